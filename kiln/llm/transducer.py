"""Byte-level BPE as a transducer: encoding with bounded lookahead, decoding as a stream.

Merging gives every string one sequence of tokens, and the sequence of a string
up to one of its token boundaries is the sequence of that prefix.  A sequence is
that of its string exactly if every token and every two neighbours are left as
they are when merged on their own.  So a reader need only hold, for each place
where the current token may have begun, the tokens up to there and the bytes
since as a node of the trie of tokens: a state of the transducer.  A place whose two
bytes would be merged first, whatever token follows, is no place where one begins.  A byte moves
all of them on, ends the one token that fits its neighbour, and emits the tokens
on which all agree; no more bytes are ever waited for than a token has.  States
and arcs are made when a text first needs them and kept by the worker.

Decoding steps a state machine of UTF-8 over the bytes of the tokens and
releases whole characters; the bytes of an unfinished one wait for more tokens.

Defined results: a null text counts as empty (no tokens, the digests of no
bytes); special strings inside a text are ordinary text; repeated rows give
repeated results; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
from pyspark.sql import DataFrame

from kiln.llm.common import map_texts

ARCS = 700_000              # arcs kept by a worker, about; beyond that the transducer is grown anew
MEMO, SHORT = 300_000, 64   # pieces remembered by a worker (twice as many at most), and their length; only saves repeated work
BLOCK = 65_536              # ids decoded at a time
START, NEVER = -1, 1 << 60      # no token before; no merge


class Transducer:
    """The encoder of one table of ranks, grown as texts need it.

    A state is the tuple of its readings, each a node of the trie and a path; a
    path is a number that stands for the last emitted token and the tokens since.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.child: dict[int, int] = {}
        self.token = [-1]
        # when a token is merged on its own: the rank at which its first and its last byte first take part
        size = max(ranks.values()) + 2
        self.last_byte, self.last_merge, self.first_merge = [0] * size, [-1] * size, [NEVER] * size
        self.lead, self.least = [0], [NEVER]        # of a node: its first byte, the earliest such rank of a token below it
        for token, rank in ranks.items():
            first, last = self._merge_times(token)
            self.last_byte[rank], self.last_merge[rank], self.first_merge[rank] = token[-1], last, first
            node = 0
            for b in token:
                node = self.child.setdefault(node << 8 | b, len(self.token))
                if node == len(self.token):
                    self.token.append(-1)
                    self.lead.append(token[0])
                    self.least.append(NEVER)
                self.least[node] = min(self.least[node], first)
            self.token[node] = rank
        self.inner = bytearray(len(self.token))
        for key in self.child:
            self.inner[key >> 8] = 1
        self.pairs = [ranks.get(bytes([x, y]), NEVER) for x in range(256) for y in range(256)]
        self.stays: dict[int, bool] = {}
        self._grow_anew()

    def _grow_anew(self) -> None:
        self.path_of: dict[int, int] = {}
        self.path_token: list[int] = []         # last token of a path
        self.path_before: list[int] = []        # the path without it, -1 at an emitted token
        self.path_first: list[int] = []         # its first token that is not emitted, -1 if there is none
        self.number: dict[tuple[int, ...], int] = {}
        self.states: list[tuple[int, ...]] = []
        self.arcs: dict[int, int | tuple[int, list[int]]] = {}
        self._state((0, self._path(-1, START)))

    def merged(self, data: bytes) -> list[int]:
        """Tokens of ``data`` by merging the neighbours of least rank, the leftmost first."""
        parts = [data[i:i + 1] for i in range(len(data))]
        ranks = [self.ranks.get(data[i:i + 2], NEVER) for i in range(len(data) - 1)]
        while ranks and (best := min(ranks)) < NEVER:
            i = ranks.index(best)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            del ranks[i]
            if i:
                ranks[i - 1] = self.ranks.get(parts[i - 1] + parts[i], NEVER)
            if i < len(ranks):
                ranks[i] = self.ranks.get(parts[i] + parts[i + 1], NEVER)
        return [self.ranks[p] for p in parts]

    def fits(self, left: int, token: int) -> bool:
        """Whether merging leaves these neighbours (or ``token`` alone, at the start) as they are."""
        key = (left + 1) << 32 | token
        known = self.stays.get(key)
        if known is None:
            if len(self.stays) > ARCS:
                self.stays.clear()
            pair = [token] if left == START else [left, token]
            known = self.stays[key] = self.merged(b"".join([self.bytes_of[t] for t in pair])) == pair
        return known

    def _merge_times(self, token: bytes) -> tuple[int, int]:
        """Ranks of the first merges of a token's first and last byte."""
        parts = [token[i:i + 1] for i in range(len(token))]
        first = last = NEVER
        while len(parts) > 1:
            ranks = [self.ranks.get(a + b, NEVER) for a, b in zip(parts, parts[1:])]
            best = min(ranks)
            if best == NEVER:
                break
            i = ranks.index(best)
            if i == 0 and first == NEVER:
                first = best
            if i == len(ranks) - 1 and last == NEVER:
                last = best
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return first, last

    def _path(self, before: int, token: int) -> int:
        key = (before + 1) << 32 | token + 1
        at = self.path_of.get(key)
        if at is None:
            at = self.path_of[key] = len(self.path_token)
            self.path_token.append(token)
            self.path_before.append(before)
            first = -1 if before < 0 else self.path_first[before]
            self.path_first.append(token if first < 0 <= before else first)
        return at

    def _tokens(self, path: int) -> list[int]:
        """Tokens of a path, the emitted one first."""
        out = []
        while path >= 0:
            out.append(self.path_token[path])
            path = self.path_before[path]
        return out[::-1]

    def _state(self, readings: tuple[int, ...]) -> int:
        at = self.number.get(readings)
        if at is None:
            at = self.number[readings] = len(self.states)
            self.states.append(readings)
        return at

    def _arc(self, state: int, byte: int) -> int | tuple[int, list[int]]:
        """The arc of ``byte``: every reading moved on, and the tokens that all readings share."""
        child, token, inner, stays, first = self.child, self.token, self.inner, self.stays, self.path_first
        last_byte, last_merge, first_merge = self.last_byte, self.last_merge, self.first_merge
        lead, least, pairs = self.lead, self.least, self.pairs
        readings, alive, ended = self.states[state], [], -1
        for k in range(0, len(readings), 2):
            node = child.get(readings[k] << 8 | byte)
            if node is None:
                continue
            path = readings[k + 1]
            last = self.path_token[path]
            across = pairs[last_byte[last] << 8 | lead[node]]
            joins = across < last_merge[last]
            if joins and across < least[node]:
                continue        # the bytes at the boundary would be merged before anything parts them
            if ended < 0 and (own := token[node]) >= 0 and not (joins and across < first_merge[own]):
                known = stays.get((last + 1) << 32 | own)
                if (self.fits(last, own) if known is None else known) and self.fits(START, own):
                    ended = self._path(path, own)
            if inner[node]:
                alive += (node, path)
        if not alive:               # all is settled but the last token, whose neighbour is still to come
            emitted = self._tokens(ended)[1:]
            to = self.arcs[state << 8 | byte] = self._state((0, self._path(-1, emitted[-1]))), emitted
            return to
        alive += (0, ended)
        shared = first[ended]
        for k in range(1, len(alive), 2):
            if first[alive[k]] != shared:
                to = self._state(tuple(alive))
                break
        else:
            paths = [self._tokens(path) for path in alive[1::2]]
            agreed = 1
            while all(len(p) > agreed and p[agreed] == paths[-1][agreed] for p in paths):
                agreed += 1
            for k, p in enumerate(paths):
                path = -1
                for t in p[agreed - 1:]:
                    path = self._path(path, t)
                alive[2 * k + 1] = path
            to = self._state(tuple(alive)), paths[-1][1:agreed]
        self.arcs[state << 8 | byte] = to
        return to

    def encode(self, piece: bytes) -> list[int]:
        """Ids of one piece; a piece that is a token is that token, as the library has it."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        if len(self.arcs) > ARCS:
            self._grow_anew()
        arcs, state, out = self.arcs, 0, []
        for byte in piece:
            to = arcs.get(state << 8 | byte)
            if to is None:
                to = self._arc(state, byte)
            if type(to) is int:
                state = to
            else:
                state, emitted = to
                out += emitted
        return out + self._tokens(self.states[state][-1])[1:]


def _utf8() -> np.ndarray:
    """Transitions of UTF-8 by (state, byte): 0 whole, 1 to 3 so many bytes missing, 4 to 7 with a narrower next byte, 8 broken."""
    table = np.full((9, 256), 8, dtype=np.uint8)
    table[0, :0x80] = 0
    table[0, 0xC2:0xE0] = 1
    table[0, 0xE0:0xF0] = 2
    table[0, 0xF0:0xF5] = 3
    for state in (1, 2, 3):
        table[state, 0x80:0xC0] = state - 1
    # overlong forms, surrogates and what lies beyond the last code point
    for state, lead, low, high, then in ((4, 0xE0, 0xA0, 0xC0, 1), (5, 0xED, 0x80, 0xA0, 1), (6, 0xF0, 0x90, 0xC0, 2),
                                         (7, 0xF4, 0x80, 0x90, 2)):
        table[0, lead] = state
        table[state, low:high] = then
    return table


UTF8 = _utf8()
_STEPS = UTF8.tolist()


class Decoder:
    """Bytes of a stream of ids, released character by character.

    Bytes that cannot belong to a character are released as they are and counted in ``broken``.
    """

    def __init__(self, codec: Codec):
        self.codec, self.state, self.held, self.broken = codec, 0, bytearray(), 0

    def _step(self, data: bytes) -> bytes:
        out = bytearray()
        for byte in data:
            state = _STEPS[self.state][byte]
            if state == 8 and self.state:       # an unfinished character ends here
                self.broken += 1
                out += self.held
                self.held.clear()
                state = _STEPS[0][byte]
            if state == 8:
                self.broken += 1
                state = 0
            self.held.append(byte)
            self.state = state
            if not state:
                out += self.held
                self.held.clear()
        return bytes(out)

    def _effect(self, token: int) -> tuple[int, int] | None:
        """(state after a token, bytes of it that are unfinished then), None if it breaks a character; kept by the codec."""
        key = self.state << 24 | token
        effects = self.codec.effects
        if key not in effects:
            state, whole, name = self.state, 0, self.codec.names[token]
            for k, byte in enumerate(name, 1):
                state = _STEPS[state][byte] if state < 8 else 8
                whole = k if not state else whole
            effects[key] = None if state == 8 else (state, len(name) - whole)
        return effects[key]

    def feed(self, ids: np.ndarray) -> bytes:
        """Whole characters up to and with ``ids``; tokens of whole characters need no steps of their own."""
        names, held = self.codec.names, self.held
        cut = np.flatnonzero(self.codec.partial[ids]).tolist()
        ids = ids.tolist()
        out, at, k = [], 0, 0
        while at < len(ids):
            if not self.state:
                while k < len(cut) and cut[k] < at:
                    k += 1
                end = cut[k] if k < len(cut) else len(ids)
                if end > at:
                    out.append(b"".join(map(names.__getitem__, ids[at:end])))
                if end == len(ids):
                    break
                at = end
            token = ids[at]
            effect = self._effect(token)
            if effect is None:
                out.append(self._step(names[token]))
            else:
                self.state, left = effect
                held += names[token]
                if left < len(names[token]):
                    out.append(bytes(held[:len(held) - left]))
                    del held[:len(held) - left]
            at += 1
        return b"".join(out)

    def close(self) -> bytes:
        """What is left of an unfinished character."""
        self.broken += bool(self.held)
        out, self.state = bytes(self.held), 0
        self.held.clear()
        return out


LETTER, NUMBER, SPACE, OTHER, EDGE, UNKNOWN = range(6)


@cache
def _probes() -> list:
    """The library's own classes: per class an encoding that keeps only its characters."""
    import tiktoken
    single = {bytes([b]): b for b in range(256)}
    return [(tiktoken.Encoding(name, pat_str=name, mergeable_ranks=single, special_tokens={}), kind)
            for name, kind in ((r"\p{L}", LETTER), (r"\p{N}", NUMBER), (r"\s", SPACE))]


class Splitter:
    """Matches of the split pattern, found on the classes of the characters of many texts at once.

    The pattern is that of the vocabulary, ``bpe.SPLIT``.  A piece is a run of
    letters, of numbers or of other characters, with the blank before it; of
    white space before a character the last one stands alone unless it is such a
    blank; an apostrophe that begins a piece and a contraction is one with it.
    Classes are asked of the library, once per character.
    """

    CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")     # fixed values

    def __init__(self):
        self.classes = np.full(0x110000, UNKNOWN, dtype=np.uint8)

    def _classes(self, points: np.ndarray) -> np.ndarray:
        out = self.classes[points]
        unknown = out == UNKNOWN
        if unknown.any():
            for c in np.unique(points[unknown]).tolist():
                self.classes[c] = next((kind for probe, kind in _probes() if probe.encode_ordinary(chr(c))), OTHER)
            out = self.classes[points]
        return out

    def starts(self, points: np.ndarray, edges: np.ndarray) -> np.ndarray:
        """Where pieces start, edges (the place after each text) included."""
        kind = self._classes(points)
        kind[edges] = EDGE
        begin = np.ones(len(kind), dtype=bool)
        begin[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == EDGE)
        # the last white space before a character is cut off; a blank begins the run that follows
        last = np.flatnonzero((kind[:-1] == SPACE) & (kind[1:] < EDGE) & (kind[1:] != SPACE))
        begin[last] = True
        begin[last[points[last] == 32] + 1] = False
        # an apostrophe that begins a piece, before the letters of a contraction
        mark = np.flatnonzero((points[:-1] == 39) & begin[:-1] & (kind[1:] == LETTER))
        second = mark + 1
        third = np.where(kind[second + 1] == LETTER, points[second + 1], 0)        # a text ends in an edge at the latest
        for c in self.CONTRACTIONS:
            own = points[second] == ord(c[1])
            if len(c) > 2:
                own &= third == ord(c[2])
            begin[second[own]] = False
            begin[mark[own] + len(c)] = True
        return np.flatnonzero(begin)

    def pieces(self, texts: list[str]) -> list[list[str]]:
        """Pieces of every text."""
        if not texts:
            return []
        joined = "\0".join([*texts, ""])
        ends = np.cumsum([len(t) + 1 for t in texts]) - 1
        starts = self.starts(np.frombuffer(joined.encode("utf-32-le"), dtype="<u4"), ends)
        cut = np.searchsorted(starts, ends).tolist()            # the number of the edge after each text
        starts = starts.tolist()
        out, first = [], 0
        for k in cut:
            own = starts[first:k + 1]
            out.append([joined[a:b] for a, b in zip(own, own[1:])])
            first = k + 1
        return out


class Codec:
    """Encoder and decoder of a file of ranks (lines of a base64 token and its rank)."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}
        self.transducer = Transducer(ranks)
        self.splitter = Splitter()
        self.names: list[bytes] = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.names[rank] = token
        self.decimal = [str(i) for i in range(len(self.names))]
        self.partial = np.array([self._ends(name) for name in self.names])
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}           # what was remembered before the memo was full
        self.effects: dict[int, tuple[int, int] | None] = {}

    @staticmethod
    def _ends(name: bytes) -> bool:
        """Whether a token is not a run of whole characters."""
        try:
            name.decode()
            return False
        except UnicodeDecodeError:
            return True

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of every text."""
        out = []
        for pieces in self.splitter.pieces(texts):
            if len(self.memo) > MEMO:
                self.older, self.memo = self.memo, {}
            memo, older, long = self.memo, self.older, {}
            for piece in set(pieces).difference(memo):
                ids = older.get(piece)
                if ids is None:
                    ids = np.array(self.transducer.encode(piece.encode()), dtype="<u4").tobytes()
                (memo if len(piece) <= SHORT else long)[piece] = ids
            found = map(memo.__getitem__, pieces) if not long else [long[p] if p in long else memo[p] for p in pieces]
            out.append(np.frombuffer(b"".join(found), dtype="<u4"))
        return out

    def encode(self, text: str) -> np.ndarray:
        return self.encode_all([text])[0]

    def decode(self, ids: np.ndarray) -> Iterator[bytes]:
        """Bytes of ``ids``, as a stream of whole characters."""
        decoder = Decoder(self)
        for low in range(0, len(ids), BLOCK):
            yield decoder.feed(ids[low:low + BLOCK])
        yield decoder.close()

    def joined(self, ids: Iterable[int]) -> str:
        return ",".join(map(self.decimal.__getitem__, ids))


@cache
def codec(path: str) -> Codec:
    return Codec(path)


def byte_bpe(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) of every row: its ids, and the bytes that they decode to."""

    def run(texts: list[str]) -> dict:
        own = codec(path)
        out: dict[str, list] = {"n_tokens": [], "ids_sha256": [], "decoded_sha256": []}
        for ids in own.encode_all(texts):
            decoded = hashlib.sha256()
            for part in own.decode(ids):
                decoded.update(part)
            for column, value in zip(out.values(), (
                    len(ids), hashlib.sha256(own.joined(ids.tolist()).encode()).hexdigest(), decoded.hexdigest()), strict=True):
                column.append(value)
        return out

    return map_texts(docs, text_col, {id_col: id_col},
                     {"n_tokens": "long", "ids_sha256": "string", "decoded_sha256": "string"}, run)


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids): little-endian unsigned 32-bit ids of every row, as bytes."""
    return map_texts(docs, text_col, {id_col: id_col}, {"ids": "binary"},
                     lambda texts: {"ids": [ids.tobytes() for ids in codec(path).encode_all(texts)]})
