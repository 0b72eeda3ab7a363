from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken

from kiln.llm import transducer
from kiln.llm.bpe import SPLIT
from kiln.llm.transducer import Decoder, Transducer, byte_bpe, codec, encode

from tests.llm.test_tokens import random_texts

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=codec(PATH).transducer.ranks,
                             special_tokens={})


def digests(library, text):
    ids = library.encode_ordinary(text or "")
    return (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256((text or "").encode()).hexdigest())


def test_pattern_is_the_public_one():
    assert SPLIT == public_tokenizers.PATTERN


def test_ids_and_bytes_equal_the_library(library):
    own = codec(PATH)
    texts = [*random_texts(), "a" * 5000, " " * 5000 + "x", "ab" * 3000, "漢字" * 1500, "\r\n" * 700, "<|endoftext|> x"]
    for text in texts:
        ids = own.encode(text)
        assert ids.tolist() == library.encode_ordinary(text)
        assert b"".join(own.decode(ids)) == text.encode()


def test_all_characters_are_split_as_the_library_does(library):
    own = codec(PATH)
    points = [chr(c) for c in range(0x1FFFF) if not 0xD800 <= c < 0xE000]
    for k in range(0, len(points), 997):
        texts = [f"a{c}a{c}{c}1 {c} \n{c}'s{c}" for c in points[k:k + 997]]
        assert [i.tolist() for i in own.encode_all(texts)] == [library.encode_ordinary(t) for t in texts]


def test_pieces_equal_the_pattern():
    split, rng, own = regex.compile(SPLIT), random.Random(9), codec(PATH).splitter
    for _ in range(300):
        texts = ["".join(rng.choices("''srtvelmdSab1 2!?\n\t \xa0\x85é漢", k=rng.randint(0, 40))) for _ in range(rng.randint(0, 12))]
        assert own.pieces(texts) == [split.findall(t) for t in texts]
    assert own.pieces(["'", "s", "a'", "re", "'r", "e", "\0", " ", "", "x "]) == [
        ["'"], ["s"], ["a", "'"], ["re"], ["'", "r"], ["e"], ["\0"], [" "], [], ["x", " "]]


def random_ranks(rng):
    """Ranks of random merges over few bytes, some of them in no order of their parts."""
    tokens = [bytes([b]) for b in range(256)]
    seen = set(tokens)
    letters = [b"a", b"b", b"c"]
    while len(tokens) < 256 + 25:
        made = rng.choice(letters) + rng.choice(letters)
        if made not in seen and len(made) < 9:
            seen.add(made)
            letters.append(made)
            tokens.append(made)
    late = tokens[256:]
    if rng.random() < 0.5:
        rng.shuffle(late)
    return {t: i for i, t in enumerate(tokens[:256] + late)}


def plain_merge(ranks, piece):
    if piece in ranks:
        return [ranks[piece]]
    parts = [bytes([b]) for b in piece]
    while True:
        found = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
        if not found:
            return [ranks[p] for p in parts]
        i = min(found)[1]
        parts[i:i + 2] = [parts[i] + parts[i + 1]]


def test_transducer_equals_plain_merging():
    rng = random.Random(5)
    for _ in range(25):
        ranks = random_ranks(rng)
        machine = Transducer(ranks)
        for _ in range(150):
            piece = bytes(rng.choices(b"aabbcd", k=rng.randint(0, 30)))
            assert machine.encode(piece) == plain_merge(ranks, piece)


def test_lookahead_is_bounded_and_arcs_are_kept(monkeypatch):
    rng = random.Random(6)
    ranks = random_ranks(rng)
    machine = Transducer(ranks)
    longest = max(map(len, ranks))
    text = bytes(rng.choices(b"abc", k=4000))
    want = machine.encode(text)
    arcs = len(machine.arcs)
    assert machine.encode(text) == want and len(machine.arcs) == arcs
    assert max(len(readings) for readings in machine.states) <= 2 * longest
    assert all(len(machine._tokens(path)) <= longest + 1 for readings in machine.states for path in readings[1::2])
    monkeypatch.setattr(transducer, "ARCS", 3)
    assert Transducer(ranks).encode(text) == want
    assert machine.encode(text) == want and machine.encode(text[:99]) == plain_merge(ranks, text[:99])


def test_decoder_releases_whole_characters():
    own = codec(PATH)
    text = "é½漢😀a" * 50
    raw = text.encode()
    decoder, out = Decoder(own), []
    for b in raw:                                  # one byte, one token
        part = decoder.feed(np.array([own.transducer.ranks[bytes([b])]]))
        part.decode()
        out.append(part)
    assert b"".join(out) == raw and decoder.close() == b"" and not decoder.broken
    rng = random.Random(7)
    for _ in range(300):
        ids = np.array([rng.randrange(len(own.names)) if rng.random() < 0.5 else own.transducer.ranks[bytes([rng.randrange(256)])]
                        for _ in range(rng.randint(0, 12))], dtype=np.int64)
        whole = b"".join(own.names[i] for i in ids)
        decoder, cut = Decoder(own), rng.randint(0, len(ids))
        parts = [decoder.feed(ids[:cut]), decoder.feed(ids[cut:])]
        held = decoder.close()
        assert b"".join([*parts, held]) == whole
        try:
            whole.decode()
            assert not decoder.broken
        except UnicodeDecodeError:
            assert decoder.broken
    decoder = Decoder(own)
    assert decoder.feed(np.array([own.transducer.ranks[bytes([b])] for b in b"a\xe6\xbc"])) == b"a"
    assert decoder.close() == b"\xe6\xbc" and decoder.broken == 1


def test_utf8_machine_equals_python():
    def accepts(data):
        state = 0
        for b in data:
            state = transducer.UTF8[state, b]
        return state == 0
    for a in range(0xC0, 0x100):
        for b in range(0x70, 0xD0):
            for tail in (b"", b"\x80", b"\x80\xbf", b"\x7f", b"\x80\x80\x80"):
                data = bytes([a, b]) + tail
                try:
                    data.decode()
                    assert accepts(data)
                except UnicodeDecodeError:
                    assert not accepts(data)


def test_awkward_rows(awkward, no_docs, library):
    rows = [tuple(r) for r in byte_bpe(awkward, PATH).collect()]
    want = [(r["doc_id"], *digests(library, r["text"])) for r in awkward.collect()]
    assert sorted(rows, key=repr) == sorted(want, key=repr)
    assert byte_bpe(no_docs, PATH).count() == 0
    ids = {(r["doc_id"], bytes(r["ids"])) for r in encode(awkward, PATH).collect()}
    assert ids == {(r["doc_id"], np.array(library.encode_ordinary(r["text"] or ""), dtype="<u4").tobytes())
                   for r in awkward.collect()}


def test_query_equals_the_library(spark, docs, library):
    from kiln.llm.queries import QUERIES
    got = {r["doc_id"]: tuple(r)[1:] for r in QUERIES["op13_byte_bpe"](spark, "/root/testdata/sf0.001").collect()}
    assert got == {r["doc_id"]: digests(library, r["text"]) for r in docs.collect()}
    assert all(re.fullmatch("[0-9a-f]{64}", v[1]) for v in got.values())
