"""Byte-level BPE on ragged arrays: splitting into pre-tokens and rank-synchronous merging.

Only the files of a public tokenizer are read; their place is a parameter.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import cache

import numpy as np
import regex

# Fixed value: the split pattern of the vocabulary.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# Characters that every Unicode version in use classes alike; texts with others are split by the library.
UNCERTAIN = regex.compile("[^\u0000-ԯ -⁯₠-ꞿ]")
LONG = 2000             # rank encoders slow down with the square of such a run without white space
NONE = np.int32(2 ** 31 - 1)

_split = regex.compile(SPLIT)


@cache
def library(path: str):
    """The vocabulary's own tokenizer, once per Python worker."""
    from tokenizers import Tokenizer
    return Tokenizer.from_file(path)


@cache
def special_strings(path: str) -> regex.Pattern | None:
    """Pattern of the added tokens, which the library cuts out of a text before all else."""
    with open(path, encoding="utf-8") as f:
        added = [t["content"] for t in json.load(f)["added_tokens"]]
    return regex.compile("|".join(map(regex.escape, sorted(added, key=len, reverse=True)))) if added else None


def certain(text: str) -> bool:
    """Whether every version of Unicode splits the text alike."""
    try:
        text.encode("latin-1")
        return True
    except UnicodeEncodeError:
        return not UNCERTAIN.search(text)


def pre_tokens(text: str, path: str, step: int = 200_000) -> Iterator[list[str]]:
    """Pre-tokens of a text without special strings, in lists of bounded length."""
    if not certain(text):
        spans = library(path).pre_tokenizer.pre_tokenize_str(text)
        yield [text[a:b] for _, (a, b) in spans]
    elif len(text) < 1_000_000:
        yield _split.findall(text)
    else:
        out = []
        for m in _split.finditer(text):
            out.append(m.group())
            if len(out) == step:
                yield out
                out = []
        yield out


def _byte_names() -> dict[int, str]:
    """Byte-level alphabets print visible Latin-1 bytes as themselves and the rest from U+0100 on."""
    shown = {b: chr(b) for b in range(256) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173}
    shown.update((b, chr(256 + i)) for i, b in enumerate(b for b in range(256) if b not in shown))
    return shown


@cache
def rank_encoder(path: str):
    """The vocabulary as ranks, or None where ids do not follow the order of the merges."""
    import tiktoken
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    vocab = model["vocab"]
    made = [vocab["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
    byte_of = {c: b for b, c in _byte_names().items()}
    alphabet = [vocab[c] for c in byte_of]
    if made != sorted(set(made)) or max(alphabet) > min(made):
        return None
    plain = {*made, *alphabet}
    ranks = {bytes(byte_of[c] for c in t): i for t, i in vocab.items() if i in plain}
    return tiktoken.Encoding("vocabulary", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})


def encoded(texts: list[str], path: str) -> list[bytes]:
    """Ids of each text as little-endian unsigned 32-bit numbers, as the library gives them.

    Texts that versions of Unicode may split differently, with special strings or
    with very long runs go to the library itself, the others to the same
    vocabulary read as ranks.
    """
    encoder, special = rank_encoder(path), special_strings(path)
    out = []
    for text in texts:
        if encoder is None or max(map(len, text.split()), default=0) > LONG or not certain(text) or (
                special and special.search(text)):
            ids = np.array(library(path).encode(text, add_special_tokens=False).ids, dtype="<u4")
        else:
            ids = encoder.encode_to_numpy(text, disallowed_special=())
        out.append(ids.astype("<u4").tobytes())
    return out


class Merges:
    """The merge table as sorted arrays, applied to many pre-tokens at once."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocab = model["vocab"]
        shown = _byte_names()
        self.first = np.array([vocab[shown[b]] for b in range(256)], dtype=np.int64)
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        key = np.array([vocab[a] << 20 | vocab[b] for a, b in pairs], dtype=np.int64)
        self.product = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        order = np.argsort(key)
        self.key, self.rank = key[order], order.astype(np.int32)

    def ranks(self, sym: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Rank of the pair that starts at each symbol; NONE where no merge exists or a sequence ends."""
        pair = sym << 20
        pair[:-1] |= sym[1:]
        at = np.minimum(np.searchsorted(self.key, pair), len(self.key) - 1)
        out = np.where(self.key[at] == pair, self.rank[at], NONE)
        out[last] = NONE
        return out

    def count(self, pieces: list[bytes]) -> np.ndarray:
        """Symbols left of every piece once no merge applies.

        Each round finds every sequence's lowest-ranked pair and merges all of
        its occurrences, left to right, in all sequences at once.
        """
        length = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
        total = length.copy()
        owner = np.flatnonzero(length)          # pieces still being merged
        length = length[owner]
        sym = self.first[np.frombuffer(b"".join(pieces), dtype=np.uint8)]
        while len(sym):
            start = np.concatenate(([0], np.cumsum(length)[:-1]))
            rank = self.ranks(sym, start + length - 1)
            best = np.minimum.reduceat(rank, start)
            live = best != NONE
            if not live.all():                  # sequences without a pair are finished
                keep = np.repeat(live, length)
                sym, rank, owner, length, best = sym[keep], rank[keep], owner[live], length[live], best[live]
                if not len(sym):
                    break
            hot = rank == np.repeat(best, length)
            at = np.arange(len(sym))
            run = at - np.maximum.accumulate(np.where(hot, -1, at)) - 1   # place in a run such as a a a
            take = np.flatnonzero(hot & (run % 2 == 0))
            sym[take] = self.product[rank[take]]
            stay = np.ones(len(sym), dtype=bool)
            stay[take + 1] = False
            ends = np.cumsum(length)
            length = length - np.diff(np.concatenate(([0], np.searchsorted(take, ends))))
            total[owner] = length
            sym = sym[stay]
        return total


@cache
def merges(path: str) -> Merges:
    return Merges(path)
