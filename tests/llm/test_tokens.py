from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest

from kiln.llm import packing
from kiln.llm.bpe import UNCERTAIN, SPLIT, encoded, library, merges
from kiln.llm.packing import cut, pack, plan
from kiln.llm.token_counts import count_tokens, token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")


def lengths(texts):
    return [len(e.ids) for e in library(PATH).encode_batch([t or "" for t in texts], add_special_tokens=False)]


def random_texts(n=400):
    rng = random.Random(3)
    chars = "ab \n\t'é½²中​ s1.-"
    return ["".join(rng.choices(chars, k=rng.randint(0, 200))) for _ in range(n)] + \
        ["".join(rng.choices("abc", k=300)) for _ in range(50)]


def test_counts_and_ids_equal_the_library():
    texts = random_texts()
    assert count_tokens(texts, PATH, {}) == lengths(texts)
    want = [np.array(e.ids, dtype="<u4").tobytes() for e in library(PATH).encode_batch(texts, add_special_tokens=False)]
    assert encoded(texts, PATH) == want


def test_certain_characters_split_alike():
    import regex
    split = regex.compile(SPLIT)
    for low in (*range(0, 0x530, 0x40), *range(0x2000, 0x2070, 0x10), *range(0x20A0, 0xA7C0, 0x800)):
        chars = [chr(c) for c in range(low, low + 0x40) if not UNCERTAIN.search(chr(c))]
        text = "".join(f"a{c}a{c}{c}1" for c in chars)
        assert [m.span() for m in split.finditer(text)] == [s for _, s in library(PATH).pre_tokenizer.pre_tokenize_str(text)]


def test_merging_is_simultaneous_and_left_to_right():
    table = merges(PATH)
    pieces = [b"", b"a", b"aaaa", b"aaaaa", b"abababab" * 50, b"\xff\xfe\x00"]
    want = [len(library(PATH).encode(p.decode("latin-1"), add_special_tokens=False).ids) for p in pieces[:-1]]
    assert table.count(pieces[:-1]).tolist() == want
    assert table.count([]).tolist() == []


def test_token_counts_of_awkward_rows(awkward, no_docs):
    rows = token_counts(awkward, PATH, limit=100).collect()
    texts = [r["text"] for r in awkward.collect()]
    assert sorted(r["n_tokens"] for r in rows) == sorted(lengths(texts))
    assert sorted(r["n_bytes"] for r in rows) == sorted(len((t or "").encode()) for t in texts)
    assert all(r["over_limit"] == (r["n_tokens"] > 100) for r in rows)
    assert token_counts(no_docs, PATH).count() == 0


@pytest.mark.parametrize("ranked", [8_000, 3])
def test_packing_of_awkward_rows(awkward, no_docs, ranked, monkeypatch):
    monkeypatch.setattr(packing, "RANKED", ranked)
    capacity = 256
    got = pack(awkward, PATH, capacity).toPandas()
    texts = [t or "" for t in (r["text"] for r in awkward.collect())]
    want = []
    for e in library(PATH).encode_batch(texts, add_special_tokens=False):
        ids = np.array([*e.ids, 0], dtype="<u4")
        want += [(k, s, n, zlib.crc32(ids[s:s + n].tobytes())) for k, (s, n) in enumerate(cut(len(ids), capacity))]
    assert sorted(map(tuple, got[["piece", "start", "length", "ids_crc32"]].to_numpy().tolist())) == sorted(want)
    check_places(got, capacity)
    assert got.sequence_id.nunique() <= -(-got.length.sum() // capacity) + 1
    assert pack(no_docs, PATH).count() == 0


def check_places(got, capacity):
    for _, own in got.sort_values(["sequence_id", "offset"]).groupby("sequence_id"):
        assert own.offset.tolist() == [0, *own.length.cumsum().tolist()[:-1]]
        assert own.length.sum() <= capacity


def test_plan_is_tight_and_complete():
    import pandas as pd
    rng = random.Random(5)
    for _ in range(30):
        capacity = rng.choice([7, 30, 100])
        histogram = {n: rng.randint(0, 40) for n in rng.sample(range(1, capacity + 1), min(capacity, 12))}
        p = plan(histogram, capacity)
        length = np.array([n for n, c in histogram.items() for _ in range(c)], dtype=np.int64)
        rank = np.array([r for c in histogram.values() for r in range(c)], dtype=np.int64)
        if not len(length):
            assert p.sequences == 0
            continue
        sequence, offset = p.place(length, rank)
        check_places(pd.DataFrame({"sequence_id": sequence, "offset": offset, "length": length}), capacity)
        assert len(set(sequence)) == p.sequences
        # no two documents above a third share a sequence with a third one
        big = pd.Series(sequence[3 * length > capacity]).value_counts()
        assert big.empty or big.max() <= 2


def test_pieces_first_takes_the_remainder():
    assert cut(1, 4) == [(0, 1)] and cut(4, 4) == [(0, 4)] and cut(9, 4) == [(0, 1), (1, 4), (5, 4)]
