from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from kiln.llm import suffix_dedup
from kiln.llm.suffix_dedup import merged, multikey_sort, remove_repeats


def plain(texts):
    """(bytes, removed, runs, digest) of every text by counting all 200-byte strings."""
    raws = [(t or "").encode() for t in texts]
    seen = Counter(r[p:p + 200] for r in raws for p in range(len(r) - 199))
    out = []
    for r in raws:
        gone = np.zeros(len(r), dtype=bool)
        for p in range(len(r) - 199):
            if seen[r[p:p + 200]] > 1:
                gone[p:p + 200] = True
        kept = bytes(np.frombuffer(r, dtype=np.uint8)[~gone])
        runs = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        out.append((len(r), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


def planted(seed, n=60):
    """Random texts that share stretches of all lengths around 200 bytes, at ends and within."""
    rng = random.Random(seed)

    def noise(k):
        return "".join(rng.choices("abcdefgh é", k=k))

    shared = [noise(rng.choice([150, 198, 199, 200, 201, 230, 360, 700])) for _ in range(12)]
    texts = []
    for _ in range(n):
        parts = []
        for _ in range(rng.randint(0, 4)):
            s = rng.choice(shared)
            a = rng.choice([0, 0, rng.randint(0, len(s) // 2)])
            parts += [noise(rng.choice([0, 1, 30, 300])), s[a:]]
        texts.append("".join(parts) + noise(rng.choice([0, 5, 400])))
    return [*texts, "ab" * 500, "x" * 450, "x" * 199, "x" * 200, None, "", texts[0], texts[1][3:]]


def rows_of(df):
    return sorted((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in df.collect())


@pytest.mark.parametrize("crowded,bucket", [(50_000, 20_000), (2, 50)])
def test_planted_repeats(spark, crowded, bucket):
    texts = planted(1 if crowded > 2 else 2)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert rows_of(remove_repeats(df, crowded=crowded, bucket=bucket)) == [(i, *p) for i, p in enumerate(plain(texts))]


def test_documents_and_kept_bytes(docs):
    rows = docs.select("doc_id", "text").orderBy("doc_id").collect()
    want = [(r["doc_id"], *p) for r, p in zip(rows, plain([r["text"] for r in rows]), strict=True)]
    assert rows_of(remove_repeats(docs)) == want
    for r in remove_repeats(docs, text=True).collect():
        assert hashlib.sha256(r["kept"]).hexdigest() == r["kept_sha256"]


def test_awkward_rows(awkward, no_docs):
    texts = [r["text"] for r in awkward.collect()]
    got = sorted(tuple(r)[1:] for r in remove_repeats(awkward).collect())
    small = [t if t is None or len(t) < 100_000 else None for t in texts]       # the long one has no repeat of its own
    want = plain(small)
    want = sorted((len((t or "").encode()), p[1], p[2], p[3]) if t == s else
                  (len(t), 0, 0, hashlib.sha256(t.encode()).hexdigest()) for t, s, p in zip(texts, small, want, strict=True))
    assert got == want
    assert remove_repeats(no_docs).count() == 0


def test_multikey_sort_orders_rows_and_measures_prefixes():
    rng = random.Random(4)
    rows = [bytes(rng.choices(b"\x00ab", k=rng.randint(0, 24))) for _ in range(500)] + [b"", b"\x00"]
    size = np.array([len(r) for r in rows])
    padded = np.frombuffer(b"".join(r.ljust(24, b"\0") for r in rows), dtype=np.uint8).reshape(-1, 24)
    order, common = multikey_sort(padded, size)
    assert [rows[i] for i in order] == sorted(rows, key=lambda r: (r.ljust(24, b"\0"), len(r)))
    for k in range(1, len(rows)):
        a, b = rows[order[k - 1]], rows[order[k]]
        n = next((i for i in range(min(len(a), len(b))) if a[i] != b[i]), min(len(a), len(b)))
        assert common[k] == n


def test_anchor_of_equal_strings_is_equal():
    rng = random.Random(6)
    shared = bytes(rng.choices(b"abcd", k=200))
    places = set()
    for k in (0, 17, 333):
        text = bytes(rng.choices(b"abcd", k=k)) + shared + bytes(rng.choices(b"abcd", k=90))
        _, place, _, _, seed, _ = suffix_dedup.anchors_of([b"", text])
        inside = {(int(p) - k, int(s)) for p, s in zip(place, seed, strict=True) if 0 <= p - k <= 160}
        places = inside if not places else places & inside
    assert places


def test_merged():
    assert merged([(5, 9), (0, 3), (3, 4), (8, 12)]) == [(0, 4), (5, 12)]


def test_long_texts_in_parts_have_the_same_anchors(monkeypatch):
    rng = random.Random(8)
    texts = [bytes(rng.choices(b"abcdef", k=k)) for k in (0, 150, 5_000, 900, 12_345)] + [b"xy" * 2_000]
    whole = suffix_dedup.anchors_of(texts)
    monkeypatch.setattr(suffix_dedup, "PART", 700)
    parts = suffix_dedup.anchors_of(texts)
    rows = [sorted(zip(*(c.tolist() for c in a), strict=True)) for a in (whole, parts)]
    assert rows[0] == rows[1] and len(set(rows[0])) == len(rows[0]) > 200
