from __future__ import annotations

import random

import xxhash

from kiln.llm import simhash
from kiln.llm.simhash import drop_near_duplicates, fingerprint, links, near_duplicates


def plain_print(text):
    words = (text or "").encode()
    words = bytes(c + 32 if 65 <= c <= 90 else c for c in words).split()
    grams = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(prints):
    """Smallest member of each linked class by comparing all pairs."""
    own = sorted(set(prints))
    root = {p: p for p in own}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for i, a in enumerate(own):
        for b in own[i + 1:]:
            if ((a ^ b) & (1 << 64) - 1).bit_count() <= 3 and find(a) != find(b):
                root[max(find(a), find(b))] = min(find(a), find(b))
    return {p: find(p) for p in own}


def test_fingerprint():
    for t in ("", " ", "one", "Two words", "The Quick brown fox", "a b c a b c a b", "É É É é", "x" * 5_000):
        assert fingerprint(t) & (1 << 64) - 1 == plain_print(t)


def cloud(n=300, seed=1):
    rng = random.Random(seed)
    out = []
    for _ in range(6):
        centre = rng.getrandbits(64)
        for _ in range(n // 6):
            p = centre
            for b in rng.sample(range(64), rng.randint(0, 5)):
                p ^= 1 << b
            out.append(p)
    return [p - (1 << 64) if p >> 63 else p for p in out]


def test_links_give_the_classes_of_all_pairs_either_way(spark):
    prints = cloud()
    want = classes(prints)
    fps = spark.createDataFrame([(p,) for p in set(prints)], "fp long")
    for bucket in (1024, 2, 5):     # pairwise, nearly all stars, mixed
        got = {(r["fp"], r["root"]) for r in simhash.classes(fps, bucket).collect()}
        assert got == set(want.items()), bucket
    linked = {(r["a"], r["b"]) for r in links(fps).collect()}
    assert all(((a ^ b) & (1 << 64) - 1).bit_count() <= 3 or want[a] == want[b] for a, b in linked)


def test_long_chain(spark):
    chain = [0]
    for k in range(20):
        chain.append(chain[-1] | 7 << 3 * k)
    fps = spark.createDataFrame([(p,) for p in chain], "fp long")
    assert {r["root"] for r in simhash.classes(fps).collect()} == {0}


def test_near_duplicates_of_documents(docs):
    rows = docs.select("doc_id", "text").collect()
    prints = {r["doc_id"]: plain_print(r["text"]) for r in rows}
    signed = {i: p - (1 << 64) if p >> 63 else p for i, p in prints.items()}
    root = classes(signed.values())
    least = {}
    for i, p in signed.items():
        least[root[p]] = min(i, least.get(root[p], i))
    want = {(i, f"{prints[i]:016x}", least[root[p]]) for i, p in signed.items()}
    assert {tuple(r) for r in near_duplicates(docs).collect()} == want
    assert {r["doc_id"] for r in drop_near_duplicates(docs).collect()} == set(least.values())


def test_awkward_rows(awkward, no_docs):
    got = near_duplicates(awkward).collect()
    assert len(got) == awkward.count()
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append(r)
    assert {by[i][0]["fingerprint"] for i in (1, 2, 3)} == {"0" * 16}
    assert {by[i][0]["component_id"] for i in (1, 2, 3)} == {1}
    assert {by[i][0]["component_id"] for i in (4, 5, 16)} == {4}
    kept = drop_near_duplicates(awkward)
    assert kept.columns == awkward.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert 4 in ids and 5 not in ids and 16 not in ids and ids.count(1) == 1 and 2 not in ids
    assert ids.count(7) == 2                # its repeated row once, its other text too
    assert near_duplicates(no_docs).count() == 0 and drop_near_duplicates(no_docs).count() == 0
