from __future__ import annotations

import random
from collections import Counter
from itertools import chain

import pytest

from kiln.llm import decontamination as D
from kiln.llm.decontamination import Index, contaminated, decontaminate, shingles, words_of

from tests.llm.conftest import SF, prose


def index_of(items):
    df = Counter(chain.from_iterable(set(words_of(t)) for _, t in items))
    return Index(items, df, len(items), sum(len(words_of(t)) for _, t in items) / len(items))


def plain_hits(texts, items):
    """Items of which a text holds 80 % of the shingles."""
    out = []
    for t in texts:
        words, hit = words_of(t or ""), set()
        for i, text in items:
            own = set(shingles(words_of(text)))
            k = len(next(iter(own))) if own else 1
            there = {tuple(words[j:j + k]) for j in range(len(words) - k + 1)}
            if own and len(own & there) / len(own) >= 0.8:
                hit.add(i)
        out.append(hit)
    return out


def edited(text, rng, n):
    words = text.split()
    for k in rng.sample(range(len(words)), min(n, len(words))):
        words[k] = rng.choice(["other", words[k] + "x"])
    return " ".join(words)


def test_search_finds_what_comparing_all_finds():
    rng = random.Random(3)
    items = [(i, prose(100 + i, rng.choice([3, 6, 20, 40, 60]))) for i in range(60)]
    texts = [prose(i, rng.choice([0, 5, 90, 700])) for i in range(80)]
    for k in range(0, 80, 2):
        _, item = rng.choice(items)
        words = texts[k].split()
        at = rng.randint(0, len(words))
        texts[k] = " ".join([*words[:at], edited(item, rng, rng.choice([0, 0, 1, 2, 9])), *words[at:]])
    index = index_of(items)
    got = [{index.items[k].item_id for k in own} for own in index.search([t or "" for t in texts])]
    assert got == plain_hits(texts, items)
    assert sum(map(len, got)) > 25


def test_wand_equals_scoring_everything(monkeypatch):
    monkeypatch.setattr(D, "BLOCK", 2)
    rng = random.Random(4)
    vocabulary = [f"w{k}" for k in range(60)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(4, 14)))) for i in range(120)]
    index = index_of(items)
    for _ in range(300):
        terms = sorted({index.term[w] for w in rng.choices(vocabulary, k=rng.randint(1, 40)) if w in index.term})
        scores = Counter()
        for t in terms:
            for k, x in zip(index.docs[t], index.impacts[t], strict=True):
                scores[k] += x
        want = {k for k, s in scores.items() if s >= 1 + 1e-9}
        near = {k for k, s in scores.items() if s >= 1 - 1e-9}
        got = {k for k, _ in index.wand(terms)}
        assert want <= got <= near


@pytest.mark.parametrize("words", [500_000, 200])
def test_documents(spark, docs, words, monkeypatch):
    monkeypatch.setattr(D, "SHARD_WORDS", words)
    monkeypatch.setattr(D, "SHORTEST", 64 if words > 200 else 32)   # several length classes and shards
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
    rows, items = docs.select("doc_id", "text").collect(), [tuple(r) for r in benchmark.select("item_id", "text").collect()]
    hits = plain_hits([r["text"] for r in rows], items)
    got = {(r["doc_id"], r["item_id"]) for r in contaminated(docs, benchmark).collect()}
    assert got == {(r["doc_id"], i) for r, own in zip(rows, hits, strict=True) for i in own}
    kept = decontaminate(docs, benchmark)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r, own in zip(rows, hits, strict=True) if not own}


def test_awkward_rows(spark, awkward, no_docs):
    items = spark.createDataFrame([(1, None), (2, ""), (3, prose(4, 80)[20:300]), (3, prose(4, 80)[20:300]), (None, "two words"),
                                   (5, "?!")], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in contaminated(awkward, items).collect()}
    assert got == {(None, 3), (9, None)}
    left = decontaminate(awkward, items)
    assert left.columns == awkward.columns and left.count() == awkward.count() - 2
    empty = items.where("item_id = 77")
    assert contaminated(awkward, empty).count() == 0 and decontaminate(awkward, empty).count() == awkward.count()
    assert contaminated(no_docs, items).count() == 0 and decontaminate(no_docs, items).count() == 0


def test_question_and_answer():
    assert D.question_words("What is it?\nAnswer: a thing") == 4
    assert D.question_words("One two three. Four five.") == 3
    assert D.question_words("a b c d e f") == 4
