from __future__ import annotations

import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from kiln.llm import language_id as L
from kiln.llm import pii
from kiln.llm import toxicity as T

SF = "/root/testdata/sf0.01"


def test_language_of_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    truth = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    rows = L.identify(docs).collect()
    assert len(rows) == len(truth)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in held]) > 0.98
    # calibrated: the mean score is close to the share of right answers
    assert abs(np.mean([r["score"] for r in held]) - np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in held])) < 0.03


def test_language_of_awkward_rows(spark, awkward, no_docs):
    rows = L.identify(awkward).collect()
    assert len(rows) == awkward.count()
    for r in rows:
        assert 0 <= r["score"] <= 1 and r["lang_pred"] in ("en", "de", "und")
    assert {r["lang_pred"] for r in rows if r["doc_id"] in (1, 2, 3)} == {"und"}
    assert L.identify(no_docs).count() == 0
    unlabelled = awkward.withColumn("lang", awkward.lang.substr(1, 0)).where("lang is null")
    assert {r["lang_pred"] for r in L.identify(unlabelled).collect()} == {"und"}


def test_ngrams_do_not_depend_on_the_stretch(monkeypatch):
    text = "Ab, cd 12 éf  gh!" * 400
    whole = L.counts_of(text)
    assert L.counts_of(" 12 !") is None and L.counts_of("") is None
    assert L.counts_of("ab") is not None
    # a b ab: two single letters, the pair with either space, and the word with both
    assert L.counts_of("ab").sum() == 2 + 3 + 2
    assert whole.sum() > 0


def test_temperature_recovers_a_scale():
    rng = np.random.default_rng(1)
    logits = rng.normal(0, 1, (4_000, 3))
    y = np.array([rng.choice(3, p=L.softmax(row)) for row in logits])
    assert abs(L.temperature(4 * logits, y) - 4) < 0.5


def test_toxicity_of_held_out_documents(spark):
    larger = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{larger}/documents.parquet"), spark.read.parquet(f"{larger}/labels.parquet")
    truth = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    rows = [r for r in T.toxicity(docs, labels).collect()]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    held = [(r["score"], truth[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in truth]
    toxic, clean = ([s for s, t in held if t == k] for k in (1, 0))
    assert np.mean([a > b for a in toxic for b in clean]) > 0.92
    assert np.mean([s >= 0.5 for s in clean]) < 0.01 and np.mean([s >= 0.5 for s in toxic]) > 0.88


def test_pairs_of_terms_are_learnt():
    rng = random.Random(1)
    noise = [f"word{k}" for k in range(40)]
    texts, y = [], []
    for k in range(1_600):
        insult, group = rng.random() < 0.5, rng.random() < 0.5
        own = rng.sample(noise, 8) + ["fool"] * insult + ["tribe"] * group
        texts.append(" ".join(own))
        y.append(float(insult and group))
    terms = [T.text_terms(t) for t in texts]
    machine = T.train(terms[:1_200], np.array(y[:1_200]))
    right = [(machine.score(t) >= 0.5) == (v == 1) for t, v in zip(texts[1_200:], y[1_200:], strict=True)]
    assert np.mean(right) > 0.98


def test_pairs_of_terms_that_are_harmless_alone():
    rng = random.Random(2)
    noise = [f"{chr(97 + k // 26)}{chr(97 + k % 26)}x" for k in range(300)]
    texts, y = [], []
    for k in range(2_000):
        one, two = k % 2, k // 2 % 2                    # either word is in half of the texts of either label
        texts.append(" ".join(rng.sample(noise, 12) + ["qua"] * one + ["zor"] * two))
        y.append(float(one != two))
    machine = T.train([T.text_terms(t) for t in texts[:1_600]], np.array(y[:1_600]))
    right = [(machine.score(t) >= 0.5) == (v == 1) for t, v in zip(texts[1_600:], y[1_600:], strict=True)]
    assert np.mean(right) > 0.98


def test_a_rare_pair_is_chosen():
    # two words in 5 % of the texts of either label, and 40 further toxic texts that hold both
    rng = np.random.default_rng(4)
    texts = [np.unique(rng.integers(10, 2_000, 15)) for _ in range(8_000)]
    y = np.repeat([1.0, 0.0], 4_000)
    for first in (0, 4_000):
        for k, word in ((0, 1), (190, 2)):              # ten of each label hold both by chance
            for i in range(first + k, first + k + 200):
                texts[i] = np.union1d(texts[i], [word])
    for i in range(1_000, 1_040):
        texts[i] = np.union1d(texts[i], [1, 2])
    got = T.choose(texts, y)
    assert {1, 2} <= set(got.tolist()) and len(got) < 100


def test_few_labels_are_learnt():
    texts = [T.text_terms(f"{w} {n}") for n in ("uvw", "xyz", "rst", "opq", "lmn") for w in ("bad", "fine")]
    machine = T.train(texts, np.array([1.0, 0.0] * 5))
    assert machine.score("bad uvw") > 0.5 > machine.score("fine uvw")


def test_toxicity_of_awkward_rows(spark, awkward, no_docs):
    labels = spark.createDataFrame([(4, 1, 1), (5, 0, 0), (5, 0, 1), (7, None, 0), (None, 1, 1), (9, 1, None), (6, 1, 0), (13, 0, 0),
                                    (77, 1, 1)], "doc_id long, quality int, toxic int")
    rows = T.toxicity(awkward, labels).collect()
    assert len(rows) == awkward.count() and all(0 <= r["score"] <= 1 for r in rows)
    none = T.toxicity(awkward, labels.where("doc_id = -1")).collect()
    assert {r["score"] for r in none} == {0.5} and {r["predicted"] for r in none} == {1}
    assert T.toxicity(no_docs, labels).count() == 0
    one = T.toxicity(awkward, labels.where("toxic = 0")).collect()
    assert {r["predicted"] for r in one} == {0}


def seen_by(monkeypatch, module):
    """The first arguments of the module's ``train``."""
    seen, own = [], module.train
    monkeypatch.setattr(module, "train", lambda rows, *a: seen.append(rows) or own(rows, *a))
    return seen


def test_copies_do_not_take_the_places_of_other_texts(spark, monkeypatch):
    several = spark.range(60).select(F.concat(F.lit("other words "), F.translate(F.col("id").cast("string"), "0123456789", "abcdefghij"))
                                     .alias("text"))
    docs = several.union(spark.range(4_000).select(F.lit("the same words again"))).coalesce(2)
    seen = seen_by(monkeypatch, L)
    L.fit(docs.withColumn("lang", F.lit("aa")).union(several.select(F.reverse("text"), F.lit("bb"))))
    assert 0.7 * 2 * 121 < len(seen[0]) <= 2 * 121              # a text and a stretch of it, one in five held back

    # one id of many rows
    docs = docs.select(F.lit(1).alias("doc_id"), "text").union(several.select(F.lit(2), F.reverse("text")))
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id int, toxic int")
    seen = seen_by(monkeypatch, T)
    T.toxicity(docs, labels, held=-1)
    assert len(seen[0]) == 121


def test_the_tagger_learns_from_a_sample_of_rows_without_ids(spark, monkeypatch):
    docs = spark.range(6_000).select(F.lit(None).cast("long").alias("doc_id"), F.concat(F.lit("Mail a"), "id", F.lit("@b.example.com now"))
                                     .alias("text"))
    seen = []
    monkeypatch.setattr(pii, "train", seen.append)
    pii.learnt(docs.union(docs))
    assert 0.5 * pii.SAMPLE < len(set(seen[0])) and len(seen[0]) < 4 * pii.SAMPLE


def test_scores_equal_the_explicit_sum_over_pairs():
    rng = np.random.default_rng(3)
    terms = np.sort(rng.choice(10_000, 30, replace=False))
    texts = [np.sort(rng.choice(terms, rng.integers(0, 9), replace=False)) for _ in range(40)]
    w0, w, v = 0.3, rng.normal(size=30), rng.normal(size=(30, T.FACTORS))
    machine = T.Machine(terms, w0, w, v)
    rows = T.Rows(texts, terms)
    together = T.raw_scores(w0, w, v, *rows.of(np.arange(40)), 40)[0]
    for k, text in enumerate(texts):
        at = np.searchsorted(terms, text)
        want = w0 + sum(w[i] for i in at) + sum(float(v[i] @ v[j]) for i in at for j in at if i < j)
        assert abs(machine.raw(at) - want) < 1e-9 and abs(together[k] - want) < 1e-9


def test_gradients_equal_finite_differences(monkeypatch):
    # one step from a known place moves against the gradient of the loss
    monkeypatch.setattr(T, "EPOCHS", 1)
    monkeypatch.setattr(T, "LINEAR", 0)
    monkeypatch.setattr(T, "L2", 0.0)
    monkeypatch.setattr(T, "RATE", 1e-4)
    rng = np.random.default_rng(4)
    terms = np.arange(12)
    texts = [np.sort(rng.choice(12, 5, replace=False)) for _ in range(30)]
    y = (rng.random(30) < 0.3).astype(float)
    rows, everything = T.Rows(texts, terms), np.arange(30)
    v0 = np.random.default_rng(0).normal(0, 0.01, (12, T.FACTORS))

    def loss(w0, w, v):
        x = T.raw_scores(w0, w, v, *rows.of(everything), 30)[0]
        return (T.balanced(y) * (np.log1p(np.exp(x)) - y * x)).sum()
    w0, w, v = T.descend(rows, y, 12, everything, 0)
    start = (0.0, np.zeros(12), v0)
    for i in range(12):
        bump = np.zeros(12)
        bump[i] = 1e-6
        g = (loss(0.0, bump, v0) - loss(0.0, -bump, v0)) / 2e-6
        assert abs(w[i] + 1e-4 * g / np.sqrt(1 + g * g)) < 1e-9
        # the factors of the step see the weights of before
        for f in (0, 3):
            bump = np.zeros_like(v0)
            bump[i, f] = 1e-6
            g = (loss(*start[:2], v0 + bump) - loss(*start[:2], v0 - bump)) / 2e-6
            assert abs(v[i, f] - v0[i, f] + 1e-4 * g / np.sqrt(1 + g * g)) < 1e-8


def test_the_cut_is_where_held_back_texts_part():
    rng = np.random.default_rng(5)
    y = (rng.random(4_000) < 0.1).astype(float)
    x = 3 * (2 * y - 1) + rng.normal(0, 1, 4_000) + 2
    scale, bias = T.cut_at_half(x, y)
    assert abs(-bias / scale - 2) < 0.3                 # the raw score that becomes 0.5
    assert T.cut_at_half(np.zeros(10), np.arange(10) % 2.0)[0] > 0


def test_limits_rise_with_the_number_of_tests():
    assert T.beyond(10) < T.beyond(1_000) < T.beyond(10 ** 8) and abs(T.beyond(10 ** 8) - 36.8) < 0.1
    rng = np.random.default_rng(6)
    noise = [np.unique(rng.integers(0, 3_000, 40)) for _ in range(600)]
    assert len(T.choose(noise, (rng.random(600) < 0.2).astype(float))) <= 6       # of millions of pairs
