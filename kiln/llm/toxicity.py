"""Toxicity scores by a factorization machine over hashed terms.

The terms of a text are its distinct lower-cased words and the first four, five
and six letters of each (stems of inflected words), hashed to 32 bits.  Linear
weights tell which terms speak for the label; every term also has a short vector
whose products weigh pairs of terms, so that a word that is harmless by itself
counts beside another.  The machine is fitted on a bounded sample of different
labelled texts, over the terms of that sample that depend on the label by a chi-square
test, or of which a pair does beyond what its terms say alone; both limits rise with
the logarithm of the tests that are made.  It learns in AdaGrad steps on small batches
with an L2 penalty.  What machines of the other folds say of each fold scales the
scores, so that 0.5 is where both labels, weighed alike, are told apart best.

Defined results: null and empty texts have no term and get the score of the
intercept; texts are read whole; a label given more than once counts as toxic if
any says so, null labels are ignored; with labels of only one kind every score
is that kind's smoothed share (0.5 without any); repeated rows give repeated
results; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.llm.common import bounded_sample, id_remainder, map_texts

PER_CLASS = 4_000           # labelled texts of either kind that are fitted, about
STEMS = (4, 5, 6)
LEAST, PAIR = 4, 20.0       # texts that hold a term; a pair's departure from its terms, at least
FACTORS, EPOCHS, RATE, L2 = 8, 30, 0.2, 0.1
BATCH, FOLDS = 128, 5       # texts of a step; parts that are held back in turn to place the cut
LINEAR = 15                 # epochs before the factors join: pairs only explain what single terms do not
MEMO = 300_000              # words remembered by a worker; only saves repeated work

WORD = re.compile(r"[^\W\d_]+")


def word_terms(word: str) -> list[int]:
    return [zlib.crc32(word.encode()), *(zlib.crc32(f"{n}:{word[:n]}".encode()) for n in STEMS if len(word) >= n)]


def text_terms(text: str) -> np.ndarray:
    """Sorted hashes of a text's terms."""
    return np.array(sorted({t for w in set(WORD.findall(text.lower())) for t in word_terms(w)}), dtype=np.int64)


class Machine:
    """Intercept, linear weights and factors of the chosen terms."""

    def __init__(self, terms: np.ndarray, w0: float, w: np.ndarray, v: np.ndarray):
        self.index = {int(t): i for i, t in enumerate(terms)}
        self.w0, self.w, self.v = w0, w, v
        self.memo: dict[str, tuple[int, ...]] = {}

    def raw(self, at: np.ndarray) -> float:
        s = self.v[at].sum(axis=0)
        return self.w0 + self.w[at].sum() + 0.5 * float(s @ s - (self.v[at] ** 2).sum())

    def score(self, text: str) -> float:
        memo, known = self.memo, set()
        for word in set(WORD.findall(text.lower())):
            hit = memo.get(word)
            if hit is None:
                if len(memo) >= MEMO:
                    memo.clear()
                hit = memo[word] = tuple(i for t in word_terms(word) if (i := self.index.get(t)) is not None)
            if hit:
                known.update(hit)
        x = self.raw(np.fromiter(known, dtype=np.int64, count=len(known)))
        return float(1 / (1 + np.exp(-np.clip(x, -35, 35))))


def logit(x: np.ndarray, n: np.ndarray, share: float) -> tuple[np.ndarray, np.ndarray]:
    """Log odds of ``x`` toxic texts among ``n``, drawn to ``share`` by one text, and their variance."""
    toxic, clean = x + share, n - x + 1 - share
    return np.log(toxic / clean), 1 / toxic + 1 / clean


def beyond(tests: float) -> float:
    """A statistic with one degree of freedom that chance reaches less than once in so many tests."""
    return 2 * float(np.log(max(tests, 2)))


def paired(texts: list[np.ndarray], y: np.ndarray, terms: np.ndarray) -> np.ndarray:
    """Terms of ``terms`` of which a pair departs from what the two say by themselves (logits add up).

    Terms held by the same texts count as one.  All pairs that share enough texts
    to show it are compared; the limit rises with the logarithm of their number.
    """
    order = np.argsort(-y, kind="stable")                       # toxic texts first
    y, texts = y[order], [texts[i] for i in order]
    at = [places(t, terms) for t in texts]
    where, owner = np.concatenate(at), np.repeat(np.arange(len(at), dtype=np.int32), [len(a) for a in at])
    marks = np.random.default_rng(0).integers(0, 1 << 52, len(at))
    alike = np.zeros(len(terms), dtype=np.int64)
    np.add.at(alike, where, marks[owner])                       # of the set of texts, modulo 2**64
    _, example, group = np.unique(alike, return_index=True, return_inverse=True)
    df = np.bincount(where, minlength=len(terms))[example]
    n, n1 = len(y), float(y.sum())
    share = n1 / n
    few = PAIR / (2 * np.log(1 / min(share, 1 - share)))        # fewer common texts cannot reach the least limit
    kept = np.argsort(-df, kind="stable")
    kept = kept[df[kept] >= few]
    number = np.full(len(terms), -1)
    number[example[kept]] = np.arange(len(kept))
    rows = [np.sort(r[r >= 0]).astype(np.int32) for r in (number[a] for a in at)]
    del at, where
    flat, owner = np.concatenate(rows), np.repeat(np.arange(len(rows), dtype=np.int32), [len(r) for r in rows])
    place = np.concatenate([np.arange(len(r), dtype=np.int32) for r in rows])
    by_term = np.argsort(flat, kind="stable").astype(np.int32)
    cut = np.concatenate(([0], np.cumsum(np.bincount(flat, minlength=len(kept)))))
    total = np.diff(cut).astype(float)
    toxic = np.bincount(flat, weights=y[owner], minlength=len(kept))
    best, compared = np.zeros(len(kept)), 0                     # a term's best pair
    for a in range(len(kept)):
        own = by_term[cut[a]:cut[a + 1]]
        more = [rows[i][:k] for i, k in zip(owner[own].tolist(), place[own].tolist(), strict=True)]     # more frequent terms
        both = np.bincount(np.concatenate(more), minlength=1)
        b = np.flatnonzero(both >= few)
        if not len(b):
            continue
        compared += len(b)
        first = np.concatenate([*more[:int(toxic[a])], b])      # one too many of each b
        o, m = (np.bincount(first, minlength=len(both))[b] - 1).astype(float), both[b].astype(float)
        la, va = logit(toxic[a] - o, total[a] - m, share)
        lb, vb = logit(toxic[b] - o, total[b] - m, share)
        l0, v0 = logit(n1 - toxic[a] - toxic[b] + o, n - total[a] - total[b] + m, share)
        p = 1 / (1 + np.exp(-np.clip(la + lb - l0, -4, 4)))
        g = 2 * (o * np.log(np.maximum(o, 1e-9) / (m * p)) + (m - o) * np.log(np.maximum(m - o, 1e-9) / (m * (1 - p))))
        g /= 1 + m * p * (1 - p) * (va + vb + v0)               # less where the expectation is uncertain
        best[a] = max(best[a], g.max())
        best[b] = np.maximum(best[b], g)
    found = best >= max(PAIR, beyond(compared))
    return terms[np.isin(group, group[example[kept[found]]])]


def choose(texts: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    """Terms whose presence depends on the label, alone or in a pair."""
    terms, df = np.unique(np.concatenate(texts), return_counts=True)
    n, n1 = len(y), int(y.sum())
    df, both = df.astype(float), np.zeros(len(terms))
    for text in (t for t, toxic in zip(texts, y, strict=True) if toxic):
        both[np.searchsorted(terms, text)] += 1
    spread = df * (n - df) * n1 * (n - n1)
    chi = np.divide(n * (n * both - df * n1) ** 2, spread, out=np.zeros(len(terms)), where=spread > 0)
    often = df >= LEAST
    alone = terms[often & (chi >= beyond(often.sum()))]
    return np.union1d(alone, paired(texts, y, terms[often])) if often.any() else alone


def places(text: np.ndarray, terms: np.ndarray) -> np.ndarray:
    """Places in ``terms`` of those that a text holds; both are sorted."""
    at = np.minimum(np.searchsorted(terms, text), max(len(terms) - 1, 0))
    return at[terms[at] == text].astype(np.int32) if len(terms) else np.empty(0, dtype=np.int32)


class Rows:
    """Places of the chosen terms of many texts, one after the other."""

    def __init__(self, texts: list[np.ndarray], terms: np.ndarray):
        at = [places(t, terms) for t in texts]
        self.size = np.array([len(a) for a in at])
        self.start = np.concatenate(([0], np.cumsum(self.size)))
        self.flat = np.concatenate([*at, np.empty(0, dtype=np.int32)])

    def of(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(term places, number in ``which`` of the text that holds each)."""
        size = self.size[which]
        owner = np.repeat(np.arange(len(which)), size)
        place = np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(self.start[which], size)
        return self.flat[place], owner


def raw_scores(w0: float, w: np.ndarray, v: np.ndarray, term: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(scores, summed factors) of ``n`` texts."""
    s = np.zeros((n, v.shape[1]))
    for f in range(v.shape[1]):
        s[:, f] = np.bincount(owner, weights=v[term, f], minlength=n)
    squares = np.bincount(owner, weights=(v[term] ** 2).sum(axis=1), minlength=n)
    return w0 + np.bincount(owner, weights=w[term], minlength=n) + 0.5 * ((s * s).sum(axis=1) - squares), s


def balanced(y: np.ndarray) -> np.ndarray:
    """Weights under which both kinds weigh alike."""
    return np.where(y > 0, len(y) / (2 * max(y.sum(), 1)), len(y) / (2 * max(len(y) - y.sum(), 1)))


def descend(rows: Rows, y: np.ndarray, terms: int, which: np.ndarray, seed: int) -> tuple[float, np.ndarray, np.ndarray]:
    """(intercept, weights, factors) learnt from the texts ``which``, in AdaGrad steps on small batches."""
    rng = np.random.default_rng(seed)
    w0, w, v = 0.0, np.zeros(terms), rng.normal(0, 0.01, (terms, FACTORS))
    g0, gw, gv = 1.0, np.ones(terms), np.ones(v.shape)
    weight = np.zeros(len(y))
    weight[which] = balanced(y[which])
    for epoch in range(EPOCHS):
        order = rng.permutation(which)
        for low in range(0, len(order), BATCH):
            own = order[low:low + BATCH]
            term, owner = rows.of(own)
            x, s = raw_scores(w0, w, v if epoch >= LINEAR else v[:, :0], term, owner, len(own))
            error = weight[own] * (1 / (1 + np.exp(-np.clip(x, -35, 35))) - y[own])
            g0 += error.sum() ** 2
            w0 -= RATE * error.sum() / np.sqrt(g0)
            if not len(term):
                continue
            held = L2 * np.bincount(term, minlength=terms)
            e = np.bincount(term, weights=error[owner], minlength=terms)
            g = e + held * w
            gw += g ** 2
            w -= RATE * g / np.sqrt(gw)
            if epoch >= LINEAR:
                pulled = error[:, None] * s
                g = (held - e)[:, None] * v
                for f in range(FACTORS):
                    g[:, f] += np.bincount(term, weights=pulled[owner, f], minlength=terms)
                gv += g ** 2
                v -= RATE * g / np.sqrt(gv)
    return w0, w, v


def cut_at_half(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """(scale, bias) by which scores ``x`` of texts that were not learnt from say best which are toxic, both kinds weighed
    alike; drawn to (1, 0) by the weight of one text."""
    a, b, weight = 1.0, 0.0, balanced(y)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -35, 35)))
        g = np.array([(weight * (p - y) * x).sum() + a - 1, (weight * (p - y)).sum() + b])
        h = weight * p * (1 - p)
        hessian = np.array([[(h * x * x).sum() + 1, (h * x).sum()], [(h * x).sum(), h.sum() + 1]])
        step = np.linalg.solve(hessian, g)
        step /= max(1.0, np.abs(step).max())
        a, b = max(1e-3, a - step[0]), b - step[1]
        if np.abs(step).max() < 1e-9:
            break
    return a, b


def train(texts: list[np.ndarray], y: np.ndarray, seed: int = 0) -> Machine:
    """The machine of all texts, its scores scaled by what machines of the others say of each fold."""
    terms = choose(texts, y)
    rows = Rows(texts, terms)
    everything = np.arange(len(y))
    fold = np.empty(len(y), dtype=np.int64)
    for kind in (0.0, 1.0):             # either kind is dealt evenly
        own = np.flatnonzero(y == kind)
        fold[np.random.default_rng(seed).permutation(own)] = np.arange(len(own)) % FOLDS
    held, known = np.zeros(len(y)), np.zeros(len(y), dtype=bool)
    for k in range(FOLDS):
        out, rest = np.flatnonzero(fold == k), np.flatnonzero(fold != k)
        if len(out) and 0 < y[rest].sum() < len(rest):
            held[out] = raw_scores(*descend(rows, y, len(terms), rest, seed), *rows.of(out), len(out))[0]
            known[out] = True
    w0, w, v = descend(rows, y, len(terms), everything, seed)
    scale, bias = cut_at_half(held[known], y[known]) if 0 < y[known].sum() < known.sum() else (1.0, 0.0)
    return Machine(terms, scale * w0 + bias, scale * w, np.sqrt(scale) * v)


def fit(training: DataFrame) -> Machine:
    """Learn from (text, toxic) rows, toxic being 0 or 1."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [text_terms(t.as_py() or "") for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), batch.column("key"),
                                              pa.array([t.astype(np.uint32).view(np.int32) for t in found],
                                                       pa.list_(pa.int32()))],
                                             names=["toxic", "key", "terms"])

    got = training.select("text", "toxic", "key").mapInArrow(run, "toxic int, key long, terms array<int>").toArrow()
    got = got.sort_by([("key", "ascending"), ("toxic", "ascending")])
    y = got.column("toxic").to_numpy().astype(float)
    if y.sum() in (0, len(y)):
        share = (y.sum() + 0.5) / (len(y) + 1)
        return Machine(np.empty(0, dtype=np.int64), float(np.log(share / (1 - share))), np.zeros(0), np.zeros((0, FACTORS)))
    texts = [t.values.to_numpy().view(np.uint32) for t in got.column("terms")]
    return train(texts, y)


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "toxic", parts: int = 5, held: int = 0) -> DataFrame:
    """(id, held_out, score, predicted); learns from labelled rows whose id's remainder is not ``held``."""
    known = (labels.select(F.col(id_col).alias("id"), (F.col(label_col) > 0).cast("int").alias("toxic"))
             .where("id IS NOT NULL AND toxic IS NOT NULL").where(id_remainder("id", parts) != held)
             .groupBy("id").agg(F.max("toxic").alias("toxic")))
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    # only ids and hashes are joined; the sample holds some thousand hashes by construction, whatever the tables' sizes
    hashes = rows.where("id IS NOT NULL").select("id", F.xxhash64("text").alias("key")).distinct().join(known, "id")
    sample = bounded_sample(hashes, "toxic", {0: PER_CLASS, 1: PER_CLASS}, "key")
    texts = rows.where("id IS NOT NULL").select("text", F.xxhash64("text").alias("key")).join(
        F.broadcast(sample.select("key").distinct()), "key").distinct()
    machine = fit(texts.join(F.broadcast(sample), "key"))

    def run(texts: list[str]) -> dict:
        scores = list(map(machine.score, texts))
        return {"score": scores, "predicted": [int(s >= 0.5) for s in scores]}

    marked = rows.withColumn("held_out", id_remainder("id", parts) == held)
    return map_texts(marked, "text", {id_col: "id", "held_out": "held_out"}, {"score": "double", "predicted": "int"}, run)
