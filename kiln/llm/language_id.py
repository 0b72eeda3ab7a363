"""Language identification: sparse multinomial logistic regression on TF-IDF of hashed character n-grams.

Document frequencies are counted over all training texts.  The regression is
fitted by follow-the-regularised-leader with an elastic net (most weights stay
exactly zero) on a bounded sample, ``PER_CLASS`` different texts of every language and a
short stretch of each, so that short texts are known too; one in five is held
back to fit the temperature that calibrates the scores.

Texts are lower-cased; runs of other characters than letters are one space;
n-grams of one to three characters do not cross a space.  Weights: one plus the
logarithm of the count, times the smoothed inverse document frequency, scaled to
unit length.

Defined results: ``und`` with score 0 for a null text, a text without a letter,
or where there is nothing to learn from; a single language is always predicted
with score 1; texts are read whole; repeated rows give repeated results; further
columns are ignored.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.llm.common import bounded_sample, chunks, id_remainder, map_texts

BUCKETS = 1 << 15
PER_CLASS, SAMPLE = 800, 8_000      # training texts per language and in all, about
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.05, 0.01
UNKNOWN = "und"


@cache
def _letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.fromiter((unicodedata.category(chr(c))[0] == "L" for c in range(0x110000)), dtype=bool, count=0x110000)


def ngram_buckets(text: str) -> Iterator[np.ndarray]:
    """Bucket numbers of all n-grams of a text, in stretches of bounded length; nothing without a letter."""
    step = 4_000_000
    for at in range(0, len(text), step):
        # three more characters complete the n-grams that begin in this stretch
        points = np.frombuffer(text[max(0, at - 1):at + step + 2].lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        letter = _letters()[points]
        if not letter.any():
            continue
        x = np.where(letter, points, 32).astype(np.uint32)
        keep = letter.copy()
        keep[1:] |= letter[:-1]                 # the first of several spaces
        x = np.concatenate(([32], x[keep], [32])).astype(np.uint32)
        space = x == 32
        one = x * np.uint32(0x9E3779B1)
        two = (one[:-1] ^ np.uint32(0x5BD1E995)) * np.uint32(0x85EBCA6B) + x[1:]
        three = (two[:-1] ^ np.uint32(0x1B873593)) * np.uint32(0xC2B2AE35) + x[2:]
        inner = ~space[1:-1]
        for h in (one[~space], two[~(space[:-1] & space[1:])], three[inner]):
            h = h ^ (h >> np.uint32(15))
            yield ((h * np.uint32(0x2C1B3C6D)) >> np.uint32(17)).astype(np.int64)


def counts_of(text: str) -> np.ndarray | None:
    """Count of every bucket, None without a letter."""
    out = None
    for b in ngram_buckets(text):
        own = np.bincount(b, minlength=BUCKETS)
        out = own if out is None else out + own
    return out


def weighted(counts: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets present and their TF-IDF weights at unit length."""
    at = np.flatnonzero(counts)
    w = (1 + np.log(counts[at])) * idf[at]
    return at, w / (np.linalg.norm(w) or 1.0)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max())
    return e / e.sum()


def train(rows: list[tuple[np.ndarray, np.ndarray, int]], classes: int, seed: int = 0) -> np.ndarray:
    """FTRL-proximal: weights (bucket, class), the last row for the intercept."""
    z = np.zeros((BUCKETS + 1, classes))
    n = np.zeros((BUCKETS + 1, classes))

    def solve(z: np.ndarray, n: np.ndarray) -> np.ndarray:
        return np.where(np.abs(z) <= L1, 0.0, (np.sign(z) * L1 - z) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    order = np.random.default_rng(seed)
    for _ in range(EPOCHS):
        for i in order.permutation(len(rows)):
            at, x, y = rows[i]
            at, x = np.append(at, BUCKETS), np.append(x, 1.0)
            w = solve(z[at], n[at])
            error = softmax(x @ w)
            error[y] -= 1
            g = x[:, None] * error
            z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA * w
            n[at] += g * g
    return solve(z, n)


def temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature of least log loss on held-back rows, by golden-section search on its logarithm."""
    if not len(y):
        return 1.0

    def loss(log_t: float) -> float:
        x = logits / np.exp(log_t)
        top = x.max(axis=1)
        return float(np.mean(np.log(np.exp(x - top[:, None]).sum(axis=1)) + top - x[np.arange(len(y)), y]))

    a, b, g = np.log(0.02), np.log(20.0), (np.sqrt(5) - 1) / 2
    while b - a > 1e-3:
        c, d = b - g * (b - a), a + g * (b - a)
        a, b = (a, d) if loss(c) < loss(d) else (c, b)
    return float(np.exp((a + b) / 2))


def _frequencies(texts: DataFrame) -> np.ndarray:
    """Texts that hold each bucket, and at the end the number of texts; every task adds up its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(BUCKETS + 1, dtype=np.int64)
        for batch in batches:
            for part in chunks((t.as_py() for t in batch.column(0)), 1_000_000):
                for text in part:
                    counts = counts_of(text)
                    if counts is not None:
                        df[:-1] += counts > 0
                        df[-1] += 1
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(df[at])], names=["bucket", "n"])

    found = texts.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(BUCKETS + 1, dtype=np.int64)
    got = found.toArrow()                       # at most BUCKETS + 1 rows
    out[got.column("bucket").to_numpy()] = got.column("n").to_numpy()
    return out


class Model:
    """Learnt languages, weights and temperature."""

    def __init__(self, langs: list[str], idf: np.ndarray, weights: np.ndarray, t: float):
        self.langs, self.idf, self.weights, self.t = langs, idf.astype(np.float32), weights.astype(np.float32), t

    def logits(self, counts: np.ndarray) -> np.ndarray:
        at, x = weighted(counts, self.idf)
        return x @ self.weights[at] + self.weights[-1]

    def predict(self, text: str) -> tuple[str, float]:
        counts = counts_of(text) if self.langs else None
        if counts is None:
            return UNKNOWN, 0.0
        p = softmax(self.logits(counts).astype(np.float64) / self.t)
        return self.langs[int(p.argmax())], float(p.max())


def stretch(text: str, key: int) -> str:
    """A short run of whole words, its place and length set by the text's hash."""
    words = text.split()
    n = 1 + key % 8
    at = key // 8 % max(1, len(words) - n + 1)
    return " ".join(words[at:at + n])


def fit(training: DataFrame) -> Model:
    """Learn from (text, lang) rows; ``lang`` is not null."""
    langs = sorted(r["lang"] for r in training.select("lang").distinct().collect())
    if not langs:
        return Model([], np.ones(BUCKETS), np.zeros((BUCKETS + 1, 1)), 1.0)
    df = _frequencies(training)
    idf = np.log((1 + df[-1]) / (1 + df[:-1])) + 1
    per_class = max(1, min(PER_CLASS, SAMPLE // len(langs)))
    sample = bounded_sample(training, "lang", dict.fromkeys(langs, per_class)).withColumn(
        "key", F.pmod(F.xxhash64(F.lit("stretch"), "text"), F.lit(1 << 40)))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {c: [] for c in ("lang", "key", "at", "x")}
            for lang, key, text in zip(*(batch.column(c).to_pylist() for c in ("lang", "key", "text")), strict=True):
                for t in (text, stretch(text, key)):
                    counts = counts_of(t)
                    if counts is not None:
                        at, x = weighted(counts, idf)
                        for c, v in zip(out, (lang, key, at.astype(np.int32), x.astype(np.float32)), strict=True):
                            out[c].append(v)
            yield pa.RecordBatch.from_pydict(out, pa.schema([
                ("lang", pa.string()), ("key", pa.int64()), ("at", pa.list_(pa.int32())), ("x", pa.list_(pa.float32()))]))

    got = sample.select("lang", "key", "text").mapInArrow(
        features, "lang string, key long, at array<int>, x array<float>").toArrow().sort_by(
            [("key", "ascending"), ("lang", "ascending")])
    y = [langs.index(v) for v in got.column("lang").to_pylist()]
    rows = [(a.values.to_numpy(), x.values.to_numpy().astype(np.float64), c)
            for a, x, c in zip(got.column("at"), got.column("x"), y, strict=True)]
    held = np.array([k % 5 == 0 for k in got.column("key").to_pylist()], dtype=bool)
    weights = train([r for r, h in zip(rows, held, strict=True) if not h], len(langs))
    back = [r for r, h in zip(rows, held, strict=True) if h]
    logits = np.array([x @ weights[at] + weights[-1] for at, x, _ in back]).reshape(len(back), len(langs))
    return Model(langs, idf, weights, temperature(logits, np.array([c for _, _, c in back], dtype=np.int64)))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             parts: int = 3, held: int = 1) -> DataFrame:
    """(id, held_out, lang_pred, score); learns from rows whose id's remainder is not ``held``."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"),
                       F.col(f"`{lang_col}`").alias("lang"),
                       (id_remainder(F.col(f"`{id_col}`"), parts) == held).alias("held_out"))
    model = fit(rows.where(~F.col("held_out") & F.col("lang").isNotNull() & F.col("text").isNotNull()).select(
        "text", "lang"))

    def run(texts: list[str]) -> dict:
        found = [model.predict(t) for t in texts]
        return {"lang_pred": [f[0] for f in found], "score": [f[1] for f in found]}

    return map_texts(rows, "text", {id_col: "id", "held_out": "held_out"},
                     {"lang_pred": "string", "score": "double"}, run)
