"""Interaction of text filters: what each removes in every order, and its Shapley share.

A document is reduced to the set of filters that it fails, and every part of the
table to the number of documents that each of the 2^k coalitions of filters
removes.  Those numbers are all that a report needs: a step's count is the
difference of two coalitions, and the Shapley value is the constrained
least-squares fit of an additive game, solved in rationals.

Copies are found on digests: only (id, part, digest, set) rows are shuffled,
never texts, and equal rows are counted before they meet, so a group of copies
is no row's or task's burden.

Defined results: a null text counts as empty, a null part as the empty string;
a null id is no one's earlier copy and has none; rows of one id and text are no
copies of each other; of repeated labels of an id any 1 counts; an empty table
gives no rows; further columns of both tables are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from fractions import Fraction
from itertools import permutations
from math import comb, factorial

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kiln.llm.common import map_texts

FILTERS = "ABCDE"
LEAST_WORDS, DISTINCT, CAPITALS = 50, 65, 5         # words; distinct words and capitals a hundred
MARKS = b"#$%&*|"
COPY = 16                                           # the bit of E
_CAPITALS = bytes(range(65, 91))
_CONTINUED = bytes(range(0x80, 0xC0))
_KINDS = ("n", "good", "toxic")


def failures(data: bytes) -> int:
    """Bits of the filters A to D that a text fails; words end at ASCII white space."""
    words = data.split()
    n = len(words)
    capitals = len(data) - len(data.translate(None, _CAPITALS))
    points = len(data) - (0 if data.isascii() else len(data) - len(data.translate(None, _CONTINUED)))
    return ((n < LEAST_WORDS) | (100 * len(set(words)) < DISTINCT * n) << 1 | (100 * capitals > CAPITALS * points) << 2
            | (len(data) != len(data.translate(None, MARKS))) << 3)


def shapley(removed: Sequence[int], k: int) -> list[Fraction]:
    """Shapley values of the game ``removed`` (by coalition of ``k`` players, as bits).

    The additive game that fits all proper coalitions best under the Shapley
    kernel and is exact on the whole one: normal equations with one multiplier,
    solved by elimination in rationals.
    """
    whole = (1 << k) - 1
    rows = [[Fraction(0)] * (k + 2) for _ in range(k + 1)]
    for s in range(1, whole):
        size = s.bit_count()
        weight = Fraction(k - 1, comb(k, size) * size * (k - size))
        inside = [i for i in range(k) if s >> i & 1]
        for i in inside:
            for j in inside:
                rows[i][j] += weight
            rows[i][-1] += weight * (removed[s] - removed[0])
    for i in range(k):
        rows[i][k] = rows[k][i] = Fraction(1)
    rows[k][-1] = Fraction(removed[whole] - removed[0])
    for c in range(k + 1):
        pivot = next(r for r in range(c, k + 1) if rows[r][c])
        rows[c], rows[pivot] = rows[pivot], rows[c]
        rows[c] = [x / rows[c][c] for x in rows[c]]
        for r in range(k + 1):
            if r != c and rows[r][c]:
                rows[r] = [x - rows[r][c] * y for x, y in zip(rows[r], rows[c], strict=True)]
    return [rows[i][-1] for i in range(k)]


def report(games: dict[str, Sequence[int]], names: str = FILTERS) -> Iterator[tuple]:
    """(order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) of every order and step.

    ``games`` holds by kind the documents removed by every coalition, and under
    ``total`` the number of documents.
    """
    n, good, toxic = (games[c] for c in _KINDS)
    k = len(names)
    whole = (1 << k) - 1
    shares = [factorial(k) * v for v in shapley(n, k)]
    for order in permutations(range(k)):
        label, before = "".join(names[i] for i in order), 0
        for step, i in enumerate(order, 1):
            bit = 1 << i
            after = before | bit
            out = n[after] - n[before]
            yield (label, step, games["total"] - n[after], out, n[bit] - out, n[whole] - n[whole ^ bit],
                   good[after] - good[before], toxic[after] - toxic[before], int(shares[i]))
            before = after


def failure_counts(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   part_col: str = "source") -> DataFrame:
    """(part, failed, n, good, toxic): documents by the set of filters that they fail."""

    def run(texts: list[str]) -> dict:
        data = [t.encode() for t in texts]
        return {"failed": [failures(d) for d in data], "digest": [hashlib.sha256(d).digest() for d in data]}

    slim = map_texts(docs, text_col, {"id": id_col, "part": part_col}, {"failed": "int", "digest": "binary"}, run)
    slim = slim.withColumn("part", F.coalesce(F.col("part").cast("string"), F.lit("")))
    marked = labels.groupBy(F.col(f"`{id_col}`").alias("id")).agg(
        *[F.max((F.col(c) == 1).cast("int")).alias(k) for c, k in (("quality", "good"), ("toxic", "toxic"))])
    marked = slim.join(marked, "id", "left").fillna(0, ["good", "toxic"])
    same = ["digest", "failed", "part", "good", "toxic"]
    ids = marked.groupBy(*same, "id").agg(F.count(F.lit(1)).alias("n"))
    groups = ids.groupBy(*same).agg(F.sum("n").alias("n"), F.min("id").alias("least"), F.min_by("n", "id").alias("at_least"),
                                    F.sum(F.when(F.col("id").isNull(), F.col("n")).otherwise(0)).alias("no_id"))
    least = F.min("least").over(Window.partitionBy("digest"))      # at most four rows a part and digest
    first = F.col("no_id") + F.when(F.col("least") == least, F.col("at_least")).otherwise(0)
    split = groups.withColumn("first", first).select(
        "part", "good", "toxic", F.explode(F.array(
            F.struct(F.col("failed"), F.col("first").alias("n")),
            F.struct((F.col("failed") + COPY).alias("failed"), (F.col("n") - F.col("first")).alias("n")))).alias("at"))
    return split.groupBy("part", F.col("at.failed").alias("failed")).agg(
        F.sum("at.n").alias("n"), *[F.sum(F.col("at.n") * F.col(c)).alias(c) for c in _KINDS[1:]])


def filter_audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 part_col: str = "source") -> DataFrame:
    """The report of every part: one row per order of the filters and step."""
    counts = failure_counts(docs, labels, id_col, text_col, part_col)
    coalitions = range(1 << len(FILTERS))
    removed = [F.array(*[F.sum(F.when(F.col("failed").bitwiseAND(F.lit(s)) != 0, F.col(c)).otherwise(0))
                         for s in coalitions]).alias(c) for c in _KINDS]
    games = counts.groupBy("part").agg(F.sum("n").alias("total"), *removed)
    names = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost",
             "shapley"]
    types = [pa.string(), pa.string(), pa.int32(), *[pa.int64()] * 7]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for game in batch.to_pylist():
                rows = [(game["part"], *r) for r in report(game)]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)],
                                                 names=names)

    return games.mapInArrow(run, "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in names[3:]))


ORACLE = """
WITH base AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents
), words AS (
  SELECT *, list_filter(string_split_regex(text, '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w,
         min(doc_id) OVER (PARTITION BY text) AS least FROM base
), failed AS (
  SELECT doc_id, part,
    (len(w) < 50)::INT + 2 * (100 * len(list_distinct(w)) < 65 * len(w))::INT
    + 4 * (100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text))::INT
    + 8 * regexp_matches(text, '[#$%&*|]')::INT + 16 * coalesce(doc_id > least, false)::INT AS failed FROM words
), marks AS (
  SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id
), counts AS (
  SELECT part, failed, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
  FROM failed LEFT JOIN marks USING (doc_id) GROUP BY part, failed
), filters AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f, unnest([1, 2, 4, 8, 16]) AS bit
), orders AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM filters a, filters b, filters c, filters d, filters e
  WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND (a.bit | b.bit | c.bit | d.bit | e.bit) = 31
), steps AS (
  SELECT filter_order, step, bits[step] AS bit, list_sum(bits[1:step - 1])::INT AS before
  FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step)
), steps2 AS (
  SELECT filter_order, step, bit, coalesce(before, 0) AS before FROM steps
), r AS (
  SELECT part, filter_order, step, bit,
    sum(n) FILTER ((failed & (before | bit)) = 0) AS kept,
    sum(n) FILTER ((failed & bit) <> 0 AND (failed & before) = 0) AS removed,
    sum(n) FILTER ((failed & bit) <> 0 AND (failed & before) <> 0) AS redundant,
    sum(n) FILTER (failed = bit) AS unique_fails,
    sum(good) FILTER ((failed & bit) <> 0 AND (failed & before) = 0) AS good_lost,
    sum(toxic) FILTER ((failed & bit) <> 0 AND (failed & before) = 0) AS toxic_lost
  FROM counts, steps2 GROUP BY part, filter_order, step, bit
)
SELECT part, filter_order, step::INT AS step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
  coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
  coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
  (sum(coalesce(removed, 0)) OVER (PARTITION BY part, bit))::BIGINT AS shapley FROM r
"""
