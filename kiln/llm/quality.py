"""Quality rules with thresholds learnt from the corpus.

Fixed rules reject texts with too few words or mostly repeated word triples.
All other limits come from mergeable quantile sketches: every measure is
counted in logarithmic buckets per language and source, the counts add up
(partial sums before the shuffle, so a hot source costs one row per bucket and
task), and each group's limits follow from its own quantiles.  Groups of fewer
than ``min_group`` texts use the sketch of their language, and small languages
that of the whole corpus; the coarser sketches are sums of the finer ones.

An upper limit is ``median + reach * max(spread, step)`` where the spread is
the median less the lower quartile, so that junk above the median does not
widen it; a lower limit mirrors this.

Defined results: a null or empty text has no words and fails the fixed rules;
null languages and sources are groups of their own; repeated rows are judged
alike; an empty table gives no rows; further columns are ignored or carried.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kiln.llm.common import map_texts, written

MIN_WORDS, REPEAT_PERCENT = 50, 50      # fixed rules
GAMMA = 1.02                            # bucket growth: quantiles are within 1 % of a true value
REACH = 4.0
MIN_GROUP = 200

# measure -> (least spread, upper limit?, lower limit?)
MEASURES = {
    "symbols_per_word": (0.05, True, False),
    "chars_per_word": (0.5, True, True),
    "repeated_lines": (0.125, True, False),
    "repeated_words": (0.1, True, False),
}
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a window of three words found at least twice."""
    if len(words) < 4:
        return 0
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], dtype=np.int64)
    pair = ids[:-1] * len(number) + ids[1:]
    if len(number) > 2_000_000:         # keeps the next product below 2**63
        pair = np.unique(pair, return_inverse=True)[1]
    triple = pair[:-1] * len(number) + ids[2:]
    order = np.argsort(triple, kind="stable")
    same = triple[order][1:] == triple[order][:-1]
    again = np.zeros(len(triple), dtype=bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    covered = np.zeros(len(words), dtype=bool)
    for k in range(3):
        covered[k:k + len(triple)] |= again
    return int(covered.sum())


def text_counts(text: str) -> tuple[int, ...]:
    """The counts in the order of ``COUNTS``."""
    words = text.encode().split()       # bytes split at 0x20 and 0x09-0x0d only
    spaces = sum(map(text.count, " \t\n\v\f\r"))
    symbols = sum(map(text.count, "#*$%&|<>"))
    lines = [line for line in text.split("\n") if line.strip(" \t\v\f\r")]
    return (len(words), len(text) - spaces, symbols, len(lines) - len(set(lines)), repeated_words(words), len(lines))


def measured(docs: DataFrame, carry: dict[str, str], text_col: str = "text") -> DataFrame:
    """Carried columns, the counts and whether the fixed rules fail."""

    def run(texts: list[str]) -> dict:
        return dict(zip(COUNTS, zip(*map(text_counts, texts), strict=True), strict=True))

    out = map_texts(docs, text_col, carry, dict.fromkeys(COUNTS, "long"), run)
    return out.withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                          | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words")))


def measure_columns() -> dict[str, F.Column]:
    words, lines = F.greatest("n_words", F.lit(1)), F.greatest("n_lines", F.lit(1))
    return {"symbols_per_word": F.col("n_symbols") / words, "chars_per_word": F.col("word_chars") / words,
            "repeated_lines": F.col("n_dup_lines") / lines, "repeated_words": F.col("n_repeat_words") / words}


def sketches(counts: DataFrame, groups: list[str]) -> DataFrame:
    """Bucket counts per group and measure over all texts that pass the fixed rules."""
    values = F.array(*[F.struct(F.lit(m).alias("measure"), c.alias("value"))
                       for m, c in measure_columns().items()])
    bucket = F.when(F.col("value") < 1e-6, F.lit(-1_000_000)).otherwise(
        F.ceil(F.log("value") / math.log(GAMMA))).cast("int")
    return (counts.where(~F.col("base_failed")).select(*groups, F.explode(values).alias("v"))
            .select(*groups, "v.*").groupBy(*groups, "measure", bucket.alias("bucket"))
            .agg(F.count(F.lit(1)).alias("n")))


def quantiles(sketch: DataFrame, groups: list[str]) -> DataFrame:
    """Quartiles and size per group and measure: running sums over at most some thousand buckets."""
    merged = sketch.groupBy(*groups, "measure", "bucket").agg(F.sum("n").alias("n"))
    keys = Window.partitionBy(*groups, "measure")
    run = merged.select("*", F.sum("n").over(keys.orderBy("bucket")).alias("upto"), F.sum("n").over(keys).alias("size"))
    at = [F.min(F.when(F.col("upto") >= F.ceil(F.col("size") * q), F.col("bucket"))).alias(name)
          for name, q in (("q1", 0.25), ("q2", 0.5), ("q3", 0.75))]
    found = run.groupBy(*groups, "measure").agg(F.max("size").alias("size"), *at)
    value = {q: F.when(F.col(q) == -1_000_000, 0.0).otherwise(F.pow(F.lit(GAMMA), F.col(q)) * (2 / (1 + GAMMA)))
             for q in ("q1", "q2", "q3")}
    return found.select(*groups, "measure", "size", *[v.alias(q) for q, v in value.items()])


def limits(sketch: DataFrame, groups: list[str], min_group: int = MIN_GROUP) -> DataFrame:
    """One row per group: an upper and lower limit for each measure, from the finest sketch that is large enough."""
    sketch = written(sketch, "sketch")
    levels = []
    for k in range(len(groups), -1, -1):
        q = quantiles(sketch, groups[:k])
        step = F.element_at(F.create_map(*[F.lit(x) for m, (s, _, _) in MEASURES.items() for x in (m, s)]), F.col("measure"))
        high = F.col("q2") + REACH * F.greatest(F.col("q2") - F.col("q1"), step)
        low = F.col("q2") - REACH * F.greatest(F.col("q3") - F.col("q2"), step)
        per = [F.max(F.when(F.col("measure") == m, e)).alias(f"{m}_{side}")
               for m, (_, up, down) in MEASURES.items() for e, side, on in ((high, "high", up), (low, "low", down)) if on]
        levels.append(q.groupBy(*groups[:k]).agg(F.max("size").alias("size"), *per))
    names = [c for c in levels[0].columns if c not in (*groups, "size")]
    out = sketch.select(*groups).distinct()
    for k, level in zip(range(len(groups), -1, -1), levels, strict=True):
        level = level.select(*[F.col(g).alias(f"{g}_{k}") for g in groups[:k]],
                             F.struct("size", *names).alias(f"level_{k}"))
        on = F.lit(True)
        for g in groups[:k]:
            on = on & F.col(g).eqNullSafe(F.col(f"{g}_{k}"))
        out = out.join(level, on, "left").drop(*[f"{g}_{k}" for g in groups[:k]])
    ks = list(range(len(groups), -1, -1))
    chosen = F.coalesce(*[F.when(F.col(f"level_{k}.size") >= (min_group if k else 0), F.col(f"level_{k}")) for k in ks])
    return out.select(*groups, chosen.alias("limits")).select(*groups, "limits.*").drop("size")


def judged(counts: DataFrame, bounds: DataFrame, groups: list[str]) -> DataFrame:
    """``counts`` with ``kept``: the fixed rules hold and every measure lies within its group's limits."""
    on = F.lit(True)
    renamed = bounds.select(*[F.col(g).alias(f"__{g}") for g in groups],
                            *[F.col(c).alias(f"__{c}") for c in bounds.columns if c not in groups])
    for g in groups:
        on = on & counts[g].eqNullSafe(renamed[f"__{g}"])
    within = ~F.col("base_failed")
    for m, c in measure_columns().items():
        _, up, down = MEASURES[m]
        if up:
            within = within & F.coalesce(c <= F.col(f"__{m}_high"), F.lit(True))
        if down:
            within = within & F.coalesce(c >= F.col(f"__{m}_low"), F.lit(True))
    return counts.join(renamed, on, "left").withColumn("kept", within).drop(*renamed.columns)


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
            source_col: str = "source", min_group: int = MIN_GROUP) -> DataFrame:
    """Counts and verdict of every row."""
    groups = ["lang", "source"]
    counts = written(measured(docs, {id_col: id_col, "lang": lang_col, "source": source_col}, text_col), "counts")
    bounds = written(limits(sketches(counts, groups), groups, min_group), "limits")
    return judged(counts, bounds, groups).select(id_col, *COUNTS[:5], "base_failed", "kept")


def quality_filter(docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
                   source_col: str = "source", min_group: int = MIN_GROUP) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns.

    The texts are measured twice, once for the sketches and once beside the
    limits, instead of being shuffled or written to meet them.
    """
    groups = ["__lang", "__source"]
    own = {"__lang": lang_col, "__source": source_col}
    bounds = written(limits(sketches(measured(docs, own, text_col), groups), groups, min_group), "limits")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), F.col(lang_col).alias("__lang"),
                       F.col(source_col).alias("__source"), F.col(text_col).alias("__t"))
    counts = measured(rows, {"__row": "__row", "__lang": "__lang", "__source": "__source"}, "__t")
    return judged(counts, bounds, groups).where("kept").select("__row.*")
