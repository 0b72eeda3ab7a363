"""Quantiles with linear interpolation (NumPy / ``quantile_cont`` semantics).

``multi_quantiles`` is exact and distributed for whole columns: a mergeable sketch
brackets every rank in a first scan, and a second takes the rows of the brackets,
so no task ever holds a whole column.
``grouped_quantiles`` numbers distinct values per group on the series machinery.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.session import written


def grouped_quantiles(df: DataFrame, by: Sequence[str], col: str, probs: Sequence[float],
                      out: str = "q") -> DataFrame:
    """Exact quantiles per group without gathering a group in one task.

    Rows are counted per (group, value) first, so a heavily repeated value is one
    row; the distinct values are numbered on the series machinery (a hot group is
    cut into parts numbered in parallel) and their running counts tell which
    values hold the target ranks; a tiny aggregate interpolates:
    ``(hi - h) * v_lo + (h - lo) * v_hi`` with h = (n - 1) p, as Spark's
    ``percentile`` and ``quantile_cont`` do.  Nulls and NaN are skipped; null
    group values are a group.  Result: one array column."""
    from kiln.operators import series as S
    by = list(by)
    d = df.select(*by, F.col(col).cast("double").alias("_v")).filter(F.col("_v").isNotNull() & ~F.isnan("_v"))
    # written once: the size check, the numbering and the group sizes all read it
    per = written(d.groupBy(*by, "_v").agg(F.count(F.lit(1)).alias("_c")), "values")
    size = per.groupBy(*by).agg(F.sum("_c").alias("_size"))
    seq = S.sequence(per, by, ["_v"])
    cum = S.scan_sum(seq, by, {"_upto": F.col("_c").cast("double")})
    cum = S.keyed_join(cum, size, by, "inner", True)
    upto, n1 = F.col("_upto").cast("long"), F.col("_size") - 1
    ranks = [r for p in probs for h in [n1 * F.lit(float(p))] for r in (F.floor(h) + 1, F.ceil(h) + 1)]
    # one membership test (a long OR chain makes constraint inference explode)
    held = F.exists(F.array(*[r.cast("long") for r in ranks]), lambda r: (r <= upto) & (r > upto - F.col("_c")))
    few = cum.filter(held)              # <= 2 rows per target per group
    aggs = [F.first("_size").alias("_size")]
    for i, (lo, hi) in enumerate(zip(ranks[::2], ranks[1::2], strict=True)):
        aggs += [F.max(F.when((r <= upto) & (r > upto - F.col("_c")), F.col("_v"))).alias(f"_{s}{i}")
                 for s, r in (("a", lo), ("b", hi))]
    g = few.groupBy(*by).agg(*aggs)
    vals = []
    for i, p in enumerate(probs):
        h = (F.col("_size") - 1) * F.lit(float(p))
        lo0, hi0 = F.floor(h), F.ceil(h)
        vals.append(F.when(lo0 == hi0, F.col(f"_a{i}"))
                    .otherwise((hi0 - h) * F.col(f"_a{i}") + (h - lo0) * F.col(f"_b{i}")))
    return g.select(*by, F.array(*vals).alias(out))


def column_quantiles(df: DataFrame, col: str, probs: Sequence[float]) -> list[float | None]:
    """Exact quantiles of one numeric column (nulls and NaN skipped)."""
    return multi_quantiles(df, {col: probs})[col]


SKETCH = 10_000         # the sketch places a rank within one such part of the rows
INSIDE = 20_000         # values of one bracket that are gathered as an array, about


@dataclass
class _Column:
    """What the first pass knows of a column: counts, ends, and a bracket by probability."""

    n: int                  # finite and infinite values
    under: int              # -inf
    over: int               # inf
    lo: float
    hi: float
    brackets: dict[float, tuple[float, float]]

    def ranks(self, p: float) -> tuple[int, int]:
        h = (self.n - 1) * p
        return math.floor(h), math.ceil(h)


def _first_pass(d: DataFrame, spec: dict[str, Sequence[float]]) -> dict[str, _Column]:
    inf, aggs = float("inf"), []
    for i, (c, probs) in enumerate(spec.items()):
        x = F.col(c)
        finite = F.when(x.isNotNull() & ~F.isnan(x) & (F.abs(x) < inf), x)
        sides = [min(1.0, max(0.0, p + s * 3 / SKETCH)) for p in probs for s in (-1, 1)]
        aggs += [F.count(finite).alias(f"n{i}"), F.min(finite).alias(f"lo{i}"), F.max(finite).alias(f"hi{i}"),
                 F.count_if(x == -inf).alias(f"under{i}"), F.count_if(x == inf).alias(f"over{i}"),
                 F.percentile_approx(finite, sides or [0.5], SKETCH).alias(f"q{i}")]
    r, out = d.agg(*aggs).first(), {}
    for i, (c, probs) in enumerate(spec.items()):
        n, under, over, q = r[f"n{i}"], r[f"under{i}"], r[f"over{i}"], r[f"q{i}"] or []
        whole = n <= INSIDE or under or over        # few rows, or probabilities that count infinite ones too
        brackets = {p: (r[f"lo{i}"], r[f"hi{i}"]) if whole else (q[2 * j], q[2 * j + 1]) for j, p in enumerate(probs)} if n else {}
        out[c] = _Column(n + under + over, under, over, r[f"lo{i}"], r[f"hi{i}"], brackets)
    return out


def multi_quantiles(df: DataFrame, spec: dict[str, Sequence[float]], inside: int = INSIDE) -> dict[str, list[float | None]]:
    """Exact quantiles of several columns in two scans (nulls and NaN skipped).

    The first scan merges one sketch per column, whose error is bounded, so that
    two values bracket every rank.  The second counts the rows below and at the
    ends of every bracket and takes the values between them: as arrays where the
    brackets are short by their counts, otherwise as a written table of value
    counts, in which the ranks are found by running counts.  Infinite values count
    at their end of the order.  Columns with infinite values and over ``inside``
    rows take their ends as bracket, and so the second way.
    """
    cols = {f"c{i}": c for i, c in enumerate(spec)}
    d = df.select(*[F.col(f"`{c}`").cast("double").alias(k) for k, c in cols.items()])
    known = _first_pass(d, {k: list(spec[c]) for k, c in cols.items()})
    brackets: list[tuple[str, float, float]] = []
    for k, c in cols.items():
        brackets += [b for b in dict.fromkeys((k, *known[k].brackets[p]) for p in spec[c] if known[k].n > known[k].under + known[k].over)]
    wide = {(k, lo, hi) for k, lo, hi in brackets if (lo, hi) == (known[k].lo, known[k].hi) and known[k].n > inside}
    ranks = {b: set() for b in brackets}
    for k, c in cols.items():
        for p in spec[c]:
            for r in known[k].ranks(p) if known[k].n else ():
                if known[k].under <= r < known[k].n - known[k].over:
                    ranks[k, *known[k].brackets[p]].add(r - known[k].under)
    short = [b for b in brackets if b not in wide]
    rows = max((6 * known[k].n / SKETCH if known[k].n > inside else known[k].n for k, *_ in short), default=0)
    # the sketch's bound on the rows between the ends of a bracket decides
    found = _by_array(d, short) if rows <= inside else _by_value(d, short, ranks)
    found |= _by_value(d, sorted(wide), ranks)
    out: dict[str, list[float | None]] = {}
    for k, c in cols.items():
        at, res = known[k], []
        for p in spec[c]:
            if not at.n:
                res.append(None)
                continue
            a, b = at.ranks(p)
            lo, hi = _value(at, found, k, p, a), _value(at, found, k, p, b)
            h = (at.n - 1) * p
            # same interpolation form as Spark's percentile and quantile_cont
            res.append(lo if a == b else (b - h) * lo + (h - a) * hi)
        out[c] = res
    return out


def _value(at: _Column, found: dict, k: str, p: float, rank: int) -> float:
    """The value of a rank (from 0): infinite, an end of the bracket, or inside it."""
    if rank < at.under:
        return -math.inf
    if rank >= at.n - at.over:
        return math.inf
    rank -= at.under
    if rank in (0, at.n - at.over - at.under - 1):
        return at.lo if rank == 0 else at.hi
    lo, hi = at.brackets[p]
    return found[k, lo, hi](rank)


def _by_array(d: DataFrame, brackets: list) -> dict:
    """By bracket a function from rank to value: counts below and at the ends, and the sorted values between, in one scan."""
    if not brackets:
        return {}
    of: dict[str, list[int]] = {}
    for i, (k, _, _) in enumerate(brackets):
        of.setdefault(k, []).append(i)
    ends = {k: np.array([brackets[i][1:] for i in own]).T for k, own in of.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, inner = np.zeros((len(brackets), 2), dtype=np.int64), [[] for _ in brackets]
        for b in batches:
            for k, own in of.items():
                x = b.column(k).drop_null().to_numpy()
                x = np.sort(x[np.isfinite(x)])
                lo, hi = ends[k]
                first, last = np.searchsorted(x, lo, "right"), np.searchsorted(x, hi, "left")
                below = np.searchsorted(x, lo, "left")
                counts[own] += np.stack((below, first - below), axis=1)
                for i, a, z in zip(own, first.tolist(), last.tolist(), strict=True):
                    if a < z:
                        inner[i].append(x[a:z])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(brackets)), pa.int32()), pa.array(counts[:, 0]), pa.array(counts[:, 1]),
             pa.array([np.concatenate(v) if v else np.empty(0) for v in inner], pa.list_(pa.float64()))], names=["g", "below", "at", "v"])

    parts = d.select(*of).mapInArrow(run, "g int, below long, at long, v array<double>")
    rows = parts.groupBy("g").agg(F.sum("below").alias("below"), F.sum("at").alias("at"), F.flatten(F.collect_list("v")).alias("v"))
    return {brackets[r["g"]]: _ranked(brackets[r["g"]], r["below"], r["at"], sorted(r["v"])) for r in rows.collect()}


def _ranked(bracket: tuple, below: int, at_lo: int, values: list[float]):
    _, lo, hi = bracket

    def value(rank: int) -> float:
        if rank < below:
            raise ArithmeticError("the sketch missed a rank")
        rank -= below + at_lo
        return lo if rank < 0 else values[rank] if rank < len(values) else hi
    return value


def _by_value(d: DataFrame, brackets: list, ranks: dict[tuple, set[int]]) -> dict:
    """The same for brackets of any size: counts by value, written once, and running counts over them; the rows below a
    bracket are one of its values."""
    from kiln.operators import series as S
    if not brackets:
        return {}
    tags = [F.when((F.col(k) <= hi) & (F.abs(F.col(k)) < math.inf), F.struct(
        F.lit(i).alias("g"), F.when(F.col(k) >= lo, F.col(k)).otherwise(F.lit(-math.inf)).alias("v")))
        for i, (k, lo, hi) in enumerate(brackets)]
    counts = written(d.select(F.explode(F.array_compact(F.array(*tags))).alias("x")).groupBy("x.g", "x.v").agg(
        F.count(F.lit(1)).alias("n")), "bracket")
    upto = S.scan_sum(S.sequence(counts, ["g"], ["v"]), ["g"], {"upto": F.col("n").cast("double")})
    wanted = F.create_map(*[x for i, b in enumerate(brackets) for x in (F.lit(i), F.lit(sorted(ranks[b])) if ranks[b] else F.array(F.lit(-1)))])
    held = F.filter(F.element_at(wanted, F.col("g")), lambda r: (r < F.col("upto")) & (r >= F.col("upto") - F.col("n")))
    rows = upto.select("g", "v", F.explode(held).alias("r")).collect()        # a row per wanted rank
    at = {(r["g"], r["r"]): r["v"] for r in rows}
    return {b: (lambda rank, i=i: at[i, rank]) for i, b in enumerate(brackets)}
