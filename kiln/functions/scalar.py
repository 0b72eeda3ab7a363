"""Scalar column builders (all JVM-side expressions)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from kiln.functions.arrays import clip  # noqa: F401  (P20 lives with the array helpers)


def lenient_double(c: Column | str) -> Column:
    """P10: numeric cast where a bad value becomes null (pandas ``errors='coerce'``)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.trim(c.cast("string")).try_cast("double")


# Accepted spellings of booleans in text columns.
TRUE_WORDS = ("true", "1")
FALSE_WORDS = ("false", "0")


def text_to_bool(c: Column | str, null_as_false: bool = False) -> Column:
    """Trim + lower; true/1 -> true, false/0 -> false, anything else null."""
    c = F.col(c) if isinstance(c, str) else c
    t = F.lower(F.trim(c.cast("string")))
    out = F.when(t.isin(*TRUE_WORDS), F.lit(True)).when(t.isin(*FALSE_WORDS), F.lit(False))
    return F.coalesce(out, F.lit(False)) if null_as_false else out


def split_code(c: Column | str, sep: str = "/", numeric_middle: bool = True) -> list[Column]:
    """``a/b/c`` -> three columns, only when exactly three parts exist."""
    c = F.col(c) if isinstance(c, str) else c
    parts = F.split(c, sep, -1)
    ok = F.size(parts) == 3
    first = F.when(ok, F.element_at(parts, 1))
    mid = F.when(ok, F.element_at(parts, 2))
    last = F.when(ok, F.element_at(parts, 3))
    if numeric_middle:
        mid = mid.try_cast("double")
    return [first, mid, last]


def case_bands(c: Column, cuts: Sequence[float], labels: Sequence[str],
               null_label: str | None = None,
               inclusive: Sequence[bool] | None = None) -> Column:
    """Ordered CASE bucketing.  Value below cuts[i] (or at it when
    ``inclusive[i]``) -> labels[i]; above every cut -> labels[-1]."""
    if len(labels) != len(cuts) + 1:
        raise ValueError("need one more label than cuts")
    inclusive = inclusive or [False] * len(cuts)
    expr = F.when(c.isNull() | F.isnan(c), F.lit(null_label))
    for cut, lab, inc in zip(cuts, labels[:-1], inclusive):
        expr = expr.when(c <= F.lit(cut) if inc else c < F.lit(cut), F.lit(lab))
    return expr.otherwise(F.lit(labels[-1]))


# Expected-value bands of a return distribution (upper bounds of
# deep loss, loss, neutral, profit) and their names.
EV_BAND_CUTS = (-0.03, -0.005, 0.005, 0.03)
EV_BAND_LABELS = ("Deep Loss", "Loss", "Neutral", "Profit", "Deep Profit")
EV_BAND_NULL = "Unknown (NaN EV)"


def ev_band(c: Column, cuts: Sequence[float] = EV_BAND_CUTS) -> Column:
    """Five EV bands: < deep loss, < loss, <= neutral, <= profit, above; null band."""
    return case_bands(c, cuts, EV_BAND_LABELS, EV_BAND_NULL, inclusive=(False, False, True, True))


def ev_category(c: Column, threshold: float = 0.005, nan_as: str = "Neutral") -> Column:
    """Three-way Profitable / Neutral / Loss by +-threshold; null -> ``nan_as``."""
    return (F.when(c.isNull() | F.isnan(c), F.lit(nan_as))
             .when(c > threshold, F.lit("Profitable"))
             .when(c < -threshold, F.lit("Loss"))
             .otherwise(F.lit("Neutral")))


# Colour bands of the EV chart data.
EV_COLOUR_CUTS = (-0.05, -0.01, 0.01, 0.05)
EV_COLOURS = ("darkred", "lightcoral", "yellow", "lightgreen", "darkgreen")


def ev_colour(c: Column) -> Column:
    """Six colour bands: null grey; < -0.05; [-0.05, -0.01); [-0.01, 0.01]; (0.01, 0.05]; above."""
    return case_bands(c, EV_COLOUR_CUTS, EV_COLOURS, "grey", inclusive=(False, False, True, True))


def safe_ratio(num: Column, den: Column) -> Column:
    """Ratio where a zero (or null) denominator gives null."""
    return F.try_divide(num, F.nullif(den, F.lit(0)))


def row_sum(cols: Sequence[str]) -> Column:
    """Row-wise sum with nulls as 0."""
    out = F.lit(0.0)
    for c in cols:
        out = out + F.coalesce(F.col(c).cast("double"), F.lit(0.0))
    return out


def row_argmax(cols: Sequence[str]) -> Column:
    """P17 (first part): name of the largest column, first wins on ties, nulls as 0."""
    vals = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in cols]
    top = F.greatest(*vals) if len(vals) > 1 else vals[0]
    expr = None
    for c, v in zip(cols, vals):
        expr = F.when(v == top, F.lit(c)) if expr is None else expr.when(v == top, F.lit(c))
    return expr
