"""Projection, filter and schema operators."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kiln.functions import scalar as X


# P1 -------------------------------------------------------------------------
def split_target(df: DataFrame, target: str, on_missing: str = "error") -> tuple[DataFrame, str | None]:
    """Return (features, target name).  ``on_missing``: error | warn | null.

    The table stays one DataFrame; the caller keeps the target column beside the
    features (no positional re-alignment is ever needed)."""
    if target in df.columns:
        return df, target
    if on_missing == "error":
        raise ValueError(f"no column {target!r} to predict; columns: {df.columns}")
    if on_missing == "null":
        return df.withColumn(target, F.lit(None).cast("double")), target
    return df, None


# P2 -------------------------------------------------------------------------
def drop_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop columns, ignoring the ones that are absent."""
    return df.drop(*[c for c in cols if c in df.columns])


# P3 / P4 / P5 ----------------------------------------------------------------
def drop_null_rows(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    return df.na.drop(how="any", subset=list(subset) if subset else None)


def null_drop_report(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """P3 report: kept / total / percent kept, one aggregate pass."""
    cols = list(subset) if subset else df.columns
    complete = F.lit(True)
    for c in cols:
        complete = complete & F.col(c).isNotNull()
    return df.agg(F.count(F.lit(1)).alias("total"),
                  F.sum(F.when(complete, 1).otherwise(0)).cast("long").alias("kept")) \
        .withColumn("percent_kept", F.round(F.col("kept") * 100.0 / F.col("total"), 2))


def drop_null_target(df: DataFrame, target: str | None) -> DataFrame:
    """Rows with a null target go; without a target any null row goes."""
    return df.na.drop(subset=[target]) if target else df.na.drop()


# P6 -------------------------------------------------------------------------
def normalise_names(df: DataFrame, old: str = "-", new: str = "_") -> DataFrame:
    mapping = {c: c.replace(old, new) for c in df.columns if old in c}
    return df.withColumnsRenamed(mapping) if mapping else df


# P7 -------------------------------------------------------------------------
def align_to(df: DataFrame, columns: Sequence[str], fill=0) -> DataFrame:
    """Add missing columns as ``fill``, drop extra ones, use the given order."""
    have = set(df.columns)
    return df.select(*[F.col(c) if c in have else F.lit(fill).alias(c) for c in columns])


# P8 -------------------------------------------------------------------------
# The columns of a price bar.
OHLC = ("Open", "High", "Low", "Close", "Adj Close", "Volume")


def name_shapes(name: str) -> set[str]:
    """What a column name looks like: ``price`` (that suffix), ``capitals`` (no
    small letter, at least one capital), ``word`` (letters and digits, maybe joined by ``_``)."""
    found = {"price"} if name.endswith("_price") else set()
    if name == name.upper() != name.lower():
        found.add("capitals")
    if re.fullmatch(r"_*[^\W_]\w*", name):
        found.add("word")
    return found


def macro_columns(columns: Sequence[str], ohlc: Sequence[str] = OHLC) -> list[str]:
    """Side series of a price table: names of any known shape that are not bar columns."""
    bar = set(ohlc)
    return [name for name in columns if name_shapes(name) and name not in bar]


def feature_columns(columns: Sequence[str], ohlc: Sequence[str] = OHLC) -> list[str]:
    """Names fit for a model: absolute levels (bar columns, prices, series named in
    capitals) are left out, engineered ones stay."""
    return [name for name in columns if name not in ohlc and not name_shapes(name) & {"price", "capitals"}]


# P9 -------------------------------------------------------------------------
def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def categorical_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, (T.StringType, T.BooleanType))]


# P13 ------------------------------------------------------------------------
def contract_problems(df: DataFrame, expected: dict[str, str | None], not_null: Sequence[str] = ()) -> DataFrame:
    """(column, problem) for every way ``df`` breaks a contract: the schema diff
    against ``expected`` (name -> type, None for any) and one aggregate that counts
    nulls in the columns that must have none."""
    have = dict(df.dtypes)
    diff = [(c, "absent" if c not in have else f"is {have[c]}, not {kind}")
            for c, kind in expected.items() if c not in have or kind not in (None, have[c])]
    out = df.sparkSession.createDataFrame(diff, "column string, problem string")
    checked = [c for c in not_null if c in have]
    if checked:
        nulls = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in checked])
        long = nulls.unpivot([], checked, "column", "n").where("n > 0")
        out = out.union(long.select("column", F.concat("n", F.lit(" nulls")).alias("problem")))
    return out


def check_contract(df: DataFrame, expected: dict[str, str | None], not_null: Sequence[str] = ()) -> None:
    """Raise with all problems at once; they are at most two per column."""
    found = contract_problems(df, expected, not_null).collect()
    if found:
        raise ValueError("table breaks its contract: " + "; ".join(f"{r['column']} {r['problem']}" for r in found))


# P14 ------------------------------------------------------------------------
def _float_text(c: Column) -> Column:
    return F.trim(c.cast("string")).try_cast("double")


def validation_error(schema: dict[str, str], parsed: dict[str, Column] | None = None) -> Column:
    """First failing column in schema order: null -> ``Missing value in {col}``;
    text that is not a number -> the conversion error message."""
    expr = None
    for col, kind in schema.items():
        c = F.col(f"`{col}`")
        num = parsed[col] if parsed else _float_text(c)
        bad_cast = c.isNotNull() & num.isNull()
        msg_cast = F.concat(F.lit("could not convert string to float: '"), c.cast("string"), F.lit("'")) \
            if kind == "double" else \
            F.concat(F.lit("invalid literal for int() with base 10: '"), c.cast("string"), F.lit("'"))
        step = F.when(c.isNull(), F.lit(f"Missing value in {col}")).when(bad_cast, msg_cast)
        expr = step if expr is None else F.coalesce(expr, step)
    return expr


def validate_rows(df: DataFrame, schema: dict[str, str], index: str | None = None
                  ) -> tuple[DataFrame, DataFrame]:
    """Split into (valid, rejected).  Valid rows are cast (``int`` truncates);
    rejected rows carry ``error`` and the row as JSON.  Each field is parsed
    once (a staged projection), then the error is derived from the parsed values."""
    names = {c: f"_num{i}" for i, c in enumerate(schema)}
    staged = df.withColumns({n: _float_text(F.col(f"`{c}`")) for c, n in names.items()})
    tagged = staged.withColumn("_error", validation_error(schema, {c: F.col(n) for c, n in names.items()}))
    casts = []
    for c in df.columns:
        if c in schema:
            v = F.col(names[c])
            casts.append((v.cast("int") if schema[c] == "int" else v).alias(c))
        else:
            casts.append(F.col(f"`{c}`"))
    valid = tagged.filter(F.col("_error").isNull()).select(*casts)
    keep = [index] if index else []
    rejected = tagged.filter(F.col("_error").isNotNull()).select(
        *keep, F.col("_error").alias("error"),
        F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])).alias("row"))
    return valid, rejected


def tagged_rows(df: DataFrame, schema: dict[str, str], index: str | None = None,
                keep: Sequence[str] = ()) -> DataFrame:
    """One pass over the rows: ``outcome`` (``valid`` or the error), the cast values
    of ``keep`` where valid, the row as JSON where rejected."""
    names = {c: f"_num{i}" for i, c in enumerate(schema)}
    staged = df.withColumns({n: _float_text(F.col(f"`{c}`")) for c, n in names.items()})
    t = staged.withColumn("_error", validation_error(schema, {c: F.col(n) for c, n in names.items()}))
    ok = F.col("_error").isNull()
    cast = [F.when(ok, F.col(names[c]).cast("int") if schema[c] == "int" else F.col(names[c])).alias(c) for c in keep]
    row = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]))
    return t.select(*([index] if index else []), F.coalesce("_error", F.lit("valid")).alias("outcome"), *cast,
                    F.when(~ok, row).alias("row"))


# P15 ------------------------------------------------------------------------
def task_type(df: DataFrame, target: str) -> str:
    """binary (<=2 distinct numeric), multinomial (<15), regression, multilabel
    (array), else unknown."""
    dt = df.schema[target].dataType
    if isinstance(dt, T.ArrayType):
        return "multilabel"
    if isinstance(dt, (T.NumericType, T.BooleanType)):
        n = df.agg(F.countDistinct(target).alias("n")).first()["n"]
        if n <= 2:
            return "binary"
        if n < 15:
            return "multinomial"
        return "regression"
    return "unknown"


def task_type_column(n_distinct: Column, numeric: bool = True) -> Column:
    """Same rule as a column over an aggregated distinct count."""
    if not numeric:
        return F.lit("unknown")
    return (F.when(n_distinct <= 2, F.lit("binary")).when(n_distinct < 15, F.lit("multinomial"))
             .otherwise(F.lit("regression")))


# P16 / P17 / P18 ----------------------------------------------------------------
def spend_features(df: DataFrame, cols: Sequence[str], categories: Sequence[str] | None,
                   all_zero: bool = False) -> DataFrame:
    """P16 total (nulls 0) and P17 arg-max column coded by the fitted category
    list (first wins on ties; whole table all-zero -> -1)."""
    cols = [c for c in cols if c in df.columns]
    if not cols:
        return df
    d = df.withColumns({c: F.coalesce(X.lenient_double(c), F.lit(0.0)) for c in cols})
    d = d.withColumn("total_spent", X.row_sum(cols))
    if categories is None or all_zero:
        return d.withColumn("max_spend_category", F.lit(-1))
    name = X.row_argmax(cols)
    code = F.lit(-1)
    for i, c in reversed(list(enumerate(categories))):
        code = F.when(name == F.lit(c), F.lit(i)).otherwise(code)
    return d.withColumn("max_spend_category", code.cast("int"))


def threshold_flags(df: DataFrame, cols: Sequence[str], thresholds: dict[str, dict[str, float]],
                    drop_originals: bool = True) -> DataFrame:
    """``{c}_used`` (> 0) and ``{c}_above_q25/q50/q75`` (> train quantile);
    null compares false; a missing threshold gives false."""
    out = {}
    for c in cols:
        if c not in df.columns:
            continue
        x = F.col(c)
        out[f"{c}_used"] = F.coalesce(x > 0, F.lit(False))
        for q in ("q25", "q50", "q75"):
            t = thresholds.get(c, {}).get(q)
            out[f"{c}_above_{q}"] = F.lit(False) if t is None else F.coalesce(x > F.lit(float(t)), F.lit(False))
    d = df.withColumns(out)
    return drop_columns(d, cols) if drop_originals else d

