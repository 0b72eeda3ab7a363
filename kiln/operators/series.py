"""Ordered-series machinery that never funnels one series key into one task.

Every time-series operator in this package works on rows identified by a series
key and an order column.  A naive ``Window.partitionBy(key).orderBy(ts)`` puts a
whole key into one task, which fails when one key holds a large share of the
data.  Instead:

* ``sequence`` numbers the rows of each key (``_seq``, 1-based).  It first
  measures rows per key; when every key fits one block it uses a plain per-key
  window and tags ``_seq`` (column metadata) so the operators below skip halos
  and carries.  Otherwise the rows are range-partitioned by key and order (Spark
  samples the splitters, so parts are even whatever the type or spread of the
  order columns), written once, numbered inside (key, part), and the counts per
  (key, part) are prefix-summed on a small table.  Null keys are a key like any
  other and null order values come first on either path.
* ``blocked`` cuts each key into blocks of ``block_rows`` consecutive rows and
  copies the few rows a bounded window needs from the neighbouring block
  (halo rows).  Windows then partition by (key, block), so the work spreads over
  many tasks and the result is exact for frames up to the halo size.
* ``scan_*`` give unbounded (running) frames: a block-local window plus a carry
  from a small per-block table.  ``ewm`` does the same for the exponential
  recursion y_t = (1-a) y_{t-1} + a x_t: an array scan inside a run of rows, and
  affine maps, which compose, over the runs.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kiln.session import written

SEQ = "_seq"   # 1-based row position inside the series key
CNT = "_n"     # number of rows of the series key
BLK = "_blk"   # block id inside the series key
HALO = "_halo"  # row copied from a neighbouring block

DEFAULT_BLOCK_ROWS = 1 << 20
MAX_PARTS = 100_000     # beyond it parts hold more rows


def _conf_int(spark, key: str, default: int) -> int:
    try:
        return int(spark.conf.get(key, str(default)))
    except Exception:  # pragma: no cover - conf access on a stopped session
        return default


def block_rows(spark) -> int:
    return _conf_int(spark, "kiln.series.blockRows", DEFAULT_BLOCK_ROWS)


def key_stats(df: DataFrame, keys: Sequence[str]) -> tuple[int, int, bool]:
    """(rows, rows of the largest key, any null in a key): one aggregate, one row."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_c"))
    null = F.lit(False)
    for k in keys:
        null = null | F.col(k).isNull()
    r = per_key.agg(F.sum("_c").alias("n"), F.max("_c").alias("m"), F.max(null).alias("z")).first()
    return int(r["n"] or 0), int(r["m"] or 0), bool(r["z"])


def _tag(col: Column, single: bool, size: int, null_keys: bool, most: int) -> Column:
    return col.alias(SEQ, metadata={"kiln_single_block": single, "kiln_block_rows": size, "kiln_null_keys": null_keys,
                                    "kiln_most_rows": most})


def _noted(df: DataFrame, name: str, default: bool) -> bool:
    try:
        return bool(df.schema[SEQ].metadata.get(name, default))
    except (KeyError, IndexError):
        return default


def _noted_rows(df: DataFrame) -> int | None:
    """Rows of the largest key as ``sequence`` measured them."""
    try:
        return int(df.schema[SEQ].metadata["kiln_most_rows"])
    except (KeyError, IndexError):
        return None


def single_block(df: DataFrame) -> bool:
    """True when ``sequence`` measured every key to fit one block."""
    return _noted(df, "kiln_single_block", False)


def keyed_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str, null_keys: bool) -> DataFrame:
    """Equi-join on ``keys``; where some are null, they match each other."""
    if not null_keys:
        return left.join(right, list(keys), how)
    other = right.withColumnsRenamed({k: f"__{k}" for k in keys})
    on = F.lit(True)
    for k in keys:
        on = on & left[k].eqNullSafe(other[f"__{k}"])
    return left.join(other, on, how).drop(*[f"__{k}" for k in keys])


def sequence(df: DataFrame, keys: Sequence[str], order: Sequence[str],
             target_rows: int | None = None) -> DataFrame:
    """Add ``_seq`` (1-based position of the row in its key, by ``order``) and ``_n``.

    ``order`` must be unique inside a key (add a tie-break column otherwise); its
    nulls come first.  One small aggregate measures the keys first.  When every
    key holds at most ``target_rows`` rows, each key is one block: a plain window
    numbers the rows and ``_seq`` is tagged so later operators use one task per
    key.  Otherwise the rows are dealt by range of (key, order) into parts of
    about ``target_rows``; a hot key spreads over many of them.  The dealt rows
    are written to the shared folder, so that part numbers stay what they are
    when a task runs again.
    """
    keys, order = list(keys), list(order)
    target = target_rows or block_rows(df.sparkSession)
    total, biggest, null_keys = key_stats(df, keys)
    if biggest <= target:
        w = Window.partitionBy(*keys).orderBy(*order)
        whole = Window.partitionBy(*keys)
        return (df.withColumn(SEQ, _tag(F.row_number().over(w).cast("long"), True, target, null_keys, biggest))
                  .withColumn(CNT, F.count(F.lit(1)).over(whole).cast("long")))
    parts = min(-(-total // target), MAX_PARTS)
    d = written(df.repartitionByRange(parts, *keys, *order).withColumn("_part", F.spark_partition_id()), "sequenced")
    # one row per (key, part): prefix sums give each part's offset
    cnt = d.groupBy(*keys, "_part").agg(F.count(F.lit(1)).alias("_c"))
    whole = Window.partitionBy(*keys)
    before = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    off = cnt.select(*keys, "_part", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_off"),
                     F.sum("_c").over(whole).cast("long").alias(CNT))
    d = keyed_join(d, off, [*keys, "_part"], "inner", null_keys)
    w = Window.partitionBy(*keys, "_part").orderBy(*order)
    return (d.withColumn(SEQ, _tag((F.row_number().over(w) + F.col("_off")).cast("long"), False, target, null_keys, biggest))
             .drop("_part", "_off"))


def blocked(df: DataFrame, before: int = 0, after: int = 0, size: int | None = None) -> DataFrame:
    """Assign ``_blk`` and add halo copies of neighbour rows (``_halo`` true)."""
    if single_block(df):
        return df.withColumn(BLK, F.lit(0).cast("long")).withColumn(HALO, F.lit(False))
    size = size or block_rows(df.sparkSession)
    idx = F.col(SEQ) - 1
    blk = F.floor(idx / F.lit(size)).cast("long")
    if not (before or after):
        return df.withColumn(BLK, blk).withColumn(HALO, F.lit(False))
    # a row is also wanted by the blocks that look back or ahead to it, however many they are
    first = F.floor(F.greatest(idx - after, F.lit(0)) / F.lit(size)).cast("long")
    last = F.floor((idx + before) / F.lit(size)).cast("long")      # past the last block: halo rows only, dropped
    return (df.withColumn("_own", blk).withColumn(BLK, F.explode(F.sequence(first, last)))
              .withColumn(HALO, F.col(BLK) != F.col("_own")).drop("_own"))


def block_window(keys: Sequence[str]) -> Window:
    return Window.partitionBy(*keys, BLK).orderBy(SEQ)


def rolling(df: DataFrame, keys: Sequence[str],
            build: Callable[[Window], dict[str, Column]],
            before: int = 0, after: int = 0) -> DataFrame:
    """Evaluate row-frame window expressions reaching at most ``before`` rows back
    and ``after`` rows ahead.  ``build`` gets the (key, block) ordered window."""
    b = blocked(df, before, after)
    cols = build(block_window(keys))
    return b.withColumns(cols).filter(~F.col(HALO)).drop(HALO, BLK)


# ---------------------------------------------------------------- running frames

def _carry_join(local: DataFrame, carry: DataFrame, keys: Sequence[str]) -> DataFrame:
    # ``local`` is hash partitioned on (keys, _blk) by the block window, so only the
    # small carry table moves.
    return keyed_join(local, carry, [*keys, BLK], "left", _noted(local, "kiln_null_keys", True))


def scan_fill(df: DataFrame, keys: Sequence[str], cols: dict[str, str],
              backward: bool = False) -> DataFrame:
    """Forward (or backward) fill: ``cols`` maps output -> input column."""
    b = blocked(df)
    w = block_window(keys)
    if backward:
        w = w.rowsBetween(0, Window.unboundedFollowing)
        loc = {f"{o}__loc": F.first(i, ignorenulls=True).over(w) for o, i in cols.items()}
        edge = {f"{o}__edge": F.min_by(F.col(i), F.when(F.col(i).isNotNull(), F.col(SEQ)))
                for o, i in cols.items()}
    else:
        w = w.rowsBetween(Window.unboundedPreceding, 0)
        loc = {f"{o}__loc": F.last(i, ignorenulls=True).over(w) for o, i in cols.items()}
        edge = {f"{o}__edge": F.max_by(F.col(i), F.when(F.col(i).isNotNull(), F.col(SEQ)))
                for o, i in cols.items()}
    if single_block(df):
        return b.withColumns({o: loc[f"{o}__loc"] for o in cols}).drop(BLK, HALO)
    local = b.withColumns(loc)
    blocks = local.groupBy(*keys, BLK).agg(*[v.alias(k) for k, v in edge.items()])
    if backward:
        bw = Window.partitionBy(*keys).orderBy(F.col(BLK).desc()).rowsBetween(Window.unboundedPreceding, -1)
        # frame runs from the last block down to the next one: the nearest is last
        carry = blocks.select(*keys, BLK, *[F.last(f"{o}__edge", ignorenulls=True).over(bw).alias(f"{o}__carry")
                                            for o in cols])
    else:
        bw = Window.partitionBy(*keys).orderBy(BLK).rowsBetween(Window.unboundedPreceding, -1)
        carry = blocks.select(*keys, BLK, *[F.last(f"{o}__edge", ignorenulls=True).over(bw).alias(f"{o}__carry")
                                            for o in cols])
    out = _carry_join(local, carry, keys)
    out = out.withColumns({o: F.coalesce(F.col(f"{o}__loc"), F.col(f"{o}__carry")) for o in cols})
    return out.drop(*[f"{o}__loc" for o in cols], *[f"{o}__carry" for o in cols], BLK, HALO)


def scan_sum(df: DataFrame, keys: Sequence[str], cols: dict[str, Column]) -> DataFrame:
    """Running sum from the first row of the key; nulls count as 0."""
    b = blocked(df).withColumns({f"{o}__x": F.coalesce(e, F.lit(0.0)) for o, e in cols.items()})
    w = block_window(keys).rowsBetween(Window.unboundedPreceding, 0)
    local = b.withColumns({f"{o}__loc": F.sum(f"{o}__x").over(w) for o in cols})
    if single_block(df):
        return local.withColumns({o: F.col(f"{o}__loc") for o in cols}) \
            .drop(*[f"{o}__{s_}" for o in cols for s_ in ("x", "loc")], BLK, HALO)
    blocks = local.groupBy(*keys, BLK).agg(*[F.sum(f"{o}__x").alias(f"{o}__tot") for o in cols])
    bw = Window.partitionBy(*keys).orderBy(BLK).rowsBetween(Window.unboundedPreceding, -1)
    carry = blocks.select(*keys, BLK, *[F.coalesce(F.sum(f"{o}__tot").over(bw), F.lit(0.0)).alias(f"{o}__carry")
                                        for o in cols])
    out = _carry_join(local, carry, keys)
    out = out.withColumns({o: F.col(f"{o}__loc") + F.col(f"{o}__carry") for o in cols})
    return out.drop(*[f"{o}__{s}" for o in cols for s in ("x", "loc", "carry")], BLK, HALO)


# ------------------------------------------------------------------------- EWMA

RUN_ROWS = 1 << 14      # rows of a key that one array holds
SCAN_CHUNK = 64         # of these, rows that one inner scan appends to
SCAN_WIDTH = 256        # maps that one array scan composes


def _composed(a: Column, b: Column) -> Column:
    """The affine map of ``b`` after ``a``: (factor, offset, first value that either has seen)."""
    return F.struct((a["f"] * b["f"]).alias("f"), (b["g"] + b["f"] * a["g"]).alias("g"), F.coalesce(a["l"], b["l"]).alias("l"))


def _affine_prefix(runs: DataFrame, keys: Sequence[str], outs: int, levels: int, null_keys: bool) -> DataFrame:
    """(keys, at, m): the maps of all runs of the key before run ``at`` as one, per output.

    Up to ``SCAN_WIDTH`` consecutive runs are composed as one array; the maps of
    those groups are scanned the same way, one level up."""
    keys = list(keys)
    kind = "array<struct<f:double,g:double,l:double>>"
    unit = F.array(*[F.struct(F.lit(1.0).alias("f"), F.lit(0.0).alias("g"), F.lit(None).cast("double").alias("l"))] * outs).cast(kind)
    both = lambda a, b: F.zip_with(a, b, _composed)
    start = F.struct(F.array().cast(f"array<struct<at:bigint,m:{kind}>>").alias("done"), unit.alias("m"))
    step = lambda acc, x: F.struct(F.concat(acc["done"], F.array(F.struct(x["at"].alias("at"), acc["m"].alias("m")))).alias("done"),
                                   both(acc["m"], x["m"]).alias("m"))
    groups = runs.withColumn("_up", F.floor(F.col("at") / F.lit(SCAN_WIDTH)).cast("long")).groupBy(*keys, "_up").agg(
        F.sort_array(F.collect_list(F.struct("at", "m"))).alias("_own"))
    groups = groups.select(*keys, "_up", F.aggregate("_own", start, step).alias("_scan"))
    if levels > 1:
        above = _affine_prefix(groups.select(*keys, F.col("_up").alias("at"), F.col("_scan.m").alias("m")), keys, outs, levels - 1,
                               null_keys).withColumnsRenamed({"at": "_up", "m": "_before"})
        groups = keyed_join(groups, above, [*keys, "_up"], "inner", null_keys)
    else:
        groups = groups.withColumn("_before", unit)
    each = groups.select(*keys, "_before", F.explode("_scan.done").alias("_x"))
    return each.select(*keys, F.col("_x.at").alias("at"), both(F.col("_before"), F.col("_x.m")).alias("m"))


def _scanned(rows: Column, alphas: Sequence[float]) -> Column:
    """Array of (y, n) per row of ``rows`` in order: averages that start at the first value, and values seen, per input.

    The scan is an aggregate over chunks of an aggregate over rows, so that appending
    a result copies a chunk and not the whole array."""
    kind = "array<struct<y:array<double>,n:array<bigint>>>"
    start = F.struct(F.array(*[F.lit(None).cast("double")] * len(alphas)).alias("y"), F.array(*[F.lit(0).cast("long")] * len(alphas)).alias("n"))

    def next_state(state: Column, x: Column) -> Column:
        y = [F.when(x[i].isNull(), state["y"][i]).when(state["y"][i].isNull(), x[i]).otherwise(
            F.lit(1.0 - a) * state["y"][i] + F.lit(a) * x[i]) for i, a in enumerate(alphas)]
        n = [state["n"][i] + x[i].isNotNull().cast("long") for i in range(len(alphas))]
        return F.struct(F.array(*y).alias("y"), F.array(*n).alias("n"))

    def row(acc: Column, x: Column) -> Column:
        return F.struct(acc["now"].alias("now"), acc["done"].alias("done"), next_state(acc["now"], x["x"]).alias("new"))

    def chunk(acc: Column, own: Column) -> Column:
        inner = F.aggregate(own, F.struct(acc["now"].alias("now"), F.array().cast(kind).alias("done")),
                            lambda a, e: _appended(row(a, e)))
        return F.struct(inner["now"].alias("now"), F.concat(acc["done"], F.array(inner["done"])).alias("done"))

    chunks = F.transform(F.sequence(F.lit(0), F.floor((F.size(rows) - 1) / SCAN_CHUNK).cast("int")),
                         lambda i: F.slice(rows, i * SCAN_CHUNK + 1, SCAN_CHUNK))
    return F.flatten(F.aggregate(chunks, F.struct(start.alias("now"), F.array().cast(f"array<{kind}>").alias("done")), chunk)["done"])


def _appended(acc: Column) -> Column:
    return F.struct(acc["new"].alias("now"), F.concat(acc["done"], F.array(acc["new"])).alias("done"))


def ewm(df: DataFrame, keys: Sequence[str], specs: dict[str, tuple[str, float]]) -> DataFrame:
    """Exponential moving average, ``adjust=False``: y_0 = x_0, y_t = (1-a) y_{t-1} + a x_t.

    ``specs`` maps output column -> (input column, alpha).  Null and NaN inputs
    hold the previous value; rows before the first value are null.

    A run of ``RUN_ROWS`` rows of a key is scanned as one array, row by row, so a
    key that fits one run has the very values of the recursion.  A run as a whole
    is an affine map of the value before it; where a key is longer, these maps are
    composed by array scans and joined back, one small row per run.
    """
    keys, outs = list(keys), list(specs)
    alphas = [a for _, a in specs.values()]
    most, null_keys = _noted_rows(df), _noted(df, "kiln_null_keys", True)
    others = [F.col(f"`{c}`") for c in df.columns if c not in (*keys, SEQ)]
    x = F.array(*[F.nanvl(F.col(c).cast("double"), F.lit(None)) for c, _ in specs.values()])
    rows = df.select(*keys, F.floor((F.col(SEQ) - 1) / F.lit(RUN_ROWS)).cast("long").alias("_run"),
                     F.struct(F.col(SEQ), x.alias("x"), F.struct(F.lit(0).alias("_"), *others).alias("row")).alias("_e"))
    runs = rows.groupBy(*keys, "_run").agg(F.sort_array(F.collect_list("_e")).alias("_rows"))
    runs = runs.withColumn("_y", _scanned(F.col("_rows"), alphas))
    if most is None or most > RUN_ROWS:
        def first(i: int) -> Column:
            return F.get(F.filter("_rows", lambda e: e["x"][i].isNotNull()), 0)["x"][i]
        runs = runs.withColumn("_first", F.array(*map(first, range(len(outs)))))
        end = F.element_at("_y", -1)
        powers = [F.pow(F.lit(1.0 - a), end["n"][i]) for i, a in enumerate(alphas)]
        maps = runs.select(*keys, F.col("_run").alias("at"), F.array(*[
            F.struct(f.alias("f"), F.coalesce(end["y"][i] - f * F.col("_first")[i], F.lit(0.0)).alias("g"), F.col("_first")[i].alias("l"))
            for i, f in enumerate(powers)]).alias("m"))
        levels = 3 if most is None else max(1, math.ceil(math.log(max(2, most / RUN_ROWS), SCAN_WIDTH)))
        carry = _affine_prefix(maps, keys, len(outs), levels, null_keys).withColumnsRenamed({"at": "_run", "m": "_carry"})
        runs = keyed_join(runs, carry, [*keys, "_run"], "left", null_keys)
        before = [m["g"] + m["f"] * m["l"] for m in (F.col("_carry")[i] for i in range(len(outs)))]
    else:
        before = None
    each = runs.select(*keys, *([F.array(*before).alias("_before"), "_first"] if before else []),
                       F.explode(F.arrays_zip("_rows", "_y")).alias("_z"))

    def value(i: int, a: float) -> Column:
        y, n = F.col("_z._y.y")[i], F.col("_z._y.n")[i]
        if not before:
            return y
        since = F.col("_before")[i]
        # y starts at the run's first value instead of the one before the run
        return F.when(since.isNull(), y).when(n == 0, since).otherwise(y + F.pow(F.lit(1.0 - a), n) * (since - F.col("_first")[i]))

    columns = {c: F.col(f"_z._rows.row.`{c}`").alias(c, metadata=df.schema[c].metadata) for c in df.columns if c not in (*keys, SEQ)}
    columns[SEQ] = F.col(f"_z._rows.{SEQ}").alias(SEQ, metadata=df.schema[SEQ].metadata)
    return each.select(*[F.col(c) if c in keys else columns[c] for c in df.columns if c not in outs],
                       *[value(i, a).alias(o) for i, (o, (_, a)) in enumerate(specs.items())])
