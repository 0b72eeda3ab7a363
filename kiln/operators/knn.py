"""Exact k-nearest neighbours in blocks.

Donors are dealt to cells around sampled pivots, as many as the square root of
their number (at most ``MAX_CELLS``), found through a tree of two levels; small
neighbouring cells form a group, and crowded ones are cut, so that blocks hold a
bounded number of rows.  Queries are dealt by their nearest cell, so that a block
of queries is a place in space, too.  A query block and a donor block are scored
together as arrays (matrix products of at most ``PAIRS`` distances at a time), and
only each query's k best of the block leave the task, in the second round those
within its bound.

Two rounds keep the answer exact: the group of the nearest cell gives an upper
bound of the k-th distance; then only groups are visited that hold a cell whose
lower bound does not exceed it, cells of a top of the tree only where the top's
own bound allows.  The lower
bound of a cell is the distance to its bounding box, and for complete vectors
also the distance to its pivot less its radius (triangle inequality).  With
missing coordinates the box counts only those that all donors of the cell have,
which never overstates the nan-euclidean distance.

A round first knows its visits: the distinct triples (query block, group, donor
block) are a directory that is joined to the donors, so a donor is copied to the
blocks that visit it and to no other.  Before that, the queries that visit a donor
block are taken together up to a block's rows, so that there are no more copies of
donors than donors and visits.

Queries are answered in waves of neighbouring blocks, and what a wave writes is
deleted when its answers are written: the disk holds the donors, the queries, the
answers and one wave.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kiln.session import passing, settled, written

BLOCK, MAX_CELLS = 4096, 1 << 14
ROWS = 1024            # queries whose bounds are worked out together
PAIRS = 1 << 20         # distances, or bounds, held at once
WAVE = 1 << 20          # queries that are answered together, about
SENT = 1 << 13          # rows of a batch that leaves a task


def _matrix(column) -> np.ndarray:
    """A column of equally long lists as rows; null coordinates as NaN."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def _squares(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared nan-euclidean distances of all rows (plain euclidean without NaN); inf without a shared coordinate."""
    dims, hx, hy = x.shape[1], ~np.isnan(x), ~np.isnan(y)
    shared = hx.any(axis=0) & hy.any(axis=0)        # a coordinate that all rows of a side lack counts nowhere
    if not shared.all():
        x, y, hx, hy = x[:, shared], y[:, shared], hx[:, shared], hy[:, shared]
    if x.shape[1] and hx.all() and hy.all():
        s = (x @ y.T) * -2.0
        s += (x * x).sum(axis=1)[:, None]
        s += (y * y).sum(axis=1)
        np.maximum(s, 0, out=s)
        return s if x.shape[1] == dims else np.multiply(s, dims / x.shape[1], out=s)
    x0, y0 = np.where(hx, x, 0.0), np.where(hy, y, 0.0)
    s = (x0 * x0) @ hy.T + hx @ (y0 * y0).T - 2 * (x0 @ y0.T)
    p = hx.astype(float) @ hy.T.astype(float)
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(p > 0, np.maximum(s, 0) * dims / p, np.inf)


def _distance(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The same row by row, summed in coordinate order."""
    both = ~np.isnan(x) & ~np.isnan(y)
    d = np.where(both, x - y, 0.0)
    s = np.zeros(len(x))
    for i in range(x.shape[1]):
        s += d[:, i] * d[:, i]
    return np.sqrt(x.shape[1] / both.sum(axis=1) * s)


def _box_gap(x: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distances of all rows from all boxes, over the coordinates that a row has."""
    out = np.empty((len(x), len(low)))
    for c in range(len(low)):
        gap = np.fmax(np.fmax(low[c] - x, x - high[c]), 0.0)
        out[:, c] = np.nansum(gap * gap, axis=1)
    return out


@dataclass
class Level:
    """Balls and boxes around a set of pivots."""

    pivots: np.ndarray
    radius: np.ndarray          # inf where a donor lacks a coordinate
    low: np.ndarray             # box of the coordinates that all donors have, else -inf
    high: np.ndarray

    def bounds(self, x: np.ndarray, which: np.ndarray | slice = slice(None)) -> np.ndarray:
        """Lower bound of the distance from every row to every donor of the chosen pivots."""
        share = x.shape[1] / np.maximum((~np.isnan(x)).sum(axis=1), 1)
        out = np.sqrt(share[:, None] * _box_gap(x, self.low[which], self.high[which]))
        ball = np.sqrt(_squares(x, self.pivots[which])) * (1 - 1e-9) - 1e-9 - self.radius[which]
        complete = ~np.isnan(x).any(axis=1)[:, None] & np.isfinite(self.radius[which])
        return np.where(complete, np.fmax(out, ball), out) * (1 - 1e-12) - 1e-12


class Cells:
    """A tree of two levels over the pivots; its size is that of the cells, not of the donors."""

    def __init__(self, pivots: np.ndarray):
        self.pivots = pivots
        self.tops = pivots[:max(1, int(np.sqrt(len(pivots))))]
        self._group()

    def _group(self) -> None:
        of = _squares(self.pivots, self.tops).argmin(axis=1)
        self.members = [np.flatnonzero(of == t) for t in range(len(self.tops))]

    def nearest(self, x: np.ndarray) -> np.ndarray:
        """A near cell of every row: the nearest pivot below the nearest top."""
        top = _squares(x, self.tops).argmin(axis=1)
        out = np.empty(len(x), dtype=np.int64)
        for t in np.unique(top):
            rows, own = np.flatnonzero(top == t), self.members[t]
            out[rows] = own[_squares(x[rows], self.pivots[own]).argmin(axis=1)]
        return out

    def fill(self, stats: list, block: int) -> None:
        """Take up the donors' counts, distances and boxes; cells and tops without donors go."""
        stats = sorted(stats, key=lambda r: r["_cell"])
        used = np.array([r["_cell"] for r in stats], dtype=np.int64)
        n = np.array([r["n"] for r in stats], dtype=np.int64)
        whole = np.array([r["have"] for r in stats]) == n[:, None]
        low = np.where(whole, np.array([r["low"] for r in stats], dtype=float), -np.inf)
        high = np.where(whole, np.array([r["high"] for r in stats], dtype=float), np.inf)
        radius = np.where(whole.all(axis=1), np.array([r["far"] for r in stats]) * (1 + 1e-9), np.inf)
        self.number = np.full(len(self.pivots), -1)
        self.number[used] = np.arange(len(used))
        self.pivots = self.pivots[used]
        self.cells = Level(self.pivots, radius, low, high)
        self._group()
        self.tops = np.array([t for t, own in zip(self.tops, self.members, strict=True) if len(own)])
        self.members = [own for own in self.members if len(own)]
        self.group = self.packed(n, block)
        self.blocks = np.maximum(-(-np.bincount(self.group, n).astype(np.int64) // block), 1)[self.group]   # of its group, by cell
        reach = [(np.sqrt(_squares(self.tops[t:t + 1], self.pivots[own])[0]) * (1 + 1e-9) + 1e-9 + radius[own]).max()
                 for t, own in enumerate(self.members)]
        self.top = Level(self.tops, np.array(reach), np.array([low[own].min(axis=0) for own in self.members]),
                         np.array([high[own].max(axis=0) for own in self.members]))

    def packed(self, n: np.ndarray, block: int) -> np.ndarray:
        """A group of every cell: cells of one top together up to ``block`` of their ``n`` rows, crowded cells alone."""
        of, last = np.zeros(len(n), dtype=np.int64), -1
        for own in self.members:
            held = block
            for c in own:
                if held + n[c] > block:
                    held, last = 0, last + 1
                held += n[c]
                of[c] = last
        return of

    def within(self, x: np.ndarray, limit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, cell) of the cells that may hold a donor no farther than a row's limit."""
        rows, cells = [], []
        for first in range(0, len(x), ROWS):
            part, reach = x[first:first + ROWS], limit[first:first + ROWS]
            open_tops = self.top.bounds(part) <= reach[:, None]
            for t in np.flatnonzero(open_tops.any(axis=0)):
                own, at = self.members[t], np.flatnonzero(open_tops[:, t])
                row, cell = np.nonzero(self.cells.bounds(part[at], own) <= reach[at][:, None])
                rows.append(first + at[row])
                cells.append(own[cell])
        none = np.empty(0, dtype=np.int64)
        return np.concatenate([none, *rows]), np.concatenate([none, *cells])


def _near(x: np.ndarray, y: np.ndarray, s: np.ndarray, bound: np.ndarray, order_of: np.ndarray
          ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, column, distance) of all pairs whose squared distance ``s`` may not exceed the row's ``bound``; by row, distance
    and ``order_of`` the column."""
    # the product form rounds: keep all that may belong, then measure those exactly
    size = np.nansum(x * x, axis=1) + np.nansum(y * y, axis=1).max()
    row, col = np.nonzero((s <= (bound * (1 + 1e-9) + 1e-9 + 1e-13 * x.shape[1] * size)[:, None]) & np.isfinite(s))
    step = max(1, PAIRS // max(x.shape[1], 1))
    dist = np.concatenate([np.empty(0), *(_distance(x[row[i:i + step]], y[col[i:i + step]]) for i in range(0, len(row), step))])
    order = np.lexsort((order_of[col], dist, row))
    return row[order], col[order], dist[order]


def _kth(s: np.ndarray, k: int) -> np.ndarray:
    m = min(k, s.shape[1])
    return np.partition(s, m - 1, axis=1)[:, m - 1]


def _score(k: int, key: str, slot: str | None):
    """Each query's k nearest of a donor block, with their ``value`` of the slot; where queries have a limit ``_kth``, only
    those within."""
    def fn(left: pa.Table, right: pa.Table) -> pa.Table:
        schema = pa.schema([left.schema.field(key)] + ([pa.field(slot, pa.int32())] if slot else [])
                           + [right.schema.field("_dk"), ("dist", pa.float64())] + ([("value", pa.float64())] if slot else []))
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        # donors in the order of their keys, so that a place is a rank
        right = right.take(pc.sort_indices(right.column("_dk"), null_placement="at_start"))
        x, y = _matrix(left.column("_v")), _matrix(right.column("_v"))
        key_of, donor_of = left.column(key).combine_chunks(), right.column("_dk").combine_chunks()
        limit = left.column("_kth").to_numpy() if "_kth" in left.column_names else np.full(len(x), np.inf)
        places, have, found = np.arange(len(y)), ~np.isnan(y), []
        if slot:
            wanted = left.column(slot).combine_chunks()
            asks = np.zeros(x.shape, dtype=bool)
            asks[pc.list_parent_indices(wanted).to_numpy(), wanted.flatten().to_numpy()] = True

        def take(row, col, dist, j):
            own = np.arange(len(row)) - np.searchsorted(row, row) < k
            found.append((row[own], col[own], dist[own], np.full(own.sum(), j, dtype=np.int32)))

        step = max(1, PAIRS // len(y))
        for rows in (np.flatnonzero(np.isfinite(limit)), np.flatnonzero(~np.isfinite(limit))):
            for part in (rows[i:i + step] for i in range(0, len(rows), step)):
                s, known = _squares(x[part], y), np.isfinite(limit[part[0]])
                if known or not slot:
                    row, col, dist = _near(x[part], y, s, limit[part] ** 2 if known else _kth(s, k), places)
                if not slot:
                    take(part[row], col, dist, 0)
                    continue
                for j in np.flatnonzero(asks[part].any(axis=0)):
                    if known:
                        own = asks[part[row], j] & have[col, j]
                        take(part[row[own]], col[own], dist[own], j)
                    elif have[:, j].any():
                        some, of = part[asks[part, j]], np.flatnonzero(have[:, j])
                        own = s[np.ix_(asks[part, j], have[:, j])]
                        at, donor, far = _near(x[some], y[of], own, _kth(own, k), of)
                        take(some[at], of[donor], far, j)
        none = np.empty(0, dtype=np.int64)
        row, col, dist, j = (np.concatenate(c) for c in zip((none, none, none.astype(float), none), *found, strict=True))
        return pa.Table.from_arrays([key_of.take(pa.array(row))] + ([pa.array(j, pa.int32())] if slot else [])
                                    + [donor_of.take(pa.array(col)), pa.array(dist, pa.float64())]
                                    + ([pa.array(y[col, j], pa.float64())] if slot else []), schema=schema)
    return fn


def _numbers(values: np.ndarray) -> Column:
    """One literal array of whole numbers."""
    return F.split(F.lit(",".join(map(str, values.tolist()))), ",").cast("array<int>")


def _deal(donors: DataFrame, dims: int, cells: int, block: int, known: np.ndarray | None = None) -> tuple[DataFrame, Cells]:
    """Donors with their cell and block, and the tree of the cells, which lie apart in the ``known`` coordinates (all unless given)."""
    some = donors.orderBy(F.xxhash64("_dk")).limit(cells)               # pivots: at most ``cells`` rows
    pivots = _matrix(some.select("_v").toArrow().column("_v"))
    empty = np.isnan(pivots).all(axis=0)
    column_means = np.where(empty, 0.0, np.nanmean(np.where(empty, 0.0, pivots), axis=0))
    tree = Cells(np.where(np.isnan(pivots) | (False if known is None else ~known), column_means, pivots))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _matrix(b.column("_v"))
            cell = tree.nearest(x) if len(x) else np.empty(0, dtype=np.int64)
            with np.errstate(divide="ignore", invalid="ignore"):
                far = np.nan_to_num(_distance(x, tree.pivots[cell]))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell.astype(np.int32)), pa.array(far, pa.float64())],
                                             names=["_dk", "_v", "_cell", "_far"])

    kind = donors.schema["_dk"].dataType.simpleString()
    placed = written(donors.mapInArrow(assign, f"_dk {kind}, _v array<double>, _cell int, _far double"), "donors")
    v = [F.col("_v")[i] for i in range(dims)]
    stats = placed.groupBy("_cell").agg(
        F.count(F.lit(1)).alias("n"), F.max("_far").alias("far"),
        F.array(*[F.min(x) for x in v]).alias("low"), F.array(*[F.max(x) for x in v]).alias("high"),
        F.array(*[F.count(x) for x in v]).alias("have")).collect()      # one row per cell
    tree.fill(stats, block)
    blocks, groups = (F.element_at(_numbers(x[tree.number]), F.col("_cell") + 1) for x in (tree.blocks, tree.group))
    return placed.select("_dk", "_v", groups.alias("_cell"), F.pmod(F.xxhash64("_dk"), blocks).cast("int").alias("_block")), tree


def _map_queries(rows: DataFrame, fn, columns: dict[str, str]) -> DataFrame:
    """``fn(vectors, batch)`` yields the rows to take and further columns."""
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own = b.select(list(kinds))
            for row, *more in fn(_matrix(b.column("_v")), b) if b.num_rows else ():
                for at in range(0, len(row), SENT):
                    part = own.take(pa.array(row[at:at + SENT]))
                    yield pa.RecordBatch.from_arrays([*part.columns, *[pa.array(x[at:at + SENT], pa.int32()) for x in more]],
                                                     names=[*kinds, *columns])
    return rows.mapInArrow(run, ", ".join(f"`{c}` {t}" for c, t in (kinds | columns).items()))


def _visits(q: DataFrame, tree: Cells) -> DataFrame:
    """A row per query and donor block to visit: those of its near cell's group, or with a limit ``_kth`` all others that
    may hold a nearer donor."""
    first = "_kth" not in q.columns
    groups = int(tree.group.max()) + 1
    blocks = np.ones(groups, dtype=np.int64)
    blocks[tree.group] = tree.blocks
    step = max(1, min(ROWS, PAIRS // len(tree.group)))

    def fn(x: np.ndarray, b: pa.RecordBatch):
        near = tree.group[b.column("_near").to_numpy()]
        for at in range(0, len(x), step):
            if first:
                row, group = np.arange(at, min(at + step, len(x))), near[at:at + step]
            else:
                row, cell = tree.within(x[at:at + step], b.column("_kth").to_numpy(zero_copy_only=False)[at:at + step])
                row, group = np.divmod(np.unique((at + row) * groups + tree.group[cell]), groups)
                other = group != near[row]
                row, group = row[other], group[other]
            n = blocks[group]
            block = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            yield np.repeat(row, n), np.repeat(group, n), block
    return _map_queries(q, fn, {"_cell": "int", "_block": "int"})


TRIPLE = ["_qb", "_part", "_cell", "_block"]        # the first two name the query block


def visited_donors(placed: DataFrame, visits: DataFrame) -> DataFrame:
    """Donors copied to the query blocks that visit their block."""
    directory = visits.select(*[F.col(c).alias(c) for c in TRIPLE]).distinct()      # columns of their own
    return placed.join(F.broadcast(directory), ["_cell", "_block"])     # a row per donor block, and per block's rows of visits


def shared_blocks(visits: DataFrame, key: str, tree: Cells, block: int) -> DataFrame:
    """Visits with other query blocks: all that visit a donor block together up to ``block`` rows, about."""
    blocks = np.ones(int(tree.group.max()) + 1, dtype=np.int64)
    blocks[tree.group] = tree.blocks
    first = np.cumsum(blocks) - blocks
    n = np.zeros(blocks.sum(), dtype=np.int64)
    for r in visits.groupBy("_cell", "_block").agg(F.count(F.lit(1)).alias("n")).collect():       # one row per donor block
        n[first[r["_cell"]] + r["_block"]] = r["n"]
    at = F.element_at(_numbers(first), F.col("_cell") + 1) + F.col("_block")
    parts = F.element_at(_numbers(np.maximum(-(-n // block), 1)), at + 1)
    return visits.withColumn("_qb", F.lit(0)).withColumn("_part", F.pmod(F.xxhash64(key, "_v"), parts).cast("int"))


def deal_queries(queries: DataFrame, qk: Sequence[str], vec: str, tree: Cells, block: int, wave: int = 0) -> DataFrame:
    """Queries with their near cell and query block: cells of one top together up to ``block`` rows, crowded cells in parts.
    With ``wave``, query blocks are numbered off in waves of about so many rows."""
    q = queries.select(*qk, F.col(vec).cast("array<double>").alias("_v"))
    q = written(_map_queries(q, lambda x, b: [(np.arange(len(x)), tree.nearest(x))], {"_near": "int"}), "queries")
    n = np.zeros(len(tree.blocks), dtype=np.int64)
    for r in q.groupBy("_near").agg(F.count(F.lit(1)).alias("n")).collect():       # one row per cell
        n[r["_near"]] = r["n"]
    of, near = tree.packed(n, block), F.col("_near") + 1
    parts = np.maximum(-(-n // block), 1)
    q = q.withColumn("_qb", F.element_at(_numbers(of), near)).withColumn(
        "_part", F.pmod(F.xxhash64(*qk), F.element_at(_numbers(parts), near)).cast("int"))
    if not wave:
        return q
    inside = np.ones(max(int(of.max()) + 1, 1), dtype=np.int64)        # query blocks by group
    np.maximum.at(inside, of, parts)
    place = F.element_at(_numbers((np.cumsum(inside) - inside)[of]), near) + F.col("_part")
    held = max(1, wave // block)
    q = q.withColumn("_wave", F.floor(place / held).cast("int"))
    if inside.sum() <= held:
        return q
    # rows of one key are answered together
    return written(q.withColumn("_wave", F.min("_wave").over(Window.partitionBy(qk[0]))), "queries")


def _asked(queries: DataFrame, vec: str, slot: str | None, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Which coordinates some query has, and which some query wants."""
    has = [F.max(F.get(vec, F.lit(i)).isNotNull()) for i in range(dims)]
    wants = [F.max(F.array_contains(F.col(slot).cast("array<int>"), i)) for i in range(dims)] if slot else []
    row = list(queries.agg(*[c.alias(f"c{i}") for i, c in enumerate([*has, *wants])]).first())
    known, wanted = (np.array([bool(v) for v in part], dtype=bool) for part in (row[:dims], row[dims:]))
    return known if known.any() else np.ones(dims, dtype=bool), wanted


def neighbours(queries: DataFrame, donors: DataFrame, qkey: str, dkey: str, vec: str, k: int,
               slot: str | None = None, cells: int | None = None, block: int = BLOCK,
               then: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> DataFrame:
    """Rows (qkey[, slot], dkey, dist, rank[, value]) of the k nearest donors per query.

    ``slot`` is an array of coordinates: for each of them a query has k nearest of
    its own, among the donors that have that coordinate, and ``value`` is theirs.
    Distances are nan-euclidean; ties go to the smaller donor key.  ``cells`` is the
    square root of the donors unless given.  ``then`` is what is made of the rows of
    some queries before they are written."""
    with passing(queries.sparkSession) as keep:
        return _neighbours(queries, donors, qkey, dkey, vec, k, slot, cells, block, then, keep)


def _neighbours(queries, donors, qkey, dkey, vec, k, slot, cells, block, then, keep) -> DataFrame:
    qk = [qkey] + ([slot] if slot else [])
    columns = [*qk, F.col("_dk").alias(dkey), "dist", "rank", *(["value"] if slot else [])]
    d = donors.select(F.col(dkey).alias("_dk"), F.col(vec).cast("array<double>").alias("_v"))
    size = d.agg(F.max(F.size("_v")).alias("dims"), F.count(F.lit(1)).alias("n")).first()
    dims, n = int(size["dims"] or 0), size["n"]
    # coordinates that no query has count in no distance, and donors without any wanted one are nobody's
    known, wanted = _asked(queries, vec, slot, dims) if dims > 0 else (None, np.zeros(0, dtype=bool))
    if wanted.any() and not wanted.all():
        d = d.filter(F.exists(_numbers(np.flatnonzero(wanted)), lambda j: F.get("_v", j).isNotNull()))
        n = d.count()
    if slot:
        queries = queries.withColumn(slot, F.col(slot).cast("array<int>"))
    none = (queries.withColumn(slot, F.explode(slot)) if slot else queries).select(
        *qk, F.lit(None).cast(donors.schema[dkey].dataType).alias("_dk"), F.lit(0.0).alias("dist"), F.lit(0).alias("rank"),
        F.lit(0.0).alias("value")).select(*columns).limit(0)
    if dims <= 0 or not n:
        return then(none)
    placed, tree = _deal(d, dims, cells or min(MAX_CELLS, int(np.ceil(np.sqrt(n)))), block, known)
    q = deal_queries(queries, qk, vec, tree, block, WAVE)
    kind, key_kind = placed.schema["_dk"].dataType.simpleString(), q.schema[qkey].dataType.simpleString()
    ddl = f"`{qkey}` {key_kind}, " + (f"`{slot}` int, " if slot else "") + f"_dk {kind}, dist double" + (", value double" if slot else "")

    def scored(rows: DataFrame) -> DataFrame:
        v = shared_blocks(written(_visits(rows, tree), "visits"), qkey, tree, block)
        return v.groupBy(*TRIPLE).cogroup(visited_donors(placed, v).groupBy(*TRIPLE)).applyInArrow(_score(k, qkey, slot), ddl)

    def best(rows: DataFrame) -> DataFrame:
        w = Window.partitionBy(*qk).orderBy("dist", "_dk")
        return rows.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)

    def answered(q: DataFrame) -> DataFrame:
        one = written(best(scored(q)).drop("rank"), "round-one")
        kth, far = one.groupBy(*qk).agg(F.when(F.count(F.lit(1)) >= k, F.max("dist")).alias("_kth")), F.lit(float("inf"))
        if slot:        # a query's limit is that of its farthest coordinate
            kth = kth.filter("_kth IS NOT NULL").groupBy(qkey).agg(F.map_from_entries(F.collect_list(F.struct(slot, "_kth"))).alias("_of"))
            limit = F.array_max(F.transform(slot, lambda j: F.coalesce(F.try_element_at("_of", j), far)))
            rest = q.join(kth, qkey, "left").withColumn("_kth", F.coalesce(limit, far)).drop("_of")
        else:
            rest = q.join(kth, qkey, "left").withColumn("_kth", F.coalesce("_kth", far))
        return then(best(one.unionByName(scored(rest))).select(*columns))

    waves = q.agg(F.max("_wave")).first()[0]
    if waves is None:
        return then(none)
    found = [keep(settled(q.sparkSession, lambda i=i: answered(q.filter(F.col("_wave") == i).drop("_wave")), "neighbours"))
             for i in range(waves + 1)]
    return reduce(DataFrame.unionByName, found)


# M6 -------------------------------------------------------------------------
def knn_predict(train: DataFrame, test: DataFrame, key: str, vec: str, label: str, k: int = 5,
                regression: bool = False, weights: str = "uniform") -> DataFrame:
    """Vote (smallest label on ties) or mean of the k nearest.  ``weights`` is
    ``uniform`` or ``distance`` (1 / distance; donors at distance zero alone count if there are any)."""
    nb = neighbours(test, train.withColumnRenamed(key, "_donor"), key, "_donor", vec, k)
    j = nb.join(train.select(F.col(key).alias("_donor"), F.col(label).alias("_y")), "_donor")
    w: Column = F.lit(1.0)
    if weights == "distance":
        least = j.groupBy(key).agg(F.min("dist").alias("_least"))
        j = j.join(least, key)
        w = F.when(F.col("_least") == 0, (F.col("dist") == 0).cast("double")).otherwise(F.try_divide(F.lit(1.0), "dist"))
    j = j.withColumn("_w", w)
    if regression:
        return j.groupBy(key).agg((F.sum(F.col("_w") * F.col("_y")) / F.sum("_w")).alias("prediction"))
    votes = j.groupBy(key, "_y").agg(F.sum("_w").alias("_v"))
    return votes.groupBy(key).agg(F.min_by("_y", F.struct(-F.col("_v"), F.col("_y"))).alias("prediction"))


# F6 -------------------------------------------------------------------------
def impute_slots(train: DataFrame, data: DataFrame, key: str, vec: str, k: int = 9,
                 cells: int | None = None, block: int = BLOCK) -> DataFrame:
    """(key, j, value) for every missing coordinate: mean over the k nearest
    donors having coordinate j, or the train mean of j without donors."""
    dims = train.select(F.max(F.size(vec))).first()[0]
    means = train.agg(*[F.avg(F.col(vec)[i]).alias(f"m{i}") for i in range(dims)]).first()
    mean_arr = F.array(*[F.lit(means[f"m{i}"]).cast("double") for i in range(dims)])
    lacking = data.select(key, vec, F.filter(F.sequence(F.lit(0), F.lit(dims - 1)), lambda i: F.col(vec)[i].isNull()).alias("_j"))
    miss = lacking.select(key, F.explode("_j").alias("_j"))
    donors = train.select(F.col(key).alias("_donor"), vec)
    repeated = donors.filter("_donor IS NOT NULL").groupBy("_donor").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("_donor")
    of_key = None
    if not repeated.isEmpty():
        of_key = donors.join(repeated, "_donor").select("_donor", F.posexplode(vec).alias("_j", "_y")).groupBy("_donor", "_j").agg(
            F.sum("_y").alias("_sum"), F.count("_y").alias("_n"))

    def averaged(nb: DataFrame) -> DataFrame:
        value, n = F.col("value"), F.lit(1)
        if of_key is not None:      # a neighbour counts with all rows of its key
            nb, value, n = nb.join(of_key, ["_donor", "_j"], "left"), F.coalesce("_sum", "value"), F.coalesce("_n", F.lit(1))
        own = F.col("_donor").isNotNull()
        return nb.groupBy(key, "_j").agg((F.sum(F.when(own, value)) / F.sum(F.when(own, n))).alias("value"))

    filled = neighbours(lacking.filter(F.size("_j") > 0), donors, key, "_donor", vec, k, slot="_j", cells=cells, block=block, then=averaged)
    out = miss.select(key, "_j").join(filled, [key, "_j"], "left")
    return out.select(key, F.col("_j").alias("j"),
                      F.coalesce("value", F.element_at(mean_arr, (F.col("_j") + 1).cast("int"))).alias("value"))
