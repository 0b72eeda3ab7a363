"""Best-fit packing of documents into token sequences, by large-item matching.

The lengths of all pieces are counted into a histogram of at most ``capacity``
entries; the packing is worked out on that histogram in bulk (no document
reaches the driver) and each piece finds its place by its rank among the pieces
of its length.  Pieces above a third of the capacity meet at most pairwise: the
largest is matched with the largest that fits.  Smaller pieces, largest first,
go to the tightest gap that holds them and open a sequence only where none does.

Defined results: a null text counts as empty (its end token only); a text of
more tokens than the capacity is cut into full pieces, the first one taking the
remainder; repeated rows are packed as often as they occur; an empty table gives
no rows; further columns of the input are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass
from random import getrandbits

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kiln.llm.bpe import encoded
from kiln.llm.common import map_texts, written

RANKED = 8_000          # pieces per part: at most so many of one length are numbered by one window, about


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` tokens: full ones, the remainder first."""
    first = (n - 1) % capacity + 1
    return [(0, first), *((s, capacity) for s in range(first, n, capacity))]


def pieces(docs: DataFrame, path: str, capacity: int, end_id: int, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """One row per piece, with a random ``salt`` that spreads and orders equal rows; write before use."""

    def run(texts: list[str]) -> dict:
        out: dict[str, list] = {c: [] for c in ("at", "piece", "start", "length", "ids_crc32", "salt")}
        for at, raw in enumerate(encoded(texts, path)):
            raw += end_id.to_bytes(4, "little")
            for k, (start, n) in enumerate(cut(len(raw) // 4, capacity)):
                row = (at, k, start, n, zlib.crc32(raw[4 * start:4 * (start + n)]), getrandbits(40))
                for column, value in zip(out.values(), row, strict=True):
                    column.append(value)
        return out

    return map_texts(docs, text_col, {"id": id_col}, {"piece": "int", "start": "long", "length": "long",
                                                      "ids_crc32": "long", "salt": "long"}, run)


@dataclass
class Plan:
    """Places by (length, rank): rank r from ``since`` on sits in ``base + (r - since) // per``."""

    length: np.ndarray
    since: np.ndarray
    base: np.ndarray
    per: np.ndarray
    offset: np.ndarray
    sequences: int

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        k = np.searchsorted(self.length << 44 | self.since, length << 44 | rank, side="right") - 1
        j = rank - self.since[k]
        return self.base[k] + j // self.per[k], self.offset[k] + j % self.per[k] * length


def plan(histogram: dict[int, int], capacity: int) -> Plan:
    """Pack counted lengths; groups of sequences filled alike are handled as one."""
    left = {n: c for n, c in histogram.items() if c > 0}
    done = dict.fromkeys(left, 0)
    rows: list[tuple[int, int, int, int, int]] = []
    open_groups: dict[int, list[tuple[int, int]]] = {}      # gap -> (first sequence, sequences)
    gaps: list[int] = []
    sequences = 0

    def put(n: int, count: int, base: int, per: int, offset: int) -> None:
        rows.append((n, done[n], base, per, offset))
        done[n] += count
        left[n] -= count

    def leave(gap: int, base: int, count: int) -> None:
        if gap and count:
            if gap not in open_groups:
                open_groups[gap] = []
                insort(gaps, gap)
            open_groups[gap].append((base, count))

    large = sorted((n for n in left if 3 * n > capacity), reverse=True)
    for i, n in enumerate(large):
        for m in large[i:]:
            if not left[n]:
                break
            if m + n > capacity:
                continue
            pairs = left[n] // 2 if m == n else min(left[n], left[m])
            if pairs and m == n:
                put(n, 2 * pairs, sequences, 2, 0)
            elif pairs:
                put(n, pairs, sequences, 1, 0)
                put(m, pairs, sequences, 1, n)
            leave(capacity - n - m, sequences, pairs)
            sequences += pairs
        if left[n]:
            leave(capacity - n, sequences, left[n])
            sequences += left[n]
            put(n, left[n], sequences - left[n], 1, 0)

    for n in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        while left[n]:
            at = bisect_left(gaps, n)
            if at == len(gaps):
                count = -(-left[n] // (capacity // n))
                leave(capacity, sequences, count)
                sequences += count
                at = len(gaps) - 1
            gap = gaps[at]
            base, count = open_groups[gap].pop()
            if not open_groups[gap]:
                del open_groups[gap], gaps[at]
            per = min(gap // n, left[n])
            filled = min(count, left[n] // per)
            put(n, filled * per, base, per, capacity - gap)
            leave(gap - per * n, base, filled)
            leave(gap, base + filled, count - filled)
    rows.sort()
    cols = np.array(rows, dtype=np.int64).reshape(-1, 5).T
    return Plan(*cols, sequences=sequences)


def pack(docs: DataFrame, path: str, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """One row per piece: (id, piece, start, length, ids_crc32, sequence_id, offset)."""
    cuts = written(pieces(docs, path, capacity, end_id, id_col, text_col), "pieces")
    total = cuts.count()
    groups = max(1, -(-total // RANKED))
    cuts = cuts.withColumn("part", F.pmod(F.xxhash64("salt", "id", "piece"), F.lit(groups)))
    sizes = cuts.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    # at most ``capacity`` rows
    histogram = {r["length"]: r["n"] for r in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places = plan(histogram, capacity)

    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    since = sizes.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("since"))
    within = Window.partitionBy("length", "part").orderBy("id", "piece", "salt", "ids_crc32")
    ranked = (cuts.withColumn("rank", F.row_number().over(within))
              .join(since, ["length", "part"])
              .withColumn("rank", F.col("rank") - 1 + F.col("since")))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            where = places.place(*(b.column(c).to_numpy() for c in ("length", "rank")))
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], *map(pa.array, where)],
                                             names=[*cols, "sequence_id", "offset"])

    cols = ["id", "piece", "start", "length", "ids_crc32"]
    kind = docs.schema[id_col].dataType.simpleString()
    out = ranked.select(*cols, F.col("rank").cast("long")).mapInArrow(
        assign, f"id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
    return out.withColumnRenamed("id", id_col)
