"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints link at ``radius`` (3) or fewer differing bits.  The 64 bits
are cut into three blocks; for each block erased in turn a fingerprint emits the
remaining bits with none or one of them flipped, the ball of half the radius
(rounded down).  Two linked fingerprints that differ at all differ in some
block, so with that block erased at most two differing bits are left and their
balls meet.  129 variants per distinct fingerprint instead of the 2,081 of a
ball of radius two, at 43 bits of selectivity; every colliding pair is verified.

A variant shared by more than ``bucket`` fingerprints is not compared pairwise.
Its members emit the whole balls of radius one and two: all members within one
bit of a point are within two bits of each other and within three bits of every
member within two bits of that point, so linking each to the smallest member
within one bit gives exactly the linked classes, in rows linear in the members.

Links are reduced to spanning links per variant, and components are found by
alternating star contractions over tables in the shared folder.

Defined results: words, shingles and bits as in ``fingerprint``; a text without
words (null, empty, white space) has fingerprint zero, which links like any
other; copies share one fingerprint and are never paired; null ids form no
component id unless a group has no other; an empty table gives no rows; further
columns are ignored or carried.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.llm.common import map_texts, written

WORDS, RADIUS, SEED = 3, 3, 42
CUTS = (0, 21, 42, 64)
BUCKET = 1024           # members compared pairwise; larger buckets take the star way

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def fingerprint(text: str, k: int = WORDS) -> int:
    """Bits set in over half of the XXH64 hashes of all k-word shingles, A-Z lower-cased."""
    words = text.encode().translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    end = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    start = np.concatenate(([0], end[:-1] + 1))
    last = min(k, len(words)) - 1
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(start.tolist(), end[last:].tolist())),
                         dtype=">u8", count=len(words) - last)
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 100_000):
        raw = hashes[at:at + 100_000].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(raw, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(hashes)).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, carry: dict[str, str], text_col: str = "text", k: int = WORDS) -> DataFrame:
    """Carried columns and ``fp``, the fingerprint as a signed long."""
    return map_texts(docs, text_col, carry, {"fp": "long"}, lambda texts: {"fp": [fingerprint(t, k) for t in texts]})


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _variants(fps: DataFrame) -> DataFrame:
    """(key, fp) for every erased block and every flipped bit outside of it."""
    keys = []
    for low, high in zip(CUTS[:-1], CUTS[1:], strict=True):
        erased = (1 << high) - (1 << low)
        kept = F.col("fp").bitwiseAND(F.lit(_signed(~erased & (1 << 64) - 1)))
        mark = (CUTS.index(low) + 1) << low             # tells the erased blocks apart
        flips = [0, *(1 << b for b in range(64) if not low <= b < high)]
        keys += [kept.bitwiseXOR(F.lit(_signed(mark ^ f))) for f in flips]
    return fps.select(F.explode(F.array(*keys)).alias("key"), "fp")


def _spanning(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (member, smallest linked member) of one bucket, by repeated minima over its distance matrix."""
    near = np.bitwise_count(fp[:, None] ^ fp[None, :]) <= RADIUS
    label = np.arange(len(fp))
    while True:
        least = np.where(near, label[None, :], len(fp)).min(axis=1)
        if (least == label).all():
            break
        label = least
    own = label != np.arange(len(fp))
    return fp[own], fp[label[own]]


def _meet(batches: Iterator[pa.RecordBatch], bucket: int) -> Iterator[pa.RecordBatch]:
    """Sorted (key, fp) rows to links (a, b); ``a`` alone marks a member of an over-full bucket.

    Of an open bucket at most ``bucket`` members are held; members beyond are passed on as they come.
    """
    open_key, held = None, np.empty(0, dtype=np.uint64)

    def close(fp: np.ndarray) -> list[tuple[np.ndarray, np.ndarray | None]]:
        return [_spanning(fp)] if 1 < len(fp) <= bucket else [(fp, None)] if len(fp) > bucket else []

    def batch(found: list[tuple[np.ndarray, np.ndarray | None]]) -> Iterator[pa.RecordBatch]:
        a = [x.view(np.int64) for x, _ in found]
        b = [pa.nulls(len(x), pa.int64()) if y is None else pa.array(y.view(np.int64)) for x, y in found]
        if a:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.concat_arrays(b)], names=["a", "b"])

    for rows in batches:
        if not rows.num_rows:
            continue
        key, fp = rows.column(0).to_numpy(), rows.column(1).to_numpy().view(np.uint64)
        cut = np.concatenate(([0], np.flatnonzero(key[1:] != key[:-1]) + 1, [len(key)]))
        found = []
        first = 0
        if open_key == key[0]:
            if len(held) > bucket:                  # already known as over-full: members go straight through
                found.append((fp[:cut[1]], None))
            else:
                held = np.concatenate((held, fp[:cut[1]]))
                if len(held) > bucket:
                    found.append((held, None))
            first = 1
        if first < len(cut) - 1:                    # the open bucket ends within this batch
            if len(held) <= bucket:
                found += close(held)
            size = np.diff(cut)
            size[:first] = 0
            size[-1] = 0                            # the last bucket may go on in the next batch
            pairs = cut[:-1][size == 2]
            near = np.bitwise_count(fp[pairs] ^ fp[pairs + 1]) <= RADIUS
            found.append((fp[pairs][near], fp[pairs + 1][near]))
            for k in np.flatnonzero(size > 2):
                found += close(fp[cut[k]:cut[k + 1]])
            open_key, held = key[-1], fp[cut[-2]:]
            if len(held) > bucket:
                found.append((held, None))
        yield from batch(found)
    if len(held) <= bucket:
        yield from batch(close(held))


def _stars(fps: DataFrame) -> DataFrame:
    """Links among ``fps`` by whole balls: every member within two bits of a point to its centre."""
    one = [0, *(1 << b for b in range(64))]
    two = [1 << a | 1 << b for a in range(64) for b in range(a)]
    flips = F.array(*[F.lit(_signed(f)) for f in one])
    near = fps.select("fp", F.explode(F.transform(flips, lambda m: F.col("fp").bitwiseXOR(m))).alias("point"))
    far = fps.select("fp", F.explode(F.transform(F.array(*[F.lit(_signed(f)) for f in two]),
                                                 lambda m: F.col("fp").bitwiseXOR(m))).alias("point"))
    centres = near.groupBy("point").agg(F.min("fp").alias("centre"))
    return near.union(far).join(centres, "point").where("fp <> centre").select(
        F.col("fp").alias("a"), F.col("centre").alias("b"))


def links(fps: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Links between distinct fingerprints whose classes are those of all links; ``a`` > ``b``."""
    met = written(_variants(fps).repartition("key").sortWithinPartitions("key")
                  .mapInArrow(lambda it: _meet(it, bucket), "a long, b long").distinct(), "met")
    out = met.where("b IS NOT NULL")
    crowded = met.where("b IS NULL").select(F.col("a").alias("fp")).distinct()
    if not crowded.isEmpty():
        out = out.union(_stars(written(crowded, "crowded")))
    return out.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node with an edge (a > b): the smallest node of its component.

    Alternates large-star (neighbours above a node move to its smallest
    neighbour) and small-star (those below do), minima being combined before
    the shuffle, until no edge changes; the rounds grow with the logarithm of
    the longest path.
    """
    edges = written(edges, "edges")
    before = None
    while True:
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("least"))
        small = large.join(least, "a").select(F.explode(F.array(
            F.struct(F.col("a"), F.col("least").alias("b")), F.struct(F.col("b").alias("a"), F.col("least").alias("b"))
        )).alias("e")).select("e.*").where("a <> b").distinct()
        edges = written(small, "edges")
        state = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if state == before:
            break
        before = state
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        edges.select("b", "b").distinct()).distinct()


def classes(prints: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """(fp, root) of every distinct fingerprint in ``prints``."""
    fps = written(prints.select("fp").distinct(), "distinct")
    roots = components(links(fps, bucket)).withColumnRenamed("node", "fp")
    return fps.join(roots, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bucket: int = BUCKET) -> DataFrame:
    """(id, fingerprint, component_id) of every row; the component id is its smallest id."""
    prints = written(fingerprints(docs, {"id": id_col}, text_col), "fingerprints")
    smallest = prints.groupBy("fp").agg(F.min("id").alias("least"))
    named = written(classes(prints, bucket).join(smallest, "fp"), "classes")
    named = named.join(named.groupBy("root").agg(F.min("least").alias("component_id")), "root").select(
        "fp", "component_id")
    return prints.join(named, "fp").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         bucket: int = BUCKET) -> DataFrame:
    """The row of the smallest id of every group (nulls last), with all its columns."""
    row = F.xxhash64(F.col(id_col), F.col(text_col))
    marked = docs.withColumn("__row", row)
    prints = written(fingerprints(marked, {"id": id_col, "row": "__row"}, text_col), "fingerprints")
    first = (prints.join(classes(prints, bucket), "fp").groupBy("root")
             .agg(F.min(F.struct(F.col("id").isNull().alias("late"), "id", "row")).alias("first")))
    kept = first.select(F.col("first.id").alias("__id"), F.col("first.row").alias("__row"))
    return (marked.join(kept, "__row").where(F.col(id_col).eqNullSafe(F.col("__id")))
            .dropDuplicates(["__row"]).select(*[F.col(f"`{c}`") for c in docs.columns]))
