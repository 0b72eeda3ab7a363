"""Removal of repeated byte strings by a sparse, range-partitioned suffix array.

Every byte covered by a string of ``length`` (200) bytes that also starts
anywhere else is removed.  Not every suffix is sorted: of each 200-byte string
the 40-byte gram with the least hash (the first of equals) is its anchor, so
equal strings have equal anchors, about one position in eighty is one, and a
string can only repeat if its anchor's gram (the seed) does.

1. Anchors with the hash of their seed and of their context, the 160 bytes on
   either side (fewer at the ends of a text).  Equal contexts are counted before
   the shuffle, so copies cost one row per task and context.
2. A context found twice repeats whole.  Only seeds with several contexts go on,
   one suffix per context, fetched from the texts that hold them.
3. These suffixes are range-partitioned by their leading bytes (Spark samples the
   splitters); each bucket sorts its suffixes, and the contexts to the left read
   backwards, by multikey quicksort, and takes from the common prefixes of
   neighbours which strings of 200 bytes around the seed occur twice.  The seed
   leads the suffix, so all that can match lies in one bucket, unless a seed has
   more contexts than a bucket may hold: such seeds are compared across
   buckets, by counting every string around the seed by its hash.
4. Each anchor's repeated stretch joins its text, and stretches are cut out.

Texts without a repeated stretch are hashed where they are read; a bitmap of
fixed size keeps most of them out of the shuffles (when it fills up, more texts
pass, never fewer).

Defined results: a null text counts as empty; texts under 200 bytes keep all
bytes; overlaps count and strings are judged on the input; rows are told apart
by id and text, so repeated rows repeat each other's text and lose it; an empty
table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kiln.llm.common import map_texts, written

LENGTH, SEED = 200, 40
SIDE = LENGTH - SEED            # context on either side
BUCKET = 20_000                 # suffixes of a bucket
CROWDED = 50_000                # contexts of one seed compared in one bucket
BITS = 1 << 23                  # of the bitmap of texts
PART = 1 << 21                  # bytes of a text that are hashed together
PLACE_BITS = np.uint64(23)      # hold a place in two parts and their overlaps; one value, so that all parts choose alike

_rng = np.random.default_rng(7)
_BYTE = _rng.integers(0, 2 ** 64, 256, dtype=np.uint64)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2 ** 64))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def _anchors(parts: list[tuple[bytes, int, int]]) -> tuple[np.ndarray, ...]:
    """(part, place, left, right, seed hash, context hash) of the anchors of the
    windows that begin at ``low`` to ``high`` of every part (bytes, low, high)."""
    size = np.array([len(raw) for raw, _, _ in parts], dtype=np.int64)
    end = np.cumsum(size)
    first = end - size
    data = np.frombuffer(b"".join(raw for raw, _, _ in parts), dtype=np.uint8)
    n = len(data)
    if not (size >= LENGTH).any():
        return (np.empty(0, dtype=np.int64),) * 6
    power, back = _powers(_STEP, n + 1), _powers(_BACK, n + 1)
    prefix = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(_BYTE[data] * power[:n], dtype=np.uint64)))
    gram = _mixed((prefix[SEED:] - prefix[:-SEED]) * back[:n - SEED + 1])
    # the upper bits of the hash decide, the first place of equals wins
    least = (gram >> PLACE_BITS << PLACE_BITS) | np.arange(len(gram), dtype=np.uint64)
    span = 1
    while 2 * span <= SIDE + 1:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    rest = SIDE + 1 - span
    least = np.minimum(least[:len(least) - rest], least[rest:])
    whole = np.zeros(len(least), dtype=bool)            # windows inside one part
    for at, k, (_, low, high) in zip(first.tolist(), size.tolist(), parts, strict=True):
        if k >= LENGTH:
            whole[at + low:at + min(high, k - LENGTH + 1)] = True
    mark = np.zeros(n, dtype=bool)
    mark[(least[whole] & ((np.uint64(1) << PLACE_BITS) - np.uint64(1))).astype(np.int64)] = True
    at = np.flatnonzero(mark)
    part = np.searchsorted(end, at, side="right")
    left = np.minimum(SIDE, at - first[part])
    right = np.minimum(SIDE, end[part] - at - SEED)
    lo = at - left
    context = (prefix[at + SEED + right] - prefix[lo]) * back[lo]
    context = _mixed(_mixed(context) + (left * 1000 + right).astype(np.uint64))
    return part, at - first[part], left, right, gram[at].view(np.int64), context.view(np.int64)


def anchors_of(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """(text, place, left, right, seed hash, context hash) of every anchor.

    Long texts are worked on in overlapping parts of ``PART`` bytes, so memory does
    not grow with a text; an anchor found from two parts is one."""
    found: list[tuple[np.ndarray, ...]] = []
    group: list[tuple[bytes, int, int]] = []
    origin: list[tuple[int, int]] = []
    held = 0

    def flush() -> None:
        if group:
            part, place, *rest = _anchors(group)
            text, offset = np.array(origin, dtype=np.int64).T
            found.append((text[part], place + offset[part], *rest))
        group.clear()
        origin.clear()

    for i, raw in enumerate(texts):
        for at in range(0, max(1, len(raw)), PART):
            a, b = max(0, at - SIDE), min(len(raw), at + PART + 2 * LENGTH)
            if held + b - a > 2 * PART:
                flush()
                held = 0
            group.append((raw[a:b], at - a, at - a + PART))
            origin.append((i, a))
            held += b - a
    flush()
    columns = [np.concatenate(c) for c in zip(*found, strict=True)] if found else [np.empty(0, dtype=np.int64)] * 6
    once = np.unique(np.stack(columns[:2]), axis=1, return_index=True)[1] if any(len(t) > PART for t in texts) else slice(None)
    return tuple(c[once] for c in columns)


def multikey_sort(rows: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of zero-padded byte rows (shorter first of equals) and the common prefix of neighbours.

    Multikey quicksort, eight bytes at a time: only rows still tied on all
    earlier keys are compared on the next one.
    """
    lanes = np.ascontiguousarray(rows).view(">u8")
    order = np.argsort(lanes[:, 0], kind="stable")
    bound = np.ones(len(rows), dtype=bool)              # starts a run of ties
    bound[1:] = lanes[order[1:], 0] != lanes[order[:-1], 0]
    for k in range(1, lanes.shape[1] + 1):
        tied = ~bound
        tied[:-1] |= ~bound[1:]
        at = np.flatnonzero(tied)
        if not len(at):
            break
        run = np.cumsum(bound)[at]
        key = lanes[order[at], k] if k < lanes.shape[1] else size[order[at]]
        own = np.lexsort((key, run))
        order[at] = order[at[own]]
        key, run = key[own], run[own]
        bound[at[1:]] |= (key[1:] != key[:-1]) | (run[1:] != run[:-1])
    common = np.zeros(len(rows), dtype=np.int64)        # with the row before
    for a in range(1, len(rows), 20_000):
        x, y = order[a - 1:a + 19_999], order[a:a + 20_000]
        x = x[:len(y)]
        differ = rows[x] != rows[y]
        first = np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1])
        common[a:a + 20_000] = np.minimum(first, np.minimum(size[x], size[y]))
    return order, common


def repeated_sides(seed: list[bytes], left: list[bytes], right: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Furthest bytes left and right of each seed that lie in a 200-byte string around it found twice (-1: none).

    ``left`` holds the bytes before the seed read backwards.
    """
    n = len(seed)
    lsize, rsize = (np.array(list(map(len, x)), dtype=np.int64) for x in (left, right))

    def matrix(rows: list[bytes], width: int) -> np.ndarray:
        return np.frombuffer(b"".join(r.ljust(width, b"\0") for r in rows), dtype=np.uint8).reshape(n, width)

    suffixes = matrix([s + r for s, r in zip(seed, right, strict=True)], LENGTH)
    order, common = multikey_sort(suffixes, rsize + SEED)
    order_left, common_left = multikey_sort(matrix(left, SIDE), lsize)
    far_left, far_right = np.full(n, -1), np.full(n, -1)
    key, key_left = np.empty(n, dtype=np.int64), np.empty(n, dtype=np.int64)
    for back in range(SIDE + 1):                        # the string starts ``back`` bytes before the seed
        ahead = SIDE - back
        key[order] = np.cumsum(common < SEED + ahead)
        key_left[order_left] = np.cumsum(common_left < back)
        fits = np.flatnonzero((lsize >= back) & (rsize >= ahead))
        both = key[fits] * (n + 1) + key_left[fits]
        by = np.argsort(both, kind="stable")
        same = both[by[1:]] == both[by[:-1]]
        hit = np.union1d(fits[by[1:][same]], fits[by[:-1][same]])
        far_left[hit] = back
        far_right[hit] = np.where(far_right[hit] < 0, ahead, far_right[hit])
    return far_left, far_right


def _bitmap(df: DataFrame, key: Column) -> np.ndarray:
    """Bitmap of ``BITS`` bits over a hash of ``key``, of one fixed size whatever the rows."""
    words = df.select(F.pmod(key, F.lit(BITS)).alias("bit")).groupBy(F.expr("bit div 32").alias("word")).agg(
        F.expr("bit_or(shiftleft(1L, cast(bit % 32 as int)))").alias("bits")).toArrow()
    out = np.zeros(BITS // 32, dtype=np.uint32)
    out[words.column("word").to_numpy()] = words.column("bits").to_numpy().astype(np.uint32)
    return out


def _maybe(bitmap: np.ndarray, key: Column) -> Column:
    """Whether the bitmap has the key's bit."""
    @F.pandas_udf("boolean")
    def there(bit):     # a pandas series of longs
        import pandas as pd
        b = bit.to_numpy()
        return pd.Series((bitmap[b // 32] >> (b % 32).astype(np.uint32) & 1).astype(bool))
    return there(F.pmod(key, F.lit(BITS)))


def _suffixes(texts: DataFrame) -> DataFrame:
    """One row per wanted anchor: its seed, context and the bytes around it."""
    kept = ["seed", "context"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {c: [] for c in (*kept, "lead", "left", "right")}
            for text, wanted in zip(batch.column("text"), batch.column("wanted"), strict=True):
                raw = (text.as_py() or "").encode()
                for w in wanted.as_py():
                    p = w["place"]
                    out["seed"].append(w["seed"])
                    out["context"].append(w["context"])
                    out["lead"].append(raw[p:p + SEED])
                    out["left"].append(raw[max(0, p - SIDE):p][::-1])
                    out["right"].append(raw[p + SEED:p + LENGTH])
            yield pa.RecordBatch.from_pydict(
                out, pa.schema([(c, pa.int64()) for c in kept] + [(c, pa.binary()) for c in ("lead", "left", "right")]))

    return texts.select("text", "wanted").mapInArrow(
        run, "seed long, context long, lead binary, left binary, right binary")


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One bucket of suffixes to (seed, context, left, right) of those in a repeated string."""
    rows = pa.Table.from_batches(list(batches)) if (batches := list(batches)) else None
    if rows is None or rows.num_rows < 2:
        return
    far_left, far_right = repeated_sides(*(rows.column(c).to_pylist() for c in ("lead", "left", "right")))
    hit = np.flatnonzero(far_left >= 0)
    found = rows.select(["seed", "context"]).take(pa.array(hit))
    found = found.append_column("left", pa.array(far_left[hit])).append_column("right", pa.array(far_right[hit]))
    yield from found.combine_chunks().to_batches()


def _compare_across(suffixes: DataFrame) -> DataFrame:
    """The same for seeds too crowded for a bucket: every string around the seed is counted by two hashes."""
    strings = suffixes.select("seed", "context", "lead", "left", "right",
                              F.explode(F.sequence(F.lit(0), F.lit(SIDE))).alias("back")).where(
        (F.length("left") >= F.col("back")) & (F.length("right") >= SIDE - F.col("back")))
    parts = ["lead", F.expr("substring(left, 1, back)"), F.expr(f"substring(right, 1, {SIDE} - back)")]
    strings = written(strings.select("seed", "context", "back", F.xxhash64(*parts).alias("h1"),
                                     F.xxhash64(F.lit(1), *parts).alias("h2")), "strings")
    keys = ["seed", "back", "h1", "h2"]
    twice = strings.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return strings.join(twice, keys, "left_semi").groupBy("seed", "context").agg(
        F.max("back").cast("long").alias("left"), (SIDE - F.min("back")).cast("long").alias("right"))


def repeated_stretches(docs: DataFrame, crowded: int = CROWDED, bucket: int = BUCKET) -> DataFrame:
    """(id, check, stretches) of the texts (id, check, text) that hold repeated strings; bytes from, to."""
    kinds = {"place": "int", "left": "int", "right": "int", "seed": "long", "context": "long"}

    def run(texts: list[str]) -> dict:
        text, place, left, right, seed, context = anchors_of([t.encode() for t in texts])
        return {"at": text, "place": place.astype(np.int32), "left": left.astype(np.int32),
                "right": right.astype(np.int32), "seed": seed, "context": context}

    anchors = written(map_texts(docs, "text", {"id": "id", "check": "check"}, kinds, run), "anchors")
    seeds = anchors.groupBy("seed").agg(F.count(F.lit(1)).alias("n"), (F.min("context") != F.max("context")).alias(
        "mixed")).where("n > 1").drop("n")
    seeds = written(seeds, "seeds")             # a join of two plain shuffles, whose hot keys Spark splits
    anchors = written(anchors.join(seeds, "seed"), "repeated")
    contexts = written(anchors.groupBy("seed", "context", "left", "right", "mixed").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("id", "check", "place")).alias("one")), "contexts")
    whole = contexts.where((F.col("n") > 1) & (F.col("left") + F.col("right") + SEED >= LENGTH)).select(
        "seed", "context", F.col("left").cast("long").alias("left"), F.col("right").cast("long").alias("right"))

    wanted = (contexts.where("mixed").groupBy(F.col("one.id").alias("id_w"), F.col("one.check").alias("check_w"))
              .agg(F.collect_list(F.struct("seed", "context", F.col("one.place").alias("place"))).alias("wanted")))
    wanted = written(wanted, "wanted")
    some = docs.where(_maybe(_bitmap(wanted, F.xxhash64("id_w", "check_w")), F.xxhash64("id", "check")))
    on = F.col("id").eqNullSafe(F.col("id_w")) & F.col("check").eqNullSafe(F.col("check_w"))
    # rows that repeat under one id hold the same text: one of them is enough
    suffixes = written(_suffixes(some.join(wanted, on).select("text", "wanted")).dropDuplicates(["seed", "context"]),
                       "suffixes")
    per_seed = contexts.where("mixed").groupBy("seed").agg(F.count(F.lit(1)).alias("m"))
    heavy = written(per_seed.where(F.col("m") > crowded).select("seed"), "heavy")
    total = suffixes.count()
    light = suffixes.join(heavy, "seed", "left_anti")
    sorted_out = light.repartitionByRange(max(1, -(-total // bucket)), "lead").select(
        "seed", "context", "lead", "left", "right").mapInArrow(
        _compare, "seed long, context long, left long, right long")
    partly = written(sorted_out.union(_compare_across(suffixes.join(heavy, "seed", "left_semi"))), "partly")
    covers = written(whole.union(partly).groupBy("seed", "context").agg(
        F.max("left").alias("l"), F.max("right").alias("r")), "covers")
    return anchors.join(covers, ["seed", "context"]).select(
        "id", "check", F.struct((F.col("place") - F.col("l")).cast("long").alias("a"),
                                (F.col("place") + SEED + F.col("r")).cast("long").alias("b")).alias("s")).groupBy(
        "id", "check").agg(F.collect_set("s").alias("stretches"))


def merged(stretches: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of overlapping or touching stretches, in order."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(stretches):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", crowded: int = CROWDED,
                   bucket: int = BUCKET, text: bool = False) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256) of every row; with ``text`` also the bytes that are left."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias(
        "text")).withColumn("check", F.crc32(F.encode("text", "utf-8")))
    found = written(repeated_stretches(rows, crowded, bucket).withColumnsRenamed({"id": "id_w", "check": "check_w"}),
                    "stretches")
    marked = rows.withColumn("some", _maybe(_bitmap(found, F.xxhash64("id_w", "check_w")), F.xxhash64("id", "check")))
    kind = docs.schema[id_col].dataType.simpleString()
    names = ["n_bytes", "n_removed", "n_spans", "kept_sha256"]
    untouched = marked.where(~F.col("some")).select(
        "id", F.octet_length("text").cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"),
        F.lit(0).cast("long").alias("n_spans"), F.sha2(F.encode("text", "utf-8"), 256).alias("kept_sha256"),
        *[F.encode("text", "utf-8").alias("kept")] * text)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for t, s in zip(batch.column("text"), batch.column("stretches"), strict=True):
                raw = t.as_py().encode()
                spans = merged([(x["a"], x["b"]) for x in s.as_py() or []])
                ends = [0, *(x for span in spans for x in span), len(raw)]
                kept = b"".join(raw[a:b] for a, b in zip(ends[::2], ends[1::2], strict=True))
                out.append((len(raw), len(raw) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(),
                            *[kept] * text))
            columns = list(zip(*out, strict=True)) or [()] * (4 + text)
            types = [pa.int64()] * 3 + [pa.string(), *[pa.binary()] * text]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *map(pa.array, columns, types)],
                                             names=["id", *names, *["kept"] * text])

    on = F.col("id").eqNullSafe(F.col("id_w")) & F.col("check").eqNullSafe(F.col("check_w"))
    touched = marked.where("some").join(found, on, "left").select("id", "text", "stretches").mapInArrow(
        cut, f"id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * text)
    return untouched.union(touched).withColumnRenamed("id", id_col)
