"""Audit of how far the sources of a language diverge in their terms.

Tasks count terms on arrays: a term of up to eight bytes is one big-endian
64-bit word, of up to sixteen two of them; both kinds are radix-sorted by 16-bit
digits and counted as runs.  Longer terms lie in buckets of twice the width of
the one before, sorted by bytes; the longest are sorted as byte strings.  Only
counts per (language, source, term) leave a task, already summed over its texts.

All sums are exact.  The divergence of two sources adds over all kept terms, but
only terms that a source holds differ from its floor (the share of a term that
it lacks), so it is put together from value counts per source, and from the
terms that both hold; these meet as blocks of arrays, whose sums per pair of
sources leave the task, never a row per term and pair.

Defined results: null text, language and source count as the empty string; a
repeated row is a document of its own; a language without kept terms gives its
pairs the value 0; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kiln.llm.common import written

CHUNK, ROWS = 5 << 20, 60_000          # bytes and documents that a task counts together, about
WIDEST = 256                            # bytes of a term in the widest bucket of arrays
CELLS = 1 << 21                         # cells of a block of terms by sources, and of sums kept by a task
SCALE = 1_000_000_000

# Letters in lower case and bytes beyond ASCII; 0 for all that ends a term.
_FOLD = np.zeros(256, dtype=np.uint8)
_FOLD[97:123] = _FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


def radix_order(keys: list[np.ndarray]) -> np.ndarray:
    """The stable order by ``keys``, the least significant first: one counting pass per 16-bit digit that varies."""
    order = np.arange(len(keys[0]))
    for key in keys:
        key = key.astype(np.uint64, copy=False)
        for shift in range(0, 64, 16):
            digit = (key >> np.uint64(shift)).astype(np.uint16)
            if len(digit) and (digit != digit[0]).any():
                order = order[np.argsort(digit[order], kind="stable")]
    return order


def runs(keys: list[np.ndarray], doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first, n, documents) of every run of equal ``keys`` in sorted rows, documents ascending inside a run."""
    new = np.zeros(len(doc), dtype=bool)
    new[:1] = True
    for key in keys:
        new[1:] |= key[1:] != key[:-1]
    first = np.flatnonzero(new)
    new[1:] |= doc[1:] != doc[:-1]
    return first, np.diff(np.append(first, len(doc))), np.add.reduceat(new, first, dtype=np.int64)


def _texts(rows: np.ndarray) -> pa.Array:
    """Rows of zero-padded bytes as strings."""
    inside = rows != 0
    offsets = np.zeros(len(rows) + 1, dtype=np.int32)
    np.cumsum(inside.sum(1), out=offsets[1:])
    return pa.StringArray.from_buffers(len(rows), pa.py_buffer(offsets), pa.py_buffer(rows[inside]))


def _word(data: np.ndarray, at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The first ``size`` (1 to 8) bytes from ``at``, as a big-endian word padded with zeros."""
    word = np.lib.stride_tricks.sliding_window_view(data, 8)[at].view(">u8").ravel().astype(np.uint64)
    spare = ((8 - size) * 8).astype(np.uint64)
    return word >> spare << spare


def count_terms(data: np.ndarray, offsets: np.ndarray, group: np.ndarray) -> Iterator[tuple]:
    """(terms, group, n, documents) per bucket of lengths, for texts that follow each other in ``data``."""
    fold = _FOLD[data]
    inside = fold != 0
    before, after = np.zeros_like(inside), np.zeros_like(inside)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    edge = offsets[(offsets > offsets[0]) & (offsets < offsets[-1])] - offsets[0]
    before[edge], after[edge - 1] = False, False
    start, end = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    doc = np.searchsorted(offsets[1:] - offsets[0], start, side="right")
    size = end - start
    fold = np.concatenate((fold, np.zeros(WIDEST, dtype=np.uint8)))

    def counted(chosen: np.ndarray, words: list[np.ndarray]) -> tuple:
        own = group[doc[chosen]]
        order = radix_order([*words[::-1], own])
        words, own = [w[order] for w in words], own[order]
        first, n, docs = runs([*words, own], doc[chosen][order])
        rows = np.stack([w[first] for w in words], axis=1).astype(">u8").view(np.uint8)
        return _texts(rows.reshape(len(first), -1)), own[first], n, docs

    chosen = np.flatnonzero(size <= 8)
    if len(chosen):
        yield counted(chosen, [_word(fold, start[chosen], size[chosen])])
    chosen = np.flatnonzero((size > 8) & (size <= 16))
    if len(chosen):
        at = start[chosen]
        yield counted(chosen, [_word(fold, at, np.full(len(at), 8)), _word(fold, at + 8, size[chosen] - 8)])
    width = 16
    while width < WIDEST:
        chosen = np.flatnonzero((size > width) & (size <= 2 * width))
        width *= 2
        if len(chosen):
            rows = np.lib.stride_tricks.sliding_window_view(fold, width)[start[chosen]]
            rows *= np.arange(width) < size[chosen][:, None]
            terms = rows.view(f"S{width}").ravel()
            own = group[doc[chosen]]
            order = np.argsort(terms, kind="stable")
            order = order[radix_order([own[order]])]
            terms, own = terms[order], own[order]
            first, n, docs = runs([terms, own], doc[chosen][order])
            yield _texts(rows[order][first]), own[first], n, docs
    chosen = np.flatnonzero(size > WIDEST)
    if len(chosen):
        found = sorted((fold[start[i]:end[i]].tobytes(), group[doc[i]], doc[i]) for i in chosen)
        terms = np.array([t for t, _, _ in found], dtype=object)
        own, docs = (np.array([r[k] for r in found]) for k in (1, 2))
        first, n, docs = runs([terms, own], docs)
        yield pa.array([t.decode() for t in terms[first]], pa.string()), own[first], n, docs


def term_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """(lang, source, term, n, docs): occurrences of every term in a source of a language, and documents with it."""

    def grouped(rows: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = pa.Table.from_batches(rows).combine_chunks()
        names: dict[tuple[str, str], int] = {}
        group = np.array([names.setdefault(k, len(names)) for k in zip(part["lang"].to_pylist(), part["source"].to_pylist(),
                                                                       strict=True)], dtype=np.uint16)
        langs, sources = (pa.array([k[i] for k in names], pa.string()) for i in (0, 1))
        text = pa.concat_arrays(part["text"].chunks).cast(pa.large_binary())
        _, offsets, data = text.buffers()
        offsets = np.frombuffer(offsets, dtype=np.int64)[text.offset:text.offset + len(text) + 1]
        if not data or offsets[0] == offsets[-1]:
            return
        data = np.frombuffer(data, dtype=np.uint8)[offsets[0]:offsets[-1]]
        for terms, own, n, held in count_terms(data, offsets, group):
            own = pa.array(own.astype(np.int32))
            out = pa.RecordBatch.from_arrays([langs.take(own), sources.take(own), terms, pa.array(n), pa.array(held)],
                                             names=["lang", "source", "term", "n", "docs"])
            for k in range(0, out.num_rows, 50_000):
                yield out.slice(k, 50_000)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = rows = 0
        for batch in batches:
            for k in range(0, batch.num_rows, 2_000):
                part = batch.slice(k, 2_000)
                held.append(part)
                size += part.column(2).nbytes
                rows += part.num_rows
                if size >= CHUNK or rows >= ROWS:
                    yield from grouped(held)
                    held, size, rows = [], 0, 0
        if held:
            yield from grouped(held)

    taken = docs.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(k)
                          for c, k in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))])
    rows = taken.mapInArrow(run, "lang string, source string, term string, n long, docs long")
    return rows.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _share(n: str) -> Column:
    """Scaled share of a count ``n`` among ``total`` and ``terms`` kept terms; null without kept terms."""
    return F.expr(f"CASE WHEN terms > 0 THEN 1 + (CAST({SCALE} AS DECIMAL(18, 0)) * ({n} + 1)) DIV (total + terms) END")


def _gap(p: str, q: str) -> Column:
    return F.expr(f"(({p} - {q}) * ({p} - {q})) DIV {q}")


def _fit(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // q


def shared_terms(lang: str, at: np.ndarray, share: np.ndarray, floor: np.ndarray, offsets: np.ndarray
                 ) -> tuple[np.ndarray, np.ndarray]:
    """(sources, sums): over the terms that two sources hold, what their shares add to the gap beyond their floors.

    ``at`` numbers the source of every entry, ``offsets`` the entries of every
    term.  Sums may wrap on the way and are right once all are added.
    """
    sources, place = np.unique(at, return_inverse=True)
    k = len(sources)
    floors = np.zeros(k, dtype=np.int64)
    floors[place] = floor
    sums = np.zeros((k, k), dtype=np.int64)
    step = max(1, CELLS // k)
    for low in range(0, len(offsets) - 1, step):
        bounds = offsets[low:low + step + 1]
        rows, own = slice(bounds[0], bounds[-1]), np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        shares = np.zeros((len(bounds) - 1, k), dtype=np.int64)
        shares[own, place[rows]] = share[rows]
        for a in range(k):
            q = shares[shares[:, a] > 0]
            if len(q):
                p, held = q[:, a, None], q > 0
                q = np.where(held, q, 1)
                more = _fit(p, q) - _fit(p, floors[None]) - _fit(floors[a], q) + _fit(floors[a], floors)[None]
                sums[a] += np.where(held, more, 0).sum(0)
    return sources, sums


def _pair_sums(terms: DataFrame) -> DataFrame:
    """(lang, a, b, value) of rows (lang, held: array of source number, share and floor), summed per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[str, int, int], int] = {}

        def rows() -> pa.RecordBatch:
            keys = list(sums)
            value = [(v + (1 << 63)) % (1 << 64) - (1 << 63) for v in sums.values()]
            return pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int32()),
                 pa.array([k[2] for k in keys], pa.int32()), pa.array(value, pa.int64())], names=["lang", "a", "b", "value"])

        for batch in batches:
            for lang in batch.column(0).unique().to_pylist():
                held = batch.filter(pc.equal(batch.column(0), lang)).column(1)
                flat = held.flatten()
                offsets = np.concatenate(([0], np.cumsum(held.value_lengths().to_numpy())))
                sources, found = shared_terms(lang, *[flat.field(c).to_numpy() for c in ("at", "share", "floor")], offsets)
                for i, j in zip(*np.nonzero(found), strict=True):
                    if i != j:
                        key = (lang, int(sources[i]), int(sources[j]))
                        sums[key] = sums.get(key, 0) + int(found[i, j])
            if len(sums) > CELLS:
                yield rows()
                sums = {}
        yield rows()

    return terms.mapInArrow(run, "lang string, a int, b int, value long")


def divergence(docs: DataFrame, least: int = 3, top: int = 200, text_col: str = "text", lang_col: str = "lang",
               source_col: str = "source") -> DataFrame:
    """(lang, source, part, item, value, rank): gaps to every other source of the language, and each source's own terms.

    Terms are kept from ``least`` documents of a language on; ``top`` bounds the
    ranks of part ``term``.
    """
    counts = term_counts(docs, text_col, lang_col, source_col)
    per_term = Window.partitionBy("lang", "term")
    kept = (counts.withColumn("held", F.sum("docs").over(per_term)).where(F.col("held") >= least)
            .withColumn("whole", F.sum("n").over(per_term))
            .withColumn("lead", F.row_number().over(per_term.orderBy("source")) == 1)
            .select("lang", "source", "term", "n", "whole", "lead"))
    kept = written(kept, "kept-terms")

    names = docs.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(k)
                          for c, k in ((lang_col, "lang"), (source_col, "source"))]).distinct()
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("distinct"),
                                                F.sum(F.col("lead").cast("long")).alias("terms"))
    per_lang = Window.partitionBy("lang")           # as many rows as the language has sources
    groups = (names.join(totals, ["lang", "source"], "left").fillna(0, ["total", "distinct", "terms"])
              .withColumn("terms", F.sum("terms").over(per_lang))
              .withColumn("lang_total", F.sum("total").over(per_lang))
              .withColumn("at", F.row_number().over(per_lang.orderBy("source")))
              .withColumn("floor", _share("0")))
    groups = written(groups, "sources")

    facts = kept.join(groups, ["lang", "source"]).withColumn("share", _share("n"))
    own = (facts.withColumn("total", F.col("lang_total")).withColumn("base", _share("whole"))
           .where(F.col("share") > F.col("base"))
           .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                   _gap("share", "base").alias("value")))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    own = own.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)

    other = groups.select("lang", F.col("source").alias("item"), F.col("at").alias("other_at"),
                          F.col("floor").alias("other_floor"), F.col("distinct").alias("other_distinct"))
    exact = "CAST({} AS DECIMAL(38, 0))"
    pairs = groups.join(other, "lang").where(F.col("at") != F.col("other_at"))
    # terms that neither holds, less those of both, as if every source had its floor everywhere
    none = pairs.select("lang", "at", "other_at", F.expr(
        f"coalesce({exact.format('terms - distinct - other_distinct')} * (((floor - other_floor) * (floor - other_floor)) "
        "DIV other_floor), 0)").cast("decimal(38,0)").alias("value"))
    values = facts.groupBy("lang", "at", "share").agg(F.count(F.lit(1)).alias("m"))
    met = values.join(other, "lang").where(F.col("at") != F.col("other_at"))
    one = met.select("lang", F.explode(F.array(
        F.struct("at", "other_at", (F.col("m") * _gap("share", "other_floor").cast("decimal(19,0)")).cast(
            "decimal(38,0)").alias("value")),
        F.struct(F.col("other_at").alias("at"), F.col("at").alias("other_at"),
                 (F.col("m") * _gap("other_floor", "share").cast("decimal(19,0)")).cast("decimal(38,0)").alias("value"))
    )).alias("s")).select("lang", "s.*")
    held = facts.groupBy("lang", "term").agg(F.collect_list(F.struct("at", "share", "floor")).alias("held"))
    both = _pair_sums(held.where(F.size("held") > 1).select("lang", "held")).select(
        "lang", F.col("a").alias("at"), F.col("b").alias("other_at"), F.col("value").cast("decimal(38,0)").alias("value"))
    sums = none.unionByName(one).unionByName(both).groupBy("lang", "at", "other_at").agg(F.sum("value").alias("value"))
    gaps = (sums.join(groups.select("lang", "at", "source"), ["lang", "at"])
            .join(other.select("lang", "other_at", "item"), ["lang", "other_at"])
            .select("lang", "source", F.lit("pair").alias("part"), "item", F.col("value").cast("long").alias("value")))
    return gaps.withColumn("rank", F.row_number().over(order)).unionByName(own)


ORACLE = """
WITH d AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents
), t AS (
  SELECT doc, lang, source, unnest(regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM d
), kept AS (
  SELECT lang, term, count(*)::HUGEINT AS whole FROM t GROUP BY lang, term HAVING count(DISTINCT doc) >= 3
), groups AS (SELECT DISTINCT lang, source FROM d
), c AS (
  SELECT lang, source, term, count(*)::HUGEINT AS n FROM t GROUP BY lang, source, term
), dense AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, k.whole FROM groups g JOIN kept k USING (lang)
  LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), sums AS (
  SELECT *, sum(n) OVER (PARTITION BY lang, source) AS total, count(*) OVER (PARTITION BY lang, source) AS v FROM dense
), wide AS (SELECT lang, sum(whole) AS total FROM kept GROUP BY lang
), shares AS (
  SELECT s.lang, source, term, n, 1 + (1000000000::HUGEINT * (n + 1)) // (s.total + v) AS p,
    1 + (1000000000::HUGEINT * (whole + 1)) // (w.total + v) AS q FROM sums s JOIN wide w USING (lang)
), gaps AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(g.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN gaps g ON g.lang = a.lang AND g.source = a.source AND g.item = b.source
), own AS (
  SELECT lang, source, term AS item, ((p - q) * (p - q)) // q AS value FROM shares WHERE n > 0 AND p > q
), r AS (
  SELECT lang, source, 'pair' AS part, item, value,
    row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM pairs
  UNION ALL
  SELECT * FROM (SELECT lang, source, 'term' AS part, item, value,
    row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM own) WHERE rank <= 200
)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INT AS rank FROM r
"""
