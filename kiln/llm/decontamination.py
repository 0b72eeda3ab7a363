"""Benchmark decontamination: BM25 over test items, searched by block-max WAND.

The test items form a small inverted index; every passage of every training
text is a query against it.  Passages are windows of two segments of ``L`` words
(``L``: the longest item of the index), one starting at each segment, so an item
of the text lies whole in some passage.  An item is retrieved if its BM25 score
reaches the least score that a passage with 80 % of its five-word shingles can
have: its score against itself less the impacts of the words that missing
shingles may hide.  Impacts are divided by that score, so one threshold of 1
serves all items, and no item at or above the overlap is missed.

Upper bounds are taken in two steps: sums of block maxima for all passages of a
chunk at once, then document-at-a-time block-max WAND for the passages left.
Retrieved items are verified: 80 % of all shingles, and half of the question's
shingles and of the answer's words.

The index is cut by item length and into shards of a bounded number of words;
each shard is sent to the executors by itself, and texts pass the shards in
turn without a shuffle.

Defined results: null and empty texts hold no item; items without a word are
never found, items under five words only by their whole sequence; repeated rows
give repeated results; an empty table of either kind finds nothing; further
columns are ignored or carried.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass
from itertools import chain, repeat

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.llm.common import map_texts

K1, B = 1.2, 0.75
SHINGLE, OVERLAP, PART = 5, 0.8, 0.5
SHORTEST = 64               # words; the least segment length
SHARD_WORDS = 500_000       # of one shard of the index
SUPERBLOCKS, BLOCK = 32, 16

WORD = re.compile(r"\w+")
ANSWER = re.compile(r"\n\s*(?:answer|a)\s*:", re.I)
LAST_SENTENCE = re.compile(r"[.!?\n]\s*(?=[^.!?\n]*\w[^.!?\n]*[.!?\s]*$)")


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def question_words(text: str) -> int:
    """Words before the answer: what follows an answer mark, else the last sentence, else the last third."""
    marks = list(ANSWER.finditer(text)) or list(LAST_SENTENCE.finditer(text))
    total = len(words_of(text))
    before = len(words_of(text[:marks[-1].end()])) if marks else 0
    return before if 0 < before < total else total - max(1, total // 3)


def shingles(words: list[str]) -> list[tuple[str, ...]]:
    k = min(SHINGLE, len(words))
    return [tuple(words[i:i + k]) for i in range(len(words) - k + 1)] if words else []


@dataclass
class Item:
    item_id: object
    words: list[str]
    question: int           # words of the question

    def verify(self, passage: list[str]) -> tuple[float, float, float]:
        """Overlap of all shingles, of the question's shingles and of the answer's words."""
        own = shingles(self.words)
        k = len(own[0])
        there = {tuple(passage[i:i + k]) for i in range(len(passage) - k + 1)}
        hit = [s in there for s in own]
        first = dict(zip(own, hit, strict=True))
        asked = hit[:max(1, self.question - k + 1)]
        answer = self.words[self.question:] or self.words
        vocabulary = set(passage)
        return (sum(first.values()) / len(first), sum(asked) / len(asked),
                sum(w in vocabulary for w in answer) / len(answer))


class Index:
    """Postings with impacts relative to each item's least score, and their block maxima."""

    def __init__(self, items: list[tuple[object, str]], df: dict[str, int], n_items: int, mean_words: float):
        self.items = [Item(i, words_of(t), question_words(t)) for i, t in items]
        self.segment = max(SHORTEST, *(len(i.words) for i in self.items))
        lists: dict[str, list[tuple[int, float]]] = {}
        for k, item in enumerate(self.items):
            norm = K1 * (1 - B + B * len(item.words) / mean_words)
            impact = {w: np.log1p((n_items - df[w] + 0.5) / (df[w] + 0.5)) * tf * (K1 + 1) / (tf + norm)
                      for w, tf in Counter(item.words).items()}
            times = sorted(Counter(shingles(item.words)).values(), reverse=True)
            missing = sum(times[:int((1 - OVERLAP) * len(times) + 1e-9)])     # shingle places that may be missing
            hidden = sum(sorted(impact.values(), reverse=True)[:missing])
            least = max(1e-9, (sum(impact.values()) - hidden) * (1 - 1e-6))
            for w, x in impact.items():
                lists.setdefault(w, []).append((k, x / least))
        self.term = {w: t for t, w in enumerate(lists)}
        self.docs = [np.array([k for k, _ in p]) for p in lists.values()]
        self.impacts = [np.array([x for _, x in p]) for p in lists.values()]
        per = -(-len(self.items) // SUPERBLOCKS)
        self.bound = np.zeros((len(lists), -(-len(self.items) // per)), dtype=np.float32)
        for t, (d, x) in enumerate(zip(self.docs, self.impacts, strict=True)):
            np.maximum.at(self.bound[t], d // per, x)
        self.bound *= 1 + 1e-5                                                # single precision never falls short
        self.lasts = [d[np.minimum(np.arange(BLOCK - 1, len(d) + BLOCK - 1, BLOCK), len(d) - 1)].tolist()
                      for d in self.docs]
        self.maxima = [np.maximum.reduceat(x, np.arange(0, len(x), BLOCK)).tolist() for x in self.impacts]
        self.top = [max(m) for m in self.maxima]
        self.docs, self.impacts = [d.tolist() for d in self.docs], [x.tolist() for x in self.impacts]

    def wand(self, terms: list[int]) -> list[tuple[int, float]]:
        """Items whose relative score over ``terms`` reaches 1: block-max WAND, one item at a time."""
        cursors = [[self.docs[t][0], 0, t] for t in terms]       # item, place in the list, term
        found = []

        def move(c: list[int], to: int) -> bool:
            docs, lasts = self.docs[c[2]], self.lasts[c[2]]
            at, block = c[1], c[1] // BLOCK
            while block < len(lasts) and lasts[block] < to:      # whole blocks are skipped unread
                block += 1
            if block == len(lasts):
                return False
            at = max(at, block * BLOCK)
            while docs[at] < to:
                at += 1
            c[0], c[1] = docs[at], at
            return True

        while cursors:
            cursors.sort()
            bound, pivot = 0.0, -1
            for i, c in enumerate(cursors):
                bound += self.top[c[2]]
                if bound >= 1:
                    pivot = i
                    break
            if pivot < 0:
                break
            item = cursors[pivot][0]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == item:
                pivot += 1
            bound, until = 0.0, cursors[pivot + 1][0] if pivot + 1 < len(cursors) else len(self.items)
            for c in cursors[:pivot + 1]:
                block, lasts = c[1] // BLOCK, self.lasts[c[2]]
                while block < len(lasts) and lasts[block] < item:
                    block += 1
                if block < len(lasts):
                    bound += self.maxima[c[2]][block]
                    until = min(until, lasts[block] + 1)
            if bound < 1:                                        # no item before ``until`` can reach it
                cursors = [c for c in cursors[:pivot + 1] if move(c, max(until, item + 1))] + cursors[pivot + 1:]
            elif cursors[0][0] == item:
                score = sum(self.impacts[c[2]][c[1]] for c in cursors[:pivot + 1])
                if score >= 1:
                    found.append((item, score))
                cursors = [c for c in cursors[:pivot + 1] if move(c, item + 1)] + cursors[pivot + 1:]
            else:
                cursors = [c for c in cursors if c[0] >= item or move(c, item)]
        return found

    def search(self, texts: list[str]) -> list[dict[int, tuple[float, float, float, float]]]:
        """Per text: item -> (overlap, question overlap, answer overlap, relative score) of its best passage."""
        lists = [words_of(t) for t in texts]
        size = np.array([len(w) for w in lists], dtype=np.int64)
        ids = np.fromiter(map(self.term.get, chain.from_iterable(lists), repeat(-1)), dtype=np.int64, count=size.sum())
        segments = -(-size // self.segment)
        base = np.concatenate(([0], np.cumsum(segments)))
        place = np.arange(len(ids)) - np.repeat(np.cumsum(size) - size, size)
        key = (np.repeat(base[:-1], size) + place // self.segment) * len(self.term) + ids
        key = np.unique(key[ids >= 0])
        seg, term = key // len(self.term), key % len(self.term)
        cut = np.searchsorted(seg, np.arange(base[-1] + 1))
        sums = np.zeros((base[-1] + 1, self.bound.shape[1]), dtype=np.float32)
        full = np.flatnonzero(cut[1:] > cut[:-1])
        for at in range(0, len(full), 2_000):                    # bounds the gathered rows
            own = full[at:at + 2_000]
            lo, hi = cut[own[0]], cut[own[-1] + 1]
            sums[own] = np.add.reduceat(self.bound[term[lo:hi]], cut[own] - lo, axis=0)
        owner = np.repeat(np.arange(len(texts)), segments)
        follows = np.concatenate((owner[1:] == owner[:-1], [False])) if len(owner) else np.zeros(0, dtype=bool)
        total = sums[:-1] + np.where(follows[:, None], sums[1:], 0)
        found: list[dict[int, tuple[float, float, float, float]]] = [{} for _ in texts]
        for s in np.flatnonzero((total >= 1).any(axis=1)):
            terms = np.unique(term[cut[s]:cut[s + 1 + follows[s]]])
            if not (self.bound[terms].sum(axis=0) >= 1).any():
                continue
            d = int(owner[s])
            first = int(s - base[d]) * self.segment
            passage = lists[d][first:first + 2 * self.segment]
            for item, score in self.wand(terms.tolist()):
                got = (*self.items[item].verify(passage), score)
                if got[0] >= OVERLAP and got[1] >= PART and got[2] >= PART:
                    found[d][item] = max(got, found[d].get(item, got))
        return found


def indexes(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> list[Index]:
    """The items by length class, in shards of about ``SHARD_WORDS`` words, each brought to the driver by itself."""
    words = F.regexp_extract_all(F.lower(F.coalesce(F.col(text_col), F.lit(""))), F.lit(r"(?U)\w+"), F.lit(0))
    items = benchmark.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), words.alias("words")).where(
        F.size("words") > 0)
    # Java and Python may class rare characters differently: leave room by one length class
    level = F.greatest(F.lit(0), F.ceil(F.log2(F.size("words") / SHORTEST))).cast("int")
    items = items.withColumn("level", level)
    sizes = {r["level"]: r["n"] for r in items.groupBy("level").agg(F.sum(F.size("words")).alias("n")).collect()}
    n_items, total = items.count(), sum(sizes.values())
    out = []
    for lv, n in sorted(sizes.items()):
        shards = -(-n // SHARD_WORDS)
        for k in range(shards):
            part = items.where((F.col("level") == lv) & (F.pmod(F.xxhash64("id", "text"), F.lit(shards)) == k))
            rows = [(r["id"], r["text"]) for r in part.select("id", "text").collect() if words_of(r["text"])]
            if not rows:
                continue
            own = set(chain.from_iterable(words_of(t) for _, t in rows))
            if len(sizes) == shards == 1:
                df = Counter(chain.from_iterable(set(words_of(t)) for _, t in rows))
            else:
                here = part.select(F.explode("words").alias("w")).distinct()
                counts = (items.select(F.explode(F.array_distinct("words")).alias("w")).join(here, "w", "left_semi")
                          .groupBy("w").agg(F.count(F.lit(1)).alias("df")))
                df = dict.fromkeys(own, 1) | {r["w"]: r["df"] for r in counts.collect()}
            out.append(Index(rows, df, n_items, total / n_items))
    return out


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id") -> DataFrame | None:
    """(id, item, overlap, question_overlap, answer_overlap, score) of every text and item that it holds."""
    kind = benchmark.schema[item_col].dataType.simpleString()
    columns = {"overlap": "double", "question_overlap": "double", "answer_overlap": "double", "score": "double"}
    out = None
    for index in indexes(benchmark, item_col):

        def run(texts: list[str], index: Index = index) -> dict:
            hits = [(d, k, got) for d, own in enumerate(index.search(texts)) for k, got in sorted(own.items())]
            values = zip(*(got for _, _, got in hits), strict=True) if hits else ((),) * 4
            item = [None if index.items[k].item_id is None else str(index.items[k].item_id) for _, k, _ in hits]
            return {"at": [d for d, _, _ in hits], "item": item, **dict(zip(columns, values, strict=True))}

        found = map_texts(docs, text_col, {id_col: id_col}, {"item": "string", **columns}, run)
        out = found if out is None else out.union(found)
    if out is None:
        out = docs.select(id_col, F.lit(None).cast("string").alias("item"),
                          *[F.lit(None).cast("double").alias(c) for c in columns]).where(F.lit(False))
    return out.select(id_col, F.col("item").cast(kind).alias(item_col), *columns)


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """The rows of ``docs`` without a test item, with all their columns; shards follow each other in one scan."""
    names = docs.columns
    out = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("__row"))
    for index in indexes(benchmark, item_col):

        def run(texts: list[str], index: Index = index) -> dict:
            return {"at": [d for d, own in enumerate(index.search(texts)) if not own]}

        out = map_texts(out.select("__row", F.col(f"__row.`{text_col}`").alias("__t")), "__t", {"__row": "__row"}, {}, run)
    return out.select("__row.*")
