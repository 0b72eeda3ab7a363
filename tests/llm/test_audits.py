from __future__ import annotations

import random
import re
from collections import Counter
from fractions import Fraction
from itertools import permutations

import duckdb
import numpy as np
import pytest

from kiln.llm import divergence, filter_audit
from kiln.llm.divergence import count_terms, radix_order
from kiln.llm.filter_audit import COPY, FILTERS, failures, report, shapley

SF = "/root/testdata/sf0.001"
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LABELS = "doc_id long, quality int, toxic int, part string, n int"


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def plain_terms(text):
    return [re.sub("[A-Z]", lambda m: m.group().lower(), t) for t in TERM.findall(text or "")]


def plain_divergence(docs, least=3, top=200):
    docs = [(lang or "", source or "", plain_terms(text)) for text, lang, source in docs]
    out = []
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        held = Counter(t for d in own for t in set(d[2]))
        kept = sorted(t for t, n in held.items() if n >= least)
        counts = {s: Counter(t for d in own if d[1] == s for t in d[2] if held[t] >= least) for s in {d[1] for d in own}}
        counts[None] = Counter(t for d in own for t in d[2] if held[t] >= least)
        p = {s: {t: 1 + 10 ** 9 * (c[t] + 1) // (sum(c.values()) + len(kept)) for t in kept} for s, c in counts.items()}

        def gap(a, b, t):
            return (p[a][t] - p[b][t]) ** 2 // p[b][t]
        for s in counts:
            if s is None:
                continue
            pairs = [(sum(gap(s, o, t) for t in kept), o) for o in counts if o not in (s, None)]
            terms = [(gap(s, None, t), t) for t in kept if counts[s][t] and p[s][t] > p[None][t]]
            for part, found, limit in (("pair", pairs, None), ("term", terms, top)):
                ranked = sorted(found, key=lambda x: (-x[0], x[1].encode()))[:limit]
                out += [(lang, s, part, item, value, k) for k, (value, item) in enumerate(ranked, 1)]
    return sorted(out, key=repr)


def mixed(seed, n=60):
    rng = random.Random(seed)
    words = ["a", "Ab", "straße", "x" * 8, "y" * 9, "y" * 16, "z" * 17, "é" * 40, "漢" * 90, "q" * 300, "q" * 301, "KITTEN",
             "abcdefgh", "abcdefghi", "don't", "1st", *("w%s" % chr(97 + i) for i in range(20))]
    return [(" ".join(rng.choices(words, k=rng.randint(0, 40))), rng.choice(["en", "de", None, ""]),
             rng.choice(["s1", "s2", "s3", None])) for _ in range(n)]


def test_divergence_equals_a_plain_version(spark):
    rows = [*mixed(1), (None, "en", "s1"), ("", "xx", "s9"), ("lone words", "yy", None), *[("hot hot copy", "en", "s2")] * 40]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "text string, lang string, source string, n int, term string")
    assert rows_of(divergence.divergence(docs)) == plain_divergence(rows)
    assert rows_of(divergence.divergence(docs, least=1, top=3)) == plain_divergence(rows, 1, 3)


def test_divergence_of_awkward_rows(awkward, no_docs):
    rows = [(r["text"], r["lang"], r["source"]) for r in awkward.collect()]
    assert rows_of(divergence.divergence(awkward, least=1)) == plain_divergence(rows, 1)
    assert divergence.divergence(no_docs).count() == 0


@pytest.mark.parametrize("cells", [1, 50])
def test_divergence_in_small_blocks(spark, cells, monkeypatch):
    monkeypatch.setattr(divergence, "CELLS", cells)
    monkeypatch.setattr(divergence, "CHUNK", 500)
    monkeypatch.setattr(divergence, "ROWS", 7)
    rows = mixed(2)
    docs = spark.createDataFrame(rows, "text string, lang string, source string")
    assert rows_of(divergence.divergence(docs)) == plain_divergence(rows)


def test_terms_are_counted_by_length():
    texts = [t or "" for t, _, _ in mixed(3)] + ["ab", "", "cd", "É" * 500]
    data = [t.encode() for t in texts]
    offsets = np.concatenate(([0], np.cumsum([len(d) for d in data])))
    group = np.array([i % 3 for i in range(len(texts))], dtype=np.uint16)
    got = Counter()
    for terms, own, n, docs in count_terms(np.frombuffer(b"".join(data), dtype=np.uint8), offsets, group):
        for row in zip(terms.to_pylist(), own.tolist(), n.tolist(), docs.tolist(), strict=True):
            got[row] += 1
    want = {}
    for i, t in enumerate(texts):
        own = Counter(plain_terms(t))
        for term, n in own.items():
            a, b = want.get((term, i % 3), (0, 0))
            want[term, i % 3] = (a + n, b + 1)
    assert got == Counter((t, g, n, d) for (t, g), (n, d) in want.items())


def test_radix_order_is_stable():
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 2 ** 64, 5000, dtype=np.uint64) % 97, rng.integers(0, 2 ** 64, 5000, dtype=np.uint64)
    b[:2500] = b[2500:]
    assert (radix_order([a, b]) == np.lexsort((np.arange(5000), a, b))).all()


def plain_shapley(v, k):
    out = [Fraction(0)] * k
    orders = list(permutations(range(k)))
    for order in orders:
        before = 0
        for i in order:
            out[i] += Fraction(v[before | 1 << i] - v[before], len(orders))
            before |= 1 << i
    return out


def test_least_squares_gives_the_shapley_values():
    rng = random.Random(4)
    for k in (1, 2, 3, 5):
        v = [0, *(rng.randint(0, 10 ** 12) for _ in range((1 << k) - 1))]
        assert shapley(v, k) == plain_shapley(v, k)


def plain_failures(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    return ((len(words) < 50) + 2 * (100 * len(set(words)) < 65 * len(words))
            + 4 * (100 * len(re.findall("[A-Z]", text)) > 5 * len(text)) + 8 * bool(re.search("[#$%&*|]", text)))


def plain_audit(docs, labels):
    marks = {}
    for i, quality, toxic in labels:
        good, bad = marks.get(i, (False, False))
        marks[i] = (good or quality == 1, bad or toxic == 1)
    rows, smallest = [], {}
    for i, text, _ in docs:
        if i is not None:
            smallest[text or ""] = min(i, smallest.get(text or "", i))
    for i, text, source in docs:
        copy = i is not None and i > smallest[text or ""]
        rows.append((source or "", plain_failures(text or "") + COPY * copy, *marks.get(i, (False, False))))
    out = []
    for part in {r[0] for r in rows}:
        own = [r[1:] for r in rows if r[0] == part]
        removed_of, steps = Counter(), []
        for order in permutations(range(5)):
            left = own
            for step, i in enumerate(order, 1):
                gone = [r for r in left if r[0] >> i & 1]
                left = [r for r in left if not r[0] >> i & 1]
                removed_of[i] += len(gone)
                steps.append(("".join(FILTERS[j] for j in order), step, i, len(left), len(gone),
                              sum(r[0] >> i & 1 for r in own) - len(gone), sum(r[0] == 1 << i for r in own),
                              sum(r[1] for r in gone), sum(r[2] for r in gone)))
        out += [(part, s[0], s[1], *s[3:], removed_of[s[2]]) for s in steps]
    return sorted(out, key=repr)


def test_failures_equal_a_plain_version():
    rng = random.Random(6)
    for _ in range(500):
        text = "".join(rng.choices("ab C\tÉ\n\x0b\x0c\x1c\x85 　#漢", k=rng.randint(0, 300)))
        assert failures(text.encode()) == plain_failures(text)


def test_audit_of_awkward_rows(spark, awkward, no_docs):
    labels = [(1, 1, None), (4, 0, 1), (4, 1, 0), (5, 1, 1), (7, None, 1), (None, 1, 1), (99, 1, 1)]
    table = spark.createDataFrame([(*r, "x", 0) for r in labels], LABELS)
    docs = [(r["doc_id"], r["text"], r["source"]) for r in awkward.collect()]
    docs += [(20 + i % 6, "the hot copy", "s1") for i in range(60)]
    frame = awkward.select("doc_id", "text", "source", "n_words", "part").unionByName(
        spark.createDataFrame(docs[-60:], "doc_id long, text string, source string"), allowMissingColumns=True)
    labels = [r for r in labels if r[0] is not None]            # a null id has no labels
    assert rows_of(filter_audit.filter_audit(frame, table)) == plain_audit(docs, labels)
    assert filter_audit.filter_audit(no_docs, table).count() == 0
    assert filter_audit.filter_audit(frame, table.limit(0)).count() == len(plain_audit(docs, []))


def test_report_counts_are_differences_of_coalitions():
    game = {"total": 10, "n": [0, 4, 6, 7], "good": [0, 1, 1, 2], "toxic": [0, 0, 2, 2]}
    assert list(report(game, "XY")) == [("XY", 1, 6, 4, 0, 1, 1, 0, 5), ("XY", 2, 3, 3, 3, 3, 1, 2, 9),
                                        ("YX", 1, 4, 6, 0, 3, 1, 2, 9), ("YX", 2, 3, 1, 3, 1, 1, 0, 5)]


@pytest.mark.parametrize("name", ["op11_source_divergence", "op12_filter_interaction"])
def test_queries_equal_their_statements(spark, name):
    from kiln.llm.queries import ORACLE, QUERIES
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    want = con.execute(ORACLE[name])
    columns = [d[0] for d in want.description]
    got = QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(columns)
    assert rows_of(got.select(*columns)) == sorted(want.fetchall(), key=repr)
