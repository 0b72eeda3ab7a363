from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np

from kiln.llm.quality import measured, quality, quality_filter, quantiles, repeated_words, sketches, text_counts

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    found = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if found[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered),
            len(lines))


def test_counts():
    rng = random.Random(1)
    texts = ["", " ", "a", "a b", "a a a", "a a a a", "x y z x y z", "l\nl\n\nl\r\nm|<>", "\x85 \xa0 é#"]
    texts += [" ".join(rng.choices("abc", k=rng.randint(0, 30))).replace("c a", "\n") for _ in range(300)]
    for t in texts:
        assert text_counts(t) == plain_counts(t)
    assert repeated_words([b"a", b"b", b"c"]) == 0


def test_awkward_rows(awkward, no_docs):
    got = quality(awkward)
    want = sorted((plain_counts(r["text"])[:5] for r in awkward.collect()))
    assert sorted(tuple(r)[1:6] for r in got.collect()) == want
    for r in got.collect():
        failed = r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"]
        assert r["base_failed"] == failed and not (failed and r["kept"])
    kept = quality_filter(awkward)
    assert kept.columns == awkward.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(str(r["doc_id"]) for r in got.where("kept").collect())
    assert quality(no_docs).count() == 0 and quality_filter(no_docs).count() == 0


def test_sketch_quantiles_are_within_their_error_and_merge(spark, docs):
    counts = measured(docs, {"lang": "lang", "source": "source"}).cache()
    sketch = sketches(counts, ["lang", "source"])
    rows = [r for r in counts.collect() if not r["base_failed"]]
    for groups in (["lang"], []):
        for r in quantiles(sketch, groups).collect():
            if r["measure"] != "chars_per_word":
                continue
            own = np.sort([x["word_chars"] / x["n_words"] for x in rows if not groups or x["lang"] == r["lang"]])
            assert r["size"] == len(own)
            for q, name in ((0.25, "q1"), (0.5, "q2"), (0.75, "q3")):
                true = own[int(np.ceil(q * len(own))) - 1]
                assert abs(r[name] - true) <= 0.0101 * true
    counts.unpersist()


def test_limits_follow_the_group(spark):
    rng = random.Random(2)

    def text(length, symbols=0):
        return " ".join("".join(rng.choices("abcdefghij", k=length)) + "#" * symbols for _ in range(80))

    rows = [(i, text(4), "en", "a") for i in range(60)] + [(100 + i, text(12), "xx", "a") for i in range(60)]
    rows += [(900, text(12), "en", "a"), (901, text(4), "xx", "a"), (902, text(4, 2), "en", "a")]
    rows += [(903, text(4), "en", None), (904, text(4), None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    kept = {r["doc_id"]: r["kept"] for r in quality(df, min_group=20).collect()}
    assert not kept[900] and not kept[901] and not kept[902]      # words of the other language's length; symbols
    assert kept[903]                                              # a small source is judged by its language
    assert all(kept[i] for i in range(60)) and all(kept[100 + i] for i in range(60))


def test_labelled_documents(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    got = quality(spark.read.parquet(f"{sf}/documents.parquet")).join(labels, "doc_id").where("not base_failed")
    rows = got.groupBy("quality", "kept").count().collect()
    assert {(r["quality"], r["kept"]) for r in rows} == {(0, False), (1, True)}
