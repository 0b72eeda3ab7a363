from __future__ import annotations

import public_tokenizers
import pytest

import corpus_pipeline
from kiln.llm import queries
from kiln.llm.bpe import library
from kiln.llm.pii import redacted

from tests.llm.conftest import SF
from tests.llm.test_decontamination import plain_hits
from tests.llm.test_pii import plain
from tests.llm.test_quality import plain_counts
from tests.llm.test_simhash import classes, plain_print


def test_stages_and_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_dedup", "decontamination", "personal_data", "packing"]
    assert [n.split("_")[0] for n in sorted(queries.QUERIES, key=lambda n: int(n[2:].split("_")[0]))] == [
        f"op{k}" for k in range(1, 14)]


def test_run_against_a_plain_version(spark):
    got = corpus_pipeline.run(spark, SF).toPandas()
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    symbols = {}
    for r in rows:
        words, chars, marks, lines, repeated, n = plain_counts(r["text"])
        if words >= 50 and 100 * repeated <= 50 * words:
            symbols[r["doc_id"]] = marks / words
    clean = [r for r in rows if symbols.get(r["doc_id"], 1) < 0.2]      # the generated junk is full of symbols
    prints = {r["doc_id"]: plain_print(r["text"]) for r in clean}
    root, first = classes(prints.values()), {}
    for i, p in sorted(prints.items()):
        first.setdefault(root[p], i)
    clean = [r for r in clean if r["doc_id"] in set(first.values())]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    clean = [r for r, hit in zip(clean, plain_hits([r["text"] for r in clean], items), strict=True) if not hit]
    tokenizer = library(public_tokenizers.path("byte_bpe_50k.json"))
    want = {r["doc_id"]: len(tokenizer.encode(redacted(r["text"], plain(r["text"])), add_special_tokens=False).ids) + 1
            for r in clean}
    assert got.groupby("doc_id").length.sum().to_dict() == want
    assert (got.groupby("sequence_id").length.sum() <= 2048).all()


@pytest.mark.parametrize("rows", ["awkward", "no_docs"])
def test_each_stage_on_awkward_rows(spark, request, rows):
    docs = request.getfixturevalue(rows)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        if name != "packing":
            assert out.columns == docs.columns, name
            assert [f.dataType for f in out.schema] == [f.dataType for f in docs.schema], name
        n = out.count()
        assert (n == 0) == (rows == "no_docs"), name
