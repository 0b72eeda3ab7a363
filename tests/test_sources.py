"""Version claims, the chunk data source and observed steps."""

from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from kiln.sources import chunk_source as CS
from kiln.sources import sinks as K
from kiln.streaming import chunked as ST


def test_concurrent_writers_get_versions_of_their_own(spark, tmp_path):
    path = str(tmp_path / "registry")
    with ThreadPoolExecutor(20) as pool:
        got = list(pool.map(lambda i: K.register_version(spark, path, f"writer {i}", "y", {"i": i}), range(20)))
    assert sorted(got, key=lambda v: int(v[1:])) == [f"v{i}" for i in range(1, 21)]
    rows = spark.read.parquet(path).collect()
    assert {r["version"]: r["description"] for r in rows} == {v: f"writer {i}" for i, v in enumerate(got)}
    assert K.register_version(spark, path, "next", "y") == "v21"


def test_versions_go_on_from_entries_without_claims(spark, tmp_path):
    path = str(tmp_path / "old")
    spark.createDataFrame([("v4", 4, "d", "y", "{}")], K.REGISTRY_SCHEMA).write.parquet(f"{path}/entry=4")
    assert not (tmp_path / "old" / "_claims").exists()
    assert K.register_version(spark, path, "next", "y") == "v5"
    assert K.claim(spark, f"{path}/_claims/9") and not K.claim(spark, f"{path}/_claims/9")
    assert K.register_version(spark, path, "after a dead writer", "y") == "v10"


def _csv_chunks(folder, n, rows=5):
    folder.mkdir()
    for i in range(n):
        lines = [f"{100 * i + j},name{j},{j / 2}" for j in range(rows)]
        (folder / f"merged_chunk_{i}.csv").write_text("\n".join(["id,name,x", *lines]) + "\n")
    (folder / "_SUCCESS").write_text("")
    return str(folder)


SCHEMA = "id long, name string, x double, absent int"


def test_chunks_are_read_in_parallel(spark, tmp_path):
    path = _csv_chunks(tmp_path / "csv", 12)
    df = CS.read_chunk_source(spark, path, SCHEMA, "csv")
    assert df.rdd.getNumPartitions() == 12
    assert df.columns == ["id", "name", "x", "absent", "chunk_no"]
    got = sorted(tuple(r) for r in df.collect())
    assert got == sorted((100 * i + j, f"name{j}", j / 2, None, i) for i in range(12) for j in range(5))
    some = df.filter("chunk_no >= 3 AND chunk_no < 5 AND x > 0.6")
    assert some.rdd.getNumPartitions() == 2
    assert sorted(r["id"] for r in some.collect()) == [302, 303, 304, 402, 403, 404]
    assert df.filter(F.col("chunk_no").isin(7, 99)).select("chunk_no").distinct().collect()[0][0] == 7


def test_readers_skip_filtered_chunks():
    reader = CS.ChunkReader(None, {"path": "/nowhere"})
    other = CS.D.EqualTo(("x",), 1.0)
    assert list(reader.pushFilters([CS.D.GreaterThan(("chunk_no",), 2), other])) == [other]
    assert [reader._wanted(CS.Chunk("p", n)) for n in (1, 3, None)] == [False, True, False]
    assert reader.partitions() == []
    with pytest.raises(ValueError):
        CS.ChunkReader(None, {"path": "/nowhere", "chunkFormat": "unheard"})


def test_chunks_as_a_stream(spark, tmp_path):
    path = _csv_chunks(tmp_path / "stream", 7)
    stream = CS.stream_chunk_source(spark, path, SCHEMA, "csv")
    out = ST.run_metrics(stream, lambda b: b.groupBy().agg(F.count(F.lit(1)).alias("n"), F.max("chunk_no").alias("last")),
                         "chunk-stream", keep_batch=True)
    rows = sorted((r["last"], r["n"]) for r in out.collect() if r["n"])
    assert sum(n for _, n in rows) == 35 and rows[-1][0] == 6
    reader = CS.ChunkStreamReader(None, {"path": path, "chunkFormat": "csv", "chunksPerTrigger": "3"})
    seen, taken = reader.initialOffset(), []
    while (end := reader.latestOffset()) != seen:
        taken.append([c.number for c in reader.partitions(seen, end)])
        reader.commit(end)
        seen = end
    assert taken == [[0, 1, 2], [3, 4, 5], [6]]
    again = CS.ChunkStreamReader(None, {"path": path, "chunkFormat": "csv", "chunksPerTrigger": "3"})     # a restart
    assert [c.number for c in again.partitions({"chunks": 3}, {"chunks": 6})] == [3, 4, 5]
    assert again.latestOffset() == {"chunks": 7}


def test_other_formats_and_empty_folders(spark, tmp_path):
    folder = tmp_path / "jsonl"
    folder.mkdir()
    (folder / "part.jsonl").write_text('{"id": 1, "name": "a"}\n\n{"id": 2, "x": 0.5}\n')
    rows = sorted(tuple(r) for r in CS.read_chunk_source(spark, str(folder), SCHEMA, "jsonl").collect())
    assert rows == [(1, "a", None, None, None), (2, None, 0.5, None, None)]
    (tmp_path / "empty").mkdir()
    assert CS.read_chunk_source(spark, str(tmp_path / "empty"), SCHEMA, "csv").count() == 0
    batches = list(CS.FORMATS["jsonl"](pa.BufferReader(b'{"id": 7}\n' * 10_001), []))
    assert [b.num_rows for b in batches] == [10_000, 1]


def test_one_event_per_batch_and_step(spark, tmp_path):
    path = str(tmp_path / "chunks")
    for i in range(110):
        spark.createDataFrame([(i, float(j)) for j in range(i % 3 + 1)], "c int, x double").coalesce(1).write.mode("append").parquet(path)
    calls = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def counted(x):
        calls.add(1)
        return x
    steps = {"read": lambda b: b.withColumn("y", counted("x")), "filter": lambda b: b.filter("y > 0"), "none": lambda b: b.filter("y > 99")}
    events = ST.stream_progress(spark, path, "c int, x double", steps, {"n": F.count(F.lit(1)), "total": F.sum("y")})
    rows = events.collect()
    assert len(rows) == 330 and len({(r["batch_id"], r["step"]) for r in rows}) == 330
    total = sum(i % 3 + 1 for i in range(110))
    assert sum(r["n"] for r in rows if r["step"] == "read") == total == calls.value      # each row computed once
    assert sum(r["n"] for r in rows if r["step"] == "filter") == sum(i % 3 for i in range(110))
    assert all(r["n"] == 0 and r["total"] is None for r in rows if r["step"] == "none")
