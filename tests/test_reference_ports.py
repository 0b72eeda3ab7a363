"""The reference's four unit tests, re-expressed on Spark."""

import tempfile

from pyspark.sql import functions as F

from kiln.operators import aggregates as AG
from kiln.operators import schema as P
from kiln.plans.q_relational import WINE_SCHEMA
from kiln.sources import files as SRC

# The one-row wine sample of the reference tests.
HEADER = ("fixed acidity,volatile acidity,citric acid,residual sugar,chlorides,free sulfur dioxide,"
          "total sulfur dioxide,density,pH,sulphates,alcohol,quality")
ROW = "7.4,0.7,0,1.9,0.076,11,34,0.9978,3.51,0.56,9.4,5"


def test_csv_source_reads_chunks(spark):
    d = tempfile.mkdtemp(prefix="kiln-csv-")
    with open(f"{d}/sample.csv", "w") as f:
        f.write(HEADER + "\n" + ROW + "\n")
    df = SRC.read_csv(spark, d)
    assert df.count() > 0
    stream = SRC.read_csv_stream(spark, d, df.schema, files_per_batch=1)
    assert stream.isStreaming


def _rows(spark, values):
    schema = ", ".join(f"`{c}` string" for c in WINE_SCHEMA)
    return spark.createDataFrame(values, schema)


def test_validate_and_transform_valid(spark):
    df = _rows(spark, [tuple("0" for _ in WINE_SCHEMA) for _ in range(5)])
    valid, rejected = P.validate_rows(df, WINE_SCHEMA)
    assert valid.count() == 5
    assert rejected.count() == 0
    assert dict(valid.dtypes)["quality"] == "int"


def test_validate_and_transform_invalid(spark):
    df = _rows(spark, [tuple(None for _ in WINE_SCHEMA)])
    valid, rejected = P.validate_rows(df, WINE_SCHEMA)
    assert valid.count() == 0
    errs = [r["error"] for r in rejected.collect()]
    assert errs == ["Missing value in fixed acidity"]


def test_drift_detection(spark):
    a = spark.createDataFrame([(0.1,), (0.2,), (0.3,)], "a double")
    b = spark.createDataFrame([(0.9,), (0.95,), (1.0,)], "a double")
    flagged = AG.mean_drift(a, b, ["a"]).collect()
    assert [r["column"] for r in flagged] == ["a"]
    assert abs(flagged[0]["mean_a"] - 0.2) < 1e-12 and abs(flagged[0]["mean_b"] - 0.95) < 1e-12
