"""Session construction and lineage helpers.

Cluster jobs get their session from the launcher; ``get_session`` only fills in
settings that are unset so a cluster's own configuration always wins.
"""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
import weakref
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings applied only when the running session has no value for them.
_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_session(master: str | None = None, app: str = "kiln",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def reachable(spark: SparkSession) -> None:
    """Let the Python workers of a local session import this package from wherever
    they start; on a cluster it is shipped with the job."""
    sc = spark.sparkContext
    if sc.master.startswith("local") and not sc.master.startswith("local-cluster"):
        root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        known = sc.environment.get("PYTHONPATH", os.environ.get("PYTHONPATH", ""))
        if root not in known.split(os.pathsep):
            sc.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, known]))


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``, which driver and executors share.

    Where the setting is absent, a plain local session (one process, so any
    folder is shared) gets a temporary folder; any other master must name one.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="kiln-ckpt-")
        spark.conf.set("spark.checkpoint.dir", base)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` into the shared checkpoint folder (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written intermediate tables."""
    return f"{ensure_checkpoint_dir(spark)}/kiln-tables/{name}"


_open = threading.local()                           # the tables of the innermost ``passing`` of a thread
_paths: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table below the shared folder and read it back."""
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    if getattr(_open, "paths", None) is not None:
        _open.paths.append(path)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    _paths[out] = path
    return out


RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def passing(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """A span of work whose tables pass: those ``written`` inside are deleted at its end, but for those given to the
    function it yields.  Shuffle files go with the action that made them, not whenever the driver collects its garbage.
    What leaves the span must read no table but those kept."""
    outer, own, kept = getattr(_open, "paths", None), [], set()
    before = spark.conf.get(RELEASE, None)

    def keep(df: DataFrame) -> DataFrame:
        kept.add(_paths[df])
        return df
    _open.paths = own
    spark.conf.set(RELEASE, "true")
    try:
        yield keep
    finally:
        _open.paths = outer
        if before is None:
            spark.conf.unset(RELEASE)
        else:
            spark.conf.set(RELEASE, before)
        for path in own:
            if path not in kept:
                _delete(spark, path)
            elif outer is not None:
                outer.append(path)


def settled(spark: SparkSession, make: Callable[[], DataFrame], name: str) -> DataFrame:
    """The frame that ``make`` returns as a written table; tables that it wrote on the way are deleted."""
    with passing(spark) as keep:
        return keep(written(make(), name))


def _delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(at, True)
