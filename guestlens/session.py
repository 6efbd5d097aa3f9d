"""Session settings, the shared work folder and lineage cuts."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Only what differs from, or must not be turned off against, the defaults.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
}

# Drops a query's shuffle files when it has ended, once its result is written.
CLEAN_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# A shuffle of many terabytes starts from many partitions; AQE merges what is
# small. A local session keeps its own few.
CLUSTER_CONF = {
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
}

# The folder of the innermost ``scratch`` block.
_SCOPE: ContextVar[str | None] = ContextVar("scratch", default=None)


def build_session(app: str = "guestlens", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the engine's settings; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = SESSION_CONF | {key.replace("__", "."): value for key, value in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    if not spark.sparkContext.master.startswith("local"):
        for key, value in CLUSTER_CONF.items():
            if key not in settings and spark.sparkContext.getConf().get(key) is None:
                spark.conf.set(key, value)
    return spark


def work_dir(spark: SparkSession) -> str:
    """The folder that driver and all executors share: ``spark.checkpoint.dir``.

    Without it, a folder of the session's warehouse. On a cluster the warehouse
    has to be on a shared file system then; a machine-local one is refused.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    machine_local = ":" not in warehouse or warehouse.startswith("file:")
    if machine_local and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return f"{warehouse}/_work"


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the innermost ``scratch`` folder, or in the work folder; nothing is overwritten."""
    return f"{_SCOPE.get() or work_dir(spark)}/{label}-{uuid.uuid4().hex}"


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a file or folder, on whatever file system it is."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


@contextmanager
def scratch(spark: SparkSession, label: str = "scratch") -> Iterator[str]:
    """A folder for what a block writes with ``materialize`` and ``new_path``; it is deleted at the end.

    Plans made in the block read that folder, so write their results to a path
    from outside before the block ends. Blocks nest. The folder goes whether the
    block ends or fails.
    """
    folder = new_path(spark, label)
    token = _SCOPE.set(folder)
    try:
        yield folder
    finally:
        _SCOPE.reset(token)
        delete_path(spark, folder)


def landed(spark: SparkSession, label: str, make: Callable[[], DataFrame]) -> DataFrame:
    """The result of ``make()``, written outside the scratch folder that ``make`` works in."""
    path = new_path(spark, label)
    with scratch(spark, label):
        df = make()
        _write(df, path)
        schema = df.schema
    return spark.read.schema(schema).parquet(path)


def _write(df: DataFrame, path: str) -> None:
    """Write a table and drop the shuffle files of the query that made it."""
    conf = df.sparkSession.conf
    before = conf.get(CLEAN_SHUFFLES, "false")
    conf.set(CLEAN_SHUFFLES, "true")
    try:
        df.write.parquet(path)
    finally:
        conf.set(CLEAN_SHUFFLES, before)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the work folder and read it back.

    Cuts the lineage before iterative work: a lost executor costs a re-read of
    some files, not a re-run of the joins above them. The shuffle files of the
    finished query are dropped at once.
    """
    path = new_path(df.sparkSession, label)
    _write(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
