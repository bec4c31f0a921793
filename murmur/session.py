"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "murmur", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs rely on; a cluster sets master and sizes itself."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**settings, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new path under the folder all executors share.

    The cluster names that folder in `spark.checkpoint.dir`. Where it is unset, only a
    session whose tasks are threads of the driver gets a folder of its own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or _own_folder(spark.sparkContext.master)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


_own: list[str] = []


def _own_folder(master: str) -> str:
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    if not _own:
        folder = tempfile.TemporaryDirectory(prefix="murmur-", ignore_cleanup_errors=True)
        atexit.register(folder.cleanup)
        _own.append(folder.name)
    return _own[0]


def delete_folder(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def settle(df: DataFrame, name: str = "settled") -> DataFrame:
    """`df` as a table in the shared folder: computed once however often it is read.

    For callers whose results read it several times; operators don't settle. The frame is
    lazy, so its table stays until the driver's process ends and is deleted then.
    """
    path = scratch_folder(df.sparkSession, name)
    df.write.parquet(path)
    if not _settled:
        atexit.register(_delete_settled)
    _settled.append((df.sparkSession, path))
    return df.sparkSession.read.schema(df.schema).parquet(path)


_settled: list[tuple[SparkSession, str]] = []


def _delete_settled() -> None:
    while _settled:
        spark, path = _settled.pop()
        try:
            delete_folder(spark, path)
        except Exception:  # the session has gone, and with it the way to its storage
            return


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Within it, the shuffle files of a write go when it is done, not when the driver next collects its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


#: Files of up to so many bytes are dealt out; a larger input has splits enough.
SPREAD_BYTES = 256 << 20


def spread(df: DataFrame) -> DataFrame:
    """Deal the rows of a small file to all cores: a file of one row group would keep one core busy.

    Decided by Catalyst's size of the scan, without a job. What is shuffled has a fixed
    bound, so on a large table this does nothing, however many cores there are.
    """
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df if size > SPREAD_BYTES else df.repartition(df.sparkSession.sparkContext.defaultParallelism)
