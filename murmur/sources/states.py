"""Stored state: a table in buckets, merged batch by batch without touching what readers read.

A bucket (a hash of the key, or a day) is one folder of one generation, laid out as partition
columns so that tools can read the whole folder, with generations side by side. A batch reads the
buckets it touches, writes them anew as a further generation, and then tells by a manifest
which generation of each bucket is valid. Manifests are numbered by batch: a batch that comes
again changes nothing, one that failed half-way left no manifest. Readers follow the newest
manifest; generations that the last KEPT manifests don't name are deleted.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from murmur.session import delete_folder, settle

#: Manifests whose generations stay, so that readers of the one before can finish.
KEPT = 2
BUCKET = "_bucket"


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def _manifests(spark: SparkSession, path: str) -> list[str]:
    place, files = _file_system(spark, f"{path}/_manifests")
    found = files.listStatus(place) if files.exists(place) else []
    return sorted(n for n in (f.getPath().getName() for f in found) if n.endswith(".json"))


def _read_manifest(spark: SparkSession, path: str, name: str) -> dict:
    place, files = _file_system(spark, f"{path}/_manifests/{name}")
    stream = files.open(place)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def manifest(spark: SparkSession, path: str) -> dict:
    """The newest manifest: `batch`, and `buckets` with the folder of each."""
    names = _manifests(spark, path)
    return _read_manifest(spark, path, names[-1]) if names else {"batch": -1, "buckets": {}}


def _publish(spark: SparkSession, path: str, told: dict) -> None:
    draft, files = _file_system(spark, f"{path}/_manifests/.draft-{uuid.uuid4().hex}")
    out = files.create(draft, True)
    out.write(bytearray(json.dumps(told).encode()))
    out.close()
    name, _ = _file_system(spark, f"{path}/_manifests/{told['batch']:019d}.json")
    if not files.rename(draft, name):
        raise RuntimeError(f"another writer has merged batch {told['batch']} into {path}")
    names = _manifests(spark, path)
    named = {g.split("/")[0] for n in names[-KEPT:] for g in _read_manifest(spark, path, n)["buckets"].values()}
    for old in names[:-KEPT]:
        gone = {g.split("/")[0] for g in _read_manifest(spark, path, old)["buckets"].values()} - named
        for generation in gone:
            delete_folder(spark, f"{path}/{generation}")
        delete_folder(spark, f"{path}/_manifests/{old}")


def read_state(spark: SparkSession, path: str, schema: str, wanted: Callable[[str], bool] | None = None) -> DataFrame:
    """The table as the newest manifest tells; only buckets whose name is `wanted`."""
    folders = [f"{path}/{g}" for b, g in manifest(spark, path)["buckets"].items() if wanted is None or wanted(b)]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def hash_bucket(key: str, buckets: int = 32) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("string")


def merge_batch(path: str, schema: str, batch: DataFrame, batch_id: int, bucket: Column,
                merge: Callable[[DataFrame, DataFrame], DataFrame], drop: Callable[[str], bool] | None = None) -> bool:
    """Put a batch into the table; False if that batch is in it already.

    `merge` gets the rows of the buckets the batch touches and the batch, and returns their
    new rows; `bucket`, a text, may read columns of both. Buckets whose name `drop` wants go.
    The names of the buckets a batch touches come to the driver.
    """
    spark = batch.sparkSession
    last = manifest(spark, path)
    if last["batch"] >= batch_id:
        return False
    batch = settle(batch, "batch")
    touched = {r[0] for r in batch.select(bucket).distinct().collect()}
    old = read_state(spark, path, schema, lambda b: b in touched)
    generation = f"batch-of={batch_id}-{uuid.uuid4().hex}"
    rows = merge(old, batch).withColumn(BUCKET, bucket)
    rows.hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(f"{path}/{generation}")
    valid = {b: g for b, g in last["buckets"].items() if b not in touched} | {b: f"{generation}/{BUCKET}={b}" for b in touched}
    place, files = _file_system(spark, f"{path}/{generation}")
    written = {f.getPath().getName().removeprefix(f"{BUCKET}=") for f in files.listStatus(place)}
    valid = {b: g for b, g in valid.items() if (b not in touched or b in written) and not (drop and drop(b))}
    _publish(spark, path, {"batch": batch_id, "buckets": valid})
    return True
