"""Session settings the operators rely on, and the shared working folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

#: Keyed state on disk: event ids are hex digits, which only entropy coding makes shorter, and each store otherwise
#: sets aside 4 MB for its list of files.
STATE = {
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    "spark.sql.streaming.stateStore.rocksdb.compression": "zstd",
    "spark.sql.streaming.stateStore.rocksdb.blockSizeKB": "32",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}

#: Shuffle files go when the write that made them ends, and not when the driver next collects garbage.
SHUFFLES_END = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    **STATE,
}


def build_session(name: str = "tripmill", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> None:
    """Event times are instants in UTC; every truncation and text form depends on it."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder under the shared checkpoint folder, by one rule for every master.

    Without spark.checkpoint.dir it lies under the warehouse, which all executors share as well.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        base = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_work"
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def native_state(spark: SparkSession) -> None:
    """Streaming state in RocksDB, outside the heap, however many keys there are."""
    for key, value in STATE.items():
        spark.conf.set(key, value)


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings for what is run within; those from before are back afterwards."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def release_shuffles(spark: SparkSession) -> None:
    """Ask the driver to collect garbage: Spark then removes the shuffle files of streams that have ended.

    On its own it asks every half hour only, while each micro-batch leaves the files of its shuffle.
    """
    spark._jvm.System.gc()


def kept(df: DataFrame, purpose: str) -> DataFrame:
    """Write a table into the shared working folder and read it again, for operators that read it several times.

    Event ids are random hex digits, which only a codec with entropy coding makes shorter.
    """
    path = work_dir(df.sparkSession, purpose)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def plain_times(df: DataFrame) -> DataFrame:
    """Return instants as zone-less timestamps, the form Parquet inputs and other engines use."""
    return df.select(
        *[
            F.col(f.name).cast("timestamp_ntz").alias(f.name)
            if isinstance(f.dataType, T.TimestampType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )
