"""File sources and sinks of the bronze layer."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from tripmill.schemas import BRONZE, CORRUPT
from tripmill.sources.tables import is_folder

LANDING_TRIGGER = "300 seconds"


def read_ndjson(spark: SparkSession, path: str, schema: T.StructType = BRONZE) -> DataFrame:
    """JSON lines with a declared schema; lines that do not fit keep their text in a corrupt column."""
    with_corrupt = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    return (
        spark.read.schema(with_corrupt)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .json(path)
    )


def read_ndjson_inferred(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines with an inferred schema and partition columns found in the folder names.

    Inference reads the files twice; production paths declare the schema.
    """
    return spark.read.option("basePath", path).json(path)


def read_bronze(spark: SparkSession, path: str, schema: T.StructType = BRONZE) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def stream_files(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    fmt: str = "parquet",
    pattern: str | None = None,
    max_files: int | None = None,
) -> DataFrame:
    """A stream of files that appear in a folder."""
    reader = spark.readStream.schema(schema).format(fmt)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def stream_table(
    spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None
) -> DataFrame:
    """A stream of a Parquet table that is one file or a folder of part files."""
    if is_folder(spark, path):
        return stream_files(spark, path, schema, max_files=max_files)
    parent, name = path.rsplit("/", 1)
    return stream_files(spark, parent, schema, pattern=name, max_files=max_files)


def land(
    stream: DataFrame, path: str, checkpoint: str, max_records_per_file: int = 1_000_000
) -> DataStreamWriter:
    """Append a stream with date parts to compressed JSON files in dated folders."""
    parts = [c for c in ("year", "month", "day", "hour") if c in stream.columns]
    return (
        stream.writeStream.format("json")
        .partitionBy(*parts)
        .option("compression", "gzip")
        .option("maxRecordsPerFile", max_records_per_file)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .option("path", path)
        .trigger(processingTime=LANDING_TRIGGER)
    )


def append_events(events: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    """Append to the event store."""
    events.write.mode("append").partitionBy(*partition_by).parquet(path)


def write_extract(df: DataFrame, path: str) -> None:
    """Gold rows as JSON lines for a dashboard."""
    df.write.mode("overwrite").json(path)


def rebalanced(df: DataFrame, date: str, sort_by: tuple[str, ...] = ()) -> DataFrame:
    """Rows by date: small dates share a task, a date with much of the data is split."""
    out = df.hint("rebalance", F.col(date))
    return out.sortWithinPartitions(date, *sort_by) if sort_by else out


def write_partitioned(df: DataFrame, path: str, date: str, sort_by: tuple[str, ...] = ()) -> None:
    """Parquet in one folder per date; rewrites the dates that occur in the data and no others."""
    (
        rebalanced(df, date, sort_by).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .partitionBy(date)
        .parquet(path)
    )
