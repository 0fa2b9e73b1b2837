"""Catalog tables, views, materialised models, partition registration and retention."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _folder(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def is_folder(spark: SparkSession, path: str) -> bool:
    files, where = _folder(spark, path)
    return files.exists(where) and files.getFileStatus(where).isDirectory()


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Size of a file or of all files in a folder."""
    files, where = _folder(spark, path)
    return files.getContentSummary(where).getLength()


def partition_values(spark: SparkSession, path: str, column: str) -> list[str]:
    """Values of the folders `<column>=<value>` of a table on files; one per day or batch."""
    files, where = _folder(spark, path)
    names = [s.getPath().getName() for s in files.listStatus(where)]
    return sorted(n.split("=", 1)[1] for n in names if n.startswith(f"{column}="))


def remove_partitions(spark: SparkSession, path: str, column: str, values: list[str]) -> None:
    for value in values:
        files, where = _folder(spark, f"{path}/{column}={value}")
        files.delete(where, True)


def register_external(
    spark: SparkSession, table: str, df_schema, path: str, fmt: str = "parquet", *, must_be_new: bool = False
) -> DataFrame:
    """Declare a table over existing files with the given columns."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df_schema.fields)
    guard = "" if must_be_new else "IF NOT EXISTS "
    spark.sql(f"CREATE TABLE {guard}{table} ({columns}) USING {fmt} LOCATION '{path}'")
    return spark.table(table)


def register_folder(spark: SparkSession, table: str, path: str, schema, partitions: list[str], fmt: str = "parquet") -> DataFrame:
    """Declare a table over dated folders that are there already, and register the folders as partitions."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(
        f"CREATE TABLE {table} ({columns}) USING {fmt} PARTITIONED BY ({', '.join(partitions)}) LOCATION '{path}'"
    )
    spark.sql(f"MSCK REPAIR TABLE {table}")
    return spark.table(table)


def register_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)


def run_sql(spark: SparkSession, text: str, **args: object) -> DataFrame:
    """SQL over the session's tables with named parameters; the result keeps its types."""
    return spark.sql(text, args=args)


def refresh_model(df: DataFrame, table: str, path: str | None = None) -> DataFrame:
    """Replace a model table by its newly computed rows."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static").format("parquet")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
    return df.sparkSession.table(table)


def keep_recent(df: DataFrame, day: str, as_of: Column, days: int) -> DataFrame:
    """Rows that are not older than the retention period."""
    return df.filter(F.col(day) >= F.date_sub(as_of, days))


def expire_partitions(spark: SparkSession, table: str, day: str, as_of: date, days: int) -> list[str]:
    """Drop the dated partitions of a managed table that are past retention.

    Only partition names come to the driver, one per day.
    """
    cutoff = (as_of - timedelta(days=days)).isoformat()
    names = [r[0] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()]
    old = sorted(n.split("=", 1)[1] for n in names if n.split("=", 1)[1] < cutoff)
    for value in old:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({day}='{value}')")
    return old


def expire_folders(spark: SparkSession, path: str, day: str, as_of: date, days: int) -> list[str]:
    """Remove the folders `<day>=<date>` of a table on files that are past retention; returns their dates."""
    cutoff = (as_of - timedelta(days=days)).isoformat()
    old = [v for v in partition_values(spark, path, day) if v < cutoff]
    remove_partitions(spark, path, day, old)
    return old


def expire_numbers(spark: SparkSession, path: str, column: str, first: int) -> list[str]:
    """Remove the folders `<column>=<number>` with a number from 0 up to before `first`."""
    old = [v for v in partition_values(spark, path, column) if 0 <= int(v) < first]
    remove_partitions(spark, path, column, old)
    return old
