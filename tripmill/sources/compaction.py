"""Small landed files packed by their size into files of about one size, partition by partition.

File sizes come from the listing, no content is read for the plan. Within a partition files are put in order of path and
cut where the sum of their sizes passes the next multiple of the target, so a pack holds less than the target and
one file more. Every pack is a task, and every task writes one file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

TARGET_BYTES = 64 << 20


def listed_files(spark: SparkSession, path: str, partitions: list[str], pattern: str = "part-*") -> DataFrame:
    """(file, bytes and the partition columns) of each file; only the listing is read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
    missing = [c for c in partitions if c not in files.columns]
    if missing:
        raise ValueError(f"{path} is not partitioned by {', '.join(missing)}")
    return files.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes"), *partitions)


def packs(files: DataFrame, partitions: list[str], target_bytes: int = TARGET_BYTES) -> DataFrame:
    """The files with `pack`, numbered from 0 over all partitions without gaps.

    The numbers are spread by counts per partition, one row each, so no window runs over all files.
    """
    inside = Window.partitionBy(*partitions).orderBy("file")
    before = F.sum("bytes").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("bytes")
    cut = files.withColumn("_step", F.floor(before / F.lit(target_bytes)))
    dense = cut.withColumn("_own", F.dense_rank().over(Window.partitionBy(*partitions).orderBy("_step")) - 1)
    # One row per partition: the only ones that a single task puts in order.
    counts = dense.groupBy(*partitions).agg((F.max("_own") + 1).alias("_packs"))
    total = F.sum("_packs").over(Window.orderBy(*partitions).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    first = counts.select(*[F.col(c).alias(f"_k_{c}") for c in partitions], (total - F.col("_packs")).alias("_first"))
    same = [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in partitions]
    return dense.join(first, same).select("file", "bytes", *partitions, (F.col("_first") + F.col("_own")).cast("int").alias("pack"))


def compact_lines(
    spark: SparkSession,
    path: str,
    out: str,
    partitions: list[str],
    target_bytes: int = TARGET_BYTES,
    compression: str = "gzip",
) -> int:
    """Copy a folder of line files (JSON lines, possibly compressed) into few files under `out`; returns their number.

    Whole partitions of `out` are replaced once all of them are written, so a job that stops changes nothing and a second
    run gives the same rows. The landed files stay, as a stream's own log names them; retention removes them.
    """
    packed = packs(listed_files(spark, path, partitions), partitions, target_bytes)
    number = packed.agg(F.max("pack")).first()[0]
    if number is None:
        return 0
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"))
    placed = lines.join(packed.select("file", "pack", *partitions), "file")
    (
        placed.repartitionById(number + 1, F.col("pack"))
        .select("value", *partitions)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", compression)
        .partitionBy(*partitions)
        .text(out)
    )
    return number + 1
