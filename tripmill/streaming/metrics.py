"""Event-time window metrics of completed rides. The same function runs on a batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from tripmill.functions.numeric import half_up
from tripmill.schemas import COMPLETED
from tripmill.session import native_state
from tripmill.sources.batches import COMPACT_EVERY, latest, write_batches

WINDOW = "5 minutes"
WATERMARK = "10 minutes"
WINDOW_KEYS = ["window_start", "window_end"]


def window_metrics(
    events: DataFrame,
    *,
    ts: str = "event_timestamp",
    window: str = WINDOW,
    watermark: str = WATERMARK,
) -> DataFrame:
    """Count, mean fare, mean distance and highest surge per window; missing values are skipped.

    Distance is summed in whole metres, so the mean does not depend on the order of rows.
    """
    metres = half_up(F.col("distance_km") * 1000)
    n_km = F.nullif(F.count(metres), F.lit(0)).cast("double")
    n_fare = F.nullif(F.count("fare_cents"), F.lit(0)).cast("double")
    return (
        events.filter(F.col("event_type") == COMPLETED)
        .withColumn(ts, F.col(ts).cast("timestamp"))
        .withWatermark(ts, watermark)
        .groupBy(F.window(ts, window).alias("window"))
        .agg(
            F.count(F.lit(1)).alias("rides_completed_count"),
            (F.sum("fare_cents").cast("double") / n_fare).alias("avg_fare_cents"),
            (F.sum(metres).cast("double") / n_km / F.lit(1000.0)).alias("avg_distance_km"),
            F.max("surge_multiplier").alias("max_surge_multiplier"),
        )
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            "rides_completed_count",
            "avg_fare_cents",
            "avg_distance_km",
            "max_surge_multiplier",
        )
    )


def as_messages(metrics: DataFrame) -> DataFrame:
    """Window rows as JSON values for a topic."""
    return metrics.select(F.to_json(F.struct("*")).alias("value"))


def write_windows(metrics: DataFrame, path: str, checkpoint: str, compact_every: int = COMPACT_EVERY) -> DataStreamWriter:
    """Update mode into a table: each trigger writes changed windows anew, readers take the latest."""
    native_state(metrics.sparkSession)
    return write_batches(metrics, path, checkpoint, WINDOW_KEYS, compact_every)


def read_windows(spark: SparkSession, path: str, metrics: T.StructType) -> DataFrame:
    return latest(spark, path, metrics, WINDOW_KEYS)


def write_final_windows(metrics: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Append mode: a window is written once, after the watermark has passed it."""
    return (
        metrics.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
