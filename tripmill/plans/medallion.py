"""The whole batch pipeline: bronze to silver to gold, with checks, in order of lineage."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tripmill.operators import gold
from tripmill.operators.ingest import REASONS, check_event, check_payload, dead_letters, valid_rows
from tripmill.operators.quality import (
    RowCheck,
    beyond_limits,
    bronze_checks,
    not_null,
    observed,
    observed_summary,
    silver_checks,
    summarise_rows,
    summarise_unique,
)
from tripmill.operators.silver import stamp_loaded, to_silver
from tripmill.schemas import COMPLETED, CORRUPT
from tripmill.sources.files import rebalanced
from tripmill.sources.tables import is_folder, partition_values, remove_partitions

GOLD_MODELS = {
    "stg_metrics": gold.hourly_metrics,
    "rides_summary": lambda s: gold.rides_summary(s, unique_rides=True),
    "driver_metrics": lambda s: gold.driver_metrics(s, unique_rides=True),
    "passenger_metrics": lambda s: gold.passenger_metrics(s, unique_rides=True),
}

#: What the gold models read of silver: these columns of its completed rides.
GOLD_COLUMNS = ("event_type", "event_timestamp", "rider_id", "driver_id", "fare_cents", "distance_km")


def split_bronze(bronze: DataFrame) -> tuple[DataFrame, DataFrame, Observation]:
    """Rows that silver can take, the others with their reasons as `_error`, and how many others a read of the first passed by.

    Rejected are unreadable lines, rows without event or ride id, unknown types and unreadable times.
    """
    checked = check_event(check_payload(bronze))
    counted, seen = observed(checked, [RowCheck("rejected", REASONS, F.size(REASONS) > 0)])
    return valid_rows(counted).drop(CORRUPT), dead_letters(checked), seen


def without_rejects(seen: Observation) -> bool:
    """Whether silver, which must have rows, was made from a log without a single reject.

    A plan that is found to be empty counts nothing; rows of a task that ran again count twice, which never makes rejects none.
    """
    return seen.get["c0"] == 0


COUNTED = {
    "stg_metrics": ("metric_hour", "rides_completed_count"),
    "rides_summary": ("ride_date", "rides_completed"),
    "driver_metrics": ("driver_id", "rides_completed"),
    "passenger_metrics": ("passenger_id", "rides_taken"),
}


def row_checks(table: str) -> list[RowCheck]:
    """The declared checks of single rows of a layer."""
    if table == "ride_events":
        return bronze_checks()
    return silver_checks() if table == "stg_rides" else [not_null(c) for c in COUNTED[table]]


class LayerRejectedError(ValueError):
    """More rows of a layer break a check than its limit allows."""


def checked_write(df: DataFrame, table: str, write: Callable[[DataFrame], None]) -> DataFrame:
    """Write a table and count its row checks in the same pass; returns their summary."""
    checks = row_checks(table)
    rows, seen = observed(df, checks)
    write(rows)
    return observed_summary(df.sparkSession, seen, table, checks)


LAYERS = ("rejects", "checks", "stg_rides", *GOLD_MODELS)
VERSIONS = "versions"


def finished(spark: SparkSession, base: str) -> list[int]:
    """Numbers of the versions that were built to the end and are still kept, the oldest first."""
    if not is_folder(spark, f"{base}/{VERSIONS}"):
        return []
    rows = spark.read.schema("version long").parquet(f"{base}/{VERSIONS}")
    kept = set(partition_values(spark, base, "version"))
    return sorted(r["version"] for r in rows.distinct().collect() if str(r["version"]) in kept)


def build(
    spark: SparkSession, bronze: DataFrame, base: str, period: str = "day", limits: dict[str, float] | None = None
) -> dict[str, DataFrame]:
    """Build all layers anew in a version folder of their own; returns the written tables.

    Nothing of an earlier version is read or kept in the new one: silver by event date (the day, or the
    first day of a longer `period`), the rejects of bronze with reasons, and every gold model from silver. Silver is
    read once for its completed rides, which are stored in the version folder for all models.
    The version counts once it is entered in the table of versions, after all of it is written, so a build that
    stops half way leaves the last one in force. Row checks are counted while the layers are written and kept as
    `checks`; `limits` gives the share of rows that may break a check, and beyond one the version does not count. The version before it is kept for its readers, older ones
    and unfinished ones are removed. Silver and rejects together have every row of bronze but the redeliveries.
    """
    done = finished(spark, base)
    found = [int(v) for v in partition_values(spark, base, "version")] if is_folder(spark, base) else []
    number = max(found, default=-1) + 1
    version = f"{base}/version={number}"
    good, bad, seen = split_bronze(bronze)
    dated = stamp_loaded(to_silver(good)).withColumn("event_date", F.to_date(F.date_trunc(period, "event_timestamp")))
    path = f"{version}/stg_rides"
    checks = [
        checked_write(
            rebalanced(dated, "event_date", ("ride_id", "event_timestamp")), "stg_rides",
            lambda rows: rows.write.partitionBy("event_date").parquet(path),
        )
    ]
    # Where no row was rejected on the way to silver, the table of rejects is written without another read of bronze.
    none = bool(partition_values(spark, path, "event_date")) and without_rejects(seen)
    stamp_loaded(bad.limit(0) if none else bad).write.parquet(f"{version}/rejects")
    rides = spark.read.parquet(path).filter(F.col("event_type") == COMPLETED).select(*GOLD_COLUMNS)
    rides.write.option("compression", "zstd").parquet(f"{version}/completed")
    completed = spark.read.schema(rides.schema).parquet(f"{version}/completed")
    for name, model in GOLD_MODELS.items():
        checks.append(checked_write(stamp_loaded(model(completed)), name, lambda rows, name=name: rows.write.parquet(f"{version}/{name}")))
    summary = reduce(DataFrame.unionByName, checks)
    stamp_loaded(summary.coalesce(1)).write.parquet(f"{version}/checks")
    broken = beyond_limits(spark.read.parquet(f"{version}/checks"), limits or {}).collect()
    if broken:
        raise LayerRejectedError(", ".join(f"{r['table']}.{r['check']}({r['column']}): {r['violations']} of {r['total']}" for r in broken))
    spark.range(number, number + 1).select(F.col("id").alias("version")).write.mode("append").parquet(f"{base}/{VERSIONS}")
    remove_partitions(spark, base, "version", [str(n) for n in found if n not in done[-1:]])
    return read_layers(spark, base)


def read_layers(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    """The tables of the newest version."""
    version = f"{base}/version={finished(spark, base)[-1]}"
    return {name: spark.read.parquet(f"{version}/{name}") for name in LAYERS}


UNIQUE_CHECKS: dict[str, tuple[tuple[str, ...], bool]] = {
    "ride_events": (("event_id",), False),
    "stg_rides": (("event_id",), False),
    "rides_summary": (("ride_date", "driver_id", "passenger_id"), True),
    "driver_metrics": (("driver_id",), False),
    "passenger_metrics": (("passenger_id",), False),
}


def _unique(tables: dict[str, DataFrame]) -> list[DataFrame]:
    return [summarise_unique(tables[t], t, *keys, nulls_too=nulls) for t, (keys, nulls) in UNIQUE_CHECKS.items()]


def quality_summary(bronze: DataFrame, models: dict[str, DataFrame] | None = None) -> DataFrame:
    """A row per declared check over all layers. Pass the written models to read instead of compute.

    Each table is read by several checks, so both inputs should be stored tables.
    """
    if models is None:
        silver = to_silver(bronze)
        models = {"stg_rides": silver} | {n: model(silver) for n, model in GOLD_MODELS.items()}
    tables = {"ride_events": bronze} | {t: models[t] for t in ("stg_rides", *GOLD_MODELS)}
    rows = [summarise_rows(df, t, row_checks(t)) for t, df in tables.items()]
    return reduce(DataFrame.unionByName, [*rows, *_unique(tables)])


def written_summary(bronze: DataFrame, base: str) -> DataFrame:
    """The same summary of layers that are written to `base` by it.

    Row checks are counted within the writes. Only uniqueness reads a written table, once each.
    """
    spark, parts, tables = bronze.sparkSession, [], {}

    def put(df: DataFrame, table: str) -> DataFrame:
        parts.append(checked_write(df, table, lambda rows: rows.write.parquet(f"{base}/{table}")))
        tables[table] = spark.read.parquet(f"{base}/{table}")
        return tables[table]

    silver = put(to_silver(put(bronze, "ride_events")), "stg_rides")
    for name, model in GOLD_MODELS.items():
        put(model(silver), name)
    return reduce(DataFrame.unionByName, [*parts, *_unique(tables)])
