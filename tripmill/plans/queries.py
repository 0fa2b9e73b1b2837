"""One query per operator, over the bindings of the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill import schemas
from tripmill.operators import (
    dims,
    facts,
    gold,
    history,
    increments,
    ingest,
    lifecycle,
    membership,
    pricing,
    quality,
    silver,
    state,
)
from tripmill.plans import bindings as bind
from tripmill.plans import medallion
from tripmill.session import SHUFFLES_END, kept, plain_times, release_shuffles, settings, work_dir
from tripmill.sources import compaction, files, tables
from tripmill.sources.bucketed import BucketedTable
from tripmill.streaming import events as stream_events
from tripmill.streaming import lifecycle as stream_lifecycle
from tripmill.streaming import metrics as stream_metrics
from tripmill.streaming import progress as stream_progress_table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

AS_OF = "2001-08-02"
SUMMARY_DAYS = 30
RETENTION_DAYS = 730
CHANGE_CUT = "1998-01-01"
REDELIVERED_FROM = "1997-07-01"
INCREMENT_CUTS = ("1995-01-01", "1997-01-01")
LANDING_BATCHES = 8
STREAM_BATCHES = 4
PII_SALT = "pepper"


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = lambda spark, sf_dir: plain_times(fn(spark, sf_dir))
    return fn


# Silver


@query
def silver_rides(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bind.silver(spark, sf_dir).select(*schemas.SILVER_COLUMNS)


@query
def silver_rides_by_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bind.silver(spark, sf_dir, silver.RIDE_EVENT_TIME_KEY).select(*schemas.SILVER_COLUMNS)


LINE_ORDER = (
    "l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus",
)
LINE_KEY = ("l_orderkey", "l_linenumber")


@query
def dedup_first_rownum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.first_occurrence(bind.table(spark, sf_dir, "lineitem"), LINE_KEY, LINE_ORDER)


@query
def dedup_first_minby(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.first_occurrence_by_min(
        bind.table(spark, sf_dir, "lineitem"), LINE_KEY, LINE_ORDER
    )


@query
def partition_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ingest.with_date_parts(bind.silver(spark, sf_dir), F.col("event_timestamp"))
    return rows.groupBy("year", "month", "day", "hour").agg(F.count(F.lit(1)).alias("events"))


# Gold


@query
def hourly_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.hourly_metrics(bind.silver(spark, sf_dir))


@query
def driver_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.driver_metrics(bind.silver(spark, sf_dir))


@query
def driver_metrics_nodistinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.driver_metrics(bind.silver(spark, sf_dir), unique_rides=True)


@query
def passenger_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.passenger_metrics(bind.silver(spark, sf_dir))


@query
def passenger_metrics_nodistinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.passenger_metrics(bind.silver(spark, sf_dir), unique_rides=True)


@query
def passenger_metrics_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.passenger_metrics_joined(bind.silver(spark, sf_dir), unique_rides=True)


@query
def rides_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.rides_summary(bind.silver(spark, sf_dir), unique_rides=True)


@query
def recent_summary_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = gold.rides_summary(bind.silver(spark, sf_dir), unique_rides=True)
    return gold.recent_summary(summary, AS_OF, SUMMARY_DAYS)


@query
def events_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = bind.table(spark, sf_dir, "events")
    cents = F.round(F.col("value") * 100).cast("bigint")
    return gold.counts_by_type(events.withColumn("fare_cents", cents)).orderBy("event_type")


@query
def global_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.revenue_totals(bind.silver(spark, sf_dir))


@query
def revenue_by_currency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Currency of a ride by its driver; a driver with both gets no total."""
    done = gold.completed(bind.silver(spark, sf_dir), "driver_id")
    euro = (F.col("ride_id").cast("bigint") % 2 == 0) & (F.col("driver_id").cast("bigint") % 3 == 0)
    paid = done.withColumn("currency", F.when(euro, "EUR"))
    return gold.money_by_currency(paid, "fare_cents", "driver_id")


@query
def batch_metrics_zero_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = bind.table(spark, sf_dir, "events").select(
        F.when(F.col("event_type") != "view", F.round(F.col("value") * 100)).alias("fare_cents"),
        F.when(F.col("event_type") != "click", (F.col("event_id") % 300) / F.lit(4.0)).alias(
            "distance_km"
        ),
        F.when(F.col("event_type") == "purchase", 1.0 + (F.col("user_id") % 9) / F.lit(4.0)).alias(
            "surge_multiplier"
        ),
    )
    return gold.batch_metrics(rows)


@query
def driver_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.leaderboard(gold.driver_daily_totals(bind.silver(spark, sf_dir)), "driver_id")


@query
def passenger_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.leaderboard(gold.passenger_daily_totals(bind.silver(spark, sf_dir)), "rider_id")


@query
def pipeline_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.pipeline_summary(bind.silver(spark, sf_dir))


@query
def gold_by_increments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly gold from parts by month after three increments: the early log, the latest one, then the one between.

    Some events of the first increment's months come late, with the last one.
    """
    typed = kept(silver.type_events(bind.bronze(spark, sf_dir)).drop("latitude", "longitude"), "typed")
    store = increments.DailyGold(spark, work_dir(spark, "gold"), part="month").create()
    first, second = (F.lit(c).cast("timestamp") for c in INCREMENT_CUTS)
    at, late = F.col("event_timestamp"), F.col("ride_id").cast("bigint") % 50 == 0
    store.apply(typed.filter((at < first) & ~late), stored=True)
    store.apply(typed.filter(at >= second), stored=True)
    store.apply(typed.filter((at >= first) & (at < second) | (at < first) & late), stored=True)
    return store.report("month")


@query
def trips_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.trips_daily(bind.silver(spark, sf_dir))


# Facts and dimensions


@query
def fact_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.fact_trip(bind.silver(spark, sf_dir))


@query
def fact_driver_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.fact_driver_daily(bind.silver(spark, sf_dir))


@query
def platform_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.platform_daily(bind.silver(spark, sf_dir))


ATTRIBUTES = ["vehicle_type", "active_flag"]


def _drivers(log: DataFrame) -> DataFrame:
    return dims.dim_driver(log, "driver_id", "changed_at", ATTRIBUTES, "entry")


@query
def dim_driver_scd2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _drivers(bind.change_log(spark, sf_dir))


@query
def scd2_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = bind.change_log(spark, sf_dir)
    cut = F.lit(CHANGE_CUT).cast("timestamp")
    old, new = log.filter(F.col("changed_at") < cut), log.filter(F.col("changed_at") >= cut)
    dim = dims.scd2(old, "driver_id", "changed_at", ATTRIBUTES, "entry")
    return dims.scd2_merge(dim, new, "driver_id", "changed_at", ATTRIBUTES, "entry")


@query
def scd2_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = gold.completed(bind.silver(spark, sf_dir)).select(
        "ride_id",
        F.col("rider_id").alias("driver_id"),
        F.to_date("event_timestamp").alias("ride_date"),
    )
    drivers = _drivers(bind.change_log(spark, sf_dir))
    return dims.scd2_lookup(
        done, drivers, "driver_id", "ride_date", "ride_id", ["driver_key", "vehicle_type"]
    )


def _riders(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = bind.change_log(spark, sf_dir).withColumnRenamed("driver_id", "rider_id")
    return dims.dim_rider(log, "rider_id", "changed_at", ATTRIBUTES, "entry")


@query
def dim_rider(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _riders(spark, sf_dir)


@query
def dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.dim_date(bind.silver(spark, sf_dir), "event_timestamp")


@query
def dim_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.dim_time(bind.silver(spark, sf_dir), "event_timestamp")


@query
def dim_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.dim_location(bind.rides(spark, sf_dir))


@query
def fact_rides_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rides are written once, as the star reads them for frequent ids and again for the joins."""
    outcomes = facts.ride_outcomes(bind.silver(spark, sf_dir))
    places = bind.rides(spark, sf_dir).select(
        "ride_id", "pickup_lat", "pickup_lon", "dropoff_lat", "dropoff_lon"
    )
    path = work_dir(spark, "rides")
    outcomes.join(places, "ride_id").write.parquet(path)
    return dims.fact_rides(
        spark.read.parquet(path),
        _drivers(bind.change_log(spark, sf_dir)),
        _riders(spark, sf_dir),
    )


@query
def pii_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = bind.table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return dims.hash_names(customers, ["c_name"], PII_SALT)


# Ingest and validation


@query
def flatten_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = ingest.flatten(bind.domain_messages(spark, sf_dir))
    return flat.select(*schemas.BRONZE.names)


@query
def rebuild_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.nest(bind.bronze(spark, sf_dir).select(*schemas.ENVELOPE, "rider_id", "driver_id",
                                                         "fare_cents", "distance_meters"))


@query
def publish_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = bind.bronze(spark, sf_dir).select(*schemas.ENVELOPE, "rider_id", "driver_id", "fare_cents")
    return ingest.keyed_messages(rows)


@query
def event_id_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    wrong = pricing.check_event_ids(bind.silver(spark, sf_dir))
    return wrong.select("ride_id", "event_type", "event_timestamp", "event_id", "expected_id")


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bind.ride_messages(bind.table(spark, sf_dir, "events"))


@query
def payload_validate_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = ingest.check_payload(ingest.parse_messages(_messages(spark, sf_dir)))
    return ingest.valid_rows(checked).select("offset", *schemas.ENVELOPE)


@query
def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = ingest.check_payload(ingest.parse_messages(_messages(spark, sf_dir)))
    rejects = ingest.dead_letters(checked, at=F.col("ts"))
    return rejects.select(
        "offset", "event_id", "ride_id", "raw_text", "_error", "_dlq_timestamp"
    )


@query
def ride_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejects = ingest.rejected_rows(ingest.check_ride(bind.rides(spark, sf_dir)))
    return rejects.select("ride_id", F.array_join(ingest.REASONS, ";").alias("reasons"))


@query
def unseen_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of the log whose id was not among the requests received before."""
    log = bind.bronze(spark, sf_dir).select("event_id", "ride_id", "event_type", "timestamp")
    seen = log.filter(F.col("event_type") == schemas.REQUESTED)
    return state.unseen(log, seen, "event_id", ["timestamp", "ride_id", "event_type"])


@query
def unseen_by_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events from a day on whose id did not come before it: the history is kept by year, with bitmaps."""
    log = kept(bind.bronze(spark, sf_dir).select("event_id", "ride_id", "event_type", "timestamp"), "bronze")
    path = work_dir(spark, "seen")
    history = membership.SeenIds(spark, path, bits=membership.bits_for(log.count())).create()
    before = log.filter(F.col("timestamp") < CHANGE_CUT).withColumn("year", F.substring("timestamp", 1, 4).cast("int"))
    # One year per batch comes to the driver.
    for (year,) in sorted(before.select("year").distinct().collect()):
        history.remember(before.filter(F.col("year") == year), "event_id", year)
    arrived = log.filter(F.col("timestamp") >= REDELIVERED_FROM)
    return history.unseen(arrived, "event_id", ["timestamp", "ride_id", "event_type"])


@query
def payload_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields of the payloads by event type, with the months since and until which they come."""
    month = F.substring("timestamp", 1, 7)
    return ingest.payload_drift(bind.domain_messages(spark, sf_dir).withColumn("month", month), "month", "event_type")


# Pricing


@query
def trip_distance_by_driver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pricing.distance_by_driver(bind.trips(spark, sf_dir))


@query
def fare_audit_service(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pricing.fare_audit_by_driver_day(pricing.audit_fares(bind.trips(spark, sf_dir), "service"))


@query
def fare_audit_minimum(spark: SparkSession, sf_dir: str) -> DataFrame:
    audited = pricing.audit_fares(bind.trips(spark, sf_dir), "minimum")
    return audited.select("ride_id", "fare_cents", "expected_cents", "difference_cents", "verdict")


@query
def fare_estimate_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pricing.estimate_error(bind.trips(spark, sf_dir))
    return rows.select("ride_id", "fare_cents", "estimated_cents", "error_cents")


@query
def distance_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pricing.audit_distances(bind.trips(spark, sf_dir))
    return rows.select("ride_id", "straight_km", "recorded_km", "off_tolerance")


@query
def surge_by_cell(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pricing.demand_surge(bind.silver(spark, sf_dir), cells_per_degree=2, window="1 day")


# Lifecycle and ride state


@query
def lifecycle_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lifecycle.violations(bind.silver(spark, sf_dir))


@query
def lifecycle_violations_by_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """On a log that still has later redeliveries, each of which repeats a step."""
    return lifecycle.violations(bind.silver(spark, sf_dir, silver.RIDE_EVENT_TIME_KEY))


@query
def rides_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lifecycle.rides_current(bind.silver(spark, sf_dir))


@query
def rides_in_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lifecycle.rides_in_error(bind.silver(spark, sf_dir))


@query
def rides_by_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rides in a table split by status, of which one folder is read."""
    rides = lifecycle.with_status_flags(lifecycle.rides_current(bind.silver(spark, sf_dir)))
    path = work_dir(spark, "rides")
    rides.hint("rebalance", F.col("status")).write.partitionBy("status").parquet(path)
    return state.find(spark.read.parquet(path), "status", "in_progress").select(
        "ride_id", "status", "is_active", "is_terminal", "estimated_distance_km"
    )


STATE_COLUMNS = ("ride_id", "status", "driver_id", "distance_km", "fare_cents", "completed_at")


def _ride_table(spark: SparkSession) -> BucketedTable:
    return BucketedTable(spark, f"rides_{uuid.uuid4().hex}", "ride_id")


def _stored_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The typed log, stored once for queries that read it several times."""
    return kept(bind.silver(spark, sf_dir), "silver")


@query
def ride_state_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """States as of a date, then the states of all rides with later events put over them."""
    events = _stored_silver(spark, sf_dir)
    cut = F.lit(CHANGE_CUT).cast("timestamp")
    later = events.filter(F.col("event_timestamp") >= cut).select("ride_id")
    table = _ride_table(spark)
    table.save(lifecycle.rides_current(events.filter(F.col("event_timestamp") < cut)).select(*STATE_COLUMNS))
    table.save(lifecycle.rides_current(state.find_many(events, "ride_id", later)).select(*STATE_COLUMNS))
    return table.read()


@query
def ride_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _ride_table(spark)
    table.save(lifecycle.rides_current(bind.silver(spark, sf_dir)).select(*STATE_COLUMNS))
    table.delete(state.find(table.read(), "status", "cancelled"))
    return table.read()


@query
def ride_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ride with the greatest id, looked up by its id after two saves."""
    table = _ride_table(spark)
    rides = kept(lifecycle.rides_current(bind.silver(spark, sf_dir)).select(*STATE_COLUMNS), "rides")
    table.save(rides.withColumn("status", F.lit("stale")))
    table.save(rides)
    wanted = table.read().agg(F.max("ride_id")).first()[0]
    return table.find(wanted)


@query
def event_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full histories of the rides that cannot be replayed, from a log that is stored once."""
    log = kept(bind.bronze(spark, sf_dir), "bronze")
    wanted = lifecycle.rides_in_error(silver.to_silver(log, keep=bind.TRIP_FIELDS))
    return history.event_history(log.select(*schemas.ENVELOPE, "rider_id", "driver_id", "fare_cents"), rides=wanted)


# Quality


@query
def dq_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All declared checks; those of rows are counted while the layers are written."""
    return medallion.written_summary(bind.bronze(spark, sf_dir), work_dir(spark, "layers"))


@query
def dq_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of silver that break a bound, each with the checks it breaks."""
    checks = [c for c in quality.silver_checks() if c.name.endswith(("bounds", "negative"))]
    names = F.array_compact(F.array(*[F.when(c.broken, F.lit(c.name)) for c in checks]))
    rows = bind.silver(spark, sf_dir).withColumn("checks", F.array_join(names, ";"))
    return rows.filter(F.col("checks") != "").select(
        "ride_id", "event_type", "fare_cents", "distance_km", "checks"
    )


@query
def dq_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.duplicate_keys(bind.bronze(spark, sf_dir), "event_id")


@query
def dq_unique_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that share order and line number."""
    return quality.duplicate_keys(bind.table(spark, sf_dir, "lineitem"), *LINE_KEY)


@query
def dq_relationships(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders that no line refers to, and line keys without an order, in both directions."""
    orders, lines = bind.table(spark, sf_dir, "orders"), bind.table(spark, sf_dir, "lineitem")
    idle = quality.orphans(orders, "o_orderkey", lines, "l_orderkey")
    lost = quality.orphans(lines, "l_orderkey", orders, "o_orderkey")
    return idle.select(F.lit("orders").alias("side"), F.col("o_orderkey").alias("key"), "rows").union(
        lost.select(F.lit("lineitem"), "l_orderkey", "rows")
    )


def _typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.type_events(bind.bronze(spark, sf_dir))


@query
def reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.to_date("event_timestamp")
    return quality.reconcile_counts(
        _typed(spark, sf_dir).withColumn("event_date", day),
        bind.silver(spark, sf_dir).withColumn("event_date", day),
        "event_date",
    )


@query
def reconcile_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    rides = bind.silver(spark, sf_dir)
    summary = gold.rides_summary(rides).withColumnRenamed("total_revenue_cents", "cents")
    return quality.reconcile_totals(
        summary, gold.completed(rides).withColumnRenamed("fare_cents", "cents"), "cents"
    )


@query
def id_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.id_difference(bind.bronze(spark, sf_dir), bind.silver(spark, sf_dir), "event_id")


@query
def stage_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per month, whether deduplication changed the log, by digests of its rows."""
    month = F.to_date(F.date_trunc("month", "event_timestamp"))
    typed = _typed(spark, sf_dir).withColumn("event_month", month)
    once = bind.silver(spark, sf_dir).withColumn("event_month", month)
    return quality.stage_changes(typed, once, "event_month", "event_id", "ride_id", "event_type")


@query
def driver_event_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Declared checks of driver events: those that carry a driver, and requests, which have none yet."""
    log = bind.bronze(spark, sf_dir).select("event_id", "driver_id")
    return quality.summarise_rows(log, "driver_events", quality.driver_event_checks())


@query
def date_range_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events outside of the dates that a report covers."""
    check = quality.date_range_check("event_date", "1996-01-01", AS_OF)
    dated = bind.silver(spark, sf_dir).withColumn("event_date", F.to_date("event_timestamp"))
    return quality.violations(dated, check).groupBy("event_date").agg(F.count(F.lit(1)).alias("events"))


@query
def recency(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = bind.table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return quality.recency(events, "ts", F.lit("2024-02-01 00:00:00").cast("timestamp"), 86400)


@query
def stage_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _arrivals(bind.table(spark, sf_dir, "events"))
    return quality.stage_lag(rows, "ts", "arrived_at")


# Tables and files


@query
def retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = bind.silver(spark, sf_dir).withColumn("event_date", F.to_date("event_timestamp"))
    kept = tables.keep_recent(rows, "event_date", F.to_date(F.lit(AS_OF)), RETENTION_DAYS)
    return kept.select("event_id", "ride_id", "event_type", "event_date")


def _marked_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log with rows that no layer can take."""
    k = F.col("ride_id").cast("bigint")
    return bind.bronze(spark, sf_dir).withColumns(
        {
            "event_id": F.when(k % 7 != 0, F.col("event_id")),
            "event_type": F.when(k % 13 == 0, "ride_teleported").otherwise(F.col("event_type")),
            "timestamp": F.when(k % 11 == 0, "soon").otherwise(F.col("timestamp")),
        }
    )


@query
def layer_rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Layers built from the whole log and then from its earlier part: nothing of the first build is left."""
    base = work_dir(spark, "layers")
    log = kept(bind.bronze(spark, sf_dir), "bronze")
    medallion.build(spark, log, base, "month")
    built = medallion.build(spark, log.filter(F.col("timestamp") < CHANGE_CUT), base, "month")
    day = F.to_date("event_timestamp").alias("event_date")
    return built["stg_rides"].groupBy(day, "event_type").agg(F.count(F.lit(1)).alias("events"))


@query
def build_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a build sets aside, with reasons."""
    log = kept(_marked_bronze(spark, sf_dir), "bronze")
    built = medallion.build(spark, log, work_dir(spark, "layers"), "month")
    return built["rejects"].select("event_id", "ride_id", "event_type", "_error")


def _dated_silver(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    rows = bind.silver(spark, sf_dir).select("event_id", "ride_id", "event_type", "event_timestamp")
    path = work_dir(spark, "silver")
    rows = rows.withColumn("event_month", F.trunc("event_timestamp", "month"))
    files.write_partitioned(rows, path, "event_month")
    return path, rows


@query
def layer_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored layer after its folders past retention are removed."""
    path, _ = _dated_silver(spark, sf_dir)
    tables.expire_folders(spark, path, "event_month", date.fromisoformat(AS_OF), RETENTION_DAYS)
    return spark.read.parquet(path).groupBy("event_month").agg(F.count(F.lit(1)).alias("events"))


@query
def registered_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dated folders that are there already, declared as a table and registered as its partitions."""
    path, rows = _dated_silver(spark, sf_dir)
    name = f"silver_{uuid.uuid4().hex}"
    found = tables.register_folder(spark, name, path, rows.schema, ["event_month"])
    return found.groupBy("event_month").agg(F.count(F.lit(1)).alias("events"))


VIEW_FROM = 1996
VIEW_SQL = """
    SELECT year(event_timestamp) AS event_year, event_type, count(*) AS events, count(DISTINCT ride_id) AS rides
    FROM {view} WHERE year(event_timestamp) >= :first GROUP BY ALL
"""
BY_TYPE_SQL = """
    SELECT event_type, count(*) AS events, sum(fare_cents) AS total_cents
    FROM {table} WHERE fare_cents >= :least GROUP BY event_type
"""


@query
def event_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw log appended to the event store in two parts, in folders by month, read back."""
    path = work_dir(spark, "store")
    month = F.to_date(F.trunc(F.to_date(F.substring("timestamp", 1, 10)), "month"))
    log = kept(bind.bronze(spark, sf_dir).select("event_id", "ride_id", "event_type", "timestamp"), "bronze")
    log = log.withColumn("event_month", month)
    for part in (F.col("timestamp") < CHANGE_CUT, F.col("timestamp") >= CHANGE_CUT):
        files.append_events(files.rebalanced(log.filter(part), "event_month"), path, ("event_month",))
    return spark.read.parquet(path).groupBy("event_month", "event_type").agg(
        F.count(F.lit(1)).alias("events"), F.countDistinct("event_id").alias("ids")
    )


@query
def file_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed JSON lines with the file that each row came from and its load time, counted by landing folder."""
    path = work_dir(spark, "landed")
    log = bind.bronze(spark, sf_dir).select(*schemas.BRONZE.names)
    log.withColumn("batch", F.substring("timestamp", 1, 4)).hint("rebalance", F.col("batch")).write.partitionBy("batch").json(
        path, compression="gzip"
    )
    rows = ingest.with_lineage(files.read_ndjson(spark, path))
    named = rows.withColumn("batch", F.regexp_extract("_source_file", "/batch=([0-9]+)/", 1))
    return named.groupBy("batch").agg(
        F.count(F.lit(1)).alias("events"),
        F.count_if(F.substring("timestamp", 1, 4) == F.col("batch")).alias("in_place"),
        F.countDistinct("_loaded_at").alias("loads"),
    )


@query
def load_stamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each built layer, and how many of them have no load stamp or one from before the build."""
    base, log = work_dir(spark, "layers"), kept(bind.bronze(spark, sf_dir), "bronze")
    before = spark.range(1).select(F.current_timestamp()).first()[0]
    built = medallion.build(spark, log, base, "month")
    names = ("stg_rides", "stg_metrics", "rides_summary", "driver_metrics", "passenger_metrics")
    parts = [built[name].select(F.lit(name).alias("layer"), "_loaded_at") for name in names]
    return reduce(DataFrame.unionByName, parts).groupBy("layer").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("_loaded_at").isNull() | (F.col("_loaded_at") < F.lit(before))).alias("unstamped"),
    )


@query
def silver_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver under a name of its own, read with SQL."""
    name = f"silver_{uuid.uuid4().hex}"
    tables.register_view(bind.silver(spark, sf_dir), name)
    return tables.run_sql(spark, VIEW_SQL.format(view=name), first=VIEW_FROM)


@query
def gold_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Driver metrics written as JSON lines for a dashboard, read back."""
    metrics = gold.driver_metrics(bind.silver(spark, sf_dir))
    path = work_dir(spark, "extract")
    files.write_extract(metrics, path)
    return spark.read.schema(metrics.schema).json(path)


@query
def parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver written as Parquet, declared as a table and read with SQL."""
    rows = bind.silver(spark, sf_dir).select(*schemas.SILVER_COLUMNS)
    path, name = work_dir(spark, "silver"), f"silver_{uuid.uuid4().hex}"
    rows.write.parquet(path)
    tables.register_external(spark, name, rows.schema, path)
    result = tables.run_sql(spark, BY_TYPE_SQL.format(table=name), least=0)
    spark.sql(f"DROP TABLE {name}")
    return result


@query
def ndjson_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze written as JSON lines and read with the declared schema."""
    path = work_dir(spark, "bronze")
    bind.bronze(spark, sf_dir).select(*schemas.BRONZE.names).write.json(path, compression="gzip")
    return files.read_ndjson(spark, path).select(*schemas.BRONZE.names)


# Streams


def _arrivals(events: DataFrame) -> DataFrame:
    late = F.make_dt_interval(mins=(F.col("user_id") % 20).cast("int"))
    ts = F.col("ts").cast("timestamp")
    return events.withColumns({"ts": ts, "arrived_at": ts + late})


@query
def window_5min_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid = ingest.valid_rows(stream_events.checked_messages(_messages(spark, sf_dir)))
    typed = silver.type_events(valid, keep=("surge_multiplier",))
    return stream_metrics.window_metrics(silver.derive_units(typed))


def _event_stream(spark: SparkSession, sf_dir: str, max_files: int | None = None) -> DataFrame:
    schema = bind.table(spark, sf_dir, "events").schema
    return files.stream_table(spark, f"{sf_dir}/events.parquet", schema, max_files)


@query
def window_5min_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same windows from a stream of files, in update mode into a table."""
    messages = bind.ride_messages(_event_stream(spark, sf_dir))
    valid = ingest.valid_rows(stream_events.checked_messages(messages))
    typed = silver.derive_units(silver.type_events(valid, keep=("surge_multiplier",)))
    path, metrics = work_dir(spark, "windows"), stream_metrics.window_metrics(typed)
    stream_events.run_available(stream_metrics.write_windows(metrics, path, work_dir(spark, "offsets")))
    return stream_metrics.read_windows(spark, path, metrics.schema)


@query
def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of a stream in which some are delivered twice."""
    copies = F.when(F.col("user_id") % 3 == 0, F.array(F.lit(0), F.lit(1))).otherwise(
        F.array(F.lit(0))
    )
    twice = _event_stream(spark, sf_dir).withColumn("copy", F.explode(copies)).drop("copy")
    path = work_dir(spark, "events")
    once = stream_events.drop_redelivered(twice, ts="ts")
    stream_events.run_available(
        once.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", work_dir(spark, "offsets"))
    )
    return spark.read.parquet(path)


@query
def stream_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the recorded progress tells of a stream that removes redelivered events."""
    path, name = work_dir(spark, "progress"), f"dedup_{uuid.uuid4().hex}"
    listener = stream_progress_table.ProgressTable(spark, path, {name})
    once = stream_events.drop_redelivered(_event_stream(spark, sf_dir), ts="ts")
    writer = once.writeStream.format("parquet").queryName(name).option("path", work_dir(spark, "events"))
    spark.streams.addListener(listener)
    try:
        run = stream_events.run_available(writer.option("checkpointLocation", work_dir(spark, "offsets")))
        if not listener.wait_for(run):
            raise TimeoutError("the progress of the stream was not reported")
    finally:
        spark.streams.removeListener(listener)
    told = stream_progress_table.freshness(stream_progress_table.read_progress(spark, path))
    return told.withColumn("query", F.regexp_extract("query", "^[a-z]+", 0))


@query
def late_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stream_events.late_rows(_arrivals(bind.table(spark, sf_dir, "events")), "ts", "arrived_at")
    return rows.select("event_id", "ts", "arrived_at", "lateness_seconds")


LANDED = (
    "event_id", "ride_id", "event_type", "driver_id", "fare_cents", "distance_meters", "surge_multiplier",
    "year", "month", "day",
)


@query
def landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid messages of a stream as compressed JSON files in dated folders, read back."""
    messages = bind.ride_messages(_event_stream(spark, sf_dir))
    path = work_dir(spark, "landing")
    stream_events.run_available(stream_events.land_valid(messages, path, work_dir(spark, "offsets")))
    landed = files.read_ndjson(spark, path).drop(schemas.CORRUPT)
    return landed.select(*LANDED)


@query
def landing_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages landed in eight batches of small files, packed by size into few, read back."""
    source, path, out = (work_dir(spark, name) for name in ("events", "landing", "archive"))
    events = bind.table(spark, sf_dir, "events")
    events.repartition(LANDING_BATCHES, "event_id").write.parquet(source)
    messages = bind.ride_messages(files.stream_files(spark, source, events.schema, max_files=1))
    stream_events.run_available(stream_events.land_valid(messages, path, work_dir(spark, "offsets")))
    compaction.compact_lines(spark, path, out, ["year", "month", "day"])
    return files.read_ndjson(spark, out).select(*LANDED)


@query
def landing_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The messages that the landing stream rejects, read back with their reasons."""
    path = work_dir(spark, "rejects")
    stream = bind.ride_messages(_event_stream(spark, sf_dir))
    stream_events.run_available(stream_events.land_rejected(stream, path, work_dir(spark, "offsets")))
    kept = "event_id string, ride_id string, raw_text string, _error string"
    return spark.read.schema(kept).json(path)


@query
def stream_rides_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver events as a stream of several micro-batches, rides kept in streaming state.

    The number of files follows the data, so that none gets large; a micro-batch takes its share of them. The shuffle
    that removes redeliveries deals the events by ride and type, so it makes the files too.
    """
    source, tasks = work_dir(spark, "silver"), max(STREAM_BATCHES, bind.log_tasks(spark, sf_dir))
    events = bind.silver(spark, sf_dir)
    one_file_a_task = {
        "spark.sql.shuffle.partitions": str(tasks), "spark.sql.adaptive.coalescePartitions.enabled": "false", **SHUFFLES_END,
    }
    with settings(spark, one_file_a_task):
        events.write.option("compression", "zstd").parquet(source)
    stream = files.stream_files(spark, source, events.schema, max_files=-(-tasks // STREAM_BATCHES))
    path = work_dir(spark, "rides")
    stream_events.run_available(stream_lifecycle.write_rides(stream, path, work_dir(spark, "offsets")))
    release_shuffles(spark)
    return stream_lifecycle.read_rides(spark, path, events.schema).filter(F.col("error").isNull()).drop("error")


@query
def stream_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rides of a stream that stops after half of the files, starts again with the rest, and once more with none."""
    source, path, offsets = (work_dir(spark, name) for name in ("silver", "rides", "offsets"))
    with settings(spark, SHUFFLES_END):
        events = _stored_silver(spark, sf_dir)
    for half in (0, 1, None):
        if half is not None:
            events.filter(F.pmod(F.xxhash64("event_id"), F.lit(2)) == half).write.mode("append").option(
                "compression", "zstd"
            ).parquet(source)
        stream = files.stream_files(spark, source, events.schema)
        stream_events.run_available(stream_lifecycle.write_rides(stream, path, offsets))
        release_shuffles(spark)
    return stream_lifecycle.read_rides(spark, path, events.schema).filter(F.col("error").isNull()).drop("error")


@query
def demand_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests per grid cell and five minutes."""
    return pricing.demand_surge(bind.silver(spark, sf_dir))


