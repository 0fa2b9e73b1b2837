"""Dimensions: type-2 history, current state, calendar and place, and the star fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmill.functions.geo import grid_cell
from tripmill.functions.keys import UNKNOWN_KEY, date_key, hashed, surrogate_key, time_key
from tripmill.operators.facts import SLA_SECONDS
from tripmill.operators.skew import HOT_SPLITS, frequent_keys, lookup_join


def _daily_state(log: DataFrame, key: str, ts: str, attributes: list[str], tie: str) -> DataFrame:
    """The last state of each key on each day. One key has at most one row per calendar day."""
    last = F.max(F.struct(F.col(ts), F.col(tie), *attributes)).alias("_last")
    return (
        log.groupBy(key, F.to_date(ts).alias("effective_date"))
        .agg(last)
        .select(key, "effective_date", *[F.col(f"_last.{a}").alias(a) for a in attributes])
    )


def _versions(daily: DataFrame, key: str, attributes: list[str]) -> DataFrame:
    by_key = Window.partitionBy(key).orderBy("effective_date")
    state = F.struct(*attributes)
    changed = daily.withColumn("_same", F.lag(state).over(by_key).eqNullSafe(state)).filter(
        ~F.col("_same")
    )
    return changed.select(
        key,
        *attributes,
        "effective_date",
        F.lead("effective_date").over(by_key).alias("end_date"),
    )


def scd2(log: DataFrame, key: str, ts: str, attributes: list[str], tie: str) -> DataFrame:
    """Versions of each key from its change log: valid from `effective_date` up to before `end_date`.

    The log is reduced to one row per key and day before any window runs, so the longest group a
    task sees is the number of days, whatever share of the log a key has.
    """
    versions = _versions(_daily_state(log, key, ts, attributes, tie), key, attributes)
    return versions.select(
        surrogate_key(F.col(key), F.col("effective_date")).alias("version_key"),
        *versions.columns,
        F.col("end_date").isNull().alias("is_current"),
    )


def scd2_merge(
    dim: DataFrame, log: DataFrame, key: str, ts: str, attributes: list[str], tie: str
) -> DataFrame:
    """Add new changes to an existing history; only keys in the log are rebuilt."""
    fresh = _daily_state(log, key, ts, attributes, tie).withColumn("_new", F.lit(1))
    touched = fresh.select(key).distinct()
    old = dim.join(touched, key, "left_semi").select(
        key, "effective_date", *attributes, F.lit(0).alias("_new")
    )
    state = F.max(F.struct("_new", *attributes)).alias("_s")
    daily = (
        old.unionByName(fresh)
        .groupBy(key, "effective_date")
        .agg(state)
        .select(key, "effective_date", *[F.col(f"_s.{a}").alias(a) for a in attributes])
    )
    rebuilt = _versions(daily, key, attributes)
    rebuilt = rebuilt.select(
        surrogate_key(F.col(key), F.col("effective_date")).alias("version_key"),
        *rebuilt.columns,
        F.col("end_date").isNull().alias("is_current"),
    )
    return dim.join(touched, key, "left_anti").select(*rebuilt.columns).unionByName(rebuilt)


def scd2_lookup(
    facts: DataFrame,
    dim: DataFrame,
    key: str,
    on_date: str,
    spread_by: str,
    take: list[str],
    frequent: DataFrame | None = None,
) -> DataFrame:
    """The version valid on the date of each fact; facts before the first version get NULLs.

    An as-of join: facts and versions are put together and sorted by key and date once, and each fact takes the
    last version that began by then, if it has not ended. No fact meets more than one version, however many a
    key has. Facts of the frequent keys and facts without a key are dealt over many sorted runs, into which
    the versions of these keys alone are copied. Unless given, the frequent keys are found by a sketch of
    the facts, which reads their key once more.
    """
    hot = F.broadcast((frequent_keys(facts, key) if frequent is None else frequent).select("_hot_key", F.lit(True).alias("_hot")))

    def marked(df: DataFrame) -> DataFrame:
        return df.join(hot, F.col(key) == F.col("_hot_key"), "left").drop("_hot_key")

    start, stop = F.to_date("effective_date"), F.to_date("end_date")
    version = F.struct(start.alias("_from"), stop.alias("_to"), *take)
    copies = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(HOT_SPLITS - 1))).otherwise(F.array(F.lit(0)))
    versions = marked(dim.filter(F.col(key).isNotNull() & start.isNotNull())).select(
        key, F.explode(copies).alias("_run"), start.alias("_day"), version.alias("_version")
    )
    spread = F.coalesce("_hot", F.lit(False)) | F.col(key).isNull()
    run = F.when(spread, F.pmod(F.xxhash64(spread_by), F.lit(HOT_SPLITS)).cast("int")).otherwise(F.lit(0))
    fact = F.struct(*facts.columns)
    wanted = marked(facts).select(key, run.alias("_run"), F.col(on_date).cast("date").alias("_day"), fact.alias("_fact"))
    # Of one day the version comes before the facts.
    by_day = Window.partitionBy(key, "_run").orderBy("_day", F.col("_fact").isNotNull())
    known = F.last("_version", ignorenulls=True).over(by_day.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    both = versions.unionByName(wanted, allowMissingColumns=True).withColumn("_known", known)
    valid = F.col("_known._to").isNull() | (F.col("_day") < F.col("_known._to"))
    return both.filter(F.col("_fact").isNotNull()).select("_fact.*", *[F.when(valid, F.col(f"_known.{c}")).alias(c) for c in take])


def dim_driver(log: DataFrame, key: str, ts: str, attributes: list[str], tie: str) -> DataFrame:
    return scd2(log, key, ts, attributes, tie).withColumnRenamed("version_key", "driver_key")


def dim_rider(log: DataFrame, key: str, ts: str, attributes: list[str], tie: str) -> DataFrame:
    """Current state per rider with the time it became valid; history is in the `scd2` form."""
    last = F.max(F.struct(F.col(ts), F.col(tie), *attributes)).alias("_last")
    current = log.groupBy(key).agg(last, F.min(ts).alias("_first"))
    return current.select(
        surrogate_key(F.col(key)).alias("rider_key"),
        key,
        *[F.col(f"_last.{a}").alias(a) for a in attributes],
        F.to_date("_first").alias("account_created_date"),
        F.col(f"_last.{ts}").alias("valid_from"),
        F.lit(None).cast("timestamp").alias("valid_to"),
    )


def dim_date(df: DataFrame, ts: str) -> DataFrame:
    """Every day from the first to the last event."""
    span = df.agg(F.to_date(F.min(ts)).alias("a"), F.to_date(F.max(ts)).alias("b"))
    days = span.select(F.explode(F.sequence("a", "b", F.expr("interval 1 day"))).alias("date"))
    return days.select(
        date_key(F.col("date")).alias("date_id"),
        "date",
        F.year("date").alias("year"),
        F.month("date").alias("month"),
        F.dayofmonth("date").alias("day"),
        F.weekday("date").alias("weekday"),
        (F.weekday("date") >= 5).alias("is_weekend"),
    )


def dim_time(df: DataFrame, ts: str) -> DataFrame:
    """Every minute of the day that has events."""
    return (
        df.filter(F.col(ts).isNotNull())
        .select(time_key(F.col(ts)).alias("time_id"), F.hour(ts).alias("hour"), F.minute(ts).alias("minute"))
        .distinct()
    )


def dim_location(df: DataFrame, cells_per_degree: int = 100) -> DataFrame:
    """Every grid cell in which a ride starts or ends, with its centre and the number of each."""
    ends = F.array(
        *[
            F.struct(F.col(f"{end}_lat").alias("lat"), F.col(f"{end}_lon").alias("lon"), F.lit(end).alias("end"))
            for end in ("pickup", "dropoff")
        ]
    )
    points = df.select(F.explode(ends).alias("p")).select("p.*").filter("lat IS NOT NULL AND lon IS NOT NULL")

    def centre(degrees: str, low: int) -> Column:
        return (F.floor((F.col(degrees) + low) * cells_per_degree) + F.lit(0.5)) / cells_per_degree - low

    return points.groupBy(grid_cell(F.col("lat"), F.col("lon"), cells_per_degree).alias("location_id")).agg(
        F.min(centre("lat", 90)).alias("centre_lat"),
        F.min(centre("lon", 180)).alias("centre_lon"),
        F.count_if(F.col("end") == "pickup").alias("pickups"),
        F.count_if(F.col("end") == "dropoff").alias("dropoffs"),
    )


def fact_rides(
    trips: DataFrame,
    drivers: DataFrame,
    riders: DataFrame,
    *,
    sla_seconds: int = SLA_SECONDS,
    cells_per_degree: int = 100,
) -> DataFrame:
    """Rides with dimension keys and a late flag; an id the dimension lacks gets the unknown key.

    Date, time and place keys are computed, not looked up. Driver and rider lookups are joins that
    split hot ids; neither dimension is assumed to be small. `trips` is read three times, twice for
    one id column only, so it should be a stored table.
    """
    unknown = F.lit(UNKNOWN_KEY)
    with_driver = scd2_lookup(
        trips.withColumn("_day", F.to_date("started_at")),
        drivers, "driver_id", "_day", "ride_id", ["driver_key"], frequent_keys(trips, "driver_id"),
    )
    joined = lookup_join(
        with_driver,
        riders.select("rider_id", "rider_key"),
        "rider_id",
        spread_by=["ride_id"],
        frequent=frequent_keys(trips, "rider_id"),
    )
    seconds = F.unix_seconds("completed_at") - F.unix_seconds("started_at")

    def cell(end: str) -> Column:
        return grid_cell(F.col(f"{end}_lat"), F.col(f"{end}_lon"), cells_per_degree)

    return joined.select(
        "ride_id",
        F.coalesce("rider_key", unknown).alias("rider_key"),
        F.coalesce("driver_key", unknown).alias("driver_key"),
        date_key(F.to_date("started_at")).alias("date_id"),
        time_key(F.col("started_at")).alias("start_time_id"),
        cell("pickup").alias("pickup_location_id"),
        cell("dropoff").alias("dropoff_location_id"),
        "distance_meters",
        seconds.cast("int").alias("duration_seconds"),
        "fare_cents",
        F.col("completed_at").isNotNull().alias("completed"),
        (seconds > sla_seconds).alias("late"),
    )


def hash_names(df: DataFrame, columns: list[str], salt: str) -> DataFrame:
    """Replace personal text by its salted hash."""
    return df.withColumns({c: hashed(F.col(c), salt) for c in columns})
