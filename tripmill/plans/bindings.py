"""The given order, line and event tables read as ride logs.

The tables hold no rides, so each order stands for a ride and each purchase event for a completed
one. Some rides are given defects on purpose, chosen by their number, for the checks to find.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.functions.events import event_id, iso_text
from tripmill.functions.numeric import half_up
from tripmill.operators.silver import RIDE_EVENT_KEY, to_silver
from tripmill.schemas import ACCEPTED, CANCELLED, COMPLETED, GPS, REQUESTED, STARTED
from tripmill.session import use_utc
from tripmill.sources.tables import folder_bytes

TRIP_FIELDS = (
    "surge_multiplier", "pickup_lat", "pickup_lon", "dropoff_lat", "dropoff_lon", "cancel_reason",
)

#: Bytes of the stored orders and lines that a task of the log is made from: it sorts some fifty times as much.
LOG_TASK_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    use_utc(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def log_tasks(spark: SparkSession, sf_dir: str) -> int:
    """Tasks that the log of the orders is made in, by the size of its tables."""
    size = sum(folder_bytes(spark, f"{sf_dir}/{name}.parquet") for name in ("orders", "lineitem"))
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), size // LOG_TASK_BYTES)


def rides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order: the facts of its ride.

    Orders are spread by key, as the join needs them anyway, so that the log made from them is
    computed in parallel however few files they came in. An order makes several wide events, so the
    number of tasks follows the size of the tables and not that of the shuffle.
    """
    tasks = log_tasks(spark, sf_dir)
    per_order = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(F.min("l_suppkey").alias("driver"), F.sum("l_quantity").alias("quantity"))
        .repartition(tasks, "l_orderkey")
    )
    orders = table(spark, sf_dir, "orders").repartition(tasks, "o_orderkey")
    joined = orders.join(per_order, orders.o_orderkey == per_order.l_orderkey, "left")
    k, customer = F.col("o_orderkey"), F.col("o_custkey")

    def every(n: int) -> Column:
        return k % n == 0

    def degrees(base: float, number: Column, n: int) -> Column:
        return F.lit(base) + (number % n) / F.lit(10000.0)

    fare = F.floor(F.col("o_totalprice") / 4)
    base = joined.select(
        k.alias("k"),
        k.cast("string").alias("ride_id"),
        F.when(every(97), "").otherwise(customer.cast("string")).alias("rider_id"),
        F.col("driver").cast("string").alias("driver_id"),
        F.when(every(89), F.lit(600000).cast("bigint"))
        .otherwise((F.coalesce("quantity", F.lit(0.0)) * 100).cast("bigint"))
        .alias("distance_meters"),
        F.when(every(83), -fare).otherwise(fare).alias("fare_cents"),
        F.when(every(103), 6.0).otherwise(1.0 + 0.25 * (k % 5)).alias("surge_multiplier"),
        F.when(every(113), 95.0).otherwise(degrees(37.7, customer, 1000)).alias("pickup_lat"),
        degrees(-122.5, customer, 700).alias("pickup_lon"),
        degrees(37.7, k * 7, 1000).alias("_lat"),
        degrees(-122.5, k * 3, 700).alias("_lon"),
        F.col("o_orderstatus").alias("order_status"),
        (
            F.col("o_orderdate").cast("timestamp")
            + F.make_dt_interval(mins=(k * 37 % 1440).cast("int"))
        ).alias("requested_at"),
        F.when(k % 3 == 0, "no_drivers").when(k % 3 == 1, "changed_mind").alias("reason"),
    )
    same_ends = F.col("k") % 109 == 0
    return base.withColumns(
        {
            "dropoff_lat": F.when(same_ends, F.col("pickup_lat")).otherwise(F.col("_lat")),
            "dropoff_lon": F.when(same_ends, F.col("pickup_lon")).otherwise(F.col("_lon")),
        }
    ).drop("_lat", "_lon")


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flat event log of those rides, with redeliveries, plus the trip fields of the payloads."""
    k = F.col("k")
    driven = F.col("driver_id").isNotNull()
    started = driven & F.col("order_status").isin("F", "O") & (k % 101 != 0)

    def event(kind: str, minutes: Column | int, keep: Column) -> Column:
        offset = F.lit(minutes) if isinstance(minutes, int) else minutes
        return F.struct(
            F.lit(kind).alias("kind"), offset.cast("int").alias("minutes"), keep.alias("keep")
        )

    plan = F.array(
        event(REQUESTED, 0, F.lit(True)),
        event(ACCEPTED, 3, driven),
        event(STARTED, 8, started),
        event(GPS, 10, started),
        event(GPS, 12, started),
        event(COMPLETED, 18 + k % 50, driven & (F.col("order_status") == "F")),
        event(CANCELLED, 5, F.col("order_status") == "P"),
    )
    # A second delivery is exact for numbers ending in 0 and a minute later for those ending in 1.
    delays = F.when(k % 10 == 0, F.array(F.lit(0), F.lit(0))).when(
        k % 10 == 1, F.array(F.lit(0), F.lit(1))
    ).otherwise(F.array(F.lit(0)))
    log = (
        rides(spark, sf_dir)
        .withColumn("e", F.explode(F.filter(plan, lambda e: e.keep)))
        .withColumn("delay", F.explode(delays))
        .withColumn("kind", F.col("e.kind"))
        .withColumn(
            "at",
            F.col("requested_at") + F.make_dt_interval(mins=F.col("e.minutes") + F.col("delay")),
        )
        .withColumn("timestamp", iso_text(F.col("at")))
    )
    kind = F.col("kind")

    def only(kinds: tuple[str, ...], value: Column) -> Column:
        return F.when(kind.isin(*kinds), value)

    def place(name: str) -> Column:
        middle = (F.col(f"pickup_{name}") + F.col(f"dropoff_{name}")) / 2
        return F.when(kind == REQUESTED, F.col(f"pickup_{name}")).when(kind == GPS, middle)

    zero = F.lit(0).cast("bigint")
    wrong = F.when(k % 107 == 0, F.concat(F.lit("x"), F.col("ride_id"))).otherwise(F.col("ride_id"))
    return log.select(
        event_id(wrong, kind, F.col("timestamp")).alias("event_id"),
        "ride_id",
        kind.alias("event_type"),
        "timestamp",
        only((REQUESTED, ACCEPTED, STARTED, COMPLETED), F.col("rider_id")).alias("rider_id"),
        only((ACCEPTED, STARTED, COMPLETED), F.col("driver_id")).alias("driver_id"),
        place("lat").alias("latitude"),
        place("lon").alias("longitude"),
        F.coalesce(only((COMPLETED,), F.col("fare_cents")), zero).alias("fare_cents"),
        F.coalesce(only((COMPLETED,), F.col("distance_meters")), zero).alias("distance_meters"),
        F.coalesce(only((COMPLETED,), F.col("surge_multiplier")), F.lit(1.0)).alias(
            "surge_multiplier"
        ),
        *[only((REQUESTED,), F.col(c)).alias(c) for c in TRIP_FIELDS[1:5]],
        only((CANCELLED,), F.col("reason")).alias("cancel_reason"),
    )


def silver(spark: SparkSession, sf_dir: str, key: tuple[str, ...] = RIDE_EVENT_KEY) -> DataFrame:
    return to_silver(bronze(spark, sf_dir), key, keep=TRIP_FIELDS)


def domain_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same log in the nested form a ride service emits: envelope and a JSON `data` text."""
    log = bronze(spark, sf_dir)
    kind = F.col("event_type")
    done = kind == COMPLETED

    def only(condition: Column, name: str) -> Column:
        return F.when(condition, F.col(name))

    data = F.struct(
        F.col("rider_id").alias("passenger_id"),
        "driver_id",
        only(kind == GPS, "latitude").alias("latitude"),
        only(kind == GPS, "longitude").alias("longitude"),
        *TRIP_FIELDS[1:5],
        only(done, "fare_cents").alias("fare_cents"),
        (only(done, "distance_meters") / F.lit(1000.0)).alias("distance_km"),
        only(done, "surge_multiplier").alias("surge_multiplier"),
        F.col("cancel_reason").alias("reason"),
    )
    return log.select("event_id", "ride_id", "event_type", "timestamp", F.to_json(data).alias("data"))


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Completed rides of silver with the two ends of the trip."""
    places = rides(spark, sf_dir).select(
        "ride_id", "pickup_lat", "pickup_lon", "dropoff_lat", "dropoff_lon"
    )
    done = silver(spark, sf_dir).filter(F.col("event_type") == COMPLETED)
    return done.drop("pickup_lat", "pickup_lon", "dropoff_lat", "dropoff_lon").join(places, "ride_id")


def ride_messages(events: DataFrame) -> DataFrame:
    """The `events` table, batch or stream, as JSON messages: a purchase is a completed ride.

    Every message carries flat ids and a nested payload. Clicks lack their ride id, views are cut
    short and are no longer JSON, and errors have a type that is not known.
    """
    kinds = (
        F.when(F.col("event_type") == "purchase", COMPLETED)
        .when(F.col("event_type") == "signup", REQUESTED)
        .when(F.col("event_type") == "click", GPS)
        .when(F.col("event_type") == "view", GPS)
        .otherwise(F.col("event_type"))
    )
    k = F.get_json_object("props", "$.k").cast("int")
    data = F.to_json(
        F.struct(
            F.col("user_id").cast("string").alias("driver_id"),
            half_up(F.col("value") * 100).alias("fare_cents"),
            ((F.col("event_id") % 300) / F.lit(10.0)).alias("distance_km"),
            (1.0 + (k % 17) / F.lit(4.0)).alias("surge_multiplier"),
        )
    )
    ts = F.col("ts").cast("timestamp")
    message = F.to_json(
        F.struct(
            F.col("event_id").cast("string").alias("event_id"),
            F.when(F.col("event_type") != "click", F.concat(F.lit("r"), F.col("event_id"))).alias(
                "ride_id"
            ),
            kinds.alias("event_type"),
            iso_text(ts).alias("timestamp"),
            data.alias("data"),
        )
    )
    cut = F.when(F.col("event_type") == "view", F.substring(message, 1, 40)).otherwise(message)
    return events.select("event_id", ts.alias("ts"), cut.alias("value")).withColumnRenamed(
        "event_id", "offset"
    )


def change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes of drivers: each order is an entry for its customer with two tracked attributes."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("driver_id"),
        F.col("o_orderdate").cast("timestamp").alias("changed_at"),
        F.col("o_orderkey").alias("entry"),
        F.col("o_orderpriority").alias("vehicle_type"),
        (F.col("o_orderstatus") != "P").alias("active_flag"),
    )
