"""Gold by day from mergeable parts, with exact distinct counts, kept up to date by increments of events.

An increment touches some days. The typed events of those days are put together with its own, repeats removed, and
the parts of those days written anew; no other day is read. Parts are sums per day, and per day and kind of id
bitmaps of dense numbers. A report over any span of days adds the sums up and counts the bits of the bitmaps put together.

Repeats are told by ride, type and time, so all copies of an event lie in one day.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.operators.silver import RIDE_EVENT_TIME_KEY, first_occurrence
from tripmill.schemas import COMPLETED
from tripmill.session import kept
from tripmill.sources.files import write_partitioned

DAY = "event_date"
PEOPLE = {"driver": "driver_id", "rider": "rider_id"}
EVENTS = (
    "event_id string, ride_id string, event_type string, event_timestamp timestamp, rider_id string, driver_id string, "
    f"fare_cents bigint, distance_meters double, {DAY} date"
)
TOTALS = f"rides bigint, fare_cents bigint, distance_meters double, {DAY} date"
BITS = f"kind string, bucket bigint, bitmap binary, {DAY} date"
NUMBERS = "kind string, id string, number bigint"


def _ids(rows: DataFrame, *keep: str) -> DataFrame:
    """(kind, id) of the drivers and riders of each row that names them."""
    named = [F.struct(F.lit(kind).alias("kind"), F.col(column).alias("id")) for kind, column in PEOPLE.items()]
    return rows.select(*keep, F.inline(F.array(*named))).filter("id IS NOT NULL")


@dataclass(frozen=True)
class DailyGold:
    """The stored events, id numbers and parts under a folder. One writer at a time.

    `part` is the span that a part covers and that is rewritten as a whole: a day, or a longer one where days are small.
    """

    spark: SparkSession
    path: str
    part: str = "day"

    def _read(self, name: str, schema: str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.path}/{name}")

    def create(self) -> DailyGold:
        """Folders of an empty day, so that all can be read before the first increment."""
        for name, schema in (("events", EVENTS), ("totals", TOTALS), ("people", BITS)):
            empty = self.spark.createDataFrame([], schema).drop(DAY)
            empty.write.mode("ignore").parquet(f"{self.path}/{name}/{DAY}=0001-01-01")
        self.spark.createDataFrame([], NUMBERS).write.mode("ignore").parquet(f"{self.path}/numbers")
        return self

    def totals(self) -> DataFrame:
        return self._read("totals", TOTALS)

    def people(self) -> DataFrame:
        return self._read("people", BITS)

    def numbers(self) -> DataFrame:
        return self._read("numbers", NUMBERS)

    def _number_new(self, rows: DataFrame) -> None:
        """Give ids that have no number yet one that nobody has: dense within a task, so that bitmaps are well filled.

        A number once given stays. They come in one write, so a job that stops gives none.
        """
        done = self.numbers()
        new = _ids(rows).distinct().join(done.select("kind", "id"), ["kind", "id"], "left_anti")
        first = done.agg(F.coalesce(F.max("number") + 1, F.lit(0))).first()[0]
        numbered = new.select("kind", "id", (F.monotonically_increasing_id() + F.lit(first)).alias("number"))
        numbered.write.mode("append").parquet(f"{self.path}/numbers")

    def apply(self, events: DataFrame, *, stored: bool = False) -> list[str]:
        """Add typed events (as `silver.type_events` gives them) and recompute their days; returns the days.

        Events without a time belong to no day and are left out. The same increment again changes nothing.
        The increment is read twice: it is written down first, unless it is a part of a `stored` table.
        """
        names = [c for c in (f.split()[0] for f in EVENTS.split(", ")) if c != DAY]
        dated = events.select(*names, F.to_date(F.date_trunc(self.part, "event_timestamp")).alias(DAY)).filter(F.col(DAY).isNotNull())
        added = dated if stored else kept(dated, "increment")
        # One date per touched day comes to the driver.
        days = sorted(r[0] for r in added.select(DAY).distinct().collect())
        if not days:
            return []
        # The days are replaced once the job has read all of them.
        before = self._read("events", EVENTS).filter(F.col(DAY).isin(days))
        write_partitioned(first_occurrence(before.unionByName(added), RIDE_EVENT_TIME_KEY, ["event_id"]), f"{self.path}/events", DAY)
        rows = self._read("events", EVENTS).filter(F.col(DAY).isin(days))
        done = rows.filter(F.col("event_type") == COMPLETED)
        self._number_new(done)
        # Each touched day gets a row, also one without a completed ride.
        ended = F.col("event_type") == COMPLETED
        sums = rows.groupBy(DAY).agg(
            F.count_if(ended).alias("rides"),
            F.sum(F.when(ended, F.col("fare_cents"))).alias("fare_cents"),
            F.sum(F.when(ended, F.col("distance_meters"))).alias("distance_meters"),
        )
        write_partitioned(sums, f"{self.path}/totals", DAY)
        write_partitioned(self._bitmaps(done), f"{self.path}/people", DAY)
        return [d.isoformat() for d in days]

    def _bitmaps(self, done: DataFrame) -> DataFrame:
        """Bitmaps of the numbers of each day. Pairs of day and id are made unique before they meet the numbers."""
        placed = _ids(done, DAY).distinct().join(self.numbers(), ["kind", "id"])
        return placed.groupBy(DAY, "kind", F.bitmap_bucket_number("number").alias("bucket")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bitmap")
        )

    def report(self, span: str = "month") -> DataFrame:
        """Rides, money, distance and exact numbers of drivers and riders per span of days, from the parts alone."""
        start = F.to_date(F.date_trunc(span, DAY)).alias("period")
        sums = self.totals().groupBy(start).agg(
            F.sum("rides").alias("rides"),
            F.sum("fare_cents").alias("fare_cents"),
            F.sum("distance_meters").cast("bigint").alias("distance_meters"),
        )
        merged = self.people().groupBy(start, "kind", "bucket").agg(F.bitmap_count(F.bitmap_or_agg("bitmap")).alias("n"))
        counts = merged.groupBy("period").agg(
            *[F.sum(F.when(F.col("kind") == k, F.col("n")).otherwise(0)).alias(f"{k}s") for k in PEOPLE]
        )
        return sums.join(counts, "period", "left").select(
            "period", "rides", "fare_cents", "distance_meters", *[F.coalesce(f"{k}s", F.lit(0)).alias(f"{k}s") for k in PEOPLE]
        )
