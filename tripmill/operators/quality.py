"""Data-quality checks: each has a query for its violations and a row in the summary.

Checks on single rows of one table are counted together in one pass. Uniqueness and reference
checks work on counts per key, never on all rows of a key at once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tripmill.functions.fares import SURGE_RANGE
from tripmill.schemas import COMPLETED, EVENT_TYPES

MAX_KM = 500.0
MAX_FARE_CENTS = 100_000


@dataclass(frozen=True)
class RowCheck:
    """A rule that each row meets or breaks; `broken` is true, and never NULL, where it is broken."""

    name: str
    column: str
    broken: Column


def not_null(column: str) -> RowCheck:
    return RowCheck("not_null", column, F.col(column).isNull())


def accepted_values(column: str, values: tuple[str, ...]) -> RowCheck:
    return RowCheck(
        "accepted_values", column, F.coalesce(~F.col(column).isin(*values), F.lit(False))
    )


def in_range(name: str, column: str, low, high=None, *, completed_only: bool = False) -> RowCheck:
    value = F.col(column)
    outside = value < low if high is None else ~value.between(low, high)
    if completed_only:
        outside = (F.col("event_type") == COMPLETED) & outside
    return RowCheck(name, column, F.coalesce(outside, F.lit(False)))


def bronze_checks() -> list[RowCheck]:
    return [not_null(c) for c in ("event_id", "ride_id", "event_type")] + [
        in_range("surge_bounds", "surge_multiplier", *SURGE_RANGE, completed_only=True)
    ]


def driver_event_checks() -> list[RowCheck]:
    return [not_null("event_id"), not_null("driver_id")]


def silver_checks() -> list[RowCheck]:
    return [not_null(c) for c in ("event_id", "ride_id", "event_type", "event_timestamp")] + [
        accepted_values("event_type", EVENT_TYPES),
        in_range("distance_bounds", "distance_km", 0.0, MAX_KM, completed_only=True),
        in_range("fare_not_negative", "fare_cents", 0, completed_only=True),
        in_range("fare_bounds", "fare_cents", 0, MAX_FARE_CENTS, completed_only=True),
    ]


def date_range_check(column: str, first: str, last: str) -> RowCheck:
    return in_range("date_range", column, F.to_date(F.lit(first)), F.to_date(F.lit(last)))


def violations(df: DataFrame, check: RowCheck) -> DataFrame:
    return df.filter(check.broken)


def check_counts(checks: list[RowCheck]) -> list[Column]:
    return [F.count(F.lit(1)).alias("total"), *[F.count_if(c.broken).alias(f"c{i}") for i, c in enumerate(checks)]]


def _summary_row(check: RowCheck, table: str, violations: Column, total: Column) -> Column:
    return F.struct(
        F.lit(check.name).alias("check"),
        F.lit(table).alias("table"),
        F.lit(check.column).alias("column"),
        violations.cast("long").alias("violations"),
        total.cast("long").alias("total"),
    )


def observed(df: DataFrame, checks: list[RowCheck]) -> tuple[DataFrame, Observation]:
    """The rows, with the checks counted while they are written: no pass of their own.

    Apply it last before the write. Rows that a shuffle after it sends again, because an executor
    was lost, would count twice.
    """
    seen = Observation()
    return df.observe(seen, *check_counts(checks)), seen


def observed_summary(spark: SparkSession, seen: Observation, table: str, checks: list[RowCheck]) -> DataFrame:
    """What `summarise_rows` gives, from the counts of a write that is done."""
    found = seen.get
    total = F.lit(found.get("total", 0))
    rows = [_summary_row(c, table, F.lit(found.get(f"c{i}", 0)), total) for i, c in enumerate(checks)]
    return spark.range(1).select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def beyond_limits(summary: DataFrame, limits: dict[str, float]) -> DataFrame:
    """Checks of the summary that more rows break than the share given for their name; names without one may break."""
    allowed = F.create_map(*[F.lit(x) for pair in limits.items() for x in pair]) if limits else F.create_map().cast("map<string,double>")
    share = F.col("violations") / F.greatest(F.col("total"), F.lit(1))
    return summary.filter(share > F.element_at(allowed, F.col("check")))


def summarise_rows(df: DataFrame, table: str, checks: list[RowCheck]) -> DataFrame:
    """One summary row per check, counted in a single pass over the table."""
    counts = df.agg(*check_counts(checks))
    rows = F.array(*[_summary_row(c, table, F.col(f"c{i}"), F.col("total")) for i, c in enumerate(checks)])
    return counts.select(F.explode(rows).alias("r")).select("r.*")


def duplicate_keys(df: DataFrame, *keys: str, nulls_too: bool = False) -> DataFrame:
    """Keys that occur more than once. NULL keys are not compared unless asked for."""
    rows = df if nulls_too else df.na.drop(subset=list(keys))
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("cnt")).filter("cnt > 1")


def summarise_unique(df: DataFrame, table: str, *keys: str, nulls_too: bool = False) -> DataFrame:
    """Summary row of a uniqueness check: keys in violation, out of all distinct keys."""
    rows = df if nulls_too else df.na.drop(subset=list(keys))
    per_key = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("cnt"))
    return per_key.agg(
        F.lit("unique").alias("check"),
        F.lit(table).alias("table"),
        F.lit("+".join(keys)).alias("column"),
        F.count_if(F.col("cnt") > 1).alias("violations"),
        F.count(F.lit(1)).alias("total"),
    )


def orphans(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child keys without a parent and how many rows carry them.

    Children are counted per key first, so both sides of the join are unique.
    """
    children = child.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    parents = parent.select(F.col(parent_key).alias("_parent")).distinct()
    return children.join(parents, F.col(key) == F.col("_parent"), "left_anti")


def recency(df: DataFrame, ts: str, as_of: Column, limit_seconds: int) -> DataFrame:
    """Age of the newest row against a limit; an empty table is stale."""
    newest = F.max(ts)
    age = F.unix_seconds(as_of) - F.unix_seconds(newest)
    return df.agg(
        newest.alias("latest_at"),
        age.alias("age_seconds"),
        F.coalesce(age > limit_seconds, F.lit(True)).alias("stale"),
    )


def stage_lag(rows: DataFrame, event_ts: str, loaded_ts: str) -> DataFrame:
    """How long rows took from the event to the table: mean and longest, in seconds."""
    lag = F.unix_seconds(loaded_ts) - F.unix_seconds(event_ts)
    return rows.agg(
        F.count(lag).alias("rows"), F.avg(lag).alias("avg_lag_seconds"), F.max(lag).alias("max_lag_seconds")
    )


def reconcile_counts(
    source: DataFrame, target: DataFrame, key: str, tolerance: float = 0.001
) -> DataFrame:
    """Rows per key on both sides and whether they agree within a share of the source."""
    a = source.groupBy(key).agg(F.count(F.lit(1)).alias("source_rows"))
    b = target.groupBy(key).agg(F.count(F.lit(1)).alias("target_rows"))
    both = a.join(b, key, "full_outer").select(
        key,
        F.coalesce("source_rows", F.lit(0)).alias("source_rows"),
        F.coalesce("target_rows", F.lit(0)).alias("target_rows"),
    )
    gap = F.abs(F.col("source_rows") - F.col("target_rows")).cast("double")
    return both.withColumn("within", gap <= F.col("source_rows").cast("double") * F.lit(tolerance))


def reconcile_totals(parts: DataFrame, whole: DataFrame, amount: str) -> DataFrame:
    """Whether the components add up to the total, as one row."""
    a = parts.agg(F.sum(amount).alias("parts_total"))
    b = whole.agg(F.sum(amount).alias("whole_total"))
    return a.select("parts_total", b.select("whole_total").scalar().alias("whole_total")).withColumn(
        "equal", F.col("parts_total").eqNullSafe(F.col("whole_total"))
    )


#: Buckets of ids that digests are made of; as many rows at most are broadcast.
DIGEST_BUCKETS = 4096


def _bucket(*keys: str) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(DIGEST_BUCKETS))


def digests(df: DataFrame, *keys: str) -> DataFrame:
    """(_bucket, n, x, s): count, exclusive or and sum of hashes of the rows of each bucket, in any order.

    Two tables with the same rows, repeats included, have the same digests. With two hashes of 64 bits, others
    do not.
    """
    other = F.xxhash64(F.lit(1), *keys)
    return df.groupBy(_bucket(*keys).alias("_bucket")).agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor(other).alias("x"), F.sum(F.xxhash64(*keys).cast("decimal(38,0)")).alias("s")
    )


def differing_buckets(left: DataFrame, right: DataFrame, *keys: str) -> DataFrame:
    """Buckets of ids whose rows are not the same on both sides."""
    a = digests(left, *keys).select("_bucket", F.struct("n", "x", "s").alias("_a"))
    b = digests(right, *keys).select("_bucket", F.struct("n", "x", "s").alias("_b"))
    return a.join(b, "_bucket", "full_outer").filter(~F.col("_a").eqNullSafe(F.col("_b"))).select("_bucket")


def stage_changes(before: DataFrame, after: DataFrame, by: str, *columns: str) -> DataFrame:
    """Per value of `by`, rows of both tables and whether they hold the same rows, repeats included.

    Only one digest per value is shuffled, whatever the tables hold.
    """

    def digest(df: DataFrame, name: str) -> DataFrame:
        rows = F.struct(
            F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64(F.lit(1), *columns)).alias("x"),
            F.sum(F.xxhash64(*columns).cast("decimal(38,0)")).alias("s"),
        )
        return df.groupBy(F.col(by).alias("_by")).agg(rows.alias(name))

    a, b = digest(before, "_a"), digest(after, "_b")
    both = a.join(b, a["_by"].eqNullSafe(b["_by"]), "full_outer")
    return both.select(
        F.coalesce(a["_by"], b["_by"]).alias(by),
        F.coalesce("_a.n", F.lit(0)).alias("rows_before"),
        F.coalesce("_b.n", F.lit(0)).alias("rows_after"),
        F.col("_a").eqNullSafe(F.col("_b")).alias("same"),
    )


def id_difference(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Ids found on one side only.

    Both sides are first compared by digests of hash buckets, which is all that is shuffled where they agree.
    Only ids of buckets that differ are grouped. Each side is read twice.
    """
    differing = F.broadcast(differing_buckets(left, right, key))
    left, right = (
        df.select(key, _bucket(key).alias("_bucket")).join(differing, "_bucket", "left_semi").select(key) for df in (left, right)
    )
    both = left.select(key, F.lit(True).alias("_left"), F.lit(False).alias("_right")).unionByName(
        right.select(key, F.lit(False).alias("_left"), F.lit(True).alias("_right"))
    )
    found = both.groupBy(key).agg(F.max("_left").alias("_left"), F.max("_right").alias("_right"))
    return found.filter("_left != _right").select(key, F.when(F.col("_left"), "left").otherwise("right").alias("side"))
