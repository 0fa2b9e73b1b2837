"""Equi-join for facts whose keys may be very unevenly spread."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOT_KEYS = 256
HOT_SPLITS = 64


def frequent_keys(facts: DataFrame, key: str, k: int = HOT_KEYS) -> DataFrame:
    """At most `k` of the most frequent values of a column, from one pass with a fixed-size sketch.

    The sketch is approximate. It only decides which keys are spread, never what is matched.
    """
    sketch = F.call_function("approx_top_k", F.col(key), F.lit(k))
    top = facts.filter(F.col(key).isNotNull()).agg(sketch.alias("_top"))
    return top.select(F.explode("_top").alias("_t")).select(F.col("_t.item").alias("_hot_key"))


def lookup_join(
    facts: DataFrame,
    dim: DataFrame,
    key: str,
    *,
    spread_by: Sequence[str],
    frequent: DataFrame,
    condition: Column | None = None,
    how: str = "left",
    splits: int = HOT_SPLITS,
) -> DataFrame:
    """Join facts to a dimension on a key column and an optional further condition.

    The keys in `frequent`, from `frequent_keys` and so bounded in number, are split over `splits`
    tasks by a hash of the `spread_by` columns, and only their dimension rows are copied to each
    split. Facts without a key match nothing and are spread the same way. Other rows keep the plain
    join on their key, which is taken from the facts.
    """
    hot = F.broadcast(frequent.select("_hot_key", F.lit(True).alias("_hot")))

    def marked(df: DataFrame) -> DataFrame:
        return df.join(hot, F.col(key) == F.col("_hot_key"), "left").drop("_hot_key")

    slot = F.pmod(F.xxhash64(*spread_by), F.lit(splits)).cast("int")
    spread = F.coalesce(F.col("_hot"), F.lit(False)) | F.col(key).isNull()
    left = marked(facts).withColumn("_slot", F.when(spread, slot).otherwise(F.lit(0)))
    slots = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(splits - 1))).otherwise(
        F.array(F.lit(0))
    )
    right = marked(dim).withColumn("_dim_slot", F.explode(slots)).drop("_hot")
    right = right.withColumnRenamed(key, "_dim_key")
    match = (F.col(key) == F.col("_dim_key")) & (F.col("_slot") == F.col("_dim_slot"))
    if condition is not None:
        match &= condition
    return left.join(right, match, how).drop("_hot", "_slot", "_dim_slot", "_dim_key")
