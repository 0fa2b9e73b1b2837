"""Keyed state: latest row per key, lookup, deletion, and ids seen before."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.operators.silver import first_occurrence


def upsert_latest(
    current: DataFrame, updates: DataFrame, key: str, order: Sequence[Column | str]
) -> DataFrame:
    """Current rows with the updates put over them; the first row in `order` wins within the updates.

    An update always beats the stored row, as a put does.
    """
    rows = current.withColumn("_new", F.lit(0)).unionByName(updates.withColumn("_new", F.lit(1)))
    return first_occurrence(rows, [key], [F.col("_new").desc(), *order]).drop("_new")


def find(rows: DataFrame, key: str, value: object) -> DataFrame:
    """Point lookup; the filter reaches the scan."""
    return rows.filter(F.col(key) == value)


def find_many(rows: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    return rows.join(wanted.select(key).distinct(), key, "left_semi")


def delete(rows: DataFrame, key: str, unwanted: DataFrame) -> DataFrame:
    return rows.join(unwanted.select(key).distinct(), key, "left_anti")


def unseen(incoming: DataFrame, seen: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Rows whose id is neither in the history nor earlier in the batch.

    The batch is reduced to one row per id before the join, so both sides are unique on it.
    """
    return delete(first_occurrence(incoming, [key], order), key, seen)
