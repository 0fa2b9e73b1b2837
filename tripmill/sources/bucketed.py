"""Keyed state in bucketed tables: rows are hashed and sorted by key, a lookup reads one bucket.

A save joins the stored rows with the new ones bucket by bucket, so only the new rows are shuffled, and writes the
result as the next version. A view names the version that counts; it is set once the version is written, so
a save that stops half way changes nothing. The version before stays for its readers. One writer at a time.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class BucketedTable:
    """Rows by key in the catalog, under a view with the given name.

    With as many buckets as the session has shuffle partitions, or more, a join leaves the stored side where it is.
    """

    spark: SparkSession
    name: str
    key: str
    buckets: int | None = None

    def versions(self) -> list[str]:
        """Tables written so far and still there, the oldest first."""
        names = [r["tableName"] for r in self.spark.sql(f"SHOW TABLES LIKE '{self.name}_v*'").collect()]
        return sorted(names)

    def replace(self, rows: DataFrame) -> None:
        """Write the rows, one per key, as the next version and let the view name it."""
        done = self.versions()
        number = int(done[-1][len(self.name) + 2 :].split("_")[0]) + 1 if done else 0
        version = f"{self.name}_v{number:09d}_{uuid.uuid4().hex[:8]}"
        buckets = self.buckets or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        clustered = rows.hint("rebalance", F.col(self.key)) if not done else rows
        clustered.write.bucketBy(buckets, self.key).sortBy(self.key).format("parquet").saveAsTable(version)
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.name} AS SELECT * FROM {version}")
        for old in done[:-1]:
            self.spark.sql(f"DROP TABLE IF EXISTS {old}")

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def merged(self, rows: DataFrame) -> DataFrame:
        """The stored rows with new ones, one per key, in the place of those with their keys."""
        stored = self.read()
        rest = [c for c in stored.columns if c != self.key]
        old = stored.select(self.key, F.struct(*rest).alias("_old"))
        new = rows.select(self.key, F.struct(*rest).alias("_new"))
        both = old.join(new.hint("merge"), self.key, "full_outer").select(self.key, F.coalesce("_new", "_old").alias("_row"))
        return both.select(*[c if c == self.key else F.col(f"_row.{c}").alias(c) for c in stored.columns])

    def save(self, rows: DataFrame) -> None:
        if self.versions():
            self.replace(self.merged(rows))
        else:
            self.replace(rows)

    def without(self, keys: DataFrame) -> DataFrame:
        """The stored rows but those of the given keys."""
        return self.read().join(keys.select(self.key).distinct().hint("merge"), self.key, "left_anti")

    def delete(self, keys: DataFrame) -> None:
        self.replace(self.without(keys))

    def find(self, value: object) -> DataFrame:
        """The row of one key, from the bucket that the key lies in."""
        return self.read().filter(F.col(self.key) == F.lit(value))

    def drop(self) -> None:
        self.spark.sql(f"DROP VIEW IF EXISTS {self.name}")
        for version in self.versions():
            self.spark.sql(f"DROP TABLE IF EXISTS {version}")
