"""Ids seen before, remembered as bitmaps, so that a batch meets only the history that may hold its ids.

Each id sets one bit of a space of `bits`, at a position given by its hash. The space is cut into bitmaps of fixed
size; a batch of ids stores those that it touches, beside its ids. New ids are first held against the bitmaps of all
batches put together: a bit that is not set proves an id new. The few that are left are held against the bitmap of
each batch, and then joined with the ids of those batches only, by folder. So the answer is exact, and the ids of a
batch are read only if one of them may come again.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.operators.silver import first_occurrence
from tripmill.session import kept

BATCH = "batch"
BITMAPS = f"bucket bigint, bitmap binary, {BATCH} bigint"


def bit_is_set(bitmap: Column, position: Column) -> Column:
    """Bit of a bitmap, counted from the lowest of its first byte."""
    byte = F.substring(bitmap, (position / 8).cast("int") + 1, F.lit(1))
    return F.getbit(F.conv(F.hex(byte), 16, 10).cast("bigint"), (position % 8).cast("int")) == 1


def bits_for(ids: int) -> int:
    """A power of two of at least 16 bits for each of so many ids, and of one bitmap at least."""
    return max(1 << 15, 1 << (16 * ids - 1).bit_length())


@dataclass(frozen=True)
class SeenIds:
    """Ids by numbered batch under a folder, with their bitmaps.

    `bits` is fixed for the life of the folder, by `bits_for` the ids that the history will hold: then one new id in 16 at
    most has to be looked for. Too few cost time, never an answer. An id without a value is never remembered.
    """

    spark: SparkSession
    path: str
    id_type: str = "string"
    bits: int = 1 << 30

    def _placed(self, ids: DataFrame, key: str) -> DataFrame:
        place = F.pmod(F.xxhash64(key), F.lit(self.bits))
        return ids.withColumns({"_bucket": F.bitmap_bucket_number(place), "_bit": F.bitmap_bit_position(place)})

    def ids(self) -> DataFrame:
        return self.spark.read.schema(f"id {self.id_type}, {BATCH} bigint").parquet(f"{self.path}/ids")

    def bitmaps(self) -> DataFrame:
        return self.spark.read.schema(BITMAPS).parquet(f"{self.path}/bitmaps")

    def create(self) -> SeenIds:
        """Folders of an empty batch, so that the history can be read before the first one."""
        for name, schema in (("ids", f"id {self.id_type}"), ("bitmaps", "bucket bigint, bitmap binary")):
            self.spark.createDataFrame([], schema).write.mode("ignore").parquet(f"{self.path}/{name}/{BATCH}=-1")
        return self

    def remember(self, rows: DataFrame, key: str, batch: int) -> None:
        """Store the ids of a batch; the same batch again replaces it. Its ids count once they are all written."""
        target = f"{self.path}/ids/{BATCH}={batch}"
        rows.select(F.col(key).cast(self.id_type).alias("id")).filter("id IS NOT NULL").distinct().write.mode("overwrite").parquet(target)
        ids = self.spark.read.schema(f"id {self.id_type}").parquet(target)
        made = self._placed(ids, "id").groupBy(F.col("_bucket").alias("bucket")).agg(F.bitmap_construct_agg("_bit").alias("bitmap"))
        made.write.mode("overwrite").parquet(f"{self.path}/bitmaps/{BATCH}={batch}")

    def suspects(self, rows: DataFrame, key: str) -> DataFrame:
        """(id, batch): ids of the rows with the batches that may hold them; each pair once."""
        ids = rows.select(F.col(key).cast(self.id_type).alias("id")).filter("id IS NOT NULL").distinct()
        merged = self.bitmaps().groupBy("bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
        placed = self._placed(ids, "id").withColumnRenamed("_bucket", "bucket")
        some = placed.join(merged, "bucket").filter(bit_is_set(F.col("bitmap"), F.col("_bit"))).drop("bitmap")
        return some.join(self.bitmaps(), "bucket").filter(bit_is_set(F.col("bitmap"), F.col("_bit"))).select("id", BATCH)

    def seen(self, rows: DataFrame, key: str) -> DataFrame:
        """(id): ids of the rows that the history holds, from the batches that may hold them."""
        pairs = kept(self.suspects(rows, key), "suspects")
        # One name per folder comes to the driver.
        batches = [r[0] for r in pairs.select(BATCH).distinct().collect()]
        there = self.ids().filter(F.col(BATCH).isin(batches))
        return pairs.join(there, ["id", BATCH], "left_semi").select("id").distinct()

    def unseen(self, rows: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
        """Rows whose id is neither in the history nor earlier in `order` within the rows.

        Rows without an id are one group of their own, as in `state.unseen`.
        """
        once = first_occurrence(rows, [key], order)
        known = self.seen(once, key).select(F.col("id").cast(rows.schema[key].dataType).alias(key))
        return once.join(known, key, "left_anti")
