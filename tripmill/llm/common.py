"""Small helpers shared by the operators of this folder."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.session import work_dir

CHUNK = 1 << 12


BATCH_BYTES = "4m"


def bounded(spark: SparkSession) -> SparkSession:
    """The session with Arrow batches bounded by size: rows may be very long texts."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def without(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """The table without columns that an output column would clash with, whatever their case."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def stored(df: DataFrame, purpose: str, **options: str) -> DataFrame:
    """Write a table into the shared folder and read it again: later steps start from its files.

    It takes the place of a cached or locally checkpointed table, which is lost with its executor.
    """
    spark = df.sparkSession
    path = work_dir(spark, purpose)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def add_vectors(df: DataFrame, run: Callable[[Iterator], Iterator[np.ndarray]], size: int) -> np.ndarray:
    """Sum of the vectors that `run` makes of each partition; their length must not grow with the table.

    Vectors travel in chunks, so that no task and no row gets large, and one vector comes to the driver.
    """

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for vector in run(batches):
            parts = [vector[at : at + CHUNK] for at in range(0, size, CHUNK)]
            some = [(i, p.astype("<f8").tobytes()) for i, p in enumerate(parts) if p.any()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([i for i, _ in some], pa.int32()), pa.array([p for _, p in some], pa.binary())], names=["chunk", "vector"]
            )

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(v, dtype="<f8") for v in rows["vector"])
        return pd.DataFrame({"chunk": rows["chunk"].iloc[:1], "vector": [total.tobytes()]})

    total = np.zeros(size)
    for r in df.mapInArrow(chunks, "chunk int, vector binary").groupBy("chunk").applyInPandas(add, "chunk int, vector binary").collect():
        total[r["chunk"] * CHUNK : (r["chunk"] + 1) * CHUNK] = np.frombuffer(r["vector"], dtype="<f8")
    return total
