"""Reproducible shuffle of a table into shards, by a keyed permutation of row numbers.

Rows get global numbers 0..n-1 in the order of their keys. A Feistel network permutes the smallest
power of four that holds n; numbers that land outside 0..n-1 are permuted again until they fall
inside (cycle walking), so the result is a permutation of 0..n-1. Position p belongs to shard
p mod k at slot p div k. Shard sizes differ by one row at most, slots have no gaps, and the place of
any row, or the row at any place, follows from the seed, n and k alone.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.llm.common import stored, without

ROUNDS = 6
MASK64 = (1 << 64) - 1


def round_keys(seed: int, rounds: int = ROUNDS) -> list[int]:
    """Round keys from a seed, by the splitmix64 sequence."""
    keys = []
    for i in range(1, rounds + 1):
        z = (seed + i * 0x9E3779B97F4A7C15) & MASK64
        z = ((z ^ (z >> 30)) * 0xBF58476D1CE4E5B9) & MASK64
        z = ((z ^ (z >> 27)) * 0x94D049BB133111EB) & MASK64
        keys.append(z ^ (z >> 31))
    return keys


def _half_bits(n: int) -> int:
    return max(1, (max(n - 1, 1).bit_length() + 1) // 2)


def _mix(x: np.ndarray, key: int, half: int) -> np.ndarray:
    """The round function: `half` well-mixed bits of a half block and a key."""
    z = (x ^ np.uint64(key)) * np.uint64(0xD6E8FEB86659FD93)
    z = (z ^ (z >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return z >> np.uint64(64 - half)


def _network(x: np.ndarray, keys: Sequence[int], half: int, inverse: bool) -> np.ndarray:
    low = np.uint64((1 << half) - 1)
    a, b = x >> np.uint64(half), x & low
    if inverse:
        for key in reversed(keys):
            a, b = b ^ _mix(a, key, half), a
    else:
        for key in keys:
            a, b = b, a ^ _mix(b, key, half)
    return (a << np.uint64(half)) | b


def permute(rows: np.ndarray, n: int, seed: int, *, inverse: bool = False) -> np.ndarray:
    """Positions of the given row numbers in the shuffle of n rows, or with `inverse` the reverse."""
    x = np.asarray(rows, dtype=np.uint64).copy()
    if not len(x):
        return x.astype(np.int64)
    keys, half = round_keys(seed), _half_bits(n)
    todo = np.arange(len(x))
    while len(todo):
        x[todo] = _network(x[todo], keys, half, inverse)
        todo = todo[x[todo] >= np.uint64(n)]
    return x.astype(np.int64)


def row_at(shard: int, slot: int, n: int, shards: int, seed: int) -> int:
    """The global row number that lies in a slot of a shard."""
    return int(permute(np.array([slot * shards + shard]), n, seed, inverse=True)[0])


def number_rows(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, int]:
    """Add `row_number`, 0..n-1 in the order of the keys, and return it with n.

    Rows with equal keys are ordered by a hash of all their columns, so numbers do not depend on how
    the input is split into files; rows equal in every column may swap numbers, which changes
    nothing. The table is sorted by ranges and stored once; each range is then shifted by the number
    of rows before it. Only one count per range passes through the driver. A last sort column splits
    even a run of wholly equal rows over many ranges.
    """
    base = without(df, ["row_number", "__range", "__index", "__hash", "__tie"])
    order = [F.col(f"`{k}`") for k in keys]
    ranged = (
        base.withColumn("__hash", F.xxhash64(*[F.to_json(F.struct(F.col(f"`{c}`").alias("v"))) for c in base.columns]))
        .withColumn("__tie", F.monotonically_increasing_id())
        .repartitionByRange(*order, F.col("__hash"), F.col("__tie"))
        .sortWithinPartitions(*order, F.col("__hash"), F.col("__tie"))
        .drop("__hash", "__tie")
        .withColumn("__range", F.spark_partition_id())
        .withColumn("__index", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    )
    kept = stored(ranged, "numbered")
    counts = sorted((r["__range"], r["n"]) for r in kept.groupBy("__range").agg(F.count("*").alias("n")).collect())
    starts, total = [], 0
    for number, count in counts:
        starts.append((number, total))
        total += count
    offsets = df.sparkSession.createDataFrame(starts, "__range int, __start long")
    rows = kept.join(F.broadcast(offsets), "__range")
    return (
        rows.withColumn("row_number", F.col("__start") + F.col("__index")).drop("__range", "__index", "__start"),
        total,
    )


def shuffle_into_shards(df: DataFrame, keys: Sequence[str], shards: int, seed: int) -> DataFrame:
    """The table with `row_number`, `shard` and `slot`.

    Null keys sort first and null texts are kept as they are. An empty table gives an empty table.
    Input columns with the names of the three are replaced.
    """
    if shards < 1:
        raise ValueError("shards must be 1 or more")
    numbered, n = number_rows(without(df, ["shard", "slot"]), keys)

    @F.pandas_udf("long")
    def position(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for rows in batches:
            yield pd.Series(permute(rows.to_numpy(), n, seed))

    placed = numbered.withColumn("__position", position("row_number"))
    return (
        placed.withColumn("shard", F.pmod("__position", F.lit(shards)).cast("int"))
        .withColumn("slot", F.expr(f"__position div {shards}"))
        .drop("__position")
    )


def write_shards(sharded: DataFrame, path: str) -> None:
    """Write one folder per shard, in slot order within each file."""
    sharded.repartition("shard").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
