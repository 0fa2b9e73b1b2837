"""Near copies by SimHash, linked with a Gray-order hierarchical index.

Fingerprints have 64 bits. Equal ones are one node; two are linked if at most MAX_BITS bits differ.

Candidates meet by agreement: the 64 bits are cut into blocks, and two fingerprints within MAX_BITS bits
agree in all but MAX_BITS of them. Every choice of that many blocks is a bucket key, so no link can be
missed. In a bucket the index of the method does the search: fingerprints are sorted by Gray rank,
runs of them share a mask of equal bits, runs of runs share fewer, up to a root. A query walks down with
the differences counted so far; each node counts only bits that its parent did not share. A whole group is
left out once the count exceeds the limit, and taken in at once if even all its free bits could not exceed
it. Groups whose members all lie within the limit are joined by a chain, not by their pairs.

A bucket returns a spanning forest of its links, never its pairs, and Spark joins the forests into
components. A bucket with more than SPLIT_ROWS fingerprints is split once more by the blocks of
its remaining bits.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.llm import components
from tripmill.llm.common import stored

BITS = 64
MAX_BITS = 4
SHINGLE = 4
SEED = 42
SPLIT_ROWS = 1 << 16
FANOUT = 8
#: Pairs of queries and groups that are looked at together, at most.
FRONTIER = 1 << 22
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """SimHash of the word shingles of a text, repeats included; 0 without a word."""
    words = (text or "").encode().translate(LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1
    ends = np.cumsum(sizes)
    starts = (ends - sizes)[: len(words) - shingle + 1].tolist()
    stops = (ends[shingle - 1 :] - 1).tolist()
    digest = xxhash.xxh64_digest
    hashes = b"".join([digest(joined[a:b], SEED) for a, b in zip(starts, stops)])
    table = np.frombuffer(hashes, dtype=np.uint8).reshape(-1, 8)
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(table), 1 << 14):
        ones += np.unpackbits(table[at : at + (1 << 14)], axis=1).sum(axis=0, dtype=np.uint32)
    return int.from_bytes(np.packbits(2 * ones > len(table)).tobytes(), "big")


def with_fingerprint(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """The table with `fingerprint`, a signed long with the 64 bits."""

    @F.pandas_udf("long")
    def prints(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(np.array([fingerprint(t) for t in texts], dtype=np.uint64).view(np.int64))

    return docs.withColumn("fingerprint", prints(F.col(f"`{text_column}`")))


def as_hex(value: Column) -> Column:
    return F.lower(F.lpad(F.hex(value), 16, "0"))


def gray_rank(x: np.ndarray) -> np.ndarray:
    """Position of each number in the reflected Gray code."""
    x = x.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        x ^= x >> np.uint64(shift)
    return x


class GrayIndex:
    """Hierarchy of masks over distinct fingerprints in Gray order.

    levels[0] are the fingerprints themselves and levels[-1] is the root. Per node: `pattern`, the
    values of the bits all its members share, `own`, those of them that its parent does not share, and
    `free`, the number of bits in which members differ.
    """

    def __init__(self, prints: np.ndarray) -> None:
        self.prints = prints[np.argsort(gray_rank(prints), kind="stable")]
        both, either = self.prints, self.prints
        levels = [(both, either)]
        while len(both) > 1:
            at = np.arange(0, len(both), FANOUT)
            both, either = np.bitwise_and.reduceat(both, at), np.bitwise_or.reduceat(either, at)
            levels.append((both, either))
        shared = [~(a ^ b) for a, b in levels]
        self.levels = []
        for i, (both, _) in enumerate(levels):
            above = shared[i + 1][np.arange(len(both)) // FANOUT] if i + 1 < len(levels) else np.zeros(1, np.uint64)
            free = BITS - np.bitwise_count(shared[i]).astype(np.int64)
            self.levels.append((both, shared[i] & ~above, free))

    def links(self, limit: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of positions whose links connect exactly what all links connect."""
        top = len(self.levels) - 1
        for level in range(top, 0, -1):
            close = np.flatnonzero(self.levels[level][2] <= limit)
            if len(close):
                first = close * FANOUT**level
                member = (first[:, None] + np.arange(FANOUT**level)[None, :]).ravel()
                head = np.repeat(first, FANOUT**level)
                inside = member < len(self.prints)
                yield head[inside], member[inside]
        block = max(16, FRONTIER // len(self.prints))
        for start in range(0, len(self.prints), block):
            query = np.arange(start, min(start + block, len(self.prints)))
            node, count = np.zeros(len(query), np.int64), np.zeros(len(query), np.int64)
            for level in range(top, -1, -1):
                if level < top:
                    node = (node[:, None] * FANOUT + np.arange(FANOUT)[None, :]).ravel()
                    query, count = np.repeat(query, FANOUT), np.repeat(count, FANOUT)
                    # Each pair once: skip groups that end before the query.
                    inside = (node < len(self.levels[level][0])) & ((node + 1) * FANOUT**level > query)
                    node, query, count = node[inside], query[inside], count[inside]
                pattern, own, free = self.levels[level]
                count = count + np.bitwise_count((self.prints[query] ^ pattern[node]) & own[node])
                near = count <= limit
                whole = near & (count + free[node] <= limit)
                if whole.any():
                    yield query[whole], node[whole] * FANOUT**level
                more = near & ~whole
                node, query, count = node[more], query[more], count[more]
                if not len(node):
                    break


def join_labels(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Union of the sets of each pair; labels are the least position of each set."""
    while True:
        x, y = labels[a], labels[b]
        apart = x != y
        if not apart.any():
            return labels
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(labels, np.maximum(x, y), np.minimum(x, y))
        while True:
            jumped = labels[labels]
            if (jumped == labels).all():
                break
            labels = jumped


def forest(prints: np.ndarray, limit: int = MAX_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Edges from fingerprints to the head of their set within one bucket; repeats do not matter."""
    index = GrayIndex(np.unique(prints))
    labels = np.arange(len(index.prints))
    for a, b in index.links(limit):
        labels = join_labels(labels, a, b)
    moved = np.flatnonzero(labels != np.arange(len(labels)))
    return index.prints[moved], index.prints[labels[moved]]


def block_masks(blocks: int, bits: Iterator[int] | range = range(BITS)) -> list[int]:
    """Masks of all choices of blocks - MAX_BITS blocks of the given bits."""
    bits = list(bits)
    cuts = [bits[len(bits) * i // blocks : len(bits) * (i + 1) // blocks] for i in range(blocks)]
    return [
        sum(1 << b for i in chosen for b in cuts[i]) for chosen in itertools.combinations(range(blocks), blocks - MAX_BITS)
    ]


def blocks_for(n: int) -> int:
    """More blocks make longer and more keys: about 13, 21 or 27 bits, 5, 15 or 35 keys."""
    return 5 if n < 1 << 25 else 6 if n < 1 << 33 else 7


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def bucket_links(prints: DataFrame) -> DataFrame:
    """Edges (u, v) whose components are those of all pairs within MAX_BITS bits.

    `prints` has one row per distinct fingerprint.
    """
    blocks = blocks_for(prints.count())
    masks = block_masks(blocks)

    def keyed(df: DataFrame, choices: list[int], name: str) -> DataFrame:
        keys = F.array(*[
            F.struct(F.lit(i).alias("c"), F.col("fingerprint").bitwiseAND(F.lit(_signed(m))).alias("k")) for i, m in enumerate(choices)
        ])
        return df.withColumn(name, F.explode(keys))

    rows = keyed(prints, masks, "b").select("fingerprint", "b.c", "b.k")
    hot = stored(rows.groupBy("c", "k").agg(F.count("*").alias("n")).filter(F.col("n") > SPLIT_ROWS).select("c", "k", F.lit(True).alias("hot")), "hot")
    none = F.lit(-1)
    plain = rows
    parts = []
    if not hot.isEmpty():
        marked = rows.join(hot, ["c", "k"], "left")
        plain = marked.filter("hot IS NULL")
        for i, mask in enumerate(masks):
            rest = block_masks(blocks, [b for b in range(BITS) if not mask >> b & 1])
            parts.append(
                keyed(marked.filter(F.col("hot") & (F.col("c") == i)), rest, "b2").select(
                    "fingerprint", "c", "k", F.col("b2.c").alias("c2"), F.col("b2.k").alias("k2")
                )
            )
    rows = plain.select("fingerprint", "c", "k", none.alias("c2"), none.cast("long").alias("k2"))
    for part in parts:
        rows = rows.unionByName(part)
    keys = ["c", "k", "c2", "k2"]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(prints: np.ndarray) -> pa.RecordBatch:
            u, v = forest(prints)
            return pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], names=["u", "v"])

        open_key, open_rows = None, []
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [np.asarray(batch.column(i)) for i in range(5)]
            new = np.zeros(batch.num_rows, dtype=bool)
            new[0] = True
            for column in columns[1:]:
                new[1:] |= column[1:] != column[:-1]
            starts = np.flatnonzero(new)
            for start, stop in zip(starts, [*starts[1:], batch.num_rows]):
                key = tuple(c[start] for c in columns[1:])
                if key != open_key:
                    if sum(map(len, open_rows)) > 1:
                        yield found(np.concatenate(open_rows))
                    open_key, open_rows = key, []
                open_rows.append(columns[0][start:stop].view(np.uint64))
        if sum(map(len, open_rows)) > 1:
            yield found(np.concatenate(open_rows))

    dealt = rows.repartition(*keys).sortWithinPartitions(*keys)
    return dealt.mapInArrow(search, "u long, v long")


def classes(docs: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Fingerprint, root fingerprint of its component and the component's least id.

    `docs` has `fingerprint` and the id; the result has one row per distinct fingerprint. Null ids count
    only where a component has no other.
    """
    nodes = stored(docs.groupBy("fingerprint").agg(F.min(id_column).alias("least")), "prints")
    roots = components.connected(bucket_links(nodes.select("fingerprint")))
    rooted = nodes.join(roots.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").select(
        "fingerprint", F.coalesce("root", "fingerprint").alias("root"), "least"
    )
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rooted.join(least, "root").select("fingerprint", "root", "component_id")


def near_copies(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, fingerprint, component_id) of every row.

    Texts without a word have fingerprint 0 and are linked like any other. A null id is kept; repeated
    rows stay repeated. Other columns are ignored.
    """
    marked = stored(with_fingerprint(docs.select(F.col(f"`{id_column}`"), F.col(f"`{text_column}`")), text_column).drop(text_column), "fingerprints")
    found = classes(marked, id_column)
    return marked.join(found, "fingerprint").select(id_column, "fingerprint", "component_id")


def keep_one(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row of each component, the one with the least id, with all its columns.

    Of rows equal in id and text one is kept. A component whose ids are all null keeps one of them.
    """
    text_hash = F.xxhash64(F.coalesce(F.col(f"`{text_column}`"), F.lit("")))
    marked = stored(
        with_fingerprint(
            docs.select(F.col(f"`{id_column}`").alias("__id"), text_hash.alias("__text_hash"), F.col(f"`{text_column}`").alias("__text")), "__text"
        ).drop("__text"),
        "fingerprints",
    )
    roots = classes(marked, "__id").select("fingerprint", "root")
    first = F.min(F.struct(F.col("__id").isNull(), F.col("__id"), F.col("__text_hash")))
    kept = marked.join(roots, "fingerprint").groupBy("root").agg(first.alias("__keep")).select("__keep.__id", "__keep.__text_hash")
    same = F.col("__id").eqNullSafe(F.col(f"`{id_column}`")) & (F.col("__text_hash") == F.col("__own_hash"))
    found = docs.withColumn("__own_hash", text_hash).join(kept, same, "left_semi")
    return found.dropDuplicates([id_column, "__own_hash"]).drop("__own_hash")
