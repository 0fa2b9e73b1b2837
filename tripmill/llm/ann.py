"""Approximate nearest neighbours by largest inner product, with a pruned graph per shard.

Vectors are dealt into shards of bounded size. One more component makes all vectors of a shard equally long,
so that the largest inner product is the smallest distance. A shard builds a directed graph: points enter in
batches of growing size; a greedy search of the graph so far proposes neighbours, and robust pruning keeps a
near one only if no kept one is closer to it by the factor ALPHA, so that long edges remain. Edges are added
in both directions and full nodes are pruned again. Each query is searched in each shard with a beam, and the
best of all shards are merged. A task reads the points of a shard, builds its graph and then reads the queries
batch by batch, so it holds one shard and one batch, however many queries there are.

Equal vectors are one point with its smallest ids, as many as a result can hold, so a vector that fills a
third of the table is one point of one shard. Scores are inner products of the given vectors in double
precision.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmill.llm.common import stored

SHARD_ROWS = 1 << 14
DEGREE = 28
SLOTS = 40
POOL = 56
BEAM = 128
WIDTH = 4
ALPHA = 1.15
BLOCK = 256
SEED = 11


class Graph:
    """Vamana graph over the rows of x, by squared distance."""

    def __init__(self, x: np.ndarray) -> None:
        self.x = np.ascontiguousarray(x, dtype=np.float32)
        self.norm = (self.x * self.x).sum(axis=1)
        n = len(x)
        self.out = np.full((n, SLOTS), -1, dtype=np.int32)
        self.degree = np.zeros(n, dtype=np.int64)
        self.start = int(self._to(self.x.mean(axis=0, keepdims=True), np.arange(n)[None, :]).argmin())
        order = np.random.default_rng(SEED).permutation(n)
        order = order[order != self.start]
        at, size = 0, 1
        while at < len(order):
            self._insert(order[at : at + size])
            at += size
            size = min(2 * size, BLOCK, max(1, n // 16))

    def _to(self, q: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Squared distances of each query to its row of ids; missing ids are infinitely far."""
        near = self.norm[ids] - 2 * np.einsum("bd,bkd->bk", q, self.x[ids]) + (q * q).sum(axis=1)[:, None]
        return np.where(ids >= 0, np.maximum(near, 0), np.inf)

    def search(self, q: np.ndarray, pool: int) -> tuple[np.ndarray, np.ndarray]:
        """The nearest points found for each query, nearest first, and their distances."""
        b = len(q)
        ids = np.full((b, pool), -1, dtype=np.int64)
        ids[:, 0] = self.start
        near = np.full((b, pool), np.inf, dtype=np.float32)
        near[:, 0] = self._to(q, ids[:, :1])[:, 0]
        done = np.zeros((b, pool), dtype=bool)
        seen = np.zeros((b, len(self.x)), dtype=bool)
        seen[:, self.start] = True
        while True:
            open_ = (ids >= 0) & ~done
            rows = np.flatnonzero(open_.any(axis=1))
            if not len(rows):
                return ids, near
            chosen = open_[rows] & (np.cumsum(open_[rows], axis=1) <= WIDTH)
            r, c = np.nonzero(chosen)
            done[rows[r], c] = True
            rank = np.cumsum(chosen, axis=1)[r, c] - 1
            new = np.full((len(rows), WIDTH, SLOTS), -1, dtype=np.int64)
            new[r, rank] = self.out[ids[rows[r], c]]
            new = np.sort(new.reshape(len(rows), -1), axis=1)
            fresh = new >= 0
            fresh[:, 1:] &= new[:, 1:] != new[:, :-1]
            fresh &= ~seen[rows[:, None], new]
            keep = int(fresh.sum(axis=1).max(initial=0))
            if not keep:
                continue
            order = np.argsort(~fresh, axis=1, kind="stable")[:, :keep]
            new = np.where(np.take_along_axis(fresh, order, 1), np.take_along_axis(new, order, 1), -1)
            i, j = np.nonzero(new >= 0)
            seen[rows[i], new[i, j]] = True
            all_ids = np.concatenate((ids[rows], new), axis=1)
            all_near = np.concatenate((near[rows], self._to(q[rows], new).astype(np.float32)), axis=1)
            all_done = np.concatenate((done[rows], np.zeros(new.shape, dtype=bool)), axis=1)
            best = np.argsort(all_near, axis=1, kind="stable")[:, :pool]
            ids[rows] = np.take_along_axis(all_ids, best, 1)
            near[rows] = np.take_along_axis(all_near, best, 1)
            done[rows] = np.take_along_axis(all_done, best, 1)

    def _prune(self, points: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Robust pruning: of each point's candidates the diverse near ones, at most DEGREE."""
        ids = np.where(ids == points[:, None], -1, ids)
        near = self._to(self.x[points], ids)
        order = np.argsort(near, axis=1, kind="stable")
        ids, near = np.take_along_axis(ids, order, 1), np.take_along_axis(near, order, 1)
        vectors = self.x[ids]
        apart = self.norm[ids][:, :, None] + self.norm[ids][:, None, :] - 2 * vectors @ vectors.transpose(0, 2, 1)
        left = np.isfinite(near)
        kept = np.full((len(points), SLOTS), -1, dtype=np.int64)
        each = np.arange(len(points))
        for k in range(DEGREE):
            some = left.any(axis=1)
            if not some.any():
                break
            pick = left.argmax(axis=1)
            kept[some, k] = ids[each, pick][some]
            left &= ALPHA**2 * apart[each, pick] > near
            left[each, pick] = False
        return kept

    def _insert(self, points: np.ndarray) -> None:
        found = self.search(self.x[points], POOL)[0]
        kept = self._prune(points, found)
        self.out[points] = kept
        self.degree[points] = (kept >= 0).sum(axis=1)
        i, j = np.nonzero(kept >= 0)
        target, source = kept[i, j], points[i]
        order = np.lexsort((source, target))
        target, source = target[order], source[order]
        starts = np.flatnonzero(np.concatenate(([True], target[1:] != target[:-1])))
        counts = np.diff(np.concatenate((starts, [len(target)])))
        nodes = target[starts]
        place = np.arange(len(target)) - np.repeat(starts, counts)
        fits = self.degree[nodes] + counts <= SLOTS
        add = np.repeat(fits, counts)
        self.out[target[add], self.degree[target[add]] + place[add]] = source[add]
        self.degree[nodes[fits]] += counts[fits]
        full = np.flatnonzero(~fits)
        for at in range(0, len(full), BLOCK):
            part = full[at : at + BLOCK]
            widest = int(counts[part].max())
            extra = np.full((len(part), widest), -1, dtype=np.int64)
            for row, k in enumerate(part):
                extra[row, : counts[k]] = source[starts[k] : starts[k] + counts[k]]
            kept = self._prune(nodes[part], np.concatenate((self.out[nodes[part]].astype(np.int64), extra), axis=1))
            self.out[nodes[part]] = kept
            self.degree[nodes[part]] = (kept >= 0).sum(axis=1)


def lengthened(x: np.ndarray) -> np.ndarray:
    """Vectors with one more component that makes all equally long."""
    size = (x.astype(np.float64) ** 2).sum(axis=1)
    return np.concatenate((x, np.sqrt(np.maximum(size.max() - size, 0))[:, None]), axis=1).astype(np.float32)


class Shard:
    """The graph of a shard's points, and the ids that each point stands for."""

    def __init__(self, x: np.ndarray, members: Sequence[Sequence[int]]) -> None:
        order = np.lexsort(x.T[::-1])  # the graph must not depend on the order of arrival
        self.members = [members[i] for i in order]
        self.exact = x[order].astype(np.float64)
        self.graph = Graph(lengthened(x[order]))

    def search(self, queries: np.ndarray, k: int) -> list[list[tuple[int, float]]]:
        """For each query up to k (id, score), best first and smaller ids first among equals."""
        out: list[list[tuple[int, float]]] = []
        for at in range(0, len(queries), BLOCK):
            part = queries[at : at + BLOCK]
            wide = np.concatenate((part, np.zeros((len(part), 1))), axis=1).astype(np.float32)
            found, _ = self.graph.search(wide, max(BEAM, k))
            for q, ids in zip(part.astype(np.float64), found):
                ids = ids[ids >= 0]
                scores = self.exact[ids] @ q
                rows = [(m, float(s)) for i, s in zip(ids.tolist(), scores.tolist()) for m in self.members[i]]
                out.append(sorted(rows, key=lambda r: (-r[1], r[0]))[:k])
        return out


def usable(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """(id, v) of rows that take part: ids and vectors that are no null, finite, not zero, of the usual length."""
    v = F.col(f"`{vector_column}`").cast("array<double>")
    rows = vectors.select(F.col(f"`{id_column}`").alias("id"), v.alias("v")).filter(
        "id IS NOT NULL AND v IS NOT NULL AND forall(v, c -> c IS NOT NULL AND NOT isnan(c) AND abs(c) != double('Infinity')) "
        "AND exists(v, c -> c != 0)"
    )
    usual = rows.groupBy(F.size("v").alias("n")).agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), "n").limit(1).collect()
    return rows.filter(F.size("v") == (usual[0]["n"] if usual else -1)).distinct()


def nearest(
    vectors: DataFrame, query_filter: str, *, k: int = 20, id_column: str = "vec_id", vector_column: str = "embedding"
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row under `query_filter`, an expression over id, its k nearest.

    Every row but the query's own is a candidate. Ties go to the smaller id. Rows without a usable vector
    take no part, nor do vectors of another length than most have; repeated rows count once; fewer candidates
    give fewer rows. Ids are whole numbers.
    """
    rows = stored(usable(vectors, id_column, vector_column), "vectors")
    # Of equal vectors only the k + 1 smallest ids can be in a result; the limit is applied before the shuffle.
    first = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    points = rows.withColumn("__n", first).filter(F.col("__n") <= k + 1).groupBy("v").agg(F.sort_array(F.collect_list(F.col("id").cast("long"))).alias("ids"))
    count = rows.count()
    shards = max(1, -(-count // SHARD_ROWS))
    dealt = points.withColumn("shard", F.pmod(F.xxhash64("v"), F.lit(shards)).cast("int"))
    queries = rows.filter(query_filter)
    asked = queries.groupBy("v").agg(F.min("id").alias("q"))
    sent = asked.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))

    def matrix(column: pa.Array) -> np.ndarray:
        return np.asarray(column.flatten()).reshape(len(column), -1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        points: list[pa.RecordBatch] = []
        now, shard = None, None
        for batch in batches:
            for own in dict.fromkeys(batch.column("shard").to_pylist()):
                part = batch.filter(pc.equal(batch.column("shard"), own))
                if own != now:
                    now, shard, points = own, None, []
                asks = pc.is_valid(part.column("q"))
                points.append(part.filter(pc.invert(asks)).select(["v", "ids"]))
                asked = part.filter(asks)
                if not asked.num_rows:
                    continue
                if shard is None and any(p.num_rows for p in points):
                    x = np.concatenate([matrix(p.column("v")) for p in points if p.num_rows])
                    shard, points = Shard(x, [ids for p in points for ids in p.column("ids").to_pylist()]), []
                hits = shard.search(matrix(asked.column("v")), k + 1) if shard else []
                found = [(key, *hit) for key, some in zip(asked.column("q").to_pylist(), hits) for hit in some]
                columns = zip(*found) if found else ([], [], [])
                kinds = (pa.int64(), pa.int64(), pa.float64())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["q", "vec_id", "score"])

    # The points of a shard come before the queries.
    rows_of = dealt.select("shard", "v", "ids", F.lit(None).cast("long").alias("q"))
    together = rows_of.unionByName(sent.select("shard", "v", F.lit(None).cast("array<long>").alias("ids"), F.col("q").cast("long")))
    streamed = together.repartition("shard").sortWithinPartitions("shard", F.col("q").isNotNull())
    found = streamed.mapInArrow(run, "q long, vec_id long, score double")
    best = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    top = found.withColumn("__n", F.row_number().over(best)).filter(F.col("__n") <= k + 1).drop("__n")
    named = queries.join(asked.withColumnRenamed("v", "av"), F.col("v") == F.col("av")).select(F.col("id").alias("query_id"), "q")
    each = named.join(top, "q").filter("vec_id != query_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return each.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
