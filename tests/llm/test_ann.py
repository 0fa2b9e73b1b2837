import numpy as np
from tripmill.llm import ann
from tripmill.llm.queries import QUERIES

VECTORS = "vec_id long, embedding array<float>, label int, id string, v int, q int, shard int"


def brute(x, ids, query, k):
    scores = x.astype(np.float64) @ query.astype(np.float64)
    return sorted(((i, float(s)) for i, s in zip(ids, scores)), key=lambda r: (-r[1], r[0]))[:k]


def test_graph_recall_and_degrees():
    rng = np.random.default_rng(1)
    centres = rng.standard_normal((30, 32))
    x = (centres[rng.integers(0, 30, 3000)] + 0.7 * rng.standard_normal((3000, 32))) * rng.uniform(0.5, 2, (3000, 1))
    queries = x[::60]
    hits = ann.Shard(x.astype(np.float32), [[i] for i in range(3000)]).search(queries.astype(np.float32), 20)
    found = [len({i for i, _ in hit} & {i for i, _ in brute(x.astype(np.float32), range(3000), q, 20)}) for hit, q in zip(hits, queries.astype(np.float32))]
    assert np.mean(found) / 20 >= 0.95
    graph = ann.Graph(ann.lengthened(x))
    assert graph.degree.max() <= ann.SLOTS and (graph.out < 3000).all()
    assert np.isclose((graph.x**2).sum(axis=1), (graph.x**2).sum(axis=1)[0], rtol=1e-4).all()


def test_pruning_keeps_diverse_edges():
    x = np.array([[0, 0], [1, 0], [1.1, 0], [0, 1.5], [-2, 0]], dtype=np.float32)
    graph = ann.Graph(x)
    kept = graph._prune(np.array([0]), np.array([[1, 2, 3, 4]]))[0]
    assert kept[kept >= 0].tolist() == [1, 3, 4]  # 2 lies behind 1


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x", 1, 1, 1) for i, v in rows], VECTORS)


def test_exact_on_small_tables_with_copies_and_bad_rows(spark):
    rng = np.random.default_rng(2)
    x = rng.standard_normal((80, 8)).astype(np.float32).round(2)
    rows = [(i, x[i].tolist()) for i in range(80)]
    rows += [(100 + i, x[3].tolist()) for i in range(60)]  # many copies of one vector
    bad = [(200, None), (220, [0.0] * 8), (240, [float("nan")] * 8), (260, [float("inf")] + [1.0] * 7), (280, [1.0] * 3), (None, x[0].tolist()), (300, [None] + [1.0] * 7)]
    frame = vectors(spark, rows + bad + [(5, x[5].tolist())]).repartition(5)
    got = {}
    for r in ann.nearest(frame, "id % 20 = 0", k=20).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    ids, m = [i for i, _ in rows], np.array([v for _, v in rows], dtype=np.float32)
    assert set(got) == {i for i in ids if i % 20 == 0}
    for q, hits in got.items():
        keep = [n for n, i in enumerate(ids) if i != q]
        want = brute(m[keep], [ids[n] for n in keep], m[ids.index(q)], 20)
        assert [h[0] for h in sorted(hits)] == list(range(1, 21))
        assert [h[1] for h in sorted(hits)] == [i for i, _ in want]
        assert np.allclose([h[2] for h in sorted(hits)], [s for _, s in want], rtol=1e-12)


def test_several_shards_are_merged(spark, monkeypatch):
    monkeypatch.setattr(ann, "SHARD_ROWS", 30)
    x = np.random.default_rng(3).standard_normal((100, 6)).astype(np.float32)
    frame = vectors(spark, [(i, x[i].tolist()) for i in range(100)])
    got = ann.nearest(frame, "id = 40", k=5).orderBy("rank").collect()
    want = brute(np.delete(x, 40, 0), [i for i in range(100) if i != 40], x[40], 5)
    assert [r["vec_id"] for r in got] == [i for i, _ in want]


def test_recall_over_several_shards(spark, monkeypatch):
    """Queries reach a shard in many batches."""
    monkeypatch.setattr(ann, "SHARD_ROWS", 500)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "64")
    x = np.random.default_rng(4).standard_normal((2000, 24)).astype(np.float32)
    got = {}
    try:
        for r in ann.nearest(vectors(spark, [(i, v.tolist()) for i, v in enumerate(x)]), "id % 10 = 0", k=20).collect():
            got.setdefault(r["query_id"], set()).add(r["vec_id"])
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    found = [len(got[q] & {i for i, _ in brute(np.delete(x, q, 0), [i for i in range(2000) if i != q], x[q], 20)}) for q in range(0, 2000, 10)]
    assert np.mean(found) / 20 >= 0.9


def test_no_task_groups_all_queries(spark):
    found = ann.nearest(vectors(spark, [(i, [float(i), 1.0]) for i in range(50)]), "id % 2 = 0")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "CoGroups" not in plan


def test_empty_and_few(spark):
    assert ann.nearest(vectors(spark, []), "id % 20 = 0").count() == 0
    assert ann.nearest(vectors(spark, [(0, [1.0, 2.0])]), "id % 20 = 0").count() == 0
    assert [tuple(r) for r in ann.nearest(vectors(spark, [(0, [1.0, 2.0]), (1, [3.0, 0.5])]), "id % 20 = 0").collect()] == [(0, 1, 1, 4.0)]


def test_query_recall(spark):
    folder = "/root/testdata/sf0.01"
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").collect()
    ids, x = [r["vec_id"] for r in rows], np.array([r["embedding"] for r in rows], dtype=np.float32)
    got = {}
    for r in QUERIES["op6_ann"](spark, folder).collect():
        got.setdefault(r["query_id"], {})[r["vec_id"]] = r["score"]
    found = 0
    for q, hits in got.items():
        keep = [n for n, i in enumerate(ids) if i != q]
        want = dict(brute(x[keep], [ids[n] for n in keep], x[ids.index(q)], 20))
        found += len(want.keys() & hits.keys())
        assert len(hits) == 20 and all(np.isclose(s, want.get(i, s), rtol=1e-12) for i, s in hits.items())
    assert found / (20 * len(got)) >= 0.95
