import numpy as np
import pytest
from pyspark.sql import functions as F

from tripmill.llm import whitening
from tripmill.llm.queries import QUERIES

NAN, INF = float("nan"), float("inf")


def brute(vectors, count=4):
    """Per usable vector and component (deviation, |whitened|, explained), by a dense eigensolver."""
    x = [[int(np.floor(256.0 * c)) for c in v] for v in vectors]
    fit = np.array(sorted(set(map(tuple, x))), dtype=object)
    n, sums = len(fit), [int(s) for s in fit.sum(axis=0)]
    centred = fit.astype(float) - np.array([s / n for s in sums])
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1][:count], axes[:, ::-1][:, :count]
    white = (np.array(x, dtype=float) - np.array([s / n for s in sums])) @ axes / np.sqrt(values)
    trace = np.trace(centred.T @ centred / n)
    return n, [sum((n * a - s) ** 2 for a, s in zip(row, sums)) for row in x], white, values / trace


def table_of(spark, *vectors):
    return spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<float>")


@pytest.mark.parametrize("kind", ["random", "steep", "equal", "clustered", "one", "tied mean"])
def test_components_match_a_dense_eigensolver(kind):
    rng = np.random.default_rng(5)
    n = 1 if kind == "one" else 40
    values = {
        "random": rng.random(n), "steep": 10.0 ** -np.arange(n) + 1e-9 * np.arange(n), "equal": np.ones(n), "one": np.ones(1),
        "clustered": np.where(np.arange(n) < 7, 3.0, 1.0) + 1e-9 * rng.random(n), "tied mean": np.arange(n) - n // 2.0,
    }[kind]
    basis = np.linalg.qr(rng.standard_normal((n, n)))[0]
    a = (basis * values) @ basis.T
    a = (a + a.T) / 2
    found, vectors = whitening.spectral_components(a)
    assert np.allclose(found, np.linalg.eigvalsh(a)[::-1], atol=1e-13 * max(1, np.abs(values).max()))
    assert np.allclose(vectors.T @ vectors, np.eye(n), atol=1e-12)
    assert np.abs(a @ vectors - vectors * found).max() < 1e-12 * max(1, np.abs(values).max())
    top = whitening.spectral_components(a, 4)
    assert np.allclose(top[0], found[:4], atol=1e-13) and top[1].shape == (n, min(4, n))


def test_polar_factor_is_the_matrix_sign():
    rng = np.random.default_rng(6)
    basis = np.linalg.qr(rng.standard_normal((30, 30)))[0]
    values = np.concatenate((10.0 ** -np.arange(15), -(10.0 ** -np.arange(15))))
    sign = whitening.polar_factor((basis * values) @ basis.T)
    assert np.allclose(sign @ sign, np.eye(30), atol=1e-12) and abs(np.trace(sign)) < 1e-10


def test_query_matches_a_dense_eigensolver(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect()
    n, deviations, white, explained = brute([r["embedding"] for r in rows])
    place = {r["vec_id"]: i for i, r in enumerate(rows)}
    found = QUERIES["op12_whitening"](spark, sf_dir).collect()
    assert len(found) == 4 * len(rows)
    signs = {}
    for r in found:
        i, c = place[r["vec_id"]], r["component"] - 1
        assert r["n"] == n and r["deviation"] == deviations[i]
        assert abs(r["explained"] / explained[c] - 1) < 1e-9 and r["identity_error"] < 1e-9
        if abs(white[i, c]) > 1e-6:
            sign = np.sign(white[i, c] * r["whitened"])
            assert signs.setdefault(c, sign) == sign
        assert abs(abs(r["whitened"]) - abs(white[i, c])) < 1e-8


def test_edges(spark, clashing):
    rng = np.random.default_rng(8)
    good = rng.standard_normal((30, 3)).tolist()
    bad = [None, [1.0, None, 2.0], [NAN, 0.0, 0.0], [INF, 0.0, 0.0], [1.0, 2.0], [], [3e38, 0.0, 0.0]]
    df = table_of(spark, *good, *good[:7], *bad).withColumns({"n": F.lit("a"), "__X": F.lit("b")})
    found = whitening.whiten(clashing(df), components=4).collect()
    assert sorted({r["vec_id"] for r in found}) == list(range(37)) and len(found) == 37 * 3
    n, deviations, white, explained = brute([np.float32(v).tolist() for v in good])
    assert n == 30 and {r["n"] for r in found} == {30}
    by = {(r["vec_id"], r["component"]): r for r in found}
    for i in range(37):
        for c in range(3):
            assert int(by[i, c + 1]["deviation"]) == deviations[i % 30]
            assert abs(abs(by[i, c + 1]["whitened"]) - abs(white[i % 30, c])) < 1e-9
            assert by[i, c + 1]["explained"] == pytest.approx(explained[c], rel=1e-9)
    assert "SLOT" in found[0].asDict()


def test_nothing_to_whiten(spark):
    assert whitening.whiten(table_of(spark, [1.0]).limit(0)).count() == 0
    assert whitening.whiten(table_of(spark, [1.0, 2.0], [1.0, 2.0])).count() == 0
    assert whitening.whiten(table_of(spark, None, [], [])).count() == 0
    # One direction of two varies.
    found = whitening.whiten(table_of(spark, [1.0, 2.0], [1.0, 3.0], [1.0, 3.0])).collect()
    assert sorted((r["vec_id"], r["component"], abs(round(r["whitened"], 9))) for r in found) == [(0, 1, 1.0), (1, 1, 1.0), (2, 1, 1.0)]


def test_large_numbers_stay_exact(spark):
    vectors = [[1e15, 1.0], [2e15, 2.0], [1.5e15, -7.0], [1e15, 1.0]]
    df = table_of(spark, *vectors).withColumn("embedding", F.col("embedding").cast("array<double>"))
    n, deviations, _, _ = brute([np.float32(v).tolist() for v in vectors])
    found = whitening.whiten(df, components=1).collect()
    assert [int(r["deviation"]) for r in sorted(found, key=lambda r: r["vec_id"])] == deviations and n == 3
