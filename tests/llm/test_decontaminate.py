import random

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st
from tripmill.llm import decontaminate as dc
from tripmill.llm.queries import QUERIES

BENCH = "item_id long, text string, extra int"


def plain_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


@given(st.lists(st.integers(1, 5), max_size=80), st.lists(st.integers(0, 6), max_size=40))
def test_lcs(a, b):
    assert dc.lcs_length(a, b) == plain_lcs(a, b)


@given(st.text())
def test_fast_words_are_the_words(text):
    for t in (text, "".join(c for c in text if c < "\u0100"), "Ünï_cödé 1½² ª\xa0b\x85c\x1cd_e"):
        assert [w if isinstance(w, str) else w.decode("latin-1") for w in dc.fast_words(t)] == dc.words_of(t)


def made(seed=1, n_docs=150):
    rng = random.Random(seed)
    common = ["the", "of", "and", "to", "in"]
    rare = ["".join(rng.choice("bcdfgaeiou") for _ in range(rng.randint(3, 9))) for _ in range(900)]
    word = lambda: rng.choice(common) if rng.random() < 0.4 else rng.choice(rare)
    items = {i: [word() for _ in range(rng.choice([9, 15, 16, 17, 32, 40, 59, 90]))] for i in range(30)}
    docs, truth = {}, {}
    for d in range(n_docs):
        words = [word() for _ in range(rng.randint(0, 400))]
        kind = d % 5
        if kind < 2:
            i = rng.randrange(30)
            said = list(items[i])
            if kind == 1:  # a paraphrase: some words replaced, none near the end
                for k in rng.sample(range(len(said) * 3 // 4), len(said) // 8):
                    said[k] = "changed"
            at = rng.randint(0, len(words))
            words[at:at] = [w.upper() if rng.random() < 0.1 else w for w in said]
            truth[d] = i
        docs[d] = ", ".join(words) + "."
    return items, docs, truth


def test_planted_items_are_found_and_others_are_not(spark, docs):
    items, texts, truth = made()
    bench = spark.createDataFrame([(i, " ".join(w), 1) for i, w in items.items()], BENCH)
    got = {r["id"]: r for r in dc.scan(docs(*texts.items()).repartition(4), bench).collect()}
    assert set(got) == set(texts)
    for d, r in got.items():
        assert r["contaminated"] == (d in truth), (d, r, truth.get(d))
        if d in truth:
            assert r["best_item"] == truth[d] and r["coverage"] >= 0.8


def test_matches_brute_force_over_all_windows(spark, docs):
    """What the cosine search leaves out must not be a copy by the exact check."""
    items, texts, _ = made(2, 40)
    known = dc.Benchmark([(i, " ".join(w), None) for i, w in items.items()])
    bench = spark.createDataFrame([(i, " ".join(w), 1) for i, w in items.items()], BENCH)
    got = {r["id"]: r["n_items"] for r in dc.scan(docs(*texts.items()), bench).collect()}
    for d, text in texts.items():
        ids = np.array([known.vocabulary.get(w, 0) for w in dc.words_of(text)], dtype=np.int64)
        found = set()
        for i, item in enumerate(known.items):
            width = next(m for m, members in known.by_blocks.items() if i in members) * dc.BLOCK
            for at in range(0, max(1, len(ids)), width // 2):
                if known.judge(i, ids[at : at + width]):
                    found.add(i)
        assert got[d] == len(found)


def test_basis_is_the_svd(spark, docs):
    items, texts, _ = made(3, 60)
    known = dc.Benchmark([(i, " ".join(w), None) for i, w in items.items()])
    coded = dc.encoded(docs(*texts.items()), known, "doc_id", "text")
    basis = dc.latent_basis(coded, known)
    rows = []
    for r in coded.collect():
        ids = np.frombuffer(r["ids"], "<i4")
        for at in range(0, len(ids), dc.BLOCK * dc.PASSAGE_BLOCKS):
            rows.append(np.bincount(ids[at : at + dc.BLOCK * dc.PASSAGE_BLOCKS], minlength=known.size).astype(float))
    counts = np.array(rows)
    df = (counts > 0).sum(axis=0)
    idf = np.where(df <= dc.COMMON_SHARE * len(rows), np.log((len(rows) + 1) / (df + 1)), 0)
    idf[0] = 0
    items = np.array([np.bincount(ws, minlength=known.size) for ws in known.items]) * idf
    matrix = counts * idf
    matrix = np.concatenate((matrix, items * np.sqrt((matrix**2).sum() / (items**2).sum())))
    best = np.linalg.svd(matrix, compute_uv=False)[: dc.RANK]
    some = idf > 0
    directions = basis[some] / idf[some, None]
    ours = np.linalg.qr(directions)[0]
    # The space found holds nearly as much as the best one of its rank, and lengths tell its singular values.
    assert ((matrix[:, some] @ ours) ** 2).sum() > 0.9 * (best**2).sum()
    assert np.allclose(1 / np.linalg.norm(directions, axis=0)[:10] ** 2, best[:10], rtol=0.15)


def test_the_basis_is_fitted_on_all_documents(spark, docs, monkeypatch):
    """However few documents FIT_DOCUMENTS names, the passages of all of them make the basis."""
    items, texts, _ = made(3, 60)
    known = dc.Benchmark([(i, " ".join(w), None) for i, w in items.items()])
    coded = dc.encoded(docs(*texts.items()), known, "doc_id", "text")
    monkeypatch.setattr(dc, "FIT_DOCUMENTS", 1 << 30)
    whole = dc.latent_basis(coded, known)
    monkeypatch.setattr(dc, "FIT_DOCUMENTS", 10)
    assert np.allclose(dc.latent_basis(coded, known), whole, rtol=1e-3, atol=1e-3 * abs(whole).max())


def test_a_sketch_is_the_product(spark, docs, monkeypatch):
    """With frequent words multiplied as a matrix and the others row by row."""
    monkeypatch.setattr(dc, "FREQUENT", 5)
    items, texts, _ = made(3, 20)
    known = dc.Benchmark([(i, " ".join(w), None) for i, w in items.items()])
    coded = dc.encoded(docs(*texts.items()), known, "doc_id", "text")
    rng = np.random.default_rng(1)
    idf, test = np.maximum(rng.standard_normal(known.size), 0), rng.standard_normal((known.size, 7))
    idf[0] = 0
    rows = []
    for r in coded.collect():
        ids = np.frombuffer(r["ids"], "<i4")
        for at in range(0, len(ids), dc.BLOCK * dc.PASSAGE_BLOCKS):
            rows.append(np.bincount(ids[at : at + dc.BLOCK * dc.PASSAGE_BLOCKS], minlength=known.size) * idf)
    matrix = np.array(rows)
    assert np.allclose(dc.sketch(coded, idf, test), matrix.T @ (matrix @ test), rtol=1e-3, atol=1e-3)


def test_answer_decides_for_partial_copies():
    words = [f"w{i}" for i in range(20)]
    known = dc.Benchmark([(1, " ".join(words), " ".join(words[-3:]))])
    ids = np.array(known.items[0])
    assert known.judge(0, ids) == 1.0
    part = np.concatenate((ids[:4], ids[10:]))
    assert known.judge(0, part) == pytest.approx(0.7)
    assert known.judge(0, ids[:14]) == 0.0  # as much of it, but without the answer
    assert known.judge(0, ids[-11:]) == 0.0


def test_edges(spark, docs, clashing):
    bench = spark.createDataFrame([(1, "one two three four five six seven eight nine ten", 1), (2, None, 1), (3, "too short", 1)], BENCH)
    text = "x one two three four five six seven eight nine ten y"
    rows = clashing(docs((1, None), (2, ""), (3, text), (3, text), (None, text), (5, "too short"), (6, "word " * 100_000 + text), (7, "not too long, not short")))
    got = sorted((r["id"] or 0, r["contaminated"]) for r in dc.scan(rows, bench).collect())
    assert got == [(0, True), (1, False), (2, False), (3, True), (3, True), (5, True), (6, True), (7, False)]
    kept = dc.drop_copies(rows, bench)
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 2, 7] and kept.columns == rows.columns
    assert dc.scan(docs(), bench).count() == 0
    assert not dc.scan(docs((1, text)), bench.limit(0)).first()["contaminated"]


def test_an_item_in_one_row_is_found(spark, docs):
    text = "one two three four five six seven eight nine ten"
    bench = spark.createDataFrame([(1, text, 1)], BENCH)
    assert dc.scan(docs((1, f"x {text} y")), bench).first()["contaminated"]
    assert not dc.scan(docs((1, text[: len(text) // 2])), bench).first()["contaminated"]


def test_an_item_in_a_third_of_short_rows_is_found(spark, docs):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(300)]
    items = {i: " ".join(rng.sample(words, 20)) for i in range(10)}
    rows = [(d, f"x{d} {items[0]} y{d}" if d % 3 == 0 else " ".join(rng.sample(words, 25))) for d in range(60)]
    got = {r["id"]: r["best_item"] for r in dc.scan(docs(*rows), spark.createDataFrame([(i, t, 1) for i, t in items.items()], BENCH)).collect()}
    assert got == {d: 0 if d % 3 == 0 else None for d in range(60)}


def test_a_stretched_copy_is_found_at_any_offset(spark, docs):
    item = [f"w{i}" for i in range(32)]
    stretched = [x for w in item for x in (w, "and")]
    texts = {at: " ".join(["of"] * at + stretched + ["of"] * 70) for at in range(0, 64, 4)}
    known = dc.Benchmark([(1, " ".join(item), None)])
    for text in texts.values():
        assert dc.lcs_length(known.items[0], [known.vocabulary.get(w, 0) for w in dc.words_of(text)]) == 32
    got = dc.scan(docs(*texts.items()), spark.createDataFrame([(1, " ".join(item), 1)], BENCH)).collect()
    assert {r["id"]: r["coverage"] for r in got} == dict.fromkeys(texts, 1.0)


def test_latent_search_alone_finds_the_items(spark, docs, monkeypatch):
    """With the basis fitted on a sample, and no item sought by its words."""
    monkeypatch.setattr(dc, "FIT_DOCUMENTS", 100)
    monkeypatch.setattr(dc.Benchmark, "marks", lambda *_: {})
    items, texts, truth = made(5, 400)
    bench = spark.createDataFrame([(i, " ".join(w), 1) for i, w in items.items()], BENCH)
    got = {r["id"]: r["best_item"] for r in dc.scan(docs(*texts.items()).repartition(4), bench).collect()}
    found = sum(got[d] == i for d, i in truth.items())
    assert found >= 0.9 * len(truth) and sum(v is not None for v in got.values()) == found


def test_few_items_are_sought_by_their_words(spark, sf_dir):
    known = dc.read_benchmark(spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    counts, n = dc.document_frequencies(dc.encoded(documents, known, "doc_id", "text"), known.size)
    marked = {i for some in known.marks(counts <= dc.COMMON_SHARE * n, counts).values() for i in some}
    assert len(marked) <= 0.05 * len(known.items)


def test_short_items_are_whole_runs(spark, docs):
    bench = spark.createDataFrame([("a", "who wrote it", None), ("b", "name the sea", "baltic"), ("c", "word", None)], "item_id string, text string, answer string")
    texts = {
        1: "x who wrote it y", 2: "who it wrote", 3: "name the sea: Baltic", 4: "name the sea", 5: "", 6: "a word", 7: "z " * 15 + "who", 8: "wrote it",
        9: "p " * 14 + "who wrote it", 10: "name the sea" + " q" * 60 + " baltic",
    }
    got = {r["id"]: r["best_item"] for r in dc.scan(docs(*texts.items()).coalesce(1), bench).collect()}
    assert got == {1: "a", 2: None, 3: "b", 4: None, 5: None, 6: "c", 7: None, 8: None, 9: "a", 10: None}


def test_vocabulary_is_checked(spark, monkeypatch):
    monkeypatch.setattr(dc, "MAX_SKETCH", 100)
    with pytest.raises(ValueError):
        dc.read_benchmark(spark.createDataFrame([(1, "a b c", 1)], BENCH))


def test_benchmark_size_is_checked(spark, monkeypatch):
    monkeypatch.setattr(dc, "MAX_BENCHMARK_BYTES", 10)
    with pytest.raises(ValueError):
        dc.read_benchmark(spark.createDataFrame([(1, "a b c", 1)], BENCH))


def test_query(spark, sf_dir):
    rows = QUERIES["op7_decontamination"](spark, sf_dir).collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    items = {r["item_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()}
    assert {r["doc_id"] for r in rows} == set(texts)
    for r in rows:
        words = " ".join(dc.words_of(texts[r["doc_id"]]))
        assert r["contaminated"] or not any(" ".join(dc.words_of(t)) in words for t in items.values())
