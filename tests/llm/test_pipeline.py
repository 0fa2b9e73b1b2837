import pytest
from tripmill.llm import decontaminate, simhash
from tripmill.llm.queries import QUERIES

import corpus_pipeline
from llm_brute import brute_classes, brute_substring, ids_of


@pytest.fixture(scope="module")
def kept(spark):
    """The documents after each stage, from the whole smallest tables."""
    folder = "/root/testdata/sf0.001"
    now = spark.read.parquet(f"{folder}/documents.parquet")
    out = [("input", now.collect())]
    for name, stage in corpus_pipeline.STAGES:
        now = corpus_pipeline.stored(stage(spark, now, folder), f"test-{name}")
        out.append((name, now.collect()))
    return out


def test_every_stage_does_its_work(spark, kept):
    tables = dict(kept)
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language", "simhash", "substring", "decontamination", "packing"]
    columns = tables["input"][0].asDict().keys()
    for name in names[:-1]:
        assert tables[name][0].asDict().keys() == columns

    texts = {r["doc_id"]: r["text"] for r in tables["input"]}
    lettered = {k for k, t in texts.items() if any(c.isalpha() for c in t or "")}
    assert {r["doc_id"] for r in tables["language"]} == lettered

    ids = sorted(lettered)
    label = brute_classes([simhash.fingerprint(texts[i]) for i in ids])
    assert {r["doc_id"] for r in tables["simhash"]} == {ids[x] for x in label}

    left = sorted(r["doc_id"] for r in tables["simhash"])
    cut = dict(zip(left, brute_substring([texts[i] for i in left], 35)))
    got = {r["doc_id"]: r for r in tables["substring"]}
    assert set(got) == set(left)
    for i, (_, removed, text) in cut.items():
        assert got[i]["text"] == (text if removed else texts[i])
        assert not removed or got[i]["n_chars"] == len(text)

    items = [decontaminate.words_of(r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").collect()]
    for r in tables["substring"]:
        words = " ".join(decontaminate.words_of(r["text"]))
        if any(" ".join(w) in words for w in items):
            assert r["doc_id"] not in {x["doc_id"] for x in tables["decontamination"]}
    assert len(tables["decontamination"]) >= 0.9 * len(tables["substring"])

    by = {}
    for r in tables["packing"]:
        by.setdefault(r["doc_id"], []).append(r)
    assert set(by) == {r["doc_id"] for r in tables["decontamination"]}
    for r in tables["decontamination"]:
        assert sum(p["length"] for p in by[r["doc_id"]]) == len(ids_of(r["text"]))


def test_run_is_the_stages(spark, kept):
    got = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    want = dict(kept)["packing"]
    assert sorted(map(tuple, got.select("doc_id", "start", "length", "ids_crc32").collect())) == sorted((r["doc_id"], r["start"], r["length"], r["ids_crc32"]) for r in want)


def test_stages_keep_clashing_columns(spark, docs, clashing, write_table):
    bench = spark.createDataFrame([(1, "never said in any of the documents here at all")], "item_id long, text string")
    folder = write_table(benchmark=bench)
    now = clashing(docs((1, "some words here"), (1, "some words here"), (2, None), (None, "quite other words there"), (4, "12 34")))
    columns = now.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = corpus_pipeline.stored(stage(spark, now, folder), f"clash-{name}")
        assert now.columns == columns
    assert sorted(r["text"] for r in now.collect()) == ["quite other words there", "some words here"]


def test_stages_take_empty_tables(spark, docs, write_table):
    bench = spark.createDataFrame([(1, "never said in any of the documents here at all")], "item_id long, text string")
    folder = write_table(benchmark=bench)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs(), folder).count() == 0


def test_all_queries_are_registered():
    import __spark_entry__

    names = set(__spark_entry__.queries())
    assert "pipeline" in names and len([n for n in QUERIES if n.startswith("op")]) == 13
    assert set(QUERIES) <= names
