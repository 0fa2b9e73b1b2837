import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tripmill.llm import lines
from tripmill.llm.queries import QUERIES

WHITE = " \t\n\x0b\x0c\r"
LOWER = str.maketrans(lines.UPPER, lines.UPPER.lower())


def brute(rows, min_chars=20, min_docs=3):
    """(n_lines, n_dropped, kept) of each (id, text)."""
    split = [(t or "").split("\n") for _, t in rows]
    keys = [[line.strip(WHITE).translate(LOWER) for line in ls] for ls in split]
    held = defaultdict(set)
    for (i, _), ks in zip(rows, keys):
        for k in ks:
            if len(k) >= min_chars:
                held[k].add(-1 if i is None else i)
    out = []
    for (i, _), ls, ks in zip(rows, split, keys):
        gone = [len(held[k]) >= min_docs and max(held[k]) != (-1 if i is None else i) if k in held else False for k in ks]
        out.append((len(ls), sum(gone), "\n".join(x for x, g in zip(ls, gone) if not g)))
    return out


def check(spark, rows, **options):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = lines.drop_shared_lines(df, **options).collect()
    mine = sorted((str(r["doc_id"]), str(r["text"]), r["n_lines"], r["n_dropped"], r["kept_text"]) for r in found)
    theirs = sorted((str(i), str(t), *b) for (i, t), b in zip(rows, brute(rows)))
    assert mine == theirs


COMMON = "This line is on many documents"


def test_threshold_and_keeper(spark):
    other = "Another line on two documents"
    rows = [
        (1, f"{COMMON}\nown\n{other}"),
        (2, f"  {COMMON.upper()}\t\nsecond\n\n{COMMON}"),
        (3, f"{other}\n{COMMON}\r\n{COMMON}\nthird"),
    ]
    check(spark, rows)
    found = {r["doc_id"]: r["kept_text"] for r in lines.drop_shared_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == {1: f"own\n{other}", 2: "second\n", 3: rows[2][1]}


def test_edges(spark):
    rows = [
        (None, f"{COMMON}\nx"), (None, COMMON), (1, None), (2, ""), (3, "\n\n"), (4, COMMON), (4, COMMON), (4, f"{COMMON}\ny"),
        (5, "ä" * 19), (6, "ä" * 19), (7, "ä" * 19), (8, "Ä" * 20 + "\nshort"), (9, "Ä" * 20), (10, "Ä" * 20 + " "), (11, "Ä" * 20),
        (12, " " * 30), (13, " " * 30), (14, " " * 30), (15, f"{COMMON}\n" * 5_000 + "end"), (16, "long " * 100_000),
        (17, "x" * 19 + " "), (18, "x" * 19 + " "), (19, "X" * 19 + " "),
    ]
    check(spark, rows)


def test_repeated_ids_are_one_document(spark):
    check(spark, [(1, COMMON)] * 3 + [(2, COMMON)])
    check(spark, [(1, COMMON)] * 3 + [(None, COMMON), (None, f"{COMMON} "), (2, COMMON)])


@pytest.mark.parametrize("hot_keys", [0, 2])
def test_hot_and_other_keys_agree(spark, monkeypatch, hot_keys):
    monkeypatch.setattr(lines, "HOT_LINES", 5)
    monkeypatch.setattr(lines, "HOT_KEYS", hot_keys)
    rng = random.Random(3)
    pool = [f"line number {i} of the pool" for i in range(12)]
    rows = [(rng.choice([i, i // 2, None]), "\n".join(rng.choice(pool[: 1 + i % 12]) for _ in range(rng.randrange(6)))) for i in range(80)]
    check(spark, rows)


def test_empty_table_and_clashing_columns(spark, docs, clashing):
    assert lines.drop_shared_lines(docs().limit(0)).count() == 0
    df = clashing(docs(*[(i, f"{COMMON}\n{i}") for i in range(4)])).withColumns({"kept_text": F.lit(1), "__R1": F.lit(2), "pos": F.lit(3), "line": F.lit("z")})
    found = {r["doc_id"]: (r["n_dropped"], r["kept_text"], r["pos"]) for r in lines.drop_shared_lines(df).collect()}
    assert found == {0: (1, "0", 3), 1: (1, "1", 3), 2: (1, "2", 3), 3: (0, f"{COMMON}\n3", 3)}


def test_query_matches_plain_version(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    expected = {i: (n, d, hashlib.sha256(k.encode()).hexdigest()) for (i, _), (n, d, k) in zip(rows, brute(rows))}
    found = {r["doc_id"]: (r["n_lines"], r["n_dropped"], r["kept_sha256"]) for r in QUERIES["op13_lines"](spark, sf_dir).collect()}
    assert found == expected


def test_hot_line_is_never_brought_together(spark):
    """Before the counts of a line meet, each task has added its own up."""
    df = spark.range(1000).select(F.col("id").alias("doc_id"), F.lit(COMMON).alias("text"))
    rows = df.select(F.col("doc_id").alias("id"), F.lit(0).alias("r1"), F.lit(0).alias("r2"), "text")
    found = lines.shared_keys(lines.keyed_lines(rows, 20), 3)
    assert [(r["documents"], r["keeper"], r["n"]) for r in found.collect()] == [(1000, 999, 1000)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("partial_count(1)") >= 2
