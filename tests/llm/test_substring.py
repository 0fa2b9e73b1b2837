import hashlib
import random

import numpy as np
from pyspark.sql import functions as F
import pytest
from llm_brute import brute_substring as brute
from tripmill.llm import substring
from tripmill.llm.queries import QUERIES

def corpus(seed, n, window):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abé") for _ in range(rng.randint(1, 4)))
    shared = [[word() for _ in range(rng.randint(window - 2, 3 * window))] for _ in range(4)]
    texts = []
    for _ in range(n):
        parts = [rng.choice(shared) if rng.random() < 0.4 else [word() for _ in range(rng.randint(0, 2 * window))] for _ in range(rng.randint(0, 5))]
        texts.append(rng.choice([" ", "\n", " \t"]).join(w for p in parts for w in p))
    return texts


@pytest.mark.parametrize("window,class_bytes", [(3, 16 << 20), (7, 500), (35, 300)])
def test_matches_brute_force(spark, docs, monkeypatch, window, class_bytes):
    monkeypatch.setattr(substring, "CLASS_BYTES", class_bytes)
    monkeypatch.setattr(substring, "BUCKET_BYTES", class_bytes)
    monkeypatch.setattr(substring, "FLUSH_WINDOWS", 200)
    texts = [*corpus(window, 60, window), None, "", " \n", "a " * 200, "one word \x85 \x1c x", "same " * window + "end"]
    texts += texts[:3]
    frame = docs(*enumerate(texts)).repartition(4)
    got = {r["doc_id"]: r for r in substring.remove_repeats(frame, window=window).collect()}
    want = brute(texts, window)
    assert sum(w[1] for w in want) > 0
    for i, (n, removed, kept) in enumerate(want):
        r = got[i]
        assert (r["n_words"], r["n_removed"], r["kept_text"]) == (n, removed, kept)
        assert sum(s["stop"] - s["start"] for s in r["removed"]) == removed
        assert all(a["stop"] < b["start"] for a, b in zip(r["removed"], r["removed"][1:]))


def test_window_hashes_are_polynomials():
    known = substring.WordHashes()
    words = [b"a", b"b", b"c", b"a", b"b", b"c", b"d"]
    for window in (1, 2, 3, 5, 7, 8):
        got = substring.window_hashes(words, known, window)
        raw = []
        for i in range(len(words) - window + 1):
            total = 0
            for w in words[i : i + window]:
                total = (total * int(substring.BASE) + known[w]) % 2**64
            total ^= total >> 31
            total = total * 0xBF58476D1CE4E5B9 % 2**64
            raw.append(total ^ (total >> 29))
        assert got.tolist() == raw


def test_at_most_two_of_a_hash_leave_a_task():
    row = substring.packed(np.zeros(9, np.int64), np.array([0, 0, 0, 0, 1, 1, 1, 0, 1]), np.array([5, 5, 5, 5, 5, 5, 5, 6, 7], np.uint64), 2)
    assert np.frombuffer(row["hashes"][0].as_py(), "<u8").tolist() == [5, 5, 6, 5, 5, 7]
    assert np.frombuffer(row["classes"][0].as_py(), "<u4").tolist() == [0, 0, 0, 1, 1, 1]


def test_edge_tables(spark, docs, clashing):
    assert substring.remove_repeats(docs()).count() == 0
    row = "w " * 40
    got = substring.remove_repeats(clashing(docs((None, row), (1, row), (1, row), (2, None)))).collect()
    assert sorted((r["doc_id"] or 0, r["n_removed"]) for r in got) == [(0, 40), (1, 40), (1, 40), (2, 0)]


def test_repeated_rows_are_dealt_into_parts(spark, docs, monkeypatch):
    """A third of the rows are equal in id and text."""
    monkeypatch.setattr(substring, "CLASS_BYTES", 4_000)
    row = " ".join(f"r{i}" for i in range(40))
    others = [(d, " ".join(f"d{d}w{i}" for i in range(40))) for d in range(600)]
    df = docs(*[(-1, row)] * 300, *others).repartition(8)
    found = substring.remove_repeats(df, window=10)
    got = [(r["doc_id"], r["n_removed"], r["kept_text"]) for r in found.collect()]
    assert sorted(got) == sorted([(-1, 40, "")] * 300 + [(d, 0, t) for d, t in others])
    dealt = df.withColumn("__class", F.when(F.col("doc_id") < 0, 0).otherwise(F.col("doc_id") % 20 + 1))
    parts = substring.in_parts(dealt, substring.large_classes(dealt, "text"))
    sizes = parts.groupBy("__class", "__part").agg(F.sum(F.octet_length("text")).alias("n"))
    assert sizes.agg(F.max("n")).first()[0] <= 2 * substring.CLASS_BYTES


def test_query(spark, docs, write_table):
    texts = corpus(1, 30, 35)
    got = {r["doc_id"]: r for r in QUERIES["op5_substring"](spark, write_table(documents=docs(*enumerate(texts)))).collect()}
    for i, (n, removed, kept) in enumerate(brute(texts, 35)):
        assert (got[i]["n_words"], got[i]["n_removed"], got[i]["kept_sha256"]) == (n, removed, hashlib.sha256(kept.encode()).hexdigest())
