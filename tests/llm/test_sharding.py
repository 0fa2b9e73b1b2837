import zlib

import numpy as np
import pytest
from tripmill.llm import sharding
from tripmill.llm.queries import QUERIES, SHARD_SEED


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 16, 17, 1000, 4097])
def test_permutation_and_inverse(n):
    rows = np.arange(n)
    there = sharding.permute(rows, n, 5)
    assert sorted(there.tolist()) == list(range(n))
    assert (sharding.permute(there, n, 5, inverse=True) == rows).all()
    assert n < 100 or (there != sharding.permute(rows, n, 6)).any()


def test_large_numbers_stay_in_range():
    n = (1 << 45) + 12345
    rows = np.array([0, 1, n - 1, n // 2])
    there = sharding.permute(rows, n, 9)
    assert (there < n).all() and (there >= 0).all()
    assert (sharding.permute(there, n, 9, inverse=True) == rows).all()


def test_shuffle_is_even(  ):
    there = sharding.permute(np.arange(20_000), 20_000, 3)
    # Neighbours do not stay neighbours and low rows spread over all shards.
    assert abs(np.corrcoef(np.arange(20_000), there)[0, 1]) < 0.03
    assert np.bincount(there[:1600] % 16).min() > 60


def test_query_places(spark, docs, write_table):
    rows = [(i, "x" * (i % 7) if i % 5 else None) for i in range(101)] + [(None, "n"), (3, "twice"), (3, "twice")]
    folder = write_table(documents=docs(*rows).repartition(5))
    got = [r.asDict() for r in QUERIES["op1_sharding"](spark, folder).collect()]
    assert len(got) == len(rows)
    n = len(rows)
    by = {}
    for r in got:
        by.setdefault(r["shard"], []).append(r["slot"])
        assert r["law"] == "rows" and r["grown_shard"] is None
    assert set(by) == set(range(16))
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    assert max(map(len, by.values())) - min(map(len, by.values())) <= 1
    texts = sorted((i is not None, i or 0, (t or "")) for i, t in rows)
    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["size"], r["text_crc32"]) for r in got) == sorted(
        (a, i, len(t.encode()) + 1, zlib.crc32(t.encode())) for a, i, t in texts
    )
    # Any place can be computed: the k-th smallest key is row k.
    ids = sorted((r["doc_id"] for r in got if r["doc_id"] is not None))
    for r in got:
        row = sharding.row_at(r["shard"], r["slot"], n, 16, SHARD_SEED)
        assert (r["doc_id"] is None and row == 0) or ids[row - 1] == r["doc_id"]


def test_same_places_for_other_files(spark, docs):
    rows = [(i % 40, f"t{i}") for i in range(80)]
    one = sharding.shuffle_into_shards(docs(*rows).coalesce(1), ["doc_id"], 4, 1)
    two = sharding.shuffle_into_shards(docs(*rows[::-1]).repartition(7), ["doc_id"], 4, 1)
    take = lambda df: sorted((r["text"], r["shard"], r["slot"]) for r in df.collect())
    assert take(one) == take(two)


def test_empty_and_clashing(spark, docs, clashing):
    assert sharding.shuffle_into_shards(docs(), ["doc_id"], 3, 1).count() == 0
    some = sharding.shuffle_into_shards(clashing(docs((1, "a"), (2, None))), ["doc_id"], 3, 1)
    assert [c.lower() for c in some.columns].count("slot") == 1 and some.count() == 2
    with pytest.raises(ValueError):
        sharding.shuffle_into_shards(docs(), ["doc_id"], 0, 1)


def test_written_shards_are_in_slot_order(spark, docs, tmp_path):
    sharding.write_shards(sharding.shuffle_into_shards(docs(*[(i, "t") for i in range(30)]), ["doc_id"], 3, 1), f"{tmp_path}/s")
    got = spark.read.parquet(f"{tmp_path}/s/shard=1").collect()
    assert [r["slot"] for r in got] == list(range(10))
