import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tripmill.operators import increments, ingest, membership, state
from tripmill.schemas import COMPLETED, REQUESTED

SEEN = "id string, at string"
TYPED = (
    "event_id string, ride_id string, event_type string, event_timestamp timestamp, rider_id string, driver_id string, "
    "fare_cents bigint, distance_meters double"
)


def ids(spark, *values):
    return spark.createDataFrame([(v, f"t{i:03d}") for i, v in enumerate(values)], SEEN)


def test_bits_are_read_from_the_lowest_of_the_first_byte(spark, rows):
    made = spark.createDataFrame([(0,), (9,), (32767,)], "p bigint").agg(F.bitmap_construct_agg("p").alias("b"))
    asked = spark.createDataFrame([(p,) for p in (0, 1, 8, 9, 10, 32766, 32767)], "p bigint").crossJoin(made)
    got = {r["p"] for r in rows(asked.filter(membership.bit_is_set(F.col("b"), F.col("p"))))}
    assert got == {0, 9, 32767}


@pytest.mark.parametrize("n", [1, 2047, 2048, 2049, 10**6])
def test_bits_for_sixteen_per_id(n):
    bits = membership.bits_for(n)
    assert bits >= 16 * n and bits & (bits - 1) == 0 and (bits < 32 * n or bits == 1 << 15)


@pytest.mark.parametrize("bits", [1 << 15, 1 << 24])
def test_unseen_equals_a_join_with_the_whole_history(spark, rows, tmp_path, bits):
    rng = random.Random(3)
    history = membership.SeenIds(spark, str(tmp_path / "seen"), bits=bits).create()
    old = []
    for batch in range(3):
        part = [f"id{rng.randrange(40_000)}" for _ in range(4_000)] + [None]
        old += part
        history.remember(ids(spark, *part), "id", batch)
    arrived = ids(spark, *[f"id{rng.randrange(40_000)}" for _ in range(3_000)], "", "id7", "id7")
    expected = state.unseen(arrived, ids(spark, *old), "id", ["at"])
    got = history.unseen(arrived, "id", ["at"])
    assert sorted(map(str, rows(got))) == sorted(map(str, rows(expected)))


def test_few_suspects_and_only_batches_that_hold_them_are_read(spark, tmp_path):
    n = 20_000
    history = membership.SeenIds(spark, str(tmp_path / "seen"), bits=membership.bits_for(4 * n)).create()
    for batch in range(4):
        history.remember(spark.range(n).select(F.concat(F.lit(f"b{batch}-"), "id").alias("id")), "id", batch)
    again = spark.range(50).select(F.concat(F.lit("b2-"), "id").alias("id"))
    new = spark.range(n).select(F.concat(F.lit("new-"), "id").alias("id"))
    arrived = again.union(new)
    # One new id in sixteen, at a history that fills its bits; here four batches of a space for four.
    suspects = history.suspects(arrived, "id")
    assert suspects.filter("id LIKE 'b2-%' AND batch = 2").count() == 50
    assert suspects.select("id").distinct().count() < 50 + n / 14
    assert history.seen(arrived, "id").count() == 50
    only = history.suspects(again.union(spark.range(0).select(F.lit("x").alias("id"))), "id").select("batch").distinct()
    wanted = [r[0] for r in only.collect()]
    there = history.ids().filter(F.col("batch").isin(wanted))
    assert there.count() == n * len(wanted) and 2 in wanted


def test_a_batch_again_replaces_itself_and_an_empty_history_knows_nothing(spark, tmp_path):
    history = membership.SeenIds(spark, str(tmp_path / "seen")).create()
    assert history.unseen(ids(spark, "a", "a", None), "id", ["at"]).count() == 2
    history.remember(ids(spark, "a", "b"), "id", 0)
    history.remember(ids(spark, "a"), "id", 0)
    assert history.ids().count() == 1
    assert {r["id"] for r in history.unseen(ids(spark, "a", "b"), "id", ["at"]).collect()} == {"b"}
    assert history.unseen(ids(spark).filter("false"), "id", ["at"]).count() == 0


def typed(spark, seed, n=400, days=40):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        at = dt.datetime(2024, 1, 1) + dt.timedelta(days=rng.randrange(days), minutes=rng.randrange(1440))
        kind = COMPLETED if rng.random() < 0.7 else REQUESTED
        row = (f"e{seed}-{i}", f"r{i % 60}", kind, at, rng.choice([None, f"p{rng.randrange(30)}"]), f"d{rng.randrange(9)}", i, 10.0 * i)
        out += [row] * rng.choice([1, 1, 2])
    return spark.createDataFrame(out, TYPED)


def plain_report(events):
    first = events.dropDuplicates(["ride_id", "event_type", "event_timestamp"])
    done = F.col("event_type") == COMPLETED
    return first.groupBy(F.to_date(F.date_trunc("month", "event_timestamp")).alias("period")).agg(
        F.count_if(done).alias("rides"),
        F.sum(F.when(done, F.col("fare_cents"))).alias("fare_cents"),
        F.sum(F.when(done, F.col("distance_meters"))).cast("bigint").alias("distance_meters"),
        F.countDistinct(F.when(done, F.col("driver_id"))).alias("drivers"),
        F.countDistinct(F.when(done, F.col("rider_id"))).alias("riders"),
    )


def test_increments_equal_a_full_build_and_late_days_are_recomputed_alone(spark, rows, tmp_path):
    parts = [typed(spark, 1), typed(spark, 2, days=12), typed(spark, 3, n=5, days=2)]
    store = increments.DailyGold(spark, str(tmp_path / "gold")).create()
    assert store.report().count() == 0
    touched = [store.apply(p) for p in parts]
    assert len(touched[2]) <= 2 and set(touched[2]) <= set(touched[0])
    whole = parts[0].union(parts[1]).union(parts[2])
    expected = sorted(map(str, rows(plain_report(whole))))
    assert sorted(map(str, rows(store.report()))) == expected
    numbers = store.numbers().count()
    store.apply(parts[1])
    store.apply(parts[0].filter("false"))
    assert store.numbers().count() == numbers == store.numbers().select("number").distinct().count()
    assert sorted(map(str, rows(store.report()))) == expected


def test_untouched_days_keep_their_files(spark, tmp_path):
    store = increments.DailyGold(spark, str(tmp_path / "gold")).create()
    store.apply(typed(spark, 1))
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "gold").rglob("part-*")}
    (day,) = store.apply(typed(spark, 5, n=4, days=1))
    changed = {p for p in before if not p.exists() or p.stat().st_mtime_ns != before[p]}
    assert changed and all(f"event_date={day}" in str(p) for p in changed)


PAYLOADS = [
    ("1", "a", '{"x": 1, "y": "t"}'),
    ("2", "a", '{"x": 2.5, "y": "u", "z": [1]}'),
    ("3", "a", '{"x": "3", "n": null, "o": {"k": true}}'),
    ("3", "a", "{broken"),
    ("3", "a", None),
    ("1", "b", "[1, 2]"),
    ("1", "b", "{}"),
    ("2", None, '{"x": true}'),
]


def test_drift_tells_fields_that_come_and_go(spark, rows):
    frame = spark.createDataFrame(PAYLOADS, "month string, event_type string, data string")
    got = {(r["event_type"], r["field"], r["kind"]): (r["rows"], r["first_seen"], r["last_seen"], r["is_new"], r["is_gone"])
           for r in rows(ingest.payload_drift(frame, "month", "event_type"))}
    assert got == {
        ("a", "x", "number"): (2, "1", "2", False, True),
        ("a", "x", "text"): (1, "3", "3", True, False),
        ("a", "y", "text"): (2, "1", "2", False, True),
        ("a", "z", "array"): (1, "2", "2", True, True),
        ("a", "n", "null"): (1, "3", "3", True, False),
        ("a", "o", "object"): (1, "3", "3", True, False),
        ("a", None, "unreadable"): (1, "3", "3", True, False),
        ("a", None, "missing"): (1, "3", "3", True, False),
        ("b", None, "unreadable"): (1, "1", "1", False, False),
        (None, "x", "boolean"): (1, "2", "2", False, False),
    }


def test_each_payload_is_parsed_once(spark):
    frame = spark.createDataFrame(PAYLOADS, "month string, event_type string, data string")
    plan = ingest.payload_drift(frame, "month", "event_type")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lower().replace("_", "").count("parsejson") == 1
    messages = frame.select(F.lit("e").alias("event_id"), F.lit("r").alias("ride_id"), "event_type", F.lit("t").alias("timestamp"), "data")
    flat = ingest.flatten(messages)._jdf.queryExecution().optimizedPlan().toString()
    assert flat.count("from_json") == 1 and "json_object_keys" not in flat


def test_a_part_of_a_stored_table_is_not_written_again(spark, rows, tmp_path, monkeypatch):
    """Its days are rewritten in place: no copy of the increment or of the days is kept."""
    data = [
        (f"e{i}", f"r{i % 30}", COMPLETED if i % 3 else REQUESTED, dt.datetime(2024, 1, 1 + i % 4, i % 24), f"p{i % 7}", f"d{i % 5}", i, float(i))
        for i in range(120)
    ]
    parts = [data[:50], data[30:90], data[70:]]
    copied = increments.DailyGold(spark, str(tmp_path / "copied")).create()
    for part in parts:
        copied.apply(spark.createDataFrame(part, TYPED))
    monkeypatch.setattr(increments, "kept", lambda *_: pytest.fail("a copy was written"))
    plain = increments.DailyGold(spark, str(tmp_path / "plain")).create()
    for part in parts:
        plain.apply(spark.createDataFrame(part, TYPED), stored=True)
    assert rows(plain.report("day").orderBy("period")) == rows(copied.report("day").orderBy("period"))
    assert plain._read("events", increments.EVENTS).count() == len({(r[1], r[2], r[3]) for r in data})
