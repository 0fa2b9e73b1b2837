import datetime as dt
import uuid
import random

import pytest
from pyspark.sql import functions as F

from tripmill.operators import dims, quality, skew, state
from tripmill.operators.silver import first_occurrence, first_occurrence_by_min
from tripmill.sources.bucketed import BucketedTable
from tripmill.sources import files, tables

DAY = dt.date(2024, 1, 1)
LOG = "driver_id string, changed_at timestamp, entry bigint, vehicle_type string"


def change_log(spark, n=400, seed=3):
    rng = random.Random(seed)
    data = [
        (rng.choice(["hot"] * 3 + ["a", "b", "c"]), dt.datetime(2024, 1, 1) + dt.timedelta(hours=rng.randrange(900)),
         i, rng.choice(["sedan", "suv"]))
        for i in range(n)
    ]
    return data, spark.createDataFrame(data, LOG)


def versions_of(data):
    last = {}
    for driver, at, entry, kind in sorted(data, key=lambda r: (r[1], r[2])):
        last[(driver, at.date())] = kind
    out, open_kind = [], {}
    for (driver, day), kind in sorted(last.items()):
        if open_kind.get(driver) != kind:
            out.append((driver, kind, day))
            open_kind[driver] = kind
    return sorted(out)


def test_versions_follow_the_log(spark):
    data, log = change_log(spark)
    dim = dims.scd2(log, "driver_id", "changed_at", ["vehicle_type"], "entry").collect()
    assert sorted((r.driver_id, r.vehicle_type, r.effective_date) for r in dim) == versions_of(data)
    for driver in {r.driver_id for r in dim}:
        mine = sorted((r for r in dim if r.driver_id == driver), key=lambda r: r.effective_date)
        assert [r.end_date for r in mine] == [r.effective_date for r in mine[1:]] + [None]
        assert [r.is_current for r in mine] == [False] * (len(mine) - 1) + [True]
    assert quality.duplicate_keys(spark.createDataFrame(dim), "driver_id", "effective_date").count() == 0


def test_merge_equals_rebuild(spark):
    _, log = change_log(spark)
    cut = dt.datetime(2024, 1, 20)
    args = ("driver_id", "changed_at", ["vehicle_type"], "entry")
    old = dims.scd2(log.filter(F.col("changed_at") < cut), *args)
    merged = dims.scd2_merge(old, log.filter(F.col("changed_at") >= cut), *args)
    whole = dims.scd2(log, *args)
    assert merged.exceptAll(whole).count() == whole.exceptAll(merged).count() == 0


def test_lookup_finds_the_version_of_the_day_on_a_hot_key(spark):
    data, log = change_log(spark)
    dim = dims.dim_driver(log, "driver_id", "changed_at", ["vehicle_type"], "entry")
    facts = spark.createDataFrame(
        [(f"r{i}", d, DAY + dt.timedelta(days=i % 45 - 3)) for i in range(300) for d in ("hot", "a", "ghost", None)],
        "ride_id string, driver_id string, day date",
    )
    got = dims.scd2_lookup(facts, dim, "driver_id", "day", "ride_id", ["vehicle_type"]).collect()
    assert len(got) == facts.count()
    known = sorted(versions_of(data), key=lambda v: v[2])
    for r in got:
        before = [k for d, k, day in known if d == r.driver_id and day <= r.day]
        assert r.vehicle_type == (before[-1] if before else None)


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("hot", [[], [1], [1, 2, 9]])
def test_lookup_join_equals_a_plain_join(spark, how, hot):
    rng = random.Random(5)
    facts = spark.createDataFrame(
        [(i, rng.choice([1] * 5 + [2, 3, None, 9])) for i in range(500)], "id bigint, k bigint"
    )
    dim = spark.createDataFrame([(1, "x"), (1, "y"), (2, "z"), (3, None), (7, "w")], "k bigint, v string")
    frequent = spark.createDataFrame([(k,) for k in hot], "_hot_key bigint")
    got = skew.lookup_join(facts, dim, "k", spread_by=["id"], frequent=frequent, how=how, splits=8)
    want = facts.join(dim, "k", how).select("id", "k", "v")
    got = got.select("id", "k", "v")
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0


def test_frequent_keys_hold_the_hot_key_and_are_bounded(spark):
    df = spark.createDataFrame([(str(i % 3000 if i % 3 else -1),) for i in range(9000)] + [(None,)], "k string")
    keys = [r[0] for r in skew.frequent_keys(df, "k", 16).collect()]
    assert "-1" in keys and len(keys) <= 16 and None not in keys


def test_first_occurrence_by_rank_and_by_minimum(spark):
    rng = random.Random(1)
    data = [(rng.randrange(20), rng.randrange(50), i, rng.random()) for i in range(400)]
    df = spark.createDataFrame(data, "k int, t int, id int, x double")
    want = {k: min((r[1], r[2], r[3]) for r in data if r[0] == k) for k in {r[0] for r in data}}
    for fn in (first_occurrence, first_occurrence_by_min):
        got = {r.k: (r.t, r.id, r.x) for r in fn(df, ["k"], ["t", "id"]).collect()}
        assert got == want


def test_summary_counts_each_check(spark, rows):
    df = spark.createDataFrame(
        [("e1", "r1", "ride_completed", dt.datetime(2024, 1, 1), 501.0, 5),
         ("e1", None, "ride_completed", None, -1.0, -5),
         ("e2", "r3", "teleported", dt.datetime(2024, 1, 1), 900.0, 200000),
         (None, "r4", None, dt.datetime(2024, 1, 1), None, None)],
        "event_id string, ride_id string, event_type string, event_timestamp timestamp, distance_km double, fare_cents bigint",
    )
    got = {(r["check"], r["column"]): r["violations"] for r in rows(quality.summarise_rows(df, "t", quality.silver_checks()))}
    assert got == {
        ("not_null", "event_id"): 1, ("not_null", "ride_id"): 1, ("not_null", "event_type"): 1,
        ("not_null", "event_timestamp"): 1, ("accepted_values", "event_type"): 1,
        ("distance_bounds", "distance_km"): 2, ("fare_not_negative", "fare_cents"): 1, ("fare_bounds", "fare_cents"): 1,
    }
    (unique,) = rows(quality.summarise_unique(df, "t", "event_id"))
    assert (unique["violations"], unique["total"]) == (1, 2)
    for check in quality.silver_checks():
        assert quality.violations(df, check).count() == got[(check.name, check.column)]


def test_bronze_surge_and_driver_event_checks(spark, rows):
    df = spark.createDataFrame(
        [("e", "r", "ride_completed", 6.0), ("e", "r", "ride_requested", 9.0), ("e", "r", "ride_completed", 5.0)],
        "event_id string, ride_id string, event_type string, surge_multiplier double",
    )
    summary = rows(quality.summarise_rows(df, "t", quality.bronze_checks()))
    assert [r["violations"] for r in summary] == [0, 0, 0, 1]
    drivers = spark.createDataFrame([("e", None)], "event_id string, driver_id string")
    assert [r["violations"] for r in rows(quality.summarise_rows(drivers, "d", quality.driver_event_checks()))] == [0, 1]
    dates = spark.createDataFrame([(dt.date(2023, 12, 31),), (dt.date(2024, 1, 1),)], "d date")
    assert quality.violations(dates, quality.date_range_check("d", "2024-01-01", "2024-12-31")).count() == 1


def test_orphans_recency_and_reconciliation(spark, rows):
    child = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    parent = spark.createDataFrame([(2,), (3,)], "p int")
    assert rows(quality.orphans(child, "k", parent, "p")) == [{"k": 1, "rows": 2}]
    now = F.lit("2024-01-02 00:00:00").cast("timestamp")
    times = spark.createDataFrame([(dt.datetime(2024, 1, 1, 23),)], "ts timestamp")
    (fresh,) = rows(quality.recency(times, "ts", now, 3600))
    assert (fresh["age_seconds"], fresh["stale"]) == (3600, False)
    assert quality.recency(times.limit(0), "ts", now, 3600).first().stale
    got = {r["k"]: (r["source_rows"], r["target_rows"], r["within"])
           for r in rows(quality.reconcile_counts(child.na.drop(), parent.withColumnRenamed("p", "k"), "k"))}
    assert got == {1: (2, 0, False), 2: (1, 1, True), 3: (0, 1, False)}
    diff = rows(quality.id_difference(child.na.drop(), parent.withColumnRenamed("p", "k"), "k"))
    assert sorted((r["k"], r["side"]) for r in diff) == [(1, "left"), (3, "right")]


def test_upsert_delete_and_unseen(spark, rows):
    schema = "k string, v int, t int"
    current = spark.createDataFrame([("a", 1, 9), ("b", 2, 9)], schema)
    updates = spark.createDataFrame([("b", 3, 1), ("b", 4, 2), ("c", 5, 1)], schema)
    merged = state.upsert_latest(current, updates, "k", [F.col("t").desc()])
    assert sorted((r["k"], r["v"]) for r in rows(merged)) == [("a", 1), ("b", 4), ("c", 5)]
    assert [r["k"] for r in rows(state.delete(current, "k", updates))] == ["a"]
    assert [r["v"] for r in rows(state.find(current, "k", "a"))] == [1]
    assert state.find(current, "k", "zz").count() == 0
    new = state.unseen(updates, current, "k", ["t"])
    assert [(r["k"], r["v"]) for r in rows(new)] == [("c", 5)]


RIDES = "ride_id string, status string, n int"


@pytest.fixture
def ride_table(spark):
    table = BucketedTable(spark, f"rides_{uuid.uuid4().hex}", "ride_id", 4)
    yield table
    table.drop()


def physical(df):
    text = df._jdf.queryExecution().toString()
    return text[text.index("== Physical Plan ==") :]


def test_bucketed_table_saves_deletes_and_keeps_two_versions(spark, rows, ride_table):
    table = ride_table
    table.save(spark.createDataFrame([(f"r{i}", "requested", i) for i in range(40)], RIDES))
    new = spark.createDataFrame([("r1", "completed", 1), ("r99", "requested", 99)], RIDES)
    for _ in range(2):  # a repeated save changes nothing
        table.save(new)
        got = {r["ride_id"]: r["status"] for r in rows(table.read())}
        assert len(got) == 41 and got["r1"] == "completed" and got["r2"] == "requested"
    table.delete(table.read().filter("ride_id <> 'r5'"))
    assert [r["ride_id"] for r in rows(table.read())] == ["r5"]
    for _ in range(3):
        table.save(new)
    assert sorted(r["ride_id"] for r in rows(table.read())) == ["r1", "r5", "r99"]
    assert len(table.versions()) == 2


def test_a_save_that_stops_half_way_loses_nothing(spark, rows, ride_table):
    ride_table.save(spark.createDataFrame([("a", "requested", 1), ("b", "requested", None)], RIDES))
    bad = spark.createDataFrame([("a", "completed", 2)], RIDES).withColumn(
        "n", F.when(F.col("n") == 2, F.raise_error(F.lit("stopped")).cast("int"))
    )
    with pytest.raises(Exception, match="stopped"):
        ride_table.save(bad)
    assert {r["ride_id"]: r["status"] for r in rows(ride_table.read())} == {"a": "requested", "b": "requested"}
    ride_table.save(spark.createDataFrame([("a", "completed", None)], RIDES))
    assert {r["ride_id"]: (r["status"], r["n"]) for r in rows(ride_table.read())} == {"a": ("completed", None), "b": ("requested", None)}


def test_a_lookup_reads_one_bucket(spark, rows, ride_table):
    ride_table.save(spark.createDataFrame([(f"r{i}", "requested", i) for i in range(40)], RIDES))
    ride_table.save(spark.createDataFrame([("r7", "completed", 7)], RIDES))
    found = ride_table.find("r7")
    assert [r["status"] for r in rows(found)] == ["completed"]
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")  # the plan names buckets only so
    try:
        assert "SelectedBucketsCount: 1 out of 4" in physical(ride_table.find("r7"))
    finally:
        spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")
    assert ride_table.find("none").count() == 0


def test_saves_and_deletes_leave_the_stored_rows_in_their_buckets(spark, ride_table):
    ride_table.save(spark.createDataFrame([(f"r{i}", "requested", i) for i in range(40)], RIDES))
    new = spark.createDataFrame([("r7", "completed", 7)], RIDES)
    for plan in (physical(ride_table.merged(new)), physical(ride_table.without(new))):
        assert "Bucketed: true" in plan and "SortMergeJoin" in plan
        scan = plan.index("Scan parquet")
        assert "Exchange" not in plan[plan.index("SortMergeJoin") : scan]  # the stored side comes first


def test_tables_views_sql_and_retention(spark, rows, tmp_path):
    df = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-05"), (3, "2024-01-09")], "id int, day string")
    path = str(tmp_path / "t")
    df.write.parquet(path)
    tables.register_external(spark, "ext_t", df.schema, path)
    assert tables.register_external(spark, "ext_t", df.schema, path).count() == 3
    with pytest.raises(Exception, match="ALREADY_EXISTS"):
        tables.register_external(spark, "ext_t", df.schema, path, must_be_new=True)
    assert rows(tables.run_sql(spark, "SELECT id FROM ext_t WHERE day = :d", d="2024-01-05")) == [{"id": 2}]
    tables.register_view(df, "v_t")
    assert tables.run_sql(spark, "SELECT max(id) m FROM v_t").first().m == 3
    assert tables.refresh_model(df, "model_t").count() == 3
    assert tables.refresh_model(df.filter("id = 1"), "model_t").count() == 1
    kept = tables.keep_recent(df.withColumn("day", F.to_date("day")), "day", F.to_date(F.lit("2024-01-10")), 5)
    assert sorted(r["id"] for r in rows(kept)) == [2, 3]
    df.write.partitionBy("day").format("parquet").saveAsTable("dated_t")
    gone = tables.expire_partitions(spark, "dated_t", "day", dt.date(2024, 1, 10), 5)
    assert gone == ["2024-01-01"] and spark.table("dated_t").count() == 2


def test_files_are_read_with_a_declared_schema(spark, rows, tmp_path):
    path = tmp_path / "in"
    path.mkdir()
    (path / "a.json").write_text('{"event_id":"e1","fare_cents":1000}\n{"event_id":"e2","fare_cents":2000}\nnot json\n')
    got = rows(files.read_ndjson(spark, str(path)))
    assert sum(r["fare_cents"] or 0 for r in got) == 3000
    assert [r["_corrupt_record"] for r in got if r["event_id"] is None] == ["not json"]
    out = str(tmp_path / "parts")
    df = spark.createDataFrame([("r1", "2024-01-01", 1), ("r2", "2024-01-02", 2)], "ride_id string, d string, n int")
    files.write_partitioned(df, out, "d", ("ride_id",))
    files.write_partitioned(df.filter("n = 2").withColumn("n", F.lit(5)), out, "d")
    assert sorted((r.ride_id, r.n) for r in spark.read.parquet(out).collect()) == [("r1", 1), ("r2", 5)]
    files.append_events(df, out + "_log")
    files.append_events(df, out + "_log")
    assert spark.read.parquet(out + "_log").count() == 4
    files.write_extract(df, out + "_json")
    assert "n" in files.read_ndjson_inferred(spark, out + "_json").columns
