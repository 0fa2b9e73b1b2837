import datetime as dt
import random
import zipfile

import pytest
from helpers import events as make_events
from pyspark.sql import functions as F

from tripmill.functions.events import order_key, ordered_time
from tripmill.operators import lifecycle
from tripmill.plans import bindings
from tripmill.schemas import ACCEPTED, BRONZE, COMPLETED, GPS, REQUESTED, STARTED
from tripmill.sources import batches, files
from tripmill.streaming import events as se
from tripmill.streaming import lifecycle as sl
from tripmill.streaming import metrics as sm

METRIC_ROWS = "event_timestamp timestamp, event_type string, fare_cents bigint, distance_km double, surge_multiplier double"


def minutes(n):
    return dt.datetime(2024, 1, 1) + dt.timedelta(minutes=n)


def write(df, path):
    df.coalesce(1).write.mode("append").parquet(str(path))


def same(a, b):
    return a.exceptAll(b).count() == b.exceptAll(a).count() == 0


@pytest.fixture
def metric_rows(spark):
    rng = random.Random(2)
    data = [
        (minutes(rng.randrange(60)), rng.choice([COMPLETED, COMPLETED, REQUESTED]),
         rng.choice([None, rng.randrange(5000)]), round(rng.random() * 20, 2), rng.choice([None, 1.0, 2.5]))
        for _ in range(200)
    ]
    return spark.createDataFrame(data, METRIC_ROWS)


def test_windows_skip_missing_values_and_other_types(spark):
    df = spark.createDataFrame(
        [(minutes(1), COMPLETED, 1000, 4.0, None), (minutes(4), COMPLETED, None, 8.0, 1.5), (minutes(5), COMPLETED, 7, None, None),
         (minutes(2), REQUESTED, 9, 9.0, 9.0)],
        METRIC_ROWS,
    )
    first, second = sm.window_metrics(df).orderBy("window_start").collect()
    assert tuple(first) == (minutes(0), minutes(5), 2, 1000.0, 6.0, 1.5)
    assert tuple(second) == (minutes(5), minutes(10), 1, 7.0, None, None)


def test_update_stream_restarts_and_equals_the_batch(spark, metric_rows, tmp_path):
    source, out, offsets = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp")
    half = F.minute("event_timestamp") < 30
    write(metric_rows.filter(half), source)

    def run():
        stream = files.stream_files(spark, source, metric_rows.schema)
        return se.run_available(sm.write_windows(sm.window_metrics(stream, watermark="2 hours"), out, offsets))

    run()
    before = sm.read_windows(spark, out, sm.window_metrics(metric_rows).schema)
    assert same(before, sm.window_metrics(metric_rows.filter(half)).select(*before.columns))
    write(metric_rows.filter(~half), source)
    write(metric_rows.filter(half).limit(20), source)
    query = run()
    after = sm.read_windows(spark, out, sm.window_metrics(metric_rows).schema)
    again = metric_rows.unionByName(metric_rows.filter(half).limit(20))
    assert same(after, sm.window_metrics(again).select(*after.columns))
    assert sum(p["numInputRows"] for p in query.recentProgress) == again.count() - metric_rows.filter(half).count()


def test_append_stream_holds_windows_until_the_watermark_has_passed(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    df = spark.createDataFrame([(minutes(1), COMPLETED, 1, 1.0, 1.0), (minutes(40), COMPLETED, 2, 1.0, 1.0)], METRIC_ROWS)
    write(df, source)
    stream = files.stream_files(spark, source, df.schema)
    query = se.run_available(sm.write_final_windows(sm.window_metrics(stream), out, str(tmp_path / "cp")))
    assert [r.window_start for r in spark.read.parquet(out).collect()] == [minutes(0)]
    assert se.watermark_of(query).startswith("2024-01-01T00:30")


def test_rows_later_than_the_watermark_are_dropped_and_counted(spark, tmp_path):
    source, out, offsets = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp")
    batches = [(60, 1), (90, 2), (5, 3), (85, 4)]
    queries = []
    for at, fare in batches:
        df = spark.createDataFrame([(minutes(at), COMPLETED, fare, 1.0, 1.0)], METRIC_ROWS)
        write(df, source)
        stream = files.stream_files(spark, source, df.schema)
        queries.append(se.run_available(sm.write_windows(sm.window_metrics(stream), out, offsets)))
    kept = {r.window_start for r in sm.read_windows(spark, out, sm.window_metrics(df).schema).collect()}
    assert kept == {minutes(60), minutes(90), minutes(85)}
    assert [se.dropped_by_watermark(q) for q in queries] == [0, 0, 1, 0]


def test_redelivered_events_pass_once(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    df = spark.createDataFrame([("a", minutes(1)), ("a", minutes(3)), ("b", minutes(2)), ("b", minutes(2))],
                               "event_id string, event_timestamp timestamp")
    write(df, source)
    once = se.drop_redelivered(files.stream_files(spark, source, df.schema))
    se.run_available(once.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "cp")))
    assert sorted(r.event_id for r in spark.read.parquet(out).collect()) == ["a", "b"]


def test_lateness_is_measured_against_arrival(spark):
    df = spark.createDataFrame([(minutes(0), minutes(10)), (minutes(0), minutes(11))], "ts timestamp, seen timestamp")
    (late,) = se.late_rows(df, "ts", "seen").collect()
    assert late.lateness_seconds == 660.0


def test_landing_splits_valid_from_rejected(spark, sf_dir, tmp_path):
    source = spark.read.parquet(f"{sf_dir}/events.parquet")
    n = source.count()
    stream = bindings.ride_messages(files.stream_files(spark, sf_dir, source.schema, pattern="events.parquet"))
    good, bad = str(tmp_path / "good"), str(tmp_path / "bad")
    se.run_available(se.land_valid(stream, good, str(tmp_path / "c1")))
    se.run_available(se.land_rejected(stream, bad, str(tmp_path / "c2")))
    landed = files.read_ndjson(spark, good, BRONZE)
    rejected = spark.read.json(bad)
    assert landed.count() + rejected.count() == n and landed.count() > 0
    assert {"year", "month", "day"} <= set(landed.columns)
    assert {r[0] for r in rejected.select("_error").distinct().collect()} == {
        "malformed", "missing_ride_id", "unknown_event_type"}
    assert rejected.filter(F.col("_error") == "malformed").filter(F.col("raw_text").isNull()).count() == 0


def ride_events(spark):
    done = {"driver_id": "d1", "distance_meters": 5000.0, "fare_cents": 1500}
    return make_events(
        spark,
        ("a", REQUESTED, 0), ("a", ACCEPTED, 1), ("a", GPS, 2), ("a", STARTED, 3), ("a", COMPLETED, 9, done),
        ("b", REQUESTED, 0), ("b", STARTED, 1),
        ("c", GPS, 0), ("c", REQUESTED, 1),
        ("d", REQUESTED, 5), ("d", ACCEPTED, 6), ("d", ACCEPTED, 7),
        ("e", REQUESTED, 5), *[("e", GPS, m) for m in range(6, 30)],
    )


def ride_batches(spark):
    """Events in five parts: one a year late comes first, and the last two repeat events."""
    df = ride_events(spark)
    late = df.withColumn("event_timestamp", F.col("event_timestamp") + F.expr("interval 400 days")).filter("ride_id = 'a' AND event_type = 'gps_update'")
    late = late.withColumn("event_id", F.lit("very late"))
    done = F.col("event_type").isin(COMPLETED, GPS)
    parts = (late, df.filter(done), df.filter(~done), df.filter(done), df.filter("ride_id = 'd'"))
    return parts, lifecycle.replayed(df.unionByName(late)), df.schema


@pytest.mark.parametrize("max_files", [1, 4, 16])
def test_streaming_state_equals_the_batch_replay_for_any_split_into_batches(spark, tmp_path, max_files):
    source, offsets, out = str(tmp_path / "in"), str(tmp_path / "cp"), str(tmp_path / "rides")
    parts, want, schema = ride_batches(spark)
    for part in parts:
        write(part, source)
    stream = files.stream_files(spark, source, schema, max_files=max_files)
    query = se.run_available(sl.write_rides(stream, out, offsets, compact_every=2))
    (operator,) = query.lastProgress["stateOperators"]
    assert operator["operatorName"] == "stateStoreSave" and operator["numRowsTotal"] == 5
    assert any("rocksdb" in m for m in operator["customMetrics"])
    assert same(sl.read_rides(spark, out, schema).select(*want.columns), want)
    assert "Python" not in sl.read_rides(spark, out, schema)._jdf.queryExecution().toString()


def test_streaming_state_goes_on_after_a_restart(spark, tmp_path):
    source, offsets, out = str(tmp_path / "in"), str(tmp_path / "cp"), str(tmp_path / "rides")
    parts, want, schema = ride_batches(spark)
    for part in parts:
        write(part, source)
        stream = files.stream_files(spark, source, schema)
        query = se.run_available(sl.write_rides(stream, out, offsets, compact_every=2))
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] == 5
    assert same(sl.read_rides(spark, out, schema).select(*want.columns), want)
    folders = [p.name for p in (tmp_path / "rides").iterdir() if p.name.startswith("batch=")]
    assert len(folders) <= 5  # compaction removed old batches


def test_a_batch_holds_the_rides_that_changed_without_event_ids(spark, tmp_path):
    source, offsets, out = str(tmp_path / "in"), str(tmp_path / "cp"), str(tmp_path / "rides")
    parts, want, schema = ride_batches(spark)
    for number, part in enumerate((parts[2], parts[4], parts[1])):
        write(part, source)
        se.run_available(sl.write_rides(files.stream_files(spark, source, schema), out, offsets))
        got = spark.read.parquet(f"{out}/batch={number}")
        assert set(got.columns) == set(want.columns)
        assert all(f.endswith(".zstd.parquet") for f in got.inputFiles())
        changed = {r.ride_id for r in part.select("ride_id").collect()}
        now = lifecycle.replayed(spark.read.schema(schema).parquet(source).distinct()).select(*got.columns).collect()
        assert sorted(map(str, got.collect())) == sorted(str(r) for r in now if r.ride_id in changed)


def test_state_is_kept_with_entropy_coding_and_without_space_set_aside(spark, tmp_path):
    source, offsets, out = str(tmp_path / "in"), str(tmp_path / "cp"), str(tmp_path / "rides")
    parts, _, schema = ride_batches(spark)
    write(parts[1], source)
    se.run_available(sl.write_rides(files.stream_files(spark, source, schema), out, offsets))
    options = "".join(
        z.read(n).decode()
        for p in tmp_path.glob("cp/state/0/*/*.zip") for z in [zipfile.ZipFile(p)] for n in z.namelist() if "OPTIONS" in n
    )
    assert "compression=kZSTD" in options and "block_size=32768" in options
    assert "allow_fallocate=false" in options and "allow_fallocate=true" not in options


def test_the_time_of_an_event_can_be_read_from_its_order(spark):
    kinds = [*lifecycle.STEPS, REQUESTED, GPS, "other", None]
    times = [dt.datetime(1931, 5, 4, 3, 2, 1, 999_999), dt.datetime(1970, 1, 1), dt.datetime(2024, 2, 29, 1, 2, 3, 1), None]
    df = spark.createDataFrame([(k, t) for k in kinds for t in times], "event_type string, event_timestamp timestamp")
    order = order_key(F.col("event_timestamp"), F.col("event_type"))
    assert df.filter(~ordered_time(order).eqNullSafe(F.col("event_timestamp"))).count() == 0


def test_windows_of_a_repeated_batch_stay(spark, metric_rows, tmp_path):
    rows, path = sm.window_metrics(metric_rows), str(tmp_path / "w")
    rows.withColumn("rides_completed_count", F.lit(0).cast("bigint")).write.parquet(f"{path}/batch=0")
    for _ in range(2):
        rows.write.mode("overwrite").parquet(f"{path}/batch=1")
    assert same(sm.read_windows(spark, path, rows.schema), rows)
    for _ in range(2):
        batches.compact(spark, path, rows.schema, sm.WINDOW_KEYS, 0)
        assert same(sm.read_windows(spark, path, rows.schema), rows)
    assert batches.read_batches(spark, path, rows.schema).select("batch").distinct().collect() == [(1,)]


def test_streams_read_a_table_stored_as_a_folder(spark, sf_dir, tmp_path):
    from tripmill.plans.oracles import ORACLES
    from tripmill.plans.queries import QUERIES, _event_stream

    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    events.repartition(4, "event_id").write.parquet(f"{tmp_path}/events.parquet")
    stream = _event_stream(spark, str(tmp_path), max_files=1)
    out = str(tmp_path / "out")
    query = se.run_available(stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "cp")))
    assert spark.read.parquet(out).count() == events.count() and len(query.recentProgress) >= 4
    for name in ("window_5min_stream", "stream_dedup", "landing", "landing_rejects"):
        assert name in ORACLES
        assert same(QUERIES[name](spark, str(tmp_path)), QUERIES[name](spark, sf_dir))


def test_checks_are_reported_per_batch(spark, tmp_path):
    from tripmill.operators.quality import in_range, not_null

    source, checks = str(tmp_path / "in"), [not_null("event_type"), in_range("fare", "fare_cents", 0)]
    for fares in ([1, 2], [-1, None, 5]):
        write(spark.createDataFrame([(minutes(1), COMPLETED if f else None, f, 1.0, 1.0) for f in fares], METRIC_ROWS), source)
    stream = files.stream_files(spark, source, spark.createDataFrame([], METRIC_ROWS).schema, max_files=1)
    checked = se.observe_checks(stream, checks)
    query = se.run_available(checked.writeStream.format("parquet").option("path", str(tmp_path / "o")).option("checkpointLocation", str(tmp_path / "c")))
    found = se.reported_checks(query, checks)
    assert sorted((r["check"], r["violations"], r["total"]) for r in found) == [
        ("fare", 0, 2), ("fare", 1, 3), ("not_null", 0, 2), ("not_null", 1, 3)]
