"""What the plans must look like to hold at scale."""

import re

import pytest
from pyspark.sql import functions as F

from tripmill.operators import gold, ingest, lifecycle, silver, state
from tripmill.plans import bindings, medallion, queries
from tripmill.plans.oracles import ORACLES
from tripmill.plans.queries import QUERIES
from tripmill.session import kept, settings, work_dir


def plan(df):
    return df._jdf.queryExecution().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("layers"))
    return medallion.build(spark, bindings.bronze(spark, "/root/testdata/sf0.001"), base)


def test_filters_and_columns_reach_the_scan(stored):
    text = plan(gold.driver_metrics(stored["stg_rides"], unique_rides=True))
    assert "EqualTo(event_type,ride_completed)" in text and "IsNotNull(driver_id)" in text
    schema = re.findall(r"ReadSchema: struct<([^>]*)>", text)[-1]
    assert "latitude" not in schema and "rider_id" not in schema and "fare_cents" in schema
    found = plan(state.find(stored["stg_rides"], "ride_id", "7"))
    assert "EqualTo(ride_id,7)" in found


def test_dates_prune_partitions(stored):
    text = plan(gold.recent_days(stored["stg_rides"], "event_date", "2001-01-01", 30))
    assert re.search(r"PartitionFilters: \[isnotnull\(event_date.*>= 2000-12-02", text)


def test_first_occurrence_limits_before_the_shuffle(spark, sf_dir):
    text = plan(silver.to_silver(bindings.bronze(spark, sf_dir)))
    physical = text[text.index("== Physical Plan =="):]
    assert physical.index("WindowGroupLimit") < physical.rindex("Exchange")
    assert re.search(r"WindowGroupLimit.*Partial", physical)


def test_step_judgement_limits_before_the_shuffle(stored):
    text = plan(lifecycle.violations(stored["stg_rides"]))
    assert re.search(r"WindowGroupLimit.*row_number.*4, Partial", text)


def test_replay_and_rollups_aggregate_before_the_shuffle(stored):
    for df in (lifecycle.rides_current(
        stored["stg_rides"].withColumns(
            {c: F.lit(None).cast("double") for c in ("pickup_lat", "pickup_lon", "dropoff_lat", "dropoff_lon")}
        ).withColumn("cancel_reason", F.lit(None).cast("string"))),
        gold.passenger_metrics(stored["stg_rides"], unique_rides=True),
    ):
        text = plan(df)
        assert "partial_" in text and "Window" not in text[text.index("== Physical Plan =="):]
    assert "Expand" not in plan(gold.passenger_metrics(stored["stg_rides"], unique_rides=True))


def test_no_python_in_batch_plans(spark, sf_dir):
    streams = {"window_5min_stream", "stream_dedup", "landing", "landing_rejects", "stream_rides_current", "landing_compacted", "stream_progress"}
    writes = {"ride_state_upsert", "ride_delete", "parquet_roundtrip", "ndjson_roundtrip", "dq_summary", "fact_rides_star", "ride_by_id",
              "event_history", "rides_by_status", "layer_rebuild", "build_rejects", "layer_retention", "registered_partitions",
              "unseen_by_bitmaps", "gold_by_increments"}
    for name in set(QUERIES) - streams - writes:
        text = plan(QUERIES[name](spark, sf_dir))
        physical = text[text.index("== Physical Plan =="):]
        assert "Python" not in physical and "CartesianProduct" not in physical, name
        assert "BroadcastNestedLoopJoin" not in physical, name


def test_models_written_in_order_agree_with_each_other(stored, spark):
    revenue = gold.completed(stored["stg_rides"]).agg(F.sum("fare_cents")).first()[0]
    assert stored["rides_summary"].agg(F.sum("total_revenue_cents")).first()[0] == revenue
    assert all("_loaded_at" in df.columns for df in stored.values())
    summary = medallion.quality_summary(bindings.bronze(spark, "/root/testdata/sf0.001"), stored)
    assert summary.count() == 25
    assert summary.filter("table = 'rides_summary' AND violations > 0").count() == 0


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_work_folder_is_the_one_the_session_names(spark):
    assert work_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_lineage_columns(spark, sf_dir):
    row = ingest.with_lineage(spark.read.parquet(f"{sf_dir}/orders.parquet")).first()
    assert row._source_file.endswith("orders.parquet") and row._loaded_at is not None


def test_id_difference_compares_digests_first(spark):
    from tripmill.operators import quality

    df = spark.createDataFrame([("a",), ("b",), ("b",)], "event_id string")
    found = quality.id_difference(df, df.filter("event_id = 'a'"), "event_id")
    text = plan(found)
    physical = text[text.index("== Physical Plan ==") :]
    assert physical.count("Exchange hashpartitioning(event_id") == 1 and "LeftSemi" in physical
    assert [tuple(r) for r in found.collect()] == [("b", "left")]
    # Where both sides agree, in whatever order and with repeats, nothing but digests is shuffled.
    big = spark.range(20_000).select(F.concat(F.lit("e"), F.col("id") % 15_000).alias("event_id"))
    equal = quality.id_difference(big, big.orderBy(F.rand(3)), "event_id")
    assert quality.differing_buckets(big, big.repartition(3), "event_id").count() == 0 and equal.count() == 0
    gone = quality.id_difference(big, big.filter("event_id != 'e77'").union(spark.createDataFrame([("z",), (None,)], "event_id string")), "event_id")
    assert sorted(map(str, gone.collect())) == sorted(["Row(event_id='e77', side='left')", "Row(event_id='z', side='right')", "Row(event_id=None, side='right')"])
    assert quality.differing_buckets(big, big.filter("event_id != 'e77'"), "event_id").count() == 1


def test_row_checks_are_counted_while_layers_are_written(spark, sf_dir, tmp_path):
    log = bindings.bronze(spark, sf_dir)
    ours = {tuple(r) for r in medallion.written_summary(log, f"{tmp_path}/layers").collect()}
    assert ours == {tuple(r) for r in medallion.quality_summary(log).collect()}
    built = medallion.build(spark, log, f"{tmp_path}/a", "month")
    counted = {tuple(r) for r in built["checks"].drop("_loaded_at").collect()}
    assert {r for r in counted if r[1] == "stg_rides"} == {r for r in ours if r[1] == "stg_rides" and r[0] != "unique"}
    rides = built["stg_rides"].count()
    with pytest.raises(medallion.LayerRejectedError, match="fare_not_negative"):
        medallion.build(spark, log.filter("CAST(ride_id AS BIGINT) % 83 = 0"), f"{tmp_path}/a", "month", {"fare_not_negative": 0.0})
    assert medallion.read_layers(spark, f"{tmp_path}/a")["stg_rides"].count() == rides
    medallion.build(spark, log, f"{tmp_path}/a", "month", {"fare_not_negative": 0.5, "unknown": 0.0})
    assert (tmp_path / "a" / "versions").exists() and len(list((tmp_path / "a").glob("version=*"))) == 2


def test_a_second_build_equals_a_fresh_one(spark, sf_dir, tmp_path):
    log = bindings.bronze(spark, sf_dir)
    early = log.filter(F.col("timestamp") < "1996-01-01")
    medallion.build(spark, log, f"{tmp_path}/a", "month")
    again = medallion.build(spark, early, f"{tmp_path}/a", "month")
    fresh = medallion.build(spark, early, f"{tmp_path}/b", "month")
    for name, df in fresh.items():
        mine, theirs = (x.drop("_loaded_at", "_dlq_timestamp") for x in (again[name], df))
        assert mine.exceptAll(theirs).count() == theirs.exceptAll(mine).count() == 0, name


def test_a_build_that_stops_leaves_the_last_one_in_force(spark, sf_dir, tmp_path, monkeypatch):
    base = str(tmp_path)
    rides = medallion.build(spark, bindings.bronze(spark, sf_dir), base, "month")["stg_rides"].count()

    def stop(*_):
        raise RuntimeError("stopped")

    monkeypatch.setitem(medallion.GOLD_MODELS, "driver_metrics", stop)
    with pytest.raises(RuntimeError):
        medallion.build(spark, bindings.bronze(spark, sf_dir).limit(10), base, "month")
    assert medallion.read_layers(spark, base)["stg_rides"].count() == rides


def test_nothing_of_bronze_is_lost_in_a_build(spark, tmp_path):
    from tripmill.sources.files import read_ndjson

    lines = [
        '{"event_id":"1","ride_id":"r","event_type":"ride_requested","timestamp":"2024-01-01T00:00:00"}',
        "not json",
        '{"event_id":"2","ride_id":"r","event_type":"ride_accepted","timestamp":"someday"}',
        '{"event_id":"3","ride_id":null,"event_type":"ride_accepted","timestamp":"2024-01-01T00:00:00"}',
    ]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(f"{tmp_path}/in")
    built = medallion.build(spark, read_ndjson(spark, f"{tmp_path}/in"), f"{tmp_path}/out")
    assert [r.event_id for r in built["stg_rides"].collect()] == ["1"]
    reasons = sorted(r._error.split(";")[0] for r in built["rejects"].collect())
    assert reasons == ["bad_timestamp", "malformed", "missing_ride_id"]


def test_versions_are_met_by_an_as_of_join(spark):
    """A key with 1,000 versions and a third of the facts: each fact meets one version, in many sorted runs."""
    import datetime as dt

    from tripmill.operators import dims

    first = dt.date(2020, 1, 1)
    rows = [(i, "d" if i % 3 == 0 else None if i % 3 == 1 else f"x{i}", first + dt.timedelta(days=i % 1300 - 100)) for i in range(6000)]
    facts = spark.createDataFrame([(*r[:2], str(r[2])) for r in rows], "ride_id int, driver_id string, at string").withColumn("at", F.to_date("at"))
    dim = spark.range(1000).select(
        F.lit("d").alias("driver_id"),
        F.date_add(F.lit(first), F.col("id").cast("int")).alias("effective_date"),
        F.when(F.col("id") < 999, F.date_add(F.lit(first), F.col("id").cast("int") + 1)).alias("end_date"),
        F.col("id").alias("v"),
    )
    found = dims.scd2_lookup(facts, dim, "driver_id", "at", "ride_id", ["v"])
    got = {r.ride_id: r.v for r in found.collect()}
    assert len(got) == len(rows)
    for i, key, day in rows:
        age = (day - first).days
        assert got[i] == (min(age, 999) if key == "d" and age >= 0 else None)
    text = plan(found)
    physical = text[text.index("== Physical Plan ==") :]
    assert "SortMergeJoin" not in physical and "trunc" not in physical and "CartesianProduct" not in physical
    runs = found.sparkSession.createDataFrame(rows, "ride_id int, driver_id string, at date").filter("driver_id = 'd'")
    sizes = runs.groupBy(F.pmod(F.xxhash64("ride_id"), F.lit(dims.HOT_SPLITS))).count().agg(F.max("count")).first()[0]
    assert sizes < 2000 / 10


def test_ended_versions_and_gaps_match_nothing(spark):
    from tripmill.operators import dims

    dim = spark.createDataFrame(
        [("d", "2024-01-01", "2024-01-05", 1), ("d", "2024-01-10", None, 2), ("e", "2024-01-01", "2024-02-01", 3), (None, "2024-01-01", None, 4)],
        "driver_id string, effective_date string, end_date string, v int",
    )
    facts = [("d", "2024-01-04"), ("d", "2024-01-05"), ("d", "2024-01-10"), ("e", "2024-02-01"), (None, "2024-01-02"), ("d", None), ("d", "2023-12-31")]
    df = spark.createDataFrame([(i, *f) for i, f in enumerate(facts)], "ride_id int, driver_id string, at string").withColumn("at", F.to_date("at"))
    got = {r.ride_id: r.v for r in dims.scd2_lookup(df, dim, "driver_id", "at", "ride_id", ["v"]).collect()}
    assert got == {0: 1, 1: None, 2: 2, 3: None, 4: None, 5: None, 6: None}


def test_tasks_of_the_log_follow_the_size_of_its_tables(spark, sf_dir, monkeypatch):
    whole = bindings.rides(spark, sf_dir)
    monkeypatch.setattr(bindings, "LOG_TASK_BYTES", 8 << 10)
    tasks = bindings.log_tasks(spark, sf_dir)
    spread = bindings.rides(spark, sf_dir)
    text = plan(spread)
    physical = text[text.index("== Physical Plan =="):]
    assert tasks > 4 and len(re.findall(rf"hashpartitioning\([lo]_orderkey#\d+L, {tasks}\), REPARTITION_BY_NUM", physical)) == 2
    assert sorted(map(str, spread.collect())) == sorted(map(str, whole.collect()))


def test_stream_files_follow_the_data_and_batches_do_not(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(bindings, "LOG_TASK_BYTES", 8 << 10)
    seen, read = [], queries.files.stream_files

    def watched(spark, path, schema, **options):
        seen.append((len(spark.read.schema(schema).parquet(path).inputFiles()), options["max_files"]))
        return read(spark, path, schema, **options)

    monkeypatch.setattr(queries.files, "stream_files", watched)
    got = QUERIES["stream_rides_current"](spark, sf_dir)
    n, at_once = seen[0]
    assert n == bindings.log_tasks(spark, sf_dir) > queries.STREAM_BATCHES
    assert -(-n // at_once) == queries.STREAM_BATCHES
    assert got.count() == QUERIES["rides_current"](spark, sf_dir).count()


def test_the_shuffle_of_silver_deals_the_files_of_the_stream(spark, sf_dir, monkeypatch):
    found, read = [], queries.files.stream_files
    before = {key: spark.conf.get(key) for key in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}

    def watched(spark, path, schema, **options):
        found.append(spark.read.schema(schema).parquet(path))
        assert {key: spark.conf.get(key) for key in before} == before
        return read(spark, path, schema, **options)

    monkeypatch.setattr(queries.files, "stream_files", watched)
    QUERIES["stream_rides_current"](spark, sf_dir)
    n = max(queries.STREAM_BATCHES, bindings.log_tasks(spark, sf_dir))
    dealt = found[0].select(F.input_file_name().alias("file"), F.expr(f"pmod(hash(ride_id, event_type), {n})").alias("task"))
    by_file = dealt.groupBy("file").agg(F.countDistinct("task").alias("tasks"))
    assert by_file.count() == n and by_file.filter("tasks > 1").count() == 0


def test_files_of_the_restarted_stream_are_written_with_entropy_coding(spark, sf_dir, monkeypatch):
    found, read = [], queries.files.stream_files

    def watched(spark, path, schema, **options):
        found.append(spark.read.schema(schema).parquet(path))
        return read(spark, path, schema, **options)

    monkeypatch.setattr(queries.files, "stream_files", watched)
    QUERIES["stream_restart"](spark, sf_dir)
    assert len(found) == 3 and all(f.endswith(".zstd.parquet") for df in found for f in df.inputFiles())
    assert found[2].count() == bindings.silver(spark, sf_dir).count()


def test_settings_hold_within_and_are_back_afterwards(spark):
    known, unknown = "spark.sql.shuffle.partitions", "spark.sql.tripmill.none"
    before = spark.conf.get(known)
    with pytest.raises(ZeroDivisionError), settings(spark, {known: "7", unknown: "x"}):
        assert (spark.conf.get(known), spark.conf.get(unknown)) == ("7", "x")
        raise ZeroDivisionError
    assert spark.conf.get(known) == before and spark.conf.get(unknown, None) is None


@pytest.mark.parametrize("name", ["load_stamps", "layer_rebuild", "build_rejects"])
def test_layers_are_built_from_a_log_that_is_stored_once(spark, sf_dir, monkeypatch, name):
    """A build reads its log for rejects and for silver; the joins that make the log run once."""
    logs, build = [], medallion.build

    def watched(spark, log, *rest, **options):
        logs.append(plan(log))
        return build(spark, log, *rest, **options)

    monkeypatch.setattr(queries.medallion, "build", watched)
    QUERIES[name](spark, sf_dir)
    assert logs and not any("Join" in text for text in logs)


@pytest.mark.parametrize("name", ["file_lineage", "ndjson_roundtrip"])
def test_json_lines_are_written_compressed(spark, sf_dir, monkeypatch, name):
    found, read = [], queries.files.read_ndjson

    def watched(spark, path):
        found.extend(read(spark, path).inputFiles())
        return read(spark, path)

    monkeypatch.setattr(queries.files, "read_ndjson", watched)
    QUERIES[name](spark, sf_dir)
    assert found and all(f.endswith(".json.gz") for f in found)


def test_kept_tables_are_written_with_entropy_coding(spark):
    assert all(f.endswith(".zstd.parquet") for f in kept(spark.range(10), "numbers").inputFiles())


def test_gold_models_share_one_read_of_silver(spark, sf_dir, tmp_path, monkeypatch):
    """Each model reads the completed rides, and gives what it gives on all of silver; odd rows too."""
    log = bindings.bronze(spark, sf_dir)
    odd = log.filter("CAST(ride_id AS BIGINT) % 7 = 0").withColumns(
        {c: F.when(F.col("ride_id").endswith(d), F.lit(None)).otherwise(F.col(c)).cast(log.schema[c].dataType)
         for c, d in (("rider_id", "1"), ("driver_id", "2"), ("fare_cents", "3"), ("distance_meters", "4"), ("event_type", "5"))}
    ).withColumn("ride_id", F.concat(F.lit("odd"), "ride_id"))
    log = kept(log.unionByName(odd).unionByName(odd), "bronze")
    read = []

    def watched(model):
        return lambda rides: read.append(rides) or model(rides)

    models = dict(medallion.GOLD_MODELS)
    for name, model in models.items():
        monkeypatch.setitem(medallion.GOLD_MODELS, name, watched(model))
    built = medallion.build(spark, log, str(tmp_path), "month")
    rides = built["stg_rides"].filter("event_type = 'ride_completed'").count()
    assert len(read) == len(models) and all(df.count() == rides for df in read)
    assert not any("stg_rides" in f for df in read for f in df.inputFiles())
    for name, model in models.items():
        mine, whole = built[name].drop("_loaded_at"), model(built["stg_rides"])
        assert mine.exceptAll(whole).count() == whole.exceptAll(mine).count() == 0, name


def test_the_log_is_read_for_rejects_only_where_silver_left_rows_out(spark, sf_dir, tmp_path, monkeypatch):
    log = kept(bindings.bronze(spark, sf_dir), "bronze")
    marked = log.withColumn("event_id", F.when(F.col("ride_id") != "7", F.col("event_id")))
    stamped, stamp, built = [], medallion.stamp_loaded, {}
    monkeypatch.setattr(medallion, "stamp_loaded", lambda df: stamped.append(df) or stamp(df))
    for name, df in (("clean", log), ("marked", marked)):
        stamped.clear()
        built[name] = medallion.build(spark, df, f"{tmp_path}/{name}", "month")["rejects"]
        (rejects,) = [plan(x) for x in stamped if "_error" in x.columns]
        assert ("Scan parquet" in rejects[rejects.index("== Physical Plan =="):]) == (name == "marked")
    assert built["clean"].schema == built["marked"].schema and built["clean"].count() == 0
    assert built["marked"].count() == log.filter("ride_id = '7'").count() > 0
    assert [r[0] for r in built["marked"].select("_error").distinct().collect()] == ["missing_event_id"]
