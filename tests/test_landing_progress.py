import json

import pytest
from pyspark.sql import functions as F

from tripmill.sources import compaction, files
from tripmill.streaming import events as se
from tripmill.streaming import progress as pr

DAYS = ["year", "month", "day"]


def landed(spark, path, batches=8, rows=60):
    for b in range(batches):
        frame = spark.range(b * rows, (b + 1) * rows).select(
            "id", F.concat(F.lit("text "), "id").alias("text"), F.lit(2024).alias("year"),
            F.lit(1).alias("month"), (F.col("id") % 3 + 1).cast("int").alias("day"),
        )
        frame.repartition(2).write.mode("append").partitionBy(*DAYS).option("compression", "gzip").json(path)


def test_packs_are_gapless_and_bounded(spark, rows):
    sizes = [(f"f{i:03d}", (i * 37) % 90 + 1, i % 4 or None) for i in range(200)]
    got = rows(compaction.packs(spark.createDataFrame(sizes, "file string, bytes bigint, day int"), ["day"], 100))
    assert len(got) == 200
    by_pack = {}
    for r in got:
        by_pack.setdefault(r["pack"], []).append(r)
    assert sorted(by_pack) == list(range(len(by_pack)))
    for members in by_pack.values():
        assert len({m["day"] for m in members}) == 1
        assert sum(m["bytes"] for m in members) < 100 + 90
    assert len(by_pack) <= sum(s for _, s, _ in sizes) / 100 + 4


@pytest.mark.parametrize("target", [1 << 20, 400])
def test_landed_files_are_packed_and_no_line_is_lost(spark, tmp_path, target):
    path, out = str(tmp_path / "landing"), str(tmp_path / "out")
    landed(spark, path)
    small = compaction.listed_files(spark, path, DAYS)
    sizes = small.agg(F.count("*"), F.sum("bytes"), F.max("bytes")).first()
    made = compaction.compact_lines(spark, path, out, DAYS, target)
    there = compaction.listed_files(spark, out, DAYS).count()
    assert there == made < sizes[0]
    assert made <= sizes[1] / target + 3
    for _ in range(2):
        assert spark.read.json(out).exceptAll(spark.read.json(path)).count() == 0
        assert spark.read.json(out).count() == 480
        compaction.compact_lines(spark, path, out, DAYS, target)
    assert compaction.listed_files(spark, out, DAYS).count() == there


def test_the_listing_reads_no_content(spark, tmp_path):
    path = str(tmp_path / "landing")
    landed(spark, path, 1)
    plan = compaction.listed_files(spark, path, DAYS)._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema:")[-1]
    with pytest.raises(ValueError, match="hour"):
        compaction.listed_files(spark, path, ["hour"])


def test_a_changed_day_is_replaced_and_others_stay(spark, tmp_path):
    path, other, out = (str(tmp_path / n) for n in ("landing", "other", "out"))
    landed(spark, path)
    compaction.compact_lines(spark, path, out, DAYS)
    spark.createDataFrame([(9999, "new", 2024, 1, 2)], "id long, text string, year int, month int, day int").write.partitionBy(*DAYS).json(other)
    compaction.compact_lines(spark, other, out, DAYS)
    got = {r["day"]: r["n"] for r in spark.read.json(out).groupBy("day").agg(F.count("*").alias("n")).collect()}
    assert got == {1: 160, 2: 1, 3: 160}


def dedup_run(spark, source, schema, tmp_path, table, name="dedup"):
    listener = pr.ProgressTable(spark, table, {name})
    stream = se.drop_redelivered(files.stream_files(spark, source, schema, max_files=1), ts="ts", key="id")
    writer = stream.writeStream.format("parquet").queryName(name).option("path", str(tmp_path / "out"))
    spark.streams.addListener(listener)
    try:
        query = se.run_available(writer.option("checkpointLocation", str(tmp_path / "cp")))
        assert listener.wait_for(query)
    finally:
        spark.streams.removeListener(listener)


def test_progress_is_kept_over_a_restart(spark, tmp_path):
    source, table = str(tmp_path / "in"), str(tmp_path / "progress")

    def put(first, hour):
        at = F.timestamp_seconds(F.lit(1704067200 + hour * 3600) + F.col("id") % 60)
        spark.range(first, first + 100).select("id", at.alias("ts")).coalesce(1).write.mode("append").parquet(source)

    put(0, 0)
    schema = spark.read.parquet(source).schema
    dedup_run(spark, source, schema, tmp_path, table)
    (one,) = pr.freshness(pr.read_progress(spark, table)).collect()
    assert (one["query"], one["batches"], one["input_rows"], one["dropped_late"]) == ("dedup", 1, 100, 0)
    put(100, 5)
    dedup_run(spark, source, schema, tmp_path, table)
    put(200, 1)
    dedup_run(spark, source, schema, tmp_path, table)
    (row,) = pr.freshness(pr.read_progress(spark, table)).collect()
    assert (row["batches"], row["input_rows"], row["dropped_late"]) == (3, 300, 100)
    assert row["watermark"] > one["watermark"]
    behind = pr.lag(pr.read_progress(spark, table)).filter("lag_seconds IS NOT NULL")
    assert behind.count() > 0 and behind.filter("lag_seconds <= 0").count() == 0


def test_a_repeated_batch_counts_once_and_other_queries_are_left_out(spark, tmp_path):
    table = str(tmp_path / "progress")
    pr.ProgressTable(spark, table)
    assert pr.read_progress(spark, table).count() == 0
    base = {"query": "q", "run_id": "r", "batch": 0, "at": "2024-01-01T00:00:00Z", "input_rows": 5, "dropped_late": 1,
            "watermark": "1970-01-01T00:00:00Z"}
    reports = [base, base | {"run_id": "s", "at": "2024-01-01T00:01:00Z"}, base | {"batch": 1, "input_rows": 0, "dropped_late": 0}]
    text = spark.createDataFrame([(json.dumps(r),) for r in reports], "v string")
    text.select(F.from_json("v", pr.PROGRESS).alias("r")).select("r.*").write.mode("append").parquet(f"{table}/reports")
    got = {r["batch"]: r for r in pr.lag(pr.read_progress(spark, table)).collect()}
    assert got[0]["run_id"] == "s" and got[0]["lag_seconds"] is None and len(got) == 2
    (row,) = pr.freshness(pr.read_progress(spark, table)).collect()
    assert (row["batches"], row["input_rows"], row["dropped_late"]) == (1, 5, 1)
