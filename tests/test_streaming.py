"""Streams: resume, several micro-batches, same result as the batch operator."""

import pytest
from pyspark.sql import functions as F

from gleaner.operators import dedup, ledger
from gleaner.streaming import ingest, state

SCHEMA = "url string, status string, ts timestamp, seq long"


@pytest.fixture()
def landing(spark, tmp_path):
    """Three files, events out of order between them."""
    rows = [(f"u{(i * 7) % 11}", ["started", "failed", "completed", "failed"][i % 4], 60 * ((i * 13) % 40), i) for i in range(90)]
    df = spark.createDataFrame(rows, "url string, status string, s long, seq long").select(
        "url", "status", F.timestamp_seconds(F.col("s") + 1_704_067_200).alias("ts"), "seq")
    folder = str(tmp_path / "landing")
    for part in range(3):
        df.filter(F.col("seq") % 3 == part).coalesce(1).write.mode("append").parquet(folder)
    return folder, df, str(tmp_path)


def stream(spark, folder):
    return ingest.read_stream(spark, folder, SCHEMA, max_files=1)


def rows(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=repr)


def test_ingest_resumes(spark, landing):
    folder, df, base = landing
    for _ in range(2):
        ingest.stream_ingest(stream(spark, folder), base + "/out", base + "/cp")
    assert spark.read.parquet(base + "/out").count() == 90
    df.limit(5).coalesce(1).write.mode("append").parquet(folder)
    ingest.stream_ingest(stream(spark, folder), base + "/out", base + "/cp")
    assert spark.read.parquet(base + "/out").count() == 95


def test_status_is_batch_status(spark, landing):
    folder, df, base = landing
    state.write_updates(state.status_updates(stream(spark, folder), ["url"], ["ts", "seq"]), base + "/out", base + "/cp")
    assert spark.read.parquet(base + "/out/batches").select("batch_id").distinct().count() == 3
    want = ledger.latest_status(df, ["url"], ["ts", "seq"])
    assert rows(state.current(spark, base + "/out", ["url"]), *df.columns) == rows(want, *df.columns)


def test_first_seen_is_batch_dedup(spark, landing):
    folder, df, base = landing
    state.write_updates(state.first_seen_updates(stream(spark, folder), ["url"], ["ts", "seq"]), base + "/out", base + "/cp")
    got = state.current(spark, base + "/out", ["url"]).select("url", "first.ts", "first.seq")
    assert rows(got, "url", "seq") == rows(dedup.first_seen(df.select("url", "ts", "seq"), ["url"], ["ts", "seq"]), "url", "seq")


def test_first_seen_with_horizon(spark, landing):
    folder, df, base = landing
    keep = state.first_seen_partials(["url"], ["ts", "seq"], "10 minutes")
    state.write_partials(stream(spark, folder), keep, base + "/out", base + "/cp")
    fold = state.first_seen(["url"])
    got = fold(state.written(spark, base + "/out"))
    assert rows(got, "url", "period", "first") == rows(keep(df), "url", "period", "first")


def test_rate_counts_late_requests(spark, landing):
    folder, df, base = landing
    want = df.groupBy(F.date_trunc("minute", "ts").alias("window_start")).agg(F.count("*").alias("requests"))
    run = lambda: state.write_partials(stream(spark, folder), state.rate_partials(), base + "/out", base + "/cp")
    run()
    state.compact(spark, base + "/out", state.rates)
    late = df.limit(7).withColumn("ts", F.lit("2001-01-01").cast("timestamp"))
    late.coalesce(1).write.mode("append").parquet(folder)
    run()
    want = want.union(spark.createDataFrame([(7,)], "requests long").select(F.lit("2001-01-01").cast("timestamp"), "requests"))
    got = state.rates(state.written(spark, base + "/out"))
    assert rows(got, "window_start", "requests") == rows(want, "window_start", "requests")
    state.compact(spark, base + "/out", state.rates)
    got = state.rates(state.written(spark, base + "/out"))
    assert rows(got, "window_start", "requests") == rows(want, "window_start", "requests")
    assert {r.over_budget for r in state.over_budget(got, 2).collect()} == {r.requests > 2 for r in got.collect()}


def test_compacted_updates(spark, landing):
    folder, df, base = landing
    state.write_updates(state.status_updates(stream(spark, folder), ["url"], ["ts", "seq"]), base + "/out", base + "/cp")
    before = rows(state.current(spark, base + "/out", ["url"]), *df.columns)
    state.compact(spark, base + "/out", state.newest(["url"]))
    plan = state.written(spark, base + "/out")._jdf.queryExecution().executedPlan().toString()
    assert "upto" in plan and rows(state.current(spark, base + "/out", ["url"]), *df.columns) == before


def test_retry_is_batch_plan(spark, landing):
    folder, df, base = landing
    state.write_updates(state.retry_updates(stream(spark, folder), ["url"]), base + "/out", base + "/cp")
    got = state.retry_schedule(spark, base + "/out", ["url"], max_tries=4)
    want = ledger.retry_plan(df, ["url"], max_tries=4)
    columns = ["url", "failures", "succeeded", "last_attempt", "action", "next_at"]
    assert rows(got, *columns) == rows(want, *columns)
    assert state.due(got, F.lit("2999-01-01").cast("timestamp")).count() == got.filter("action = 'retry'").count()
    assert state.due(got, F.lit("1999-01-01").cast("timestamp")).count() == 0
