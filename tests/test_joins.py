"""Joins: skew, rows in = rows out, resume, ranges, windows."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from gleaner.operators import dedup, joins, ledger
from gleaner.operators.skew import left_join


@pytest.mark.parametrize("how", ["left", "left_semi", "left_anti"])
def test_left_join_is_join(spark, how):
    rnd = random.Random(3)
    left = spark.createDataFrame(
        [(rnd.choice(["hot"] * 5 + ["miss"] * 4 + list("abcdef") + [None, None]), i) for i in range(300)],
        "k string, i int").repartition(6)
    right = spark.createDataFrame([(k, v) for k in ["hot", "a", "b", "b", None, "z"] for v in (1, 2)], "k string, v int")
    got = left_join(left, right, "k", how)
    want = left.join(right, "k", how)
    assert got.columns == want.columns
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want.collect()))


def test_null_keys_are_spread(spark):
    left = spark.createDataFrame([(None, i) for i in range(100)] + [("a", 1)], "k string, i int")
    plan = left_join(left, left, "k")._jdf.queryExecution().optimizedPlan().toString()
    assert "_part" in plan and left_join(left, left, "k", "left_semi").count() == 1


def test_join_content_chooses_by_digest(spark):
    meta = spark.createDataFrame([("a", 1)], "blob_id string, n int")
    texts = [("a", t) for t in ("one", "two", "three", "four")]
    import hashlib
    want = min((t for _, t in texts), key=lambda t: hashlib.sha256(t.encode()).hexdigest())
    for order in (texts, texts[::-1]):
        out = joins.join_content(meta, spark.createDataFrame(order, "blob_id string, text string").repartition(3))
        assert [r.text for r in out.collect()] == [want]


def test_join_content_keeps_rows(spark):
    meta = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4), ("x", 5)], "blob_id string, n int")
    content = spark.createDataFrame([("a", "t u"), ("a", "t u"), ("b", "")], "blob_id string, text string")
    out = {r.n: (r.text, r.word_count, r.status) for r in joins.join_content(meta, content).collect()}
    assert out == {1: ("t u", 2, "ok"), 2: ("t u", 2, "ok"), 3: ("", 0, "ok"),
                   4: ("", 0, "missing"), 5: ("", 0, "missing")}


def test_todo_and_done_are_all(spark):
    keys = spark.createDataFrame([(f"raw/{f}/{n}",) for f in "ab" for n in range(20)], "key string")
    done = spark.createDataFrame([(f"out/{n}",) for n in range(5)], "key string")
    todo = joins.todo_by_basename(keys, done, F.col("key"), F.col("key"))
    assert todo.count() == 30
    there = spark.createDataFrame([("raw/a/1",), ("raw/b/3",), ("other",)], "key string")
    assert joins.todo_by_key(keys, there).count() + joins.already_done(keys, there).count() == keys.count()


def test_resume_and_ranges_cover_each_file(spark):
    source = spark.createDataFrame([("new", 2500), ("part", 2500), ("full", 10), ("long", 10), ("empty", 0)],
                                   "key string, size long")
    target = spark.createDataFrame([("part", 1000), ("full", 10), ("long", 99), ("gone", 1)], "key string, size long")
    plan = joins.resume_plan(source, target)
    states = {r.key: (r.state, r.start_at) for r in plan.collect()}
    assert states == {"new": ("new", 0), "part": ("resume", 1000), "full": ("done", 10),
                      "long": ("restart", 0), "empty": ("new", 0)}
    bytes_left = {}
    for r in joins.byte_ranges(plan, 1024).collect():
        assert 0 < r.range_end - r.range_start + 1 <= 1024
        bytes_left.setdefault(r.key, []).extend(range(r.range_start, r.range_end + 1))
    assert {k: sorted(v) for k, v in bytes_left.items()} == {
        "new": list(range(2500)), "part": list(range(1000, 2500)), "long": list(range(10))}


def test_size_windows(spark):
    df = spark.range(-3, 106).select(F.col("id").alias("size"))
    got = {r.size: (r.window_low, r.window_high) for r in joins.size_windows(df, F.col("size")).collect()}
    want, low = {}, 0
    while low < 100:
        high = max(low + 1, min(100, low + 10))
        want.update({s: (low, high) for s in range(low, high + 1)})
        low = high + 1
    assert got == want


def test_seeds(spark):
    seeds = spark.createDataFrame([("a", 2), ("b", 0)], "term string, pages int")
    assert joins.seed_pages(seeds.select("term"), 3).count() == 6
    assert [(r.term, r.page_no) for r in joins.seed_pages(seeds, F.col("pages")).collect()] == [("a", 1), ("a", 2)]
    assert joins.seed_sources(seeds, ["x", "y"]).count() == 4


def test_dedup(spark):
    df = spark.createDataFrame([("t", "u", 2, "late"), ("t", "u", 1, None), ("t", "v", 3, "only")],
                               "term string, url string, pos int, alt string")
    assert sorted(map(tuple, dedup.first_seen(df, ["term", "url"], ["pos"]).collect())) == [
        ("t", "u", 1, None), ("t", "v", 3, "only")]
    seeds = spark.createDataFrame([(" a ", 0), ("b", 1), ("a", 2)], "term string, pos int")
    assert sorted(map(tuple, dedup.dedup_seeds(seeds, F.col("term"), F.col("pos")).collect())) == [("a", 0), ("b", 1)]
    assert [tuple(r) for r in dedup.key_collisions(df, ["url"]).collect()] == [("u", 2)]


def test_ledger_latest_and_upsert(spark):
    log = spark.createDataFrame(
        [("r", "f", "started", 1, 1), ("r", "f", "failed", 2, 2), ("r", "f", "completed", 2, 3), ("r", "g", "started", 1, 4)],
        "record string, url string, status string, ts int, seq int")
    last = ledger.latest_status(log, ["record", "url"], ["ts", "seq"])
    assert {r.url: r.status for r in last.collect()} == {"f": "completed", "g": "started"}
    assert [r.url for r in ledger.open_runs(log, ["record", "url"], ["ts", "seq"]).collect()] == ["g"]

    current = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], "k string, n int, s string")
    events = spark.createDataFrame([("a", None, "z", 1), ("a", 5, None, 2), ("a", 4, None, 1), ("c", 9, None, 1)],
                                   "k string, n int, s string, seq int")
    changes = ledger.merge_changes(events, ["k"], ["seq"])
    after = ledger.upsert_documents(current, changes, ["k"])
    state = {tuple(r) for r in after.collect()}
    assert state == {("a", 5, "z"), ("b", 2, "y"), ("c", 9, None)}
    again = ledger.upsert_documents(after, changes, ["k"])
    assert {tuple(r) for r in again.collect()} == state


def test_upsert_versions_do_not_touch_each_other(spark, tmp_path):
    root = str(tmp_path / "state")
    first = spark.createDataFrame([("a", 1)], "k string, n int")
    ledger.save_version(first, root, 1)
    changed = ledger.upsert_documents(ledger.read_version(spark, root, 1),
                                      spark.createDataFrame([("a", 2)], "k string, n int"), ["k"])
    ledger.save_version(changed, root, 2)
    assert ledger.read_version(spark, root, 1).first().n == 1
    assert ledger.read_version(spark, root, 2).first().n == 2 and ledger.read_version(spark, root).first().n == 2
    with pytest.raises(Exception, match="exists"):
        ledger.save_version(first, root, 2)


def test_upsert_clears_fields(spark):
    current = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], "k string, n int, s string")
    events = spark.createDataFrame([("a", None, None, ["n"], 2), ("a", 7, "z", ["n", "s"], 1), ("b", None, None, [], 1)],
                                   "k string, n int, s string, sets array<string>, seq int")
    after = ledger.upsert_documents(current, ledger.merge_changes(events, ["k"], ["seq"], "sets"), ["k"])
    assert {tuple(r) for r in after.collect()} == {("a", None, "z"), ("b", 2, "y")}


def test_retry_plan(spark):
    log = spark.sql("""SELECT * FROM VALUES
      ('ok', 'failed', timestamp'2024-01-01 00:00:00'), ('ok', 'completed', timestamp'2024-01-01 00:01:00'),
      ('again', 'failed', timestamp'2024-01-01 00:00:00'), ('again', 'failed', timestamp'2024-01-01 00:02:00'),
      ('never', 'failed', timestamp'2024-01-01 00:00:00'), ('never', 'failed', timestamp'2024-01-01 00:00:01'),
      ('never', 'failed', timestamp'2024-01-01 00:00:02'), ('new', 'started', timestamp'2024-01-01 00:00:00')
      AS t(url, status, ts)""")
    plan = {r.url: (r.action, str(r.next_at)[:19] if r.next_at else None)
            for r in ledger.retry_plan(log, ["url"], max_tries=3).collect()}
    assert plan == {"ok": ("done", None), "again": ("retry", "2024-01-01 00:02:02"),
                    "never": ("failed", None), "new": ("wait", None)}
