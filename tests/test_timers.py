"""Streams with timers, bounded state and merges: any cut into files, restarts, crashes."""

import pytest
from pyspark.sql import functions as F

from gleaner.operators import ledger
from gleaner.streaming import bounded, ingest, merge, state, timers

SCHEMA = "k string, ts timestamp, status string, seq long"
START = 1_704_067_200_000_000


def put(spark, folder, rows):
    (spark.createDataFrame([(k, float(s), status, seq) for k, s, status, seq in rows], "k string, s double, status string, seq long")
     .select("k", F.timestamp_micros((F.col("s") * 1_000_000).cast("bigint") + F.lit(START)).alias("ts"), "status", "seq")
     .coalesce(1).write.mode("append").parquet(folder))


def stream(spark, folder):
    return ingest.read_stream(spark, folder, SCHEMA, max_files=1)


@pytest.mark.parametrize("order", [(0, 1, 2), (1, 0, 2)])
def test_retries_come_due_as_time_passes(spark, tmp_path, order):
    folder, out, cp = (str(tmp_path / x) for x in ("in", "out", "cp"))
    files = [[("a", 1, "failed", 1), ("b", 2, "started", 2), ("c", 3, "failed", 3), (None, 4, "failed", 4)],
             [("c", 3.5, "failed", 6), ("c", 3.2, "failed", 5), ("b", 30, "completed", 7), ("e", 5, "completed", 8)],
             [("a", 40, "failed", 9), ("d", 45, "failed", 10)]]

    def run():
        due = timers.retry_timers(stream(spark, folder), ["k"], 3, "40 seconds", ttl_seconds=1000)
        return timers.run_retries(due, out, cp)

    for k in order:
        put(spark, folder, files[k])
    run()
    assert spark.read.parquet(out).count() < 7
    put(spark, folder, [("z", 500, "completed", 11)])
    run()                                                   # after a restart
    put(spark, folder, [("late", 7, "failed", 12), ("z", 2000, "completed", 13)])
    found = run()
    assert found["late"] == 1
    rows = {(r["k"], r["action"], r["failures"]): r["at"] for r in spark.read.parquet(out).collect()}
    assert set(rows) == {("a", "retry", 1), ("a", "retry", 2), ("b", "done", 0), ("c", "failed", 3), ("d", "retry", 1),
                         ("e", "done", 0), (None, "retry", 1), ("z", "done", 0)}
    # The times are those of the batch plan.
    put(spark, str(tmp_path / "one"), files[0][:1] + files[2][1:])
    plan = ledger.retry_plan(spark.read.parquet(str(tmp_path / "one")), ["k"], max_tries=3).collect()
    assert {r["k"]: r["next_at"] for r in plan} == {k: rows[k, "retry", 1] for k in ("a", "d")}


def test_state_is_gone_after_the_outcome(spark, tmp_path):
    folder, out, cp = (str(tmp_path / x) for x in ("in", "out", "cp"))
    put(spark, folder, [(f"k{i}", i / 10, ["failed", "started"][i % 2], i) for i in range(40)])
    put(spark, folder, [(f"k{i}", 100 + i / 10, "completed", 100 + i) for i in range(30)])
    put(spark, folder, [("end", 900, "completed", 1000)])    # ten keys have had no attempt for ttl_seconds
    due = timers.retry_timers(stream(spark, folder), ["k"], 3, "1 second", ttl_seconds=300)
    states = timers.run_retries(due, out, cp)
    assert spark.read.parquet(out).where("action = 'done'").count() == 30
    put(spark, folder, [("end", 2000, "completed", 1001)])
    after = timers.run_retries(timers.retry_timers(stream(spark, folder), ["k"], 3, "1 second", ttl_seconds=300), out, cp)
    # What is left is the attempt that the watermark has not passed yet, with its timer.
    assert after["keys"] <= 4 and states["keys"] <= 4


def test_retries_of_many_keys_share_calls(spark, tmp_path):
    """A micro-batch costs calls by bucket, not by key; every key has its own run all the same."""
    folder, out, cp = (str(tmp_path / x) for x in ("in", "out", "cp"))
    put(spark, folder, [(f"k{i}" if i else None, i / 100, "failed", i) for i in range(300)])
    put(spark, folder, [(f"k{i}", 60 + i / 100, ["failed", "completed"][i % 2], i) for i in range(100, 300)])
    put(spark, folder, [("end", 400, "failed", 1000)])
    due = timers.retry_timers(stream(spark, folder), ["k"], 2, "1 second", ttl_seconds=10_000, buckets=1)
    assert timers.run_retries(due, out, cp)["keys"] == 101    # those that failed once, and the last attempt
    rows = sorted(((r["k"] or "k0", r["action"], r["failures"]) for r in spark.read.parquet(out).collect()))
    assert rows == sorted([(f"k{i}", "retry", 1) for i in range(300)]
                          + [(f"k{i}", *[("failed", 2), ("done", 1)][i % 2]) for i in range(100, 300)])


class _Calls:
    """A state value and timers that count what is asked of them."""

    def __init__(self):
        self.value, self.timers, self.calls = None, set(), 0

    def __getattr__(self, name):
        def call(*args):
            self.calls += 1
            if name == "get":
                return self.value
            if name == "getValueState":
                return self
            if name == "update":
                self.value = args[0]
            elif name == "clear":
                self.value = None
            else:
                {"registerTimer": self.timers.add, "deleteTimer": self.timers.remove}[name](*args)
        return call

    def getCurrentWatermarkInMs(self):
        return 2_000


def test_a_bucket_takes_a_few_calls():
    calls = _Calls()
    scheduler = timers.RetryScheduler(["a", "b"], 2, 1000)
    scheduler.init(calls)
    values = [None, 2 ** 60 + 1, float("nan"), [1], "x"]
    rows = [(values[i % 5], i, 1_000_000 + j * 900_000, j, "failed") for i in range(500) for j in (1, 0)]
    list(scheduler.handleInputRows((0,), iter(rows[:500]), calls))
    list(scheduler.handleInputRows((0,), iter(rows[500:]), calls))
    found = [tuple(r) for r in scheduler.handleExpiredTimer((0,), calls, None)]
    assert calls.calls < 15 and calls.value is None and not calls.timers
    assert len(found) == 500 and {r[2:4] for r in found} == {("failed", 2)}
    assert sorted((r[1], repr(r[0])) for r in found) == [(i, repr(values[i % 5])) for i in range(500)]


def test_bounded_first_seen(spark, tmp_path):
    folder, out, cp = (str(tmp_path / x) for x in ("in", "out", "cp"))
    everything = set()
    for hour in range(8):
        rows = [(f"u{hour}-{i}", hour * 3600 + i, "x", i) for i in range(50)] + [("always", hour * 3600 + 60, "x", 60)]
        rows += [(f"late{hour}", 5, "x", 0), ("u0-1", 1, "x", 0), (None, hour * 3600, "x", 0)]
        everything |= {r[0] for r in rows}
        put(spark, folder, rows)
        if hour in (3, 7):
            sizes = bounded.bounded_first_seen(stream(spark, folder), out, cp, ["k"], "1 hour")
            assert max(sizes) <= 3 * 60                       # keys of two hours, not of all
    found = [r["k"] for r in bounded.seen_keys(spark, out, ["k"]).collect()]
    assert len(found) == len(set(found)) and set(found) == everything


def documents(spark, root):
    return sorted(((r["k"], r["status"], r["seq"]) for r in merge.merged_documents(spark, root).collect()), key=repr)


def test_merge_applies_a_batch_once(spark, tmp_path, monkeypatch):
    folder, root, cp = (str(tmp_path / x) for x in ("in", "root", "cp"))
    put(spark, folder, [("a", 1, "started", 1), ("b", 1, "started", 2), (None, 1, "x", 3)])
    put(spark, folder, [("a", 9, "completed", 5), ("a", 8, "failed", 4)])
    put(spark, folder, [("b", 0.5, "older", 0), ("c", 3, "started", 6)])
    go = lambda: merge.merge_stream(stream(spark, folder), root, cp, ["k"], ["ts", "seq"])
    write, calls = merge._POINTER, []

    real = spark.createDataFrame

    def crash(data, schema=None, *args, **kwargs):
        if schema == write and data and len(calls) < 2:
            calls.append(1)
            if len(calls) == 2:
                raise RuntimeError("killed between version and pointer")
        return real(data, schema, *args, **kwargs)

    monkeypatch.setattr(type(spark), "createDataFrame", lambda self, *a, **k: crash(*a, **k))
    with pytest.raises(Exception, match="killed"):
        go()
    monkeypatch.undo()
    go()
    expected = [("a", "completed", 5), ("b", "started", 2), ("c", "started", 6)]
    assert documents(spark, root) == expected
    # A batch that comes again changes nothing.
    again = spark.read.parquet(folder)
    merge._save(root, "changes", ["k"], ["ts", "seq"])(again, 2)
    assert documents(spark, root) == expected and merge._last(spark, root, "changes")[0] == 3
    # Another stream's numbers are its own.
    merge._save(root, "other", ["k"], ["ts", "seq"])(again, 0)
    assert documents(spark, root) == expected and merge._last(spark, root, "changes")[0] == 4


def test_compaction_survives_a_crash(spark, tmp_path, monkeypatch):
    folder, out, cp = (str(tmp_path / x) for x in ("in", "out", "cp"))
    put(spark, folder, [("a", 1, "started", 1), ("b", 2, "started", 2)])
    put(spark, folder, [("a", 3, "completed", 3)])
    keys, order = ["k"], ["ts", "seq"]
    state.write_updates(state.status_updates(stream(spark, folder), keys, order), out, cp)
    want = sorted(map(tuple, state.current(spark, out, keys).collect()))
    monkeypatch.setattr(type(spark), "createDataFrame", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("killed")))
    with pytest.raises(RuntimeError, match="killed"):
        state.compact(spark, out, state.newest(keys))
    monkeypatch.undo()
    assert sorted(map(tuple, state.current(spark, out, keys).collect())) == want
    for _ in range(2):
        state.compact(spark, out, state.newest(keys))
        assert sorted(map(tuple, state.current(spark, out, keys).collect())) == want
    put(spark, folder, [("b", 4, "failed", 4)])
    state.write_updates(state.status_updates(stream(spark, folder), keys, order), out, cp)
    assert {r["k"]: r["status"] for r in state.current(spark, out, keys).collect()} == {"a": "completed", "b": "failed"}
