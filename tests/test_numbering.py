"""Numbering in pieces against brute force and plain windows, with groups of one piece and of many."""

import random

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import Window, functions as F

from gleaner.operators import aggregate, numbering, skew


@pytest.fixture(params=["false", "true"], ids=["pieces", "one"], autouse=True)
def coalesce(spark, request):
    """Small tables make one piece; without coalescing they make eight."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, request.param)
    yield
    spark.conf.set(name, "true")


def rows(seed=1, n=400):
    """One group holds a third of the rows, some rows have no group."""
    rnd = random.Random(seed)
    ids = rnd.sample(range(-50, 5000), n)
    return [(rnd.choice(["hot", "hot", "hot", "a", "b", "c", "d", None, "e"]), i, rnd.randint(0, 9)) for i in ids]


def frame(spark, data):
    return spark.createDataFrame(data, "g string, i long, x long").repartition(5)


def grouped(data):
    out = {}
    for row in sorted(data, key=lambda r: r[1]):
        out.setdefault(row[0], []).append(row)
    return out


def test_number_and_running_total(spark):
    data = rows()
    df = numbering.number_rows(frame(spark, data), ["g"], ["i"], "n", total="size", start=1)
    df = numbering.running_total(df, ["g"], ["i"], F.col("x"), "before", total="all")
    got = {(r.g, r.i): (r.n, r.size, r.before, r["all"]) for r in df.collect()}
    want = {}
    for g, members in grouped(data).items():
        total, seen = sum(m[2] for m in members), 0
        for n, (_, i, x) in enumerate(members):
            want[(g, i)] = (n + 1, len(members), seen, total)
            seen += x
    assert got == want


def test_global_number(spark):
    data = rows(2)
    df = numbering.number_rows(frame(spark, data), [], ["i"], "n")
    got = {r.i: r.n for r in df.collect()}
    assert got == {r[1]: n for n, r in enumerate(sorted(data, key=lambda r: r[1]))}


def test_previous_value(spark):
    data = [(g, i, None if x == 3 else x) for g, i, x in rows(3)]
    df = numbering.previous_value(frame(spark, data), ["g"], ["i"], "x", "prev")
    got = {(r.g, r.i): r.prev for r in df.collect()}
    want = {}
    for members in grouped(data).values():
        last = None
        for g, i, x in members:
            want[(g, i)], last = last, x
    assert got == want


def test_stop_at_repeat(spark):
    data = [(g, i, i % 97) for g, i, _ in rows(4)]  # few repeats, so prefixes are long
    data += [("late", i, 500 + i) for i in range(300)] + [("late", 300, 799)]
    df = frame(spark, data).withColumn("items", F.when((F.col("g") == "a") & (F.col("i") > 2000), 0).otherwise(1))
    kept = numbering.stop_at_repeat(df, ["g"], ["i"], "x", "items")
    got = {(r.g, r.i) for r in kept.collect()}
    want = set()
    for members in grouped(data).values():
        last = None
        for g, i, x in members:
            if x == last or (g == "a" and i > 2000):
                break
            want.add((g, i))
            last = x
    assert got == want and ("late", 299) in got and ("late", 300) not in got


@pytest.mark.parametrize("limit", [None, 0, 1, 7])
def test_cap(spark, limit):
    data = rows(5)
    capped = numbering.cap_per_group(frame(spark, data), ["g"], ["i"], limit)
    got = sorted(r.i for r in capped.collect())
    assert got == sorted(r[1] for m in grouped(data).values() for r in (m[:limit] if limit else m))


@pytest.mark.parametrize("n,chunks", [(10, 3), (3, 10), (100, 7), (1, 1), (99, 100)])
def test_chunks_cover_each_row_once(spark, n, chunks):
    df = spark.range(n).withColumnRenamed("id", "i").repartition(3)
    got = numbering.work_chunks(df, ["i"], chunks).orderBy("i").collect()
    size, more = divmod(n, chunks)
    want = [c + 1 for c in range(chunks) for _ in range(size + (c < more))]
    assert [r.i for r in got] == list(range(n)) and [r.chunk for r in got] == want


def test_batches_and_budget(spark):
    df = spark.range(250).select(F.lit("f").alias("g"), F.col("id").alias("i"))
    sizes = numbering.upload_batches(df, ["g"], ["i"], 100).groupBy("batch").count()
    assert {r["batch"]: r["count"] for r in sizes.collect()} == {0: 100, 1: 100, 2: 50}
    budget = numbering.rate_budget(df, ["i"], F.lit("2024-01-01").cast("timestamp"), 30, 60)
    slots = budget.groupBy("slot", "not_before").count().orderBy("slot").collect()
    assert [r["count"] for r in slots] == [30] * 8 + [10]
    assert (slots[1].not_before - slots[0].not_before).total_seconds() == 60


def test_lists_stay_bounded_and_whole(spark):
    data = rows(6)
    docs = aggregate.numbered_lists(frame(spark, data), ["g"], ["i"], F.col("i"), size=10).collect()
    assert max(len(r["items"]) for r in docs) <= 10
    got = {}
    for r in sorted(docs, key=lambda r: r.chunk):
        got.setdefault(r.g, []).extend(r["items"])
    assert got == {g: [m[1] for m in members] for g, members in grouped(data).items()}


KEYS = st.sampled_from(["a", "b", "http://h.org/x1", "http://h.org/x2", None])


@given(st.lists(st.tuples(KEYS, st.integers(-5, 5) | st.none()), min_size=1, max_size=60), st.booleans(), st.booleans())
@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_same_as_plain_windows(spark, data, down, grouped_):
    df = spark.createDataFrame([(g, v, i) for i, (g, v) in enumerate(data)], "g string, v long, i long").repartition(3)
    group = ["g"] if grouped_ else []
    order = [F.col("v").desc() if down else F.col("v"), F.col("i").desc() if down else F.col("i")]
    w = Window.partitionBy(*group).orderBy(*order)
    got = numbering.running_total(numbering.number_rows(df, group, order, "n"), group, order, F.col("v"), "t", total="s")
    got = numbering.previous_value(got, group, order, "v", "p")
    want = (df.withColumn("n", F.row_number().over(w).cast("bigint") - 1)
            .withColumn("t", F.coalesce(F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
            .withColumn("s", F.coalesce(F.sum("v").over(Window.partitionBy(*group)), F.lit(0)))
            .withColumn("p", F.lag("v").over(w)))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


def test_slice_of_rows(spark):
    got = numbering.key_slice(frame(spark, rows(7)), ["i"], 30, 75).collect()
    assert sorted(r.i for r in got) == sorted(r[1] for r in rows(7))[30:75]


def test_one_exchange(spark):
    df = numbering._ordered(frame(spark, rows()), ["g"], ["i"], F.lit(1).cast("bigint"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange range") == 1 and "Exchange hash" not in plan


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from([None, "a", "b"]), st.sampled_from([None, "a", "b"])), min_size=1, max_size=60))
def test_nulls_in_several_group_columns(spark, groups):
    data = [(g, h, i) for i, (g, h) in enumerate(groups)]
    df = spark.createDataFrame(data, "g string, h string, i long").repartition(3)
    number = {(r.i): r.number for r in numbering.number_rows(df, ["g", "h"], ["i"], "number").collect()}
    before = {r.i: r.before for r in numbering.previous_value(df, ["g", "h"], ["i"], "i", "before").collect()}
    lists = {(r.g, r.h): list(r["items"]) for r in aggregate.numbered_lists(df, ["g", "h"], ["i"], F.col("i")).collect()}
    for g, h, i in data:
        mine = [j for x, y, j in data if (x, y) == (g, h)]
        assert number[i] == mine.index(i) and lists[g, h] == mine
        assert before[i] == (mine[mine.index(i) - 1] if mine.index(i) else None)


def test_decimal_totals(spark):
    df = spark.range(300).select((F.col("id") % 3).alias("g"), F.col("id").alias("i"),
                                 (F.col("id") * F.lit("0.75").cast("decimal(10,2)")).cast("decimal(20,2)").alias("x"))
    large = df.withColumn("x", F.col("x") + F.lit("123456789012345678.25").cast("decimal(20,2)"))
    for frame_ in (df, large):
        got = numbering.running_total(frame_.repartition(4), ["g"], ["i"], F.col("x"), "before", total="all")
        w = Window.partitionBy("g").orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
        want = frame_.withColumns({"before": F.coalesce(F.sum("x").over(w), F.lit(0)), "all": F.sum("x").over(Window.partitionBy("g"))})
        assert sorted(map(tuple, got.select("i", "before", "all").collect())) == sorted(
            map(tuple, want.select("i", "before", "all").collect()))


def test_tables_with_maps(spark):
    df = spark.range(200).select((F.col("id") % 3).alias("g"), F.col("id").alias("i"), F.create_map(F.lit("k"), "id").alias("m"),
                                 F.array(F.create_map(F.lit("k"), "id")).alias("n"))
    assert numbering.cap_per_group(df, ["g"], ["i"], 4).count() == 12
    assert numbering.number_rows(df, ["g"], ["i"], "number").where("number = m['k'] div 3").count() == 200
    left = df.withColumn("g", F.when(F.col("g") > 0, F.col("g")))
    assert skew.left_join(left, spark.createDataFrame([(1, "x")], "g long, v string"), "g").where("v IS NULL").count() == 133


@pytest.mark.parametrize("start, stop, small", [(0, 5, 10), (190, 280, 10), (100, 101, 1000), (395, 900, 50), (7, 7, 10), (900, 950, 9)])
def test_slices(spark, start, stop, small):
    data = [(g, i if g != "a" else None, i) for g, i, _ in rows(8)]
    df = spark.createDataFrame(data, "g string, h long, i long").repartition(4)
    got = [r.i for r in numbering.key_slice(df, ["g", "h", "i"], start, stop, ranges=5, small=small).collect()]
    want = [r.i for r in df.orderBy("g", "h", "i").collect()][start:stop]
    assert sorted(got) == sorted(want)
    down = numbering.key_slice(df, [F.col("i").desc()], start, stop)
    assert sorted(r.i for r in down.collect()) == sorted([r.i for r in df.orderBy(F.col("i").desc()).collect()][start:stop])


def test_a_small_slice_writes_nothing(spark, monkeypatch):
    monkeypatch.setattr(numbering, "stage", lambda *a: pytest.fail("the table was written"))
    df = spark.range(5000).select(F.col("id").alias("i"), F.lit(1).alias("same"))
    assert [r.i for r in numbering.key_slice(df, ["same", "i"], 4000, 4090, small=500).collect()] == list(range(4000, 4090))
