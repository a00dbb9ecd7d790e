"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing columns for every operator."""

import pytest
from pyspark.sql import functions as F, types as T

import corpus_pipeline
import public_tokenizers
from gleaner.llm import contamination, grace, language, lines, near, packing, passages, quality, substrings, warc

LONG = " ".join(f"word{i % 997}x{i}" for i in range(30_000))
WORDS = " ".join(f"alpha{i}" for i in range(80))
CLASH = ["id", "n", "block", "key", "th", "line", "n_lines", "kept", "size", "grade", "lang"]
ROWS = [(1, WORDS), (2, WORDS), (2, WORDS), (3, None), (4, ""), (5, " \t\n "), (6, LONG), (7, LONG + " tail"),
        (None, WORDS), (None, None), (8, "one two"), (9, "é☃ 漢字"), (9, "another text of the same id")]


def frame(spark, rows):
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())]
                          + [T.StructField(c, T.StringType()) for c in CLASH])
    return spark.createDataFrame([r + ("x",) * len(CLASH) for r in rows], schema)


@pytest.fixture(scope="module")
def docs(spark):
    return frame(spark, ROWS).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return frame(spark, [])


def ids(df, column="doc_id"):
    return sorted((r[column] for r in df.select(column).collect()), key=lambda x: (x is None, x))


ALL = sorted((r[0] for r in ROWS), key=lambda x: (x is None, x))


def test_near(docs, none):
    rows = near.near_duplicates(docs).collect()
    assert sorted((r["doc_id"] for r in rows), key=lambda x: (x is None, x)) == ALL
    by = {(r["doc_id"], r["n_shingles"]): r for r in rows}
    assert by[2, 76]["component_id"] == 1 and not by[2, 76]["kept"] and by[1, 76]["kept"]
    assert by[None, 76]["component_id"] is None and by[None, 76]["kept"]
    assert all(by[i, 0]["component_id"] == i and by[i, 0]["kept"] for i in (3, 4, 5))
    assert by[7, 29997]["component_id"] == 6 and by[8, 1]["component_id"] == 8
    assert near.near_duplicates(none).count() == 0


def test_grace(docs, none):
    rows = grace.exact_duplicates(docs).collect()
    assert len(rows) == len(ROWS)
    group = [r for r in rows if r["group_size"] == 4]
    assert {r["keep_id"] for r in group} == {2} and sorted(r["kept"] for r in group) == [False, False, True, True]
    empty = [r for r in rows if r["doc_id"] in (3, 4)]
    assert all(r["keep_id"] == 4 and r["group_size"] == 3 for r in empty)
    assert grace.exact_duplicates(none).count() == 0


def test_substrings(docs, none):
    rows = substrings.repeated_spans(docs).collect()
    assert sorted((r["doc_id"] for r in rows), key=lambda x: (x is None, x)) == ALL
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], []).append(r)
    assert by[1][0]["n_removed"] == 0 and all(r["n_removed"] == r["n_bytes"] for r in by[2])
    assert [(s["start"], s["end"]) for s in by[7][0]["spans"]] == [(0, len(LONG))]
    assert sorted(r["n_removed"] for r in by[None]) == [0, len(WORDS)]
    assert substrings.repeated_spans(none).count() == 0


def test_passages(docs, none):
    rows = {r["doc_id"]: r for r in passages.repeated_passages(docs).collect()}
    assert sorted(rows) == sorted(set(ALL) - {None})
    assert rows[2]["class_id"] == 1 and rows[2]["n_dup_words"] == 80 and rows[7]["class_id"] == 6
    assert rows[9]["class_id"] == 9 and rows[3]["n_dup_words"] == 0
    assert passages.repeated_passages(none).count() == 0


def test_packing(docs, none):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    rows = packing.pack(docs, path, 2).collect()
    assert sum(r["piece"] == 0 for r in rows) == len(ROWS)
    assert all(r["length"] == 1 for r in rows if r["doc_id"] in (3, 4))
    assert packing.pack(none, path, 2).count() == 0


def test_language(spark, docs, none):
    model = language.train(docs.withColumn("lang", F.when(F.col("doc_id") < 7, "aa").when(F.col("doc_id") == 9, "bb")))
    assert model.langs == ["aa", "bb"]
    rows = language.identify(docs, model).collect()
    assert len(rows) == len(ROWS)
    assert all(r["lang_pred"] == "und" and r["score"] == 0 and not r["spans"] for r in rows if r["doc_id"] in (3, 4, 5))
    assert all(r["lang_pred"] != "und" for r in rows if r["doc_id"] in (1, 6, 9))
    empty = language.train(none)
    assert empty.langs == [] and {r["lang_pred"] for r in language.identify(docs, empty).collect()} == {"und"}
    assert language.identify(none, model).count() == 0


def test_quality(spark, docs, none):
    grades = spark.createDataFrame([(1, 2), (6, 0), (3, 2), (None, 1), (2, None), (1, 2)], "doc_id long, grade int")
    rows = quality.judge(docs, grades).collect()
    assert len(rows) == len(ROWS) and all(0 <= r["tail"] <= 1 and 0 <= r["expected_grade"] <= 2 for r in rows)
    assert quality.judge(none, grades).count() == 0
    unjudged = quality.judge(docs, grades.where("false")).collect()
    assert all(r["selected"] and r["tail"] is None for r in unjudged)
    assert quality.select(docs, grades.where("false")).count() == len(ROWS)
    assert quality.select(docs, grades).columns == docs.columns


def test_lines(spark, docs, none):
    out = lines.drop_recurring_lines(docs)
    assert out.columns == [c for c in docs.columns if c != "n_lines"] + ["n_lines", "n_dropped"]
    rows = out.collect()
    assert sorted((r["doc_id"] for r in rows), key=lambda x: (x is None, x)) == ALL
    assert all(r["n_dropped"] == 0 for r in rows) and {r["text"] for r in rows} == {r[1] for r in ROWS}
    assert lines.drop_recurring_lines(none).count() == 0


def test_contamination(spark, docs, none):
    bench = spark.createDataFrame([(10, " ".join(f"ALPHA{i}," for i in range(20, 50))), (11, None), (12, ""), (13, "a b"),
                                   (10, " ".join(f"ALPHA{i}," for i in range(20, 50)))], "item_id long, text string")
    assert ids(contamination.contaminated(docs, bench)) == [1, 2]
    assert ids(contamination.remove(docs, bench)) == [3, 4, 5, 6, 7, 8, 9, 9, None]
    assert contamination.contaminated(docs, bench.where("false")).count() == 0
    assert contamination.remove(docs, bench.where("false")).count() == len(ROWS)
    assert contamination.contaminated(none, bench).count() == 0


def test_archives(spark):
    schema = "page_id long, url string, html string, path string, record string"
    rows = [(5, "http://a/\r\nX: y", "<p>é</p>", "q", "q"), (3, None, "<p>é</p>", "q", "q"), (3, None, "<p>é</p>", "q", "q"),
            (7, "u", None, "q", "q"), (8, "u", "", "q", "q"), (None, "u", "", "q", "q"), (None, "u", "z" * 3_000_000, "q", "q")]
    out = warc.archive_pages(spark.createDataFrame(rows, schema).repartition(2)).collect()
    got = sorted(((r["page_id"], r["payload_bytes"], r["record_type"], r["refers_to"]) for r in out), key=repr)
    assert got == sorted([(3, 9, "response", None), (3, 9, "revisit", 3), (5, 9, "revisit", 3), (7, 0, "response", None),
                          (8, 0, "revisit", 7), (None, 0, "revisit", 7), (None, 3_000_000, "response", None)], key=repr)
    assert warc.archive_pages(spark.createDataFrame([], schema)).count() == 0


@pytest.mark.parametrize("name, step", corpus_pipeline.STAGES)
def test_stages(spark, docs, none, sf_dir, name, step):
    for rows in (docs, none):
        out = step(spark, rows, sf_dir)
        out.count()
        if name != "packing":
            assert out.columns == docs.columns


def test_packing_of_long_runs(spark):
    ready = packing.encoder(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    whole = packing.encoder(public_tokenizers.path("byte_bpe_50k.json"))
    runs = [" " * 1_000_000, "\n" * 1_000_000 + "x", "a" * 1_000_000, "7" * 200_000, "=" * 200_000 + " word", "\t \n" * 400_000]
    for text in [*runs, "some words " + " " * (packing.LONGEST + 1) + "more", "a" * packing.LONGEST, "漢" * 100_000]:
        assert ready(text) == whole(text)
    found = packing.pack(frame(spark, list(enumerate(runs[:2]))), public_tokenizers.path("byte_bpe_50k.tiktoken"), end_id=2)
    total = {r["doc_id"]: r["n"] for r in found.groupBy("doc_id").agg(F.sum("length").alias("n")).collect()}
    assert total == {i: len(whole(t)) + 1 for i, t in enumerate(runs[:2])}
