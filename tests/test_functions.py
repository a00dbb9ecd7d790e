"""Column functions against plain Python."""

import os
import re
from urllib.parse import urljoin

import pytest
from hypothesis import Phase, given, settings, strategies as st
from pyspark.sql import functions as F

from gleaner.functions import names, predicates, retry, text, urls


def column(spark, values, expr, name="v", kind="string"):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, {name} {kind}")
    return [r[0] for r in df.orderBy("i").select(expr.alias("out")).collect()]


SPACES = "\t\n\x0b\x0c\r \x1c\x1d\x1e\x1f\x85\xa0        　"
WORDS = st.text(alphabet=SPACES + "abcé漢​﻿_-.", max_size=40)


@settings(max_examples=5, deadline=None, derandomize=True, phases=[Phase.generate])
@given(st.lists(WORDS, min_size=50, max_size=200))
def test_word_count_is_python_split(spark, values):
    assert column(spark, values, text.word_count(F.col("v"))) == [len(v.split()) for v in values]


def test_word_count_edges(spark):
    got = column(spark, ["", " ", None, "a", " a　b "], text.word_count(F.col("v")))
    assert got == [0, 0, None, 1, 2]


@settings(max_examples=5, deadline=None, derandomize=True, phases=[Phase.generate])
@given(st.lists(st.text(alphabet=SPACES + "aZ09é漢/_-.!", max_size=30), min_size=50, max_size=200))
def test_sanitize_is_python_re(spark, values):
    want = [re.sub(r"[^a-zA-Z0-9\s]", "", v).replace(" ", "_") + ".jpg" for v in values]
    assert column(spark, values, names.sanitize_filename(F.col("v"), ".jpg")) == want


@settings(max_examples=5, deadline=None, derandomize=True, phases=[Phase.generate])
@given(st.lists(st.text(alphabet="a.b", max_size=8), min_size=50, max_size=200))
def test_stem_and_extension_are_splitext(spark, values):
    stems = column(spark, values, names.file_stem(F.col("v")))
    endings = column(spark, values, names.file_extension(F.col("v")))
    assert list(zip(stems, endings)) == [os.path.splitext(v) for v in values]


BASES = ["http://h.org/a/b/c?x=1#f", "https://h.org", "https://h.org/", "http://h.org:80/a/", "http://h.org/a"]
HREFS = ["", "g", "./g", "g/", "/g", "//other/x", "?y", "g?y", "#s", "g#s", "g?y#s", "..", "../", "../g", "../..",
         "../../g", "../../../g", "/./g", "/../g", "g.", ".g", "g..", "./../g", "./g/.", "g/./h", "g/../h",
         "http://full/x", "https://h.org/a/../b", "mailto:x@y", "a/b/../../c", ".", "./", "/a//b", "x//y"]


def test_resolve_url_is_urljoin(spark):
    pairs = [(b, h) for b in BASES for h in HREFS]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, base string, href string")
    got = [r[0] for r in df.orderBy("i").select(urls.resolve_url(F.col("base"), F.col("href"))).collect()]
    # A URL that is absolute already is returned as written.
    want = [h if h.startswith("http") else urljoin(b, h) for b, h in pairs]
    assert [(p, g) for p, g, w in zip(pairs, got, want) if g != w] == []


def test_url_parts(spark):
    u = F.col("v")
    seeds = ["https://h.org/a/b.pdf?sig=1/x", "https://h.org/item/", "https://h.org/item//", "plain", "https://h/" + "y" * 300]
    assert column(spark, seeds, urls.url_basename(u)) == [v.split("/")[-1][:255] for v in seeds]
    assert column(spark, seeds, urls.url_basename_noquery(u)) == [v.split("/")[-1].split("?")[0] for v in seeds]
    assert column(spark, seeds[:4], urls.item_name(u)) == ["x", "item", "item", "plain"]
    assert column(spark, ["a b"], urls.search_url("https://h/", u, F.lit(2), "pagi", "/")) == ["https://h/a%20b/?pagi=2"]
    assert column(spark, [" a b "], urls.folder_token(u)) == ["a_b"]
    assert column(spark, ["x?w=gi&h=1", "x"], urls.rewrite_url(u, "w=gi", "w=0")) == ["x?w=0&h=1", "x"]
    assert column(spark, ["https://h.org/p/q"], urls.root_relative(u, F.lit("/z"))) == ["https://h.org/z"]
    assert column(spark, ["https://h.org/p/q"], urls.root_relative(u, F.lit("z"))) == ["z"]
    assert column(spark, ["b"], urls.object_key(F.lit("a"), u, F.lit(None).cast("string"), F.lit("c"))) == ["a/b/c"]


def test_names(spark):
    v = F.col("v")
    assert column(spark, ["a b/c", None], names.alt_token(v)) == ["a_b_c", ""]
    assert column(spark, ["", None, "x"], names.media_src(v, F.lit("d"))) == ["d", "d", "x"]
    assert column(spark, ["", "x"], names.media_src(v, F.lit(""))) == [None, "x"]
    assert column(spark, ["u"], names.md5_name(F.lit(1), v)) == ["image_1_7b774effe4a349c6dd82ad4f4f21d34c.jpg"]
    assert column(spark, ["n"], names.unique_filename(v, F.lit("u"), F.lit(True), ".jpg")) == [
        "n_7b774effe4a349c6dd82ad4f4f21d34c.jpg"]


def test_predicates(spark):
    v = F.col("v")
    page = "<p>Try another search term</p>"
    assert column(spark, [page, "Try another search term", "<p>Try another search terms</p>", None],
                  predicates.has_text_node(v)) == [True, True, False, False]
    classes = ["a b", "b a", "ab", None, "a"]
    assert column(spark, classes, predicates.class_matches(v, "a")) == [True, True, False, False, True]
    assert column(spark, classes, predicates.class_matches(v, "a b")) == [True, False, False, False, False]
    assert column(spark, ["http://x", "/x", None, "data:x"], predicates.valid_media_url(v)) == [True, False, False, False]
    assert column(spark, [" Get it ", "Get it!"], predicates.trimmed_text_equals(v, "Get it")) == [True, False]


@pytest.mark.parametrize("total,pages", [(0, 0), (1, 1), (100, 1), (101, 2), (5000, 10)])
def test_page_count(spark, total, pages):
    assert column(spark, [total], retry.page_count(F.col("v")), kind="bigint") == [pages]


def test_backoff(spark):
    assert column(spark, [0, 1, 4], retry.backoff_seconds(F.col("v")), kind="int") == [1.0, 2.0, 16.0]
    first = column(spark, ["a", "b"], retry.jitter_seconds(F.col("v")))
    assert first == column(spark, ["a", "b"], retry.jitter_seconds(F.col("v"))) and all(0 <= j <= 1 for j in first)
    assert column(spark, [403, 500, None], retry.pause_after(F.col("v")), kind="int") == [300.0, 2.0, 2.0]
