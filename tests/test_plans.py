"""Physical plans: what must be there, and what must not."""

import pytest

import __spark_entry__  # noqa: F401  (registration)
from checks.registry import QUERIES
# Queries whose operator is Python on Arrow batches by design.
ARROW = {"scan_batched", "decode_blob", "decode_or_empty", "scan_blobs", "extract_links_scoped", "bundle_groups",
         "list_objects", "fetch_blobs", "read_large_csv"}
STREAMS = {n for n in QUERIES if n.startswith("stream_")}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - STREAMS))
def test_no_cross_join_and_no_row_udf(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "BatchEvalPython" not in text
    if name not in ARROW:
        assert "ArrowEvalPython" not in text and "InPandas" not in text and "InArrow" not in text


def test_cap_is_pushed_below_the_shuffle(spark, sf_dir):
    text = plan(QUERIES["cap_per_group"](spark, sf_dir))
    assert text.count("WindowGroupLimit") >= 4 and "Partial" in text


@pytest.mark.parametrize("name", ["todo_by_basename", "todo_by_key"])
def test_skip_is_an_anti_join(spark, sf_dir, name):
    assert "LeftAnti" in plan(QUERIES[name](spark, sf_dir))


@pytest.mark.parametrize("name", ["size_windows", "extract_links", "extract_images", "page_signature", "seed_pages", "anchor_text_equals",
                                  "byte_ranges"])
def test_row_work_does_not_shuffle(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir)).split("Initial Plan")[0]
    if name == "byte_ranges":  # its listings are joined, the ranges are not
        text = text.split("Generate explode")[0]
    assert "Exchange" not in text


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    text = plan(QUERIES["repo_filter"](spark, sf_dir))
    assert "p_size" in text.split("PushedFilters: [")[1].split("]")[0]
    text = plan(QUERIES["folder_stats"](spark, sf_dir))
    assert "ReadSchema: struct<l_suppkey:bigint,l_quantity:double>" in text


def test_joins_read_their_input_once(spark, sf_dir):
    text = plan(QUERIES["cap_per_group"](spark, sf_dir))
    assert text.count("Scan parquet") == 1
    text = plan(QUERIES["content_enrichment"](spark, sf_dir))
    assert text.count("Scan parquet") <= 4
