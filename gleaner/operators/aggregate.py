"""Statistics and nested documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from gleaner.operators.numbering import int_div, number_rows


def folder_stats(objects: DataFrame, folder: str = "folder", size: str = "size") -> DataFrame:
    """Number of objects and their total size per folder."""
    return objects.groupBy(folder).agg(
        F.count(F.lit(1)).alias("total_count"),
        F.sum(size).alias("total_size"))


def numbered_lists(df: DataFrame, group: Sequence[str], order: Sequence[str], item: Column, *,
                   size: int = 1000, out: str = "items") -> DataFrame:
    """Items per group as ordered arrays of at most ``size`` elements (``chunk`` 0, 1, ...).

    A group of any size stays whole: it has more chunks, not a longer array.
    """
    numbered = number_rows(df.withColumn("_item", item), group, order, "_rank")
    chunked = numbered.withColumn("chunk", int_div(F.col("_rank"), size))
    lists = chunked.groupBy(*group, "chunk").agg(
        F.array_sort(F.collect_list(F.struct("_rank", "_item"))).alias("_list"))
    return lists.withColumn(out, F.transform("_list", lambda x: x["_item"])).drop("_list")


def item_summary(links: DataFrame, item: Sequence[str], status: str = "status", size: str = "size",
                 ts: str = "ts") -> DataFrame:
    """Per item: links, successes, failures, stored bytes, first and last time.

    ``links`` has one row per link with its latest status. The link lists
    themselves come from :func:`link_lists`, which keeps them bounded.
    """
    ok = F.col(status) == "success"
    return links.groupBy(*item).agg(
        F.count(F.lit(1)).alias("total_links"),
        F.count_if(ok).alias("total_files"),
        F.count_if(F.col(status) == "failed").alias("failed_files"),
        F.coalesce(F.sum(F.when(ok, F.col(size))), F.lit(0)).alias("folder_size"),
        F.min(ts).alias("start_time"),
        F.max(ts).alias("end_time"))


def link_lists(links: DataFrame, item: Sequence[str], order: Sequence[str], link: str, *,
               size: int = 1000) -> DataFrame:
    """``download_links`` and ``failed_links`` per item in arrays of at most ``size`` links."""
    pair = F.struct(F.col(link).alias("link"), (F.col("status") == "failed").alias("failed"))
    lists = numbered_lists(links, item, order, pair, size=size, out="_l")
    return lists.withColumns({
        "download_links": F.transform("_l", lambda x: x["link"]),
        "failed_links": F.transform(F.filter("_l", lambda x: x["failed"]), lambda x: x["link"]),
    }).drop("_l")


def folder_documents(media: DataFrame, folder: Sequence[str], order: Sequence[str],
                     fields: Sequence[str], *, size: int = 1000, out: str = "images") -> DataFrame:
    """Media records nested under their folder, in order, ``size`` per document."""
    record = F.struct(*fields)
    return numbered_lists(media, folder, order, record, size=size, out=out)


def keyword_documents(media: DataFrame, keyword: Sequence[str], order: Sequence[str],
                      link: str, alt: str, *, size: int = 1000) -> DataFrame:
    """Parallel arrays ``links`` and ``alts`` per keyword, first seen first."""
    pair = F.struct(F.col(link).alias("link"), F.col(alt).alias("alt"))
    docs = numbered_lists(media, keyword, order, pair, size=size, out="_l")
    return docs.withColumns({
        "links": F.transform("_l", lambda x: x["link"]),
        "alts": F.transform("_l", lambda x: x["alt"]),
    }).drop("_l")


def progress_counts(log: DataFrame, group: Sequence[str], status: Column) -> DataFrame:
    """Total, done, failed and open items per group."""
    return log.groupBy(*group).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(status == "completed").alias("done"),
        F.count_if(status == "failed").alias("failed"),
        F.count_if(status == "started").alias("open"))


def partition_plan(df: DataFrame, group: Sequence[str], rows_per_partition: int = 800_000) -> DataFrame:
    """Rows and the number of output partitions for them.

    For reports and writers that need a number of files; shuffles are sized
    by adaptive execution.
    """
    return df.groupBy(*group).agg(F.count(F.lit(1)).alias("total_rows")).withColumn(
        "partitions", int_div(F.col("total_rows"), rows_per_partition) + 1)
