"""Landed result pages of search terms -> new images with names, keys and upload batches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from gleaner.functions.names import sanitize_filename, unique_filename
from gleaner.functions.predicates import has_text_node
from gleaner.operators.dedup import first_seen
from gleaner.operators.extract import linked_images, page_signature
from gleaner.operators.numbering import stop_at_repeat, upload_batches
from gleaner.operators.skew import same
from gleaner.session import stage


def keyword_images(pages: DataFrame, term: str, page_no: str, wanted_class: str, no_results: str) -> DataFrame:
    """``term, page_no, pos, media_url, alt``: each linked thumbnail of a term once, where it is first seen.

    ``pages`` holds ``term, page_no, url, html`` and is parsed once. A term
    ends before the first page that says ``no_results``, shows no image or
    repeats the page before it.
    """
    found = pages.select(
        term, page_no, "html", linked_images(F.col("html"), wanted_class, F.col("url")).alias("_linked"),
        has_text_node(F.col("html"), no_results).alias("_none"))
    parsed = stage(page_signature(found).withColumn(
        "n_images", F.when(F.col("_none"), F.lit(0)).otherwise(F.col("n_images"))), "result-pages")
    shown = stop_at_repeat(parsed, [term], [page_no], "signature", "n_images")
    images = shown.select(term, page_no, F.posexplode("_linked").alias("pos", "_i")).select(
        term, page_no, "pos", "_i.media_url", "_i.alt")
    return first_seen(images, [term, "media_url"], [page_no, "pos"])


def keyword_harvest(images: DataFrame, term: str, page_no: str, batch: int = 100, extension: str = ".jpg",
                    clean: Callable[[Column], Column] = sanitize_filename) -> DataFrame:
    """Images of :func:`keyword_images` with ``file_name``, unique in the term, and ``batch``.

    Where several images of a term have the same clean name, each name gets
    the digest of its URL.
    """
    named = images.withColumn("_clean", clean(F.coalesce("alt", F.lit(""))))
    shared = (named.groupBy(term, "_clean").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1)
              .select(F.col(term).alias(f"_of_{term}"), F.col("_clean").alias("_of__clean"), F.lit(True).alias("_twice")))
    joined = named.join(shared, same(named, shared, [term, "_clean"], "_of_"), "left")
    name = unique_filename(F.col("_clean"), F.col("media_url"), F.col("_twice").isNotNull(), extension)
    records = joined.withColumn("file_name", name).select(*images.columns, "file_name")
    return upload_batches(records, [term], [page_no, "pos"], batch)
