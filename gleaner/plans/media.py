"""Landed pages -> media records with names and keys -> folder documents and statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from gleaner.functions.names import alt_token, md5_name, media_name
from gleaner.functions.predicates import valid_media_url
from gleaner.functions.urls import object_key
from gleaner.operators.dedup import first_seen
from gleaner.operators.extract import extract_images, extract_videos
from gleaner.operators.numbering import cap_per_group, number_rows


def media_candidates(pages: DataFrame, kind: str = "image", wanted_class: str | None = None) -> DataFrame:
    """Media with an absolute URL, in page order: ``page_id, pos, media_url, alt`` and page columns."""
    found = extract_images(pages, wanted_class) if kind == "image" else extract_videos(pages, wanted_class)
    return found.filter(valid_media_url(F.col("media_url"))).drop("src", "data_src", "class")


def media_records(candidates: DataFrame, folder: str, prefix: str, order: Sequence[str] = ("page_id", "pos"), *,
                  kind: str = "image", extension: str = ".jpg",
                  cap: int | None = None, by_digest: bool = False) -> DataFrame:
    """One record per folder and URL: ``number, media_name, object_key``, numbered from 0 in page order."""
    unique = first_seen(candidates, [folder, "media_url"], list(order))
    if cap:
        # At most `cap` rows of a folder are left, so a plain window will do.
        capped = cap_per_group(unique, [folder], list(order), cap)
        number = F.row_number().over(Window.partitionBy(folder).orderBy(*order)).cast("bigint") - 1
        numbered = capped.withColumn("number", number)
    else:
        numbered = number_rows(unique, [folder], list(order), "number")
    if by_digest:
        name = md5_name(F.col("number") + 1, F.col("media_url"), kind, extension)
    else:
        name = media_name(F.col("number"), alt_token(F.col("alt")), kind, extension)
    named = numbered.withColumn("media_name", name)
    return named.withColumn("object_key", object_key(F.lit(prefix), F.col(folder), F.col("media_name")))


def folder_totals(records: DataFrame, objects: DataFrame, folder: str) -> DataFrame:
    """Records and stored bytes per folder; ``objects`` holds ``key, size``."""
    sizes = objects.select(F.col("key").alias("object_key"), "size")
    return records.join(sizes, "object_key", "left").groupBy(folder).agg(
        F.count(F.lit(1)).alias("total_images"),
        F.coalesce(F.sum("size"), F.lit(0)).alias("total_size"))
