"""Item pages -> document links -> status per link -> item documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gleaner.functions.predicates import anchor_text_contains
from gleaner.functions.urls import item_name, object_key, prefix_always, url_filename
from gleaner.operators.aggregate import item_summary
from gleaner.operators.extract import extract_links
from gleaner.operators.ledger import latest_status


def item_links(pages: DataFrame, base: str, prefix: str, word: str = "PDF") -> DataFrame:
    """Wanted links of each item page with item name, absolute URL, file name and key."""
    links = extract_links(pages).filter(anchor_text_contains(F.col("text"), word))
    named = links.withColumns({
        "item": item_name(F.col("url")),
        "doc_url": prefix_always(F.lit(base), F.col("href")),
        "file_name": url_filename(F.col("href")),
    })
    return named.withColumn("key", object_key(F.lit(prefix), F.col("item"), F.col("file_name")))


def item_documents(status_log: DataFrame, item: str, link: str) -> DataFrame:
    """Item summary from the status log: one status per link, the last one."""
    return item_summary(latest_status(status_log, [item, link], ["ts", "seq"]), [item])
