"""Joins that plan work: enrich, skip what is done, resume, ranges, windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from gleaner.functions.text import word_count
from gleaner.operators.skew import left_join


def join_content(metadata: DataFrame, content: DataFrame, on: str = "blob_id", *,
                 content_unique: bool = False) -> DataFrame:
    """Every metadata row once, with its ``text``, ``word_count`` and ``status``.

    ``content`` holds ``on, text``; of several texts of an id that with the
    smallest SHA-256 counts. ``content_unique`` says it holds an id once
    already and saves the grouping. A blob that a large share of the rows
    refer to is split by adaptive execution, and rows without an id are spread
    over tasks. Words are counted after the join, so only in texts that are
    asked for.
    """
    content = content.select(on, "text")
    if not content_unique:
        content = content.groupBy(on).agg(F.min_by("text", F.sha2("text", 256)).alias("text"))
    joined = left_join(metadata, content, on)
    return joined.withColumns({
        "status": F.when(F.col("text").isNull(), "missing").otherwise("ok"),
        "text": F.coalesce("text", F.lit("")),
        "word_count": F.coalesce(word_count(F.col("text")), F.lit(0)),
    })


def todo_by_basename(keys: DataFrame, done: DataFrame, key: Column, done_key: Column) -> DataFrame:
    """Rows whose file name is not among the processed ones, whatever the folder.

    The rows are narrow, so a name that occurs in very many folders is left to
    the skew handling of adaptive execution.
    """
    names = done.select(F.substring_index(done_key, "/", -1).alias("_name")).distinct()
    named = keys.withColumn("_name", F.substring_index(key, "/", -1))
    return left_join(named, names, "_name", "left_anti").drop("_name")


def todo_by_key(keys: DataFrame, done: DataFrame, on: str = "key") -> DataFrame:
    """Rows whose target key does not exist. Listings hold a key once, so no key is hot."""
    return keys.join(done.select(on), on, "left_anti")


def already_done(keys: DataFrame, done: DataFrame, on: str = "key") -> DataFrame:
    """Rows whose target key exists."""
    return keys.join(done.select(on), on, "left_semi")


def skip_report(keys: DataFrame, done: DataFrame, group: Sequence[str], on: str = "key") -> DataFrame:
    """``n_all, n_done, n_todo`` per group in one pass."""
    marks = done.select(on).distinct().withColumn("_done", F.lit(True))
    return (keys.join(marks, on, "left").groupBy(*group).agg(
        F.count(F.lit(1)).alias("n_all"),
        F.count_if(F.col("_done").isNotNull()).alias("n_done"),
        F.count_if(F.col("_done").isNull()).alias("n_todo")))


def resume_plan(source: DataFrame, target: DataFrame, on: str = "key") -> DataFrame:
    """``start_at`` and ``state`` per source object, from the sizes in two listings.

    ``source`` and ``target`` hold ``key, size``. Without a target an object is
    new, an empty one too. Equal sizes are done; a
    shorter target goes on at its size; a longer one starts again.
    """
    have = target.select(on, F.col("size").alias("_have"))
    have_size = F.coalesce(F.col("_have"), F.lit(0))
    return (source.join(have, on, "left").withColumns({
        "state": F.when(F.col("_have").isNull(), "new")
        .when(have_size == F.col("size"), "done")
        .when(have_size < F.col("size"), "resume").otherwise("restart"),
        "start_at": F.when(have_size > F.col("size"), F.lit(0)).otherwise(have_size),
    }).drop("_have"))


def byte_ranges(plan: DataFrame, step: int = 1 << 20) -> DataFrame:
    """One row per range ``range_start..range_end`` (inclusive) still to fetch."""
    pending = plan.filter(F.col("start_at") < F.col("size"))
    return pending.withColumn(
        "range_start", F.explode(F.sequence(F.col("start_at"), F.col("size") - 1, F.lit(step).cast("bigint")))
    ).withColumn("range_end", F.least(F.col("range_start") + F.lit(step - 1), F.col("size") - 1))


def size_window(size: Column, low: int = 0, high: int = 100, step: int = 10) -> dict[str, Column]:
    """``window_low, window_high`` of a size; null outside ``low..high``.

    Windows are ``low..low+step``, then the next ``step + 1`` values, and so
    on; the last one ends at ``high`` and holds two values at least. The
    window follows from the size, so the range join needs no shuffle.
    """
    width = step + 1
    start = size - F.pmod(size - F.lit(low), F.lit(width))
    end = F.greatest(start + 1, F.least(F.lit(high), start + step))
    # A window that would open at `high` itself is never asked for.
    inside = (size >= low) & (start < high) & (size <= end)
    return {"window_low": F.when(inside, start), "window_high": F.when(inside, end)}


def size_windows(df: DataFrame, size: Column, low: int = 0, high: int = 100, step: int = 10) -> DataFrame:
    """Rows that fall into a size window, with the window."""
    return df.withColumns(size_window(size, low, high, step)).filter(F.col("window_low").isNotNull())


def seed_pages(seeds: DataFrame, pages: int | Column, out: str = "page_no") -> DataFrame:
    """Every seed with page numbers 1 to ``pages``; a generator, not a join."""
    last = F.lit(pages) if isinstance(pages, int) else pages
    return seeds.withColumn(out, F.explode(
        F.when(last >= 1, F.sequence(F.lit(1).cast("bigint"), last.cast("bigint")))))


def seed_sources(seeds: DataFrame, sources: Sequence[str], out: str = "source") -> DataFrame:
    """Every seed with every name of a short, fixed list."""
    return seeds.withColumn(out, F.explode(F.array(*[F.lit(s) for s in sources])))


def failed_links(links: DataFrame, status: DataFrame, on: Sequence[str]) -> DataFrame:
    """Links whose latest status is ``failed``. ``status`` holds one row per link."""
    failed = status.filter(F.col("status") == "failed").select(*on)
    return links.join(failed, list(on), "left_semi")
