"""Page counts, waiting times and time stamps."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed values of the request rules.
PAGE_SIZE = 100
MAX_QUERY_PAGES = 10
PAUSE_FIXED = 2.0
PAUSE_FORBIDDEN = 300.0
MILLIS = 1000            # most milliseconds of jitter


def page_count(total: Column, page_size: int = PAGE_SIZE, most: int = MAX_QUERY_PAGES) -> Column:
    """Result pages to ask for: ``min(ceil(total / page_size), most)``."""
    pages = F.ceil(total / F.lit(page_size))
    return F.least(pages, F.lit(most).cast("bigint"))


def backoff_seconds(attempt: Column) -> Column:
    """Exponential base: ``2 ** attempt`` seconds, attempts counted from 0."""
    return F.pow(F.lit(2.0), attempt)


def jitter_seconds(*seed: Column) -> Column:
    """0 to 1 second in steps of a millisecond, the same on every re-run, from digits of an MD5."""
    digits = F.substring(F.md5(F.concat_ws("|", *[s.cast("string") for s in seed])), 1, 6)
    return F.pmod(F.conv(digits, 16, 10).cast("bigint"), F.lit(MILLIS + 1)) / F.lit(1000.0)


def pause_after(http_status: Column) -> Column:
    """Fixed pause of the simple retry loop: long after a 403, short otherwise."""
    return F.when(http_status == 403, F.lit(PAUSE_FORBIDDEN)).otherwise(F.lit(PAUSE_FIXED))


def stamp() -> Column:
    """Event time at write; one value per query."""
    return F.current_timestamp()
