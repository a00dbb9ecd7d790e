"""Row predicates. Each is a boolean column that Catalyst can push down or fuse."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def has_suffix(name: Column, *suffixes: str) -> Column:
    """True where the name ends with one of the suffixes."""
    tests = [name.endswith(s) for s in suffixes]
    out = tests[0]
    for t in tests[1:]:
        out = out | t
    return out


def lacks(name: Column, marker: str) -> Column:
    return ~name.contains(marker)


def valid_media_url(url: Column) -> Column:
    """Absolute http(s) URL; null counts as invalid, never as unknown."""
    return F.coalesce(url.startswith("http"), F.lit(False))


def anchor_text_contains(text: Column, word: str = "PDF") -> Column:
    return F.coalesce(text.contains(word), F.lit(False))


def href_contains(href: Column, part: str = ".pdf") -> Column:
    return F.coalesce(href.contains(part), F.lit(False))


def class_matches(class_attr: Column, wanted: str) -> Column:
    """A single class matches any token; several classes match the whole attribute."""
    if " " in wanted:
        return F.coalesce(class_attr == wanted, F.lit(False))
    return F.coalesce(F.array_contains(F.split(class_attr, r"\s+"), wanted), F.lit(False))


def has_text_node(html: Column, sentence: str = "Try another search term") -> Column:
    """True where an HTML text node starts and ends with exactly this sentence."""
    return F.coalesce(html.rlike(rf"(^|>)\Q{sentence}\E(<|$)"), F.lit(False))


def repo_in_range(size: Column, stars: Column, low: int, high: int, min_stars: int = 100) -> Column:
    """Repository search condition: size within ``low..high`` and stars above ``min_stars``."""
    return size.between(low, high) & (stars > min_stars)


def trimmed_text_equals(text: Column, wanted: str) -> Column:
    return F.coalesce(F.trim(text) == wanted, F.lit(False))
