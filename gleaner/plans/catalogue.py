"""Landed search responses -> repository catalogue."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gleaner.functions.predicates import repo_in_range
from gleaner.operators.dedup import first_seen
from gleaner.operators.joins import size_windows
from gleaner.operators.numbering import first_rows


def repo_catalogue(repos: DataFrame, low: int = 0, high: int = 100, step: int = 10,
                   min_stars: int = 100) -> DataFrame:
    """Distinct ``name, stars, lang`` that match the search, with their size window.

    ``repos`` holds ``name, stars, size, lang, pos``; the first position of a
    repeated repository is kept.
    """
    matching = repos.filter(repo_in_range(F.col("size"), F.col("stars"), low, high, min_stars))
    windowed = size_windows(matching, F.col("size"), low, high, step)
    slim = windowed.select("name", "stars", "lang", "window_low", "pos")
    return first_seen(slim, ["name", "stars", "lang"], ["window_low", "pos"])


def top_of_catalogue(catalogue: DataFrame, n: int = 10) -> DataFrame:
    """The first ``n`` repositories in the order of the search."""
    return first_rows(catalogue, ["window_low", "pos", "name"], n).select("name", "stars", "lang")
