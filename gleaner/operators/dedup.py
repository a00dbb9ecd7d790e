"""Duplicate removal and collision reports. All aggregate on the map side first."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.distinct()


def first_seen(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row per key in ``order``; other columns come from that row.

    A partial minimum per map task reduces a hot key before the shuffle.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    best = df.groupBy(*keys).agg(F.min(F.struct(*order, *rest)).alias("_first"))
    return best.select(*[F.col(k) if k in keys else F.col("_first")[k].alias(k) for k in df.columns])


def dedup_seeds(df: DataFrame, term: Column, position: Column) -> DataFrame:
    """One row per trimmed search term, at its first position."""
    return df.groupBy(F.trim(term).alias("term")).agg(F.min(position).alias("position"))


def union_chunks(*chunks: DataFrame) -> DataFrame:
    """Append results by column name; columns a chunk lacks are null."""
    out = chunks[0]
    for chunk in chunks[1:]:
        out = out.unionByName(chunk, allowMissingColumns=True)
    return out


def key_collisions(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that more than one row would write to, with the number of rows."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
            .filter(F.col("n_rows") > 1))
