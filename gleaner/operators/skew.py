"""Joins in which one key may hold a large share of all rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

NULL_PARTS = 1024    # parts over which rows with a null key are spread


def same(left: DataFrame, right: DataFrame, names: Sequence[str], prefix: str = "") -> Column:
    """Null-safe equality of columns ``names`` (left) and ``prefix + names`` (right)."""
    return reduce(lambda a, b: a & b, [left[n].eqNullSafe(right[prefix + n]) for n in names])


def _has_map(kind: T.DataType) -> bool:
    parts = [f.dataType for f in kind.fields] if isinstance(kind, T.StructType) else [
        getattr(kind, "elementType", None)] if isinstance(kind, T.ArrayType) else []
    return isinstance(kind, (T.MapType, T.VariantType)) or any(map(_has_map, parts))


def spread(df: DataFrame, parts: int) -> Column:
    """A part of each row by a hash of its columns; those that hold maps have none and are left out."""
    columns = [F.col(f"`{f.name}`") for f in df.schema.fields if not _has_map(f.dataType)]
    return F.pmod(F.xxhash64(*columns), F.lit(parts)) if columns else F.lit(0).cast("bigint")


def left_join(left: DataFrame, right: DataFrame, on: str, how: str = "left") -> DataFrame:
    """Left, semi or anti join on one column whose left side may have hot keys, null among them.

    Adaptive execution splits the partition of a hot key. Rows with a null
    key have no partner; a second key spreads them, so they share no task.
    """
    part = F.when(F.col(on).isNull(), spread(left, NULL_PARTS)).otherwise(F.lit(-1))
    dealt = left.withColumn("_part", part)
    return dealt.join(right.withColumn("_part", F.lit(-1).cast("bigint")), [on, "_part"], how).drop("_part")
