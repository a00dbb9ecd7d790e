"""Ordered numbering, caps, batches and look-back, without one task per group.

A window over a whole group puts that group into one task. Here the table is
range-partitioned by group and order, so a large group is cut into pieces,
and every task numbers its piece in one pass. The pieces are written to the
shared folder; a group that goes on in the next piece takes its total along,
which is one row per piece. There is one path for all groups and sizes, and
one exchange of the table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from gleaner.operators.skew import same, spread
from gleaner.session import stage

FAN_IN = 64      # parts in which a group is capped before its rows meet


def int_div(number: Column, width) -> Column:
    """Exact integer quotient of a non-negative number."""
    return F.call_function("div", number, F.lit(width) if isinstance(width, int) else width)


def _sort_columns(group: Sequence[str], order: Sequence) -> list:
    return [F.col(g) if isinstance(g, str) else g for g in (*group, *order)]


def _ordered(df: DataFrame, group: Sequence[str], order: Sequence, value: Column) -> DataFrame:
    """``df`` cut into pieces and sorted, with ``_g`` (the group), ``_v`` and ``_piece``."""
    by = _sort_columns(group, order)
    # The hash passes over nulls; with a flag beside each column (null, a) and (a, null) are two groups.
    flagged = [c for g in group for c in (F.col(g), F.col(g).isNull())]
    marked = df.withColumns({"_g": F.xxhash64(*flagged) if group else F.lit(0).cast("bigint"), "_v": value})
    return (marked.repartitionByRange(*by).sortWithinPartitions(*by)
            .withColumn("_piece", F.spark_partition_id()))


def _groups(batch, held):
    """Starts of groups in a batch, with whether the first row goes on with the group of the batch before."""
    import numpy as np

    g = batch.column("_g").to_numpy()
    new = np.empty(len(g), dtype=bool)
    new[0] = held is None or g[0] != held
    np.not_equal(g[1:], g[:-1], out=new[1:])
    return g, new


def _append(batch, **columns):
    import pyarrow as pa

    return pa.RecordBatch.from_arrays([*batch.columns, *columns.values()], [*batch.schema.names, *columns])


def _count(batches):
    """``_n``: sum of ``_v`` before the row in its group and piece; ``_lead``: in the first group of the piece."""
    import decimal

    import numpy as np
    import pyarrow as pa

    decimal.getcontext().prec = 38
    held, total, groups, place = None, 0, 0, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        kind = batch.schema.field("_v").type
        v = batch.column("_v").to_numpy(zero_copy_only=False)
        g, new = _groups(batch, held)
        before = np.cumsum(v) - v
        first = np.flatnonzero(new)
        number = np.cumsum(new)                       # 0: goes on with the group of the batch before
        start = np.concatenate(([-total], before[first]))
        n = before - start[number]
        yield _append(batch, _n=pa.array(n, kind), _lead=pa.array(groups + number <= 1),
                      _place=pa.array(np.arange(place, place + len(g))))
        held, total, groups, place = g[-1], n[-1] + v[-1], groups + int(number[-1]), place + len(g)


def _previous(batches):
    """``_prev``: ``_v`` of the row before in its group and piece."""
    import numpy as np
    import pyarrow as pa

    held, last, place = None, None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        g, new = _groups(batch, held)
        column = batch.column("_v")
        rows = pa.concat_arrays([pa.nulls(1, column.type) if last is None else last, column])
        at = pa.array(np.arange(len(g)), mask=new)
        yield _append(batch, _prev=rows.take(at), _place=pa.array(np.arange(place, place + len(g))))
        held, last, place = g[-1], column.slice(len(g) - 1, 1), place + len(g)


def _plus(df: DataFrame, **fields: str) -> T.StructType:
    schema = T.StructType(list(df.schema.fields))
    for name, kind in fields.items():
        schema.add(name, kind)
    return schema


def running_total(df: DataFrame, group: Sequence[str], order: Sequence, value: Column, out: str, *,
                  total: str | None = None) -> DataFrame:
    """Add ``out``: the sum of ``value`` over the rows before this one in its group.

    ``order`` must name each row of a group uniquely; columns may be
    descending. ``value`` is a whole number, a decimal or a double, null
    counts as 0. Whole numbers add up to a long, decimals to one of 38 digits.
    ``total`` adds the sum of the whole group under that name. An empty
    ``group`` orders the table. Null groups are groups, null orders sort as
    they do in Spark.
    """
    given = df.select(value.alias("v")).schema["v"].dataType
    kind = ("double" if isinstance(given, (T.DoubleType, T.FloatType))
            else f"decimal(38,{given.scale})" if isinstance(given, T.DecimalType) else "bigint")
    cut = _ordered(df, group, order, F.coalesce(value.cast(kind), F.lit(0).cast(kind)))
    local = stage(cut.mapInArrow(_count, _plus(cut, _n="long" if kind == "bigint" else kind, _lead="boolean", _place="long")), "numbered")
    pieces = local.groupBy("_piece").agg(
        F.max(F.when(F.col("_lead"), F.col("_g"))).alias("_first"),
        F.max_by(F.struct("_g", (F.col("_n") + F.col("_v")).cast(kind).alias("_sum")), F.col("_place")).alias("_last"))
    # One row per piece; a group's pieces follow each other.
    running = F.sum("_last._sum").over(Window.partitionBy("_last._g").orderBy("_piece")).cast(kind)
    before = Window.orderBy("_piece")
    carried = pieces.withColumn("_so_far", running).select(
        "_piece", F.when(F.lag("_last._g").over(before) == F.col("_first"), F.lag("_so_far").over(before)).alias("_carry"))
    # Safe broadcast: one row per partition of the exchange.
    joined = local.join(F.broadcast(carried), "_piece")
    result = joined.withColumn(out, (F.col("_n") + F.coalesce(F.when(F.col("_lead"), F.col("_carry")), F.lit(0).cast(kind))).cast(kind))
    if total is not None:
        sums = local.groupBy(*group, "_g").agg(F.sum("_v").cast(kind).alias(total)).withColumnsRenamed(
            {c: f"_of_{c}" for c in (*group, "_g")})
        # Without groups this is one row.
        result = result.join(sums if group else F.broadcast(sums), same(result, sums, [*group, "_g"], "_of_"))
    return result.select(*[c for c in df.columns if c not in (out, total)], out, *([total] if total else []))


def number_rows(df: DataFrame, group: Sequence[str], order: Sequence, out: str = "number", *,
                start: int = 0, total: str | None = None) -> DataFrame:
    """Dense number per group in the given order, counted from ``start``."""
    numbered = running_total(df, group, order, F.lit(1).cast("bigint"), out, total=total)
    return numbered.withColumn(out, F.col(out) + F.lit(start)) if start else numbered


def _first_of(df: DataFrame, keys: Sequence[str], order: Sequence, limit: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") <= limit).drop("_rank")


def cap_per_group(df: DataFrame, group: Sequence[str], order: Sequence, limit: int | None) -> DataFrame:
    """First ``limit`` rows of each group; ``None`` or 0 keeps all. ``df`` is read once.

    Each map task keeps at most ``limit`` rows of a group before the shuffle
    (window group limit). What many tasks keep of a large group is capped in
    ``FAN_IN`` parts before it meets in one.
    """
    if not limit:
        return df
    parts = df.withColumn("_part", spread(df, FAN_IN))
    return _first_of(_first_of(parts, [*group, "_part"], order, limit).drop("_part"), group, order, limit)


def upload_batches(df: DataFrame, group: Sequence[str], order: Sequence, size: int = 100,
                   out: str = "batch") -> DataFrame:
    """Batch number per group: every ``size`` rows, the last batch may be short."""
    numbered = number_rows(df, group, order, "_rank")
    return numbered.withColumn(out, int_div(F.col("_rank"), size)).drop("_rank")


def rate_budget(df: DataFrame, order: Sequence, start: Column, requests: int = 30,
                pause_seconds: int = 60) -> DataFrame:
    """Requests in order get ``slot`` and ``not_before``: ``requests`` per slot, then a pause."""
    numbered = number_rows(df, [], order, "_rank")
    slot = int_div(F.col("_rank"), requests)
    return numbered.withColumns({
        "slot": slot,
        "not_before": start + F.make_dt_interval(secs=slot * F.lit(pause_seconds)),
    }).drop("_rank")


def work_chunks(df: DataFrame, order: Sequence, chunks: int, out: str = "chunk") -> DataFrame:
    """Cut the ordered table into ``chunks`` even parts, numbered from 1; each row in exactly one."""
    numbered = number_rows(df, [], order, "_rank", total="_all")
    small = int_div(F.col("_all"), chunks)
    larger = F.col("_all") % F.lit(chunks)          # so many chunks have one row more
    border = larger * (small + 1)
    chunk = F.when(F.col("_rank") < border, int_div(F.col("_rank"), small + 1)).otherwise(
        larger + int_div(F.col("_rank") - border, F.greatest(small, F.lit(1))))
    return numbered.withColumn(out, (chunk + 1).cast("bigint")).drop("_rank", "_all")


def previous_value(df: DataFrame, group: Sequence[str], order: Sequence, value: str, out: str) -> DataFrame:
    """Add ``out``: ``value`` of the row before this one in its group.

    Inside a piece this is the row before; the first row of a piece takes the
    last value of the piece before, if the group is the same.
    """
    kind = df.schema[value].dataType
    cut = _ordered(df, group, order, F.col(value))
    local = stage(cut.mapInArrow(_previous, _plus(cut, _prev=kind, _place="long")), "previous")
    last = local.groupBy("_piece").agg(F.max_by(F.struct("_g", "_v"), F.col("_place")).alias("_last"))
    # One row per piece.
    carried = last.select("_piece", F.lag("_last").over(Window.orderBy("_piece")).alias("_carry"))
    joined = local.join(F.broadcast(carried), "_piece")
    goes_on = (F.col("_place") == 0) & (F.col("_carry._g") == F.col("_g"))
    result = joined.withColumn(out, F.when(goes_on, F.col("_carry._v")).otherwise(F.col("_prev")))
    return result.select(*[c for c in df.columns if c != out], out)


def stop_at_repeat(df: DataFrame, group: Sequence[str], order: Sequence[str], signature: str,
                   items: str) -> DataFrame:
    """Pages of each group before the first one that is empty or repeats its predecessor."""
    pages = previous_value(df, group, order, signature, "_before")
    stop = F.coalesce((F.col(items) == 0) | (F.col(signature) == F.col("_before")), F.lit(False))
    # One row per group, reduced before the shuffle.
    ends = (pages.filter(stop).groupBy(*group).agg(F.min(F.struct(*order)).alias("_end"))
            .withColumnsRenamed({g: f"_of_{g}" for g in group}))
    if group:
        joined = pages.join(ends, same(pages, ends, group, "_of_"), "left")
    else:
        joined = pages.withColumn("_one", F.lit(1)).join(F.broadcast(ends.withColumn("_one", F.lit(1))), "_one", "left")
    kept = joined.filter(F.col("_end").isNull() | (F.struct(*order) < F.col("_end")))
    return kept.select(*df.columns)


def sorted_keys(df: DataFrame, *order) -> DataFrame:
    """Rows in key order, range-partitioned (no single sorting task)."""
    return df.orderBy(*order)


def _ranges(df: DataFrame, order: Sequence[str], n: int) -> Column:
    """Number of the key range, 0 to ``n`` at most, of a row; ranges are cut at ``n`` keys picked by a hash."""
    key = F.struct(*order)
    picked = df.select(key.alias("k")).orderBy(F.xxhash64("k"), "k").limit(n).distinct().orderBy("k").collect()
    kinds = [df.schema[c].dataType for c in order]
    above = [key >= F.struct(*[F.lit(v).cast(t).alias(c) for v, t, c in zip(r["k"], kinds, order)]) for r in picked]
    return sum((x.cast("int") for x in above), F.lit(0))


def key_slice(df: DataFrame, order: Sequence, start: int, stop: int, *, ranges: int = 64, small: int = 100_000) -> DataFrame:
    """Rows ``start`` to ``stop - 1`` of the ordered table.

    Rows are counted per key range, then only ranges that hold the slice are looked at, again in ranges until ``small``
    rows are left; these are sorted. The table is read some times and neither shuffled nor written. A slice that is
    larger, or all of whose rows share a key, is numbered, and with it only the ranges it lies in. An order with columns
    other than plain ascending ones numbers the table.
    """
    rest, first = df, 0
    while start < stop and all(isinstance(c, str) for c in order):
        number = _ranges(rest, order, ranges)
        # One row per range.
        counts = sorted((r["r"], r["n"]) for r in rest.groupBy(number.alias("r")).agg(F.count(F.lit(1)).alias("n")).collect())
        held, before = [], first
        for r, n in counts:
            if before < stop and before + n > start:
                if not held:
                    first = before
                held.append((r, n))
            before += n
        if not held:
            return df.limit(0)
        left = sum(n for _, n in held)
        narrower = len(held) < len(counts)
        rest = rest.filter(number.between(held[0][0], held[-1][0])) if narrower else rest
        if left <= small:
            return rest.orderBy(*order).limit(stop - first).offset(start - first)
        if not narrower:
            break
    numbered = number_rows(rest, [], order, "_rank", start=first)
    return numbered.filter((F.col("_rank") >= start) & (F.col("_rank") < stop)).drop("_rank")


def first_rows(df: DataFrame, order: Sequence, n: int = 10) -> DataFrame:
    return df.orderBy(*order).limit(n)
