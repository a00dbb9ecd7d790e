"""Writers: parquet, CSV, JSON, keyed layouts and zip bundles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from gleaner.operators.aggregate import numbered_lists
from gleaner.operators.numbering import int_div, running_total


def write_parquet(df: DataFrame, path: str) -> None:
    """Snappy parquet, replacing what is there; one job for the whole table."""
    df.write.mode("overwrite").option("compression", "snappy").parquet(path)


def clustered(df: DataFrame, *columns: str) -> DataFrame:
    """Rows of a folder brought together, so that a folder gets few files.

    Adaptive execution splits a folder that is too large for one task and
    merges small ones.
    """
    return df.hint("rebalance", *[F.col(c) for c in columns])


def write_metadata_csv(df: DataFrame, path: str, folder: str = "folder_name", mode: str = "append",
                       run: str | None = None) -> None:
    """CSV with header, one folder per ``folder`` value.

    With ``run``, the rows go below ``run=<name>`` and replace what the same run has written to these folders before: a
    job that is started again under its name appends its rows once. A folder that the repeated run has no rows for
    keeps what it had.
    """
    if run is None:
        clustered(df, folder).write.mode(mode).partitionBy(folder).csv(path, header=True, escape='"')
    else:
        (clustered(df.withColumn("run", F.lit(run)), "run", folder).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("run", folder).csv(path, header=True, escape='"'))


def write_catalog_csv(df: DataFrame, path: str, none_columns: Sequence[str] = ("lang",)) -> None:
    """CSV without header, values quoted where needed; null is ``None`` in ``none_columns``, else nothing."""
    named = df.withColumns({c: F.coalesce(c, F.lit("None")) for c in none_columns if c in df.columns})
    named.write.mode("overwrite").csv(path, header=False, escape='"')


def json_arrays(df: DataFrame, order: Sequence[str], item: Column, *, size: int = 10_000) -> DataFrame:
    """The ordered items as JSON arrays of at most ``size`` elements: ``chunk, value``."""
    lists = numbered_lists(df, [], order, item, size=size)
    return lists.select("chunk", F.to_json("items", {"pretty": "false"}).alias("value"))


def write_json_array(df: DataFrame, path: str, order: Sequence[str], item: Column, *, size: int = 10_000) -> None:
    """JSON array files, one array per file (``chunk=N``); a list of up to ``size`` items is one file."""
    (json_arrays(df, order, item, size=size)
     .write.mode("overwrite").partitionBy("chunk").text(path))


def write_keyed(df: DataFrame, path: str, group: str | Sequence[str], fmt: str = "parquet",
                max_records: int = 1_000_000) -> None:
    """``<path>/<group>=<value>/part`` layout; a big group becomes several files."""
    names = [group] if isinstance(group, str) else list(group)
    (clustered(df, *names).write.mode("overwrite").partitionBy(*names)
     .option("maxRecordsPerFile", max_records).format(fmt).save(path))


def _zipper(group: str):
    def bundle(key, rows):
        import io
        import zipfile

        import pandas as pd

        buffer = io.BytesIO()
        ordered = rows.sort_values("name", kind="stable")
        with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
            for name, content in zip(ordered["name"], ordered["content"]):
                # A fixed date keeps a re-run byte-identical.
                entry = zipfile.ZipInfo(name, date_time=(1980, 1, 1, 0, 0, 0))
                entry.compress_type = zipfile.ZIP_DEFLATED
                archive.writestr(entry, content if content is not None else b"")
        return pd.DataFrame({
            group: [key[0]], "part": [int(key[1])], "n_files": [len(ordered)],
            "raw_bytes": [int(ordered["size"].sum())], "zip": [buffer.getvalue()]})

    return bundle


def bundle_groups(files: DataFrame, group: str, *, max_bytes: int = 64 << 20) -> DataFrame:
    """Deflated zip archives per group: ``group, part, n_files, raw_bytes, zip``.

    ``files`` holds ``group, name, content``; names are unique in a group,
    and files of a null group are bundled like any other. A group larger than ``max_bytes`` gets
    numbered parts, so one archive never holds more than that plus one file.
    """
    sized = files.select(group, "name", "content", F.octet_length("content").cast("bigint").alias("size"))
    # Positions come from names and sizes; payloads join the plan once, below.
    placed = running_total(sized.select(group, "name", "size"), [group], ["name"], F.col("size"), "_before")
    parts = placed.select(F.col(group).alias("_of_group"), F.col("name").alias("_of_name"),
                          int_div(F.col("_before"), max_bytes).cast("int").alias("part"))
    with_part = sized.join(parts, sized[group].eqNullSafe(parts["_of_group"])
                           & sized["name"].eqNullSafe(parts["_of_name"])).drop("_of_group", "_of_name")
    kind = dict(files.dtypes)[group]
    schema = f"`{group}` {kind}, part int, n_files bigint, raw_bytes bigint, zip binary"
    return with_part.groupBy(group, "part").applyInPandas(_zipper(group), schema)
