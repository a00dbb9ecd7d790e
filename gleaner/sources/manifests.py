"""Manifests and landed responses: CSV, JSON arrays, tagged lines, search results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from gleaner.session import stage

REPO_SCHEMA = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("stars", T.LongType()),
    T.StructField("lang", T.StringType()),
])

SEARCH_PAGE_SCHEMA = T.StructType([
    T.StructField("total_count", T.LongType()),
    T.StructField("items", T.ArrayType(T.StructType([
        T.StructField("full_name", T.StringType()),
        T.StructField("stargazers_count", T.LongType()),
        T.StructField("size", T.LongType()),
        T.StructField("language", T.StringType()),
    ]))),
])

# The tag a link line carries, and the address it has to start with.
LINK_OPEN, LINK_CLOSE = "<link>", "</link>"


def read_manifest_csv(spark: SparkSession, path: str, schema: T.StructType = REPO_SCHEMA,
                      none_columns: Sequence[str] = ("lang",), errors: bool = False) -> DataFrame:
    """CSV without header; in ``none_columns`` the text ``None`` is null.

    A quoted value may hold line breaks. With ``errors`` a row that does not
    fit the schema has its text in ``error``.
    """
    if errors:
        schema = T.StructType([*schema.fields, T.StructField("error", T.StringType())])
    rows = spark.read.csv(path, schema=schema, header=False, escape='"', multiLine=True,
                          columnNameOfCorruptRecord="error")
    return rows.withColumns({c: F.when(F.col(c) != "None", F.col(c)) for c in none_columns})


def _odd_quotes(open_file, step: int):
    """Per byte range whether it holds an odd number of quotes."""
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            odd = []
            for name, start, end in zip(*(batch.column(c).to_pylist() for c in ("file", "start", "end"))):
                quotes = 0
                with open_file(name) as file:
                    file.seek(start)
                    for at in range(start, end, step):
                        quotes += file.read(min(step, end - at)).count(b'"')
                odd.append(quotes % 2)
            yield pa.RecordBatch.from_arrays([batch.column("file"), batch.column("start"), pa.array(odd, pa.int64())],
                                             ["file", "start", "odd"])
    return run


def csv_records(file, size: int, start: int, end: int, quoted: bool, step: int = 1 << 20):
    """``offset, bytes`` of the records that begin in ``start <= offset < end``; ``quoted``: the range begins inside quotes.

    A record ends at a line break outside quotes; the last one may end beyond the range. A carriage return before the
    break belongs to it.
    """
    import numpy as np

    at = max(start - 1, 0)
    file.seek(at)
    begin, held, inside = (0, [], quoted) if start == 0 else (None, [], quoted)
    first = start > 0
    while at < size and (begin is None or begin < end):
        data = file.read(min(step, size - at))
        buf = np.frombuffer(data, dtype=np.uint8)
        if first and buf[0] == 34:
            inside = not inside                            # the state is that before the range's first byte
        first = False
        state = np.cumsum(buf == 34) + inside
        cut = 0
        for brk in np.flatnonzero((buf == 10) & (state % 2 == 0)).tolist():
            if begin is not None and begin < end:
                yield begin, b"".join([*held, data[cut:brk]]).removesuffix(b"\r")
            begin, held, cut = at + brk + 1, [], brk + 1
            if begin >= end:
                return
        if begin is not None:
            held.append(data[cut:])
        elif at + len(data) >= end:
            return
        inside, at = bool(state[-1] % 2), at + len(data)
    if begin is not None and begin < end and begin < size:
        yield begin, b"".join(held)


def _records(open_file, step: int, piece: int):
    def run(batches):
        import pyarrow as pa

        def batch_of(name, rows):
            offsets, texts = zip(*rows)
            return pa.RecordBatch.from_arrays([pa.array([name] * len(rows)), pa.array(offsets, pa.int64()),
                                               pa.array([t.decode("utf-8", "replace") for t in texts])], ["file", "at", "value"])

        for batch in batches:
            for name, size, start, end, quoted in zip(*(batch.column(c).to_pylist() for c in (
                    "file", "size", "start", "end", "quoted"))):
                rows, held = [], 0
                with open_file(name) as file:
                    for offset, text in csv_records(file, size, start, end, quoted, step):
                        if text.strip():
                            rows.append((offset, text))
                            held += len(text)
                        if held >= piece:
                            yield batch_of(name, rows)
                            rows, held = [], 0
                if rows:
                    yield batch_of(name, rows)
    return run


def read_large_csv(spark: SparkSession, root: str, schema: T.StructType = REPO_SCHEMA, none_columns: Sequence[str] = ("lang",),
                   errors: bool = False, *, suffix: str | None = None, range_bytes: int = 64 << 20) -> DataFrame:
    """:func:`read_manifest_csv` for files of any size below a folder: each is read in byte ranges by many tasks.

    Whether a range begins inside a quoted value follows from the quotes before it: every range is counted, odd counts
    are added up along the file, and then each range parses the records that begin in it. A task holds one record and
    some blocks. Quotes stand around values and are doubled inside them, as CSV writers write them; a quote inside a
    value without quotes around it is not allowed for. Lines end with a line feed; blank lines are left out.
    """
    from gleaner.sources.listings import list_objects

    place = _opener(root)
    files = list_objects(spark, root, suffix).where("size > 0")
    ranges = stage(files.select(F.col("key").alias("file"), "size", F.explode(F.sequence(
        F.lit(0).cast("bigint"), F.col("size") - 1, F.lit(range_bytes).cast("bigint"))).alias("start"))
        .withColumn("end", F.least(F.col("start") + F.lit(range_bytes), F.col("size"))), "csv-ranges")
    # A range is a row; it is worth a task.
    n = max(1, min(ranges.count(), 10_000))
    counted = ranges.repartition(n).mapInArrow(_odd_quotes(place, 1 << 20), "file string, start bigint, odd bigint")
    before = F.sum("odd").over(Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1))
    states = counted.select("file", "start", (F.coalesce(before, F.lit(0)) % 2 == 1).alias("quoted"))
    records = (ranges.join(states, ["file", "start"]).repartition(n)
               .mapInArrow(_records(place, 1 << 20, 8 << 20), "file string, at bigint, value string"))
    wanted = T.StructType([*schema.fields, T.StructField("error", T.StringType())])
    parsed = records.select(F.from_csv("value", wanted.simpleString()[7:-1].replace(":", " "), {
        "escape": '"', "multiLine": "true", "columnNameOfCorruptRecord": "error"}).alias("r")).select("r.*")
    rows = parsed if errors else parsed.drop("error")
    return rows.withColumns({c: F.when(F.col(c) != "None", F.col(c)) for c in none_columns})


def _opener(root: str):
    """Opens a file below ``root``; made in each task."""
    def open_file(name: str):
        from pyarrow import fs

        place, base = fs.FileSystem.from_uri(root if ":/" in root else f"file://{root}")
        return place.open_input_file(f"{base.rstrip('/')}/{name}")
    return open_file


def read_manifest_json(spark: SparkSession, path: str) -> DataFrame:
    """JSON files that hold one array of strings each: ``file, position, value, error``.

    A file that is no such array gives one row with ``error`` and no value.
    """
    whole = spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("file"), F.from_json("value", "array<string>").alias("items"))
    rows = whole.select("file", F.when(F.col("items").isNull(), "not a JSON array of strings").alias("error"),
                        F.posexplode_outer("items").alias("position", "value"))
    return (rows.filter(F.col("position").isNotNull() | F.col("error").isNotNull())
            .select("file", "position", "value", "error"))


def read_link_lines(lines: DataFrame, host: str, column: str = "value") -> DataFrame:
    """URLs of lines like ``<link>URL</link>`` (blanks around allowed) whose URL starts with ``host``."""
    line = F.regexp_replace(F.col(column), r"(?U)^\s+|\s+$", "")
    kept = lines.withColumn("_line", line).filter(F.col("_line").startswith(LINK_OPEN + host))
    # The URL is what stands between the tags; a cut of their fixed lengths.
    inside = F.substring(F.col("_line"), F.lit(len(LINK_OPEN) + 1),
                         F.length("_line") - F.lit(len(LINK_OPEN) + len(LINK_CLOSE)))
    return kept.withColumn("link", inside).drop("_line", column)


def read_search_pages(spark: SparkSession, path: str) -> DataFrame:
    """Landed search responses, one JSON document per file; ``error`` holds the text of an unreadable one."""
    schema = T.StructType([*SEARCH_PAGE_SCHEMA.fields, T.StructField("error", T.StringType())])
    return (spark.read.json(path, schema=schema, multiLine=True, columnNameOfCorruptRecord="error")
            .withColumn("file", F.col("_metadata.file_path")))


def parse_search_pages(df: DataFrame, column: str) -> DataFrame:
    """The same from a column of JSON texts."""
    schema = T.StructType([*SEARCH_PAGE_SCHEMA.fields, T.StructField("error", T.StringType())])
    page = F.from_json(F.col(column), schema, {"columnNameOfCorruptRecord": "error"})
    return df.withColumn("_page", page).select(
        *[c for c in df.columns if c != column], "_page.total_count", "_page.items", "_page.error")


def flatten_search_page(pages: DataFrame, *keep: str) -> DataFrame:
    """One repository per row: ``total_count, error, pos, name, stars, size, lang``.

    An unreadable response is one row with ``error`` and no repository.
    """
    rows = (pages.select(*keep, "total_count", "error", F.posexplode_outer("items").alias("pos", "_r"))
            .filter(F.col("pos").isNotNull() | F.col("error").isNotNull()))
    return rows.select(*keep, F.when(F.col("error").isNull(), F.col("total_count")).alias("total_count"), "error", "pos",
                       F.col("_r.full_name").alias("name"),
                       F.col("_r.stargazers_count").alias("stars"),
                       F.col("_r.size").alias("size"),
                       F.col("_r.language").alias("lang"))
