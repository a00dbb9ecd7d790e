"""Gzip blobs addressed by id."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from gleaner.functions.blobs import with_decoded
from gleaner.operators.skew import left_join
from gleaner.session import stage


def scan_blobs(spark: SparkSession, root: str) -> DataFrame:
    """``blob_id, path, content`` of the objects in ``root``; the id is the file name.

    A folder holds a name once, so ids are unique.
    """
    files = spark.read.format("binaryFile").load(root)
    return files.select(F.substring_index("path", "/", -1).alias("blob_id"), "path", "content")


def _reader(template: str, piece: int, most: int | None):
    def run(batches):
        import pyarrow as pa
        from pyarrow import fs

        places: dict[tuple, object] = {}

        def read(path: str) -> bytes:
            if ":/" not in path:
                path = f"file://{path}"
            scheme, _, rest = path.replace(":///", ":/").partition(":/")
            host, _, name = rest.lstrip("/").partition("/") if rest.startswith("/") else ("", "", rest)
            if (scheme, host) not in places:
                places[scheme, host] = fs.FileSystem.from_uri(f"{scheme}://{host}/")[0]
            # Hadoop names a file below its host, object stores below the bucket.
            name = f"{host}/{name}" if host and scheme not in ("hdfs", "viewfs") else f"/{name}"
            with places[scheme, host].open_input_file(name) as file:
                if most is not None and file.size() > most:
                    raise ValueError(f"{file.size()} bytes, more than {most}")
                return file.read()

        def batch_of(rows):
            ids, paths, contents, errors = zip(*rows)
            return pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.string()), pa.array(paths, pa.string()), pa.array(contents, pa.binary()),
                 pa.array(errors, pa.string())], ["blob_id", "path", "content", "error"])

        for batch in batches:
            rows, held = [], 0
            for blob in batch.column(0).to_pylist():
                path, content, error = template.replace("{id}", blob), None, None
                try:
                    content = read(path)
                except Exception as problem:  # whatever a store says about one blob is a row, not the end of the job
                    error = f"{type(problem).__name__}: {problem}"[:500]
                rows.append((blob, path, content, error))
                held += len(content or b"")
                if held >= piece:
                    yield batch_of(rows)
                    rows, held = [], 0
            if rows:
                yield batch_of(rows)
    return run


def fetch_blobs(wanted: DataFrame, template: str, on: str = "blob_id", *, per_task: int = 1000,
                piece: int = 32 << 20, most: int | None = None) -> DataFrame:
    """``blob_id, path, content, error`` of the blobs that ``wanted`` names, each read once.

    ``template`` is the path of a blob with ``{id}`` for its id, on any store that Arrow's file systems know (``file``,
    ``s3``, ``gs``, ``hdfs``). The store is not listed, and blobs that nobody asks for are neither looked up nor read:
    a metadata table of a thousandth of a store reads a thousandth of it. Ids are dealt over tasks, about ``per_task``
    to a task, whatever the store looks like; an Arrow batch ends after ``piece`` bytes, so a task holds no more than
    that and one blob. A blob that is missing, unreadable, or larger than ``most`` bytes is a row with ``error`` and no
    content. Null ids name no blob; an id with a path of its own (``..`` or ``/``) is an error too.
    """
    ids = stage(wanted.select(F.col(on).cast("string").alias("blob_id")).where(F.col("blob_id").isNotNull()).distinct(), "wanted")
    n = max(1, -(-ids.count() // per_task))
    dealt = ids.repartition(n, "blob_id")
    odd = F.col("blob_id").rlike(r"(^|/)\.\.?(/|$)|^/") | (F.col("blob_id") == "")
    schema = "blob_id string, path string, content binary, error string"
    good = dealt.where(~odd).mapInArrow(_reader(template, piece, most), schema)
    none = F.lit(None)
    return good.union(ids.where(odd).select("blob_id", none.cast("string"), none.cast("binary"), F.lit("no name of a blob")))


def fetch_enriched(metadata: DataFrame, template: str, on: str = "blob_id", encoding: str = "src_encoding", **how) -> DataFrame:
    """Metadata rows with ``text, word_count, status, error`` from blobs read by id; rows out = rows in."""
    found = fetch_blobs(metadata, template, on, **how)
    payload = found.select(F.col("blob_id").alias(on), "content", F.col("error").alias("_fetch"))
    decoded = with_decoded(left_join(metadata, payload, on), "content", encoding)
    return decoded.withColumn("error", F.coalesce("_fetch", "error")).drop("_fetch")


def enrich(metadata: DataFrame, blobs: DataFrame, on: str = "blob_id", encoding: str = "src_encoding") -> DataFrame:
    """Metadata rows with ``text, word_count, status, error``; rows out = rows in.

    ``blobs`` holds ``on, path, content``; of several blobs of an id that with
    the smallest path counts, which ids and paths alone decide. Compressed
    payloads are decoded next to their metadata row. A row without blob
    becomes a failure row.
    """
    first = blobs.groupBy(on).agg(F.min("path").alias("path"))
    payload = blobs.join(first, [on, "path"], "left_semi").select(on, "content")
    return with_decoded(left_join(metadata, payload, on), "content", encoding)
