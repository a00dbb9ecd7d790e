"""WARC archives: whole-file gzip streams in, one gzip member per record and an offset index out."""

from __future__ import annotations

import base64
import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from gleaner.llm.hashing import texts_of
from gleaner.session import fresh_dir, stage

ROLL_BYTES = 128 << 20    # payload bytes after which a task begins another archive
ROLL_RECORDS = 100_000
_END = b"\r\n\r\n"
_ID = re.compile(r"^<urn:gleaner:page:(-?\d+)>$")
_DATE = "2000-01-01T00:00:00Z"  # archives of equal input are equal
_INDEX = ("page_id bigint, archive bigint, record bigint, path string, offset bigint, length bigint, "
          "record_type string, error string")


def _digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _urn(page: int) -> str:
    return f"<urn:gleaner:page:{page}>"


def _record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    clean = "".join(f"{k}: {re.sub(r'[\r\n]', lambda m: f'%0{ord(m[0]):X}', v)}\r\n" for k, v in headers)
    head = f"WARC/1.1\r\n{clean}Content-Length: {len(block)}\r\n\r\n"
    return head.encode() + block + _END


def response(record_id: str, url: str | None, payload: bytes) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    return _record([("WARC-Type", "response"), ("WARC-Record-ID", record_id), ("WARC-Date", _DATE)]
                   + ([("WARC-Target-URI", url)] if url else [])
                   + [("WARC-Payload-Digest", f"sha1:{_digest(payload)}"),
                      ("Content-Type", "application/http; msgtype=response")], http.encode() + payload)


def revisit(headers: dict[str, str], size: int, of: int | None) -> bytes:
    """The record without its payload, pointing at the response that has it."""
    kept = [(k, v) for k, v in headers.items() if k not in ("WARC-Type", "Content-Length")]
    return _record([("WARC-Type", "revisit"), *kept, *([] if of is None else [("WARC-Refers-To", _urn(of))]),
                    ("WARC-Payload-Length", str(size)),
                    ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")], b"")


def _place(root: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(root if "://" in root or root.startswith("file:") else f"file://{root}")


class _Output:
    """A file that appears under its name when it is complete, so a repeated task replaces it whole."""

    def __init__(self, root: str, name: str):
        self.fs, folder = _place(root)
        self.fs.create_dir(folder, recursive=True)
        self.path, self.part = f"{folder}/{name}", f"{folder}/.{name}.{uuid.uuid4().hex}"
        self.file, self.at = self.fs.open_output_stream(self.part, compression=None), 0

    def write(self, data: bytes) -> None:
        self.file.write(data)
        self.at += len(data)

    def close(self) -> None:
        self.file.close()
        self.fs.move(self.part, self.path)


def _pack(root: str):
    """Records of a task as whole-file gzip streams."""
    def run(batches):
        task, k, out, gz, held, count = TaskContext.get().partitionId(), 0, None, None, 0, 0
        for batch in batches:
            rows = []
            for page, url, payload in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                          texts_of(batch.column(2))):
                if out is None:
                    number = task << 20 | k
                    out, gz, held, count = _Output(root, f"{number}.warc.gz"), zlib.compressobj(1, wbits=31), 0, 0
                name = f"<urn:gleaner:record:{number}-{count}>" if page is None else _urn(page)
                out.write(gz.compress(response(name, url, payload)))
                rows.append((page, number, count, _digest(payload), len(payload)))
                held, count = held + len(payload), count + 1
                if held >= ROLL_BYTES or count >= ROLL_RECORDS:
                    out.write(gz.flush())
                    out.close()
                    out, k = None, k + 1
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int64(), pa.string(),
                                                                 pa.int64()))],
                    ["page_id", "archive", "record", "digest", "bytes"])
        if out is not None:
            out.write(gz.flush())
            out.close()
    return run


def write_monolithic(pages: DataFrame, root: str) -> DataFrame:
    """A response record per row of ``pages(page_id, url, html)``; ``page_id, archive, record, digest, bytes``."""
    return stage(pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", "html")
                 .mapInArrow(_pack(root), "page_id bigint, archive bigint, record bigint, digest string, bytes bigint"),
                 "warc-records")


def inflate(stream, chunk: int = 1 << 20) -> Iterator[bytes]:
    """Bytes of a gzip file of one member or many, read once from front to end."""
    gz = zlib.decompressobj(wbits=31)
    while data := stream.read(chunk):
        while data:
            yield gz.decompress(data)
            data = b""
            if gz.eof:
                data, gz = gz.unused_data, zlib.decompressobj(wbits=31)


def parse(pieces: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record; at most one record and one piece are held."""
    buffer, pieces = bytearray(), iter(pieces)

    def fill(size: int) -> bool:
        while len(buffer) < size:
            piece = next(pieces, None)
            if piece is None:
                return False
            buffer.extend(piece)
        return True

    while True:
        while (at := buffer.find(_END)) < 0:
            if not fill(len(buffer) + 1):
                if buffer.strip():
                    raise EOFError("an archive ends inside a header")
                return
        lines = bytes(buffer[:at]).decode("utf-8", "replace").lstrip("\r\n").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record: {lines[0][:40]!r}")
        headers = dict(x.split(": ", 1) for x in lines[1:] if ": " in x)
        size = int(headers.get("Content-Length", 0))
        if not fill(at + 4 + size + 4):
            raise EOFError("an archive ends inside a record")
        yield headers, bytes(buffer[at + 4:at + 4 + size])
        del buffer[:at + 8 + size]


def payload_of(headers: dict[str, str], block: bytes) -> bytes:
    if "application/http" in headers.get("Content-Type", ""):
        return block.partition(_END)[2]
    return block


def _page(value: str | None) -> int | None:
    found = _ID.match(value or "")
    return int(found[1]) if found else None


def _normalise(raw: str, root: str):
    """One archive: inflate, rewrite records as members, write the sidecar index."""
    def run(key, decisions):
        number = key[0].as_py()
        of = dict(zip(decisions["record"].to_pylist(),
                      zip(decisions["revisit"].to_pylist(), decisions["first_id"].to_pylist())))
        source, folder = _place(raw)
        out, index, rows, error = _Output(root, f"{number}.warc.gz"), _Output(root, f"{number}.idx.jsonl"), [], None
        with source.open_input_stream(f"{folder}/{number}.warc.gz", compression=None) as stream:
            try:
                for k, (headers, block) in enumerate(parse(inflate(stream))):
                    again, first = of.get(k, (False, None))
                    if again:
                        data, kind = revisit(headers, len(payload_of(headers, block)), first), "revisit"
                    else:
                        data = _record([x for x in headers.items() if x[0] != "Content-Length"], block)
                        kind = headers.get("WARC-Type", "")
                    gz, start = zlib.compressobj(6, wbits=31), out.at
                    out.write(gz.compress(data) + gz.flush())
                    rows.append((_page(headers.get("WARC-Record-ID")), number, k, out.path, start, out.at - start, kind,
                                 None))
                    index.write(json.dumps({"offset": start, "length": out.at - start, "type": kind, "record": k,
                                            "id": headers.get("WARC-Record-ID"), "uri": headers.get("WARC-Target-URI"),
                                            "digest": headers.get("WARC-Payload-Digest")}).encode() + b"\n")
            except (EOFError, ValueError, zlib.error) as exc:
                error = str(exc)
        out.close()
        index.close()
        if error:
            rows.append((None, number, len(rows), out.path, None, None, None, error))
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
        names = [x.split()[0] for x in _INDEX.split(", ")]
        return pa.table([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names=names)
    return run


def normalise(raw: str, root: str, decisions: DataFrame) -> DataFrame:
    """Rewrite the archives of ``decisions(archive, record, revisit, first_id)`` below ``root``; the offset index.

    Each archive is one task's work: inflated once as a stream, every record
    becomes a gzip member of its own, ``<archive>.idx.jsonl`` beside it says
    where. An archive that breaks off keeps the records before the break and
    adds a row with ``error``.
    """
    # The decisions are slim but their archives are not: a task per archive, whatever the size of the shuffle.
    archives = decisions.select("archive").distinct().count()
    return stage(decisions.repartition(max(archives, 1), "archive").groupBy("archive")
                 .applyInArrow(_normalise(raw, root), _INDEX), "warc-index")


def _read(root: str):
    def run(batches):
        where, _ = _place(root)
        name, file = None, None
        for batch in batches:
            rows = []
            for path, offset, length in zip(*(batch.column(c).to_pylist() for c in ("path", "offset", "length"))):
                if path != name:
                    name, file = path, where.open_input_file(path)
                headers, block = next(parse(iter([zlib.decompress(file.read_at(length, offset), wbits=31)])))
                payload, kind = payload_of(headers, block), headers["WARC-Type"]
                stated = headers["WARC-Payload-Digest"].removeprefix("sha1:")
                if kind == "response" and _digest(payload) != stated:
                    raise ValueError(f"{path} at {offset}: the payload does not match its digest")
                rows.append((_page(headers["WARC-Record-ID"]), stated, kind, _page(headers.get("WARC-Refers-To")),
                             int(headers.get("WARC-Payload-Length", len(payload)))))
            if rows:
                page, digest, kind, of, size = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(page, pa.int64()), pa.array(size, pa.int64()), pa.array(digest), pa.array(kind),
                     pa.array(of, pa.int64())],
                    ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])
    return run


def read_records(index: DataFrame, root: str) -> DataFrame:
    """Every indexed record, read by its offset; the digest of a response is checked against its payload."""
    found = index.where("error IS NULL").select("path", "offset", "length")
    files = found.select("path").distinct().count()
    return (found.repartition(max(files, 1), "path").sortWithinPartitions("path", "offset")
            .mapInArrow(_read(root), "page_id bigint, payload_bytes bigint, payload_digest string, "
                                     "record_type string, refers_to bigint"))


def archive_pages(pages: DataFrame, least_bytes: int = 0, root: str | None = None) -> DataFrame:
    """Write ``pages(page_id, url, html, ...)`` as archives, normalise them, read them back: a row per page.

    Null html is an empty payload, a null url leaves its header out. Of equal
    payloads of ``least_bytes`` or more the smallest ``page_id`` is the
    response and the others revisit it; among rows that share that
    ``page_id`` the first record is. Rows without ``page_id`` come last; a
    revisit of such a row has a null ``refers_to``. Other columns are ignored.
    """
    root = root or fresh_dir(pages.sparkSession, "warc")
    records = write_monolithic(pages, f"{root}/raw")
    rank = F.struct(F.col("page_id").isNull().alias("none"), "page_id", "archive", "record")
    first = (records.where(F.col("bytes") >= least_bytes).groupBy("digest", "bytes").agg(F.min(rank).alias("first")))
    decisions = (records.join(first, ["digest", "bytes"], "left")
                 .select("archive", "record", F.col("first.page_id").alias("first_id"),
                         F.coalesce((F.col("archive") != F.col("first.archive"))
                                    | (F.col("record") != F.col("first.record")), F.lit(False)).alias("revisit")))
    return read_records(normalise(f"{root}/raw", f"{root}/records", decisions), f"{root}/records")
