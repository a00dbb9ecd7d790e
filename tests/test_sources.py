"""Sources, sinks and blobs on small files."""

import gzip
import io
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from gleaner.functions.blobs import decode_blob
from gleaner import session
from gleaner.session import shared_dir, stage
from gleaner.sources import blobs, listings, manifests, sinks, tables


def test_merged_scan(spark, tmp_path):
    spark.createDataFrame([("a", "utf-8")], "blob_id string, src_encoding string").write.parquet(str(tmp_path / "x"))
    spark.createDataFrame([("b", 5)], "blob_id string, size int").write.parquet(str(tmp_path / "y"))
    df = tables.scan_merged(spark, str(tmp_path / "x"), str(tmp_path / "y"))
    assert set(df.columns) == {"blob_id", "src_encoding", "size"} and df.count() == 2


def test_batched_scan(spark):
    sizes = "n long"

    def count(batch):
        import pyarrow as pa
        return pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], ["n"])

    got = [r.n for r in tables.scan_batched(spark.range(2500).coalesce(1), count, sizes, 1000).collect()]
    assert sum(got) == 2500 and max(got) <= 1000


def test_listing(spark, tmp_path):
    for name, data in {"a/1.zip": b"xy", "a/b/2.zip": b"abc", "a/b/none.zip": b"", "a b/3+4.zip": b"z", "a/5.json": b"{}",
                       "_p/.x%20y.zip": b"h", "100%.zip": b"tt"}.items():
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(data)
    found = listings.list_objects(spark, str(tmp_path), ".zip")
    assert {(r.key, r["size"]) for r in found.collect()} == {
        ("a/1.zip", 2), ("a/b/2.zip", 3), ("a/b/none.zip", 0), ("a b/3+4.zip", 1), ("_p/.x%20y.zip", 1), ("100%.zip", 2)}
    listed = listings.list_objects(spark, str(tmp_path))
    assert listed.count() == 7 and listed.filter("modified IS NULL OR modified < '2020-01-01'").count() == 0
    assert listings.from_inventory(listed.withColumnRenamed("size", "bytes"), size="bytes").count() == 7
    empty = tmp_path / "nothing"
    empty.mkdir()
    assert listings.list_objects(spark, str(empty)).count() == 0
    target = spark.createDataFrame([("up/a/1.zip",)], "key string")
    left = {r.target_key for r in listings.pending_uploads(found, target, "up").collect()}
    assert left == {"up/a/b/2.zip", "up/a b/3+4.zip", "up/a/b/none.zip", "up/_p/.x%20y.zip", "up/100%.zip"}


def test_csv_manifest_round_trip(spark, tmp_path):
    rows = [("o/a", 5, "C"), ("o/b,c", 4, None), ('o/"q"', 3, "D"), ("p/a", 5, "C"), ("None", 1, "C"), ("a\nb", 2, None)]
    path = str(tmp_path / "repos")
    sinks.write_catalog_csv(spark.createDataFrame(rows, "name string, stars long, lang string"), path)
    assert sorted(map(tuple, manifests.read_manifest_csv(spark, path).collect()), key=str) == sorted(rows, key=str)
    plain = tmp_path / "plain.csv"
    plain.write_text("o/a,5,None\no/b,4,C\n")
    assert [tuple(r) for r in manifests.read_manifest_csv(spark, str(plain)).collect()] == [("o/a", 5, None), ("o/b", 4, "C")]


def test_json_manifest(spark, tmp_path):
    (tmp_path / "k.json").write_text('["b", "a ", "b",\n "ü"]')
    (tmp_path / "empty.json").write_text("[]")
    got = manifests.read_manifest_json(spark, str(tmp_path)).orderBy("position").collect()
    assert [r.value for r in got] == ["b", "a ", "b", "ü"] and all(r.error is None for r in got)
    (tmp_path / "cut.json").write_text('["b", "a')
    broken = manifests.read_manifest_json(spark, str(tmp_path)).filter("error IS NOT NULL").collect()
    assert [(r.file.rsplit("/", 1)[1], r.value) for r in broken] == [("cut.json", None)]


def test_link_lines(spark):
    lines = ["  <link>https://h.org/details/1</link>\t", "<link>https://other/x</link>", "<url>https://h.org/details/2</url>",
             "", "<link>https://h.org/details/3</link>"]
    df = spark.createDataFrame([(v,) for v in lines], "value string")
    got = [r.link for r in manifests.read_link_lines(df, "https://h.org/details").collect()]
    assert got == ["https://h.org/details/1", "https://h.org/details/3"]


def test_search_pages(spark, tmp_path):
    (tmp_path / "p1.json").write_text(json.dumps({"total_count": 2, "items": [
        {"full_name": "o/a", "stargazers_count": 3, "size": 7, "language": None, "extra": 1},
        {"full_name": "o/b", "stargazers_count": 4, "size": 8, "language": "C"}]}, indent=1))
    (tmp_path / "p2.json").write_text('{"total_count": 0, "items": []}')
    flat = manifests.flatten_search_page(manifests.read_search_pages(spark, str(tmp_path)))
    assert [(r.pos, r.name, r.stars, r.lang) for r in flat.orderBy("pos").collect()] == [
        (0, "o/a", 3, None), (1, "o/b", 4, "C")]
    (tmp_path / "p3.json").write_text('{"total_count": 9, "ite')
    pages = manifests.read_search_pages(spark, str(tmp_path))
    broken = manifests.flatten_search_page(pages, "file").filter("error IS NOT NULL").collect()
    assert [(r.file.rsplit("/", 1)[1], r.name) for r in broken] == [("p3.json", None)]


def test_metadata_csv_appends(spark, tmp_path):
    path = str(tmp_path / "meta")
    df = spark.createDataFrame([("f", "u,1", 'alt "q"'), ("g", "u2", None)], "folder_name string, img_url string, alt_text string")
    sinks.write_metadata_csv(df, path)
    sinks.write_metadata_csv(df.filter("folder_name = 'f'"), path)
    back = spark.read.csv(path, header=True, escape='"')
    assert back.count() == 3 and back.filter("folder_name = 'f'").first().alt_text == 'alt "q"'


def test_json_array_files_are_arrays(spark, tmp_path):
    path = tmp_path / "array"
    df = spark.range(25).select(F.col("id").alias("i"))
    sinks.write_json_array(df, str(path), ["i"], F.concat(F.lit("u"), F.col("i").cast("string")), size=10)
    arrays = [json.loads(f.read_text()) for c in range(3) for f in (path / f"chunk={c}").glob("*.txt")]
    assert [len(a) for a in arrays] == [10, 10, 5] and sum(arrays, []) == [f"u{i}" for i in range(25)]


def test_keyed_layout(spark, tmp_path):
    df = spark.createDataFrame([("g1", 1), ("g1", 2), ("g2", 3)], "grp string, n int")
    sinks.write_keyed(df.coalesce(1), str(tmp_path / "keyed"), "grp", max_records=1)
    assert sorted(p.name for p in (tmp_path / "keyed").glob("grp=*")) == ["grp=g1", "grp=g2"]
    assert len(list((tmp_path / "keyed" / "grp=g1").glob("*.parquet"))) == 2


def test_bundles_hold_every_file_once(spark):
    files = [(f"o/{r}", f"{i:03d}.txt", (f"{r}{i}" * i).encode()) for r in "ab" for i in range(40)] + [("o/a", "zz/none", None), (None, "of no group", b"x")]
    df = spark.createDataFrame(files, "repo string, name string, content binary").repartition(4)
    got = sinks.bundle_groups(df, "repo", max_bytes=500)
    seen = {}
    for r in got.collect():
        with zipfile.ZipFile(io.BytesIO(r.zip)) as z:
            infos = z.infolist()
            assert r.n_files == len(infos) and r.raw_bytes == sum(i.file_size for i in infos)
            assert sum(i.file_size for i in infos[:-1]) <= 500
            for i in infos:
                assert (r.repo, i.filename) not in seen
                seen[(r.repo, i.filename)] = z.read(i)
    assert seen == {(r, n): c or b"" for r, n, c in files}


def test_decode(spark, tmp_path):
    store = tmp_path / "content"
    store.mkdir()
    texts = {"u8": ("grün é", "utf-8"), "l1": ("grün", "latin-1"), "cp": ("“q”", "cp1252"), "empty": ("", "utf-8"),
             "ko": ("한국어 텍스트", "euc-kr")}
    for name, (value, charset) in texts.items():
        (store / name).write_bytes(gzip.compress(value.encode(charset)))
    (store / "cut").write_bytes(gzip.compress(b"some longer text " * 20)[:30])
    (store / "plain").write_bytes(b"not gzip")
    meta = [(k, c) for k, (_, c) in texts.items()] + [
        ("cut", "utf-8"), ("plain", "utf-8"), ("gone", "utf-8"), ("l1", "utf-8"), ("u8", "no-such"), ("u8", None), (None, "utf-8")]
    df = spark.createDataFrame([(i, *m) for i, m in enumerate(meta)], "n int, blob_id string, src_encoding string")
    stored = blobs.scan_blobs(spark, str(store))
    out = blobs.enrich(df, stored).orderBy("n").collect()
    assert len(out) == len(meta)
    assert [r.text for r in out[:5]] == [v for v, _ in texts.values()]
    assert [r.word_count for r in out[:5]] == [2, 1, 1, 0, 2]
    assert [r.status for r in out] == ["ok"] * 5 + ["failed"] * 5 + ["ok", "failed"]
    assert all(r.text == "" and r.word_count == 0 and r.error for r in out if r.status == "failed")
    assert out[7].error == "missing" and out[10].text == "grün é"
    again = stored.union(stored.withColumn("path", F.concat("path", F.lit("-copy"))))
    assert blobs.enrich(df, again).count() == len(meta)


def test_shared_dir_and_stage(spark):
    assert listings._place("file:/tmp")[1] == listings._place("/tmp/")[1] == "/tmp"
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    df = stage(spark.range(5).withColumn("x", F.col("id") * 2))
    assert df.count() == 5 and df.inputFiles()[0].split("file:")[-1].lstrip("/").startswith(shared_dir(spark).lstrip("/"))


def test_release_removes_what_was_staged(spark):
    path = stage(spark.range(3), "short-lived").inputFiles()[0].rsplit("/", 1)[0]
    kept = session.fresh_dir(spark, "kept")
    assert session.path_exists(spark, path)
    session.release(spark, "short-lived")
    assert not session.path_exists(spark, path) and kept in session._handed_out


def test_cluster_needs_shared_dir(monkeypatch):
    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(Session())


def test_blobs_by_id(spark, tmp_path, monkeypatch):
    names = [f"b{i}" for i in range(100)] + ["100%", "a b", "x/y"]
    for name in names:
        path = tmp_path / "store" / f"{name}.gz"
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(gzip.compress(f"words of {name}".encode()))
    (tmp_path / "store" / "large.gz").write_bytes(b"z" * 5000)
    (tmp_path / "secret.gz").write_bytes(gzip.compress(b"outside"))
    wanted = ["b1", "b2", "b1", "100%", "a b", "x/y", "gone", None, "large", "../secret", "", "/etc/passwd"]
    metadata = spark.createDataFrame([(i, w, "utf-8") for i, w in enumerate(wanted)], "row int, blob_id string, src_encoding string")
    for root in (f"{tmp_path}/store", f"file://{tmp_path}/store"):
        found = blobs.fetch_blobs(metadata, root + "/{id}.gz", per_task=2, piece=30, most=4000)
        rows = {r["blob_id"]: r for r in found.collect()}
        assert len(rows) == found.count() == 10
        assert all(gzip.decompress(rows[n]["content"]) == f"words of {n}".encode() for n in ("b1", "b2", "100%", "a b", "x/y"))
        assert rows["gone"]["error"].startswith("FileNotFoundError") and "5000 bytes" in rows["large"]["error"]
        assert all(rows[n]["error"] == "no name of a blob" and rows[n]["content"] is None for n in ("../secret", "", "/etc/passwd"))
    texts = {r["row"]: r for r in blobs.fetch_enriched(metadata, f"{tmp_path}/store/{{id}}.gz").collect()}
    assert len(texts) == len(wanted) and [texts[i]["text"] for i in (0, 2, 5)] == ["words of b1"] * 2 + ["words of x/y"]
    assert texts[6]["status"] == "failed" and texts[6]["error"].startswith("FileNotFound") and texts[7]["error"] == "missing"


def test_blobs_by_id_open_only_what_is_wanted(spark, tmp_path):
    """The store's folder cannot be listed, and of its blobs only the wanted ones can be read."""
    store = tmp_path / "store"
    store.mkdir()
    for i in range(60):
        (store / f"b{i}").write_bytes(b"%d" % i)
    seen = blobs._reader(f"{store}/{{id}}", 10, None)
    import pyarrow as pa
    from pyarrow import fs

    opened = []

    class Place:
        def open_input_file(self, name):
            opened.append(name)
            return fs.LocalFileSystem().open_input_file(name)

    class Systems:
        @staticmethod
        def from_uri(uri):
            return Place(), "/"

    own, fs.FileSystem = fs.FileSystem, Systems
    try:
        batches = list(seen([pa.record_batch({"blob_id": ["b3", "b41", "b41x"]})]))
    finally:
        fs.FileSystem = own
    assert [b for x in batches for b in x["content"].to_pylist()] == [b"3", b"41", None]
    assert [n.rsplit("/", 1)[1] for n in opened] == ["b3", "b41", "b41x"]


def test_listing_of_deep_and_flat_trees(spark, tmp_path):
    root, want = tmp_path / "tree", {}
    for depth in range(12):
        for i in range(3):
            name = "/".join(f"d{k}" for k in range(depth)) + f"/f{i} {depth}%.bin"
            want[name.lstrip("/")] = depth * i
    want |= {f"flat/{i}": i % 3 for i in range(2500)}
    for name, size in want.items():
        path = root / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(b"x" * size)
    (root / "empty" / "folder").mkdir(parents=True)
    found = listings.list_objects(spark, str(root), page=100)
    assert {r["key"]: r["size"] for r in found.collect()} == want and found.count() == len(want)
    assert listings.list_objects(spark, str(root / "empty")).count() == 0
    # No batch is longer than a page.
    import pyarrow as pa

    sizes = [b.num_rows for b in listings._level(str(root), 100)([pa.record_batch({"key": ["flat", ""]})])]
    assert sum(sizes) == 2500 + 3 + 3 and max(sizes) <= 100


CSV = ('a/b,5,"None"\n"x ""y"", z",7,Py\n\n"two\nlines, and\n""quotes""\n",1,\n,2,"é\n漢"\n"""",3,""\n"\n\n",4,None\nlast,9,"C\n"')


def test_csv_records_at_every_cut():
    for data in (CSV.encode(), CSV.encode() + b"\n", b"one", b"\n", b'"a\nb"\n\n"c"'):
        whole = list(manifests.csv_records(io.BytesIO(data), len(data), 0, len(data), False))
        assert b"".join(t for _, t in whole).replace(b"\n", b"") == data.replace(b"\n", b"").replace(b"\r", b"")
        for width in range(1, len(data) + 1):
            for step in (1, 3, 1 << 20):
                found = []
                for start in range(0, len(data), width):
                    quoted = data[:start].count(b'"') % 2 == 1
                    found += manifests.csv_records(io.BytesIO(data), len(data), start, min(start + width, len(data)), quoted, step)
                assert found == whole


@pytest.mark.parametrize("range_bytes", [1, 7, 16, 1 << 20])
def test_large_csv_equals_the_whole_file_reader(spark, tmp_path, range_bytes):
    (tmp_path / "csv").mkdir()
    (tmp_path / "csv" / "a.csv").write_bytes(CSV.encode())
    (tmp_path / "csv" / "b c.csv").write_bytes(b'm,12,Go\nbad,"x",Go\n')
    (tmp_path / "csv" / "crlf.csv").write_bytes(b'r,1,"R"\r\n"s,""",2,S\r\n')
    (tmp_path / "csv" / "none.csv").write_bytes(b"")
    want = manifests.read_manifest_csv(spark, str(tmp_path / "csv"), errors=True).collect()
    got = manifests.read_large_csv(spark, str(tmp_path / "csv"), errors=True, range_bytes=range_bytes).collect()
    line = lambda r: (r["name"], r["stars"], r["lang"], r["error"] and r["error"].strip())
    assert sorted(map(line, got), key=repr) == sorted(map(line, want), key=repr) and len(got) == 11


def test_large_csv_query_writes_by_many_tasks(spark, tmp_path, monkeypatch):
    from checks import tables as queries

    rows = [(i, ["en", None][i % 2], f'say "{i}",\nthen {i}' if i % 3 else "") for i in range(40)]
    (spark.createDataFrame(rows, "doc_id long, lang string, text string").repartition(4)
     .write.parquet(str(tmp_path / "documents.parquet")))
    parts, write = [], queries.sinks.write_catalog_csv
    monkeypatch.setattr(queries.sinks, "write_catalog_csv",
                        lambda df, root: (parts.append(df.rdd.getNumPartitions()), write(df, root)))
    got = queries.read_large_csv(spark, str(tmp_path)).collect()
    assert parts == [4]
    assert sorted(map(tuple, got)) == [(i, lang or "None", text) for i, lang, text in rows if text]
