"""Sources and sinks: each query writes what it derives from the tables and reads it back."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from checks.inputs import (DONE, OBJECTS, REPOS, done_objects, objects, repos, table, with_sql)
from checks.registry import query
from checks.scalars import gzip_store
from gleaner.functions.blobs import with_decoded
from gleaner.operators.numbering import int_div, number_rows
from gleaner.session import fresh_dir
from gleaner.sources import blobs, listings, manifests, sinks, tables


@query("scan_merged", """
  SELECT doc_id, lang, NULL::INTEGER AS quality FROM documents
  UNION ALL SELECT doc_id, NULL, quality FROM labels""")
def scan_merged(spark, d):
    root = fresh_dir(spark, "merged")
    sinks.write_parquet(table(spark, d, "documents").select("doc_id", "lang"), f"{root}/part=a")
    sinks.write_parquet(table(spark, d, "labels").select("doc_id", "quality"), f"{root}/part=b")
    return tables.scan_merged(spark, root).select("doc_id", "lang", "quality")


@query("scan_batched", "SELECT doc_id, strlen(text) AS n_bytes FROM documents")
def scan_batched(spark, d):
    def measure(batch):
        import pyarrow as pa
        import pyarrow.compute as pc
        lengths = pc.binary_length(batch.column("text")).cast(pa.int64())
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), lengths], ["doc_id", "n_bytes"])

    docs = table(spark, d, "documents").select("doc_id", "text")
    return tables.scan_batched(docs, measure, "doc_id bigint, n_bytes bigint", 1000)


@query("list_objects", """
  SELECT 'source=' || source AS folder, sum(strlen(text) + 1)::BIGINT AS size FROM documents GROUP BY source""")
def list_objects(spark, d):
    root = fresh_dir(spark, "listing")
    sinks.write_keyed(table(spark, d, "documents").select("source", "text"), root, "source", "text")
    listed = listings.list_objects(spark, root, ".txt")
    return listed.groupBy(F.substring_index("key", "/", 1).alias("folder")).agg(F.sum("size").alias("size"))


@query("list_snapshot_files", """
  SELECT 'data/' || lang || '/' || doc_id || '.txt' AS key FROM documents WHERE lang = 'en'""")
def list_snapshot_files(spark, d):
    files = table(spark, d, "documents").select(F.format_string("data/%s/%d.txt", "lang", "doc_id").alias("key"))
    return listings.list_snapshot_files(files, "en")


@query("read_manifest_csv", with_sql(REPOS, select="SELECT name, stars, lang FROM repos"))
def read_manifest_csv(spark, d):
    root = fresh_dir(spark, "manifest")
    sinks.write_catalog_csv(repos(spark, d).select("name", "stars", "lang"), root)
    return manifests.read_manifest_csv(spark, root)


@query("read_large_csv", "SELECT doc_id, lang, text FROM documents WHERE text <> ''")
def read_large_csv(spark, d):
    # Files whose values hold quotes and line breaks, each written by one task and read in ranges of half a megabyte.
    root = fresh_dir(spark, "large-csv")
    docs = table(spark, d, "documents").select("doc_id", "lang", "text").where("text <> ''")
    sinks.write_catalog_csv(docs, root)
    return manifests.read_large_csv(spark, root, docs.schema, (), suffix=".csv", range_bytes=1 << 19)


@query("read_manifest_json", """
  SELECT p_name AS value, (row_number() OVER (ORDER BY p_partkey) - 1) % 500 AS position FROM part""")
def read_manifest_json(spark, d):
    root = fresh_dir(spark, "keywords")
    sinks.write_json_array(table(spark, d, "part"), root, ["p_partkey"], F.col("p_name"), size=500)
    return manifests.read_manifest_json(spark, root).select("value", F.col("position").cast("bigint").alias("position"))


@query("read_link_lines", "SELECT page_id, url AS link FROM pages WHERE url LIKE 'https://blog.%'")
def read_link_lines(spark, d):
    lines = table(spark, d, "pages").select(
        "page_id", F.concat(F.lit("  <link>"), F.col("url"), F.lit("</link>\t")).alias("value"))
    return manifests.read_link_lines(lines, "https://blog.")


def search_pages(spark, d):
    """Search responses of up to 100 repositories per brand, as JSON text."""
    found = repos(spark, d).withColumn("brand", F.substring_index("name", "/", 1))
    numbered = number_rows(found, ["brand"], ["pos"], "n",
                           total="total_count")
    item = F.struct("n", F.struct(F.col("name").alias("full_name"), F.col("stars").alias("stargazers_count"),
                                  "size", F.col("lang").alias("language")).alias("item"))
    paged = numbered.groupBy("brand", "total_count", int_div(F.col("n"), 100).alias("page")).agg(
        F.array_sort(F.collect_list(item)).alias("rows"))
    items = F.transform("rows", lambda r: r["item"])
    return paged.select("brand", "page", F.to_json(F.struct("total_count", items.alias("items"))).alias("response"))


@query("flatten_search_page", with_sql(REPOS, """numbered AS (
  SELECT *, split_part(name, '/', 1) AS brand,
         row_number() OVER (PARTITION BY split_part(name, '/', 1) ORDER BY pos) - 1 AS n,
         count(*) OVER (PARTITION BY split_part(name, '/', 1)) AS total_count FROM repos)""", select="""
  SELECT brand, n // 100 AS page, n % 100 AS pos, total_count, name, stars, size, lang FROM numbered"""))
def flatten_search_page(spark, d):
    pages = manifests.parse_search_pages(search_pages(spark, d), "response")
    flat = manifests.flatten_search_page(pages, "brand", "page")
    return flat.drop("error").withColumn("pos", F.col("pos").cast("bigint"))


@query("read_search_pages", with_sql(REPOS, """numbered AS (
  SELECT *, split_part(name, '/', 1) AS brand, count(*) OVER (PARTITION BY split_part(name, '/', 1)) AS total_count,
         (row_number() OVER (PARTITION BY split_part(name, '/', 1) ORDER BY pos) - 1) // 100 AS page FROM repos)""",
                                    select="""
  SELECT total_count, name, stars, size, lang, FALSE AS broken FROM numbered WHERE page > 0 OR brand <> 'Brand#11'
  UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, TRUE FROM numbered WHERE page = 0 AND brand = 'Brand#11'
  GROUP BY brand, page"""))
def read_search_pages(spark, d):
    root = fresh_dir(spark, "responses")
    cut = (F.col("brand") == "Brand#11") & (F.col("page") == 0)
    text = F.when(cut, F.left("response", F.lit(40))).otherwise(F.col("response"))
    (search_pages(spark, d).select(text.alias("value")).write.option("maxRecordsPerFile", 1).text(root))
    flat = manifests.flatten_search_page(manifests.read_search_pages(spark, root))
    return flat.select("total_count", "name", "stars", "size", "lang", F.col("error").isNotNull().alias("broken"))


@query("scan_blobs", """
  SELECT role, count(*) AS n_lines, sum(len(list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '')))::BIGINT AS words
  FROM conversations GROUP BY role""")
def scan_blobs(spark, d):
    root = fresh_dir(spark, "blobs")
    one_line = table(spark, d, "conversations").select("role", F.translate("text", "\n\r", "  ").alias("text"))
    (one_line.write.partitionBy("role").option("compression", "gzip").option("maxRecordsPerFile", 2000).text(root))
    stored = blobs.scan_blobs(spark, f"{root}/role=*")
    decoded = with_decoded(stored.withColumn("src_encoding", F.lit("utf-8")))
    return decoded.groupBy(F.regexp_extract("path", "role=([^/]+)", 1).alias("role")).agg(
        F.sum(F.regexp_count("text", F.lit("\n"))).alias("n_lines"), F.sum("word_count").alias("words"))


def put_blobs(rows, root):
    """A gzip object per row ``name, text`` below ``root``; gives the number written."""
    def run(batches):
        import gzip

        import pyarrow as pa
        from pyarrow import fs

        place, base = fs.FileSystem.from_uri(root if ":/" in root else f"file://{root}")
        place.create_dir(base)
        for batch in batches:
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with place.open_output_stream(f"{base}/{name}.gz", compression=None) as out:
                    out.write(gzip.compress(text.encode()))
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], ["n"])
    return rows.mapInArrow(run, "n bigint").agg(F.sum("n")).first()[0]


@query("fetch_blobs", """
  SELECT 's' || l_suppkey AS blob_id, count(*) AS n_rows, CASE WHEN s_acctbal < 0 THEN 0 ELSE count(*) * 2 END AS words,
         CASE WHEN s_acctbal < 0 THEN 'failed' ELSE 'ok' END AS status
  FROM lineitem JOIN supplier ON s_suppkey = l_suppkey GROUP BY l_suppkey, s_acctbal""")
def fetch_blobs(spark, d):
    # A store with a blob per customer, whom nobody asks for, and one per supplier that is not in debt.
    root = fresh_dir(spark, "store")
    supplier = table(spark, d, "supplier").where("s_acctbal >= 0")
    put_blobs(supplier.select(F.concat(F.lit("s"), F.col("s_suppkey").cast("string")), F.concat_ws(" ", "s_suppkey", "s_nationkey"))
              .union(table(spark, d, "customer").select(F.concat(F.lit("c"), F.col("c_custkey").cast("string")), F.lit("x"))), root)
    metadata = table(spark, d, "lineitem").select(
        F.concat(F.lit("s"), F.col("l_suppkey").cast("string")).alias("blob_id"), F.lit("utf-8").alias("src_encoding"))
    texts = blobs.fetch_enriched(metadata, root + "/{id}.gz")
    return texts.groupBy("blob_id", "status").agg(F.count("*").alias("n_rows"), F.sum("word_count").cast("bigint").alias("words"))


@query("write_parquet", "SELECT doc_id, text, lang FROM documents")
def write_parquet(spark, d):
    root = fresh_dir(spark, "parquet")
    docs = table(spark, d, "documents").select("doc_id", "text", "lang")
    sinks.write_parquet(docs, root)
    return spark.read.schema(docs.schema).parquet(root)


@query("write_metadata_csv", """
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL SELECT item_id, -1, 'benchmark', text FROM benchmark""")
def write_metadata_csv(spark, d):
    root = fresh_dir(spark, "metadata")
    first = table(spark, d, "conversations").select("conv_id", "turn", "text", "role")
    more = table(spark, d, "benchmark").select(
        F.col("item_id").alias("conv_id"), F.lit(-1).cast("bigint").alias("turn"), "text",
        F.lit("benchmark").alias("role"))
    sinks.write_metadata_csv(first, root, "role")
    sinks.write_metadata_csv(more, root, "role")
    return spark.read.schema(first.schema).csv(root, header=True, escape='"', multiLine=True)


@query("write_metadata_csv_again", """
  SELECT conv_id, turn, role, text, 'first' AS run FROM conversations
  UNION ALL SELECT item_id, -1, 'benchmark', text, 'second' FROM benchmark""")
def write_metadata_csv_again(spark, d):
    root = fresh_dir(spark, "metadata-runs")
    first = table(spark, d, "conversations").select("conv_id", "turn", "text", "role")
    more = table(spark, d, "benchmark").select(
        F.col("item_id").alias("conv_id"), F.lit(-1).cast("bigint").alias("turn"), "text", F.lit("benchmark").alias("role"))
    # The first run is started twice.
    for rows, run in ((first, "first"), (more, "second"), (first, "first")):
        sinks.write_metadata_csv(rows, root, "role", run=run)
    schema = T.StructType([*first.drop("role").schema.fields, T.StructField("run", T.StringType()), T.StructField("role", T.StringType())])
    return spark.read.csv(root, schema=schema, header=True, escape='"', multiLine=True).select("conv_id", "turn", "role", "text", "run")


@query("write_catalog_csv", with_sql(REPOS, select="SELECT name || chr(10) || 'None' AS name, stars, lang FROM repos"))
def write_catalog_csv(spark, d):
    root = fresh_dir(spark, "catalogue")
    # Names with a line break, and the text that stands for null in another column.
    named = repos(spark, d).select(F.concat("name", F.lit("\nNone")).alias("name"), "stars", "lang")
    sinks.write_catalog_csv(named, root)
    return manifests.read_manifest_csv(spark, root)


@query("write_json_array", """
  SELECT (row_number() OVER (ORDER BY item_id) - 1) % 50 AS position, text AS value FROM benchmark""")
def write_json_array(spark, d):
    root = fresh_dir(spark, "array")
    sinks.write_json_array(table(spark, d, "benchmark"), root, ["item_id"], F.col("text"), size=50)
    read = manifests.read_manifest_json(spark, root)
    return read.select(F.col("position").cast("bigint").alias("position"), "value")


@query("write_keyed", "SELECT o_orderkey, o_totalprice, o_orderpriority, o_orderstatus FROM orders")
def write_keyed(spark, d):
    root = fresh_dir(spark, "keyed")
    orders = table(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority", "o_orderstatus")
    sinks.write_keyed(orders, root, ["o_orderpriority", "o_orderstatus"])
    return spark.read.schema(orders.schema).parquet(root)


def unzip(frames):
    """Name and digest of every file, read back from the archives."""
    import hashlib
    import io
    import zipfile

    import pandas as pd

    for frame in frames:
        rows = [(r.source, r.part, r.n_files, r.raw_bytes, name, hashlib.md5(z.read(name)).hexdigest())
                for r in frame.itertuples() for z in [zipfile.ZipFile(io.BytesIO(r.zip))] for name in z.namelist()]
        yield pd.DataFrame(rows, columns=["source", "part", "n_files", "raw_bytes", "name", "digest"])


@query("bundle_groups", """
  WITH files AS (
    SELECT source, lpad(doc_id::VARCHAR, 12, '0') || '.' || lang AS name, strlen(text) AS size, md5(text) AS digest FROM documents),
  placed AS (
    SELECT source, name, digest, size, coalesce(sum(size) OVER (PARTITION BY source ORDER BY name
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) // 65536 AS part FROM files)
  SELECT source, part::INTEGER AS part, count(*) OVER p AS n_files, (sum(size) OVER p)::BIGINT AS raw_bytes, name, digest
  FROM placed WINDOW p AS (PARTITION BY source, part)""")
def bundle_groups(spark, d):
    files = table(spark, d, "documents").select(
        "source", F.concat(F.lpad(F.col("doc_id").cast("string"), 12, "0"), F.lit("."), F.col("lang")).alias("name"),
        F.encode("text", "UTF-8").alias("content"))
    bundles = sinks.bundle_groups(files, "source", max_bytes=65536)
    return bundles.mapInPandas(unzip, "source string, part int, n_files bigint, raw_bytes bigint, name string, digest string")


@query("pending_uploads", with_sql(OBJECTS, DONE, select="""
  SELECT key, 'backup/' || key AS target_key FROM objects
  WHERE key LIKE '%.en' AND key NOT IN (SELECT key FROM done)"""))
def pending_uploads(spark, d):
    there = done_objects(spark, d).select(F.concat(F.lit("backup/"), F.col("key")).alias("key"))
    return listings.pending_uploads(objects(spark, d), there, "backup", ".en").select("key", "target_key")
