"""Extraction, joins, numbering and duplicate removal."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.inputs import (DONE, IMAGES, LATEST, MEDIA_PAGES, NAV_LINKS, OBJECTS, REPOS, done_objects,
                           link_log, media_pages, objects, repos, sql_text, table, utc_text, with_sql)
from checks.registry import query
from gleaner.operators import dedup, extract, joins, ledger, numbering
from gleaner.session import stage


def _long(*columns):
    return [F.col(c).cast("bigint").alias(c) for c in columns]


# --- extraction ----------------------------------------------------------------

@query("extract_links", with_sql(NAV_LINKS, select="SELECT page_id, CAST(pos AS BIGINT) AS pos, href, text FROM nav"))
def extract_links(spark, d):
    links = extract.extract_links(table(spark, d, "pages"))
    return links.select("page_id", *_long("pos"), "href", "text")


@query("extract_links_entities", with_sql(MEDIA_PAGES, select="""
  SELECT page_id, '/e?x=1&y=2&z=\u00e9' AS href, 'caf\u00e9 \u20ac \u2209 \u00a9 ' || page_id AS text
  FROM media_pages WHERE has_body"""))
def extract_links_entities(spark, d):
    added = F.concat(F.lit('<a href="/e?x=1&#38;y=2&#x26;z=&eacute;">caf&eacute; &#8364; &notin; &copy '),
                     F.col("page_id").cast("string"), F.lit("</a></body>"))
    pages = table(spark, d, "pages").withColumn("html", F.replace("html", F.lit("</body>"), added))
    return extract.extract_links(pages).filter(F.col("href").startswith("/e?")).select("page_id", "href", "text")


@query("extract_links_scoped", with_sql(MEDIA_PAGES, select="""
  SELECT 'row' AS scope, page_id, 0::BIGINT AS pos, '/f/' || page_id || '.pdf' AS href, 'PDF ' || page_id AS text
  FROM media_pages WHERE has_body
  UNION ALL SELECT 'entry', page_id, 0, '/f/' || page_id || '.pdf', 'PDF ' || page_id FROM media_pages WHERE has_body
  UNION ALL SELECT 'entry', page_id, 1, '../doc/' || n || '.txt', 'TXT ' || n FROM media_pages WHERE has_body"""))
def extract_links_scoped(spark, d):
    pages = media_pages(spark, d).select("page_id", "html")
    row = extract.scoped_links(pages, "row").withColumn("scope", F.lit("row"))
    entry = extract.scoped_links(pages, "entry", tag="div", first_only=True).withColumn("scope", F.lit("entry"))
    return row.unionByName(entry).select("scope", "page_id", *_long("pos"), "href", "text")


@query("extract_doc_links", with_sql(MEDIA_PAGES, select="""
  SELECT page_id, '/f/' || page_id || '.pdf' AS href,
         'https://docs.example.org/f/' || page_id || '.pdf' AS doc_url FROM media_pages WHERE has_body"""))
def extract_doc_links(spark, d):
    links = extract.extract_doc_links(media_pages(spark, d), "https://docs.example.org", ".pdf")
    return links.select("page_id", "href", "doc_url")


@query("extract_images", with_sql(MEDIA_PAGES, IMAGES, select="""
  SELECT page_id, CAST(pos AS BIGINT) AS pos, src, data_src, alt, class, media_url FROM images"""))
def extract_images(spark, d):
    images = extract.extract_images(media_pages(spark, d))
    return images.select("page_id", *_long("pos"), "src", "data_src", "alt", "class", "media_url")


@query("extract_linked_images", with_sql(MEDIA_PAGES, select="""
  SELECT page_id, 'https://cdn.example.org/' || n || '.jpg?w=gi' AS media_url, 'a/b ' || n AS alt
  FROM media_pages WHERE has_body"""))
def extract_linked_images(spark, d):
    found = extract.extract_linked_images(media_pages(spark, d), "card", F.col("url"))
    return found.select("page_id", "media_url", "alt")


@query("extract_videos", with_sql(MEDIA_PAGES, select="""
  SELECT page_id, 'https://cdn.example.org/' || n || '.mp4' AS src, 'v ' || n AS alt
  FROM media_pages WHERE has_body"""))
def extract_videos(spark, d):
    return extract.extract_videos(media_pages(spark, d), "clip").select("page_id", "src", "alt")


@query("page_signature", with_sql(MEDIA_PAGES, select="""
  SELECT page_id, CASE WHEN has_body THEN 2 ELSE 0 END::BIGINT AS n_images,
         md5(CASE WHEN has_body THEN '["https://cdn.example.org/' || n || '.jpg?w=gi",""]' ELSE '[]' END) AS signature
  FROM media_pages"""))
def page_signature(spark, d):
    return extract.page_signature(media_pages(spark, d)).select("page_id", "n_images", "signature")


# --- joins ----------------------------------------------------------------------

@query("join_content", """
  SELECT d.doc_id, d.lang, CASE WHEN l.doc_id IS NULL THEN 'missing' ELSE 'ok' END AS status,
         CASE WHEN l.doc_id IS NULL THEN '' ELSE text END AS text,
         CASE WHEN l.doc_id IS NULL THEN 0
              ELSE len(list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '')) END AS word_count
  FROM documents d LEFT JOIN labels l USING (doc_id)""")
def join_content(spark, d):
    docs = table(spark, d, "documents")
    content = docs.join(table(spark, d, "labels"), "doc_id", "left_semi").select("doc_id", "text")
    # The store holds labelled documents, each twice: rows out stay rows in.
    joined = joins.join_content(docs.select("doc_id", "lang"), content.unionByName(content), "doc_id")
    return joined.withColumn("word_count", F.col("word_count").cast("bigint"))


@query("todo_by_basename", with_sql(OBJECTS, DONE, select="""
  SELECT key, size FROM objects WHERE split_part(key, '/', -1) NOT IN (SELECT split_part(done_key, '/', -1) FROM done)"""))
def todo_by_basename(spark, d):
    done = done_objects(spark, d)
    return joins.todo_by_basename(objects(spark, d), done, F.col("key"), F.col("done_key")).select("key", "size")


@query("todo_by_key", with_sql(OBJECTS, DONE, select="SELECT key, size FROM objects ANTI JOIN done USING (key)"))
def todo_by_key(spark, d):
    return joins.todo_by_key(objects(spark, d), done_objects(spark, d)).select("key", "size")


@query("already_done", with_sql(OBJECTS, DONE, select="SELECT key, size FROM objects SEMI JOIN done USING (key)"))
def already_done(spark, d):
    return joins.already_done(objects(spark, d), done_objects(spark, d)).select("key", "size")


@query("skip_report", with_sql(OBJECTS, DONE, select="""
  SELECT folder, count(*) AS n_all, count(d.key) AS n_done, count(*) - count(d.key) AS n_todo
  FROM objects o LEFT JOIN done d USING (key) GROUP BY folder"""))
def skip_report(spark, d):
    return joins.skip_report(objects(spark, d), done_objects(spark, d), ["folder"])


RESUME = """plan AS (
  SELECT o.key, o.size, CASE WHEN coalesce(d.size, 0) = o.size THEN 'done' WHEN d.size IS NULL THEN 'new'
         WHEN d.size < o.size THEN 'resume' ELSE 'restart' END AS state, coalesce(d.size, 0) AS start_at
  FROM objects o LEFT JOIN done d USING (key))"""


@query("resume_plan", with_sql(OBJECTS, DONE, RESUME, select="SELECT * FROM plan"))
def resume_plan(spark, d):
    source = objects(spark, d).select("key", "size")
    return joins.resume_plan(source, done_objects(spark, d)).select("key", "size", "state", "start_at")


@query("byte_ranges", with_sql(OBJECTS, DONE, RESUME, """ranges AS (
  SELECT key, size, unnest(range(start_at, size, 1024)) AS range_start FROM plan WHERE start_at < size)""", select="""
  SELECT key, range_start, least(range_start + 1023, size - 1) AS range_end FROM ranges"""))
def byte_ranges(spark, d):
    plan = joins.resume_plan(objects(spark, d).select("key", "size"), done_objects(spark, d))
    return joins.byte_ranges(plan, 1024).select("key", "range_start", "range_end")


@query("size_windows", with_sql(REPOS, """windows AS (
  SELECT i * 11 AS window_low, greatest(i * 11 + 1, least(100, i * 11 + 10)) AS window_high
  FROM range(0, 10) t(i) WHERE i * 11 < 100)""", select="""
  SELECT pos, size, window_low, window_high FROM repos JOIN windows ON size BETWEEN window_low AND window_high"""))
def size_windows(spark, d):
    return joins.size_windows(repos(spark, d), F.col("size")).select("pos", "size", "window_low", "window_high")


@query("seed_pages", """
  SELECT s_suppkey, 'Supplier' AS term, unnest(range(1, 4)) AS page_no, source
  FROM supplier, (VALUES ('web'), ('archive')) t(source)""")
def seed_pages(spark, d):
    seeds = table(spark, d, "supplier").select("s_suppkey", F.substring_index("s_name", "#", 1).alias("term"))
    return joins.seed_sources(joins.seed_pages(seeds, 3), ["web", "archive"])


@query("failed_links", with_sql(LATEST, select="""
  SELECT DISTINCT l.item, l.link FROM link_log l JOIN latest s USING (item, link) WHERE s.status = 'failed'"""))
def failed_links(spark, d):
    log = link_log(spark, d)
    status = ledger.latest_status(log, ["item", "link"], ["ts", "seq"])
    return joins.failed_links(log.select("item", "link").distinct(), status, ["item", "link"])


# --- numbering ------------------------------------------------------------------

@query("media_number", with_sql(MEDIA_PAGES, IMAGES, select="""
  SELECT host, page_id, CAST(pos AS BIGINT) AS pos,
         row_number() OVER (PARTITION BY host ORDER BY page_id, pos) - 1 AS number FROM images"""))
def media_number(spark, d):
    images = stage(extract.extract_images(media_pages(spark, d)).select("host", "page_id", "pos"), "images")
    numbered = numbering.number_rows(images, ["host"], ["page_id", "pos"], "number")
    return numbered.select("host", "page_id", *_long("pos"), "number")


@query("media_number_null_groups", """
  SELECT g, h, o_orderkey, row_number() OVER w - 1 AS number, coalesce(sum(price) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING
    AND 1 PRECEDING), 0)::DOUBLE AS before
  FROM (SELECT CASE WHEN o_custkey < 300 THEN o_orderstatus END AS g, CASE WHEN o_orderkey < 9000 THEN o_orderpriority END AS h,
               o_orderkey, o_totalprice::DECIMAL(12, 2) AS price FROM orders) WINDOW w AS (PARTITION BY g, h ORDER BY o_orderkey)""")
def media_number_null_groups(spark, d):
    orders = table(spark, d, "orders").select(
        F.when(F.col("o_custkey") < 300, F.col("o_orderstatus")).alias("g"),
        F.when(F.col("o_orderkey") < 9000, F.col("o_orderpriority")).alias("h"),
        "o_orderkey", F.col("o_totalprice").cast("decimal(12,2)").alias("price"))
    numbered = numbering.running_total(orders, ["g", "h"], ["o_orderkey"], F.col("price"), "before")
    numbered = numbering.number_rows(numbered, ["g", "h"], ["o_orderkey"], "number")
    return numbered.select("g", "h", "o_orderkey", "number", F.col("before").cast("double").alias("before"))


@query("cap_per_group", """
  SELECT o_custkey, o_orderkey, o_totalprice FROM orders
  QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) <= 3""")
def cap_per_group(spark, d):
    orders = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return numbering.cap_per_group(orders, ["o_custkey"], ["o_orderkey"], 3)


@query("upload_batches", """
  SELECT l_suppkey, l_orderkey, l_linenumber,
         (row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey) - 1) // 100 AS batch
  FROM lineitem""")
def upload_batches(spark, d):
    lines = table(spark, d, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey")
    batched = numbering.upload_batches(lines, ["l_suppkey"], ["l_orderkey", "l_linenumber", "l_partkey"], 100)
    return batched.drop("l_partkey")


@query("rate_budget", f"""
  SELECT event_id, slot, {sql_text("TIMESTAMP '2024-02-01' + to_seconds(slot * 60)")} AS not_before
  FROM (SELECT event_id, (row_number() OVER (ORDER BY ts, event_id) - 1) // 30 AS slot FROM events)""")
def rate_budget(spark, d):
    events = table(spark, d, "events").select("event_id", "ts")
    start = F.lit("2024-02-01").cast("timestamp_ntz")
    budget = numbering.rate_budget(events, ["ts", "event_id"], start)
    return budget.select("event_id", "slot", utc_text("not_before").alias("not_before"))


@query("work_chunks", with_sql(OBJECTS, select="""
  SELECT key, ntile(7) OVER (ORDER BY doc_id) AS chunk FROM objects"""))
def work_chunks(spark, d):
    chunks = numbering.work_chunks(objects(spark, d), ["doc_id"], 7)
    return chunks.select("key", "chunk")


@query("stop_at_repeat", with_sql(MEDIA_PAGES, """signed AS (
  SELECT host, page_id, has_body, CASE WHEN has_body THEN n ELSE '' END AS signature FROM media_pages),
flagged AS (
  SELECT host, page_id, NOT has_body OR coalesce(signature = lag(signature) OVER w, FALSE) AS stop
  FROM signed WINDOW w AS (PARTITION BY host ORDER BY page_id))""", select="""
  SELECT host, page_id FROM (
    SELECT host, page_id, max(stop::INT) OVER (PARTITION BY host ORDER BY page_id) AS stopped FROM flagged)
  WHERE stopped = 0"""))
def stop_at_repeat(spark, d):
    pages = stage(extract.page_signature(media_pages(spark, d)), "signatures")
    kept = numbering.stop_at_repeat(pages, ["host"], ["page_id"], "signature", "n_images")
    return kept.select("host", "page_id")


@query("sorted_keys", with_sql(OBJECTS, select="SELECT key FROM objects ORDER BY key"))
def sorted_keys(spark, d):
    return numbering.sorted_keys(objects(spark, d).select("key"), "key")


@query("key_slice", with_sql(OBJECTS, select="SELECT key FROM objects ORDER BY key LIMIT 90 OFFSET 270"))
def key_slice(spark, d):
    return numbering.key_slice(objects(spark, d).select("key"), ["key"], 270, 360)


@query("first_repos", with_sql(REPOS, select="SELECT name, stars, lang FROM repos ORDER BY pos LIMIT 10"))
def first_repos(spark, d):
    return numbering.first_rows(repos(spark, d), ["pos"], 10).select("name", "stars", "lang")


# --- duplicates -----------------------------------------------------------------

@query("distinct_repos", with_sql(REPOS, select="SELECT DISTINCT name, lang FROM repos"))
def distinct_repos(spark, d):
    return dedup.distinct_rows(repos(spark, d).select("name", "lang"))


@query("dedup_urls", with_sql(MEDIA_PAGES, IMAGES, select="""
  SELECT host, media_url, page_id, CAST(pos AS BIGINT) AS pos, alt FROM images
  QUALIFY row_number() OVER (PARTITION BY host, media_url ORDER BY page_id, pos) = 1"""))
def dedup_urls(spark, d):
    images = extract.extract_images(media_pages(spark, d)).select("host", "media_url", "page_id", "pos", "alt")
    first = dedup.first_seen(images, ["host", "media_url"], ["page_id", "pos"])
    return first.withColumn("pos", F.col("pos").cast("bigint"))


@query("dedup_seeds", "SELECT p_name AS term, min(p_partkey) AS position FROM part GROUP BY p_name")
def dedup_seeds(spark, d):
    padded = F.concat(F.lit(" "), F.col("p_name"))
    return dedup.dedup_seeds(table(spark, d, "part"), padded, F.col("p_partkey"))


@query("union_chunks", """
  SELECT doc_id AS id, text, lang FROM documents UNION ALL SELECT item_id, text, NULL FROM benchmark""")
def union_chunks(spark, d):
    return dedup.union_chunks(
        table(spark, d, "documents").select(F.col("doc_id").alias("id"), "text", "lang"),
        table(spark, d, "benchmark").select(F.col("item_id").alias("id"), "text"))


@query("key_collisions", with_sql(REPOS, select="""
  SELECT split_part(name, '/', -1) AS repo, count(*) AS n_rows FROM repos GROUP BY 1 HAVING count(*) > 1"""))
def key_collisions(spark, d):
    named = repos(spark, d).select(F.substring_index("name", "/", -1).alias("repo"))
    return dedup.key_collisions(named, ["repo"])


@query("media_number_desc", """
  SELECT l_suppkey, l_orderkey, l_linenumber, l_partkey, row_number() OVER (PARTITION BY l_suppkey
    ORDER BY l_orderkey DESC, l_linenumber DESC, l_partkey DESC) - 1 AS number FROM lineitem""")
def media_number_desc(spark, d):
    lines = table(spark, d, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey")
    order = [F.col(c).desc() for c in ("l_orderkey", "l_linenumber", "l_partkey")]
    return numbering.number_rows(lines, ["l_suppkey"], order, "number")


@query("work_chunks_nulls", """
  SELECT doc_id, part, ntile(7) OVER (ORDER BY part NULLS FIRST, doc_id) AS chunk
  FROM (SELECT doc_id, CASE WHEN doc_id % 3 <> 0 THEN doc_id % 10 END AS part FROM documents)""")
def work_chunks_nulls(spark, d):
    docs = table(spark, d, "documents").select(
        "doc_id", F.when(F.col("doc_id") % 3 != 0, F.col("doc_id") % 10).alias("part"))
    return numbering.work_chunks(docs, ["part", "doc_id"], 7)
