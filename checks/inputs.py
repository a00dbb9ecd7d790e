"""Inputs that the queries derive from the given tables, and the same as SQL.

Each derivation reads a whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- object listing: one object per document ---------------------------------

def objects(spark, d) -> DataFrame:
    docs = table(spark, d, "documents")
    return docs.select(
        F.format_string("raw/%s/%d.%s", "source", "doc_id", "lang").alias("key"),
        F.col("source").alias("folder"), F.col("n_chars").alias("size"), "doc_id", "lang")


OBJECTS = """objects AS (
  SELECT 'raw/' || source || '/' || doc_id || '.' || lang AS key, source AS folder,
         n_chars AS size, doc_id, lang FROM documents)"""


# --- what is already there: one object per labelled document -----------------

def done_objects(spark, d) -> DataFrame:
    labels = table(spark, d, "labels")
    return objects(spark, d).join(labels, "doc_id").select(
        F.format_string("out/%s/%d.%s", "lang", "doc_id", "lang").alias("done_key"),
        "key", "doc_id", "quality",
        F.when(F.col("quality") == 1, F.col("size"))
        .otherwise(F.floor(F.col("size") / 2)).cast("bigint").alias("size"))


DONE = """done AS (
  SELECT 'out/' || lang || '/' || doc_id || '.' || lang AS done_key, key, doc_id, quality,
         CASE WHEN quality = 1 THEN size ELSE size // 2 END AS size
  FROM objects JOIN labels USING (doc_id))"""


# --- landed pages with media: the driver's pages plus links, images, a video --

def media_pages(spark, d) -> DataFrame:
    pages = table(spark, d, "pages")
    n = F.regexp_extract("url", "/([0-9]+)", 1)
    extra = F.concat(
        F.lit('<div class="entry"><div class="row wide"><a href="/f/'), F.col("page_id").cast("string"),
        F.lit('.pdf">PDF '), F.col("page_id").cast("string"),
        F.lit('</a></div><a href="../doc/'), n, F.lit('.txt">TXT '), n, F.lit("</a></div>"),
        F.lit('<a class="card link" href="/p/'), n,
        F.lit('"><img class="thumb wide" src="https://cdn.example.org/'), n,
        F.lit('.jpg?w=gi" alt="a/b '), n, F.lit('"></a>'),
        F.lit('<img class="thumb" src="" data-src="/rel/'), F.col("page_id").cast("string"), F.lit('.png">'),
        F.lit('<video class="clip" src="https://cdn.example.org/'), n, F.lit('.mp4" alt="v '), n,
        F.lit('"></video></body>'))
    return pages.withColumns({
        "html": F.replace("html", F.lit("</body>"), extra),
        "host": F.regexp_extract("url", "://([^/]+)", 1),
    })


# The twin needs no HTML: what was added is known, page by page.
MEDIA_PAGES = """media_pages AS (
  SELECT page_id, url, html, regexp_extract(url, '://([^/]+)', 1) AS host,
         regexp_extract(url, '/([0-9]+)', 1) AS n,
         regexp_extract(url, '^([a-z]+://[^/]+)', 1) AS origin,
         contains(html, '</body>') AS has_body
  FROM pages)"""

NAV_LINKS = """cleaned AS (
  SELECT page_id, url, regexp_replace(html,
         '(?is)<!--.*?-->|<script[^>]*>.*?</script>|<style[^>]*>.*?</style>', '', 'g') AS html
  FROM pages),
nav_lists AS (
  SELECT page_id, url,
         regexp_extract_all(html, '(?is)<a[^>]*\\shref="([^"]*)"[^>]*>(.*?)</a>', 1) AS hrefs,
         regexp_extract_all(html, '(?is)<a[^>]*\\shref="([^"]*)"[^>]*>(.*?)</a>', 2) AS texts
  FROM cleaned),
nav AS (
  SELECT page_id, url, unnest(generate_series(0, len(hrefs) - 1)) AS pos,
         replace(unnest(hrefs), '&amp;', '&') AS href, replace(unnest(texts), '&amp;', '&') AS text
  FROM nav_lists)"""

IMAGES = """images AS (
  SELECT page_id, url, host, 0 AS pos, 'https://cdn.example.org/' || n || '.jpg?w=gi' AS src,
         NULL AS data_src, 'a/b ' || n AS alt, 'thumb wide' AS class,
         'https://cdn.example.org/' || n || '.jpg?w=gi' AS media_url
  FROM media_pages WHERE has_body
  UNION ALL
  SELECT page_id, url, host, 1, '', '/rel/' || page_id || '.png', NULL, 'thumb', '/rel/' || page_id || '.png'
  FROM media_pages WHERE has_body)"""


# --- event log: a user fetches links (the key in props) ----------------------

def link_log(spark, d) -> DataFrame:
    events = table(spark, d, "events")
    kind = F.col("event_type")
    return events.select(
        F.col("user_id").alias("item"),
        F.get_json_object("props", "$.k").alias("link"),
        F.when(kind == "error", "failed").when(kind == "purchase", "success")
        .otherwise("started").alias("status"),
        F.floor(F.col("value") * 100).cast("bigint").alias("size"),
        "ts", F.col("event_id").alias("seq"))


LINK_LOG = """link_log AS (
  SELECT user_id AS item, json_extract_string(props, '$.k') AS link,
         CASE event_type WHEN 'error' THEN 'failed' WHEN 'purchase' THEN 'success' ELSE 'started' END AS status,
         CAST(floor(value * 100) AS BIGINT) AS size, ts, event_id AS seq
  FROM events)"""

LATEST = LINK_LOG + """,
latest AS (
  SELECT * FROM link_log QUALIFY row_number() OVER (PARTITION BY item, link ORDER BY ts DESC, seq DESC) = 1)"""


def run_log(spark, d) -> DataFrame:
    """The same log in the words of a run: started, completed, failed."""
    log = link_log(spark, d)
    return log.withColumn("status", F.when(F.col("status") == "success", "completed").otherwise(F.col("status")))


RUN_LOG = LINK_LOG + """,
run_log AS (
  SELECT * REPLACE (CASE WHEN status = 'success' THEN 'completed' ELSE status END AS status) FROM link_log)"""


# --- repositories ------------------------------------------------------------

def repos(spark, d) -> DataFrame:
    return table(spark, d, "part").select(
        F.concat_ws("/", F.col("p_brand"), F.replace("p_name", F.lit(" "), F.lit("-"))).alias("name"),
        F.floor("p_retailprice").cast("bigint").alias("stars"),
        F.col("p_size").cast("bigint").alias("size"),
        F.nullif(F.col("p_type"), F.lit("ECONOMY")).alias("lang"),
        F.col("p_partkey").alias("pos"))


REPOS = """repos AS (
  SELECT p_brand || '/' || replace(p_name, ' ', '-') AS name, CAST(floor(p_retailprice) AS BIGINT) AS stars,
         CAST(p_size AS BIGINT) AS size, nullif(p_type, 'ECONOMY') AS lang, p_partkey AS pos
  FROM part)"""


def utc_text(column: str):
    """Time stamp as text; independent of client types."""
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def sql_text(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S.%f')"


def with_sql(*parts: str, select: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n" + select
