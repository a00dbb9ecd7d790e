"""Scalar functions and predicates."""

from __future__ import annotations

import pandas as pd
from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from checks.inputs import (IMAGES, MEDIA_PAGES, NAV_LINKS, OBJECTS, REPOS, media_pages, objects, repos,
                           table, with_sql)
from checks.registry import query
from gleaner.functions import blobs, names, predicates, retry, text, urls
from gleaner.operators import extract


@query("url_basename", "SELECT page_id, left(split_part(url, '/', -1), 255) AS name FROM pages")
def url_basename(spark, d):
    return table(spark, d, "pages").select("page_id", urls.url_basename(F.col("url")).alias("name"))


@query("url_basename_noquery",
       "SELECT page_id, split_part(split_part(url, '/', -1), '?', 1) AS name FROM pages")
def url_basename_noquery(spark, d):
    return table(spark, d, "pages").select("page_id", urls.url_basename_noquery(F.col("url")).alias("name"))


@query("item_name", "SELECT page_id, split_part(rtrim(url, '/'), '/', -1) AS name FROM pages")
def item_name(spark, d):
    return table(spark, d, "pages").select("page_id", urls.item_name(F.col("url")).alias("name"))


@query("object_key", "SELECT doc_id, 'raw/' || source || '/' || doc_id || '.' || lang AS key FROM documents")
def object_key(spark, d):
    name = F.concat_ws(".", F.col("doc_id").cast("string"), F.col("lang"))
    return table(spark, d, "documents").select(
        "doc_id", urls.object_key(F.lit("raw"), F.col("source"), name).alias("key"))


@query("file_stem", """
  WITH named AS (SELECT doc_id, 'v1.' || doc_id || '.' || lang AS name FROM documents)
  SELECT doc_id, regexp_replace(name, '\\.[^.]*$', '') AS stem, '.' || split_part(name, '.', -1) AS ext,
         split_part(name, '.', 1) AS first FROM named""")
def file_stem(spark, d):
    named = table(spark, d, "documents").select(
        "doc_id", F.format_string("v1.%d.%s", "doc_id", "lang").alias("name"))
    n = F.col("name")
    return named.select("doc_id", names.file_stem(n).alias("stem"), names.file_extension(n).alias("ext"),
                        names.name_before_first_dot(n).alias("first"))


@query("sanitize_filename", """
  SELECT conv_id, turn, replace(regexp_replace(text, '[^a-zA-Z0-9\\s]', '', 'g'), ' ', '_') || '.jpg' AS name
  FROM conversations""")
def sanitize_filename(spark, d):
    return table(spark, d, "conversations").select(
        "conv_id", "turn", names.sanitize_filename(F.col("text"), ".jpg").alias("name"))


@query("alt_token",
       "SELECT conv_id, turn, translate(coalesce(text, ''), ' /', '__') AS token FROM conversations")
def alt_token(spark, d):
    return table(spark, d, "conversations").select("conv_id", "turn", names.alt_token(F.col("text")).alias("token"))


@query("media_name", """
  SELECT p_partkey, 'image_' || p_size || '_' || replace(p_name, ' ', '_') || '.jpg' AS image,
         'video_' || p_size || '_' || replace(p_name, ' ', '_') || '.mp4' AS video,
         'image_' || p_size || '.jpg' AS plain FROM part""")
def media_name(spark, d):
    n, token = F.col("p_size"), names.alt_token(F.col("p_name"))
    return table(spark, d, "part").select(
        "p_partkey", names.media_name(n, token).alias("image"),
        names.media_name(n, token, "video", ".mp4").alias("video"), names.media_name(n).alias("plain"))


@query("md5_name",
       "SELECT page_id, 'image_' || (page_id + 1) || '_' || md5(url) || '.jpg' AS name FROM pages")
def md5_name(spark, d):
    return table(spark, d, "pages").select(
        "page_id", names.md5_name(F.col("page_id") + 1, F.col("url")).alias("name"))


@query("absolute_url", with_sql(NAV_LINKS, MEDIA_PAGES, """hrefs AS (
  SELECT page_id, pos, href, NULL AS resolved FROM nav
  UNION ALL SELECT page_id, -1, '/f/' || page_id || '.pdf', NULL FROM media_pages WHERE has_body
  UNION ALL SELECT page_id, -2, '../doc/' || n || '.txt',
    origin || CASE WHEN regexp_matches(url, '^[a-z]+://[^/]+/[a-z]+/[^/?#]*/')
                   THEN '/' || regexp_extract(url, '^[a-z]+://[^/]+/([a-z]+)/', 1) ELSE '' END
           || '/doc/' || n || '.txt' FROM media_pages WHERE has_body
  UNION ALL SELECT page_id, -3, '/p/' || n, NULL FROM media_pages WHERE has_body)""", select="""
  SELECT page_id, href,
    CASE WHEN href LIKE '/%' THEN origin || href ELSE href END AS rooted,
    CASE WHEN href LIKE 'http%' THEN href ELSE 'https://docs.example.org' || href END AS unless_http,
    'https://docs.example.org' || href AS always,
    coalesce(resolved, origin || href) AS resolved
  FROM hrefs JOIN media_pages USING (page_id)"""))
def absolute_url(spark, d):
    links = extract.extract_links(media_pages(spark, d))
    href, url, base = F.col("href"), F.col("url"), F.lit("https://docs.example.org")
    return links.select(
        "page_id", "href", urls.root_relative(url, href).alias("rooted"),
        urls.prefix_unless_http(base, href).alias("unless_http"),
        urls.prefix_always(base, href).alias("always"), urls.resolve_url(url, href).alias("resolved"))


@query("rewrite_url", "SELECT page_id, replace(url, 'page=2', 'page=1') AS url FROM pages")
def rewrite_url(spark, d):
    return table(spark, d, "pages").select(
        "page_id", urls.rewrite_url(F.col("url"), "page=2", "page=1").alias("url"))


@query("search_url", """
  SELECT p_partkey, 'https://img.example.org/s/' || replace(p_name, ' ', '%20') AS url,
         'https://img.example.org/s/' || replace(p_name, ' ', '%20') || '/?pagi=' || p_size AS paged FROM part""")
def search_url(spark, d):
    base, phrase = "https://img.example.org/s/", F.col("p_name")
    return table(spark, d, "part").select(
        "p_partkey", urls.search_url(base, phrase).alias("url"),
        urls.search_url(base, phrase, F.col("p_size"), "pagi", "/").alias("paged"))


@query("folder_token", "SELECT p_partkey, replace(trim(' ' || p_name || '  '), ' ', '_') AS folder FROM part")
def folder_token(spark, d):
    padded = F.concat(F.lit(" "), F.col("p_name"), F.lit("  "))
    return table(spark, d, "part").select("p_partkey", urls.folder_token(padded).alias("folder"))


@query("media_src", with_sql(MEDIA_PAGES, IMAGES, select="""
  SELECT page_id, CAST(pos AS BIGINT) AS pos, coalesce(nullif(src, ''), nullif(data_src, '')) AS media_url FROM images"""))
def media_src(spark, d):
    images = extract.extract_images(media_pages(spark, d))
    return images.select("page_id", F.col("pos").cast("bigint").alias("pos"),
                         names.media_src(F.col("src"), F.col("data_src")).alias("media_url"))


@query("word_count", """
  SELECT doc_id, len(list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '')) AS words FROM documents""")
def word_count(spark, d):
    return table(spark, d, "documents").select(
        "doc_id", text.word_count(F.col("text")).cast("bigint").alias("words"))


def _gzip():
    @F.pandas_udf("binary")
    def compress(value: pd.Series) -> pd.Series:
        import gzip
        return value.map(lambda t: gzip.compress(t.encode("utf-8"), compresslevel=1))

    return compress


def gzip_store(spark, d):
    """The documents as a blob table: id and gzip payload."""
    return table(spark, d, "documents").select("doc_id", _gzip()(F.col("text")).alias("content"))


@query("decode_blob", """
  SELECT doc_id, text, len(list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '')) AS word_count,
         'ok' AS status FROM documents""")
def decode_blob(spark, d):
    store = gzip_store(spark, d).withColumn("src_encoding", F.lit("utf-8"))
    out = blobs.with_decoded(store)
    return out.select("doc_id", "text", F.col("word_count").cast("bigint").alias("word_count"), "status")


@query("decode_or_empty", """
  SELECT d.doc_id, CASE WHEN l.doc_id IS NULL THEN '' ELSE text END AS text,
         CASE WHEN l.doc_id IS NULL THEN 0
              ELSE len(list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '')) END AS word_count,
         CASE WHEN l.doc_id IS NULL THEN 'failed' ELSE 'ok' END AS status,
         CASE WHEN l.doc_id IS NULL THEN 'missing' END AS error
  FROM documents d LEFT JOIN labels l USING (doc_id)""")
def decode_or_empty(spark, d):
    from gleaner.sources.blobs import enrich
    stored = gzip_store(spark, d).join(table(spark, d, "labels").select("doc_id"), "doc_id", "left_semi")
    meta = table(spark, d, "documents").select("doc_id", F.lit("utf-8").alias("src_encoding"))
    # A store that holds every blob twice gives no row twice.
    stored = stored.withColumn("path", F.explode(F.array(F.lit("a"), F.lit("b"))))
    out = enrich(meta, stored, "doc_id")
    return out.select("doc_id", "text", F.col("word_count").cast("bigint").alias("word_count"), "status", "error")


@query("page_count", """
  SELECT l_suppkey, count(*) AS total, CAST(least(ceil(count(*) / 100.0), 10) AS BIGINT) AS pages
  FROM lineitem GROUP BY l_suppkey""")
def page_count(spark, d):
    totals = table(spark, d, "lineitem").groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("total"))
    return totals.withColumn("pages", retry.page_count(F.col("total")))


@query("backoff_seconds", """
  SELECT l_orderkey, l_linenumber, pow(2, l_linenumber) AS base,
         CAST('0x' || substr(md5(concat_ws('|', l_orderkey, l_linenumber)), 1, 6) AS BIGINT) % 1001 / 1000.0::DOUBLE AS jitter,
         CASE WHEN l_returnflag = 'R' THEN 300.0::DOUBLE ELSE 2.0::DOUBLE END AS pause FROM lineitem""")
def backoff_seconds(spark, d):
    jitter = retry.jitter_seconds(F.col("l_orderkey"), F.col("l_linenumber"))
    status = F.when(F.col("l_returnflag") == "R", 403).otherwise(500)
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", retry.backoff_seconds(F.col("l_linenumber")).alias("base"),
        jitter.alias("jitter"), retry.pause_after(status).alias("pause"))


@query("stamp", "SELECT lang, count(*) AS n, 1::BIGINT AS stamps, count(*) AS recent FROM documents GROUP BY lang")
def stamp(spark, d):
    """One time for all rows of a query, and that of the run."""
    begun = F.lit(datetime.now(timezone.utc) - timedelta(minutes=5))
    stamped = table(spark, d, "documents").select("lang", retry.stamp().alias("at"))
    return stamped.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("at").alias("stamps"),
                                       F.count_if(F.col("at") > begun).alias("recent"))


# --- predicates ---------------------------------------------------------------

@query("keep_suffix", with_sql(OBJECTS, select="SELECT key, size FROM objects WHERE key LIKE '%.en' OR key LIKE '%.fr'"))
def keep_suffix(spark, d):
    return objects(spark, d).filter(predicates.has_suffix(F.col("key"), ".en", ".fr")).select("key", "size")


@query("drop_containing", with_sql(OBJECTS, select="SELECT key, size FROM objects WHERE key NOT LIKE '%/src1%'"))
def drop_containing(spark, d):
    return objects(spark, d).filter(predicates.lacks(F.col("key"), "/src1")).select("key", "size")


@query("valid_media_url", with_sql(MEDIA_PAGES, IMAGES, select="""
  SELECT host, count(*) FILTER (media_url LIKE 'http%') AS valid,
         count(*) FILTER (coalesce(media_url, '') NOT LIKE 'http%') AS rejected FROM images GROUP BY host"""))
def valid_media_url(spark, d):
    ok = predicates.valid_media_url(F.col("media_url"))
    return extract.extract_images(media_pages(spark, d)).groupBy("host").agg(
        F.count_if(ok).alias("valid"), F.count_if(~ok).alias("rejected"))


@query("anchor_text_filter", with_sql(MEDIA_PAGES, NAV_LINKS, select="""
  SELECT page_id, href FROM nav WHERE contains(text, 'PDF')
  UNION ALL SELECT page_id, '/f/' || page_id || '.pdf' FROM media_pages WHERE has_body"""))
def anchor_text_filter(spark, d):
    links = extract.extract_links(media_pages(spark, d))
    return links.filter(predicates.anchor_text_contains(F.col("text"))).select("page_id", "href")


@query("href_filter", with_sql(MEDIA_PAGES, NAV_LINKS, select="""
  SELECT page_id, href FROM nav WHERE contains(href, '.pdf')
  UNION ALL SELECT page_id, '/f/' || page_id || '.pdf' FROM media_pages WHERE has_body"""))
def href_filter(spark, d):
    links = extract.extract_links(media_pages(spark, d))
    return links.filter(predicates.href_contains(F.col("href"))).select("page_id", "href")


@query("class_filter", with_sql(MEDIA_PAGES, IMAGES, select="""
  SELECT page_id, CAST(pos AS BIGINT) AS pos, list_contains(string_split(class, ' '), 'thumb') AS token_match,
         class = 'thumb wide' AS exact_match FROM images"""))
def class_filter(spark, d):
    images = extract.extract_images(media_pages(spark, d))
    return images.select(
        "page_id", F.col("pos").cast("bigint").alias("pos"),
        predicates.class_matches(F.col("class"), "thumb").alias("token_match"),
        predicates.class_matches(F.col("class"), "thumb wide").alias("exact_match"))


@query("no_results_page", """
  SELECT page_id, regexp_matches(html, '(^|>)The(<|$)') AS no_results FROM pages""")
def no_results_page(spark, d):
    return table(spark, d, "pages").select(
        "page_id", predicates.has_text_node(F.col("html"), "The").alias("no_results"))


@query("repo_filter", with_sql(REPOS, select="SELECT * FROM repos WHERE size BETWEEN 11 AND 21 AND stars > 950"))
def repo_filter(spark, d):
    return repos(spark, d).filter(predicates.repo_in_range(F.col("size"), F.col("stars"), 11, 21, 950))


@query("anchor_text_equals", with_sql(NAV_LINKS, select="""
  SELECT page_id, CAST(pos AS BIGINT) AS pos, href FROM nav WHERE trim(text) = 'The'
  QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY pos) = 1"""))
def anchor_text_equals(spark, d):
    first = extract.first_link_with_text(table(spark, d, "pages"), "The")
    return first.select("page_id", F.col("pos").cast("bigint").alias("pos"), "href")
