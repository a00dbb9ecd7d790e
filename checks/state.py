"""Aggregations, ledger, streams and the composed plans."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.inputs import (DONE, IMAGES, LATEST, MEDIA_PAGES, NAV_LINKS, OBJECTS, REPOS, RUN_LOG, done_objects,
                           link_log, media_pages, objects, repos, run_log, sql_text, table, utc_text, with_sql)
from checks.registry import query
from gleaner.functions import names
from gleaner.operators import aggregate, ledger
from gleaner.plans import archive, catalogue, content, copy, harvest, media
from gleaner.operators.dedup import first_seen
from gleaner.operators.extract import extract_images
from gleaner.session import fresh_dir, stage
from gleaner.sources import manifests, sinks
from gleaner.streaming import bounded, ingest, merge, timers
from gleaner.streaming import state as live

# --- aggregations ---------------------------------------------------------------

@query("folder_stats", """
  SELECT l_suppkey, count(*) AS total_count, sum(l_quantity)::BIGINT AS total_size FROM lineitem GROUP BY l_suppkey""")
def folder_stats(spark, d):
    listing = table(spark, d, "lineitem").select("l_suppkey", F.col("l_quantity").cast("bigint").alias("size"))
    return aggregate.folder_stats(listing, "l_suppkey", "size")


SUMMARY = f"""
  SELECT item, count(*) AS total_links, count(*) FILTER (status = 'success') AS total_files,
         count(*) FILTER (status = 'failed') AS failed_files,
         coalesce(sum(size) FILTER (status = 'success'), 0)::BIGINT AS folder_size,
         {sql_text('min(ts)')} AS start_time, {sql_text('max(ts)')} AS end_time
  FROM latest GROUP BY item"""


@query("item_summary", with_sql(LATEST, select=SUMMARY))
def item_summary(spark, d):
    latest = ledger.latest_status(link_log(spark, d), ["item", "link"], ["ts", "seq"])
    return aggregate.item_summary(latest, ["item"]).withColumns(
        {"start_time": utc_text("start_time"), "end_time": utc_text("end_time")})


@query("link_lists", with_sql(LATEST, """numbered AS (
  SELECT *, (row_number() OVER (PARTITION BY item ORDER BY link) - 1) // 20 AS chunk FROM latest)""", select="""
  SELECT item, chunk, string_agg(link, ',' ORDER BY link) AS download_links,
         coalesce(string_agg(link, ',' ORDER BY link) FILTER (status = 'failed'), '') AS failed_links
  FROM numbered GROUP BY item, chunk"""))
def link_lists(spark, d):
    latest = ledger.latest_status(link_log(spark, d), ["item", "link"], ["ts", "seq"])
    lists = aggregate.link_lists(latest, ["item"], ["link"], "link", size=20)
    return lists.withColumns({c: F.array_join(c, ",") for c in ("download_links", "failed_links")})


NESTED = """first AS (
  SELECT * FROM images QUALIFY row_number() OVER (PARTITION BY host, media_url ORDER BY page_id, pos) = 1),
numbered AS (
  SELECT *, (row_number() OVER (PARTITION BY host ORDER BY page_id, pos) - 1) // 3 AS chunk FROM first)"""


def unique_images(spark, d):
    images = extract_images(media_pages(spark, d)).select("host", "media_url", "page_id", "pos", "alt")
    return stage(first_seen(images, ["host", "media_url"], ["page_id", "pos"]), "images")


@query("folder_documents", with_sql(MEDIA_PAGES, IMAGES, NESTED, select="""
  SELECT host, chunk, count(*) AS n,
         string_agg(media_url || '#' || coalesce(alt, ''), '|' ORDER BY page_id, pos) AS images
  FROM numbered GROUP BY host, chunk"""))
def folder_documents(spark, d):
    docs = aggregate.folder_documents(unique_images(spark, d), ["host"], ["page_id", "pos"], ["media_url", "alt"], size=3)
    flat = F.transform("images", lambda r: F.concat(r["media_url"], F.lit("#"), F.coalesce(r["alt"], F.lit(""))))
    return docs.select("host", "chunk", F.size("images").cast("bigint").alias("n"),
                       F.array_join(flat, "|").alias("images"))


@query("keyword_documents", with_sql(MEDIA_PAGES, IMAGES, NESTED, select="""
  SELECT host, chunk, string_agg(media_url, '|' ORDER BY page_id, pos) AS links,
         string_agg(coalesce(alt, '-'), '|' ORDER BY page_id, pos) AS alts
  FROM numbered GROUP BY host, chunk"""))
def keyword_documents(spark, d):
    docs = aggregate.keyword_documents(unique_images(spark, d), ["host"], ["page_id", "pos"], "media_url", "alt", size=3)
    return docs.select("host", "chunk", F.array_join("links", "|").alias("links"),
                       F.array_join("alts", "|", "-").alias("alts"))


@query("progress_counts", with_sql(RUN_LOG, select="""
  SELECT item, count(*) AS total, count(*) FILTER (status = 'completed') AS done,
         count(*) FILTER (status = 'failed') AS failed, count(*) FILTER (status = 'started') AS open
  FROM run_log GROUP BY item"""))
def progress_counts(spark, d):
    return aggregate.progress_counts(run_log(spark, d), ["item"], F.col("status"))


@query("partition_plan", """
  SELECT l_returnflag, count(*) AS total_rows, count(*) // 800 + 1 AS partitions FROM lineitem GROUP BY l_returnflag""")
def partition_plan(spark, d):
    return aggregate.partition_plan(table(spark, d, "lineitem"), ["l_returnflag"], 800)


# --- ledger ---------------------------------------------------------------------

@query("latest_status", with_sql(LATEST, select=f"SELECT item, link, status, size, seq, {sql_text('ts')} AS ts FROM latest"))
def latest_status(spark, d):
    last = ledger.latest_status(link_log(spark, d), ["item", "link"], ["ts", "seq"])
    return last.withColumn("ts", utc_text("ts"))


@query("upsert_documents", """
  WITH changes AS (
    SELECT doc_id, quality, CASE WHEN toxic = 1 THEN 'toxic' END AS lang FROM labels
    UNION ALL SELECT item_id + 1000000000, 1, 'new' FROM benchmark)
  SELECT doc_id, coalesce(c.lang, d.lang) AS lang, CASE WHEN c.quality = 0 THEN NULL ELSE d.n_chars END AS n_chars,
    c.quality FROM documents d FULL JOIN changes c USING (doc_id)""")
def upsert_documents(spark, d):
    current = table(spark, d, "documents").select("doc_id", "lang", "n_chars")
    # Each label arrives as two events: the quality first, then the rest; low quality clears n_chars.
    labels = table(spark, d, "labels")
    none, names = F.lit(None), lambda *n: F.array(*map(F.lit, n))
    length = none.cast("bigint").alias("n_chars")
    events = (
        labels.select("doc_id", "quality", none.cast("string").alias("lang"), length, F.lit(1).alias("seq"),
                      F.when(F.col("quality") == 0, names("quality", "n_chars")).otherwise(names("quality")).alias("sets"))
        .unionByName(labels.filter("toxic = 1").select(
            "doc_id", none.cast("int").alias("quality"), F.lit("toxic").alias("lang"), length, F.lit(2).alias("seq"),
            names("lang").alias("sets")))
        .unionByName(table(spark, d, "benchmark").select(
            (F.col("item_id") + 1_000_000_000).alias("doc_id"), F.lit(1).alias("quality"),
            F.lit("new").alias("lang"), length, F.lit(1).alias("seq"), names("quality", "lang").alias("sets"))))
    changes = ledger.merge_changes(events, ["doc_id"], ["seq"], "sets")
    root = fresh_dir(spark, "documents")
    ledger.save_version(ledger.upsert_documents(current, changes, ["doc_id"]), root, 1)
    return ledger.read_version(spark, root)


@query("link_status_map", with_sql(LATEST, """numbered AS (
  SELECT *, (row_number() OVER (PARTITION BY item ORDER BY link) - 1) // 20 AS chunk FROM latest)""", select="""
  SELECT item, chunk, string_agg(link || '=' || status, ',' ORDER BY link) AS download_status
  FROM numbered GROUP BY item, chunk"""))
def link_status_map(spark, d):
    latest = ledger.latest_status(link_log(spark, d), ["item", "link"], ["ts", "seq"])
    maps = ledger.link_status_map(latest, ["item"], "link", size=20)
    entries = F.transform(F.array_sort(F.map_entries("download_status")),
                          lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return maps.withColumn("download_status", F.array_join(entries, ","))


@query("open_runs", with_sql(LATEST, select="SELECT item, link, seq FROM latest WHERE status = 'started'"))
def open_runs(spark, d):
    return ledger.open_runs(run_log(spark, d), ["item", "link"], ["ts", "seq"]).select("item", "link", "seq")


@query("start_events", with_sql(LATEST, select="""
  SELECT item, link, 'started' AS status, NULL::VARCHAR AS error_message, NULL::VARCHAR AS end_time, count(*) AS events
  FROM link_log GROUP BY item, link"""))
def start_events(spark, d):
    items = link_log(spark, d).groupBy("item", "link").agg(F.count(F.lit(1)).alias("events"))
    started = ledger.start_events(items, F.current_timestamp())
    return started.select("item", "link", "status", "error_message", utc_text("end_time").alias("end_time"), "events")


@query("snapshot_status", with_sql(LATEST, select=f"""
  SELECT link, count(*) AS files, count(*) FILTER (status = 'success') AS completed_files,
         count(*) FILTER (status = 'failed') AS failed_files,
         {sql_text('min(ts)')} AS start_time, {sql_text('max(ts)')} AS end_time,
         CASE WHEN count(*) FILTER (status = 'failed') > 0 THEN 'failed'
              WHEN count(*) FILTER (status = 'success') = count(*) THEN 'completed' ELSE 'started' END AS status
  FROM latest GROUP BY link"""))
def snapshot_status(spark, d):
    files = ledger.latest_status(run_log(spark, d), ["item", "link"], ["ts", "seq"])
    timed = files.withColumns({"start_time": F.col("ts"), "end_time": F.col("ts")})
    return ledger.snapshot_status(timed, ["link"]).withColumns(
        {"start_time": utc_text("start_time"), "end_time": utc_text("end_time")})


RETRY = """attempt AS (
  SELECT item, link, count(*) FILTER (status = 'failed') AS failures, bool_or(status = 'completed') AS succeeded,
         max(ts) AS last_attempt FROM run_log GROUP BY item, link),
decided AS (
  SELECT *, CASE WHEN succeeded THEN 'done' WHEN failures = 0 THEN 'wait' WHEN failures < 2 THEN 'retry'
                 ELSE 'failed' END AS action FROM attempt)"""
JITTERED = """last_attempt + to_seconds(pow(2, failures - 1)) + to_milliseconds(
  CAST('0x' || substr(md5(concat_ws('|', item, link, failures)), 1, 6) AS BIGINT) % 1001)"""
RETRY_SELECT = f"""
  SELECT item, link, failures, succeeded, {sql_text('last_attempt')} AS last_attempt, action,
         CASE WHEN action = 'retry' THEN {sql_text(JITTERED)} END AS next_at
  FROM decided"""


@query("retry_plan", with_sql(RUN_LOG, RETRY, select=RETRY_SELECT))
def retry_plan(spark, d):
    plan = ledger.retry_plan(run_log(spark, d), ["item", "link"], max_tries=2)
    return plan.withColumns({"last_attempt": utc_text("last_attempt"), "next_at": utc_text("next_at")})


@query("orphans", with_sql(OBJECTS, DONE, select="""
  SELECT key, size FROM objects WHERE key IN (SELECT key FROM done WHERE quality = 0)"""))
def orphans(spark, d):
    failed = done_objects(spark, d).filter("quality = 0")
    return ledger.orphans(objects(spark, d), failed).select("key", "size")


# --- streams --------------------------------------------------------------------

def event_stream(spark, d):
    """The events file as a file stream; the pattern makes it a folder scan."""
    schema = table(spark, d, "events").schema
    return ingest.read_stream(spark, f"{d}/event[s].parquet", schema)


def streamed_log(spark, d):
    kind = F.col("event_type")
    log = event_stream(spark, d).select(
        F.col("user_id").alias("item"), F.get_json_object("props", "$.k").alias("link"),
        F.when(kind == "error", "failed").when(kind == "purchase", "completed").otherwise("started").alias("status"),
        "ts", F.col("event_id").alias("seq"))
    return ingest.as_event_time(log)


def folders(spark, name):
    root = fresh_dir(spark, name)
    return f"{root}/out", f"{root}/checkpoint"


@query("stream_ingest", f"SELECT event_id, {sql_text('ts')} AS ts, user_id, event_type, value, props FROM events")
def stream_ingest(spark, d):
    target, checkpoint = folders(spark, "ingest")
    # The second run finds nothing new.
    for _ in range(2):
        ingest.stream_ingest(event_stream(spark, d), target, checkpoint)
    return spark.read.parquet(target).withColumn("ts", utc_text("ts"))


@query("stream_status", with_sql(RUN_LOG, select=f"""
  SELECT item, link, status, {sql_text('ts')} AS ts, seq FROM run_log
  QUALIFY row_number() OVER (PARTITION BY item, link ORDER BY ts DESC, seq DESC) = 1"""))
def stream_status(spark, d):
    target, checkpoint = folders(spark, "status")
    keys = ["item", "link"]
    live.write_updates(live.status_updates(streamed_log(spark, d), keys, ["ts", "seq"]), target, checkpoint)
    return live.current(spark, target, keys).withColumn("ts", utc_text("ts"))


@query("stream_dedup", with_sql(RUN_LOG, select=f"""
  SELECT link, {sql_text('ts')} AS ts, seq FROM run_log
  QUALIFY row_number() OVER (PARTITION BY link ORDER BY ts, seq) = 1"""))
def stream_dedup(spark, d):
    target, checkpoint = folders(spark, "dedup")
    live.write_updates(live.first_seen_updates(streamed_log(spark, d), ["link"], ["ts", "seq"]), target, checkpoint)
    first = live.current(spark, target, ["link"])
    return first.select("link", utc_text("first.ts").alias("ts"), "first.seq")


@query("stream_rate", f"""
  SELECT {sql_text("date_trunc('minute', ts)")} AS window_start, count(*) AS requests,
         count(*) > 2 AS over_budget FROM events GROUP BY 1""")
def stream_rate(spark, d):
    target, checkpoint = folders(spark, "rate")
    # Eight files out of order, one per micro-batch; half way the batches are folded.
    events = table(spark, d, "events")
    landing = fresh_dir(spark, "shuffled")
    events.repartition(8, F.xxhash64("event_id")).write.parquet(landing)
    stream = ingest.as_event_time(ingest.read_stream(spark, landing, events.schema, max_files=1))
    live.write_partials(stream, live.rate_partials(), target, checkpoint)
    live.compact(spark, target, live.rates)
    counted = live.rates(live.written(spark, target))
    return live.over_budget(counted, limit=2).select(
        utc_text("window_start").alias("window_start"), "requests", "over_budget")


@query("stream_retry", with_sql(RUN_LOG, RETRY, select=RETRY_SELECT))
def stream_retry(spark, d):
    target, checkpoint = folders(spark, "retry")
    keys = ["item", "link"]
    live.write_updates(live.retry_updates(streamed_log(spark, d), keys), target, checkpoint)
    plan = live.retry_schedule(spark, target, keys, max_tries=2)
    return plan.withColumns({"last_attempt": utc_text("last_attempt"), "next_at": utc_text("next_at")})


def landed(log, parts: int, *by):
    """The log as ``parts`` files, by the day of the month or by a hash: each step adds one to the folder, and gives its path."""
    folder = fresh_dir(log.sparkSession, "landed")
    part = F.pmod(F.xxhash64(*by), F.lit(parts)) if by else F.floor((F.dayofmonth("ts") - 1) * parts / 31)
    cut = stage(log.withColumn("part", part), "landed-parts")
    for number in range(parts):
        cut.where(F.col("part") == number).drop("part").coalesce(1).write.mode("append").parquet(folder)
        yield folder


RETRY_TIMERS = f"""runs AS (
  SELECT *, count(*) FILTER (status = 'completed') OVER (PARTITION BY item, link ORDER BY ts, seq
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS segment FROM run_log),
counted AS (
  SELECT *, count(*) FILTER (status = 'failed') OVER (PARTITION BY item, link, segment ORDER BY ts, seq) AS f,
    lead(ts) OVER (PARTITION BY item, link ORDER BY ts, seq) AS next_ts FROM runs),
told AS (
  SELECT item, link, ts AS last_attempt, next_ts, status,
    CASE WHEN status = 'failed' THEN (f - 1) % 3 + 1 ELSE f % 3 END AS failures FROM counted),
outcome AS (
  SELECT item, link, 'done' AS action, failures, last_attempt AS moment FROM told WHERE status = 'completed'
  UNION ALL SELECT item, link, 'failed', failures, last_attempt FROM told WHERE status = 'failed' AND failures = 3
  UNION ALL SELECT item, link, 'retry', failures, {JITTERED} FROM told
  WHERE status <> 'completed' AND failures BETWEEN 1 AND 2 AND ({JITTERED} < next_ts OR next_ts IS NULL))"""


@query("stream_retry_timers", with_sql(RUN_LOG, RETRY_TIMERS, select=f"""
  SELECT item, link, action, failures::INTEGER AS failures, {sql_text('moment')} AS "at" FROM outcome
  WHERE moment <= (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 1 HOUR FROM run_log)"""))
def stream_retry_timers(spark, d):
    target, checkpoint = folders(spark, "timers")
    log = ingest.as_event_time(run_log(spark, d).select("item", "link", "status", "ts", "seq"))
    for number, folder in enumerate(landed(log, 4)):
        # Two runs: three files, a file to a micro-batch, then the last one after a restart.
        if number >= 2:
            attempts = ingest.read_stream(spark, folder, log.schema, max_files=1)
            timers.run_retries(timers.retry_timers(attempts, ["item", "link"], max_tries=3, ttl_seconds=90 * 86_400),
                               target, checkpoint)
    return spark.read.parquet(target).withColumn("at", utc_text("at"))


@query("stream_dedup_bounded", with_sql(RUN_LOG, select="SELECT DISTINCT item, link FROM run_log"))
def stream_dedup_bounded(spark, d):
    target, checkpoint = folders(spark, "bounded")
    log = ingest.as_event_time(run_log(spark, d).select("item", "link", "ts", "seq"))
    keys = ["item", "link"]
    for number, folder in enumerate(landed(log, 4, "seq")):
        # Files out of order: most rows of the later ones are late.
        if number >= 2:
            bounded.bounded_first_seen(ingest.read_stream(spark, folder, log.schema, max_files=1), target, checkpoint, keys)
    return bounded.seen_keys(spark, target, keys)


@query("stream_merge", with_sql(RUN_LOG, select=f"""
  SELECT item, link, status, {sql_text('ts')} AS ts, seq FROM run_log
  QUALIFY row_number() OVER (PARTITION BY item, link ORDER BY ts DESC, seq DESC) = 1"""))
def stream_merge(spark, d):
    root, checkpoint = folders(spark, "merge")
    log = ingest.as_event_time(run_log(spark, d).select("item", "link", "status", "ts", "seq"))
    for number, folder in enumerate(landed(log, 4, "seq")):
        if number >= 2:
            merge.merge_stream(ingest.read_stream(spark, folder, log.schema, max_files=1), root, checkpoint,
                               ["item", "link"], ["ts", "seq"])
    return merge.merged_documents(spark, root).withColumn("ts", utc_text("ts"))


# --- composed plans ---------------------------------------------------------------

@query("content_enrichment", with_sql(OBJECTS, DONE, select="""
  SELECT source, count(*) AS files, 0::BIGINT AS missing,
         sum(len(list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '')))::BIGINT AS words
  FROM documents JOIN objects USING (doc_id)
  WHERE (key LIKE '%.en' OR key LIKE '%.de') AND doc_id NOT IN (SELECT doc_id FROM done) GROUP BY source"""))
def content_enrichment(spark, d):
    done = done_objects(spark, d).select(F.col("done_key").alias("key"))
    todo = content.remaining_objects(objects(spark, d), done, ".en", ".de", marker="tmp/")
    docs = table(spark, d, "documents").select("doc_id", "text")
    meta = todo.select("doc_id", F.col("folder").alias("source"))
    return content.content_stats(content.enrich_content(meta, docs, "doc_id", content_unique=True), "source")


@query("media_harvest", with_sql(MEDIA_PAGES, IMAGES, """first AS (
  SELECT * FROM images WHERE media_url LIKE 'http%'
  QUALIFY row_number() OVER (PARTITION BY host, media_url ORDER BY page_id, pos) = 1),
numbered AS (SELECT *, row_number() OVER (PARTITION BY host ORDER BY page_id, pos) - 1 AS number FROM first)""", select="""
  SELECT host, page_id, media_url, number,
         'image_' || number || '_' || translate(alt, ' /', '__') || '.jpg' AS media_name,
         'media/' || host || '/image_' || number || '_' || translate(alt, ' /', '__') || '.jpg' AS object_key
  FROM numbered"""))
def media_harvest(spark, d):
    candidates = stage(media.media_candidates(media_pages(spark, d), wanted_class="thumb"), "candidates")
    records = media.media_records(candidates, "host", "media")
    return records.select("host", "page_id", "media_url", "number", "media_name", "object_key")


@query("media_by_digest", with_sql(MEDIA_PAGES, IMAGES, """first AS (
  SELECT * FROM images WHERE media_url LIKE 'http%'
  QUALIFY row_number() OVER (PARTITION BY host, media_url ORDER BY page_id, pos) = 1),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY host ORDER BY page_id, pos) AS n FROM first
  QUALIFY row_number() OVER (PARTITION BY host ORDER BY page_id, pos) <= 2)""", select="""
  SELECT host, page_id, n - 1 AS number,
         'media/' || host || '/image_' || n || '_' || md5(media_url) || '.jpg' AS object_key FROM numbered"""))
def media_by_digest(spark, d):
    candidates = stage(media.media_candidates(media_pages(spark, d)), "candidates")
    records = media.media_records(candidates, "host", "media", cap=2, by_digest=True)
    return records.select("host", "page_id", "number", "object_key")


@query("video_totals", with_sql(MEDIA_PAGES, OBJECTS, """videos AS (
  SELECT host, page_id, 'https://cdn.example.org/' || n || '.mp4' AS media_url, 'v_' || n AS token
  FROM media_pages WHERE has_body
  QUALIFY row_number() OVER (PARTITION BY host, n ORDER BY page_id) = 1),
named AS (
  SELECT host, 'media/' || host || '/video_' || (row_number() OVER (PARTITION BY host ORDER BY page_id) - 1)
         || '_' || token || '.mp4' AS object_key FROM videos),
stored AS (SELECT object_key, length(object_key) AS size FROM named)""", select="""
  SELECT host, count(*) AS total_images, sum(size)::BIGINT AS total_size FROM named JOIN stored USING (object_key)
  GROUP BY host"""))
def video_totals(spark, d):
    candidates = stage(media.media_candidates(media_pages(spark, d), kind="video", wanted_class="clip"), "candidates")
    records = stage(media.media_records(candidates, "host", "media",
                                        kind="video", extension=".mp4"), "records")
    stored = records.select(F.col("object_key").alias("key"), F.length("object_key").cast("bigint").alias("size"))
    return media.folder_totals(records, stored, "host")


@query("archive_items", with_sql(MEDIA_PAGES, NAV_LINKS, """links AS (
  SELECT page_id, href FROM nav WHERE contains(text, 'PDF')
  UNION ALL SELECT page_id, '/f/' || page_id || '.pdf' FROM media_pages WHERE has_body)""", select="""
  SELECT page_id, split_part(rtrim(url, '/'), '/', -1) AS item, 'https://docs.example.org' || href AS doc_url,
         'archive/' || split_part(rtrim(url, '/'), '/', -1) || '/' || split_part(href, '/', -1) AS key
  FROM links JOIN media_pages USING (page_id)"""))
def archive_items(spark, d):
    links = archive.item_links(media_pages(spark, d), "https://docs.example.org", "archive")
    return links.select("page_id", "item", "doc_url", "key")


@query("archive_documents", with_sql(LATEST, select=SUMMARY))
def archive_documents(spark, d):
    return archive.item_documents(link_log(spark, d), "item", "link").withColumns(
        {"start_time": utc_text("start_time"), "end_time": utc_text("end_time")})


@query("repo_catalogue", with_sql(REPOS, """windowed AS (
  SELECT name, stars, lang, least(size // 11, 9) * 11 AS window_low, pos FROM repos
  WHERE size BETWEEN 0 AND 100 AND stars > 900)""", select="""
  SELECT name, stars, lang, window_low, pos FROM windowed
  QUALIFY row_number() OVER (PARTITION BY name, stars, lang ORDER BY window_low, pos) = 1"""))
def repo_catalogue(spark, d):
    return catalogue.repo_catalogue(repos(spark, d), min_stars=900)


@query("catalogue_top", with_sql(REPOS, """windowed AS (
  SELECT name, stars, lang, size // 11 * 11 AS window_low, pos FROM repos
  WHERE size BETWEEN 0 AND 100 AND stars > 900),
first AS (
  SELECT * FROM windowed
  QUALIFY row_number() OVER (PARTITION BY name, stars, lang ORDER BY window_low, pos) = 1)""", select="""
  SELECT name, stars, lang FROM first ORDER BY window_low, pos, name LIMIT 10"""))
def catalogue_top(spark, d):
    return catalogue.top_of_catalogue(catalogue.repo_catalogue(repos(spark, d), min_stars=900))


@query("keyword_harvest", with_sql(MEDIA_PAGES, IMAGES, """signed AS (
  SELECT host, page_id, has_body AND NOT regexp_matches(html, '(^|>)The(<|$)') AS shows, n FROM media_pages),
flagged AS (
  SELECT host, page_id, NOT shows OR coalesce(CASE WHEN has_body THEN n ELSE '' END
    = lag(CASE WHEN has_body THEN n ELSE '' END) OVER w, FALSE) AS stop
  FROM signed JOIN media_pages USING (host, page_id, n) WINDOW w AS (PARTITION BY host ORDER BY page_id)),
shown AS (SELECT host, page_id FROM (
  SELECT host, page_id, max(stop::INT) OVER (PARTITION BY host ORDER BY page_id) AS stopped FROM flagged) WHERE stopped = 0),
first AS (
  SELECT host, media_url, page_id, alt FROM images JOIN shown USING (host, page_id) WHERE pos = 0
  QUALIFY row_number() OVER (PARTITION BY host, media_url ORDER BY page_id) = 1),
named AS (SELECT *, 'ab_' || substr(alt, 5, 1) AS clean FROM first)""", select="""
  SELECT host, media_url, clean || CASE WHEN count(*) OVER (PARTITION BY host, clean) > 1 THEN '_' || md5(media_url)
    ELSE '' END || '.jpg' AS file_name, (row_number() OVER (PARTITION BY host ORDER BY page_id) - 1) // 4 AS batch
  FROM named"""))
def keyword_harvest(spark, d):
    images = harvest.keyword_images(media_pages(spark, d), "host", "page_id", "card", "The")
    records = harvest.keyword_harvest(images, "host", "page_id", batch=4,
                                      clean=lambda alt: names.sanitize_filename(F.left(alt, F.lit(5))))
    return records.select("host", "media_url", "file_name", "batch")


@query("dataset_copy", """
  SELECT 'data/' || lang || '/' || doc_id || '.txt' AS key,
         ntile(5) OVER (ORDER BY 'data/' || lang || '/' || doc_id || '.txt') AS chunk
  FROM documents WHERE lang = 'de' AND doc_id NOT IN (SELECT doc_id FROM labels)""")
def dataset_copy(spark, d):
    files = table(spark, d, "documents").select(
        "doc_id", F.format_string("data/%s/%d.txt", "lang", "doc_id").alias("key"))
    target = files.join(table(spark, d, "labels"), "doc_id", "left_semi").select("key")
    return copy.copy_plan(files.select("key"), target, "de", 5)


@query("dataset_copy_status", with_sql(LATEST, select="""
  SELECT snapshot, files, completed_files, failed_files, CASE WHEN failed_files > 0 THEN 'failed'
    WHEN completed_files = files THEN 'completed' ELSE 'started' END AS status, leftovers FROM (
    SELECT link AS snapshot, count(*) AS files, count(*) FILTER (status = 'success') AS completed_files,
           count(*) FILTER (status = 'failed') AS failed_files, count(*) FILTER (status = 'failed') AS leftovers
    FROM latest GROUP BY link)"""))
def dataset_copy_status(spark, d):
    log = run_log(spark, d).select(F.col("link").alias("snapshot"), F.concat_ws("/", "link", "item").alias("key"),
                                   "status", "ts", "seq")
    status = copy.copy_status(log, ["ts", "seq"])
    stored = log.select("snapshot", "key").distinct()
    left = copy.copy_leftovers(stored, log, ["ts", "seq"]).groupBy("snapshot").agg(F.count(F.lit(1)).alias("leftovers"))
    return status.join(left, "snapshot", "left").select(
        "snapshot", "files", "completed_files", "failed_files", "status",
        F.coalesce("leftovers", F.lit(0)).alias("leftovers"))


@query("manifest_ranges", with_sql(OBJECTS, DONE, """todo AS (
  SELECT key, size FROM objects WHERE doc_id NOT IN (SELECT doc_id FROM done WHERE quality = 1)),
planned AS (
  SELECT todo.key, todo.size, coalesce(done.size, 0) AS start_at FROM todo LEFT JOIN done USING (key))""", select="""
  SELECT key, unnest(range(start_at, size, 1000)) AS range_start,
         least(unnest(range(start_at, size, 1000)) + 999, size - 1) AS range_end FROM planned"""))
def manifest_ranges(spark, d):
    root = fresh_dir(spark, "manifest")
    sinks.write_json_array(objects(spark, d), root, ["key"], F.col("key"), size=100)
    manifest = manifests.read_manifest_json(spark, root).select(F.col("value").alias("key"))
    had = done_objects(spark, d)
    done = had.filter("quality = 1").select(F.col("done_key").alias("key"))
    ranges = copy.manifest_ranges(manifest, objects(spark, d).select("key", "size"), done, had.select("key", "size"), 1000)
    return ranges.select("key", "range_start", "range_end")
