"""One query per operator over its whole table, with SQL where SQL can express it."""

from __future__ import annotations

import public_tokenizers

from pyspark.sql import functions as F

from gleaner.llm import (alignment, clusters, contamination, fingerprints, grace, language, lines, near, packing,
                         passages, quality, substrings, warc)

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def _query(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn
    return add


def _table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query(r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS MATERIALIZED (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct([array_to_string(w[i:i+2], ' ') FOR i IN range(1, len(w) - 1)]) END AS s FROM w),
n AS MATERIALIZED (SELECT doc_id, len(s) AS n FROM s),
x AS MATERIALIZED (SELECT doc_id, unnest(s) AS g FROM s),
pair AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM x a JOIN x b USING (g)
         WHERE a.doc_id <> b.doc_id GROUP BY ALL),
link AS MATERIALIZED (SELECT a, b FROM pair JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b
         WHERE 100 * k >= 85 * (p.n + q.n - k)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM n UNION SELECT reach.a, link.b FROM reach JOIN link ON link.a = reach.b)
SELECT a AS doc_id, n AS n_shingles, min(b) AS component_id, min(b) = a AS kept
FROM reach JOIN n ON doc_id = a GROUP BY a, n""")
def op10_minhash_near_dedup(spark, sf_dir):
    """Links at 85 of 100 shared 3-word shingles, confirmed on full sets; every document with its component."""
    return near.near_duplicates(_table(spark, sf_dir, "documents"), n_words=3, percent=85)


@_query("""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
h AS (SELECT page_id, octet_length(b) AS n, b, sha1(b) AS hex FROM p),
d AS (SELECT page_id, n, min(page_id) OVER (PARTITION BY b) AS first_id, array_to_string([
  substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + list_sum([((instr('0123456789abcdef', hex[j // 4 + 1]) - 1)
    >> (3 - j % 4) & 1) << (4 - (j - 5 * i)) FOR j IN range(5 * i, 5 * i + 5)])::INT, 1) FOR i IN range(32)], '')
  AS payload_digest FROM h)
SELECT page_id, n AS payload_bytes, payload_digest,
  CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first_id THEN first_id END AS refers_to FROM d""")
def op1_warc_normaliser(spark, sf_dir):
    """Pages as WARC archives, normalised to a member per record with an index, and read back."""
    return warc.archive_pages(_table(spark, sf_dir, "pages"))


@_query("""
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept,
  sha256(coalesce(text, '')) AS text_sha256 FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))""")
def op4_grace_exact_dedup(spark, sf_dir):
    """Equal texts by Grace hashing; the largest doc_id of a group stays."""
    return grace.exact_duplicates(_table(spark, sf_dir, "documents"))


@_query()
def op8_best_fit_packing(spark, sf_dir):
    """Every document as ids and a closing id 2, in sequences of at most 1024 tokens."""
    return packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), end_id=2)


@_query()
def op3_ordinal_quality(spark, sf_dir):
    """Expected grade and tail probability of every document, and whether it is selected."""
    found = quality.judge(_table(spark, sf_dir, "documents"), quality.grades_of(_table(spark, sf_dir, "labels")))
    return found.withColumnRenamed("selected", "kept")


@_query()
def op5_benchmark_decontamination(spark, sf_dir):
    """Every document: the benchmark item it holds a copy of, the score, and the number of such items; clean ones are kept."""
    docs = _table(spark, sf_dir, "documents")
    found = contamination.contaminated(docs, _table(spark, sf_dir, "benchmark"))
    return (docs.select("doc_id").join(found, "doc_id", "left")
            .select("doc_id", F.col("score").isNull().alias("kept"), "item_id", "score",
                    F.coalesce("items", F.lit(0)).alias("items")))


@_query()
def op7_language_id(spark, sf_dir):
    """Language of every document, learned from four fifths of those whose language is given."""
    docs = _table(spark, sf_dir, "documents")
    fold = language.held_out()
    model = language.train(docs.where(~fold & F.col("doc_id").isNotNull()))
    return (language.identify(docs, model).withColumn("held_out", fold)
            .select("doc_id", "held_out", "lang_pred", "score", F.size("spans").alias("n_spans")))


@_query(r"""
WITH l AS MATERIALIZED (
  SELECT doc_id, unnest(x) AS value, unnest(range(len(x))) AS line
  FROM (SELECT doc_id, string_split(text, chr(10)) AS x FROM documents WHERE text IS NOT NULL)),
m AS MATERIALIZED (
  SELECT doc_id, line, value, len(t) AS n, t, t[1:3] AS head FROM (SELECT *, [CASE WHEN regexp_matches(x, '[0-9]')
    THEN '<*>' ELSE x END FOR x IN regexp_extract_all(regexp_replace(value,
    '([\x{0E00}-\x{0EFF}\x{1000}-\x{109F}\x{1780}-\x{17FF}\x{2E80}-\x{9FFF}\x{F900}-\x{FAFF}\x{20000}-\x{3FFFF}])',
    ' \1 ', 'g'), '[^ 	

]+')] AS t FROM l)),
shared AS MATERIALIZED (
  SELECT m.* FROM m JOIN (SELECT n, head FROM m WHERE n > 0 GROUP BY ALL HAVING count(DISTINCT doc_id) >= 5)
  USING (n, head)),
different AS MATERIALIZED (SELECT n, head, t, count(DISTINCT doc_id) AS docs FROM shared GROUP BY ALL),
tok AS MATERIALIZED (SELECT n, head, t, docs, unnest(t) AS token, unnest(range(n)) AS place FROM different),
constant AS (SELECT n, head, place, token FROM tok GROUP BY ALL HAVING sum(docs) >= 5),
tpl AS MATERIALIZED (
  SELECT n, head, t, CASE WHEN kept >= 0.7 * n THEN parts ELSE t END AS tpl, kept >= 0.7 * n AS general FROM (
    SELECT n, head, t, count(constant.token) AS kept,
      list(CASE WHEN constant.token IS NULL THEN chr(0) ELSE tok.token END ORDER BY tok.place) AS parts
    FROM tok LEFT JOIN constant USING (n, head, place, token) GROUP BY n, head, t)),
placed AS MATERIALIZED (
  SELECT doc_id, line, n, head, tpl, general FROM shared JOIN tpl USING (n, head, t)),
first AS (SELECT n, head, tpl, general FROM placed GROUP BY ALL HAVING count(DISTINCT doc_id) >= 5),
copies AS MATERIALIZED (
  SELECT doc_id FROM (SELECT doc_id, sum(n) AS held FROM placed JOIN first USING (n, head, tpl, general) GROUP BY 1)
  JOIN (SELECT doc_id, sum(n) AS every FROM m GROUP BY 1) USING (doc_id) WHERE held > 0.5 * every),
others AS MATERIALIZED (SELECT * FROM placed WHERE doc_id NOT IN (SELECT doc_id FROM copies)),
last AS (SELECT n, head, tpl, general FROM others GROUP BY ALL HAVING count(DISTINCT doc_id) >= 5),
dropped AS (SELECT doc_id, line FROM others JOIN last USING (n, head, tpl, general))
SELECT doc_id, count(*)::INTEGER AS n_lines, count(dropped.line)::INTEGER AS n_dropped,
  sha256(coalesce(string_agg(value, chr(10) ORDER BY line) FILTER (dropped.line IS NULL), '')) AS kept_sha256
FROM l LEFT JOIN dropped USING (doc_id, line) GROUP BY doc_id
UNION ALL SELECT doc_id, 0, 0, sha256('') FROM documents WHERE text IS NULL""")
def op2_template_line_dedup(spark, sf_dir):
    """Every document: its lines, those dropped as recurring templates, and the digest of what stays."""
    kept = lines.drop_recurring_lines(_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


@_query("""
WITH b AS MATERIALIZED (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
x AS MATERIALIZED (SELECT doc_id, unnest(range(len(h) // 2 - 49)) AS i, h FROM b WHERE len(h) >= 100),
s AS MATERIALIZED (SELECT doc_id, i, md5(substr(h, 2 * i + 1, 100)) AS k FROM x),
m AS (SELECT k, min(doc_id) AS first FROM s GROUP BY k HAVING min(doc_id) < max(doc_id)),
hit AS (SELECT doc_id, i FROM s JOIN m USING (k) WHERE first < doc_id),
run AS (SELECT doc_id, i, i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS gap FROM hit),
span AS (SELECT doc_id, n, min(i) AS a, max(i) + 50 AS z FROM (
  SELECT doc_id, i, sum(CASE WHEN gap <= 50 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY i) AS n FROM run)
  GROUP BY doc_id, n),
cut AS (SELECT doc_id, a, z, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0) AS from_ FROM span),
kept AS (SELECT doc_id, count(*) AS n_spans, sum(z - a)::BIGINT AS n_removed, max(z) AS last,
  string_agg(substr(h, 2 * from_ + 1, 2 * (a - from_)), '' ORDER BY a) AS k FROM cut JOIN b USING (doc_id) GROUP BY doc_id)
SELECT doc_id, len(h) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(CASE WHEN k IS NULL THEN h ELSE k || substr(h, 2 * last + 1) END)) AS kept_sha256
FROM b LEFT JOIN kept USING (doc_id)""")
def op6_suffix_array_dedup(spark, sf_dir):
    """Bytes covered by a 50-byte string that also starts in a document with a smaller doc_id, removed."""
    found = substrings.repeated_spans(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("bigint").alias("n_spans"), "kept_sha256")


@_query()
def op9_compact_windows(spark, sf_dir):
    """Every document: the class that near-duplicate passages put it in, and the words of such passages."""
    found = passages.repeated_passages(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", "n_dup_words", F.coalesce(F.size("spans"), F.lit(0)).alias("n_spans"),
                        F.to_json("spans").alias("spans"))


_NEAREST = """
a{i} AS MATERIALIZED (
  SELECT r, vec_id, v, min({{'d': d, 'k': k}}) AS m FROM (
    SELECT r, vec_id, v, k, list_sum(list_transform(range(1, 65), lambda i: (v[i] - c[i]) * (v[i] - c[i])))::BIGINT AS d
    FROM kept, c{i}) GROUP BY r, vec_id, v)"""
_MOVED = """
c{j} AS MATERIALIZED (
  SELECT c{i}.k, coalesce(n.c, c{i}.c) AS c FROM c{i} LEFT JOIN (
    SELECT k, list((s - ((s % n) + n) % n) // n ORDER BY i) AS c FROM (
      SELECT m.k AS k, i, sum(v[i])::BIGINT AS s, count(*) AS n FROM a{i}, unnest(range(1, 65)) AS t(i) GROUP BY ALL)
    GROUP BY k) AS n ON n.k = c{i}.k)"""


@_query("""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id), v) - 1 AS k, v AS c FROM kept QUALIFY k < 16),"""
        + ",".join(_NEAREST.format(i=i) + "," + _MOVED.format(i=i, j=i + 1) for i in range(3)) + "," + _NEAREST.format(i=3)
        + """
SELECT vec_id, m.k::INTEGER AS cluster, m.d AS distance, (sum(m.d) OVER (PARTITION BY m.k))::BIGINT AS cluster_inertia,
  (sum(m.d) OVER ())::BIGINT AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a3 JOIN c3 ON c3.k = m.k""")
def op11_pca_clusters(spark, sf_dir):
    """Sixteen centroids, three rounds; every vector with its cluster and squared distance."""
    return clusters.centroid_clusters(_table(spark, sf_dir, "embeddings")).drop("n_verified")


@_query()
def op13_edit_fingerprints(spark, sf_dir):
    """Fingerprint of every whole text and of its edited text, and their likeness."""
    return fingerprints.document_fingerprints(_table(spark, sf_dir, "documents"))


@_query()
def op12_tokenizer_alignment(spark, sf_dir):
    """Groups and links between the tokens of two public tokenizers, with counts of linked ids over all documents."""
    return alignment.align(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                           public_tokenizers.path("piece_bpe_32k.model"))
