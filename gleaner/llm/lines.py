"""Line dedup by a tree of log templates, in DataFrame functions alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from gleaner.session import stage

DEPTH = 3            # leading tokens that, with the number of tokens, lead to a leaf
MIN_DOCS = 5         # documents in which a recurring template stands, and a constant token of a leaf
LEAST_CONSTANT = 0.7 # share of constant tokens that a template needs
MOST_SHARE = 0.5     # a document with a larger share of its tokens in recurring lines is a copy, not boilerplate
#: Scripts written without blanks (Thai, Lao, Myanmar, Khmer, Chinese, Japanese): each character is a token.
UNSPACED = (r"([\x{0E00}-\x{0EFF}\x{1000}-\x{109F}\x{1780}-\x{17FF}\x{2E80}-\x{9FFF}\x{F900}-\x{FAFF}"
            r"\x{20000}-\x{3FFFF}])")
FIELD = r"(?<!\S)[^\s\d]*+\d\S*+"   # a token with a digit is a variable field


def _tokens(line: Column) -> Column:
    """Tokens between white space, or characters of ``UNSPACED``, variable fields masked; most lines need no costly step."""
    line = F.when(line.rlike(UNSPACED), F.regexp_replace(line, UNSPACED, " $1 ")).otherwise(line)
    masked = F.when(line.rlike("[0-9]"), F.regexp_replace(line, FIELD, "<*>")).otherwise(line)
    plain = F.when(masked.rlike("[\t\x0b\x0c\r]"), F.translate(masked, "\t\x0b\x0c\r", "    ")).otherwise(masked)
    return F.array_remove(F.split(plain, " "), "")


def _text_key() -> Column:
    return F.xxhash64("text").alias("th")


def numbered_lines(docs: DataFrame, depth: int = DEPTH) -> DataFrame:
    """``doc_id, th, line, n, leaf, lh`` of every line: its number, tokens, leaf and hash of its masked tokens."""
    lines = docs.select("doc_id", _text_key(), F.posexplode(F.split("text", "\n", -1)).alias("line", "value"))
    return (lines.withColumn("t", _tokens(F.col("value")))
            .select("doc_id", "th", "line", F.size("t").alias("n"),
                    F.xxhash64(F.size("t"), F.slice("t", 1, depth)).alias("leaf"), F.xxhash64("t").alias("lh")))


def _templates(docs: DataFrame, shared: DataFrame, min_docs: int, least_constant: float) -> DataFrame:
    """``leaf, lh, tpl`` of each different line of a shared leaf.

    A token is constant where it stands at its place in ``min_docs`` or more of
    the leaf's lines, counted by document. A line keeps its constant tokens
    and generalises the others, if enough are constant; else it is its own.
    """
    different = (shared.groupBy("leaf", "lh").agg(F.count("*").alias("docs"),
                                                  F.min(F.struct("doc_id", "th", "line")).alias("at")))
    wanted = (different.select("leaf", "lh", "docs", "at.*").groupBy("doc_id", "th")
              .agg(F.collect_list(F.struct("leaf", "lh", "docs", "line")).alias("wanted")).hint("merge"))
    texts = docs.select("doc_id", _text_key(), "text").alias("d")
    found = (texts.join(wanted.alias("w"), F.col("d.doc_id").eqNullSafe(F.col("w.doc_id"))
                        & (F.col("d.th") == F.col("w.th")))
             .select(F.split("text", "\n", -1).alias("lines"), F.explode("wanted").alias("w"))
             .select("w.leaf", "w.lh", "w.docs", _tokens(F.col("lines")[F.col("w.line")]).alias("t"))
             .groupBy("leaf", "lh").agg(F.first("docs").alias("docs"), F.first("t").alias("t")))
    tokens = stage(found.select("leaf", "lh", "docs", F.posexplode("t").alias("place", "token"))
                   .withColumn("token", F.xxhash64("token")), "line-tokens")
    constant = stage(tokens.groupBy("leaf", "place", "token").agg(F.sum("docs").alias("held"))
                     .where(F.col("held") >= min_docs).select("leaf", "place", "token", F.lit(True).alias("constant")),
                     "line-constants")
    made = (tokens.join(constant, ["leaf", "place", "token"], "left").groupBy("leaf", "lh")
            .agg(F.count("*").alias("n"), F.count("constant").alias("kept"),
                 F.sort_array(F.collect_list(F.when(F.col("constant"), F.struct("place", "token")))).alias("parts")))
    return made.select("leaf", "lh", F.when(F.col("kept") >= least_constant * F.col("n"),
                                            F.xxhash64("leaf", "parts", F.lit("template")))
                       .otherwise(F.xxhash64("leaf", "lh", F.lit("line"))).alias("tpl"))


def recurring_lines(docs: DataFrame, depth: int = DEPTH, min_docs: int = MIN_DOCS,
                    least_constant: float = LEAST_CONSTANT, most_share: float = MOST_SHARE
                    ) -> tuple[DataFrame, DataFrame]:
    """All numbered lines, and ``doc_id, th, line`` of those that are dropped."""
    docs = docs.select("doc_id", "text").where("text IS NOT NULL")
    lines = stage(numbered_lines(docs, depth), "lines")
    filled = lines.where(F.col("n") > 0)
    leaves = stage(filled.select("leaf", "doc_id", "th").distinct().groupBy("leaf").agg(F.count("*").alias("docs"))
                   .where(F.col("docs") >= min_docs).select("leaf"), "line-leaves")
    in_leaves = stage(filled.join(leaves, "leaf"), "line-shared")
    shared = in_leaves.groupBy("doc_id", "th", "leaf", "lh").agg(F.min("line").alias("line"))
    templates = stage(_templates(docs, shared, min_docs, least_constant), "line-templates")
    placed = stage(in_leaves.join(templates, ["leaf", "lh"]).select("doc_id", "th", "line", "n", "tpl"), "line-placed")

    recurring = lambda rows: (rows.select("tpl", "doc_id", "th").distinct().groupBy("tpl")
                              .agg(F.count("*").alias("docs")).where(F.col("docs") >= min_docs).select("tpl"))
    totals = lines.groupBy("doc_id", "th").agg(F.sum("n").alias("all"))
    covered = (placed.join(stage(recurring(placed), "line-recurring"), "tpl").groupBy("doc_id", "th")
               .agg(F.sum("n").alias("held")))
    same = F.col("c.doc_id").eqNullSafe(F.col("p.doc_id")) & (F.col("c.th") == F.col("p.th"))
    copies = stage(covered.alias("c").join(totals.alias("p"), same).where(F.col("held") > most_share * F.col("all"))
                   .select("c.doc_id", "c.th"), "line-copies")
    others = stage(placed.alias("p").join(copies.alias("c"), same, "left_anti"), "line-others")
    return lines, others.join(stage(recurring(others), "line-dropped"), "tpl").select("doc_id", "th", "line")


def drop_recurring_lines(docs: DataFrame, **options) -> DataFrame:
    """``docs(doc_id, text, ...)`` without lines whose template recurs; ``n_lines`` and ``n_dropped`` are added.

    The tree parses a line by its number of tokens and its first ``depth``
    tokens; in a leaf, tokens with digits and tokens that do not recur at
    their place are variable. A template that stands in ``min_docs``
    documents is dropped wherever it stands. Documents with more than
    ``most_share`` of their tokens in such lines are copies of each other:
    they stay whole, for the operators that look for copies, and do not count.

    Null texts stay null with no line; an empty text is one empty line. Blank
    lines stay; a line of no more than ``depth`` tokens has a leaf of its own.
    Characters of scripts without blanks are tokens. A document is its
    ``doc_id`` and text, so rows that repeat both count once and change alike;
    rows without ``doc_id`` are told apart by text. Extra columns pass
    through; columns named ``n_lines`` or ``n_dropped`` are replaced.
    """
    lines, dropped = recurring_lines(docs, **options)
    dropped = stage(dropped.distinct(), "line-numbers")
    on = lambda a, b: F.col(f"{a}.doc_id").eqNullSafe(F.col(f"{b}.doc_id")) & (F.col(f"{a}.th") == F.col(f"{b}.th"))
    changed = dropped.select("doc_id", "th").distinct()
    flags = (lines.select("doc_id", "th", "line").distinct().alias("a").join(changed.alias("b"), on("a", "b"), "left_semi")
             .alias("a").join(dropped.alias("b"), on("a", "b") & (F.col("a.line") == F.col("b.line")), "left")
             .groupBy("a.doc_id", "a.th")
             .agg(F.sort_array(F.collect_list(F.struct("a.line", F.col("b.line").isNull().alias("stays")))).alias("f"))
             .select("doc_id", "th", F.col("f.stays").alias("stays")).hint("merge"))
    parts = F.split("text", "\n", -1)
    kept = F.filter(parts, lambda x, i: F.element_at("stays", i + 1))
    own = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    return (docs.select(*own, F.xxhash64("text").alias("__th")).alias("d")
            .join(flags.alias("f"), F.col("d.doc_id").eqNullSafe(F.col("f.doc_id")) & (F.col("__th") == F.col("f.th")),
                  "left")
            .select(*[F.when(F.col("stays").isNotNull(), F.array_join(kept, "\n")).otherwise(F.col("text")).alias("text")
                      if c == "text" else F.col(f"d.`{c}`") for c in own],
                    F.when(F.col("text").isNull(), 0).otherwise(F.size(parts)).alias("n_lines"),
                    F.coalesce(F.size(F.filter("stays", lambda x: ~x)), F.lit(0)).alias("n_dropped")))
