"""URL and object-key expressions. All are native columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

MAX_NAME = 255  # fixed value: longest file name kept from a URL


def url_basename(url: Column, cap: int = MAX_NAME) -> Column:
    """Text after the last ``/``, at most ``cap`` characters."""
    return F.left(F.substring_index(url, "/", -1), F.lit(cap))


def url_filename(url: Column, cap: int = MAX_NAME) -> Column:
    """As :func:`url_basename`; where something is cut off, the name ends in the digest of the URL instead."""
    name = F.substring_index(url, "/", -1)
    return F.when(F.char_length(name) <= cap, name).otherwise(
        F.concat_ws("_", F.left(name, F.lit(cap - 33)), F.md5(url)))


def url_basename_noquery(url: Column) -> Column:
    """Text after the last ``/`` and before the first ``?`` in it."""
    return F.substring_index(F.substring_index(url, "/", -1), "?", 1)


def item_name(url: Column) -> Column:
    """Last non-empty path segment, so ``/``-terminated URLs keep a name."""
    return F.substring_index(F.rtrim(url, F.lit("/")), "/", -1)


def object_key(*parts: Column) -> Column:
    """Parts joined by ``/``; null parts are left out."""
    return F.concat_ws("/", *parts)


def root_relative(page_url: Column, href: Column) -> Column:
    """``/x`` becomes scheme + host + ``/x``; anything else stays as it is."""
    origin = F.concat_ws("/", F.slice(F.split(page_url, "/"), 1, 3))
    return F.when(href.startswith("/"), F.concat(origin, href)).otherwise(href)


def prefix_unless_http(base: Column, href: Column) -> Column:
    """``base + href`` unless ``href`` starts with ``http``."""
    return F.when(href.startswith("http"), href).otherwise(F.concat(base, href))


def prefix_always(base: Column, href: Column) -> Column:
    return F.concat(base, href)


def _tidy_path(path: Column, rooted: Column) -> Column:
    """Path without ``.`` and ``..``; a path that is not ``rooted`` loses empty inner segments too."""
    parts = F.split(path, "/")
    last = F.element_at(parts, -1)
    inner = F.filter(
        parts, lambda p, i: rooted | (i == 0) | (i == F.size(parts) - 1) | (p != ""))
    # A final "." or ".." names a folder, hence the closing "/".
    closed = F.when(last.isin(".", ".."), F.concat(inner, F.array(F.lit("")))).otherwise(inner)
    kept = F.aggregate(
        closed,
        F.array().cast("array<string>"),
        lambda acc, p: F.when(p == ".", acc)
        .when(p == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0))))
        .otherwise(F.concat(acc, F.array(p))),
    )
    joined = F.array_join(kept, "/")
    return F.when(joined.startswith("/"), joined).otherwise(F.concat(F.lit("/"), joined))


def resolve_url(base: Column, href: Column) -> Column:
    """``href`` as seen from page ``base``: scheme, ``//``, ``/``, ``?``, ``#``, relative and dot segments."""
    scheme = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.\-]*):", 1)
    authority = F.regexp_extract(base, r"^[^:/?#]+://([^/?#]*)", 1)
    origin = F.concat(scheme, F.lit("://"), authority)
    base_path = F.regexp_extract(base, r"^[^:/?#]+://[^/?#]*([^?#]*)", 1)
    no_fragment = F.substring_index(base, "#", 1)
    no_query = F.substring_index(no_fragment, "?", 1)
    folder = F.regexp_extract(base_path, r"^(.*/)", 1)
    path = F.regexp_extract(href, r"^([^?#]*)", 1)
    tail = F.regexp_extract(href, r"^[^?#]*(.*)$", 1)
    merged = F.when(path.startswith("/"), path).otherwise(
        F.concat(F.when(folder == "", F.lit("/")).otherwise(folder), path))
    # The fold over segments runs only where a segment needs it.
    needs_fold = merged.rlike(r"/\.\.?(/|$)|//")
    resolved = F.when(needs_fold, _tidy_path(merged, path.startswith("/"))).otherwise(merged)
    return (
        F.when(href.isNull() | (href == ""), base)
        .when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), href)
        .when(href.startswith("//"), F.concat(scheme, F.lit(":"), href))
        .when(href.startswith("#"), F.concat(no_fragment, href))
        .when(href.startswith("?"), F.concat(no_query, href))
        .otherwise(F.concat(origin, resolved, tail))
    )


def rewrite_url(url: Column, old: str, new: str) -> Column:
    """Replace a URL parameter, for example to ask for the full-size image."""
    return F.replace(url, F.lit(old), F.lit(new))


def search_url(base: str, phrase: Column, page: Column | None = None,
               page_param: str = "page", suffix: str = "") -> Column:
    """``base + phrase`` with blanks as ``%20``, then ``?param=page``."""
    url = F.concat(F.lit(base), F.replace(phrase, F.lit(" "), F.lit("%20")), F.lit(suffix))
    if page is None:
        return url
    return F.concat(url, F.lit(f"?{page_param}="), page.cast("string"))


def folder_token(phrase: Column) -> Column:
    """A search phrase as a folder name: trimmed, blanks to ``_``."""
    return F.replace(F.trim(phrase), F.lit(" "), F.lit("_"))
