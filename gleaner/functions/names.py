"""File and media names."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_STEM = r"(?s)^(\.*[^.].*)\.[^.]*$"
_EXTENSION = r"(?s)^\.*[^.].*(\.[^.]*)$"


def file_stem(name: Column) -> Column:
    """Name without its last extension; leading dots do not start one."""
    return F.when(name.rlike(_STEM), F.regexp_extract(name, _STEM, 1)).otherwise(name)


def file_extension(name: Column) -> Column:
    """Last extension with its dot, or an empty string."""
    return F.regexp_extract(name, _EXTENSION, 1)


def name_before_first_dot(name: Column) -> Column:
    return F.substring_index(name, ".", 1)


def sanitize_filename(name: Column, extension: str = "") -> Column:
    """Keep ASCII letters, digits and white space; blanks become ``_``."""
    # (?U) gives \s its Unicode meaning; U+001C..U+001F count as space too.
    kept = F.regexp_replace(name, r"(?U)[^a-zA-Z0-9\s\x{1c}-\x{1f}]", "")
    return F.concat(F.replace(kept, F.lit(" "), F.lit("_")), F.lit(extension))


def unique_filename(clean: Column, url: Column, collides: Column, extension: str = "") -> Column:
    """``clean`` plus the URL digest where another URL has the same name."""
    return F.concat(F.when(collides, F.concat_ws("_", clean, F.md5(url))).otherwise(clean),
                    F.lit(extension))


def alt_token(alt: Column) -> Column:
    """Alternative text for a file name: missing is empty, blank and ``/`` become ``_``."""
    return F.translate(F.coalesce(alt, F.lit("")), " /", "__")


def media_name(number: Column, token: Column | None = None,
               kind: str = "image", extension: str = ".jpg") -> Column:
    """``image_3_token.jpg`` or, without token, ``image_3.jpg``."""
    head = [F.lit(f"{kind}_"), number.cast("string")]
    if token is not None:
        head += [F.lit("_"), token]
    return F.concat(*head, F.lit(extension))


def md5_name(number: Column, raw_url: Column, kind: str = "image", extension: str = ".jpg") -> Column:
    """Name by content address: the digest is taken from the URL as written in the page."""
    return media_name(number, F.md5(raw_url), kind, extension)


def media_src(src: Column, data_src: Column) -> Column:
    """``src``, or ``data-src`` where ``src`` is missing or empty."""
    return F.coalesce(F.nullif(src, F.lit("")), F.nullif(data_src, F.lit("")))
