"""Links, images and videos out of landed HTML pages.

The native route works on columns. One regular expression walks over a page:
comments, scripts and styles are consumed without result, wanted tags are
matched with quoted attribute values respected. Attributes are then read token
by token, so ``data-src`` or a value that holds ``src=`` is never taken for
``src``. One page is one row all the way, so nothing is shuffled. All loops in
the expressions are possessive: they neither backtrack nor recurse. Scopes that depend on nesting take the parser route
(:func:`scoped_links`).
"""

from __future__ import annotations

import html
import json
from functools import cache
from html.entities import html5

from pyspark.sql import Column, DataFrame, functions as F, types as T

from gleaner.functions.names import media_src
from gleaner.functions.predicates import class_matches, has_suffix, trimmed_text_equals
from gleaner.functions.urls import prefix_unless_http, resolve_url

# What a page leaves open reaches to its end, so every scan moves on: a page
# is read once however broken it is.
_NOISE = (r"!--.*?(?:-->|\z)"
          r"|script\b[^>]*+(?:>.*?(?:</script\s*+>|\z)|\z)"
          r"|style\b[^>]*+(?:>.*?(?:</style\s*+>|\z)|\z)")
_NAME = r"[^\s/>][^\s/>=]*+"
_VALUE = r"""(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+)?+"""
_TOKEN = rf"{_NAME}(?:\s*+=\s*+{_VALUE})?+"
_TOKEN_PARTS = r"""(?s)^(.[^\s=]*+)\s*+=\s*+(?:"(.*)"|'(.*)'|(.*))$"""
# An anchor ends at its end tag, at the next anchor or with the page.
_ANCHOR_BODY = r"(?:[^<]++|<!--.*?(?:-->|\z)|<(?!/?a[\s/>]))*+(?:</a\s*+>)?+"


def _opening(tag: str) -> str:
    """An opening tag without its first ``<``; cut off by the end of the page it has no ``>``."""
    return rf"{tag}(?=[\s/>])(?:[\s/]++|{_TOKEN})*+(?:>|\z)"


def find_elements(html: Column, pattern: str) -> Column:
    """Array of the complete elements that match ``pattern`` (given without the first ``<``), outside of noise."""
    found = F.regexp_extract_all(html, F.lit(rf"(?is)<(?:{_NOISE}|({pattern}))"), F.lit(1))
    return F.filter(found, lambda e: e.contains(">"))


@cache
def _references() -> tuple[str, str]:
    """The named references of HTML as a JSON map, and a pattern of those that need no semicolon."""
    open_names = sorted((n for n in html5 if not n.endswith(";")), key=len, reverse=True)
    names = {n.removesuffix(";"): c for n, c in html5.items()}
    # Numbers that stand for another character, as HTML reads them.
    names |= {f"#{n}": html.unescape(f"&#{n};") for n in (*range(32), *range(127, 160))}
    return json.dumps(names), "^(?:" + "|".join(open_names) + ")"


def _character(number: Column) -> Column:
    """The character of a code point, by its four bytes; what is none becomes U+FFFD."""
    valid = (number < 0xD800) | ((number > 0xDFFF) & (number <= 0x10FFFF))
    code = F.when(valid, number).otherwise(F.lit(0xFFFD))
    return F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")


def unescape(text: Column) -> Column:
    """Text with its character references read as HTML reads them: named, decimal and hexadecimal.

    The text is cut at ``&``; each part begins with a reference or does not.
    """
    table, open_names = _references()
    names = F.from_json(F.lit(table), "map<string,string>")

    def read(part: Column) -> Column:
        digits = F.regexp_extract(part, r"^#(\d++)", 1)
        hexa = F.regexp_extract(part, r"^#[xX]([0-9a-fA-F]++)", 1)
        name = F.regexp_extract(part, r"^([a-zA-Z][a-zA-Z0-9]*+);", 1)
        short = F.regexp_extract(part, open_names, 0)
        # Beyond nine digits no code point is left.
        number = F.when(digits != "", F.least(F.try_to_number(F.left(F.ltrim(digits, F.lit("0")), F.lit(9)), F.lit("999999999")),
                                              F.lit(0x110000)).cast("bigint")).otherwise(
            F.conv(F.left(F.ltrim(hexa, F.lit("0")), F.lit(7)), 16, 10).cast("bigint"))
        number = F.coalesce(number, F.lit(0).cast("bigint"))
        rest = F.regexp_replace(part, r"^#(?:\d++|[xX][0-9a-fA-F]++);?+", "")
        numeric = F.coalesce(F.try_element_at(names, F.concat(F.lit("#"), number.cast("string"))), _character(number))
        return (F.when((digits != "") | (hexa != ""), F.concat(numeric, rest))
                .when((name != "") & F.try_element_at(names, name).isNotNull(),
                      F.concat(F.try_element_at(names, name), F.substr(part, F.length(name) + 2)))
                .when(short != "", F.concat(F.try_element_at(names, short), F.substr(part, F.length(short) + 1)))
                .otherwise(F.concat(F.lit("&"), part)))

    parts = F.split(text, "&")
    decoded = F.concat(F.element_at(parts, 1),
                       F.array_join(F.transform(F.slice(parts, F.lit(2), F.size(parts)), read), ""))
    return F.when(text.contains("&"), decoded).otherwise(text)


def attribute_tokens(element: Column) -> Column:
    """The attributes of an opening tag, in order, as ``name`` or ``name=value`` without quotes."""
    body = F.regexp_replace(element, r"^[^\s/>]++", "")
    tokens = F.regexp_extract_all(body, F.lit(_TOKEN), F.lit(0))
    plain = F.transform(tokens, lambda t: F.regexp_replace(t, _TOKEN_PARTS, "$1=$2$3$4"))
    return F.transform(plain, unescape)


def attribute(tokens: Column, name: str) -> Column:
    """Value of the first attribute with this name: null if absent, empty if it has no value."""
    head = F.lit(len(name) + 1)
    found = F.filter(tokens, lambda t: F.lower(F.left(t, head)).isin(f"{name}=", name))
    return F.substr(F.try_element_at(found, F.lit(1)), F.lit(len(name) + 2))


def _text(element: Column, tag: str) -> Column:
    """Text of an element (given without its first ``<``): no tags, no noise."""
    inner = F.regexp_replace(element, rf"(?is)^{_opening(tag)}", "")
    return F.regexp_replace(inner, rf"(?is)<(?:{_NOISE}|/?+[a-z!](?:[\s/]++|{_TOKEN})*+>)", "")


def _elements(pages: DataFrame, pattern: str, html: str) -> DataFrame:
    keep = [c for c in pages.columns if c != html]
    return pages.select(*keep, F.posexplode(find_elements(F.col(html), pattern)).alias("pos", "_element"))


def _opening_of(anchor: Column) -> Column:
    return F.regexp_extract(anchor, rf"(?is)^{_opening('a')}", 0)


def _anchors(pages: DataFrame, html: str) -> DataFrame:
    found = _elements(pages, _opening("a") + _ANCHOR_BODY, html)
    return found.withColumn("_tokens", attribute_tokens(_opening_of(F.col("_element"))))


def extract_links(pages: DataFrame, html: str = "html") -> DataFrame:
    """One row per ``<a href>`` in document order: ``pos, href, text, class``."""
    return (
        _anchors(pages, html)
        .withColumns({
            "href": attribute(F.col("_tokens"), "href"),
            "class": attribute(F.col("_tokens"), "class"),
            "_text": _text(F.col("_element"), "a"),
        })
        .filter(F.col("href").isNotNull())
        .withColumn("text", unescape(F.col("_text")))
        .drop("_element", "_tokens", "_text")
    )


def first_link_with_text(pages: DataFrame, wanted: str, html: str = "html") -> DataFrame:
    """The first link per page whose trimmed text is ``wanted``: ``pos, href``.

    The links of a page stay in its row, so no shuffle is needed to compare them.
    """
    anchors = find_elements(F.col(html), _opening("a") + _ANCHOR_BODY)
    links = F.transform(anchors, lambda a, i: F.struct(
        i.alias("pos"),
        attribute(attribute_tokens(_opening_of(a)), "href").alias("href"),
        unescape(_text(a, "a")).alias("text")))
    hits = F.filter(links, lambda a: a["href"].isNotNull() & trimmed_text_equals(a["text"], wanted))
    return (pages.withColumn("_first", F.try_element_at(hits, F.lit(1)))
            .filter(F.col("_first").isNotNull())
            .withColumns({"pos": F.col("_first.pos"), "href": F.col("_first.href")})
            .drop("_first", html))


def extract_doc_links(pages: DataFrame, base: str, suffix: str = ".pdf", html: str = "html") -> DataFrame:
    """Links to documents with ``suffix``, made absolute with ``base`` where needed."""
    links = extract_links(pages, html).filter(has_suffix(F.col("href"), suffix))
    return links.withColumn("doc_url", prefix_unless_http(F.lit(base), F.col("href")))


def _media(pages: DataFrame, tag: str, wanted_class: str | None, html: str) -> DataFrame:
    media = (
        _elements(pages, _opening(tag), html)
        .withColumn("_tokens", attribute_tokens(F.col("_element")))
        .withColumns({
            "src": attribute(F.col("_tokens"), "src"),
            "data_src": attribute(F.col("_tokens"), "data-src"),
            "alt": attribute(F.col("_tokens"), "alt"),
            "class": attribute(F.col("_tokens"), "class"),
        })
        .withColumn("media_url", media_src(F.col("src"), F.col("data_src")))
        .drop("_element", "_tokens")
    )
    return media.filter(class_matches(F.col("class"), wanted_class)) if wanted_class else media


def extract_images(pages: DataFrame, wanted_class: str | None = None, html: str = "html") -> DataFrame:
    """One row per ``<img>``: ``pos, src, data_src, alt, class, media_url``."""
    return _media(pages, "img", wanted_class, html)


def extract_videos(pages: DataFrame, wanted_class: str | None = None, html: str = "html") -> DataFrame:
    """One row per ``<video>``, same columns as images."""
    return _media(pages, "video", wanted_class, html)


def extract_linked_images(pages: DataFrame, wanted_class: str, base: Column, html: str = "html") -> DataFrame:
    """The first image inside each anchor of a class, with its URL resolved against ``base``."""
    image = F.try_element_at(find_elements(F.col("_element"), _opening("img")), F.lit(1))
    return (
        _anchors(pages, html)
        .filter(class_matches(attribute(F.col("_tokens"), "class"), wanted_class))
        .withColumn("_image", image)
        .filter(F.col("_image").isNotNull())
        .withColumn("_tokens", attribute_tokens(F.col("_image")))
        .withColumns({
            "src": attribute(F.col("_tokens"), "src"),
            "alt": attribute(F.col("_tokens"), "alt"),
        })
        .withColumn("media_url", F.when(F.col("src").isNotNull(), resolve_url(base, F.col("src"))))
        .drop("_element", "_tokens", "_image")
    )


def linked_images(html: Column, wanted_class: str, base: Column) -> Column:
    """``media_url, alt`` of the first image inside each anchor of a class, as an array in the page's own row."""
    anchors = F.filter(find_elements(html, _opening("a") + _ANCHOR_BODY), lambda a: class_matches(
        attribute(attribute_tokens(_opening_of(a)), "class"), wanted_class))
    # Step by step, so that no step is computed again where its result is used twice.
    images = F.transform(anchors, lambda a: F.try_element_at(find_elements(a, _opening("img")), F.lit(1)))
    tokens = F.transform(images, attribute_tokens)
    found = F.transform(tokens, lambda t: F.struct(attribute(t, "src").alias("src"), attribute(t, "alt").alias("alt")))
    return F.transform(F.filter(found, lambda i: i["src"].isNotNull()), lambda i: F.struct(
        resolve_url(base, i["src"]).alias("media_url"), i["alt"].alias("alt")))


def image_sources(html: Column) -> Column:
    """All ``img`` sources of a page in document order, as an array in the page's own row."""
    sources = F.transform(find_elements(html, _opening("img")),
                          lambda t: attribute(attribute_tokens(t), "src"))
    return F.filter(sources, lambda s: s.isNotNull())


def page_signature(pages: DataFrame, html: str = "html") -> DataFrame:
    """``n_images`` and a digest of the ordered image sources per page; no shuffle."""
    return (pages.withColumn("_src", image_sources(F.col(html)))
            .withColumns({
                "n_images": F.size("_src").cast("bigint"),
                # JSON keeps ["a b"] and ["a", "b"] apart.
                "signature": F.md5(F.to_json("_src")),
            }).drop("_src", html))


def _scope_parser(tag: str | None, wanted_class: str, first_only: bool):
    from html.parser import HTMLParser

    # HTML elements that never have an end tag.
    void = {"area", "base", "br", "col", "embed", "hr", "img", "input",
            "link", "meta", "param", "source", "track", "wbr"}

    class ScopeParser(HTMLParser):
        """Links below the scope; every tag and every piece of text is handled once."""

        def __init__(self):
            super().__init__(convert_charrefs=True)
            self.open, self.names, self.scopes_seen, self.depth = [], {}, 0, 0
            self.links, self.current = [], None

        def handle_starttag(self, name, attrs):
            values = {}
            for key, value in attrs:
                values.setdefault(key, value or "")
            starts = (wanted_class in values.get("class", "").split() and (tag is None or name == tag)
                      and not (first_only and self.scopes_seen))
            link = None
            if name == "a":                       # an anchor ends where the next one begins
                self.current = None
                if "href" in values and self.depth:
                    link = self.current = (values["href"], [])
                    self.links.append(link)
            self.scopes_seen += starts
            if name in void:
                return
            self.open.append((name, starts, link))
            self.names[name] = self.names.get(name, 0) + 1
            self.depth += starts

        def handle_endtag(self, name):
            if not self.names.get(name):
                return
            while True:
                opened, scoped, link = self.open.pop()
                self.names[opened] -= 1
                self.depth -= scoped
                if link is not None and link is self.current:
                    self.current = None
                if opened == name:
                    break

        def handle_data(self, data):
            if self.current is not None:
                self.current[1].append(data)

    return ScopeParser


def _scoped(tag: str | None, wanted_class: str, first_only: bool):
    def links_in_scope(batches):
        import pyarrow as pa

        parse = _scope_parser(tag, wanted_class, first_only)
        for batch in batches:
            rows, place, href, text = [], [], [], []
            for row, page in enumerate(batch.column("_html").to_pylist()):
                parser = parse()
                parser.feed(page or "")
                parser.close()
                rows += [row] * len(parser.links)
                place += range(len(parser.links))
                href += [link[0] for link in parser.links]
                text += ["".join(link[1]) for link in parser.links]
            # The page's other columns are taken as they are, never converted.
            keys = batch.select([c for c in batch.schema.names if c != "_html"]).take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*keys.columns, pa.array(place, pa.int32()), pa.array(href, pa.string()), pa.array(text, pa.string())],
                [*keys.schema.names, "pos", "href", "text"])

    return links_in_scope


def scoped_links(pages: DataFrame, wanted_class: str, tag: str | None = None,
                 first_only: bool = False, html: str = "html") -> DataFrame:
    """Links below elements of a class: ``pos, href, text`` plus the page's other columns.

    ``tag`` restricts the scope element, ``first_only`` takes the first such
    element only. Pages that hold the class name nowhere, and write no class
    with a character reference, never reach Python.
    """
    keep = [f for f in pages.schema.fields if f.name != html]
    schema = T.StructType(list(keep)).add("pos", "integer").add("href", "string").add("text", "string")
    spelt = F.col(html).rlike(r"""(?i)class\s*+=\s*+(?:"[^"&]*+&|'[^'&]*+&|[^\s>"'&]*+&)""")
    candidates = pages.filter(F.col(html).contains(wanted_class) | spelt)
    slim = candidates.select(*[f.name for f in keep], F.col(html).alias("_html"))
    return slim.mapInArrow(_scoped(tag, wanted_class, first_only), schema)
