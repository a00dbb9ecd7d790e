"""HTML extraction: quoting, entities, noise, scopes; native route against an HTML parser."""

import time
from html.parser import HTMLParser

from hypothesis import Phase, given, settings, strategies as st
from pyspark.sql import functions as F

from gleaner.operators import extract

PAGE = """<html><!-- <a href="/comment">x</a> --><script>var a='<a href="/script">'</script>
<style>a[href="/style"]{}</style><A HREF='/one?a=1&amp;b=2' class=foo>On<b>e</b></A><a name=x>no href</a>
<a href=/two>T&lt;w</a><abbr href="/abbr">no</abbr>
<a class="card link" title="a > b" href="/p/1"><IMG class='thumb wide' alt="x src=q" data-src="/d.png" src="https://h/x.jpg">
<img src="/second.jpg"></a><a class="link"></a>
<img src="" data-src='//h/y.png'><img alt=z><image src="no"><video class="clip" src="v.mp4" alt="v 1"></video>
<a href="/last">unclosed"""

ENTRY = """<div class="entry x"><a href="1.pdf">one</a><div class="in"><a href="2.pdf">t<b>w</b>o</a></div>
<br><img src=x><a href="3.pdf">three</div><a href="out.pdf">out</a>
<div class="entry"><a href="4.pdf">second entry</a></div><section class="row"><p><a href="5.pdf">row &amp; five</a></section>"""


def pages(spark, *html):
    return spark.createDataFrame([(i, f"https://h.org/a/b?p={i}", h) for i, h in enumerate(html)],
                                 "page_id int, url string, html string")


def test_links(spark):
    got = extract.extract_links(pages(spark, PAGE)).orderBy("pos").collect()
    assert [(r.href, r.text.strip(), r["class"]) for r in got] == [
        ("/one?a=1&b=2", "One", "foo"), ("/two", "T<w", None), ("/p/1", "", "card link"), ("/last", "unclosed", None)]


def test_images(spark):
    got = extract.extract_images(pages(spark, PAGE)).orderBy("pos").collect()
    assert [(r.src, r.data_src, r.alt, r.media_url) for r in got] == [
        ("https://h/x.jpg", "/d.png", "x src=q", "https://h/x.jpg"), ("/second.jpg", None, None, "/second.jpg"),
        ("", "//h/y.png", None, "//h/y.png"), (None, None, "z", None)]
    assert extract.extract_images(pages(spark, PAGE), "thumb").count() == 1
    assert extract.extract_images(pages(spark, PAGE), "thumb wide").count() == 1
    assert extract.extract_images(pages(spark, PAGE), "wide thumb").count() == 0
    assert extract.extract_videos(pages(spark, PAGE), "clip").first().src == "v.mp4"


def test_linked_images(spark):
    got = extract.extract_linked_images(pages(spark, PAGE), "link", F.col("url")).collect()
    assert [(r.media_url, r.alt) for r in got] == [("https://h/x.jpg", "x src=q")]


def test_signature_tells_pages_apart(spark):
    same = '<img src="a"><img src="b c">'
    got = extract.page_signature(pages(spark, same, same + "<p>text</p>", '<img src="a b"><img src="c">', "", "<img alt=x>"))
    rows = {r.page_id: r for r in got.collect()}
    assert rows[0].signature == rows[1].signature != rows[2].signature
    assert [rows[i].n_images for i in range(5)] == [2, 2, 2, 0, 0]


def test_scopes(spark):
    df = pages(spark, ENTRY, "<p>none</p>", "")
    first = extract.scoped_links(df, "entry", tag="div", first_only=True).orderBy("pos").collect()
    assert [(r.href, r.text) for r in first] == [("1.pdf", "one"), ("2.pdf", "two"), ("3.pdf", "three")]
    assert first[0].url == "https://h.org/a/b?p=0"
    row = extract.scoped_links(df, "row").collect()
    assert [(r.href, r.text) for r in row] == [("5.pdf", "row & five")]
    every = extract.scoped_links(df, "entry").count()
    assert every == 4


def test_first_link_with_text(spark):
    df = pages(spark, '<a href="/1">x</a><a href="/2"> Get it </a><a href="/3">Get it</a>')
    hits = extract.first_link_with_text(df, "Get it").collect()
    assert [r.href for r in hits] == ["/2"]


def test_doc_links(spark):
    df = pages(spark, '<a href="/a.pdf">1</a><a href="http://x/b.pdf">2</a><a href="/c.pdf?x">3</a>')
    got = [r.doc_url for r in extract.extract_doc_links(df, "https://h.org").orderBy("pos").collect()]
    assert got == ["https://h.org/a.pdf", "http://x/b.pdf"]


class Reader(HTMLParser):
    def __init__(self):
        super().__init__()
        self.found = []

    def handle_starttag(self, tag, attrs):
        values = {}
        for key, value in attrs:
            values.setdefault(key, value or "")
        if tag == "img":
            self.found.append((values.get("src"), values.get("alt")))

    handle_startendtag = handle_starttag


VALUE = st.text(alphabet="ab /=&<>.?", max_size=8).map(lambda s: s.replace("&", "&amp;"))
ATTR = st.one_of(
    st.tuples(st.sampled_from(["src", "alt", "data-src", "SRC", "class"]), VALUE).map(lambda p: f'{p[0]}="{p[1]}"'),
    st.tuples(st.sampled_from(["src", "alt", "title"]), VALUE).map(lambda p: f"{p[0]} = '{p[1]}'"),
    st.sampled_from(["hidden", "src=plain.png", "alt=x", "alt=5\"", "'", '"', "=x", "alt=", "src=/a/b/", "/", "alt='x'src='y'"]))
TAG = st.one_of(st.lists(ATTR, max_size=4).map(lambda a: f"<img {' '.join(a)}>"),
                st.sampled_from(["<p>text</p>", "<!-- <img src='no'> -->", "a < b", "<script>'<img src=s>'</script>"]))


@settings(max_examples=4, deadline=None, derandomize=True, phases=[Phase.generate])
@given(st.lists(st.lists(TAG, max_size=6).map("".join), min_size=40, max_size=80))
def test_images_are_those_of_a_parser(spark, html):
    got = {}
    for r in extract.extract_images(pages(spark, *html)).orderBy("page_id", "pos").collect():
        got.setdefault(r.page_id, []).append((r.src, r.alt))
    for i, text in enumerate(html):
        reader = Reader()
        reader.feed(text)
        reader.close()
        assert got.get(i, []) == reader.found, text


def test_long_and_broken_pages(spark):
    """Megabytes in one attribute, an anchor or a comment that never ends."""
    long = "x" * 1_000_000
    df = pages(spark, f'<img src="data:{long}" alt="ok"><a href="/a">{long}', f"<a href='/b'>t</a><!-- {long}",
               "<a " * 50_000, '<img src="' * 20_000, "<script>" * 20_000)
    df_text = ["<a " * 300_000, "<a href='" * 100_001, "<script>" * 100_000, "<!-- <a href=x>" * 100_000, "<style <" * 100_000]
    start = time.time()
    assert extract.extract_images(df).filter("page_id = 0").first().alt == "ok"
    assert [len(r.text) for r in extract.extract_links(df).filter("page_id < 2").orderBy("page_id").collect()] == [1_000_000, 1]
    extract.extract_links(df).count()
    assert extract.extract_links(pages(spark, *df_text)).count() == 0
    assert time.time() - start < 30


REF = st.sampled_from(["&amp;", "&#38;", "&#x26;", "&lt;", "&eacute;", "&notin;", "&#8364;", "&#x1F600;", "&#128;", "&#0;",
                       "&bogus;", "& ", "a", "b c", "é"])
TEXT = st.lists(REF, max_size=6).map("".join)


@settings(max_examples=3, deadline=None, derandomize=True, phases=[Phase.generate])
@given(st.lists(st.tuples(TEXT, TEXT), min_size=40, max_size=60))
def test_both_routes_read_references_alike(spark, found):
    df = pages(spark, *[f'<div class="in"><a href="/x{h}">t{t}</a></div>' for h, t in found])
    native = extract.extract_links(df).select("page_id", "href", "text").collect()
    parsed = extract.scoped_links(df, "in").select("page_id", "href", "text").collect()
    assert sorted(map(tuple, native)) == sorted(map(tuple, parsed)) and len(native) == len(found)


def test_every_reference(spark):
    import html
    from html.entities import html5

    texts = [f"x&{n}y" for n in html5] + ["&#99999999999;", "&#xD800;", "&#x110000;", "&#;", "&#x;", "&", "&&amp;;", "&copy2024"]
    rows = spark.createDataFrame([(t,) for t in texts], "s string").select("s", extract.unescape(F.col("s")).alias("u"))
    assert all(r.u == html.unescape(r.s) for r in rows.collect())


def test_scopes_keep_keys_and_read_references(spark):
    df = spark.createDataFrame([(9007199254740993, '<p class="w&#97;nted"><a href="/1">x</a></p>'), (None, "<p></p>"),
                                (5, '<p class="wanted"><a href=/2>y<a href=/3>z</a></p>')], "page_id long, html string")
    got = [tuple(r) for r in extract.scoped_links(df, "wanted").orderBy("href").collect()]
    assert got == [(9007199254740993, 0, "/1", "x"), (5, 0, "/2", "y"), (5, 1, "/3", "z")]


def test_scopes_of_broken_pages_are_linear(spark):
    """Two megabytes of tags that are never closed, with end tags of others between them."""
    open_ = '<div class="in">' + "<div><p><a href=x>y</i></b>" * 80_000
    start = time.time()
    assert extract.scoped_links(pages(spark, open_), "in").count() == 80_000
    assert time.time() - start < 5
