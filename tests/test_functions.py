import pytest
from pyspark.sql import functions as F

from gleaner.functions import dates, fields, text, urls

c = F.col


@pytest.mark.parametrize(
    "raw, n", [("", 0), (None, 0), ("a b　c\u001cd", 4), (" x \n", 1), (" ", 0), ("a\u0085b", 2)]
)
def test_word_count(value, raw, n):
    assert value(text.word_count(c("t")), t=raw) == n


def test_word_count_equals_split(value):
    raw = "".join(chr(i) + ("x" if i % 3 else " y ") for i in range(1, 0x3100))
    assert value(text.word_count(c("t")), t=raw) == len(raw.split())


@pytest.mark.parametrize(
    "raw, expected",
    [
        ("x" * 500, "x" * 500),
        ("x" * 501, "x" * 500 + "..."),
        ("x" * 498 + " yyyy", "x" * 498 + "..."),
        ("😀" * 501, "😀" * 500 + "..."),
        ("a\nb" * 200, ("a\nb" * 200)[:500] + "..."),
        ("", ""),
    ],
)
def test_summary(value, raw, expected):
    assert value(text.summary(c("t")), t=raw) == expected


@pytest.mark.parametrize("words, minutes", [(0, 1), (199, 1), (399, 1), (400, 2)])
def test_reading_minutes(value, words, minutes):
    assert value(text.reading_minutes(F.lit(words))) == minutes


@pytest.mark.parametrize(
    "raw, expected",
    [
        ("<p> a </p><!-- x --><p></p><b>b</b>", "a\nb"),
        ("a<!-- x -->b", "a\nb"),
        ("<p>a\n  b</p>", "a\n  b"),
        ("a &amp; b", "a & b"),
        ("x<script>var t='</p>';</script>y<style>p{}</style>", "x\ny"),
        ("2 < 3 and 4 > 1", "2 < 3 and 4 > 1"),
        ("", ""),
    ],
)
def test_fragment_text(value, raw, expected):
    assert value(text.fragment_text(c("t")), t=raw) == expected


@pytest.mark.parametrize(
    "raw, expected",
    [
        ("&amp;lt;", "&lt;"),
        ("&#8217;&#x1F600;&eacute;&apos;", "’😀é'"),
        ("AT&T &nosuch; &#0; &#xD800; &#1114112; & end&", "AT&T &nosuch; &#0; &#xD800; &#1114112; & end&"),
        ("no entity", "no entity"),
        (None, None),
    ],
)
def test_unescape(value, raw, expected):
    assert value(text.unescape(c("t")), t=raw) == expected


PAGE = """<html><head><title>T &amp; t</title><script>var a="<p>";</script></head><body>
<nav><a href="/n">n</a></nav><div>ad</div><article><h1>Head</h1><p><b>one  two<br>three<p>a&lt;b
<aside>side</aside><table><tr><td>x</td><td>y</td></tr></table></article><footer>f</footer></body></html>"""


def test_main_text(value):
    assert value(text.main_text(c("t")), t=PAGE) == "Head\none two\nthree\na<b\nx\ny"
    assert value(text.main_text(c("t")), t="<main>m</main><p>out</p>") == "m"
    assert value(text.main_text(c("t")), t="<body><p>b</p></body>") == "b"
    assert value(text.main_text(c("t")), t="plain <i>te</i>xt") == "plain text"


def test_page_title(value):
    assert value(text.page_title(c("t")), t=PAGE) == "Head"
    assert value(text.page_title(c("t")), t="<title> a\n b </title>") == "a b"
    og = "<meta content='O &amp; G' property='og:title'>" + PAGE
    assert value(text.page_title(c("t")), t=og) == "O & G"
    assert value(text.page_title(c("t")), t="<p>x</p>") is None


def test_page_author(value):
    assert value(text.page_author(c("t")), t='<meta name="author" content=" A &amp; B ">') == "A & B"
    assert value(text.page_author(c("t")), t="<p>x</p>") == ""


@pytest.mark.parametrize(
    "raw, iso",
    [
        ("2025-01-15", "2025-01-15T00:00:00"),
        ("2025-01-15T23:30:00-05:00", "2025-01-15T23:30:00-05:00"),
        (" 2025-01-15 10:00:00.5Z ", "2025-01-15T10:00:00.500000+00:00"),
        ("Wed, 15 Jan 2025 10:00:00 GMT", "2025-01-15T10:00:00+00:00"),
        ("5 September 2025 10:00 +0200", "2025-09-05T10:00:00+02:00"),
        ("Wed, 15 Jan 2025 10:00:00 EST", "2025-01-15T10:00:00"),
        ("January 5, 2025", "2025-01-05T00:00:00"),
        ("20250105", "2025-01-05T00:00:00"),
        ("2025-03", "2025-03-01T00:00:00"),
        ("2025", "2025-01-01T00:00:00"),
        ("2025-02-30", None),
        ("15 Foo 2025", None),
        ("junk", None),
        ("", None),
        (None, None),
        ("1 May 2019 10:00 PM", "2019-05-01T22:00:00"),
        ("May 1, 2019 12:30 a.m.", "2019-05-01T00:30:00"),
        ("1 May 2019 13:00 PM", None),
        ("2019/05/01", "2019-05-01T00:00:00"),
        ("2019-5-1 9:05", "2019-05-01T09:05:00"),
        ("05/01/2019", "2019-05-01T00:00:00"),
        ("1-May-2019", "2019-05-01T00:00:00"),
        ("20190501T100000Z", "2019-05-01T10:00:00+00:00"),
        ("Wed May  1 10:00:00 2019", "2019-05-01T10:00:00"),
        ("Wed, 01 May 19 10:00:00 GMT", "2019-05-01T10:00:00+00:00"),
        ("1 May 99", "1999-05-01T00:00:00"),
    ],
)
def test_parse_date(value, raw, iso):
    assert value(dates.parse_date(c("t")), t=raw) == iso


def test_instant_and_local_day(value):
    late = "2025-01-15T23:30:00-05:00"
    micros = F.unix_micros(dates.instant(c("t")))
    assert value(micros, t=late) == 1737001800 * 10**6
    assert value(dates.local_day(c("t")), t=late) == "2025-01-15"
    assert value(micros, t="2025-01-16T04:30:00") == 1737001800 * 10**6
    assert value(dates.instant(c("t")), t="no date") is None
    assert value(dates.local_day(c("t")), t=None) == ""


def test_instant_does_not_depend_on_the_session_zone(spark, value):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        micros = value(F.unix_micros(dates.instant(dates.parse_date(c("t")))), t="January 5, 2025")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert micros == 1736035200 * 10**6


def test_first_date_skips_unreadable(value):
    found = dates.first_date(c("a"), c("b"))
    assert value(found, a="junk", b="Wed, 15 Jan 2025 10:00:00 GMT") == "2025-01-15T10:00:00+00:00"


def test_jsonld_date(value):
    script = '<script type="application/ld+json">{}</script>'.format
    listed = script('[{"name": "x"}, {"dateCreated": "2025-02-03"}]')
    assert value(dates.jsonld_date(c("t")), t=listed) == "2025-02-03T00:00:00"
    good = script('{"datePublished": "2025-02-04"}')
    assert value(dates.jsonld_date(c("t")), t=script("{bad") + good) == "2025-02-04T00:00:00"
    nested = script('{"@graph": [{"datePublished": "2025-02-04"}]}')
    assert value(dates.jsonld_date(c("t")), t=nested) is None


def test_meta_time_and_url_dates(value):
    assert value(dates.meta_date(c("t")), t='<meta content="2025-01-05" name="date">') == "2025-01-05T00:00:00"
    both = '<meta name="date" content="2025-01-05"><meta name="DC.date" content="x">'
    assert value(dates.meta_date(c("t")), t=both) == "2025-01-05T00:00:00"
    assert value(dates.meta_date(c("t")), t='<meta name="DCxdate" content="2025-01-05">') is None
    times = "<time>x</time><time datetime='2025-01-06'></time>"
    assert value(dates.time_date(c("t")), t=times) == "2025-01-06T00:00:00"
    assert value(dates.url_date(c("t")), t="https://x/2026/01/15/x") == "2026-01-15T00:00:00"
    assert value(dates.url_date(c("t")), t="https://x/2026-01-15-x") == "2026-01-15T00:00:00"
    assert value(dates.url_date(c("t")), t="https://x/2026/13/40/x") is None


def test_page_date_prefers_jsonld_to_url(value):
    html = '<script type="application/ld+json">{"datePublished": "2025-02-04"}</script>'
    found = dates.page_date(c("h"), c("u"))
    assert value(found, h=html, u="https://x/2026/01/15/x") == "2025-02-04T00:00:00"
    assert value(found, h="", u="https://x/2026/01/15/x") == "2026-01-15T00:00:00"


@pytest.mark.parametrize(
    "href, kept",
    [
        ("/Careers", False),
        ("/blog/tags/a", True),
        ("/tag/a", False),
        ("https://docs.x.com/p", False),
        ("/a.PDF", False),
        ("/a.pdf?x=1", True),
        ("/", False),
        ("", False),
        ("/page/12", False),
        ("/page/x", True),
    ],
)
def test_skipped_links(value, href, kept):
    assert value(~urls.is_skipped_link(c("t")), t=href) is kept


def test_excluded_urls_are_case_sensitive(value):
    assert value(urls.is_excluded(c("t")), t="https://x/careers") is True
    assert value(urls.is_excluded(c("t")), t="https://x/Careers") is False
    assert value(urls.is_excluded(c("t")), t=None) is False


@pytest.mark.parametrize(
    "href, url",
    [
        ("/p", "https://b.com/p"),
        ("//cdn.x/p", "https://b.com//cdn.x/p"),
        ("https://b.com/q#f", "https://b.com/q#f"),
        ("https://other.com/z", None),
        ("mailto:x", None),
        ("/", None),
        ("https://b.com", None),
        ("httpfoo", None),
        ("https://user@b.com/p", None),
    ],
)
def test_links_on_site(value, href, url):
    full = urls.resolve(c("t"), F.lit("https://b.com"))
    assert value(F.when(urls.is_article_link(full, F.lit("https://b.com")), full), t=href) == url


def test_article_id(value):
    assert value(fields.article_id(c("s"), c("u")), s="s", u="https://x.com/a") == "s_f51edb1a34cb"


CONTENT = "content ARRAY<STRUCT<value: STRING>>, summary STRING, description STRING"


@pytest.mark.parametrize(
    "content, summary, description, expected",
    [
        ([("",)], "s", "d", ""),
        ([(None,)], "s", "d", ""),
        ([("c",), ("e",)], "s", "d", "c"),
        ([], "s", "d", "s"),
        (None, "", "d", "d"),
        (None, None, None, ""),
    ],
)
def test_chosen_html(value, content, summary, description, expected):
    found = fields.chosen_html(c("content"), c("summary"), c("description"))
    assert value(found, content=content, summary=summary, description=description, schema=CONTENT) == expected


AUTHORS = "author STRING, authors ARRAY<STRUCT<name: STRING>>"


@pytest.mark.parametrize(
    "author, authors, expected",
    [
        (None, [("A",), ("B",), ("C",), ("D",)], "A, B, C"),
        ("", [(None,)], "Site"),
        (None, [(None,), ("B",)], ", B"),
        ("X", [("A",)], "X"),
        (None, None, "Site"),
    ],
)
def test_chosen_author(value, author, authors, expected):
    found = fields.chosen_author(c("author"), c("authors"), F.lit("Site"))
    assert value(found, author=author, authors=authors, schema=AUTHORS) == expected


def test_merged_tags(value):
    found = fields.merged_tags(c("d"), c("t"), text.strip)
    schema = "d ARRAY<STRING>, t ARRAY<STRING>"
    assert value(found, d=["rag"], t=["RAG ", "New", None, "", "  "], schema=schema) == ["", "new", "rag"]
    assert value(found, d=None, t=None, schema=schema) == []


def test_retry_delay(value):
    assert [value(fields.retry_delay(F.lit(n))) for n in (0, 3, 6)] == [1.0, 8.0, 60.0]


def test_document_name(value):
    name = fields.document_name(c("i"), c("p"))
    assert value(name, i="my_src_abc123def456", p="2025-01-15T01:00:00") == "my_src_2025-01-15_abc123def456.txt"
    assert value(name, i="my_src_abc123def456", p=None) == "my_src_abc123def456.txt"


def test_markup_in_comments_and_scripts_is_not_read(value):
    hidden = "<!-- <a href='/old'>x</a><h1>Old</h1><time datetime='2001-01-01'></time><meta name='date' content='2001-01-01'> -->"
    hidden += "<script>var a = '<a href=\"/js\">x</a>'</script>"
    page = hidden + "<a class=b href=/plain>x</a><h1>New</h1><time datetime=2025-01-06></time><meta name=date content=2025-01-05>"
    assert value(urls.hrefs(c("t")), t=page + "<a href=''>e</a><a href=\"/it's\">q</a>") == ["/plain", "", "/it's"]
    assert value(text.page_title(c("t")), t=page) == "New"
    assert value(dates.time_date(c("t")), t=page) == "2025-01-06T00:00:00"
    assert value(dates.meta_date(c("t")), t=page) == "2025-01-05T00:00:00"
    listed = '<script type=application/ld+json>{"datePublished": "2025-02-04"}</script>'
    assert value(dates.jsonld_date(c("t")), t=listed) == "2025-02-04T00:00:00"


def test_a_form_around_the_article_drops_nothing(value):
    page = "<body><form><nav>n</nav><article><p>a</p><form>f</form><p>b</p></article></form></body>"
    assert value(text.main_text(c("t")), t=page) == "a\nb"


@pytest.mark.parametrize(
    ("html", "expected"),
    [
        ("<article><p>a</p><aside>x<aside>y</aside>z</aside><p>b</p></article>", "a\nb"),
        ("<article><nav>1<header>2<nav>3</nav>4</header>5</nav>text</article>", "text"),
        ("<article><p>one</p></article><p>between</p><article class='x'><p>two</p></article><p>after</p>", "one\ntwo"),
        ("<article>a<article>inner</article>b<article>other</article>c</article>", "a\ninner\nb\nother\nc"),
        ("<body><form><main><p>in a form</p></main></form></body>", "in a form"),
        ("<p>no body</p><nav>menu<aside>x</nav><p>more</p>", "no body\nmore"),
        ("<p>no body</p><aside>never closed", "no body\nnever closed"),
        ("<article><aside>" + "word <b>x</b> " * 30_000 + "</aside><p>kept</p></article>", "kept"),
    ],
)
def test_main_text_of_nested_markup(value, html, expected):
    assert value(text.main_text(F.col("html")), html=html) == expected


def test_dates_in_commented_scripts_do_not_count(value):
    script = '<script type="application/ld+json">{"datePublished": "%s"}</script>'
    html = "<!-- " + script % "2020-01-01" + " -->" + script % "2025-02-03"
    assert value(dates.jsonld_date(F.col("html")), html=html).startswith("2025-02-03")
