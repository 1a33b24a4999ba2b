"""Language, page text, quality and archives."""

import base64
import gzip
import hashlib
import re
from collections import Counter

import numpy as np
import pytest

from gleaner.llm import html_text, language, quality, warc
from pyspark.sql import functions as F


def phrases(text, sample):
    count = at = 0
    while at < len(text):
        size = 0
        while at + size < len(text) and text[at : at + size + 1] in sample:
            size += 1
        count, at = count + 1, at + max(1, size)
    return count


def test_step_table_parses_into_longest_phrases(monkeypatch):
    rng = np.random.default_rng(0)
    monkeypatch.setattr(language, "symbols_of", lambda text, codes: np.frombuffer(text, np.uint8))
    for _ in range(60):
        sample = bytes(rng.choice([0, 2, 3, 4], rng.integers(1, 60)).astype(np.uint8))
        texts = [bytes(rng.integers(0, 5, rng.integers(1, 250)).astype(np.uint8)) for _ in range(4)]
        found, sizes = language.phrase_counts(texts, np.zeros(1, np.uint8), [language.step_table(np.frombuffer(sample, np.uint8), 8)])
        assert found[:, 0].tolist() == [phrases(t, sample) for t in texts]
        assert sizes.tolist() == [len(t) for t in texts]


def test_languages_of_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = language.languages(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == docs.count() and held
    assert sum(r.lang_pred == r.lang for r in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_languages_of_edge_rows(edges, empty):
    found = {r.doc_id: r for r in language.languages(edges).collect()}
    assert [found[k].lang_pred for k in (1, 2, 3, 6)] == ["und"] * 4
    assert found[7].lang_pred == "en" and found[8].lang_pred == "de"
    assert language.languages(empty).collect() == []
    unlearned = edges.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in language.languages(unlearned).collect()} == {"und"}


PAGE = (
    '<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p><p>no</p>";</script></head><body class="has-sidebar">'
    '<nav><ul><li><a href="/x">menu</a></li></ul></nav><!-- ad <p>no</p> --><div class="ad">advert text</div>'
    "<article><h1>Head &amp;\n line</h1><p><b>First  part<br>goes on<p>Second &lt;p&gt; of %s</p>"
    "<ul><li>one</li><li>two</li></ul><aside>side</aside><form><p>form</p></form></article>"
    '<div class="comments"><p>a long comment of a reader that says very much about all of this and even more than the article says</p></div>'
    "<footer>foot</footer></body></html>"
)


def test_main_text(spark):
    rows = [(k, f"https://Host.example/{k}", PAGE % k) for k in range(5)]
    rows += [(10, None, None), (11, "x", ""), (12, "https://host.example/cut", PAGE[: PAGE.index("<ul><li>one")] + "<p")]
    rows += [(13, "https://other.example/", "<div><p>only text here</p></div><p>and")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit(1)).withColumn("paths", F.lit(1))
    found = {r.page_id: r for r in html_text.main_texts(frame).collect()}
    for k in range(5):
        assert found[k].text == f"Head & line\n\nFirst part goes on\n\nSecond <p> of {k}\n\none\n\ntwo"
        assert found[k].n_chars == len(found[k].text)
    assert found[10].text == found[11].text == ""
    assert found[12].text == "Head & line\n\nFirst part goes on\n\nSecond <p> of %s"
    assert found[13].text.startswith("only text here")
    assert html_text.main_texts(frame.where("false")).collect() == []


def plain_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[k : k + 5]) for k in range(len(words) - 4)]
    often = Counter(windows)
    inside = {k + i for k, w in enumerate(windows) if often[w] > 1 for i in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside)
    )


@pytest.mark.parametrize("which", ["documents", "edges", "empty"])
def test_quality_counts(which, request):
    docs = request.getfixturevalue(which)
    found = quality.judged(docs).select("doc_id", "counts", "base_failed", "kept").collect()
    expected = Counter((r.doc_id, plain_counts(r.text)) for r in docs.select("doc_id", "text").collect())
    assert Counter((r.doc_id, tuple(r.counts)[:5]) for r in found) == expected
    for r in found:
        assert r.base_failed == (r.counts.n_words < 10 or 100 * r.counts.n_repeat_words > 20 * r.counts.n_words)
        assert not (r.base_failed and r.kept)


def test_quality_agrees_with_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = quality.judged(docs).join(labels, "doc_id").select("base_failed", "kept", "quality").collect()
    good = [r.kept for r in rows if r.quality == 1 and not r.base_failed]
    bad = [r.kept for r in rows if r.quality == 0]
    assert sum(good) / len(good) > 0.97
    assert sum(bad) / len(bad) < 0.1
    kept = quality.good_documents(docs)
    assert kept.columns == docs.columns
    assert kept.count() == quality.judged(docs).where("kept").count()


def test_archive_round_trip(spark):
    html = ["<p>a</p>", "<p>b</p>", "<p>a</p>", None, "", "<p>é</p>", "<p>a</p>"]
    rows = [(k, None if k == 1 else f"http://h/{k} x", t) for k, t in enumerate(html)] + [(None, "http://h", "<p>z</p>"), (6, "http://h", "<p>a</p>")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("code", F.lit(1)).withColumn("first", F.lit(1))
    found = sorted((tuple(r) for r in warc.page_table(spark, frame).collect()), key=str)
    largest = {}
    for page, _, text in rows:
        if page is not None:
            largest[text or ""] = max(page, largest.get(text or "", page))
    expected = []
    for page, _, text in rows:
        body = (text or "").encode()
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        to = largest.get(text or "")
        expected.append((page, len(body), digest, "response", None) if page == to or to is None else (page, len(body), digest, "revisit", to))
    assert found == sorted(expected, key=str)
    assert warc.page_table(spark, frame.where("false")).collect() == []


@pytest.mark.parametrize("packed", [True, False])
def test_salvage_finds_later_records_and_logs_gaps(packed):
    plain = [warc.page_record(k, "http://h", b"<p>%d</p>" % k * 50, warc.base32_sha1(b"<p>%d</p>" % k * 50), None, "2025-01-01T00:00:00Z") for k in range(6)]
    pieces = [warc.member(p) for p in plain] if packed else plain
    if packed:
        assert [gzip.decompress(p) for p in pieces] == plain
    whole = b"".join(pieces)
    starts = np.cumsum([0, *map(len, pieces)]).tolist()

    def read(data, **where):
        return list(warc.salvage(lambda n, at: data[at : at + n], len(data), **where))

    assert [r.start for r in read(whole)] == starts[:-1]
    for at in (starts[2] + len(pieces[2]) // 2, starts[2]):
        broken = bytearray(whole)
        broken[at] ^= 0x55
        found = read(bytes(broken))
        gaps = [(g.start, g.end) for g in found if isinstance(g, warc.Gap)]
        assert gaps == [(starts[2], starts[3])]
        assert [r.start for r in found if isinstance(r, warc.Record)] == [s for s in starts[:-1] if s != starts[2]]
    cut = read(whole[: starts[5] + 10])
    assert isinstance(cut[-1], warc.Gap) and cut[-1].start == starts[5]
    noisy = read(b"noise" + whole)
    assert isinstance(noisy[0], warc.Gap) and noisy[0].end == 5
    middle = starts[3] - 7
    parts = read(whole, stop=middle) + read(whole, start=middle)
    assert [r.start for r in parts] == starts[:-1]
    assert read(b"") == []


def test_long_headers_are_read_back(spark, monkeypatch):
    long = "http://h/?q=" + "é " * 60_000
    rows = [(1, "http://h/1", "<p>a</p>"), (2, long, "<p>b</p>"), (3, "http://h/3", "<p>c</p>")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert sorted(r.page_id for r in warc.page_table(spark, frame).collect()) == [1, 2, 3]
    plain = b"".join(warc.page_record(k, url, page.encode(), warc.base32_sha1(page.encode()), None, "2025-01-01T00:00:00Z") for k, url, page in rows)
    found = list(warc.salvage(lambda n, at: plain[at : at + n], len(plain)))
    assert [r.headers["warc-record-id"] for r in found] == [f"<urn:page:{k}>" for k in (1, 2, 3)]
    read = warc.read_archives
    monkeypatch.setattr(warc, "read_archives", lambda files: read(files).where("record_id != '<urn:page:2>'"))
    with pytest.raises(RuntimeError):
        warc.page_table(spark, frame)


@pytest.mark.parametrize(
    "page",
    [
        "<body><form id='aspnetForm'><nav>menu</nav><article>%s<form>form</form></article><div class='ad'>advert</div></form></body>",
        "<body><form id='aspnetForm'><div class='ad'>advert</div><div>%s</div></form><p>few</p></body>",
        "<div class='layout has-sidebar'><article>%s</article><div class='sidebar'>side</div></div>",
        "<div class='content no-sidebar'><div class='site-content header-fixed'>%s</div></div>",
        "<div id='page-with-comments'>%s<div id='comments'><article>a reader says a lot more than all the text above</article></div></div>",
        "<div class='widget'><main>%s</main></div>",
    ],
)
def test_wrappers_keep_the_article(page):
    text = "The article of this page, which goes on for a while."
    read = html_text.parse(page % f"<p>{text}</p>")
    assert read.below(read.votes()) == [text]


def test_every_template_of_a_hot_host_keeps_its_consensus(spark):
    def page(template, article, comment):
        return f"<body><div class='t{chr(97 + template % 26)}{chr(97 + template // 26)}'><div class='post'><p>{article}</p></div><div class='talk'><p>{comment}</p></div></div></body>"

    long, short = "The article goes on and on with many more words.", "A short article."
    rows = []
    for template in range(80):
        rows += [(4 * template + k, "http://hot/", page(template, f"{long} {k}", "few")) for k in range(3)]
        rows.append((4 * template + 3, "http://hot/", page(template, short, "a reader talks for much longer than the article does")))
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r.page_id: r.text for r in html_text.main_texts(frame).collect()}
    assert found == {p: short if p % 4 == 3 else f"{long} {p % 4}" for p, _, _ in rows}


def test_driver_pages_give_exactly_their_article(spark):
    import html as markup

    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    texts = {r.page_id: r.text for r in html_text.main_texts(pages).collect()}
    for r in pages.collect():
        article = re.search(r"<article>(.*?)(</article>|\Z)", r.html, re.S)
        blocks = re.split(r"</?(?:p|h1|b|br)>", article[1]) if article else []
        expected = [b for b in (" ".join(markup.unescape(b).split()) for b in blocks) if b]
        assert texts[r.page_id].split("\n\n") == (expected or [""])


@pytest.mark.parametrize(
    ("page", "blocks"),
    [
        ("<!DOCTYPE html><title>t</title><p>Hello</p>", ["Hello"]),
        ("plain text\n of a page", ["plain text of a page"]),
        ("<h1>Head</h1><p>a long paragraph of this page</p><div><p>short</p></div>", ["Head", "a long paragraph of this page", "short"]),
        ("<section id='menu'><p>The only running text of this page.</p></section>", ["The only running text of this page."]),
        ("<body><div class='main header'><p>The only running text of this page.</p></div><p>ad</p></body>", ["The only running text of this page."]),
        ("<body><div><p>A short article.</p></div><div class='cookie'><p>This notice is longer than the article.</p></div></body>", ["A short article."]),
    ],
)
def test_pages_without_a_body_or_with_a_marked_wrapper(page, blocks):
    read = html_text.parse(page)
    found = read.below(read.votes())
    assert blocks[-1] in found and "This notice is longer than the article." not in found
    if "<div class='main" not in page:
        assert found == blocks


def test_a_very_long_page_is_whole(spark):
    blocks = [f"Paragraph {k} of a long page." for k in range(60_000)]
    rows = [(1, "http://h/1", "<p>" + "<p>".join(blocks)), (2, "http://h/2", "<body><p>" + "<p>".join(blocks[:9]) + "</body>")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r.page_id: r.text.split("\n\n") for r in html_text.main_texts(frame).collect()}
    assert found == {1: blocks, 2: blocks[:9]}
