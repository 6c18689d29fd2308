"""Operators 4, 7 and 1."""

import io
import struct
import zipfile

import numpy as np
import brute
import pytest
from brute import EDGE

from ledgerline.llm import html_extract, warc, weak_label


@pytest.fixture(scope="module")
def pages(spark, data):
    return spark.read.parquet(f"{data}/pages.parquet")


def test_archives_round_trip(spark, pages):
    more = spark.createDataFrame(
        [(10**6 + 1, None, None), (10**6 + 2, "http://a b\n/é", ""), (10**6 + 3, "x", "same"), (10**6 + 4, "y", "same"),
         (10**6 + 5, "y", "same"), (10**6 + 6, "z", "\U0001d4b3é\r\n\r\n")], "page_id long, url string, html string")
    table = pages.select("page_id", "url", "html").unionByName(more)
    want = brute.archive([(r["page_id"], r["html"]) for r in table.collect()])
    for size in (warc.ARCHIVE_BYTES, 20_000):
        found = warc.archive_round_trip(table, archive_bytes=size).collect()
        assert len(found) == len(want) and {r[0]: tuple(r)[1:] for r in found} == want
    few = {r[0]: r["record_type"] for r in warc.archive_round_trip(table, min_bytes=5).collect()}
    assert few[10**6 + 3] == few[10**6 + 4] == "response"  # smaller than the least size


def test_archives_payloads_and_edges(spark, tmp_path):
    rows = [(1, "u", "<p>x</p>"), (1, "u", "<p>x</p>"), (None, "v", "<p>x</p>"), (None, "w", "other"), (None, "w", "other")]
    table = spark.createDataFrame([(*r, 5) for r in rows], "page_id long, url string, html string, sum int")
    manifest = warc.write_archives(table, str(tmp_path / "out"))
    found = sorted((str(r["page_id"]), r["record_type"], r["refers_to"], r["payload"] and bytes(r["payload"]))
                   for r in warc.read_records(manifest).collect())
    assert found == [("1", "response", None, b"<p>x</p>")] * 2 + [
        ("None", "response", None, b"other")] * 2 + [("None", "revisit", 1, None)]
    assert warc.archive_round_trip(table.limit(0)).count() == 0


class Bytes(io.BytesIO):
    def read_at(self, n, at):
        self.seek(at)
        return self.read(n)


def test_zip_directories():
    """Directories that Python's zipfile writes, and a ZIP64 one."""
    raw = Bytes()
    with zipfile.ZipFile(raw, "w", zipfile.ZIP_STORED) as z:
        z.writestr("a.txt", b"hello")
        z.writestr("b/c.bin", b"\0" * 1000)
        z.comment = b"note PK"
    found = warc.members(raw, len(raw.getvalue()))
    method, place, n = found["a.txt"]
    assert (method, n) == (0, 5) and raw.read_at(5, warc.data_start(raw, place)) == b"hello"
    # the same with every size and place in ZIP64 fields
    body = raw.getvalue()
    local = body[:found["b/c.bin"][1]]
    entry = struct.pack("<4s6H3I5H2I", b"PK\x01\x02", 45, 45, 0, 0, 0, 0, 0, 0xFFFFFFFF, 0xFFFFFFFF, 5, 28, 0, 0, 0, 0,
                        0xFFFFFFFF) + b"a.txt" + struct.pack("<HH3Q", 1, 24, 5, 5, 0)
    end64 = struct.pack("<4sQ2H2I4Q", b"PK\x06\x06", 44, 45, 45, 0, 0, 1, 1, len(entry), len(local))
    locator = struct.pack("<4sIQI", b"PK\x06\x07", 0, len(local) + len(entry), 1)
    wide = Bytes(local + entry + end64 + locator
                 + struct.pack("<4s4H2IH", b"PK\x05\x06", 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 0))
    (method, place, n), = warc.members(wide, len(wide.getvalue())).values()
    assert (method, n) == (0, 5) and wide.read_at(5, warc.data_start(wide, place)) == b"hello"


PAGE = """<!DOCTYPE html><html><head><title>no</title><style>p{}</style></head><body class="c12">
<header>Site <a href="/">home</a></header><div class="cookie-notice">We use cookies</div><nav><ul><li>menu</ul></nav>
<script>var a = "</p>";</script><!-- <p>no</p> --><div id="sidebar"><p>aside aside aside aside aside</p></div>
<div class="post-17"><h1>The &amp; title</h1><p>First <b>bo</b>ld
 line<br>next &#233;&nbsp;x<p title="a>b">Second 1 &lt; 2<ul><li>one<li>two</ul>
<form><p>your mail</p><button>go</button></form><div class="advert">buy</div></div>
<section class="comments"><p>%s</p></section><footer>&copy; me</footer></body></html>"""
TEXT = "The & title First bold line next é x Second 1 < 2 one two"


def test_main_text_of_a_page():
    assert html_extract.main_text(PAGE % "nice", None) == TEXT
    assert html_extract.main_text("", ">html") == html_extract.main_text(None, None) == ""
    assert html_extract.main_text("just text < here", None) == "just text < here"
    html_extract.main_text("<div " * 2000 + "<p>x" + "<b>" * 2000, None)


WORDS = "the words of the article " * 8
AROUND = [
    '<div style="overflow:hidden">%s</div>', '<div aria-hidden="false">%s</div>', '<div data-x="a hidden id=menu">%s</div>',
    '<div title="class=sidebar">%s</div>', '<div class="page has-sidebar">%s<div class="sidebar">side</div></div>',
    '<div class="page has-sidebar"><article>%s</article><div class="sidebar">side</div></div>',
    '<div class="elementor-widget-container">%s</div>', '<form action="/default.aspx"><input>%s</form>',
    '<div class="widget-area"><main>%s</main></div>', '<div id="page-with-banner">%s</div>',
    '<div class="social">%s</div><section class="comments"><p>nice</p></section>']


@pytest.mark.parametrize("around", AROUND)
def test_wrappers_are_not_dropped(around):
    page = f"<body><nav>menu</nav>{around % f'<h1>Head</h1><p>{WORDS}</p>'}</body>"
    path, score = html_extract.best_container(page)
    assert score > 0 and html_extract.main_text(page, path) == html_extract.main_text(page, None) == f"Head {WORDS.strip()}"


def test_noise_still_goes():
    body = f"<div class='text'><p>{WORDS}</p></div>"
    for noise in ("<p hidden>no</p>", "<div aria-hidden='true'>no</div>", "<div class='sidebar'>no</div>", "<form>no</form>",
                  "<div role='dialog'>no</div>", "<div id='comments'><article><p>no</p></article></div>",
                  f"<div class='comments'><p>{WORDS * 3}</p></div>", f"<nav>{WORDS * 3}</nav>", f"<p hidden>{WORDS * 3}</p>"):
        for page in (body + noise, noise + body, f"<div class='text'><p>{WORDS}</p>{noise}</div>"):
            assert html_extract.main_text(f"<body>{page}</body>", None) == WORDS.strip(), noise


def test_widgets_share_an_article():
    """Each widget has less than half of the text; all of them have it all."""
    widget = "<div class='elementor-widget'><div class='elementor-widget-container'><p>%s</p></div></div>"
    page = f"<body><div class='elementor-widget-wrap'>{''.join(widget % (w * 30) for w in ('a ', 'b ', 'c '))}</div></body>"
    path = html_extract.best_container(page)[0]
    assert html_extract.main_text(page, path).split() == ["a"] * 30 + ["b"] * 30 + ["c"] * 30


def test_a_short_article_follows_its_host(spark):
    """The noisy wrapper on the host's path counts as the article's, also on a page where comments have more text."""
    page = "<body><div class='post has-sidebar'><p>%s</p></div><div class='comments'><p>%s</p></div></body>"
    rows = [(k, f"http://h.example/{k}", page % (WORDS, "nice")) for k in range(3)]
    rows.append((9, "http://h.example/9", page % ("short article", WORDS * 3)))
    found = html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r["page_id"]: r["text"] for r in found} == {0: WORDS.strip(), 1: WORDS.strip(), 2: WORDS.strip(), 9: "short article"}


INTRO, BODY = "the intro of it " * 8, "many words of the body " * 20
WHOLE = [
    "<div class=post><h1>Head</h1><div class=intro>%s</div><div class=body>%s</div></div>",
    "<div class=post><h1>Head</h1><div class=intro><p>%s</p></div><div class=wrap><div class=body><p>%s</p></div></div></div>",
    "<h1>Head</h1><div class=intro>%s</div><div class=body>%s</div>",
    "<div class=wrap><div class=top><h2>Head</h2></div><p>%s</p><div class=body><p>%s</p></div></div>",
    "<div class=post><h1><a href=/1>Head</a></h1><div class=meta><a href=/a></a></div>%s<div class=body>%s</div></div>",
    "<table><tr><td><h1>Head</h1><div>%s</div><div class=body>%s</div></td></tr></table>"]


@pytest.mark.parametrize("template", WHOLE)
def test_template_without_article(template):
    """Heading and intro beside the container with most of the text stay; menus and their like don't come along."""
    around = "<nav>menu</nav><div class='top'><a href='/'>Home</a> <a href='/x'>Other places of the site</a></div>%s<footer>me</footer>"
    want = f"Head {INTRO}{BODY}".split()
    for page in (f"<body>{template % (INTRO, BODY)}</body>", template % (INTRO, BODY)):
        assert html_extract.main_text(page, html_extract.best_container(page)[0]).split() == want
    if template.startswith(("<div", "<table")):
        assert html_extract.main_text(f"<body>{around % (template % (INTRO, BODY))}</body>", None).split() == want


def test_sections_and_short_ends_without_article():
    parts = "".join(f"<div class=part><h2>Part {k}</h2><p>{BODY}</p></div>" for k in range(2))
    page = f"<body><div class=post><h1>Head</h1>{parts}<div class=last>So it ends.</div></div></body>"
    assert html_extract.main_text(page, None).split() == f"Head Part 0 {BODY} Part 1 {BODY} So it ends.".split()


def test_links_and_small_texts_stay_out():
    """Around the article there is nothing of it: no climb."""
    links = "<a href='/x'>another story of this site</a> " * 5
    for other in (f"<div class=more>{links}</div>", f"<h1><a href='/'>My site</a></h1><div class=more>{links}</div>",
                  f"<h1>My site</h1><div class=more>{links}</div>", "<div class=end>All rights kept.</div>"):
        for page in (f"<body>{other}<div class=text><p>{BODY}</p></div></body>",):
            assert html_extract.main_text(page, None) == BODY.strip(), other


def test_host_without_article(spark):
    """The vote goes to the whole, and holds for the host's other pages."""
    page = "<html><body><div class=post><h1>Head</h1><div class=intro>%s</div><div class=body>%s</div></div></body></html>"
    rows = [(k, f"http://h.example/{k}", page % (INTRO, BODY)) for k in range(3)] + [(9, "http://h.example/9", page % (BODY, "x"))]
    found = {r["page_id"]: r["text"].split() for r in html_extract.extract(
        spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert found == {**{k: f"Head {INTRO}{BODY}".split() for k in range(3)}, 9: f"Head {BODY}x".split()}


def test_hosts_agree(spark):
    """A page whose aside is longer than its article follows its host."""
    page = "<html><body><div class='text'><p>%s</p></div><div class='extra'><p>%s</p></div></body></html>"
    rows = [(k, f"http://h.example/{k}", page % ("article words here " * 4, "more"), "t") for k in range(5)]
    rows += [(9, "https://H.example:80/9", page % ("short article", "long aside " * 30), "t"),
             (10, None, None, "t"), (11, "http://other.example", "<p>alone</p>", "t"), (11, "http://other.example", "<p>alone</p>", "t")]
    table = spark.createDataFrame(rows, "page_id long, url string, html string, path string")
    found = [(r["page_id"], r["text"], r["n_chars"]) for r in html_extract.extract(table).collect()]
    assert (9, "short article", 13) in found and (10, "", 0) in found and found.count((11, "alone", 5)) == 2
    assert html_extract.extract(table.limit(0)).count() == 0


def test_articles_of_the_table(pages):
    """The template's article, cut out by hand."""
    import html
    import re
    found = {r["page_id"]: r["text"] for r in html_extract.extract(pages).collect()}
    for r in pages.collect():
        own = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1]
        own = re.sub(r"</?(?:p|h1|li|ul|div|br)\b[^>]*>", " ", own)
        assert found[r["page_id"]] == " ".join(html.unescape(re.sub(r"</?[a-zA-Z][^>]*>", "", own)).split())


def test_estimation_recovers_accuracies():
    draw = np.random.default_rng(0)
    truth = draw.random(20_000) < 0.7
    rates = np.array([0.9, 0.8, 0.75, 0.6, 0.85])
    right = draw.random((20_000, 5)) < rates
    votes = np.where(right, truth[:, None], ~truth[:, None]).astype(int)
    votes[draw.random((20_000, 5)) < 0.2] = weak_label.NONE
    patterns, n = np.unique(votes, axis=0, return_counts=True)
    post, table, share = weak_label.estimate(patterns, n.astype(float))
    assert abs(share - 0.7) < 0.03
    assert np.abs(table[1, :, 1] - rates).max() < 0.04
    assert 0 <= post.min() and post.max() <= 1


def test_classifier_on_held_out_labels(spark, data):
    """No label is used in training; both classes are told apart."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = {r[0]: r[1] for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    found = {r["doc_id"]: r for r in weak_label.classify(docs).collect()}
    assert len(found) == docs.count()
    good = [found[i]["keep"] for i, q in labels.items() if q == 1]
    bad = [found[i]["keep"] for i, q in labels.items() if q == 0]
    assert np.mean(good) >= 0.95 and np.mean(bad) <= 0.1


def test_classifier_edge(edge):
    rows = weak_label.classify(edge).collect()
    assert len(rows) == len(EDGE) and all(0 <= r["weak"] <= 1 and 0 <= r["score"] <= 1 for r in rows)
    assert weak_label.classify(edge.limit(0)).count() == 0
