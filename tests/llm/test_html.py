import random
import re
import time

import pytest
from pyspark.sql import functions as F

from lakeload.llm.html import _Tags, blocks, extract_text, main_text, tokens

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p><article>";</script>
</head><body class="has-sidebar"><header><h1>Site</h1></header><nav><ul><li><a href="/a">Home</a></ul></nav>
<!-- <article>no</article> --><div class="cookie-notice">We use cookies</div><div id="ad-1">Buy</div>
<article class="post"><header><h1>Title &amp; more</h1><p>by me</p></header>
<p>One <b>bold<br>word</b>&nbsp;&#233;&eacute; a<i>b</i>c
<p>Two
  lines<aside>side</aside><form><input><p>mail</p></form><div class="share">Share</div>
<ul><li>x<li>y</ul><script>if (a < b) {}</script>tail 1 < 2<div class="comments"><p>Nice!</p></div></article>
<aside>Other</aside><footer>&copy; me</footer></body></html>"""
TEXT = "Title & more\nOne bold word éé abc\nTwo lines\nx\ny\ntail 1 < 2"


def test_article():
    assert main_text(PAGE, [], None) == TEXT


def test_blocks_tell_what_is_around_them():
    side = {b.text for b in blocks(PAGE) if b.side}
    assert {"Site", "Home", "We use cookies", "Buy", "by me", "side", "mail", "Nice!", "© me"} <= side


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id bigint, url string, html string")


def test_templates_of_hosts_without_articles(spark):
    rows = []
    for n in range(8):
        body = f"<p>Story {n} begins here and goes on for a while.</p><p>It ends with {n}.</p>"
        html = (
            f"<body><div class='top'><p>Welcome to our site</p></div><div class='c'>{body}</div>"
            f"<div class='low'><p>Read {n}</p><p>All rights reserved</p></div></body>"
        )
        rows.append((n, f"https://User@Site.example:80/{n}", html))
    found = {r.page_id: r.text for r in extract_text(pages(spark, rows)).collect()}
    for n in range(8):
        assert found[n] == f"Story {n} begins here and goes on for a while.\nIt ends with {n}."


def test_repeated_text_of_articles_stays(spark):
    same = "<article><p>This work is licensed under the same terms.</p></article>"
    rows = [(n, "http://h.example/x", same) for n in range(6)]
    texts = [r.text for r in extract_text(pages(spark, rows)).collect()]
    assert texts == ["This work is licensed under the same terms."] * 6


def test_awkward_pages(spark):
    long = "<article>" + "".join(f"<p>part {n}" for n in range(20_000))
    rows = [(None, None, None), (1, "", ""), (2, "http://a", "<p>alone"), (2, "http://a", "<p>alone")]
    rows += [(3, "http://b", long), (4, "http://c", "<<>< & <div <p>x"), (5, "http://d", "<nav>only</nav>")]
    df = pages(spark, rows).withColumn("n_chars", F.lit("old")).withColumn("host", F.lit(1))
    out = extract_text(df)
    assert out.columns == ["page_id", "url", "html", "host", "text", "n_chars"]
    found = [(r.page_id, r.text) for r in out.collect()]
    assert len(found) == len(rows)
    assert sorted(t for i, t in found if i == 2) == ["alone", "alone"]
    assert dict(found)[None] == "" and dict(found)[1] == "" and dict(found)[5] == ""
    assert dict(found)[3].count("\n") == 19_999
    assert all(r.n_chars == len(r.text) for r in out.collect())
    assert extract_text(pages(spark, [])).count() == 0


PARTS = """<h2 id="related-work">Related work</h2><section id="search-methods"><p>How we searched</p></section>
<div class="section-header"><h2>Results</h2></div><section class="social-impact"><p>Impact</p></section>
<div class="notice"><p>Mind the gap</p></div><p class="share-price">Shares fell</p>"""


def test_words_in_names_of_parts_do_not_lose_them():
    wanted = "Related work\nHow we searched\nResults\nImpact\nMind the gap\nShares fell"
    assert main_text(f"<article>{PARTS}<div class='share'>Share</div></article>", [], None) == wanted


def test_templates_confirm_words_in_names(spark):
    """A doubtful class on all pages of a host is no part of its articles, on one page it is."""
    rows = []
    for n in range(6):
        only = "<div class='related-cases'><p>A case</p></div>" if n == 0 else ""
        more = f"<div class='related-stories'><p>Read story {n + 1}</p></div>"
        html = f"<body><div><article><h1>Story {n}</h1><p>Text {n}</p>{only}{more}</article></div></body>"
        rows.append((n, f"http://h.example/{n}", html))
    found = {r.page_id: r.text for r in extract_text(pages(spark, rows)).collect()}
    assert found == {n: f"Story {n}\nText {n}" + ("\nA case" if n == 0 else "") for n in range(6)}


def test_slots_keep_all_that_is_below_them_in_each_layout(spark):
    """Lists, quotations, tables, sections and bare text, in two layouts with ids of their own pages."""
    rows, wanted = [], {}
    for n in range(12):
        inner = (
            f"Lead {n}<p>Long paragraph {n} that goes on and on for a while.</p><ul><li>Item {n}</li></ul>"
            f"<blockquote><p>Quoted {n}</p></blockquote><table><tr><td>Cell {n}</td></tr></table>"
            f"<section><h2 id='s{n}'>Part {n}</h2><p>Nested {n}</p></section>Tail {n}"
        )
        around = ("<div class='c' id='post-{0}'>{1}</div>", "<div class='story s-{0}'>{1}</div>")[n % 3 == 0]
        html = (
            "<body><div class='top'><p>Welcome to our site</p></div>"
            + around.format(n, inner)
            + f"<div class='low'><p>Read {n}</p><p>All rights reserved</p></div></body>"
        )
        rows.append((n, f"http://two.example/{n}", html))
        wanted[n] = (
            f"Lead {n}\nLong paragraph {n} that goes on and on for a while.\nItem {n}\nQuoted {n}\n"
            f"Cell {n}\nPart {n}\nNested {n}\nTail {n}"
        )
    assert {r.page_id: r.text for r in extract_text(pages(spark, rows)).collect()} == wanted


def test_templates_inside_articles(spark):
    """What all different pages of a host repeat inside their articles is no article's text."""
    rows = []
    for n in range(6):
        share = "<div class='x'><p>Join our list of readers today</p></div>"
        html = f"<body><article><h1>Story {n}</h1><p>Text {n}</p>{share}<p>End {n}</p></article></body>"
        rows += [(n, f"http://h.example/{n}", html)] * 2
    rows += [(n, "http://i.example/", "<article><p>Only copies.</p></article>") for n in range(10, 16)]
    found = extract_text(pages(spark, rows)).collect()
    assert len(found) == len(rows)
    for row in found:
        n = row.page_id
        assert row.text == (f"Story {n}\nText {n}\nEnd {n}" if n < 10 else "Only copies.")


LINES = "\n".join(["x"] * 20_000)


@pytest.mark.parametrize(
    "page, text",
    [
        ("<a " * 300_000, None),
        ("<a " * 300_000 + ">", ""),
        ("<a '>' " * 100_000 + "'", None),
        ("<a\"" * 300_000 + "/ \"'>", None),
        ("<a <a 'b' \"" * 80_001 + "'>", None),
        ("<!" * 300_000, None),
        ("<div>x" * 20_000, LINES),
        ("<div class=note><b>x</b></i>" * 20_000, LINES),
        ("<section class='share this'>x" * 20_000, LINES),
    ],
)
def test_tags_without_end_and_deep_nesting_take_linear_time(page, text):
    """Without a tag that ends, all of the page is text."""
    start = time.process_time()
    found = blocks(page)
    template, slots = list(tokens(found)), {token: 1.0 for token in tokens(found)}
    assert main_text(page, [], {}) == (" ".join(page.split()) if text is None else text)
    main_text(page, template, slots)
    assert time.process_time() - start < 20


def test_tags_are_found_as_by_one_expression():
    plain = re.compile(
        r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<[!?][^>]*>", re.S
    )
    chance = random.Random(12)
    parts = ["<", "<a", "</b", "<!", "<!--", "-->", ">", "'", '"', "/", " ", "c", "=", "\n", "<p>", "<é"]
    for _ in range(20_000):
        page = "".join(chance.choices(parts, k=chance.randint(1, 25)))
        expected = [
            (m.start(), m.end(), bool(m[1]), (m[2] or "").lower(), m[3] or "") for m in plain.finditer(page)
        ]
        tags, found, at = _Tags(page), [], 0
        while next_ := tags.after(at):
            found.append(next_)
            at = next_[1]
        assert found == expected, page


ROWS = {"menu": 5, "promo": 3, "foot": 4}


def _site(chance, host, marked):
    """Pages of one host, and the text of each one's article."""
    word = lambda: "".join(chance.choices("abcdefghij", k=chance.randint(2, 9)))
    line = lambda n: " ".join(word() for _ in range(n))
    fixed = {name: [line(4) for _ in range(n)] for name, n in ROWS.items()}
    notice = [line(8) for _ in range(4)]
    layouts = [chance.choice(["div", "section", "div"]) for _ in range(2)]
    for n in range(24):
        k = n % 2
        paragraphs = [line(chance.randint(20, 40)) for _ in range(chance.randint(2, 6))]
        items = [line(chance.randint(4, 9)) for _ in range(chance.randint(0, 3))]
        body = "".join(f"<p>{p}</p>" for p in paragraphs)
        body += "<ul>" + "".join(f"<li>{i}" for i in items) + "</ul>" if items else ""
        # Text of the template inside the article, in an element that does not tell.
        body += "<div class='z9'>" + "".join(f"<p>{t}</p>" for t in notice) + "</div>"
        if marked:
            body = f"<article>{body}</article>"
        parts = {name: "".join(f"<li>{t}</li>" for t in lines) for name, lines in fixed.items()}
        html = (
            f"<html><head><title>{line(3)}</title></head><body><ul class='q1'>{parts['menu']}</ul>"
            f"<div class='q{2 + k}'><{layouts[k]} class='m{k}'>{body}</{layouts[k]}></div>"
            f"<ul class='q5'>{parts['promo']}</ul><ul class='q6'>{parts['foot']}</ul></body></html>"
        )
        yield f"https://{host}/{n}", html, "\n".join(paragraphs + items)


def test_articles_of_generated_hosts(spark):
    """The template decides: no element but, on some hosts, the article tells what it is."""
    chance = random.Random(41)
    made = [p for h in range(20) for p in _site(chance, f"h{h}.example", marked=h % 4 == 0)]
    rows = [(n, url, html) for n, (url, html, _) in enumerate(made)]
    found = {r.page_id: r.text for r in extract_text(pages(spark, rows)).collect()}
    assert [found[n] for n in range(len(made))] == [text for *_, text in made]


def test_templates_too_many_to_broadcast(spark, monkeypatch):
    chance = random.Random(43)
    made = [p for h in range(4) for p in _site(chance, f"h{h}.example", marked=False)]
    rows = [(n, url, html) for n, (url, html, _) in enumerate(made)] + [(-1, None, "<p>alone")] * 5
    expected = sorted(map(tuple, extract_text(pages(spark, rows)).collect()))
    assert [r for r in expected if r[0] == -1] == [(-1, None, "<p>alone", "alone", 5)] * 5
    monkeypatch.setattr("lakeload.llm.html.HOT_HOSTS", 2)
    for most in (0, 3000):
        monkeypatch.setattr("lakeload.llm.html.BROADCAST_BYTES", most)
        assert sorted(map(tuple, extract_text(pages(spark, rows)).collect())) == expected
