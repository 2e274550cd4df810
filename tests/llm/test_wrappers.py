from __future__ import annotations

import random
import re
from functools import cache
from html import unescape

import pytest

from trafficlens.llm import wrappers as w


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def texts(spark, rows):
    return {r["page_id"]: r["text"] for r in w.extract(pages(spark, rows)).collect()}


def test_given_pages(spark):
    folder = "/root/testdata/sf0.01"
    rows = spark.read.parquet(f"{folder}/pages.parquet").collect()
    got = {r["page_id"]: r for r in w.op7_html_extraction(spark, folder).collect()}
    assert len(got) == len(rows)
    for r in rows:
        article = re.search(r"<article>(.*?)(</article>|$)", r["html"], re.S).group(1)
        article = re.sub(r"</?b>", "", re.sub(r"</?(p|h1|br)>", " ", article))
        assert got[r["page_id"]]["text"] == " ".join(unescape(article).split())
        assert got[r["page_id"]]["n_chars"] == len(got[r["page_id"]]["text"]) and got[r["page_id"]]["url"] == r["url"]


PAGE = """<html><head><title>T {k}</title></head><body><header><h1>Site</h1></header>
<ul class="menu"><li>a{k}</li></ul><div id=page><div class="hint">Read this in our app now</div>
<div class="text"><h2>Title {k}</h2><p>Words &amp; more of {k}.<p>Second <b>bo</b>ld {k} par&nbsp;t<br>after
  <span>inline</span></p></div><div class="x1">Made with love</div></div>
<aside>side {k}</aside><div class="comments"><p>comment {k}</p></div><form>f {k}</form><script>var a = "</p>{k}";</script><footer>foot {k}</footer></body></html>"""


def test_template_text_is_left_out_and_slots_are_kept(spark):
    rows = [(k, f"http://h.example/{k}", PAGE.format(k=f"n{k}")) for k in range(12)]
    for k, text in texts(spark, rows).items():
        assert text == f"Title n{k} Words & more of n{k}. Second bold n{k} par t after inline"


def test_articles_with_notices_and_comments(spark):
    html = "<nav>n</nav><main><article><header><span>by me</span><h1>Head {k}</h1></header><p>Body {k}</p><div class='notice'>careful {k}</div><section id='comments'>c {k}</section><p>End {k}</article><article><p>Two {k}</article></main>"
    rows = [(k, f"http://h.example/{k}", html.format(k=k)) for k in range(3)]
    assert texts(spark, rows)[2] == "Head 2 Body 2 End 2 Two 2"


def test_copies_of_one_page_keep_their_text(spark):
    html = "<body><article><h1>One</h1><p>and the same</p></article></body>"
    rows = [(k, "http://h.example/", html) for k in range(9)] + [(20, "http://h.example/x", html.replace("One", "Other"))]
    got = texts(spark, rows)
    assert got[0] == "One and the same" and got[20] == "Other and the same"


def test_awkward_pages(spark):
    long = "<article>" + "".join(f"<p>p{k} text" for k in range(8000)) + "</article>"
    deep = "<div>" * 3000 + "<p>deep" + "</div>" * 3000
    rows = [(0, None, None), (1, "x", ""), (2, "http://a/", "plain &lt;text&gt; &amp"), (3, "http://a/", "<p>cut <b>here</b> <foo"), (None, "http://b/", long),
            (5, "http://b/", "<article><p>short</article>"), (6, "http://c/", deep), (7, "http://c/", deep), (7, "http://c/", deep), (8, "http://d/", "<p a='x>y\">one</p><p title=\"a>b\">two</p>"),
            (9, "http://d/", "<!-- open comment <p>x"), (10, "http://e/", "<article>a<script>never closed <p>b</article>"), (11, "http://f/", "</p></div>loose<br/>ends")]
    got = texts(spark, [r for r in rows])
    assert got[0] == "" and got[1] == "" and got[2] == "plain <text> &" and got[3] == "cut here"
    assert got[None] == " ".join(f"p{k} text" for k in range(8000)) and got[5] == "short"
    assert got[6] == "deep" and got[7] == "deep" and got[9] == "" and got[10] == "a" and got[11] == "loose ends" and got[8].endswith("two")
    assert w.extract(pages(spark, rows).selectExpr("*", "'q' AS host", "'r' AS reference", "'s' AS text")).count() == len(rows)
    assert w.extract(pages(spark, [])).collect() == []


def random_tree(r, n):
    html = ""
    for _ in range(n):
        html += r.choice(["<div>", "<section>", "<b>", "</div>", "</section>", "<p class=a>", "<p>", "x", "</p>", "<ul><li>a<li>b</ul>"])
    return w.parse(html)


@pytest.mark.parametrize("seed", range(25))
def test_alignment_is_the_largest(seed):
    r = random.Random(seed)
    a, b = random_tree(r, 40), random_tree(r, 40)

    @cache
    def size(x, y):
        if x.key != y.key:
            return 0

        @cache
        def best(i, j):
            if i == len(x.children) or j == len(y.children):
                return 0
            return max(best(i + 1, j), best(i, j + 1), size(x.children[i], y.children[j]) + best(i + 1, j + 1))

        return 1 + best(0, 0)

    mapping = w.align(a, b)
    assert len(mapping) == size(a[0], b[0])
    for x, y in mapping.items():
        assert a[x].key == b[y].key and (x == 0 or mapping[a[x].parent.number] == b[y].parent.number)
    ordered = sorted(mapping.items())
    assert [y for _, y in ordered] == sorted(y for _, y in ordered)


def test_long_child_lists_are_aligned_between_their_ends():
    # 600 siblings, and template blocks at places that shift from page to page.
    def page(shift):
        blocks = ["<p>x</p>"] * 600
        for k in range(8):
            blocks.insert(40 + 70 * k + (shift * (k + 1)) % 9, f"<div class=hint{'abcdefgh'[k]}>{'<b>x</b>' * 12}</div>")
        return w.parse("<div>" + "<h2>x</h2>" * (shift % 3) + "".join(blocks) + "<h3>x</h3>" * (shift % 2) + "</div>")

    a, b = page(1), page(6)
    mapping = w.align(a, b)
    hints = [n for n in a if "hint" in n.key]
    assert len(hints) == 8 and all(n.number in mapping and b[mapping[n.number]].key == n.key for n in hints)


@pytest.mark.parametrize("seed", range(6))
def test_long_lists_are_matched_as_short_ones(seed):
    r = random.Random(seed)
    left, right = ([r.randrange(5) for _ in range(r.randrange(1, 90))] for _ in range(2))

    def gain(x, y):
        return 0 if x % 2 != y % 2 else 1 + min(x, y)

    short, long = w._largest(left, right, gain), w._largest_of_long(left, right, gain)
    assert sum(gain(left[i], right[j]) for i, j in short) == sum(gain(left[i], right[j]) for i, j in long)
    assert short == long


def test_template_blocks_shift_inside_a_long_article(spark):
    def page(k):
        blocks = [f"<p>par {i} of {k}</p>" for i in range(600)]
        blocks.insert(200 + k, f"<div class=hint>Read this in our app now{'<b>!</b>' * 12}</div>")
        return f"<div class=head{'abcdef'[k]}>top {k}</div><article>" + f"<h2>h {k}</h2>" * (k % 2) + "".join(blocks) + f"<ul><li>end {k}</ul></article>"

    for text in texts(spark, [(k, f"http://h.example/{k}", page(k)) for k in range(6)]).values():
        assert "our app" not in text and text.count("par ") == 600


def test_blocks_that_one_page_lacks_and_other_layouts_are_template(spark):
    one = "<body><div class=top>Menu of {k}</div><div class=text>{hint}<p>One {k} goes on and on for {k} lines</p></div><p class=end>Made by us</p></body>"
    two = "<body><section class=wide><div class=lead>Our second look</div><p>Two {k} is a story of {k}</p></section></body>"
    hint = "<div class=hint>Read this in our app now</div>"
    rows = [(0, "http://h.example/", None), (1, "http://h.example/1", "<body></body>")]
    rows += [(k, f"http://h.example/{k}", one.format(k=f"n{k}", hint=hint if k % 4 else "")) for k in range(10, 20)]
    rows += [(k, f"http://h.example/{k}", two.format(k=f"n{k}")) for k in range(20, 28)]
    for k, text in texts(spark, rows).items():
        assert "our app" not in text and "Made by" not in text and "second look" not in text
        assert k < 10 or f"n{k}" in text


def test_near_copies_are_not_template(spark):
    html = "<body><article><h1>One</h1><p>and the same</p><p>part {k}</p></article></body>"
    rows = [(k, f"http://h.example/{k}", html.format(k=k)) for k in range(3)] + [(k, f"http://h.example/{k}", f"<body><article><h1>T{k}</h1><p>other {k}</p></article></body>") for k in (7, 8)]
    for k, text in texts(spark, rows * 3).items():
        assert text == (f"One and the same part {k}" if k < 3 else f"T{k} other {k}")


@pytest.mark.parametrize("n", [2, 3])
def test_hosts_of_few_pages_have_template(spark, n):
    html = "<body><article><h1>Head {k}</h1><div class=hint>Read this now</div><p>Words of page {k}, which no other page has but {k}</p><p>shared line</p></article></body>"
    near = "<body><article><h1>One</h1><div class=text>This is long and the same on both pages</div><p>{k}</p></article></body>"
    rows = [(k, f"http://h.example/{k}", html.format(k=f"n{k}" * 9)) for k in range(n)] + [(k, f"http://near.example/{k}", near.format(k=k)) for k in (10, 11)]
    for k, text in texts(spark, rows).items():
        assert "Read this" not in text and ("shared line" in text if k < 10 else "long and the same" in text)


def test_body_beside_teasers_is_kept(spark):
    html = "<body><div class=page><div class=text><p>Story {k}" + " with many words" * 30 + " of {k}</p></div><article><p>Teaser {k}</p></article></div></body>"
    for k, text in texts(spark, [(k, f"http://h.example/{k}", html.format(k=k)) for k in range(6)]).items():
        assert text.startswith(f"Story {k} with many")
