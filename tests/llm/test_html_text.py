from __future__ import annotations

import random
import time
from html.parser import HTMLParser

import pytest

from tripfold.llm import html_text

TREE = html_text.trained_tree()
PROSE = "The council met on Tuesday to discuss the bridge, and after a long debate it voted for repairs. " * 3


@pytest.mark.parametrize(
    "page,text",
    [
        (None, ""),
        ("", ""),
        ("<nav><a href=x>Home</a></nav>", ""),
        ("<article><h1>Head &amp; line</h1><p>One<br>two  <b>th</b>ree&nbsp;x</p></article>", "Head & line One two three x"),
        ("<article><p>Kept</p><script>var t='</p>'</script><style>p{}</style><p>also</article><footer>&copy; no</footer>", "Kept also"),
        ("<article><p>a &lt; b &am", "a < b &am"),
        ("<article><p>cut off <b", "cut off"),
        ("<article><p>kept</p><!-- gone", "kept"),
        ("<article><p>kept</p><script>gone", "kept"),
        ('<div class="ad">Buy now</div><article><p>2 < 3 and 4 > 1</p></article>', "2 < 3 and 4 > 1"),
        ('<article><p>Body.</p><section id="comments"><p>I like it</p></section></article>', "Body."),
        ('<article><p>Body <a href="x>y">link</a> end</p></article></article>', "Body link end"),
        ("<article><form><p>Mail</p><input></form><aside>More</aside><p>Text</p></article>", "Text"),
        ("<div><p>Short news item.</p></div>", "Short news item."),
        ("<ul><li>One thing.<li>Another thing.</ul>", "One thing. Another thing."),
        ('<article><div class="share-price"><p>It rose.</p></div><p>Done.</p></article>', "It rose. Done."),
        ('<article><p class="ad">Buy<p>Kept</p><ol class="commentlist"><li class="comment">Nice</ol></article>', "Kept"),
        ("<article><table><tr><td>a<td class=sidebar>b<td>c<tr><td>d</table></article>", "a c d"),
        ("<article><ul><li class=ad>x<ul><li>y</ul>z<li>kept</ul></article>", "kept"),
        ('<article><p class="promo">x<div>kept</div></article>', "kept"),
        ('<article><div class="article-header"><h1>Head</h1></div><div class="site-header">no</div></article>', "Head"),
        ("<div><a href=1>Home</a></div><article><p>Yes.</p></article><div><a href=2>All news</a></div>", "Yes."),
        ("<div><a href=1>Home</a></div><p>It rained all day.</p><div><a href=2>All news</a></div>", "It rained all day."),
        ("<article><p>" + "long words " * 50 + "<p><a href=1>the report</a><p>end</article>", "long words " * 50 + "the report end"),
        ("<div><a href=1>Home page</a> | <a href=2>All news</a></div><div><p>Short item.</p></div>", "Short item."),
    ],
)
def test_pages(page, text):
    assert html_text.main_text(page, TREE) == text


def test_plain_page_without_an_article_tag():
    page = (
        '<div id="menu"><a href=1>Home</a> <a href=2>News</a></div><div><h1>Bridge repairs voted</h1>'
        f"<p>{PROSE}</p><p>{PROSE}</p></div><div class='cookie-banner'><p>{PROSE}</p></div>"
        "<div><a href=3>More news</a> <a href=4>Sport news</a></div>"
    )
    expected = f"Bridge repairs voted {PROSE.strip()} {PROSE.strip()}"
    assert html_text.main_text(page, TREE) == expected


def test_labelled_table_is_learned():
    for page in html_text.LABELLED:
        blocks = [html_text.blocks_of(frame.format(block)) for frame, block, _ in page]
        rows = html_text.features_of([b for own in blocks for b in own]).tolist()
        labels = [label for own, (_, _, label) in zip(blocks, page) for _ in own]
        assert [html_text.is_article(TREE, row) for row in rows] == labels


def test_link_density_and_neighbours_decide():
    used = set()

    def visit(node):
        if node.feature >= 0:
            used.add(node.feature)
            visit(node.low)
            visit(node.high)

    visit(TREE)
    assert 1 in used and used & {2, 3, 4, 5}


class PlainBlocks(HTMLParser):
    """The blocks of well-formed pages by the parser of the standard library."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.blocks, self.parts, self.raw = [], [], 0

    def cut(self):
        text = " ".join("".join(self.parts).split())
        self.blocks += [text] if text else []
        self.parts = []

    def handle_starttag(self, tag, attrs):
        if tag == "br":
            self.parts.append(" ")
        elif tag not in html_text.INLINE:
            self.cut()
            self.raw += tag in html_text.RAW_TEXT

    def handle_endtag(self, tag):
        if tag not in html_text.INLINE and tag != "br":
            self.cut()
            self.raw -= tag in html_text.RAW_TEXT

    def handle_data(self, data):
        if not self.raw:
            self.parts.append(data)


def test_blocks_agree_with_a_plain_parser():
    rng = random.Random(6)
    tags = ["div", "p", "ul", "li", "section", "h2", "b", "a", "span", "article", "nav", "script", "td", "blockquote"]

    def piece(depth):
        if depth == 0 or rng.random() < 0.3:
            return rng.choice(["word ", "two words", " é&amp;x ", "a &lt; b", "<br>", "<!-- no <p> -->", "&nbsp;", "🙂"])
        tag = rng.choice(tags)
        if tag == "script":
            return "<script>if (a) { b('x') }</script>"
        return f"<{tag} class='c{depth}'>" + "".join(piece(depth - 1) for _ in range(rng.randint(0, 4))) + f"</{tag}>"

    for _ in range(300):
        page = "".join(piece(5) for _ in range(3))
        parser = PlainBlocks()
        parser.feed(page)
        parser.close()
        parser.cut()
        assert [block.text for block in html_text.blocks_of(page)] == parser.blocks


def test_deep_nesting_costs_no_more():
    began = time.monotonic()
    assert html_text.main_text("<div>" * 20_000 + "deep text", TREE) == "deep text"
    page = "<div><p>w" * 10_000 + "</section></li>" * 10_000
    assert len(html_text.main_text(page, TREE).split()) == 10_000
    assert time.monotonic() - began < 5


def test_table(spark):
    rows = [(1, "u", "<article><p>é 🙂</p></article>"), (1, "u", "<article><p>é 🙂</p></article>"), (None, None, None)]
    rows.append((2, "v", "<article><p>" + "long words " * 50_000 + "</p></article>"))
    frame = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    frame = frame.selectExpr("*", "'x' AS text", "1 AS n_chars")
    got = html_text.extract_text(frame).collect()
    assert sorted((str(r.page_id), str(r.url), r.text[:5], r.n_chars) for r in got) == [
        ("1", "u", "é 🙂", 3), ("1", "u", "é 🙂", 3), ("2", "v", "long ", 549_999), ("None", "None", "", 0)
    ]
    assert html_text.extract_text(frame.limit(0)).collect() == []
