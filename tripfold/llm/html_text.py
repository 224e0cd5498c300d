"""Main text of HTML pages: flat text blocks classified by a small decision tree.

A page is cut into flat blocks of text. A block is described by its word count and link density,
those of the blocks before and after it, and where it stands (inside an article, inside an
element whose tag or class names page furniture, heading or not). A decision tree trained on a
small labelled table of blocks, written below as pages, says which blocks are the article.

A class or id names furniture when one of its words does and the others only say where it is or what
holds it: ``cookie-notice`` and ``site-footer`` do, ``share-price`` does not.

Defined results: null or empty html gives an empty text; an unclosed tag, comment, script or
style reaches to the end of the page; a paragraph, list item or table cell ends where the next of
its kind begins; a character reference cut off at the end stays as it is unless HTML decodes it
without its semicolon; repeated rows give repeated results; other columns are not looked at.
Pages are read whole, one at a time, in one pass whose cost does not depend on the nesting.
"""

from __future__ import annotations

import html as references
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Elements by what they do to the text.
RAW_TEXT = {"script", "style", "textarea", "title", "noscript", "iframe", "template", "svg", "select", "button", "xmp", "noembed", "noframes", "math", "object", "canvas", "audio", "video"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}
VOID = {"area", "base", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr", "html", "body"}
# Elements that end without an end tag, and those an opening one of them ends.
IMPLIED = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
FURNITURE = {"nav", "footer", "aside", "form", "menu", "dialog", "head", "fieldset"}
FURNITURE_WORDS = set(
    "ad ads adbox advert advertisement advertising adverts banner breadcrumb breadcrumbs byline comment commentlist "
    "comments consent cookie cookies copyright disclaimer discussion disqus footer gdpr header login masthead menu "
    "modal nav navbar navigation newsletter notice notices notification overlay pagination popup "
    "promo promoted promotion recommended related replies reply respond search share sharing sidebar "
    "signup skip social sponsor sponsored subscribe subscription tags teaser toolbar widget".split()
)
NEUTRAL_WORDS = set(
    "area article articles author bar block body bottom box btn button buttons card center col column container "
    "content entry first global group holder icon icons inner item items js last left link links list main "
    "meta mobile module outer page panel post posts primary region right row secondary section site slot "
    "small stories story text thread title top unit wrap wrapper".split()
)
ARTICLE = {"article", "main"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}

_MARKUP = re.compile(r"<!--|<(/?)([a-zA-Z][^\s/>]*)|<[!?/]")
_NAMES = re.compile(r"""\b(?:class|id|role|aria-label)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.I)
_NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
# The end of a tag, past quoted values that may hold a '>'.
_TAG_END = re.compile(r"""(?:[^"'>]|"[^"]*"|'[^']*')*>""")


@dataclass
class Block:
    text: str
    words: int
    linked: int
    furniture: bool
    article: bool
    heading: bool


@dataclass
class _State:
    blocks: list[Block] = field(default_factory=list)
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    links: int = 0
    heading: bool = False
    stack: list[tuple[str, bool, bool]] = field(default_factory=list)  # tag, furniture, article
    open: Counter[str] = field(default_factory=Counter)  # how often a tag is on the stack
    furniture: int = 0  # entries of the stack that are furniture
    article: int = 0

    def add(self, text: str) -> None:
        self.parts.append(text)
        if self.links:
            self.linked += len(text.split())

    def end_block(self) -> None:
        if self.parts:
            text = " ".join(references.unescape("".join(self.parts)).split())
            if text:
                words = text.count(" ") + 1
                linked = min(self.linked, words)
                self.blocks.append(
                    Block(text, words, linked, self.furniture > 0, self.article > 0, self.heading)
                )
        self.parts, self.linked = [], 0

    def push(self, tag: str, attributes: str) -> None:
        furniture = _is_furniture(tag, attributes, self.article > 0)
        self.stack.append((tag, furniture, tag in ARTICLE))
        self.open[tag] += 1
        self.furniture += furniture
        self.article += tag in ARTICLE

    def pop(self) -> str:
        tag, furniture, article = self.stack.pop()
        self.open[tag] -= 1
        self.furniture -= furniture
        self.article -= article
        return tag

    def begin(self, tag: str) -> None:
        """End what an opening tag ends: of the implied elements on top, the kinds it replaces."""
        ended = IMPLIED.get(tag, {"p"})
        deepest = len(self.stack)
        # every kind is on top once at most, so this looks at a few entries
        for at in range(len(self.stack) - 1, -1, -1):
            if self.stack[at][0] not in IMPLIED:
                break
            if self.stack[at][0] in ended:
                deepest = at
        while len(self.stack) > deepest:
            self.pop()

    def end(self, tag: str) -> None:
        """An end tag closes up to its start tag; one without a start tag closes nothing."""
        if self.open[tag]:
            while self.pop() != tag:
                pass


def _names_furniture(name: str) -> bool:
    words = [part.lower() for part in _NAME_PARTS.findall(name)]
    named = [word for word in words if word in FURNITURE_WORDS]
    if named == ["header"] and len(words) > 1:
        return not {"article", "post", "entry", "story", "section", "content"} & set(words)
    return bool(named) and all(word in FURNITURE_WORDS or word in NEUTRAL_WORDS for word in words)


def _is_furniture(tag: str, attributes: str, in_article: bool) -> bool:
    if tag in FURNITURE or (tag == "header" and not in_article):
        return True
    if "=" not in attributes:
        return False
    return any(
        _names_furniture(name) for groups in _NAMES.findall(attributes) for name in " ".join(groups).split()
    )


def blocks_of(page: str) -> list[Block]:
    """The flat text blocks of a page in order."""
    state, at, size = _State(), 0, len(page)
    while at < size:
        found = _MARKUP.search(page, at)
        if not found:
            state.add(page[at:])
            break
        start = found.start()
        if start > at:
            state.add(page[at:start])
        if found.group(0) == "<!--":
            end = page.find("-->", found.end())
            at = size if end < 0 else end + 3
            continue
        tag = (found.group(2) or "").lower()
        closed = _TAG_END.match(page, found.end())
        end = closed.end() if closed else page.find(">", found.end()) + 1
        at = end or size
        if not tag:
            continue
        opening = not found.group(1)
        if tag in INLINE:
            if tag == "a":
                state.links = max(0, state.links + (1 if opening else -1))
            continue
        if tag == "br":
            state.add(" ")
            continue
        state.end_block()
        state.links = 0
        if tag in HEADINGS:
            if opening:
                state.begin(tag)
            state.heading = opening
        elif tag in RAW_TEXT:
            if opening and not page[start:at].endswith("/>"):
                close = re.compile(rf"</{re.escape(tag)}\b[^>]*(?:>|$)", re.I).search(page, at)
                at = close.end() if close else size
        elif tag in VOID:
            state.heading = False
        elif opening:
            state.begin(tag)
            state.push(tag, page[found.end() : at])
            state.heading = False
        else:
            state.end(tag)
    state.end_block()
    return state.blocks


def features_of(blocks: list[Block]) -> np.ndarray:
    """A row per block, of one at least: words and link density of it, the one before and the one after, place."""
    own = np.array([[b.words, b.linked / b.words] for b in blocks], dtype=float).reshape(-1, 2)
    edge = np.zeros((1, 2))
    place = np.array([[b.furniture, b.article, b.heading] for b in blocks], dtype=float).reshape(-1, 3)
    before, after = np.vstack([edge, own[:-1]]), np.vstack([own[1:], edge])
    return np.hstack([own, before, after, place])


@dataclass
class Node:
    label: bool
    feature: int = -1
    threshold: float = 0.0
    low: Node | None = None
    high: Node | None = None


def grow_tree(rows: np.ndarray, labels: np.ndarray, depth: int = 6) -> Node:
    """A binary tree of the splits with the least Gini impurity; midpoints as thresholds."""
    node = Node(bool(labels.mean() > 0.5))
    if depth == 0 or labels.min() == labels.max():
        return node
    best = (len(labels) * 2.0 * labels.mean() * (1 - labels.mean()), -1, 0.0)
    for feature in range(rows.shape[1]):
        values = np.unique(rows[:, feature])
        for threshold in (values[1:] + values[:-1]) / 2:
            low = rows[:, feature] <= threshold
            impurity = sum(
                len(part) * 2.0 * part.mean() * (1 - part.mean()) for part in (labels[low], labels[~low])
            )
            if impurity < best[0] - 1e-9:
                best = (impurity, feature, float(threshold))
    _, node.feature, node.threshold = best
    if node.feature >= 0:
        low = rows[:, node.feature] <= node.threshold
        node.low = grow_tree(rows[low], labels[low], depth - 1)
        node.high = grow_tree(rows[~low], labels[~low], depth - 1)
    return node


def is_article(node: Node, row: list[float]) -> bool:
    while node.feature >= 0:
        node = node.low if row[node.feature] <= node.threshold else node.high
    return node.label


_SENTENCES = (
    "The river rose in the night and by morning the lower fields were under water again. "
    "Nobody at the mill had expected it, said Mrs Hale, who has kept the gauge since 1987. "
    "Farmers moved their cattle uphill; two roads stay closed until Friday at the earliest. "
).split()


def _prose(words: int) -> str:
    return " ".join((_SENTENCES * (words // len(_SENTENCES) + 1))[:words])


def _link(words: int) -> str:
    return f'<a href="/x">{_prose(words)}</a>'


_TITLE = f"<h1>{_prose(8)}</h1>"

# The labelled table: pages as (html of a block's surroundings with {} for it, block, is article).
LABELLED: list[list[tuple[str, str, bool]]] = [
    # a page with an article element and everything around it
    [
        ("<nav><ul>{}</ul></nav>", f"<li>{_link(2)}</li>", False),
        ("<nav><ul>{}</ul></nav>", "<li>Home</li>", False),
        ('<div class="ad">{}</div>', _prose(12), False),
        ('<div class="ad">{}</div>', _prose(40), False),
        ("<article>{}</article>", _TITLE, True),
        ("<article>{}</article>", f"<p>{_prose(120)}</p>", True),
        ("<article>{}</article>", f"<p>{_prose(3)}</p>", True),
        ("<article>{}</article>", f"<p>{_prose(1)}</p>", True),
        ("<article>{}</article>", f"<p>{_prose(30)} {_link(4)}</p>", True),
        ("<article>{}</article>", f'<div class="share">{_link(3)}</div>', False),
        ("<article>{}</article>", f"<aside>{_prose(25)}</aside>", False),
        ("<article>{}</article>", f"<p>{_link(6)}</p>", True),
        ('<div id="comments">{}</div>', f"<p>{_prose(60)}</p>", False),
        ('<div id="comments">{}</div>', f"<p>{_prose(4)}</p>", False),
        ("<footer>{}</footer>", _prose(9), False),
        ("<footer>{}</footer>", f"<p>{_prose(70)}</p>", False),
    ],
    # no article element: link lists before and after the prose, without names
    [
        ("<header>{}</header>", _prose(5), False),
        ("<div>{}</div>", f"<p>{_link(3)}</p>", False),
        ("<div>{}</div>", f"<p>{_link(2)} {_link(2)} {_link(3)}</p>", False),
        ("<div>{}</div>", f"<p>{_link(2)} | {_link(2)} | {_link(2)}</p>", False),
        ("<div>{}</div>", _TITLE, True),
        ("<div>{}</div>", f"<p>{_prose(80)}</p>", True),
        ("<div>{}</div>", f"<p>{_prose(24)}</p>", True),
        ("<div>{}</div>", f"<p>{_prose(6)}</p>", True),
        ("<div>{}</div>", f"<p>{_prose(12)} {_link(10)}</p>", True),
        ("<div>{}</div>", f"<p>{_prose(50)}</p>", True),
        ('<div class="sidebar">{}</div>', f"<p>{_prose(35)}</p>", False),
        ("<form>{}</form>", f"<p>{_prose(14)}</p>", False),
        ('<div class="cookie-notice">{}</div>', f"<p>{_prose(45)}</p>", False),
        ("<div>{}</div>", f"<p>{_link(1)} - {_link(2)}</p>", False),
        ("<div>{}</div>", f"<p>{_link(2)}</p>", False),
    ],
    # a main element with headings, items and quotes
    [
        ("<main>{}</main>", f"<h2>{_prose(5)}</h2>", True),
        ("<main>{}</main>", f"<p>{_prose(55)}</p>", True),
        ("<main><ul>{}</ul></main>", f"<li>{_prose(2)}</li>", True),
        ("<main><blockquote>{}</blockquote></main>", f"<p>{_prose(18)}</p>", True),
        ("<main><table><tr>{}</tr></table></main>", f"<td>{_prose(1)}</td>", True),
        ("<main>{}</main>", f"<p>{_link(4)} {_prose(2)}</p>", True),
        ('<section class="related">{}</section>', f"<p>{_link(5)}</p>", False),
        ('<section class="newsletter">{}</section>', f"<p>{_prose(20)}</p>", False),
    ],
    # short news in plain containers
    [
        ("<div>{}</div>", f"<p>{_prose(4)}</p>", True),
        ("<div>{}</div>", f"<p>{_prose(2)}</p>", True),
        ("<ul>{}</ul>", f"<li>{_prose(3)}</li>", True),
        ("<ul>{}</ul>", f"<li>{_prose(5)}</li>", True),
        ("<ul>{}</ul>", f"<li>{_prose(1)}</li>", True),
    ],
    # one short text after links, the last of its page or followed by others
    *(
        [
            ("<div>{}</div>", f"<p>{_link(n)}</p>", False),
            *(("<div>{}</div>", f"<p>{_prose(size)}</p>", True) for size in sizes),
        ]
        for n in (1, 2, 4)
        for sizes in ((1,), (2,), (3,), (1, 2), (2, 4), (2, 9))
    ),
    # texts between links, outside and inside an article
    *(
        [
            (frame, f"<p>{_link(2)}</p>", in_article),
            (frame, f"<p>{_prose(n)}</p>", True),
            (frame, f"<p>{_link(5)}</p>", in_article),
            (frame, f'<div class="share">{_link(n)}</div>', False),
            (frame, f"<p>{_prose(n + 20)}</p>", True),
            (frame, f"<p>{_link(n)}</p>", in_article),
        ]
        for frame, in_article, sizes in (
            ("<div>{}</div>", False, (3, 4, 7, 15, 35, 90)),
            ("<article>{}</article>", True, (1, 2, 3, 4, 7, 15, 35, 90)),
        )
        for n in sizes
    ),
    # a long menu of links with plain labels between, then a text whose paragraphs hold links
    [
        ("<ul>{}</ul>", f"<li>{_link(1)}</li>", False),
        ("<ul>{}</ul>", f"<li>{_link(3)}</li>", False),
        ("<ul>{}</ul>", f"<li>{_link(12)}</li>", False),
        *(
            row
            for n in (1, 2, 4, 8, 12, 20)
            for row in (
                ("<ul>{}</ul>", f"<li>{_prose(1)}</li>", False),
                ("<ul>{}</ul>", f"<li>{_link(n)}</li>", False),
                ("<ul>{}</ul>", f"<li>{_prose(2)}</li>", False),
                ("<ul>{}</ul>", f"<li>{_link(n)}</li>", False),
            )
        ),
        ("<ul>{}</ul>", f"<li>{_link(2)}</li>", False),
        ("<ul>{}</ul>", f"<li>{_link(20)} {_prose(2)}</li>", False),
        ("<ul>{}</ul>", f"<li>{_link(4)} {_prose(1)}</li>", False),
        ("<div>{}</div>", f"<h2>{_prose(4)}</h2>", True),
        ("<div>{}</div>", f"<p>{_link(3)} {_prose(9)}</p>", True),
        ("<div>{}</div>", f"<p>{_prose(40)} {_link(20)} {_prose(9)}</p>", True),
        ("<div>{}</div>", f"<p>{_prose(15)}</p>", True),
        ("<div>{}</div>", f"<p>{_link(7)}</p>", False),
        ("<div>{}</div>", f"<p>{_link(16)}</p>", False),
        ("<div>{}</div>", f"<p>{_prose(1)} {_link(9)}</p>", False),
    ],
    # reader comments and adverts marked on paragraphs, items and cells
    [
        ("<article>{}</article>", f"<p>{_prose(33)}</p>", True),
        ("<article>{}</article>", f'<p class="ad">{_prose(9)}</p>', False),
        ("<article>{}</article>", f'<div class="share-price"><p>{_prose(7)}</p></div>', True),
        ('<ol class="commentlist">{}</ol>', f'<li class="comment">{_prose(22)}</li>', False),
        ("<table><tr>{}</tr></table>", f'<td class="sidebar">{_prose(11)}</td>', False),
    ],
    # texts that follow links at once, of all sizes
    [
        *(
            row
            for n in (1, 2, 3, 5, 9, 14, 30, 90)
            for row in (
                ("<div>{}</div>", f"<p>{_link(1 + n // 2)}</p>", False),
                ("<div>{}</div>", f"<h1>{_prose(n)}</h1>", True),
                ("<div>{}</div>", f"<p>{_prose(20 + n)}</p>", True),
                ("<div>{}</div>", f"<p>{_link(2)} {_link(n)}</p>", False),
                ("<div>{}</div>", f"<p>{_prose(6 + n)}</p>", True),
                ("<div>{}</div>", f"<p>{_prose(n)}</p>", True),
            )
        ),
    ],
    # an article that is little but links
    [
        *(
            row
            for n in (1, 2, 3, 5, 9, 14, 30)
            for row in (
                ("<article>{}</article>", f"<p>{_link(n)}</p>", True),
                ("<article><ul>{}</ul></article>", f"<li>{_link(2)} {_prose(n)}</li>", True),
                ("<article>{}</article>", f"<p>{_prose(n)}</p>", True),
                ("<article><ul>{}</ul></article>", f"<li>{_link(n)}</li>", True),
                ("<article><ul>{}</ul></article>", f"<li>{_link(3)}</li>", True),
            )
        ),
    ],
]


def trained_tree() -> Node:
    rows, labels = [], []
    for page in LABELLED:
        blocks = [blocks_of(frame.format(block)) for frame, block, _ in page]
        flat = [block for own in blocks for block in own]
        rows.append(features_of(flat))
        labels += [label for own, (_, _, label) in zip(blocks, page) for _ in own]
    return grow_tree(np.vstack(rows), np.array(labels, dtype=float))


def main_text(page: str | None, tree: Node) -> str:
    blocks = blocks_of(page or "")
    if not blocks:
        return ""
    rows = features_of(blocks).tolist()
    return " ".join(block.text for block, row in zip(blocks, rows) if is_article(tree, row))


def extract_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every page."""
    tree = trained_tree()

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page.as_py(), tree) for page in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(texts, pa.string()),
                    pa.array([len(text) for text in texts], pa.int64()),
                ],
                names=["page_id", "url", "text", "n_chars"],
            )

    return pages.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.col("html").cast("string").alias("html"),
    ).mapInArrow(extracted, "page_id bigint, url string, text string, n_chars bigint")
