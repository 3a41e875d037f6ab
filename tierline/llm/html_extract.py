"""Main text of web pages by gradient-boosted trees over DOM nodes
(operator 5).

A page becomes a tree of block nodes; inline markup belongs to the block it
stands in.  Trees score every node from the density of its subtree, the
tokens of its tag and attributes, its depth, its ancestors and its siblings.
A dynamic programme then picks the most likely consistent labelling: a node
is a wrapper, content or boilerplate; below boilerplate all is boilerplate,
below content a node is content or boilerplate.

There are no labelled pages, so the trees are fitted once on pages generated
by rule (``sample_page``), in layouts whose content is known.
"""

from __future__ import annotations

import random
import re
from functools import lru_cache
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.llm import gbt
from tierline.llm.shared import ship
from tierline.llm.textstats import slices

_INLINE = set("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q s samp small span strike strong sub sup time tt u var wbr "
              # shown or fallback content that belongs to the text around it
              "audio canvas object video math maction menclose merror mfrac mi mmultiscripts mn mo mover mpadded mphantom mroot mrow ms mspace msqrt "
              "mstyle msub msubsup msup mtable mtd mtext mtr munder munderover semantics".split())
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_SILENT = set("script style noscript template title head textarea select svg iframe button annotation annotation-xml".split())
#: A head stays open before these.
_HEAD = set("script style noscript template title".split())
_CLOSES_P = set("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
_BLOCKS = _CLOSES_P - {"p"}
_SELF = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_SCOPE = set("ul ol dl table body div article section main".split())
#: Attribute tokens that tell what a node is for.
_KINDS = [
    set("content article post entry story main body text".split()),
    set("nav menu navbar breadcrumb breadcrumbs navigation topbar pagination pager tabs skip".split()),
    set("header masthead banner footer foot bottom copyright legal colophon".split()),
    set("sidebar aside related widget rail recommended popular trending tags share social promo".split()),
    set("ad ads advert adverts advertisement sponsor sponsored promoted".split()),
    set("cookie cookies consent notice gdpr popup modal newsletter subscribe signup alert overlay".split()),
    set("comment comments reply replies respond disqus discussion responses".split()),
    set("form login search".split()),
]
_TAGS = ["p", "h", "li", "div", "article", "main", "section", "nav", "header", "footer", "aside", "form", "ul", "table", "blockquote", "pre"]
_TAG_ROWS, _NO_TAG = {t: np.eye(len(_TAGS))[i] for i, t in enumerate(_TAGS)}, np.zeros(len(_TAGS))
_SPACE = re.compile(r"\s+")


class Node:
    __slots__ = ("tag", "attrs", "kids", "parent", "text", "links", "first", "order")

    def __init__(self, tag: str, attrs: str, parent: "Node | None"):
        self.tag, self.attrs, self.parent = tag, attrs, parent
        #: text pieces and child nodes in page order
        self.kids: list = []


class _Tree(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("#root", "", None)
        self.links = self.silent = 0
        #: the node that took text outside html and body
        self.loose: Node | None = None
        #: open nodes by tag, so that an end tag without a partner costs nothing
        self.open: dict[str, int] = {}

    def _enter(self, n: Node) -> None:
        self.at.kids.append(n)
        self.at = n
        self.open[n.tag] = self.open.get(n.tag, 0) + 1

    def _leave(self, n: Node) -> None:
        """Close the open nodes up to and with ``n``."""
        while True:
            at = self.at
            self.open[at.tag] -= 1
            self.at = at.parent
            if at is n:
                return

    def _imply(self) -> None:
        self.loose = Node("#text", "", self.at)
        self._enter(self.loose)

    def handle_starttag(self, tag, attrs):
        if tag in ("html", "head", "body") and self.at is self.loose or self.at.tag == "head" and tag not in _HEAD | _VOID:
            self._leave(self.at)
        if tag in _VOID or tag in _INLINE:
            if tag in ("br", "hr"):
                self.at.kids.append((" ", False))
            if tag == "a":
                self.links = 1
            return
        if tag in _CLOSES_P:
            self._close({"p"}, _BLOCKS)
        if tag in _SELF:
            self._close(_SELF[tag], _SCOPE)
        words = " ".join(v for k, v in attrs if v and k in ("class", "id", "role", "itemprop", "aria-label"))
        self._enter(Node(tag, words.lower(), self.at))
        self.links = 0

    def _close(self, tags, stop):
        if not any(self.open.get(t) for t in tags):
            return
        n = self.at
        while n.parent is not None and n.tag not in stop:
            if n.tag in tags:
                self._leave(n)
                return
            n = n.parent

    def handle_endtag(self, tag):
        if tag == "a":
            self.links = 0
        if tag in _INLINE or tag in _VOID:
            return
        if tag in ("html", "body"):
            # what follows still belongs to the page's open nodes
            return
        if self.open.get(tag):
            n = self.at
            while n.tag != tag:
                n = n.parent
            self._leave(n)
            self.links = 0

    def handle_data(self, data):
        if self.at.tag in ("#root", "html", "head") and data.strip().strip("\ufeff").strip():
            if self.at.tag == "head":
                self._leave(self.at)
            self._imply()
        self.at.kids.append((data, bool(self.links)))


def parse(html: str) -> list[Node]:
    """Nodes of a page in document order; the first is the root."""
    t = _Tree()
    t.feed(html)
    t.close()
    out, todo = [], [t.root]
    while todo:
        n = todo.pop()
        n.order = len(out)
        out.append(n)
        todo += [k for k in reversed(n.kids) if isinstance(k, Node)]
    return out


@lru_cache(50_000)
def _kinds(attrs: str) -> tuple[int, ...]:
    words = set(re.split(r"[^a-z]+", attrs))
    return tuple(int(bool(words & k)) for k in _KINDS)


def features(nodes: list[Node]) -> np.ndarray:
    n = len(nodes)
    chars, links, marks, subtree, paras = (np.zeros(n) for _ in range(5))
    own = np.zeros(n)
    for i, d in enumerate(nodes):
        if d.tag in _SILENT:
            continue
        for k in d.kids:
            if not isinstance(k, Node):
                m = len(k[0].strip())
                own[i] += m
                links[i] += m * k[1]
                marks[i] += sum(map(k[0].count, ".,;!?"))
    chars += own
    for i in range(n - 1, 0, -1):
        p = nodes[i].parent.order
        subtree[i] += 1
        paras[i] += nodes[i].tag == "p"
        for a in (chars, links, marks, subtree, paras):
            a[p] += a[i]
    subtree[0] += 1
    total = max(1.0, chars[0])
    tag = ["h" if re.fullmatch("h[1-6]", d.tag) else "ul" if d.tag in ("ol", "dl") else d.tag for d in nodes]
    depth, above = np.zeros(n), np.zeros((n, len(_KINDS) + 7))
    special = ["article", "main", "nav", "header", "footer", "aside", "form"]
    sib: dict[int, list[int]] = {}
    for i, d in enumerate(nodes):
        if d.parent is not None:
            p = d.parent.order
            depth[i] = depth[p] + 1
            above[i] = above[p]
            sib.setdefault(p, []).append(i)
        above[i, :len(_KINDS)] = np.maximum(above[i, :len(_KINDS)], _kinds(d.attrs))
        if tag[i] in special:
            above[i, len(_KINDS) + special.index(tag[i])] = 1
    peers, place, share = np.ones(n), np.zeros(n), np.ones(n)
    for p, c in sib.items():
        most = max(1.0, max(chars[j] for j in c))
        for k, j in enumerate(c):
            peers[j], place[j], share[j] = len(c), k / len(c), chars[j] / most
    c = np.maximum(1.0, chars)
    kind = np.array([_kinds(d.attrs) for d in nodes], float)
    is_tag = np.array([_TAG_ROWS.get(t, _NO_TAG) for t in tag])
    base = [np.log1p(chars), chars / total, links / c, marks / c, np.log1p(subtree), chars / subtree, paras, own / c, depth, peers, place, share]
    return np.column_stack([*base, kind, above, is_tag])


def decode(nodes: list[Node], score: np.ndarray) -> np.ndarray:
    """The best consistent labelling: 1 for content nodes.  ``score`` is the
    log-odds that a node is content."""
    n = len(nodes)
    yes, no = (-np.logaddexp(0, -score)).tolist(), (-np.logaddexp(0, score)).tolist()
    drop, keep, wrap = list(no), list(yes), list(no)
    for i in range(n - 1, 0, -1):
        p = nodes[i].parent.order
        drop[p] += drop[i]
        keep[p] += max(keep[i], drop[i])
        wrap[p] += max(wrap[i], keep[i], drop[i])
    state = [0] * n  # 0 wrapper, 1 content, 2 boilerplate
    for i, d in enumerate(nodes):
        above = 0 if d.parent is None else state[d.parent.order]
        if above == 2:
            state[i] = 2
        elif above == 1:
            state[i] = 1 if keep[i] >= drop[i] else 2
        else:
            best = max(wrap[i], keep[i], drop[i])
            state[i] = 0 if wrap[i] == best else 1 if keep[i] == best else 2
            if d.parent is None and state[i] != 0 and len(nodes) > 1:
                state[i] = 0
    return (np.array(state) == 1).astype(int)


def blocks(nodes: list[Node], kept: np.ndarray) -> list[str]:
    """Text of the content blocks in page order, white space folded."""
    out, open_ = [], []

    def flush():
        t = _SPACE.sub(" ", "".join(open_)).strip()
        open_.clear()
        if t:
            out.append(t)

    todo: list = [(nodes[0], False)]
    while todo:
        d, shut = todo.pop()
        if not isinstance(d, Node):
            open_.append(d[0])
            continue
        flush()
        if shut or d.tag in _SILENT:
            continue
        todo.append((d, True))
        for k in reversed(d.kids):
            if isinstance(k, Node):
                todo.append((k, False))
            elif kept[d.order]:
                todo.append((k, False))
    flush()
    return out


def extract(pages: list[str], trees: gbt.Trees) -> list[str]:
    """Main text of each page, empty if none; the nodes of all these pages are
    scored together."""
    parsed = [parse(html) if html.strip() else [] for html in pages]
    rows = [features(nodes) for nodes in parsed if nodes]
    if not rows:
        return [""] * len(pages)
    score, at, out = trees.score(np.concatenate(rows)), 0, []
    for nodes in parsed:
        out.append(" ".join(blocks(nodes, decode(nodes, score[at:at + len(nodes)]))) if nodes else "")
        at += len(nodes)
    return out


_WORDS = ["".join(p) for p in zip("lomitarenuso" * 6, "aeiouaeioua" * 7, "nrstlmdkpvb" * 7, "aeuioeauio" * 8)]


def sample_page(rng: random.Random, loose: bool = False) -> str:
    """A page in a random layout, whose content elements carry ``data-y``;
    with ``loose`` one whose content, or part of it, stands outside blocks."""

    def sentence(a=4, b=18):
        return " ".join(rng.choice(_WORDS) + rng.choice(["", "", "", ",", "%", "&amp;"]) for _ in range(rng.randint(a, b))).capitalize() + "."

    def para():
        body = " ".join(sentence() for _ in range(rng.choice([1, 1, 2, 4, 7])))
        if rng.random() < 0.15:
            body = rng.choice(_WORDS).capitalize() + "."
        if rng.random() < 0.15:
            body = f'<a href="/x">{rng.choice(_WORDS)}</a> ' + body
        if rng.random() < 0.15:
            return f"<p data-y><b>{body}<br>"
        return f"<p data-y>{body}</p>"

    def link_list(n):
        return "<ul>" + "".join(f'<li><a href="/{w}">{w}</a></li>' for w in rng.sample(_WORDS, n)) + "</ul>"

    def named(tags, names):
        tag, name = rng.choice(tags), rng.choice(names)
        return f'<{tag} {rng.choice(["class", "id"])}="{name}">', f"</{tag}>"

    def junk(kind):
        if kind == "nav":
            a, z = rng.choice([("<nav>", "</nav>"), named(["div", "ul"], ["menu", "main-nav", "navbar", "breadcrumbs", "site-menu"])])
            return a + link_list(rng.randint(2, 8)) + z
        if kind == "header":
            a, z = rng.choice([("<header>", "</header>"), named(["div"], ["header", "masthead", "page-banner"])])
            return a + f"<h1>{sentence(1, 4)}</h1>" * rng.randint(0, 1) + f"<p>{sentence(2, 6)}</p>" + link_list(rng.randint(0, 3)) + z
        if kind == "footer":
            a, z = rng.choice([("<footer>", "</footer>"), named(["div", "section"], ["footer", "page-footer", "copyright", "legal"])])
            return a + f"&copy; {rng.choice(_WORDS)} {sentence(1, 8)}" + f"<p>{sentence()}</p>" * rng.randint(0, 2) + z
        if kind == "side":
            a, z = rng.choice([("<aside>", "</aside>"), named(["div", "section", "aside"], ["sidebar", "related-posts", "widget", "share", "trending", "promo"])])
            return a + f"<h3>{sentence(1, 3)}</h3>" + (link_list(rng.randint(2, 5)) if rng.random() < 0.5 else f"<p>{sentence()}</p>" * rng.randint(1, 3)) + z
        if kind == "ad":
            a, z = named(["div", "section", "aside", "p"], ["ad", "ads", "advert", "sponsored", "ad-slot"])
            return a + " ".join(sentence() for _ in range(rng.randint(1, 3))) + z
        if kind == "notice":
            a, z = named(["div", "section"], ["cookie-notice", "consent", "newsletter", "subscribe-box", "popup", "gdpr", "notice"])
            return a + f"<p>{sentence()}</p>" * rng.randint(1, 2) + "<button>OK</button>" * rng.randint(0, 1) + z
        if kind == "form":
            return f'<form action="/s">{sentence(1, 4)}<label>{sentence(1, 2)}</label><input name="q"><p>{sentence()}</p></form>'
        a, z = named(["div", "section", "ol"], ["comments", "comment-list", "replies", "discussion", "user-comments"])
        one = "li" if a.startswith("<ol") else "div"
        return a + f"<h3>{sentence(1, 2)}</h3>" * rng.randint(0, 1) + "".join(
            f'<{one} class="comment"><p>{sentence()} {sentence()}</p></{one}>' for _ in range(rng.randint(1, 6))) + z

    a, z = rng.choice([("<article data-y>", "</article>"), ("<article data-y>", "</article>"), ("<main data-y>", "</main>"),
                       (f'<div class="{rng.choice(["content", "post-body", "entry-content", "article", "story", "main-text"])}" data-y>', "</div>"),
                       ("<main><article data-y>", "</article></main>"), ("<main><div data-y class='post'>", "</div></main>")])
    body = [f"<h1 data-y>{sentence(2, 9)}</h1>"] if rng.random() < 0.8 else []
    for _ in range(rng.choice([0, 1, 2, 5, 9, 16])):
        body.append(para())
        if rng.random() < 0.1:
            body.append(f"<h2 data-y>{sentence(1, 5)}</h2>")
        if rng.random() < 0.08:
            body.append("<ul data-y>" + "".join(f"<li data-y>{sentence(2, 9)}</li>" for _ in range(rng.randint(2, 5))) + "</ul>")
        if rng.random() < 0.05:
            body.append(f"<blockquote data-y><p data-y>{sentence()}</p></blockquote>")
        if rng.random() < 0.06:
            body.append(junk(rng.choice(["ad", "side", "notice", "form"])))
    if rng.random() < 0.1:
        body.append(junk("comments"))
    some = lambda kinds, p: "".join(junk(k) for k in kinds if rng.random() < p)
    if loose:
        gap = rng.choice(["<br><br>", "<br>\n", "\n\n", "<script>x()</script>"])
        text = gap.join(" ".join(sentence() for _ in range(rng.randint(1, 5))) for _ in range(rng.randint(1, 7)))
        text += "".join(para() for _ in range(rng.choice([0, 0, 2])))
        before, after = some(["notice", "header", "nav"], 0.2), some(["comments", "side", "ad", "footer"], 0.2)
        return rng.choice([f"{before}{text}{after}", f"{before}{text}{after}", f"<html><head><title>{sentence(1, 5)}</title></head><body data-y>{before}{text}{after}</body></html>",
                           f"<html><body data-y>{before}{a}{''.join(body)}{z}</body></html>{text}"])
    page = (some(["notice", "header", "nav", "ad", "form"], 0.5) + a + "".join(body) + z + some(["comments", "side", "ad", "form", "notice", "footer"], 0.5))
    wrap = rng.choice(["{}", '<div id="page">{}</div>', '<div class="wrapper"><div class="row">{}</div></div>'])
    return f"<!DOCTYPE html><html><head><title>{sentence(1, 5)}</title><style>p{{}}</style></head><body>{wrap.format(page)}</body></html>"


class _Marked(_Tree):
    def handle_starttag(self, tag, attrs):
        super().handle_starttag(tag, attrs)
        if any(k == "data-y" for k, _ in attrs):
            self.at.attrs += "\x00"

    def _imply(self):
        super()._imply()
        self.at.attrs += "\x00"


def labelled(html: str) -> tuple[list[Node], np.ndarray]:
    """Nodes of a sample page and which of them are content."""
    t = _Marked()
    t.feed(html)
    t.close()
    out, todo = [], [t.root]
    while todo:
        n = todo.pop()
        n.order = len(out)
        out.append(n)
        todo += [k for k in reversed(n.kids) if isinstance(k, Node)]
    y = np.array([n.attrs.endswith("\x00") for n in out], float)
    for n in out:
        n.attrs = n.attrs.rstrip("\x00")
    return out, y


def fit(pages: int = 400, seed: int = 5, loose: int = 160) -> gbt.Trees:
    """Trees fitted on ``pages`` generated pages and ``loose`` more with text
    outside blocks; the same at every size of the input."""
    rng, xs, ys = random.Random(seed), [], []
    for i in range(pages + loose):
        nodes, y = labelled(sample_page(rng, i >= pages))
        xs.append(features(nodes))
        ys.append(y)
    return gbt.train(np.concatenate(xs), np.concatenate(ys), trees=30, depth=5, least=5)


OUT = "page_id long, url string, text string, n_chars long"


def main_text(pages: DataFrame, trees: gbt.Trees | None = None) -> DataFrame:
    """``page_id, url, text, n_chars`` per row of ``pages(page_id, url,
    html)``.  Null and empty html give an empty text.  Repeated rows give
    repeated results; an empty table gives none; extra columns are ignored.
    Memory is bounded by half a megabyte of pages, or one page if longer."""
    spark = pages.sparkSession
    ship(spark)
    held = spark.sparkContext.broadcast(trees or fit())

    def run(batches):
        for b in batches:
            html = b.column("html")
            for at, n in slices(html, most=500_000, rows=256):
                text = extract([h or "" for h in html.slice(at, n).to_pylist()], held.value)
                yield pa.RecordBatch.from_arrays([b.column("page_id").slice(at, n), b.column("url").slice(at, n), pa.array(text, pa.string()),
                                                  pa.array([len(t) for t in text], pa.int64())], ["page_id", "url", "text", "n_chars"])

    p = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return p.mapInArrow(run, OUT)
