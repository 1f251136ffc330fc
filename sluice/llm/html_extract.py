"""Main text of web pages by gradient-boosted trees over DOM nodes.

A page becomes a tree of block elements.  Each node has features: its tag and
the kinds of words in its class, id and role; which of these its ancestors
have; length, link, tag and punctuation density of its subtree; depth, place
among its siblings and how these look.  Boosted trees give each node log-odds
of holding main text.  Decoding picks the set of nodes with the largest sum of
log-odds among those in which no kept node has a dropped ancestor, from the
leaves up.

The trees are trained on a bounded sample of the pages themselves: pages whose
markup tells which element is the article, and blocks of the pages' text set
into layouts made at random, of which it is known what is article and what is
menu, sidebar, notice, advert, form or reader comment.
"""

from __future__ import annotations

import html as entities
import math
import random
import re
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.boosting import Booster
from sluice.llm.common import id_key, restored, small_batches

TOKEN = re.compile(
    r"""<!--.*?(?:--!?>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>|<[!?/][^>]*+>""", re.S)
ATTRIBUTE = re.compile(r"""(?:^|[\s/"'])(class|id|role|itemprop|aria-label|hidden|style)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""", re.I)

# Fixed values of the HTML standard.
RAW = {"script", "style", "title", "textarea", "iframe", "noembed", "noframes", "xmp"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCKS = {
    "address", "article", "aside", "blockquote", "body", "button", "caption", "center", "dd", "details", "dialog", "div", "dl", "dt",
    "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hgroup", "html",
    "legend", "li", "main", "menu", "nav", "noscript", "ol", "optgroup", "option", "p", "pre", "section", "select", "summary", "svg",
    "table", "tbody", "td", "template", "tfoot", "th", "thead", "tr", "ul"}
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
          "option": {"option"}, "optgroup": {"option", "optgroup"}, "tbody": {"tr", "td", "th", "thead", "tbody"}, "body": {"head"}}
STOPS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"},
         "option": {"select"}, "optgroup": {"select"}, "tbody": {"table"}, "body": {"html"}}
IN_P = BLOCKS - {"button", "caption", "head", "html", "body", "legend", "noscript", "optgroup", "option", "select", "svg", "tbody", "td",
                 "template", "tfoot", "th", "thead", "tr"}
UNSEEN = {"head", "template", "svg", "noscript", "select", "button"}

TAG_KINDS = [{"article", "main"}, {"nav", "menu"}, {"header", "hgroup"}, {"footer"}, {"aside"}, {"form", "fieldset", "legend"},
             {"section"}, {"div", "center"}, {"p", "blockquote", "pre"}, {"h1"}, {"h2", "h3", "h4", "h5", "h6"}, {"li", "dt", "dd"},
             {"ul", "ol", "dl"}, {"table", "tbody", "thead", "tfoot", "tr", "td", "th"}, {"figure", "figcaption"}, {"body", "html"}]
WORD_KINDS = [
    {"article", "content", "story", "post", "entry", "main", "text", "body", "articlebody", "prose", "copy"},
    {"nav", "navigation", "menu", "navbar", "breadcrumb", "breadcrumbs", "tabs", "toc", "pagination", "pager", "links"},
    {"header", "masthead", "topbar", "top", "logo", "brand", "banner", "contentinfo"},
    {"footer", "foot", "bottom", "copyright", "legal", "imprint", "colophon"},
    {"sidebar", "side", "aside", "rail", "widget", "widgets", "complementary", "related", "recommended", "popular", "trending", "more"},
    {"ad", "ads", "advert", "adverts", "advertisement", "adsense", "sponsor", "sponsored", "promo", "promotion", "promoted", "commercial"},
    {"cookie", "cookies", "consent", "gdpr", "notice", "notices", "alert", "warning", "popup", "modal", "overlay", "dialog", "toast", "disclaimer"},
    {"comment", "comments", "commentlist", "reply", "replies", "discussion", "disqus", "respond", "responses", "reader", "readers", "feedback"},
    {"form", "login", "signin", "signup", "subscribe", "subscription", "newsletter", "search", "contact", "register"},
    {"share", "social", "sharing", "follow", "tweet", "like", "tags", "meta", "byline", "author", "date"},
    {"hidden", "none", "invisible", "skip", "print", "offscreen"}]


class Node:
    __slots__ = ("tag", "words", "up", "kids", "depth", "parts", "chars", "linked", "tags", "marks", "blocks", "n_words", "at")

    def __init__(self, tag, words, up):
        self.tag, self.words, self.up, self.kids, self.parts = tag, words, up, [], []
        self.depth = up.depth + 1 if up else 0
        self.chars = self.linked = self.tags = self.marks = self.blocks = self.n_words = self.at = 0


def parse(page: str) -> tuple[list[Node], list[tuple[Node, str]]]:
    """Nodes of a page in document order, and its blocks: the text between two block boundaries, with the node it is in."""
    root = Node("html", (), None)
    nodes, blocks, node, at, link, run, end = [root], [], root, 0, 0, [], len(page)
    skip = None  # the unseen element that is open

    def flush():
        if run:
            text = " ".join(entities.unescape("".join(t for t, _ in run)).split())
            if text and skip is None:
                blocks.append((node, text))
                node.parts.append(text)
                if any(l for _, l in run):
                    node.linked += sum(len(t) for t, l in run if l)
            run.clear()

    def close(tags, stops):
        nonlocal node, skip
        n = node
        while n is not root and n.tag not in stops:
            if n.tag in tags:
                node = n.up
                if skip is not None and skip.depth > node.depth:
                    skip = None
                return
            n = n.up

    while at < end:
        m = TOKEN.search(page, at)
        if m is None:
            run.append((page[at:], link))
            break
        if m.start() > at:
            run.append((page[at:m.start()], link))
        at = m.end()
        name = m[2] or m[5]
        if name is None:
            continue
        name = name.lower()
        shut = m[1] or m[4]
        if name in BLOCKS:
            flush()
            if shut:
                n = node
                while n is not root and n.tag != name:
                    n = n.up
                if n is not root:
                    node = n.up
                    if skip is not None and skip.depth > node.depth:
                        skip = None
                link = 0
                continue
            if name == "html":
                continue
            if name in IN_P:
                close({"p"}, {"button", "td", "th", "caption", "table", "html"})
            if name in CLOSES:
                # All open elements that the new one ends, outermost last.
                while True:
                    before = node
                    close(CLOSES[name], STOPS[name])
                    if node is before:
                        break
            raw = m[3] if m[2] else m[6]
            words = ()
            if raw:
                words = tuple(w for k, *v in ATTRIBUTE.findall(raw) for w in re.findall("[a-z]+", (
                    "".join(v) if k.lower() not in ("style", "hidden") else "hidden" if k.lower() == "hidden" or "display:none" in "".join(v).replace(" ", "") else "").lower()))
            new = Node(name, words, node)
            node.kids.append(new)
            nodes.append(new)
            node = new
            if name in UNSEEN and skip is None:
                skip = new
        else:
            node.tags += 1
            if name == "a":
                link = 0 if shut else 1
            elif name == "br":
                run.append((" ", link))
            elif not shut and name in RAW:
                found = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.I).search(page, at)
                at = found.start() if found else end
    flush()
    return nodes, blocks


N_FEATURES = 2 * (len(TAG_KINDS) + len(WORD_KINDS)) + 23


def features(nodes: list[Node]) -> list[list[float]]:
    """One row per node; subtree figures are summed from the leaves up first."""
    for n in nodes:
        n.chars = sum(map(len, n.parts))
        n.n_words = sum(p.count(" ") + 1 for p in n.parts)
        n.marks = sum(p.count(".") + p.count(",") for p in n.parts)
        n.blocks = len(n.parts)
    for n in reversed(nodes):
        if n.up:
            u = n.up
            u.chars += n.chars
            u.linked += n.linked
            u.tags += n.tags + 1
            u.marks += n.marks
            u.blocks += n.blocks
            u.n_words += n.n_words
    total = max(1, nodes[0].chars)
    before, seen = {}, 0
    for n in nodes:
        before[n] = seen
        seen += sum(map(len, n.parts))
    def around(up):
        """How the parent looks as a whole."""
        long = sum(k.chars > 80 and k.linked < k.chars / 2 for k in up.kids)
        return math.log1p(up.chars), up.linked / max(1, up.chars), up.chars / total, long, long / len(up.kids)

    known = {}
    kinds, peer_tags, out = {}, {}, []
    for n in nodes:
        if n.kids:
            peer_tags[n] = Counter(k.tag for k in n.kids)
            for i, k in enumerate(n.kids):
                k.at = i
        own = [n.tag in k for k in TAG_KINDS] + [any(w in k for w in n.words) for k in WORD_KINDS]
        up = n.up
        over = [a or b for a, b in zip(*kinds[up])] if up else [False] * len(own)
        kinds[n] = own, over
        peers, place = len(up.kids) if up else 1, n.at
        same = peer_tags[up][n.tag] if up else 0
        prior = up.kids[place - 1].chars if up and place else 0
        later = up.kids[place + 1].chars if up and place + 1 < peers else 0
        parent = (0, 0, 0, 0, 0) if up is None else known.get(up) or known.setdefault(up, around(up))
        paragraphs = [k.chars for k in n.kids if k.tag == "p"]
        out.append([
            *own, *over, math.log1p(n.chars), n.linked / max(1, n.chars), n.tags / max(1, n.n_words), n.marks / max(1, n.n_words),
            n.chars / max(1, n.blocks), n.chars / max(1, n.n_words), n.chars / total, before[n] / total, n.depth, len(n.kids),
            peers, place / peers, same / peers, math.log1p(prior), math.log1p(later), len(paragraphs),
            sum(paragraphs) / max(1, n.chars), math.log1p(n.blocks), *parent])
    return out


def decode(nodes: list[Node], logits) -> set[Node]:
    """Nodes to keep: the largest sum of log-odds in which a kept node's ancestors are kept."""
    worth = {n: float(s) for n, s in zip(nodes, logits)}
    for n in reversed(nodes):
        if n.up and worth[n] > 0:
            worth[n.up] += worth[n]
    kept = set()
    for n in nodes:
        if worth[n] > 0 and (n.up is None or n.up in kept):
            kept.add(n)
    return kept


def main_text(pages: list[str], model: Booster) -> list[str]:
    """Main text of each page; the nodes of many pages are scored in one go."""
    import numpy as np

    parsed = [parse(p) for p in pages]
    rows = [r for nodes, _ in parsed for r in features(nodes)]
    logits = model.logits(np.array(rows, np.float32).reshape(len(rows), N_FEATURES))
    out, a = [], 0
    for nodes, blocks in parsed:
        kept = decode(nodes, logits[a:a + len(nodes)])
        a += len(nodes)
        out.append("\n".join(text for node, text in blocks if node in kept))
    return out


class Layouts:
    """Pages of known make-up around blocks of real text."""

    def __init__(self, texts: list[str], seed: int = 0):
        self.r, self.texts = random.Random(seed), texts

    def some(self, low: int, high: int) -> str:
        words = self.r.choice(self.texts).split() or ["text"]
        n = self.r.randint(low, high)
        a = self.r.randrange(max(1, len(words) - n + 1))
        return entities.escape(" ".join(words[a:a + n]))

    def count(self, low: int, high: int, long: float = 0.05) -> int:
        """How many siblings to make; now and then hundreds."""
        return self.r.randint(64, 400) if self.r.random() < long else self.r.randint(low, high)

    def attrs(self, *names: str) -> str:
        if not names or self.r.random() < 0.15:
            return ""
        name = self.r.choice(names)
        name = self.r.choice([name, name, f"{name}-{self.r.choice(['box', 'wrap', 'inner', 'block', 'area'])}", f"site-{name}", f"{name} {self.r.choice(['row', 'col', 'clearfix', 'grid'])}"])
        return f' {self.r.choice(["class", "class", "id"])}="{name}"'

    def links(self, n: int) -> str:
        li = "".join(f'<li><a href="/{i}">{self.some(1, 3)}</a></li>' for i in range(n))
        return self.r.choice([f"<ul>{li}</ul>", " | ".join(f'<a href="/{i}">{self.some(1, 2)}</a>' for i in range(n))])

    def prose(self, n: int, tag: str = "p") -> str:
        return "".join(f"<{tag}>{self.some(1, 120)}</{tag}>" for _ in range(n))

    def boilerplate(self) -> str:
        r, pick = self.r, self.r.randrange(13)
        div = r.choice(["div", "div", "section", "aside"])
        if pick == 0:
            return f"<nav{self.attrs('nav', 'menu')}>{self.links(self.count(2, 9))}</nav>"
        if pick == 1:
            return f"<div class=\"{r.choice(['menu', 'navbar', 'navigation', 'breadcrumbs', 'pagination'])}\">{self.links(r.randint(2, 8))}</div>"
        if pick == 2:
            return f"<header{self.attrs('header', 'masthead', 'banner')}>{r.choice(['', '<h1>' + self.some(1, 6) + '</h1>'])}<p>{self.some(2, 10)}</p>{r.choice(['', self.links(4)])}</header>"
        if pick == 3:
            return f"<footer{self.attrs('footer')}>&copy; {self.some(2, 14)}{r.choice(['', self.links(3), self.prose(1)])}</footer>"
        if pick == 4:
            return f"<div class=\"{r.choice(['footer', 'copyright', 'legal', 'imprint'])}\">{self.prose(r.randint(1, 2))}</div>"
        if pick == 5:
            return f"<{r.choice(['aside', 'div'])} class=\"{r.choice(['sidebar', 'side', 'widget', 'related', 'popular', 'trending'])}\"><h3>{self.some(1, 5)}</h3>{r.choice([self.links(r.randint(2, 7)), self.prose(r.randint(1, 4))])}</{div}>"
        if pick == 6:
            return f"<aside>{r.choice([self.prose(r.randint(1, 4)), self.links(4), '<h2>' + self.some(1, 4) + '</h2>' + self.prose(2)])}</aside>"
        if pick in (7, 8):
            name = r.choice(["ad", "ads", "advert", "advertisement", "sponsored", "promo"])
            return f"<{div} class=\"{name}\">{r.choice([self.some(2, 40), self.prose(r.randint(1, 3)), self.links(2)])}</{div}>"
        if pick == 9:
            return f"<div{r.choice([' role=alert', ''])} class=\"{r.choice(['cookie', 'notice', 'consent', 'alert', 'popup', 'disclaimer'])}\">{r.choice([self.some(4, 60), self.prose(r.randint(1, 2))])}<button>OK</button></div>"
        if pick == 10:
            return f"<form{self.attrs('newsletter', 'login', 'search', 'subscribe')}>{r.choice(['', self.prose(1)])}<label>{self.some(1, 4)}</label><input name=q><button>{self.some(1, 2)}</button></form>"
        if pick == 11:
            return self.comments()
        return f"<div class=\"{r.choice(['share', 'social', 'tags', 'follow'])}\">{self.links(r.randint(2, 5))}</div>"

    def comments(self) -> str:
        r = self.r
        item, shell = r.choice(["li", "div", "article"]), r.choice(["div", "section"])
        said = [f"<{item}{r.choice(['', ' class=comment'])}>{r.choice(['', '<b>' + self.some(1, 2) + '</b>'])}<p>{self.some(2, 80)}</p></{item}>" for _ in range(self.count(1, 8))]
        said = "".join(said) if item != "li" else f"<{(k := r.choice(['ol', 'ul']))}>{''.join(said)}</{k}>"
        name = r.choice(["comments", "commentlist", "discussion", "responses", "reader-comments", "comment-section"])
        head = r.choice(["", f"<h2>{self.some(1, 3)}</h2>", f"<h3>{self.some(1, 3)}</h3>"])
        form = r.choice(["", "<form><textarea></textarea><button>Post</button></form>"])
        return f"<{shell} {r.choice(['class', 'id'])}=\"{name}\">{head}{said}{form}</{shell}>"

    def content(self) -> str:
        r, out = self.r, []
        if r.random() < 0.8:
            head = f"<h1>{self.some(1, 14)}</h1>"
            out.append(f"<header>{head}</header>" if r.random() < 0.15 else head)
        for _ in range(self.count(1, 24)):
            pick = r.random()
            if pick < 0.72:
                out.append(f"<p>{self.some(1, 160)}" + r.choice(["</p>", "</p>", ""]))
            elif pick < 0.8:
                out.append(f"<h{(k := r.randint(2, 4))}>{self.some(1, 8)}</h{k}>")
            elif pick < 0.86:
                out.append("<ul>" + "".join(f"<li>{self.some(2, 30)}</li>" for _ in range(self.count(2, 6, 0.01))) + "</ul>")
            elif pick < 0.9:
                out.append(f"<p>{self.some(3, 40)} <a href=/x>{self.some(1, 5)}</a> {self.some(3, 40)}</p>")
            elif pick < 0.94:
                out.append(f"<blockquote><p>{self.some(4, 60)}</p></blockquote>")
            elif pick < 0.97:
                out.append(f"<p><b>{self.some(3, 80)}<br><p>{self.some(3, 60)}</p>")
            else:
                out.append("<table>" + "".join(f"<tr><td>{self.some(1, 4)}</td><td>{self.some(1, 8)}</td></tr>" for _ in range(self.count(2, 5, 0.01))) + "</table>")
        return "".join(out)

    def page(self) -> str:
        """A page whose main text stands between the marks ``\\x02`` and ``\\x03``."""
        r = self.r
        names = ["content", "article", "post", "entry", "story", "main"]
        tag = r.choice(["article", "article", "main", "div", "div", "section"])
        text, after = f"\x02{self.content()}\x03", self.boilerplate() if r.random() < 0.3 else ""
        style = r.random()
        if style < 0.08:
            inner = text + after  # straight in the body
        elif style < 0.16:
            side = f"<td{self.attrs('menu', 'sidebar', 'ads')}>{r.choice([self.links(4), self.some(2, 30)])}</td>"
            inner = f"<table><tr>{side if r.random() < 0.5 else ''}<td{self.attrs(*names)}>{text}</td>{side if r.random() < 0.5 else ''}</tr></table>"
        else:
            inner = f"<{tag}{self.attrs(*names) if tag != 'div' or r.random() < 0.8 else ''}>{text}{after}</{tag}>"
            if r.random() < 0.15:
                inner = f"<main>{inner}{self.comments() if r.random() < 0.5 else ''}</main>"
        if r.random() < 0.4:
            inner = f"<div{self.attrs('wrapper', 'container', 'page', 'layout')}>{self.boilerplate() if r.random() < 0.4 else ''}{inner}{self.boilerplate() if r.random() < 0.4 else ''}</div>"
        top = "".join(self.boilerplate() for _ in range(r.randint(0, 3)))
        bottom = "".join(self.boilerplate() for _ in range(r.randint(0, 3)))
        return f"<!DOCTYPE html><html><head><title>{self.some(1, 9)}</title><style>p{{}}</style></head><body>{top}{inner}{bottom}</body></html>"


def _marked(page: str) -> tuple[list[Node], dict] | None:
    """A real page whose markup tells its article: one article or main element, whose text is main but for parts that are boilerplate by tag."""
    nodes, _ = parse(page)
    own = [n for n in nodes if n.tag in TAG_KINDS[0]]
    own = [n for n in own if n.tag == "main"] or own
    if len(own) != 1:
        return None
    inside, main = {own[0]}, {}
    for n in nodes:
        if n.up in inside and n.tag not in {"nav", "menu", "footer", "aside", "form"}:
            inside.add(n)
        size, u = sum(map(len, n.parts)), n
        while size and u is not None:
            main.setdefault(u, [0, 0])[n in inside] += size
            u = u.up
    return nodes, main


def _laid_out(page: str) -> tuple[list[Node], dict]:
    """A made page, whose main text stands between its two marks."""
    nodes, blocks = parse(page)
    inside, main = False, {}
    for node, text in blocks:
        inside = inside or "\x02" in text
        while node is not None and text.strip("\x02\x03 "):
            main.setdefault(node, [0, 0])[inside] += len(text)
            node = node.up
        inside = inside and "\x03" not in text
    for n in nodes:
        n.parts = [p.replace("\x02", "").replace("\x03", "") for p in n.parts]
    return nodes, main


def train(pages: list[str], layouts: int = 600, seed: int = 0) -> Booster:
    """Boosted trees from pages that mark their article and from ``layouts`` made pages around the text of all.

    A node is of class 1 if most of its text is main text, or, where it holds
    other nodes, if any is.  Real pages, where there are any, count about half
    as much as made ones.
    """
    import numpy as np

    texts = [t for p in pages for _, t in parse(p)[1] if len(t) > 20]
    made = Layouts(texts or ["text"], seed)
    real = [m for m in map(_marked, pages) if m]
    known = real * (1 + layouts // max(1, len(real)) // 2) + [_laid_out(made.page()) for _ in range(layouts)]
    rows, marks = [], []
    for nodes, main in known:
        for n, row in zip(nodes, features(nodes)):
            if n in main:
                rows.append(row)
                other, text = main[n]
                marks.append(text > (0 if any(k in main for k in n.kids) else other))
    return Booster().fit(np.array(rows, np.float32), np.array(marks, np.float64))


def extract(pages: DataFrame, sample: int = 200, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per row of ``pages``: ``page_id, url, text, n_chars``.

    ``text`` joins the kept blocks in page order by a line feed; inside a block
    white space is one space.  Null and empty pages have an empty text.  Null
    ids and repeated rows are kept; other columns are left out.  The trees are
    trained on at most ``sample`` pages, those first by hash, of at most
    a quarter of a million characters each (longer ones are not trained on).
    """
    rows = pages.select(id_key(id_col).alias("page_id"), F.col(url_col).alias("url"), F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    small_batches(pages.sparkSession)
    short = rows.where("length(html) between 1 and 250000").select(F.xxhash64("html").alias("h"), "html")
    last = short.select("h").orderBy("h").limit(sample).agg(F.max("h")).first()[0]  # hashes first: pages stay on the executors
    chosen = short.where(F.col("h") <= last).dropDuplicates(["h"]).orderBy("h").collect() if last is not None else []
    model = train([r["html"] for r in chosen])

    def run(frames):
        for pdf in frames:
            texts = []
            for a in range(0, len(pdf), 64):
                texts += main_text(pdf["html"].iloc[a:a + 64].tolist(), model)
            out = pdf[["page_id", "url"]].copy()
            out["text"] = texts
            yield out

    out = rows.mapInPandas(run, "page_id string, url string, text string")
    out = out.withColumn("page_id", restored("page_id", pages.schema[id_col].dataType))
    return out.withColumn("n_chars", F.char_length("text").cast("long"))
