import html
import re

import numpy as np
import pytest

from sluice.llm.boosting import Booster
from sluice.llm.html_extract import N_FEATURES, Layouts, decode, extract, features, main_text, parse, train

SF = "/root/testdata/sf0.01"
PAGES = "page_id long, url string, html string"


@pytest.fixture(scope="module")
def sample():
    import duckdb

    return duckdb.sql(f"SELECT html FROM '{SF}/pages.parquet' ORDER BY page_id").fetchall()


@pytest.fixture(scope="module")
def model(sample):
    return train([p for p, in sample[:100]])


def blocks(page):
    return [t for _, t in parse(page)[1]]


def test_parser():
    assert blocks("<p>a &amp; b&nbsp;&#x41;<br>c<p>d</p>e<!-- x > --> f<script>var t='</p>';</script>g") == ["a & b A c", "d", "e fg"]
    assert blocks("<ul><li>1<li>2<ul><li>3</ul><li>4</ul>5") == ["1", "2", "3", "4", "5"]
    assert blocks("<table><tr><td>a<td>b<tr><td>c</table>") == ["a", "b", "c"]
    assert blocks("<head><title>t</title></head><body>x < y <a href='>'>z</a><style>p{}</style>") == ["x < y z"]
    assert blocks("<p>open <b>bold<p>next</b> text</div></p>") == ["open bold", "next text"]
    assert blocks("<script>never closed <p>x") == [] and blocks("") == [] and blocks("<") == ["<"]
    assert blocks("a<!-- never closed <p>x") == ["a"]


def test_very_deep_and_very_long_pages(model):
    deep = "<div>" * 20000 + "text" + "</div>" * 20000
    assert blocks(deep) == ["text"]
    long = "<article>" + "<p>some words, in a row.</p>" * 20000 + "</article>"
    assert len(main_text([deep, long], model)) == 2
    assert blocks('<a "' * 3000) == ['<a "' * 3000]


def test_decoding_never_keeps_below_a_dropped_node(model):
    for page in [Layouts(["some words to choose from"], 3).page() for _ in range(20)]:
        nodes, _ = parse(page)
        rng = np.random.default_rng(len(page))
        kept = decode(nodes, rng.standard_normal(len(nodes)))
        assert all(n.up is None or n.up in kept for n in kept)
    nodes, _ = parse("<div><p>a</p><p>b</p></div>")
    assert len(features(nodes)[0]) == N_FEATURES
    assert {n.tag for n in decode(nodes, [1, -1, 3, -5])} == {"html", "div", "p"}
    assert decode(nodes, [-9, 1, 1, 1]) == set()


def test_articles_of_the_pages(sample, model):
    def article(page):
        inner = re.search("<article>(.*)</article>", page, re.S)[1]
        parts = (" ".join(html.unescape(re.sub("</?[a-z]+>", " ", x)).split()) for x in re.split("</?(?:p|h1)>", inner))
        return "\n".join(p for p in parts if p)

    pages = [p for p, in sample[100:]]
    same = [got == article(p) for got, p in zip(main_text(pages, model), pages)]
    assert np.mean(same) >= 0.99


def test_unseen_layouts(sample, model):
    made = Layouts([t for p, in sample for t in blocks(p) if len(t) > 20], 77)
    right = kept = there = 0
    for _ in range(100):
        page = made.page()
        inside, want = False, []
        for _, text in parse(page)[1]:
            inside = inside or "\x02" in text
            if inside:
                want.append(text.strip("\x02\x03 "))
            inside = inside and "\x03" not in text
        got = main_text([page.replace("\x02", "").replace("\x03", "")], model)[0].split("\n")
        right += sum(len(t) for t in got if t in want)
        kept += sum(map(len, got))
        there += sum(map(len, want))
    assert right / kept > 0.95 and right / there > 0.95


def test_boosting_learns_an_interaction():
    x = np.random.default_rng(0).random((2000, 3))
    y = ((x[:, 0] > 0.5) != (x[:, 1] > 0.5)).astype(float)
    assert ((Booster(rounds=40).fit(x, y).logits(x) > 0) == y).mean() > 0.97
    assert len(Booster(rounds=2).fit(x, y).logits(x[:0])) == 0


def test_odd_pages(spark, sample):
    from pyspark.sql import functions as F

    rows = [(1, "u", None), (2, None, ""), (None, "u", sample[0][0]), (3, "u", "plain"), (3, "u", "plain"), (4, "u", sample[1][0])]
    df = spark.createDataFrame(rows, PAGES).withColumns({c: F.lit("clash") for c in ("text", "h", "n_chars")})
    got = extract(df).collect()
    assert sorted(str(r["page_id"]) for r in got) == ["1", "2", "3", "3", "4", "None"]
    assert all(r["n_chars"] == len(r["text"]) for r in got)
    assert all(r["text"] == "" for r in got if r["page_id"] in (1, 2))
    assert extract(spark.createDataFrame([], PAGES)).collect() == []


def test_places_among_hundreds_of_siblings():
    page = "<div>" + "".join(f"<h2>{'x' * i}</h2>" if i % 10 == 0 else f"<p>{'y' * i}</p>" for i in range(1, 301)) + "</div>"
    nodes, _ = parse(page)
    rows = np.array(features(nodes))
    kids = nodes[1].kids
    assert len(kids) == 300
    first = N_FEATURES - 13  # the number of siblings
    for i, row in enumerate(rows[[nodes.index(k) for k in kids]]):
        assert row[first] == 300 and row[first + 1] == pytest.approx(i / 300)
        assert row[first + 2] == pytest.approx(0.1 if (i + 1) % 10 == 0 else 0.9)
        assert row[first + 3] == pytest.approx(np.log1p(i))
        assert row[first + 4] == pytest.approx(np.log1p(i + 2 if i < 299 else 0))


def test_articles_and_comments_of_hundreds_of_siblings(sample, model):
    made = Layouts([t for p, in sample for t in blocks(p) if len(t) > 20], 5)
    assert max(len(n.kids) for _ in range(100) for n in parse(made.page())[0]) > 64
    for n in (70, 200, 400):
        said = "".join(f"<div class=comment><p>{made.some(3, 60)}</p></div>" for _ in range(n))
        page = f"<body><nav>{made.links(80)}</nav><div class=content><h1>Title</h1>{made.prose(n)}</div><div class=comments>{said}</div></body>"
        inner = parse(page.partition("<div class=content>")[2].partition("</div>")[0])[1]
        want, got = {t for _, t in inner}, main_text([page], model)[0].split("\n")
        right = sum(len(t) for t in got if t in want)
        assert right / sum(map(len, got)) > 0.95 and right / sum(len(t) for _, t in inner) > 0.95


def test_decoding_finds_the_optimum():
    """Against all sets of nodes in which a kept node's parent is kept."""
    import random
    from itertools import combinations

    from sluice.llm.html_extract import Node, decode

    r = random.Random(6)
    for _ in range(60):
        nodes = [Node("div", [], None)]
        for _ in range(r.randint(0, 8)):
            nodes.append(Node("p", [], r.choice(nodes)))
        # Parents come before their children, as in a page.
        logits = [r.uniform(-2, 2) for _ in nodes]
        worth = dict(zip(nodes, logits))
        best = max(sum(worth[n] for n in part) for k in range(len(nodes) + 1) for part in combinations(nodes, k)
                   if all(n.up is None or n.up in part for n in part))
        kept = decode(nodes, logits)
        assert all(n.up is None or n.up in kept for n in kept)
        assert abs(sum(worth[n] for n in kept) - best) < 1e-9
