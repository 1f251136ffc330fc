import math
import re
from collections import Counter

import numpy as np
import pytest
from llm_cases import COPY, ODD, no_docs, odd_docs
from pyspark.sql import functions as F

from sluice.llm import lexical_search
from sluice.llm.lexical_search import blocks_of, rows_of, search, search_shard, terms_of

ITEMS = "item_id long, text string"
BENCH = [
    (1, COPY), (2, "brown fox"), (3, None), (4, ""), (5, "!!! ---"), (6, "the the the the"), (7, "Six, AND more words!"),
    (None, "lazy dog again"), (2, "lazy dog again"), (8, COPY), (8, COPY), (9, "w0 w7919 w5831 é"), (10, "nowhere_at_all")]


def terms(text):
    low = re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode())
    return re.findall(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def brute(docs, bench, limit=10):
    """Scores straight from the definition; per item the sorted (score, id) of its best documents."""
    bags = [(d, Counter(terms(t))) for d, t in docs]
    bags = [(d, b, sum(b.values())) for d, b in bags if b]
    total, words = len(bags), sum(n for _, _, n in bags)
    df = Counter(t for _, b, _ in bags for t in b)
    out = Counter()
    for item, text in set(bench):
        found = []
        for doc, bag, n in bags:
            m = 100 - 90 + (90 * n * total) // words
            score = sum(math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * ((1000000000 * bag[t]) // (1000 * bag[t] + 8 * m))
                        for t in set(terms(text)) if t in bag)
            if score > 0:
                found.append((-score, doc is None, doc))
        found.sort(key=lambda x: (x[0], x[1], x[2] or 0))
        out.update((item, k, doc, -score) for k, (score, _, doc) in enumerate(found[:limit], 1))
    return out


def rows(df):
    return Counter((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in df.collect())


def test_terms():
    text = "The ÉTÉ's 3rd_a\x1cb\x7fç\n@`[{~ 漢字"
    assert terms_of(text.encode()) == terms(text)
    assert terms_of(None) == []


@pytest.mark.parametrize("limit", [1, 3, 10])
def test_odd_documents(spark, limit):
    df = odd_docs(spark, ["term", "item", "score", "rank", "n", "terms"])
    bench = spark.createDataFrame(BENCH, ITEMS).withColumns({"term": F.lit(1), "doc_id": F.lit(2)})
    assert rows(search(df, bench, limit)) == brute([(d, t) for d, t, *_ in ODD], BENCH, limit)


def made(n):
    """Documents of frequent and rare words, a third of them copies of one, with ties."""
    rng = np.random.default_rng(5)
    docs = []
    for i in range(n):
        if i % 3 == 0:
            docs.append((i, "the copy that " + " ".join(f"w{k}" for k in range(40))))
        else:
            docs.append((i, " ".join(f"w{int(x)}" for x in rng.zipf(1.3, 5 + i % 60) if x < 3000)))
    return docs


def test_many_documents_in_several_shards_and_item_blocks(spark, monkeypatch):
    docs = made(3000)
    bench = [(k, " ".join(f"w{(k * 13 + j * j) % 700}" for j in range(12))) for k in range(40)] + [(99, "the"), (98, "w1 w2 w3")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    want = brute(docs, bench)
    assert rows(search(df, spark.createDataFrame(bench, ITEMS))) == want
    monkeypatch.setattr(lexical_search, "BLOCK_WORDS", 60)
    assert rows(search(df, spark.createDataFrame(bench, ITEMS))) == want


def test_null_and_large_ids_and_text_ids(spark):
    docs = [(2**63 - 1, "a b"), (None, "a b"), (-2**63, "a b"), (None, "a b"), (5, "c c")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert rows(search(df, spark.createDataFrame([(1, "a")], ITEMS))) == brute(docs, [(1, "a")])
    named = search(df.withColumn("doc_id", F.concat(F.lit("d"), "doc_id")), spark.createDataFrame([("x", "C")], "item_id string, text string"))
    assert [tuple(r)[:3] for r in named.collect()] == [("x", 1, "d5")]


@pytest.mark.parametrize("empty", ["docs", "items", "both"])
def test_empty_tables(spark, empty):
    docs = odd_docs(spark) if empty == "items" else no_docs(spark)
    items = spark.createDataFrame(BENCH if empty == "docs" else [], ITEMS)
    out = search(docs, items)
    assert out.collect() == [] and out.columns == ["item_id", "rank", "doc_id", "score"]


def test_texts_without_terms(spark):
    docs = spark.createDataFrame([(1, "!"), (2, None)], "doc_id long, text string")
    assert search(docs, spark.createDataFrame([(1, "a")], ITEMS)).collect() == []


def test_blocks_bound_their_documents_and_are_skipped():
    rng = np.random.default_rng(1)
    lists = [np.unique(np.append(np.minimum(rng.zipf(1.4, 30), 199), 50 * (d % 4))) for d in range(1000)]
    ends = np.cumsum([len(x) for x in lists])
    flat = np.concatenate(lists)
    impacts = rng.integers(1, 1000, len(flat)) * 1000
    items = [np.unique(rng.integers(1, 200, 8)) for _ in range(30)]
    related = {}
    for x in items:
        for t in x.tolist():
            related.setdefault(t, []).append(x)
    related = {t: np.unique(np.concatenate(x)) for t, x in related.items()}
    shard = [ends, flat, impacts, *blocks_of(ends, flat, impacts, related)]
    block_term, block_end, block_doc, top_end, top_term, top_impact = shard[3:]
    own = [dict(zip(flat[a:z].tolist(), impacts[a:z].tolist())) for a, z in zip(np.append(0, ends[:-1]), ends)]
    for k, t in enumerate(block_term.tolist()):
        docs = block_doc[rows_of(block_end, np.array([k]))[0]]
        at = rows_of(top_end, np.array([k]))[0]
        assert 0 < len(docs) <= lexical_search.BLOCK_DOCS and all(t in own[d] for d in docs)
        want = {c: max(own[d].get(c, 0) for d in docs) for c in related[t].tolist()}
        assert dict(zip(top_term[at].tolist(), top_impact[at].tolist())) == {c: v for c, v in want.items() if v}
    for t in related:
        held = [d for d in range(1000) if t in own[d]]
        blocks = np.flatnonzero(block_term == t)
        assert sorted(block_doc[rows_of(block_end, blocks)[0]].tolist()) == held
    weights, skipped = np.zeros(200, np.int64), 0
    for x in items:
        weights[x] = rng.integers(1, 50, len(x))
        full = {d: sum(int(weights[t]) * v for t, v in own[d].items()) for d in range(1000)}
        least = sorted(full.values())[-10]
        docs, got, seen, read = search_shard(shard, x, x, weights, least)
        assert dict(zip(docs.tolist(), got.tolist())) == {d: s for d, s in full.items() if s >= least and s > 0}
        skipped += seen - read
        weights[x] = 0
    assert skipped > 0
