import hashlib
import re
from collections import Counter

import pytest
from llm_cases import COPY, ODD, no_docs, odd_docs

from sluice.llm import decontaminate
from sluice.llm.decontaminate import find_contamination, items_digest

ITEMS = "item_id long, text string"
BENCH = [
    (1, COPY), (2, "brown fox"), (3, None), (4, ""), (5, "!!! ---"), (6, "the the the the the the the the the the the the"),
    (7, "Six, AND more words!"), (None, "lazy dog again"), (2, "lazy dog again"), (8, COPY), (9, "w0 w7919 w5831"), (10, "never seen anywhere else at all")]


def words(text):
    low = re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode())
    return re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(text, bench, window=10):
    w, hit, items = words(text), set(), set()
    for item, t in bench:
        b = words(t)
        n = min(window, len(b))
        for a in range(len(b) - n + 1 if n else 0):
            for s in range(len(w) - n + 1):
                if w[s:s + n] == b[a:a + n]:
                    hit.update(range(s, s + n))
                    items.add(item)
    return len(w), len(hit), len(items), bool(hit)


def rows(df):
    return Counter((r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], r["contaminated"]) for r in df.collect())


def test_odd_documents(spark):
    docs = [(d, t) for d, t, *_ in ODD if not t or len(t) < 5000]
    from pyspark.sql import functions as F

    df = odd_docs(spark, ["term", "places", "q", "item"]).where("text is null or length(text) < 5000")
    bench = spark.createDataFrame(BENCH, ITEMS).withColumns({"term": F.lit(1), "doc_id": F.lit(2)})
    assert rows(find_contamination(df, bench)) == Counter((d, *brute(t, BENCH)) for d, t in docs)


def test_long_document_and_digest(spark):
    got = find_contamination(odd_docs(spark).where("doc_id = 8"), spark.createDataFrame(BENCH, ITEMS))
    r = got.select("n_items", "spans", items_digest().alias("d")).first()
    assert r["n_items"] == 1 and r["spans"][:2] == [0, 3] and r["d"] == hashlib.sha256(b"9").hexdigest()


def test_digest_sorts_ids_as_text(spark):
    bench = spark.createDataFrame([(10, "a b"), (9, "a b"), (100, "a b")], ITEMS)
    got = find_contamination(spark.createDataFrame([(1, "x a b y")], "doc_id long, text string"), bench)
    assert got.select(items_digest()).first()[0] == hashlib.sha256(b"10,100,9").hexdigest()


@pytest.mark.parametrize("empty", ["docs", "benchmark"])
def test_empty_tables(spark, empty):
    docs = no_docs(spark) if empty == "docs" else odd_docs(spark)
    bench = spark.createDataFrame([] if empty == "benchmark" else BENCH, ITEMS)
    got = find_contamination(docs, bench).collect()
    assert len(got) == (0 if empty == "docs" else len(ODD)) and not any(r["contaminated"] for r in got)


def test_blocks_of_items_and_shuffled_places_give_the_same(spark, monkeypatch):
    docs = [(d, t) for d, t, *_ in ODD if not t or len(t) < 5000]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 20)
    monkeypatch.setattr(decontaminate, "BROADCAST_PLACES", 0)
    assert rows(find_contamination(df, spark.createDataFrame(BENCH, ITEMS))) == Counter((d, *brute(t, BENCH)) for d, t in docs)


def test_proximity(spark):
    docs = [(1, "one x two three y four"), (2, "four three two one"), (3, "one two x x x x x three four"), (4, "one two three")]
    bench = spark.createDataFrame([(1, "one two three four")], ITEMS)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r["doc_id"]: (r["contaminated"], r["spans"]) for r in find_contamination(df, bench, slop=2).collect()}
    assert got == {1: (True, [0, 6]), 2: (True, [0, 4]), 3: (False, []), 4: (False, [])}
