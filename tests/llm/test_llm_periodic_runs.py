import hashlib
import re
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import ODD, no_docs, odd_docs
from pyspark.sql import functions as F

from sluice.llm.periodic_runs import periodic_runs, runs_digest, runs_of, strongest_run, with_planted_runs
from sluice.llm.queries import op11_periodic_runs


def brute(words, repeats=4, least=6):
    """Every stretch and every period, straight from the definition."""
    n, out = len(words), []
    for q in range(1, n + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            part = words[i:i + length]
            smaller = any(all(part[k] == part[k + p] for k in range(length - p)) for p in range(1, q))
            if length >= max(least, repeats * q) and not smaller:
                out.append((i, length, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def split(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())


def collapse(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return b" ".join(w for i, w in enumerate(words) if i not in gone)


periodic = st.builds(lambda head, unit, times, cut, tail: head + (unit * times)[:max(0, len(unit) * times - cut)] + tail,
                     st.lists(st.integers(0, 5), max_size=6), st.lists(st.integers(0, 3), min_size=1, max_size=7),
                     st.integers(1, 9), st.integers(0, 5), st.lists(st.integers(0, 5), max_size=6))


@settings(max_examples=600, deadline=None)
@given(st.one_of(st.lists(st.integers(0, 2), max_size=60), st.lists(periodic, max_size=4).map(lambda x: sum(x, []))))
def test_runs_match_brute_force(words):
    assert runs_of(words) == brute(words)


@pytest.mark.parametrize("repeats, least", [(3, 1), (3, 9), (5, 6)])
@settings(max_examples=150, deadline=None)
@given(words=st.lists(periodic, max_size=3).map(lambda x: sum(x, [])))
def test_other_bounds(repeats, least, words):
    assert runs_of(words, repeats, least) == brute(words, repeats, least)


def test_runs_inside_runs():
    unit = [1] * 8 + [2, 3] * 4 + [9]
    assert runs_of(unit * 5) == brute(unit * 5)
    assert {q for _, _, q in runs_of(unit * 5)} == {1, 2, len(unit)}


def test_chain_of_splits():
    # Each word is one short of qualifying once the word before it has split the segment.
    words = sum(([k, k, k, k + 1] for k in range(0, 3000)), []) + [7, 8] * 20
    assert runs_of(words) == [(12000, 40, 2)]


def test_long_texts():
    x = [i * 7919 % 10007 for i in range(10007)] * 15 + [0]
    assert runs_of(x) == [(0, 150106, 10007)]
    assert runs_of([1] * 300000) == [(0, 300000, 1)]
    a, b = [0], [0, 1]
    while len(b) < 900:
        a, b = b, b + a
    assert runs_of(b, 3, 1) == brute(b, 3, 1) != []


def test_odd_documents(spark):
    df = odd_docs(spark, ["runs", "words", "_g", "_w", "_a", "_p", "collapsed"])
    short = df.where("text is null or length(text) < 5000")
    got = Counter((r["doc_id"], r["n_words"], tuple(map(tuple, r["runs"])), r["collapsed"]) for r in periodic_runs(short).collect())
    want = Counter()
    for doc, text, *_ in ODD:
        if not text or len(text) < 5000:
            w = split(text)
            runs = brute(w)
            want[doc, len(w), tuple(runs), collapse(w, runs).decode()] += 1
    assert got == want
    long = periodic_runs(df.where("doc_id in (8, 9)")).collect()
    assert {(r["doc_id"], r["n_words"]) for r in long} == {(8, 30000), (9, 30001)}
    with pytest.raises(ValueError):
        periodic_runs(df, repeats=2)


def test_empty_table_and_odd_ids(spark):
    assert periodic_runs(no_docs(spark)).collect() == []
    docs = spark.createDataFrame([(2**63 - 1, "a " * 7), (None, "b"), (2**63 - 1, "a " * 7)], "doc_id long, text string")
    got = periodic_runs(docs).collect()
    assert Counter(r["doc_id"] for r in got) == {2**63 - 1: 2, None: 1}
    assert [r["collapsed"] for r in got if r["doc_id"]] == ["a", "a"]


def test_strongest_run_and_digest(spark):
    df = spark.createDataFrame([([(0, 9, 2), (3, 18, 4), (30, 9, 2), (50, 12, 3)],), ([],), ([(0, 6, 1), (9, 12, 2)],)],
                               "runs array<struct<start:long,length:long,period:long>>")
    rows = df.select(strongest_run("runs").alias("best"), runs_digest("runs").alias("d")).collect()
    assert [r["best"] and tuple(r["best"]) for r in rows] == [(0, 9, 2), None, (0, 6, 1)]
    assert rows[0]["d"] == hashlib.sha256(b"0,9,2\n3,18,4\n30,9,2\n50,12,3\n").hexdigest()
    assert rows[1]["d"] == hashlib.sha256(b"").hexdigest()


def planted(doc, text):
    words = split(text)
    n, h = len(words), zlib.crc32(str(doc).encode())
    if doc is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    return words


def test_query_on_a_small_table(spark, scratch):
    docs = [(i, " ".join(str((i * k) % (3 + i % 11)) for k in range(i % 90))) for i in range(200)] + [(None, None), (500, None), (-7, " \t x \x1c y\xa0z "), (2**63 - 1, "a " * 40)]
    spark.createDataFrame(docs, "doc_id long, text string").withColumn("_g", F.lit(1)).write.parquet(f"{scratch}/documents.parquet")
    got = {r["doc_id"]: r for r in op11_periodic_runs(spark, scratch).collect()}
    assert len(got) == len(docs)
    seen = 0
    for doc, text in docs:
        words, r = planted(doc, text), got[doc]
        seen += words != split(text)
        runs = brute(words)
        assert r["n_runs"] == len(runs)
        best = min(runs, key=lambda x: (-x[1] / x[2], x[0], x[2]), default=(None,) * 3)
        assert (r["start"], r["length"], r["period"]) == best
        assert r["exponent_milli"] == (1000 * best[1] // best[2] if runs else None)
        assert r["runs_sha256"] == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(collapse(words, runs)).hexdigest()
    assert seen > 10


def test_planted_runs_leave_the_others_alone(spark):
    hit = next(d for d in range(1000) if zlib.crc32(str(d).encode()) % 10 == 0)
    docs = [(None, "a  b"), (hit, None), (hit, " \n "), (hit, "a  b\tc d e f g h"), (hit + 1 if zlib.crc32(str(hit + 1).encode()) % 10 else hit + 2, "x  y")]
    got = with_planted_runs(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert [r["text"] for r in got[:3]] == ["a  b", None, " \n "] and got[4]["text"] == "x  y"
    assert got[3]["text"].encode().split() == planted(hit, docs[3][1]) != [b"a", b"b", b"c", b"d", b"e", b"f", b"g", b"h"]
