import hashlib
import random

from llm_cases import ODD, no_docs, odd_docs
from xxhash import xxh64_intdigest

from sluice.llm import suffix_dedup
from sluice.llm.suffix_dedup import remove_repeats, without_repeats


def brute(docs):
    """Results by (doc_id, text) for distinct documents in their order."""
    def order(d):
        h = xxh64_intdigest((d[1] or "").encode(), 42)
        return (d[0] is None, d[0] or 0, h - (1 << 64) if h >> 63 else h)

    seen, out = set(), {}
    for doc, text in sorted(set(docs), key=order):
        b = (text or "").encode()
        covered = bytearray(len(b))
        for s in range(len(b) - 99):
            w = b[s:s + 100]
            if w in seen:
                covered[s:s + 100] = b"\1" * 100
            seen.add(w)
        kept = bytes(x for x, c in zip(b, covered) if not c)
        runs = sum(c and not (k and covered[k - 1]) for k, c in enumerate(covered))
        out[doc, text or ""] = (len(b), sum(covered), runs, hashlib.sha256(kept).hexdigest())
    return out


def check(spark, docs):
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = remove_repeats(df).collect()
    want = brute([(d, t) for d, t in docs])
    assert sorted((str(r["doc_id"]), *r[1:5]) for r in got) == sorted((str(d), *want[d, t or ""]) for d, t in docs)


def test_odd_documents(spark):
    check(spark, [(d, t) for d, t, *_ in ODD])


def test_unique_ids_and_many_shared_passages(spark):
    r = random.Random(5)
    pool = ["".join(r.choice("abcdef ") for _ in range(r.randint(60, 400))) for _ in range(12)]
    docs = [(i, "".join(r.choice(pool)[r.randint(0, 40):] if r.random() < 0.7 else "".join(r.choice("xyz ") for _ in range(50))
                        for _ in range(r.randint(0, 6)))) for i in range(120)]
    check(spark, docs)


def test_repeats_inside_one_document_and_over_chunks(spark):
    r = random.Random(6)
    a = "".join(r.choice("abcdefgh ") for _ in range(70_000))
    check(spark, [(1, "ab" * 300), (2, "z" * 1000), (3, a), (4, a[500:69_000] + a[:66_000])])


def test_empty_table(spark):
    assert remove_repeats(no_docs(spark)).collect() == []


def test_small_batches_give_the_same(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        check(spark, [(i, "x y " * (20 + i % 3) + "shared tail " * 12) for i in range(40)])
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_other_columns_stay(spark):
    docs = odd_docs(spark, ["id", "spans", "kept", "bucket"])
    got = without_repeats(docs)
    assert got.columns == docs.columns
    want = brute([(d, t) for d, t, *_ in ODD])
    for r in got.collect():
        assert r["id"] == r["spans"] == "clash"
        if r["text"] is not None and r["doc_id"] not in (7, None):
            text = next(t for d, t, *_ in ODD if d == r["doc_id"])
            assert hashlib.sha256(r["text"].encode()).hexdigest() == want[r["doc_id"], text][3]


def test_refinement_holds_one_entry_over_batches():
    import pandas as pd

    def frame(rows):
        return pd.DataFrame(rows, columns=["bucket", "sig", "loc", "ext", "kind"])

    rows = [(1, 5, 10, 0, 0), (1, 5, 11, 0, 0), (1, 6, 12, 0, 0), (2, 5, 13, 0, 0), (3, 1, 14, 0, 0), (3, 1, 15, 0, 0), (9, 9, 99, 4, 1)]
    whole = pd.concat(suffix_dedup._refine([frame(rows)])).sort_values("loc").values.tolist()
    split = pd.concat(suffix_dedup._refine(frame([r]) for r in rows)).sort_values("loc").values.tolist()
    assert whole == split == [[10, 0, 2], [11, 0, 1], [12, 0, 2], [15, 0, 1], [99, 4, 1]]


def test_places_beyond_the_least_bits(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "AT_BITS", 8)
    r = random.Random(8)
    a = "".join(r.choice("abcdefgh ") for _ in range(3000))
    check(spark, [(1, a), (2, "x" * 50 + a[1500:2500]), (3, a[200:900] + "z" * 700), (1000, a[2000:])])
    # Ids that do not fit beside the longest text get names.
    monkeypatch.setattr(suffix_dedup, "LOC_BITS", 20, raising=False)
    check(spark, [(1, a), (2, "x" * 50 + a[1500:2500]), (300, a[200:900] + "z" * 700), (1000, a[2000:])])
