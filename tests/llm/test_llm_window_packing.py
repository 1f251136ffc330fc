import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import ODD, no_docs, odd_docs
from pyspark.sql import functions as F

from sluice.llm.tokens import ByteEncoder
from sluice.llm.window_packing import CapacityTree, best_fit_decreasing, pack_windows, padded_length

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def plain():
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(PATH)
    tok.encode_special_tokens = True
    return lambda text: tok.encode(text, add_special_tokens=False).ids


@pytest.fixture(scope="module")
def encoder():
    return ByteEncoder(PATH)


def ids(raw):
    return np.frombuffer(raw, "<u4").tolist()


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("aAbBzZ'st.,!?09  \n\t\r\x1c\x1f\x85\xa0  éÉßİJ̌́ǰ漢😀<|>endoftx\x01"), max_size=80))
def test_texts_encode_as_the_file_says(plain, encoder, text):
    assert encoder.fast is not None
    assert ids(encoder.encode([text])[0]) == plain(text)


@pytest.mark.parametrize("whole", [7, 20])
def test_cut_texts_encode_alike(plain, whole):
    class Short(ByteEncoder):
        WHOLE = whole

    texts = ["one two  three\n four \n\n five", "x" * 50 + " y", " " * 40 + "a", "a" + "  " * 20 + "b c d e f", "ab cd\x1c ef  gh  ij" * 5, ""]
    assert [ids(b) for b in Short(PATH).encode(texts)] == [plain(t) for t in texts]


def one_by_one(pieces, window):
    """How full the windows of best-fit decreasing are, piece by piece (ties between equally full ones leave this as it is)."""
    windows = []
    for n in sorted(pieces, reverse=True):
        fit = min((w for w in windows if window - sum(w) >= n), key=lambda w: window - sum(w), default=None)
        windows.append([n]) if fit is None else fit.append(n)
    return Counter(map(sum, windows))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 30), max_size=80), st.integers(30, 45))
def test_plan_is_best_fit_decreasing(pieces, window):
    counts, got = Counter(pieces), defaultdict(list)
    plan = best_fit_decreasing(counts, window)
    for length, n in counts.items():
        own = sorted(e for e in plan if e[0] == length)
        for rank in range(n):
            _, lo, per, first, offset = [e for e in own if e[1] <= rank][-1]
            got[first + (rank - lo) // per].append((offset + (rank - lo) % per * length, length))
    for spans in got.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= window
    assert Counter(sum(n for _, n in w) for w in got.values()) == one_by_one(pieces, window)
    assert sorted(got) == list(range(len(got)))


@given(st.lists(st.tuples(st.integers(0, 20), st.integers(1, 3)), max_size=30))
def test_tree_finds_the_tightest(windows):
    tree = CapacityTree(20)
    for k, (capacity, n) in enumerate(windows):
        tree.put(capacity, 10 * k, n)
    for length in range(1, 21):
        assert tree.tightest(length) == min((c for c, _ in windows if c >= length), default=None)


def check(rows, window):
    seqs = defaultdict(list)
    for r in rows:
        seqs[r["sequence_id"]].append((r["offset"], r["length"]))
    for spans in seqs.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at and length > 0
            at += length
        assert at <= window
    return len(seqs)


@pytest.mark.parametrize("window", [1024, 64])
def test_odd_documents(spark, plain, window):
    rows = pack_windows(odd_docs(spark, ["length", "_part", "sequence_id", "offset", "_rank"]), PATH, window).collect()
    check(rows, window)
    want = Counter()
    for doc, text, *_ in ODD:
        tokens = [*plain(text or ""), 0]
        for a in range(0, len(tokens), window):
            part = tokens[a:a + window]
            want[doc, a, len(part), zlib.crc32(np.array(part, "<u4").tobytes()), len(tokens)] += 1
    assert Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in rows) == want


def test_largest_id_text_ids_and_null_ids(spark):
    docs = spark.createDataFrame([(2**63 - 1, "a b"), (-2**63, "c"), (None, "d"), (2**53 + 1, None)], "doc_id long, text string")
    rows = pack_windows(docs, PATH, keep_ids=True).collect()
    assert {r["doc_id"] for r in rows} == {2**63 - 1, -2**63, None, 2**53 + 1}
    assert all(r["ids"][-1] == 0 and len(r["ids"]) == r["length"] for r in rows)
    named = docs.select(F.concat(F.lit("n"), "doc_id").alias("doc_id"), "text")
    assert {r["doc_id"] for r in pack_windows(named, PATH).collect()} == {f"n{2**63 - 1}", f"n{-2**63}", f"n{2**53 + 1}", None}


def test_empty_table(spark):
    assert pack_windows(no_docs(spark), PATH).collect() == []


def test_hot_length_over_many_tasks(spark):
    docs = spark.range(3000, numPartitions=16).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "a b c").otherwise(
        F.repeat(F.lit("w "), (F.col("id") % 50).cast("int"))).alias("text"))
    rows = pack_windows(docs, PATH, 64).collect()
    assert len({r["doc_id"] for r in rows}) == 3000
    assert check(rows, 64) <= sum(r["length"] for r in rows) / 64 * 1.01 + 1


def test_padded_length(spark):
    got = spark.range(1, 9).select(padded_length(F.col("id"), 7).alias("n")).collect()
    assert [r["n"] for r in got] == [1, 2, 7, 4, 7, 7, 7, 8]
