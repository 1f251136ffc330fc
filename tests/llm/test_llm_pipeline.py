import hashlib
import re
import zlib

import numpy as np
import pytest
from llm_cases import ODD, no_docs, odd_docs

import corpus_pipeline
from sluice.llm.common import Scratch

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    """Each stage's rows, with the documents first."""
    docs, out, tmp = spark.read.parquet(f"{SF}/documents.parquet"), [], Scratch(spark, "test")
    out.append(docs)
    for name, stage in corpus_pipeline.STAGES:
        out.append(tmp.keep(stage(spark, out[-1], SF), name))
    return out


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.select("doc_id", "text").collect()}


def test_columns_and_growth(stages):
    for df in stages[1:-1]:
        assert df.schema.names == stages[0].schema.names
    counts = [df.count() for df in stages[:-1]]
    assert counts == sorted(counts, reverse=True) and counts[2] == counts[3]


def test_quality_keeps_clean_documents(spark, stages):
    marks = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = texts(stages[1]).keys()
    good = [d in kept for d, q in marks.items() if q == 1]
    bad = [d in kept for d, q in marks.items() if q == 0]
    assert np.mean(good) > 0.98 and np.mean(bad) < 0.1


def test_one_of_each_group_of_near_copies(stages):
    from test_llm_simhash import classes, fingerprint

    before, after = texts(stages[1]), texts(stages[2])
    prints = {d: fingerprint(t) for d, t in before.items()}
    of = classes(set(prints.values()))
    first = {}
    for d in sorted(prints):
        first.setdefault(of[prints[d]], d)
    assert set(after) == set(first.values())
    assert all(after[d] == before[d] for d in after)


def test_repeats_are_gone(stages):
    from test_llm_suffix_dedup import brute

    before = texts(stages[2])
    want = brute(list(before.items()))
    for r in stages[3].collect():
        b = want[r["doc_id"], before[r["doc_id"]]]
        if hashlib.sha256(r["text"].encode()).hexdigest() != b[3]:  # characters cut in the middle go
            assert len(r["text"].encode()) <= b[0] - b[1] < len(r["text"].encode()) + 8 * b[2]
        assert r["n_chars"] == len(r["text"])


def test_benchmark_passages_are_gone(spark, stages):
    from test_llm_decontamination import words

    windows = set()
    for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect():
        w = words(r["text"])
        n = min(10, len(w))
        windows |= {tuple(w[i:i + n]) for i in range(len(w) - n + 1 if n else 0)}
    sizes = {len(w) for w in windows}

    def dirty(text):
        w = words(text)
        return any(tuple(w[i:i + n]) in windows for n in sizes for i in range(len(w) - n + 1))

    before, after = texts(stages[3]), texts(stages[4])
    assert set(after) == {d for d, t in before.items() if not dirty(t)}


def test_packing_holds_all_that_is_kept(stages):
    import public_tokenizers
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    tok.encode_special_tokens = True
    got = {(r["doc_id"], r["piece"]): r["ids_crc32"] for r in stages[5].collect()}
    want = {}
    for d, t in texts(stages[4]).items():
        ids = [*tok.encode(t, add_special_tokens=False).ids, 0]
        want |= {(d, k // 2048): zlib.crc32(np.array(ids[k:k + 2048], "<u4").tobytes()) for k in range(0, len(ids), 2048)}
    assert got == want


def test_run_gives_the_last_stage(spark, stages):
    got = corpus_pipeline.run(spark, SF)
    assert sorted(got.select("doc_id", "piece", "ids_crc32").collect()) == sorted(stages[-1].select("doc_id", "piece", "ids_crc32").collect())


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_odd_documents(spark, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    docs = Scratch(spark, "odd").keep(odd_docs(spark, ["fp", "score", "length", "places"]), "docs")
    got = stage(spark, docs, SF).collect()
    assert got and {r["doc_id"] for r in got} <= {d for d, *_ in ODD}
    if name == "near_copies":
        assert len({(r["doc_id"], r["text"]) for r in got}) == len(got)
        assert sum(not re.search(r"\S", r["text"] or "") for r in got) == 1
    if name in ("repeats", "packing"):
        assert len(got) >= docs.count()
    empty = Scratch(spark, "odd").keep(no_docs(spark), "none")
    assert stage(spark, empty, SF).collect() == []
