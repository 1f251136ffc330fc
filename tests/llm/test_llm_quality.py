import zlib

import numpy as np
import pytest
from llm_cases import ODD, no_docs, odd_docs

from sluice.llm import quality
from sluice.llm.quality import fit, held_out, profile, score, trigrams

SF = "/root/testdata/sf0.1"
LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


@pytest.fixture(scope="module")
def model(tables):
    return fit(*tables)


def test_held_out_accuracy(tables, model):
    docs, labels = tables
    got = score(docs, model).select("doc_id", "score", "predicted", held_out("doc_id").alias("out")).join(labels, "doc_id").where("out").toPandas()
    assert all(zlib.crc32(str(d).encode()) % 5 == 0 for d in got["doc_id"])
    good, bad = got["score"][got["quality"] == 1].to_numpy(), got["score"][got["quality"] == 0].to_numpy()
    assert np.mean(good[:, None] > bad) + np.mean(good[:, None] == bad) / 2 > 0.98
    assert (got["predicted"] == got["quality"]).mean() > 0.98


def test_held_out_labels_are_not_learnt(tables, model):
    docs, labels = tables
    from pyspark.sql import functions as F

    other = labels.withColumn("quality", F.when(held_out("doc_id"), 1 - F.col("quality")).otherwise(F.col("quality")))
    again = fit(docs, other)
    assert np.array_equal(np.sort(again["marks"]), np.sort(model["marks"]))


def test_odd_documents(spark, model):
    got = score(odd_docs(spark, ["score", "mark", "grams"]), model)
    rows = got.collect()
    assert len(rows) == len(ODD) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)
    assert score(no_docs(spark), model).collect() == []


def test_labels_that_teach_nothing(spark):
    docs = odd_docs(spark)
    for rows in ([], [(None, 1, 0), (1, None, 0), (12345, 1, 0)]):
        model = fit(docs, spark.createDataFrame(rows, LABELS))
        assert model is None and {r["score"] for r in score(docs, model).collect()} == {0.5}
    few = fit(docs, spark.createDataFrame([(1, 1, 0), (1, 0, 0), (6, 1, 0), (3, 0, 0)], LABELS))
    assert all(0 <= r["score"] <= 1 for r in score(docs, few).collect())


def test_features_of_long_texts_do_not_depend_on_blocks(monkeypatch):
    text = (" ".join(f"w{i % 977} " for i in range(20000)) + "\n").encode() * 3
    whole = trigrams(text), profile(text)
    monkeypatch.setattr(quality, "BLOCK", 1000)
    assert np.array_equal(whole[0], trigrams(text)) and np.allclose(whole[1], profile(text), atol=1e-6)
    assert trigrams(b"").sum() == 0 and np.isfinite(profile(b"")).all() and np.isfinite(profile(b"\xff\xfe")).all()


def test_votes_match_a_plain_loop(tables, model):
    """Cosines with every point one by one, in double precision, and the nearest points' votes."""
    docs, _ = tables
    some = docs.orderBy("doc_id").limit(60)
    got = {r["doc_id"]: r["score"] for r in score(some, model).collect()}
    axes, points = model["axes"].astype(np.float64), model["points"].astype(np.float64)
    for r in some.collect():
        text = (r["text"] or "").encode()
        grams, bins = np.log1p(trigrams(text)) * model["idf"], profile(text)
        halves = [x / max(np.sqrt((x * x).sum()), 1e-12) for x in (grams, bins)]
        terms = np.concatenate(halves)
        latent = terms / np.sqrt((terms * terms).sum()) @ axes
        latent /= max(np.sqrt((latent * latent).sum()), 1e-12)
        near = sorted(((float(np.dot(latent, p)), float(m)) for p, m in zip(points, model["marks"])), reverse=True)[:25]
        weights = [max(c, 1e-3) ** 32 for c, _ in near]
        assert abs(got[r["doc_id"]] - sum(w * m for w, (_, m) in zip(weights, near)) / sum(weights)) < 1e-3


def test_repeated_labels_and_documents_teach_once(spark, tables):
    docs, labels = tables
    once = fit(docs, labels, sample=200, dims=16)
    again = fit(docs.unionByName(docs).unionByName(docs.limit(500)), labels.unionByName(labels), sample=200, dims=16)
    assert len(once["marks"]) == len(again["marks"]) == 200
    assert np.array_equal(once["marks"], again["marks"])


def test_ties_and_repeated_rows_score_alike(spark, model):
    rows = [(None, "same text here"), (1, "same text here"), (1, "same text here"), (2**63 - 1, "same text here")]
    got = score(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()
    assert len(got) == 4 and len({r["score"] for r in got}) == 1 and {r["doc_id"] for r in got} == {None, 1, 2**63 - 1}
