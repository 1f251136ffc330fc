"""A corpus pipeline over ``documents``: quality, near copies, repeats, benchmark passages, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is
written as Parquet and read again as the next stage's ``docs``; all but the last
return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm.common import Scratch, id_key, read, text_hash
from sluice.llm.decontaminate import find_contamination
from sluice.llm.packing import pack_documents
from sluice.llm.quality import fit, score
from sluice.llm.simhash import near_duplicates
from sluice.llm.suffix_dedup import without_repeats

BROADCAST_KEYS = 500_000
"""Keys of documents to drop that may be sent to all executors; more are joined by a shuffle."""


def _without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """``docs`` but for the rows whose id and text hash are in ``dropped(_id, _th)``."""
    dropped = Scratch(docs.sparkSession, "dropped").keep(dropped.distinct(), "keys")
    side = F.broadcast(dropped) if dropped.count() <= BROADCAST_KEYS else dropped
    keyed = docs.withColumns({"_id": id_key("doc_id"), "_th": text_hash("text")})
    return keyed.join(side, ["_id", "_th"], "left_anti").select(*docs.columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier takes for good ones; a null text is scored as an empty one."""
    return score(docs, fit(docs, read(spark, sf_dir, "labels"))).where("predicted = 1").select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id (null last, then by text hash); repeated rows leave one."""
    found = Scratch(spark, "near-copies").keep(near_duplicates(docs, max_bits=4, words=4, seed=42), "components")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "_th")
    rows = found.select("doc_id", id_key("doc_id").alias("_id"), F.col("text_hash").alias("_th"), "component")
    first = rows.groupBy("component").agg(F.min_by(F.struct("_id", "_th"), order).alias("first"))
    dropped = rows.join(first, "component").where(F.struct("_id", "_th") != F.col("first")).select("_id", "_th")
    out = _without(docs, dropped)
    if found.groupBy("doc_id", "text_hash").count().where("count > 1").isEmpty():
        return out
    keyed = out.withColumns({"_id": id_key("doc_id"), "_th": text_hash("text")})
    return keyed.dropDuplicates(["_id", "_th"]).select(*docs.columns)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the 100-byte strings that start earlier in the corpus; ``n_chars`` follows the text."""
    out = without_repeats(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.char_length("text")).cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of 10 words of a benchmark item (or a shorter item as a whole)."""
    found = find_contamination(docs, read(spark, sf_dir, "benchmark"), window=10)
    return _without(docs, found.where("contaminated").select(id_key("doc_id").alias("_id"), F.col("text_hash").alias("_th")))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents in sequences of at most 2048 tokens."""
    import public_tokenizers

    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality", quality),
    ("near_copies", near_copies),
    ("repeats", repeats),
    ("benchmark_passages", benchmark_passages),
    ("packing", packing),
]

ORACLE_SQL = None
"""Tokenizers, SimHash and a trained classifier are beyond SQL; tests hold the stages against brute force."""


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of what the stages keep of ``documents``."""
    tmp = Scratch(spark, "pipeline")
    docs, before = read(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        kept = tmp.keep(stage(spark, docs, sf_dir), name)
        if before is not None:
            tmp.drop(before)
        docs = before = kept
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
SQL: dict[str, str] = {}
