"""Quality scores by nearest-neighbour voting in a latent semantic space.

A document's terms are its hashed byte trigrams (whole text, weighted by log
frequency and by document frequencies counted over all documents) and profile
terms, which tell in soft bins how much it repeats words and lines, shouts,
uses digits, symbols and punctuation, and how long its words are.  A truncated
singular value decomposition of a bounded sample of labelled documents gives
the latent space.  The sample's vectors go to all tasks; every document's
cosine with each of them is computed exactly, in blocks, and the labels of the
nearest vote with weights that grow with similarity.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructType

from sluice.llm.common import small_batches, small_frame, tidy

TERM_BITS = 12
TERMS = 1 << TERM_BITS
BINS = 6
BLOCK = 1 << 20
CLASSES = [0 if b <= 32 else 3 if 48 <= b <= 57 else 2 if 65 <= b <= 90 else 1 if 97 <= b <= 122
           else 4 if chr(b) in ".,;:'\"()-?" else 5 if b < 128 else 6 for b in range(256)]
"""Kind of a byte: space, lower case, upper case, digit, punctuation, symbol, other."""


def _blocks(text: bytes):
    """Pieces of at most about a megabyte, cut after white space where there is any."""
    a = 0
    while a < len(text):
        b = a + BLOCK
        if b < len(text):
            cut = max(text.rfind(b" ", a, b), text.rfind(b"\n", a, b))
            b = cut + 1 if cut >= a else b
        yield text[a:b]
        a = b


def trigrams(text: bytes):
    """Counts of a whole text's byte trigrams by hash."""
    import numpy as np

    grams = np.zeros(TERMS, np.int64)
    for a in range(0, len(text), BLOCK):
        x = np.frombuffer(text[a:a + BLOCK + 2], np.uint8).astype(np.uint32)
        if len(x) >= 3:
            h = ((x[:-2] * np.uint32(0x9E3779B1)) ^ (x[1:-1] * np.uint32(0x85EBCA6B) + np.uint32(0x27D4EB2F)) * np.uint32(3)) + x[2:] * np.uint32(0xC2B2AE35)
            h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
            grams += np.bincount(h >> np.uint32(32 - TERM_BITS), minlength=TERMS)
    return grams


def profile(text: bytes):
    """Profile terms of a whole text: for each share six soft bins."""
    import numpy as np

    m = np.uint64(0x9E3779B97F4A7C15)
    kind = np.array(CLASSES, np.int64)
    kinds, words = np.zeros(7, np.int64), []
    for own in _blocks(text):
        b = np.frombuffer(own, np.uint8)
        k = kind[b]
        kinds += np.bincount(k, minlength=7)
        gap = k == 0
        start = np.flatnonzero(~gap & np.concatenate(([True], gap[:-1])))
        if len(start):
            at = np.arange(len(b)) - np.concatenate((np.zeros(start[0], np.int64), np.repeat(start, np.diff(np.append(start, len(b))))))
            v = (b.astype(np.uint64) + np.uint64(1)) * (at.astype(np.uint64) * m + np.uint64(12345))
            v ^= v >> np.uint64(29)
            v *= m
            v[gap] = 0
            words.append(np.add.reduceat(v, start))
    n = max(1, len(text))
    words = np.concatenate(words) if words else np.zeros(0, np.uint64)
    letters = max(1, kinds[1] + kinds[2] + kinds[6])
    lines = text.split(b"\n")
    share = np.array([
        (words[1:] == words[:-1]).mean() if len(words) > 1 else 0,
        1 - len(np.unique(words)) / len(words) if len(words) > 20 else 0,
        kinds[2] / letters, kinds[3] / n, 3 * kinds[4] / n, 4 * kinds[5] / n, kinds[6] / n,
        letters / max(1, len(words)) / 12, 1 - len(set(lines)) / len(lines), np.log1p(len(words)) / 10])
    share = np.sqrt(np.clip(share, 0, 1))
    bins = np.maximum(0, 1 - np.abs(share[:, None] - np.linspace(0, 1, BINS)) * (BINS - 1))
    return bins.ravel()


def _unit(m):
    import numpy as np

    return m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-12)


def _vectors(grams, bins, idf):
    """Term vectors: trigrams and profiles, each half scaled to length 1."""
    import numpy as np

    return _unit(np.hstack([_unit(np.log1p(grams) * idf), _unit(bins)]).astype(np.float32))


def document_frequencies(texts: DataFrame) -> tuple[int, list[int]]:
    """Number of documents, and of those with each trigram term, over all of ``texts``."""
    def count(frames):
        import numpy as np
        import pandas as pd

        df, n = np.zeros(TERMS, np.int64), 0
        for pdf in frames:
            for t in pdf["text"]:
                df += trigrams(t) > 0
                n += 1
        yield pd.DataFrame({"term": range(-1, TERMS), "df": [n, *df]})

    rows = texts.mapInPandas(tidy(count), "term int, df long").groupBy("term").agg(F.sum("df").alias("df")).collect()
    got = {r["term"]: r["df"] for r in rows}
    return got.get(-1, 0), [got.get(t, 0) for t in range(TERMS)]


def fit(docs: DataFrame, labels: DataFrame, sample: int = 4096, dims: int = 64, doc_col: str = "doc_id",
        text_col: str = "text", label_col: str = "quality") -> dict | None:
    """The voters: ``idf``, ``axes`` (terms by dims), ``points`` (latent vectors) and their ``marks``.

    At most ``sample`` labels are learnt from, those whose ids come first by
    hash, each from one row of its document (where unlike texts share an id, the
    one first by hash); a label given twice counts once, unlike labels of one id
    count each.  Rows whose CRC-32 of the id as text is divisible by 5 are held
    out; labels without an id or a document teach nothing.  None without usable
    labels.
    """
    import numpy as np

    spark = docs.sparkSession
    small_batches(spark)
    usable = labels.where(F.col(label_col).isin(0, 1) & F.col(doc_col).isNotNull() & ~held_out(doc_col))
    chosen = (usable.select(F.col(doc_col).alias("doc_id"), F.col(label_col).cast("int").alias("mark")).distinct()
              .orderBy(F.xxhash64("doc_id"), "doc_id", "mark").limit(sample).collect())
    if not chosen:
        return None
    chosen = small_frame(spark, [(int(r["doc_id"]), r["mark"]) for r in chosen], StructType().add("doc_id", LongType()).add("mark", IntegerType()))
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text")
    n, df = document_frequencies(docs.select(text))

    def terms(frames):
        import pandas as pd

        for pdf in frames:
            rows = [(d, np.minimum(trigrams(t), 65504).astype(np.float16).tobytes(), profile(t).astype(np.float16).tobytes(), m)
                    for d, t, m in zip(pdf["doc_id"], pdf["text"], pdf["mark"])]
            yield pd.DataFrame(rows, columns=["doc_id", "grams", "bins", "mark"])

    known = docs.select(F.col(doc_col).cast("long").alias("doc_id"), text).join(F.broadcast(chosen), "doc_id")
    known = known.groupBy("doc_id", "mark").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))
    rows = sorted(known.mapInPandas(tidy(terms), "doc_id long, grams binary, bins binary, mark int").collect(), key=lambda r: (r["doc_id"], r["mark"]))
    if not rows:
        return None
    idf = (np.log((1 + n) / (1 + np.array(df))) + 0.1).astype(np.float32)
    a = np.empty((len(rows), TERMS + len(rows[0]["bins"]) // 2), np.float32)
    for i, r in enumerate(rows):
        a[i:i + 1] = _vectors(*(np.frombuffer(r[c], np.float16).astype(np.float32)[None] for c in ("grams", "bins")), idf)
    dims = min(dims, len(a))
    q = np.random.default_rng(0).standard_normal((a.shape[1], dims + 10)).astype(np.float32)
    for _ in range(5):
        q, _ = np.linalg.qr(a.T @ (a @ q))
    _, _, vt = np.linalg.svd(a @ q, full_matrices=False)
    axes = (q @ vt.T)[:, :dims]
    return {"idf": idf, "axes": axes, "points": _unit(a @ axes), "marks": np.array([r["mark"] for r in rows], np.float32)}


def held_out(col: str):
    return F.coalesce(F.crc32(F.col(col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def score(docs: DataFrame, model: dict | None, neighbours: int = 25, power: int = 32, threshold: float = 0.3,
          doc_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: its columns, ``score`` (0 to 1, higher: label 1 likelier) and ``predicted``.

    The ``neighbours`` most similar of the model's points vote, weighted by
    cosine to the ``power``; of equally similar points any may be among them.
    Whole texts are scored; null is empty; an empty text has a score like any
    other.  Ids play no part: rows with null or repeated ids are kept and scored
    each by its text.  Without a model the score is 0.5.  Columns named
    ``score`` or ``predicted`` are replaced, all others stay as they are; only
    texts leave the JVM.
    """
    import numpy as np
    import pandas as pd

    small_batches(docs.sparkSession)
    docs = docs.drop("score", "predicted")
    if model is None:
        return docs.withColumn("score", F.lit(0.5)).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
    shipped = docs.sparkSession.sparkContext.broadcast(model)
    k = min(neighbours, len(model["marks"]))

    def votes(columns):
        import pandas as pd

        m = shipped.value
        for column in columns:
            texts = column.tolist()
            out = np.zeros(len(texts))
            for a in range(0, len(texts), 512):
                part = texts[a:a + 512]
                grams = np.array([trigrams(t) for t in part], np.float32)
                terms = _vectors(grams, np.array([profile(t) for t in part], np.float32), m["idf"])
                near = _unit(terms @ m["axes"]) @ m["points"].T
                best = np.argpartition(-near, k - 1, axis=1)[:, :k]
                w = np.maximum(np.take_along_axis(near, best, 1), 1e-3).astype(np.float64) ** power
                out[a:a + 512] = (w * m["marks"][best]).sum(1) / w.sum(1)
            yield pd.Series(np.clip(out, 0, 1))

    run = tidy(votes)
    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    scored = docs.withColumn("score", F.pandas_udf(run, "double")(text))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
