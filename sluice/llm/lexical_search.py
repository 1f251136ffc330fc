"""Ranked lexical search over geometric blocks of posting lists, exact top documents per item.

Benchmark items are the query set, taken in blocks of at most about ``BLOCK_WORDS``
words; the vocabulary of a block is its items' terms.

1.  Vectors.  Every whole document becomes its number of terms and the
    frequencies of the vocabulary's terms in it.  Counts over all documents give
    each term's weight, and with it a document's impact for a term.
2.  Thresholds.  Each batch of documents scores those that hold an item's
    heaviest terms; the tenth best score found over all batches is one that the
    item's answers must reach.  From it follow the lists an item has to open:
    documents that hold none but its least promising terms, whose greatest
    impacts together stay below the threshold, cannot be answers.
3.  Index.  Documents are indexed in shards of a few thousand rows as they come,
    so the list of a word that every document holds is many short ones.  Within
    a shard each list to be opened is clustered by the similarity of its
    documents into blocks.  A block keeps, for each term that shares an item
    with the list's, the greatest impact any of its documents has.
4.  Search.  An item's weights times a block's summary bound the score of every
    document in the block.  Only blocks whose bound falls short of the threshold
    are skipped; the documents of the others are scored in full.  The best of
    each shard meet in a ranking by item, of which Spark keeps only the first
    rows per task before the shuffle.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from sluice.llm.common import Scratch, small_frame, tidy

BLOCK_WORDS = 500_000
BLOCK_DOCS = 64
DIMS = 16
SEPARATORS = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))
"""Letters A-Z in lower case, digits, small letters and bytes above 127 as they are, a space for all else."""


def terms_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(SEPARATORS).split()


def rows_of(ends, picks):
    """Places of the entries of rows ``picks`` in a table whose row ``k`` ends at ``ends[k]``, and where each pick's entries begin among them."""
    import numpy as np

    begin = np.where(picks > 0, ends[picks - 1], 0)
    size = ends[picks] - begin
    at = np.cumsum(size) - size
    return np.repeat(begin - at, size) + np.arange(size.sum()), at


def vectors(docs: DataFrame, vocab: dict[bytes, int]) -> DataFrame:
    """``doc_id, n, terms, tfs`` of every document that has a term; ``terms`` are the vocabulary's, in rising order."""
    shipped = docs.sparkSession.sparkContext.broadcast(vocab)

    def count(batches):
        import numpy as np
        import pyarrow as pa

        get = shipped.value.get
        for b in batches:
            ns, ends, terms, tfs, rows = [], [0], [], [], []
            for k, text in enumerate(b.column("text").to_pylist()):
                words = terms_of(text)
                if not words:
                    continue
                ids = np.array([i for i in map(get, words) if i is not None], np.int32)
                own, tf = np.unique(ids, return_counts=True)
                rows.append(k)
                ns.append(len(words))
                ends.append(ends[-1] + len(own))
                terms.append(own)
                tfs.append(tf.astype(np.int32))
            flat = [np.concatenate(x) if x else np.empty(0, np.int32) for x in (terms, tfs)]
            lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x, pa.int32())) for x in flat]
            yield pa.RecordBatch.from_arrays([b.column("doc_id").take(pa.array(rows, pa.int64())), pa.array(ns, pa.int64()), *lists],
                                             ["doc_id", "n", "terms", "tfs"])

    schema = StructType([docs.schema["doc_id"]]).add("n", LongType()).add("terms", ArrayType(IntegerType())).add("tfs", ArrayType(IntegerType()))
    return docs.mapInArrow(tidy(count), schema)


def impact(total: int, words: int) -> str:
    """SQL for a term's impact from its frequency ``tf`` and the document's ``n`` terms."""
    return f"(1000000000L * tf) div (1000L * tf + 8 * (10 + (90 * n * {total}L) div {words}L))"


def flat_impacts(batch, total: int, words: int):
    """Of a batch of vectors: ends of the documents' entries, the entries' terms and impacts."""
    import numpy as np

    n = batch.column("n").to_numpy()
    lists, tfs = batch.column("terms"), batch.column("tfs")
    size = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    terms, tf = lists.flatten().to_numpy().astype(np.int64), tfs.flatten().to_numpy().astype(np.int64)
    m = 10 + (90 * n * total) // words
    return np.cumsum(size), terms, (1_000_000_000 * tf) // (1000 * tf + 8 * np.repeat(m, size))


def by_term(ends, terms):
    """Documents of each entry in order of terms, that order, and the distinct terms with the places where their entries end."""
    import numpy as np

    doc = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
    o = np.argsort(terms, kind="stable")
    own, first = np.unique(terms[o], return_index=True)
    return doc[o], own, np.append(first[1:], len(o))


def scores(ends, terms, impacts, weights, docs):
    """Exact scores of ``docs`` for an item with ``weights`` by term."""
    import numpy as np

    at, first = rows_of(ends, docs)
    worth = weights[terms[at]] * impacts[at]
    return np.add.reduceat(np.append(worth, 0), first) * (np.diff(np.append(first, len(worth))) > 0)


def _first_scores(items: list, weight, total: int, words: int, limit: int):
    """Per batch of vectors: ``item, score`` of documents that hold the items' heaviest terms there, ``limit`` an item at most."""
    def probe(batches):
        import numpy as np
        import pyarrow as pa

        w = np.zeros(len(weight), np.int64)
        for b in batches:
            if not b.num_rows:
                continue
            ends, terms, impacts = flat_impacts(b, total, words)
            doc, own, stop = by_term(ends, terms)
            start = np.append(0, stop[:-1])
            out = []
            for q, ids in enumerate(items):  # terms by falling weight
                k = np.minimum(np.searchsorted(own, ids), max(0, len(own) - 1))
                k = k[own[k] == ids] if len(own) else k[:0]
                enough = np.searchsorted(np.cumsum(stop[k] - start[k]), 2 * limit) + 1
                if not len(k):
                    continue
                found = np.unique(np.concatenate([doc[start[x]:stop[x]] for x in k[:enough]]))
                w[ids] = weight[ids]
                got = scores(ends, terms, impacts, w, found)
                w[ids] = 0
                best = np.sort(got[got > 0])[::-1][:limit]
                out.append((np.full(len(best), q, np.int32), best))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out)], ["item", "score"])

    return probe


INDEX = ["vec_end", "vec_term", "vec_impact", "block_term", "block_end", "block_doc", "top_end", "top_term", "top_impact"]
"""A shard's arrays: documents' entries; blocks by term with their documents; blocks' summaries."""


def blocks_of(ends, terms, impacts, related: dict):
    """Blocks of the lists of the terms ``related`` names (with the terms that share an item with it): INDEX arrays from the fourth on."""
    import numpy as np

    doc, own, stop = by_term(ends, terms)
    start = np.append(0, stop[:-1])
    # Directions of documents: signed sums of their impacts, alike for alike documents.
    sign = np.random.default_rng(7).choice(np.array([-1.0, 1.0]), (int(terms.max()) + 1 if len(terms) else 1, DIMS))
    at = np.append(0, ends[:-1])
    sketch = np.add.reduceat(np.vstack([sign[terms] * impacts[:, None], np.zeros((1, DIMS))]), np.minimum(at, len(terms)), axis=0)
    sketch /= np.maximum(np.linalg.norm(sketch, axis=1, keepdims=True), 1e-9)
    mask = np.zeros(len(sign), bool)
    block_term, members, sizes, tops = [], [], [], []
    for k, t in enumerate(own.tolist()):
        if t not in related:
            continue
        held = doc[start[k]:stop[k]]
        if len(held) > BLOCK_DOCS:
            n = -(-len(held) // BLOCK_DOCS)
            centre = held[np.arange(n) * len(held) // n]
            near = np.argmax(sketch[held] @ sketch[centre].T, axis=1)
            o = np.argsort(near, kind="stable")
            held, near = held[o], near[o]
            new = np.append(True, near[1:] != near[:-1])
            place = np.arange(len(held)) - np.maximum.accumulate(np.where(new, np.arange(len(held)), 0))
            block = np.cumsum(new | (place % BLOCK_DOCS == 0)) - 1
        else:
            block = np.zeros(len(held), np.int64)
        n = int(block[-1]) + 1
        also = related[t]
        also = also[also < len(mask)]
        mask[also] = True
        e, _ = rows_of(ends, held)
        of = np.repeat(block, np.diff(ends, prepend=0)[held])
        wanted = mask[terms[e]]
        mask[also] = False
        e, of = e[wanted], of[wanted]
        o = np.lexsort((terms[e], of))
        e, of = e[o], of[o]
        new = np.append(True, (of[1:] != of[:-1]) | (terms[e][1:] != terms[e][:-1]))
        first = np.flatnonzero(new)
        tops.append((np.bincount(of[first], minlength=n), terms[e][first], np.maximum.reduceat(impacts[e], first)))
        block_term.append(np.full(n, t))
        members.append(held)
        sizes.append(np.bincount(block, minlength=n))

    def joined(parts):
        return np.concatenate(parts) if parts else np.empty(0, np.int64)

    top_size, top_term, top_impact = (joined([x[i] for x in tops]) for i in range(3))
    return [joined(block_term), np.cumsum(joined(sizes)), joined(members), np.cumsum(top_size), top_term, top_impact]


def _index(related: dict, total: int, words: int):
    def build(batches):
        import numpy as np
        import pyarrow as pa

        for b in batches:
            if not b.num_rows:
                continue
            ends, terms, impacts = flat_impacts(b, total, words)
            arrays = [ends, terms, impacts, *blocks_of(ends, terms, impacts, related)]
            ids = pa.ListArray.from_arrays(pa.array([0, b.num_rows], pa.int32()), b.column("doc_id"))
            lists = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), pa.array(np.asarray(x, np.int32))) for x in arrays]
            yield pa.RecordBatch.from_arrays([ids, *lists], ["ids", *INDEX])

    return build


def search_shard(shard: list, opened, ids, weights, least: int):
    """Documents of a shard that may be answers, their scores, and how many blocks were there and were read.

    ``shard`` are the INDEX arrays, ``opened`` the terms whose lists the item opens,
    ``weights`` its terms' weights (zero for other terms), ``least`` its threshold.
    """
    import numpy as np

    vec_end, vec_term, vec_impact, block_term, block_end, block_doc, top_end, top_term, top_impact = shard
    lo, hi = np.searchsorted(block_term, opened), np.searchsorted(block_term, opened, side="right")
    blocks = np.concatenate([np.arange(a, z) for a, z in zip(lo, hi) if z > a] or [np.empty(0, np.int64)])
    if not len(blocks):
        return blocks, blocks, 0, 0
    at, first = rows_of(top_end, blocks)
    bound = np.add.reduceat(np.append(weights[top_term[at]] * top_impact[at], 0), first)
    read = blocks[bound >= least]
    docs = np.unique(block_doc[rows_of(block_end, read)[0]]) if len(read) else blocks[:0]
    got = scores(vec_end, vec_term, vec_impact, weights, docs) if len(docs) else docs
    keep = (got >= least) & (got > 0)
    return docs[keep], got[keep], len(blocks), len(read)


def _search(items: list, opened: list, weight, least: list, limit: int):
    def search(batches):
        import numpy as np
        import pyarrow as pa
        from pyarrow.compute import sort_indices

        w = np.zeros(len(weight), np.int64)
        for b in batches:
            for row in range(b.num_rows):
                ids = b.column("ids")[row].values
                shard = [b.column(c)[row].values.to_numpy().astype(np.int64) for c in INDEX]
                # Places of documents in the order of their ids, null last: ties go by it.
                order = np.empty(len(ids), np.int64)
                order[sort_indices(ids, null_placement="at_end").to_numpy()] = np.arange(len(ids))
                out = []
                for q, terms in enumerate(items):
                    w[terms] = weight[terms]
                    docs, got, _, _ = search_shard(shard, opened[q], terms, w, least[q])
                    w[terms] = 0
                    if len(docs):
                        o = np.lexsort((order[docs], -got))[:limit]
                        out.append((np.full(len(o), q, np.int32), docs[o], got[o]))
                if out:
                    q, docs, got = (np.concatenate(x) for x in zip(*out))
                    yield pa.RecordBatch.from_arrays([pa.array(q), ids.take(pa.array(docs)), pa.array(got)], ["item", "doc_id", "score"])

    return search


def _block(docs: DataFrame, items: list[list[bytes]], limit: int, tmp: Scratch) -> DataFrame:
    """``item`` (its number), ``rank, doc_id, score`` for one block of items, each a list of its distinct terms."""
    import numpy as np

    spark = docs.sparkSession
    vocab = {t: k for k, t in enumerate(sorted({t for x in items for t in x}))}
    table = tmp.keep(vectors(docs, vocab), "vectors")
    stats = table.agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("words")).first()
    total, words = stats["docs"], max(1, stats["words"] or 0)
    postings = table.select("n", F.explode(F.arrays_zip("terms", "tfs")).alias("p")).select("n", F.col("p.terms").alias("term"), F.col("p.tfs").alias("tf"))
    df, peak, weight = (np.zeros(len(vocab), np.int64) for _ in range(3))
    for r in postings.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.max(F.expr(impact(total, words))).alias("peak")).toLocalIterator():
        df[r["term"]], peak[r["term"]] = r["df"], r["peak"]
    weight[:] = [math.floor(1000 * math.log((2 * total + 2) / (2 * d + 1))) for d in df.tolist()]
    ids = [np.array(sorted((vocab[t] for t in x), key=lambda t: (-weight[t], t)), np.int64) for x in items]

    ranked = Window.partitionBy("item").orderBy(F.desc("score"))
    first = (table.mapInArrow(tidy(_first_scores(ids, weight, total, words, limit)), "item int, score long")
             .withColumn("r", F.row_number().over(ranked)).where(F.col("r") <= limit)
             .groupBy("item").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least")))
    least = [0] * len(ids)
    for r in first.collect():
        least[r["item"]] = r["least"] if r["n"] == limit else 0
    opened, related = [], {}
    for x, floor in zip(ids, least):
        worth = weight[x] * peak[x]
        o = np.argsort(worth, kind="stable")
        needed = np.sort(x[o[np.cumsum(worth[o]) >= floor]])
        opened.append(needed)
        for t in needed.tolist():
            related.setdefault(t, []).append(x)
    related = {t: np.unique(np.concatenate(x)) for t, x in related.items()}

    id_type = docs.schema["doc_id"].dataType
    schema = StructType([StructField("ids", ArrayType(id_type)), *[StructField(c, ArrayType(IntegerType())) for c in INDEX]])
    index = tmp.keep(table.mapInArrow(tidy(_index(related, total, words)), schema), "index")
    out = StructType([StructField("item", IntegerType()), StructField("doc_id", id_type), StructField("score", LongType())])
    hits = index.mapInArrow(tidy(_search(ids, opened, weight, least, limit)), out)
    ranked = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    best = tmp.keep(hits.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= limit), "best")
    tmp.drop(table, index)
    return best


def search(docs: DataFrame, items: DataFrame, limit: int = 10, doc_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """Each item's ``limit`` highest-scoring documents: ``item_id, rank`` (from 1), ``doc_id, score``.

    Terms are runs of letters, digits and characters beyond ASCII, A-Z in lower
    case.  With ``N`` documents that have terms, ``L`` terms in all and ``df``
    documents that hold a term, its weight is ``floor(1000 ln((2N+2)/(2df+1)))``;
    a document of ``n`` terms that holds it ``tf`` times has the impact
    ``10^9 tf div (1000 tf + 8 (10 + 90 n N div L))``.  A score is the sum of weight
    times impact over an item's distinct terms, in 64-bit integers.

    Documents with equal scores go by ascending id, null last; those with a score
    of 0 are no answers.  Null texts and texts without terms have no part in
    anything; repeated rows are documents of their own.  Rows that repeat an
    item's id and text count once; unlike texts under one id, or under null, are
    items of their own.  Empty tables give an empty result.  Other columns are
    left out.
    """
    spark = docs.sparkSession
    tmp = Scratch(spark, "search")
    docs = docs.select(F.col(doc_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    asked = items.select(F.col(item_col).alias("item_id"), F.col(item_text).cast("binary").alias("text")).where("text is not null").distinct()
    size = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // (6 * BLOCK_WORDS)))
    out = None
    for b in range(blocks):
        part = asked.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b) if blocks > 1 else asked
        rows = [(r["item_id"], sorted(set(terms_of(bytes(r["text"]))))) for r in part.collect()]
        rows = [r for r in rows if r[1]]
        if not rows:
            continue
        best = _block(docs, [t for _, t in rows], limit, tmp)
        names = StructType([StructField("item", IntegerType()), asked.schema["item_id"]])
        named = best.join(F.broadcast(small_frame(spark, [(k, r[0]) for k, r in enumerate(rows)], names)), "item")
        found = named.select("item_id", "rank", "doc_id", "score")
        out = found if out is None else out.unionByName(found)
    if out is None:
        out = spark.createDataFrame([], StructType([asked.schema["item_id"], StructField("rank", IntegerType()), docs.schema["doc_id"], StructField("score", LongType())]))
    return out
