"""Removal of long byte strings that occur earlier in the corpus, by pivots and window hashes.

Every byte covered by a ``LENGTH``-byte string that also starts earlier (in a
document with a smaller id, or earlier in the same document) is removed.

Buckets are 64-bit identifiers of byte strings, made by doubling: the bucket of
2k bytes at a place joins the bucket of k bytes there with the bucket k bytes
later, so each level reuses the one before (1, 2, 4, ... 32, 64, then 100 from
the 64-byte buckets at offsets 0 and 36).

1.  Initial buckets: of the 69 32-byte strings inside a 100-byte window, the one
    with the smallest scrambled bucket is the window's pivot.  Equal windows
    have equal pivots, so only places with the same pivot bucket can hold equal
    windows, and one entry stands for the run of neighbouring windows that
    share a pivot (about one entry per 35 bytes instead of one per byte).
2.  Refinement of whole runs: entries are shuffled by pivot bucket and sorted
    on the buckets at their run's first and last offset.  Alike runs hold the
    same windows: all but the earliest are removed.  A run alone in its pivot
    bucket is unique and settled.  Only runs whose pivot bucket holds unlike
    runs stay.
3.  Refinement of single offsets: all windows of those runs are shuffled and
    sorted by pivot bucket and 100-byte bucket; all but the earliest of each
    are removed.

Buckets are computed from each text alone.  No sort hands new bucket numbers to
later offsets, as refinement of a suffix array's bucket pointers would.

A sort that meets entries in order needs one earlier entry to judge the next,
so a bucket of any size streams through its task.  Entries that repeat within
a batch of documents are settled there, before the shuffle.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import Scratch, id_key, restored, text_hash, tidy

LENGTH, GRAM = 100, 32
PIVOTS = LENGTH - GRAM + 1
CHUNK = 1 << 16
TOGETHER, WINDOWS = 16 << 20, 1 << 20
"""Bytes of text, and windows of unsettled runs, that are settled together before the shuffle."""
ROWS = 1 << 16
"""Entries handed to Spark at once."""
LOC_BITS, AT_BITS = 63, 28
"""Bits of a place, and those of them that say where in the document, at least; longer texts take more, ids what is left."""
REMOVED, MIXED = 1, 2


def _buckets(raw):
    """Buckets of 32 and of 100 bytes at each place of ``raw`` (bytes as uint8), as far as they fit."""
    import numpy as np

    m1, m2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)

    def join(a, b):
        h = a * m1
        h += b
        h ^= h >> np.uint64(29)
        h *= m2
        h ^= h >> np.uint64(32)
        return h

    one = (np.arange(1, 257, dtype=np.uint64) * m1)
    one ^= one >> np.uint64(30)
    one *= np.uint64(0xBF58476D1CE4E5B9)
    one ^= one >> np.uint64(27)
    h, k = one[raw], 1
    while k < GRAM:
        h = join(h[:-k], h[k:])
        k *= 2
    b64 = join(h[:-GRAM], h[GRAM:])
    return h, join(b64[:-(LENGTH - 64)], b64[LENGTH - 64:])


def _pivots(b32):
    """For each window start the place of its pivot: the leftmost smallest of the next ``PIVOTS`` buckets."""
    import numpy as np

    key = (b32 >> np.uint64(32)).astype(np.uint32)
    at = np.arange(len(key), dtype=np.int32)

    def least(key, at, d):
        k2, a2 = key[d:], at[d:]
        k1, a1 = key[:-d], at[:-d]
        later = k2 < k1
        return np.where(later, k2, k1), np.where(later, a2, a1)

    d = 1
    while 2 * d <= PIVOTS:
        key, at = least(key, at, d)
        d *= 2
    if d < PIVOTS:
        key, at = least(key, at, PIVOTS - d)
    return at


def _runs(texts):
    """Runs of windows with a common pivot, for a list of documents as bytes.

    Yields per chunk ``(doc, start, extent, pivot, bucket, b100, base)``: arrays
    over runs (index of the document, first window's place in it, number of
    windows less one, pivot's place in the chunk, its 32-byte bucket), the
    chunk's 100-byte buckets and each run's first window's place in the chunk.
    """
    import numpy as np

    def chunks():
        part, size = [], 0
        for i, t in enumerate(texts):
            if len(t) < LENGTH:
                continue
            for a in range(0, len(t) - LENGTH + 1, CHUNK):
                piece = t[a:a + CHUNK + LENGTH - 1]
                if size and size + len(piece) > CHUNK:
                    yield part
                    part, size = [], 0
                part.append((i, a, piece))
                size += len(piece)
        if part:
            yield part

    for part in chunks():
        raw = np.frombuffer(b"".join(p for _, _, p in part), np.uint8)
        b32, b100 = _buckets(raw)
        at = _pivots(b32)
        sizes = np.array([len(p) for _, _, p in part])
        first = np.cumsum(sizes) - sizes
        windows = sizes - LENGTH + 1
        # Window starts that stay inside their document.
        s = np.repeat(first - (np.cumsum(windows) - windows), windows) + np.arange(windows.sum())
        own = np.repeat(np.arange(len(part)), windows)
        p = at[s]
        new = np.empty(len(s), bool)
        new[0] = True
        new[1:] = (p[1:] != p[:-1]) | (own[1:] != own[:-1])
        i = np.flatnonzero(new)
        extent = np.diff(np.append(i, len(s))) - 1
        own, base = own[i], s[i]
        doc = np.array([d for d, _, _ in part])[own]
        start = base - first[own] + np.array([a for _, a, _ in part])[own]
        yield doc, start, extent, p[i], b32[p[i]], b100, base


def _entries(bucket, sig, loc, ext, shift: int = 0):
    """Settle what repeats inside one batch: keep the earliest of alike entries, pass the others on as removed.

    With ``shift`` only the bucket's upper bits are kept.
    """
    import numpy as np
    import pandas as pd

    bucket = bucket >> np.uint64(shift)
    o = np.lexsort((loc, sig, bucket))
    bucket, sig, loc, ext = bucket[o], sig[o], loc[o], ext[o]
    again = np.zeros(len(o), bool)
    again[1:] = (bucket[1:] == bucket[:-1]) & (sig[1:] == sig[:-1])
    bucket = np.where(again, (loc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(shift), bucket)
    for a in range(0, len(loc), ROWS):
        k = slice(a, a + ROWS)
        yield pd.DataFrame({"bucket": bucket[k].view(np.int64), "sig": sig[k].view(np.int64), "loc": loc[k],
                            "ext": ext[k].astype(np.int32), "kind": again[k].astype(np.int32)})


ENTRY = "bucket long, sig long, loc long, ext int, kind int"


def _gathered(batches):
    """Batches joined until they hold ``TOGETHER`` bytes of text: the more documents at once, the more repeats settle before the shuffle."""
    import pandas as pd

    part, size = [], 0
    for pdf in batches:
        part.append(pdf)
        size += sum(map(len, pdf["text"]))
        if size >= TOGETHER:
            yield pd.concat(part, ignore_index=True)
            part, size = [], 0
    if part:
        yield pd.concat(part, ignore_index=True)


def _run_entries(batches, at_bits: int):
    import numpy as np

    for pdf in _gathered(batches):
        ids = pdf["id"].to_numpy(np.int64)
        out = []
        for doc, start, extent, pivot, bucket, b100, base in _runs(pdf["text"].tolist()):
            sig = b100[base] * np.uint64(0xFF51AFD7ED558CCD)
            sig ^= sig >> np.uint64(31)
            sig += b100[base + extent] * np.uint64(0xC4CEB9FE1A85EC53)
            sig ^= sig >> np.uint64(33)
            sig += (pivot - base).astype(np.uint64) * np.uint64(128) + extent.astype(np.uint64)
            out.append((bucket, sig, (ids[doc] << at_bits) | start, extent))
        if out:
            yield from _entries(*(np.concatenate(x) for x in zip(*out)))


def _window_entries(batches, at_bits: int):
    """Entries of the single windows of unsettled runs; ``runs`` lists where a document's unsettled runs start."""
    import numpy as np

    for pdf in _gathered(batches):
        ids = pdf["id"].to_numpy(np.int64)
        starts = [np.asarray(m, np.int64) for m in pdf["runs"]]
        wanted = np.sort(np.concatenate([(i << at_bits) | m for i, m in enumerate(starts)]))
        out, held = [], 0
        for doc, start, extent, _, bucket, b100, base in _runs(pdf["text"].tolist()):
            key = (doc.astype(np.int64) << at_bits) | start
            found = wanted[np.minimum(np.searchsorted(wanted, key), len(wanted) - 1)] == key
            n = (extent + 1) * found
            run = np.repeat(np.arange(len(n)), n)
            s = np.repeat(base - (np.cumsum(n) - n), n) + np.arange(n.sum())
            out.append((bucket[run], b100[s], (ids[doc[run]] << at_bits) | (start[run] + s - base[run]), np.zeros(len(s), np.int32)))
            held += len(s)
            if held >= WINDOWS:
                yield from _entries(*(np.concatenate(x) for x in zip(*out)), shift=32)
                out, held = [], 0
        if out:
            # 32 bits of the pivot bucket beside 64 of the window's tell windows apart, in fewer bytes.
            yield from _entries(*(np.concatenate(x) for x in zip(*out)), shift=32)


def _refine(batches):
    """Judge entries that come sorted by bucket, sig and loc; only the last kept entry is carried along."""
    import numpy as np
    import pandas as pd

    held = None  # the last entry kept, as (bucket, sig, loc, ext), and whether its bucket is known to be mixed

    def frame(loc, ext, kind):
        return pd.DataFrame({"loc": loc, "ext": ext, "kind": np.full(len(loc), kind, np.int32)})

    for pdf in batches:
        passed = pdf["kind"].to_numpy() == REMOVED
        out = [frame(pdf["loc"][passed], pdf["ext"][passed], REMOVED)]
        b, g, loc, ext = (pdf[c].to_numpy()[~passed] for c in ("bucket", "sig", "loc", "ext"))
        if len(b):
            known = False
            if held is not None:
                b, g, loc, ext = (np.concatenate(([h], x)) for h, x in zip(held[0], (b, g, loc, ext)))
                known = held[1]
            again = np.zeros(len(b), bool)
            again[1:] = (b[1:] == b[:-1]) & (g[1:] == g[:-1])
            out.append(frame(loc[again], ext[again], REMOVED))
            k = np.flatnonzero(~again)
            same = b[k][1:] == b[k][:-1]
            mixed = np.zeros(len(k), bool)
            mixed[1:] |= same
            mixed[:-1] |= same
            mixed[0] |= known
            done = k[:-1][mixed[:-1]]
            out.append(frame(loc[done], ext[done], MIXED))
            j = k[-1]
            held = (b[j], g[j], loc[j], ext[j]), bool(mixed[-1])
        yield pd.concat(out)
    if held is not None and held[1]:
        yield frame([held[0][2]], [held[0][3]], MIXED)


def _judged(entries: DataFrame, *by: str) -> DataFrame:
    return (entries.repartition(*by).sortWithinPartitions("bucket", "sig", "loc")
            .mapInPandas(tidy(_refine), "loc long, ext int, kind int"))


def _cut(text: bytes, spans) -> tuple[bytes, int, int]:
    """What is left of ``text``, and the bytes and maximal runs removed."""
    import numpy as np

    if spans is None or not len(spans):
        return text, 0, 0
    spans = np.sort(np.asarray(spans, np.int64))
    a = spans >> 7
    end = np.maximum.accumulate(a + (spans & 127) + LENGTH)
    new = np.append(True, a[1:] > end[:-1])
    a, b = a[new], end[np.append(np.flatnonzero(new)[1:] - 1, len(end) - 1)]
    kept = b"".join(text[x:y] for x, y in zip([0, *b.tolist()], [*a.tolist(), len(text)]))
    return kept, int((b - a).sum()), len(a)


def _order(docs: DataFrame, tmp: Scratch) -> tuple[DataFrame, DataFrame | None, int]:
    """Rows as ``(id, text bytes)`` with one small id per document, the names of the ids where they are not the documents' own, and the bits that the longest text's places take.

    Documents' own ids serve when they are unique and small.  Otherwise each
    distinct (doc_id, text) gets its place in their order: by id, null last,
    then by text hash.
    """
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text")
    n = docs.agg(F.count(F.lit(1)).alias("n"), F.count("doc_id").alias("k"), F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"),
                 F.max(F.octet_length("text")).alias("longest")).first()
    at_bits = max(AT_BITS, (n["longest"] or 0).bit_length())
    ids = 1 << LOC_BITS - at_bits
    plain = n["n"] == n["k"] and (not n["n"] or (n["lo"] >= 0 and n["hi"] < ids))
    if plain and docs.groupBy("doc_id").count().where("count > 1").isEmpty():
        return docs.select(F.col("doc_id").cast("long").alias("id"), text), None, at_bits
    named = docs.select(id_key("doc_id").alias("_id"), text_hash("text").alias("_th"), text)
    order = [F.asc_nulls_last("doc_id"), F.asc("_th")]
    keys = docs.select("doc_id", id_key("doc_id").alias("_id"), text_hash("text").alias("_th")).distinct()
    keys = keys.repartitionByRange(*order).sortWithinPartitions(*order)
    keys = tmp.keep(keys.select("_id", "_th", F.spark_partition_id().alias("_p"), F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("_k")), "keys")
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)  # a row per partition
    bases = keys.groupBy("_p").agg(F.count(F.lit(1)).alias("n")).select("_p", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_base"))
    names = tmp.keep(keys.join(F.broadcast(bases), "_p").select("_id", "_th", (F.col("_base") + F.col("_k")).alias("id")), "names")
    if n["n"] > ids and names.count() > ids:
        raise ValueError(f"more than {ids} documents beside a text of {n['longest']} bytes")
    return names.join(named.dropDuplicates(["_id", "_th"]), ["_id", "_th"]).select("id", "text"), names, at_bits


def _spans(docs: DataFrame) -> tuple[DataFrame, list[str]]:
    """Removed runs of windows per document, as start and extent packed into longs, and the key columns they go by."""
    tmp = Scratch(docs.sparkSession, "suffix")
    texts, names, at_bits = _order(docs, tmp)
    at = F.col("loc").bitwiseAND(F.lit((1 << at_bits) - 1))
    doc = F.shiftright("loc", at_bits).alias("id")

    long_enough = texts.where(F.octet_length("text") >= LENGTH)
    runs = tmp.keep(_judged(long_enough.mapInPandas(tidy(lambda batches: _run_entries(batches, at_bits)), ENTRY), "bucket"), "runs")
    mixed = runs.where(F.col("kind") == MIXED).select(doc, at.alias("at")).groupBy("id").agg(F.collect_list("at").alias("runs"))
    windows = long_enough.join(mixed, "id").mapInPandas(tidy(lambda batches: _window_entries(batches, at_bits)), ENTRY)
    single = tmp.keep(_judged(windows, "bucket", "sig").where(F.col("kind") == REMOVED), "windows")
    spans = (runs.where(F.col("kind") == REMOVED).unionByName(single)
             .select(doc, (F.shiftleft(at, 7) + F.col("ext")).alias("s")).groupBy("id").agg(F.collect_list("s").alias("_spans")))
    if names is None:
        return spans.select(F.concat(F.lit("="), F.col("id").cast("string")).alias("_id"), "_spans"), ["_id"]
    return spans.join(names, "id").drop("id"), ["_id", "_th"]


def _with_spans(docs: DataFrame, doc_col: str, text_col: str) -> DataFrame:
    spans, keys = _spans(docs.select(F.col(doc_col).alias("doc_id"), F.col(text_col).alias("text")))
    made = {"_id": id_key(doc_col), "_th": text_hash(text_col)}
    bare = docs.drop("_id", "_th", "_spans", "_text")
    rows = bare.withColumns({k: made[k] for k in keys} | {"_text": F.coalesce(F.col(text_col), F.lit("")).cast("binary")})
    return rows.join(spans, keys, "left").drop(*keys)


def remove_repeats(docs: DataFrame, doc_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Remove each byte covered by a 100-byte string that also starts earlier.

    Returns a row per row of ``docs``: ``doc_id``, ``n_bytes``, ``n_removed``,
    ``n_spans`` (maximal removed runs), ``kept_sha256`` and ``kept`` (the
    remaining bytes).  A null text is empty; nothing is removed from texts under
    100 bytes.  Rows with equal id and text count as one document and get equal
    rows; rows with an equal id and unlike texts are ordered by the texts'
    XXH64; a null id comes after all others.  Other columns are left out.
    """
    def cut(batches):
        import pandas as pd

        for pdf in batches:
            rows = []
            for doc, text, spans in zip(pdf["doc_id"], pdf["_text"], pdf["_spans"]):
                kept, removed, n = _cut(text, spans)
                rows.append((doc, len(text), removed, n, hashlib.sha256(kept).hexdigest(), kept))
            yield pd.DataFrame(rows, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    rows = _with_spans(docs.select(F.col(doc_col).alias("doc_id"), F.col(text_col).alias("text")), "doc_id", "text")
    out = rows.select(id_key("doc_id").alias("doc_id"), "_text", "_spans").mapInPandas(
        tidy(cut), "doc_id string, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    return out.withColumn("doc_id", restored("doc_id", docs.schema[doc_col].dataType))


def without_repeats(docs: DataFrame, doc_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the text that ``remove_repeats`` leaves, all other columns as they are.

    Texts from which nothing is removed, null ones too, stay untouched; a
    character of which only some bytes are left goes.  A column whose name is
    one of ``_id, _th, _spans, _text`` is left out.
    """
    names = [c for c in docs.columns if c not in ("_id", "_th", "_spans", "_text")]

    def cut(batches):
        import pyarrow as pa

        for b in batches:
            texts, spans = b.column(text_col).to_pylist(), b.column("_spans").to_pylist()
            texts = [t if s is None else _cut(t.encode(), s)[0].decode(errors="ignore") for t, s in zip(texts, spans)]
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()) if c == text_col else b.column(c) for c in names], names)

    return _with_spans(docs, doc_col, text_col).drop("_text").mapInArrow(tidy(cut), docs.select(*names).schema)
