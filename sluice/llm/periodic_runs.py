"""Runs of words that repeat with a period, found by recursive frequency splitting and a lag scan.

A run is a stretch of words with smallest period ``q`` (words ``q`` apart are
identical) that holds its period at least ``repeats`` times and at least
``least`` words, and that no neighbouring word extends.  Each of its words
therefore occurs at least ``repeats`` times in it.

1.  Splitting.  A word that occurs fewer times in the current segment is in no
    run there and splits it.  The pieces are segments with rarer words, so it
    goes on until no segment splits.  The counts of the longest piece are made
    from its segment's by taking away the others', so every word is counted
    anew a logarithmic number of times at most, whatever the text.
2.  Lag scan of the segments that are left.  A run of period ``q`` covers
    ``repeats`` multiples of ``q`` in a row, so for each lag only the words at its
    multiples are compared; where ``repeats`` in a row are equal the stretch is
    measured out, and counts if it holds all of them.  Lags go upward.  Multiples
    that lie in one run found before repeat that run's period, not the lag, and
    are passed over.

Documents are judged each on its own, as rows of any partition.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructType

from sluice.llm.common import small_batches, tidy

RUN = StructType().add("start", LongType()).add("length", LongType()).add("period", LongType())


def stable_segments(codes, repeats: int, least: int) -> list[tuple[int, int]]:
    """Segments ``[a, b)`` of at least ``least`` words in each of which every word occurs ``repeats`` times or more."""
    import numpy as np

    n = len(codes)
    if n < least:
        return []
    order = np.argsort(codes, kind="stable")  # places by word
    first = np.searchsorted(codes[order], np.arange(codes.max() + 2))
    counts = Counter(codes.tolist())
    todo, out = [(0, n, counts, [w for w, c in counts.items() if c < repeats])], []
    while todo:
        a, b, counts, rare = todo.pop()
        if not rare:
            out.append((a, b))
            continue
        if len(rare) == 1:
            at = order[first[rare[0]]:first[rare[0] + 1]]
            cuts = at[(at >= a) & (at < b)] if len(at) < 64 else at[np.searchsorted(at, a):np.searchsorted(at, b)]
        elif 4 * len(rare) > len(counts):
            marked = np.zeros(len(first), bool)
            marked[rare] = True
            cuts = a + np.flatnonzero(marked[codes[a:b]])
        else:
            places = (order[first[w]:first[w + 1]] for w in rare)
            cuts = np.sort(np.concatenate([at[np.searchsorted(at, a):np.searchsorted(at, b)] for at in places]))
        left, right = np.append(a, cuts + 1), np.append(cuts, b)
        size = right - left
        whole = int(np.argmax(size)) if 2 * size.max() > b - a else -1
        for k in np.flatnonzero(size >= least).tolist():
            if k != whole:
                own = Counter(codes[left[k]:right[k]].tolist())
                todo.append((int(left[k]), int(right[k]), own, [w for w, c in own.items() if c < repeats]))
        if whole >= 0 and size[whole] >= least:
            lost = Counter(codes[a:left[whole]].tolist())
            lost.update(codes[right[whole]:b].tolist())
            rare = []
            for w, c in lost.items():
                counts[w] -= c
                if not counts[w]:
                    del counts[w]
                elif counts[w] < repeats:
                    rare.append(w)
            todo.append((int(left[whole]), int(right[whole]), counts, rare))
    return sorted(out)


def _stretch(x, i: int, q: int) -> tuple[int, int]:
    """The longest ``[lo, hi)`` around ``i`` in which words equal those ``q`` later."""
    n, step, hi = len(x) - q, 64, i
    while hi < n:
        b = min(n, hi + step)
        unlike = (x[hi:b] != x[hi + q:b + q])
        k = int(unlike.argmax())
        if unlike[k]:
            hi += k
            break
        hi, step = b, 2 * step
    step, lo = 64, i
    while lo > 0:
        a = max(0, lo - step)
        unlike = (x[a:lo] != x[a + q:lo + q])[::-1]
        k = int(unlike.argmax())
        if unlike[k]:
            lo -= k
            break
        lo, step = a, 2 * step
    return lo, hi


def lag_scan(x, repeats: int, least: int) -> list[tuple[int, int, int]]:
    """Runs ``(start, length, period)`` of one segment, by lag."""
    import numpy as np

    n, out = len(x), []
    reach = np.arange(n)  # the furthest end of the runs found so far that hold a place
    for q in range(1, n // repeats + 1):
        probes = x[::q]
        same = probes[1:] == probes[:-1]
        k = len(same) - repeats + 2
        if k <= 0 or not same.any():
            continue
        row = same[:k].copy()
        for d in range(1, repeats - 1):
            row &= same[d:d + k]
        at = np.flatnonzero(row) * q
        last = (repeats - 1) * q
        for d in {q // 2, q - 1, q // 3} - {0}:  # the words between must be alike too
            if len(at) > 1:
                at = at[(x[at + d] == x[at + d + q]) & (x[at + last - q - d] == x[at + last - d])]
        at = at[reach[at] <= at + last]
        done = -1
        for i in at.tolist():
            if i < done:
                continue
            lo, hi = _stretch(x, i, q)
            done = hi
            length = hi - lo + q
            if hi + q > i + last and length >= max(least, repeats * q):
                out.append((lo, length, q))
                reach[lo:lo + length] = np.maximum(reach[lo:lo + length], lo + length)
    return out


def runs_of(words: list, repeats: int = 4, least: int = 6) -> list[tuple[int, int, int]]:
    """All runs ``(start, length, period)`` of a list of words, by start, then period."""
    import numpy as np

    number: dict = {}
    codes = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    out = []
    for a, b in stable_segments(codes, repeats, least):
        out += [(a + start, length, q) for start, length, q in lag_scan(codes[a:b], repeats, least)]
    return sorted(out, key=lambda r: (r[0], r[2]))


def periodic_runs(docs: DataFrame, repeats: int = 4, least: int = 6, doc_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The runs of every whole text, and the text with each run cut down to its first period.

    Words are what white space (space, tab, line feeds, form feed, carriage
    return) parts.  Returns per row of ``docs``: ``doc_id`` (of its own type),
    ``n_words``, ``runs`` (an array of ``start, length, period``, counted in words
    from 0, by start, then period) and ``collapsed``: the words that no run
    holds after its first ``period`` words, joined by single spaces.

    ``repeats`` is at least 3.  A null or empty text has no words, no runs and an
    empty ``collapsed``.  Null ids and repeated rows are kept, a result each.  Runs
    of unlike periods may overlap; a word is dropped if any of them says so.
    An empty table gives an empty one.  Other columns are left out.
    """
    if repeats < 3:
        raise ValueError(f"repeats must be at least 3, got {repeats}")
    small_batches(docs.sparkSession)

    def scan(batches):
        import numpy as np
        import pyarrow as pa

        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        for b in batches:
            n_words, found, collapsed = [], [], []
            for text in b.column("text").to_pylist():
                words = (text or b"").split()
                runs = runs_of(words, repeats, least)
                n_words.append(len(words))
                found.append([{"start": s, "length": n, "period": q} for s, n, q in runs])
                if runs:
                    keep = np.ones(len(words), bool)
                    for s, n, q in runs:
                        keep[s + q:s + n] = False
                    words = [words[i] for i in np.flatnonzero(keep).tolist()]
                collapsed.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(found, kind), pa.array(collapsed, pa.binary())],
                                             ["doc_id", "n_words", "runs", "collapsed"])

    rows = docs.select(F.col(doc_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    schema = StructType([rows.schema["doc_id"]]).add("n_words", LongType()).add("runs", ArrayType(RUN)).add("collapsed", BinaryType())
    return rows.mapInArrow(tidy(scan), schema).withColumn("collapsed", F.col("collapsed").cast("string"))


def strongest_run(runs: str | Column) -> Column:
    """The run that holds its period most often, compared as exact fractions; the first one where several do; null without runs."""
    none = F.lit(None).cast(RUN)
    more = lambda best, r: best["period"].isNull() | (r["length"] * best["period"] > best["length"] * r["period"])
    return F.aggregate(runs, none, lambda best, r: F.when(more(best, r), r).otherwise(best))


def runs_digest(runs: str | Column) -> Column:
    """SHA-256 of a line ``start,length,period`` per run."""
    line = lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))
    return F.sha2(F.array_join(F.transform(runs, line), ""), 256)


def with_planted_runs(docs: DataFrame, doc_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Texts of documents whose id's CRC-32 ``h`` (of its decimal form) is divisible by 10 made periodic; all others as they are.

    With ``g = h div 10`` and the ``n > 0`` words of the text, each word ``i`` from
    ``a = g % n`` on becomes word ``a + (i - a) % p``, where ``p = 1 + (n - a) div
    (3 + g % 8)``.  A null id or text leaves a text as it is.
    """
    h = F.crc32(F.col(doc_col).cast("string").cast("binary"))
    words = F.regexp_extract_all(text_col, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    picked = docs.withColumn("_g", F.when(h % 10 == 0, F.floor(h / 10))).withColumn("_w", F.when(F.col("_g").isNotNull(), words))
    n = F.size("_w").cast("long")
    sized = picked.withColumn("_a", F.when(n > 0, F.col("_g") % n)).withColumn("_p", F.when(n > 0, 1 + F.floor((n - F.col("_a")) / (3 + F.col("_g") % 8))))
    at = lambda i: F.when(i < F.col("_a"), i).otherwise(F.col("_a") + (i - F.col("_a")) % F.col("_p"))
    periodic = F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.get("_w", at(i).cast("int"))), " ")
    return sized.withColumn(text_col, F.when(F.col("_a").isNotNull(), periodic).otherwise(F.col(text_col))).drop("_g", "_w", "_a", "_p")
