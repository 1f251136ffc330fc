"""Near-duplicates by SimHash fingerprints and multi-index hashing.

A fingerprint of 64 bits is cut into ``m`` segments.  Fingerprints at most
``d`` bits apart agree in some segment but for ``d // m`` bits, so each
fingerprint is stored in one table per segment under that segment's value and
probes the tables with every value in the Hamming ball of that radius around
its own; whatever a probe meets is checked on all 64 bits.

Equal fingerprints are one entry.  Entries meet their probes in a sort by
(segment, value); a value with many entries is dealt to several tasks, each
holding some of its entries and meeting all of its probes.  A task returns,
instead of all pairs that link, a spanning forest of them, so a large group of
near copies yields as many links as it has fingerprints (times its tasks).
"""

from __future__ import annotations

from itertools import accumulate, combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import Scratch, id_key, restored, text_hash, tidy
from sluice.llm.components import components

BITS = 64
LARGE = 1 << 12
"""Pairs of a bucket that are compared in one go with other buckets' pairs; larger buckets are searched one by one."""
HOT = 1 << 12
"""Table entries of a segment value that one task holds; more are dealt to several, each of which meets all probes of the value."""
BLOCK_BITS = 20
BROADCAST_HOT = 200_000


def fingerprints(docs: DataFrame, words: int = 4, seed: int = 42, doc_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``text_hash`` (XXH64) and ``fp`` (64 bits as a signed long) of each row.

    A-Z are lower-cased, words are runs of other than space and \\x09-\\x0D;
    each shingle of ``words`` words (repeats included; one shingle of all words
    if there are fewer) votes by the bits of its XXH64.  A bit is 1 if over
    half the votes are.  Without words, as for null, the fingerprint is 0.
    """
    def fingerprint(text: bytes) -> int:
        import numpy as np
        from xxhash import xxh64_intdigest

        tokens = text.lower().split()
        if not tokens:
            return 0
        flat = b" ".join(tokens)
        ends = list(accumulate(map(len, tokens), lambda a, b: a + b + 1))
        starts = [0, *(e + 1 for e in ends[:-1])]
        ends = ends[words - 1:] or ends[-1:]
        ones = np.zeros(BITS, np.int64)
        for k in range(0, len(ends), 1 << 14):
            h = np.array([xxh64_intdigest(flat[a:b], seed) for a, b in zip(starts[k:k + (1 << 14)], ends[k:k + (1 << 14)])], "<u8")
            ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        return int.from_bytes(np.packbits(2 * ones > len(ends), bitorder="little").tobytes(), "little", signed=True)

    def batches(frames):
        import pandas as pd

        for pdf in frames:
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "text_hash": pdf["text_hash"], "fp": [fingerprint(t) for t in pdf["text"]]})

    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text")
    rows = docs.select(id_key(doc_col).alias("doc_id"), text_hash(text_col).alias("text_hash"), text)
    out = rows.mapInPandas(tidy(batches), "doc_id string, text_hash long, fp long")
    return out.withColumn("doc_id", restored("doc_id", docs.schema[doc_col].dataType))


def _segments(m: int) -> list[tuple[int, int]]:
    """(shift, width) of ``m`` segments that cover the 64 bits."""
    cuts = [round(BITS * k / m) for k in range(m + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _ball(width: int, radius: int) -> list[int]:
    return [sum(1 << i for i in c) for r in range(radius + 1) for c in combinations(range(width), r)]


def _forest(max_bits: int):
    """For rows ``(key, probe, fp)`` sorted by key: links that connect what a key's table entries and probes connect."""
    import numpy as np
    import pandas as pd

    def near(a, b):
        return np.bitwise_count((a ^ b).view(np.uint64)) <= max_bits

    def search(probes, table):
        """Spanning links of one large bucket, by growing one component at a time; a node is dropped once reached."""
        links, left_p, left_t = [], probes, table
        while len(left_t):
            frontier_t, frontier_p, left_t = left_t[:1], left_p[:0], left_t[1:]
            while len(frontier_t) or len(frontier_p):
                new_p, new_t = [], []
                for f in frontier_t:
                    hit = near(left_p, f)
                    got = left_p[hit]
                    links.append(np.stack([np.full(len(got), f), got], 1))
                    new_p.append(got)
                    left_p = left_p[~hit]
                for f in frontier_p:
                    if not len(left_t):
                        break
                    hit = near(left_t, f)
                    got = left_t[hit]
                    links.append(np.stack([np.full(len(got), f), got], 1))
                    new_t.append(got)
                    left_t = left_t[~hit]
                frontier_p = np.concatenate(new_p) if new_p else left_p[:0]
                frontier_t = np.concatenate(new_t) if new_t else left_t[:0]
        return links

    def forest(a, b):
        """Of links in sorted order, those that join what earlier ones left apart."""
        up, keep = {}, []

        def root(x):
            while up.get(x, x) != x:
                up[x] = up.get(up[x], up[x])
                x = up[x]
            return x

        for x, y in zip(a.tolist(), b.tolist()):
            rx, ry = root(x), root(y)
            if rx != ry:
                up[rx] = ry
                keep.append((x, y))
        return np.array(keep, np.int64).reshape(-1, 2)

    def bucket_links(key, probe, fp):
        edge = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        size = np.diff(np.append(edge, len(key)))
        stored = np.add.reduceat((~probe).astype(np.int64), edge)
        out = []
        # Rows of a key: table entries first, then probes.
        pairs = stored * (size - stored)
        small = np.flatnonzero((pairs > 1) & (pairs <= LARGE))
        for part in np.array_split(small, max(1, int(pairs[small].sum()) >> 20)):
            n = pairs[part]
            b = np.repeat(part, n)
            k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            t = fp[edge[b] + k % stored[b]]
            p = fp[edge[b] + stored[b] + k // stored[b]]
            ok = near(t, p) & (t != p)
            out.append(forest(t[ok], p[ok]))
        for b in np.flatnonzero(pairs > LARGE):
            rows = fp[edge[b]:edge[b] + size[b]]
            out += search(rows[stored[b]:], rows[:stored[b]])
        links = np.concatenate(out) if out else np.empty((0, 2), np.int64)
        return links[links[:, 0] != links[:, 1]]

    def batches(frames):
        held = []  # rows of keys that may go on in the next batch; all but the first batch's are of one key
        for pdf in frames:
            rows = tuple(pdf[c].to_numpy() for c in ("key", "probe", "fp"))
            if not len(rows[0]):
                continue
            if held and held[-1][0][-1] == rows[0][-1]:
                held.append(rows)
                continue
            key, probe, fp = (np.concatenate(x) for x in zip(*held, rows))
            cut = np.searchsorted(key, key[-1])
            held = [(key[cut:], probe[cut:], fp[cut:])]
            if cut:
                yield pd.DataFrame(bucket_links(key[:cut], probe[:cut], fp[:cut]), columns=["a", "b"])
        if held:
            yield pd.DataFrame(bucket_links(*(np.concatenate(x) for x in zip(*held))), columns=["a", "b"])

    return batches


def near_links(fps: DataFrame, max_bits: int, m: int, tmp: Scratch) -> DataFrame:
    """Links ``(a, b)`` that connect the distinct ``fp`` that chains of steps of at most ``max_bits`` bits connect."""
    def key(i: int, shift: int, width: int):
        value = F.shiftrightunsigned("fp", shift).bitwiseAND(F.lit((1 << width) - 1))
        return (F.lit(i << 40) + value).cast("long")

    def ball(base, width: int):
        masks = F.array(*[F.lit(x).cast("long") for x in _ball(width, max_bits // m)])
        return F.transform(masks, lambda x: F.struct(base.bitwiseXOR(x).alias("key"), F.lit(True).alias("probe")))

    stored, probes = [], []
    for i, (shift, width) in enumerate(_segments(m)):
        base = key(i, shift, width)
        stored.append(F.struct(base.alias("key"), F.lit(False).alias("probe")))
        probes.append(ball(base, width))
    entries = fps.select(F.explode(F.array(*[s["key"] for s in stored])).alias("key"))
    hot = tmp.keep(entries.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / HOT).cast("int").alias("blocks")).where("blocks > 1"), "hot")
    n = hot.count()
    rows = fps.select("fp", F.explode(F.concat(F.array(*stored), *probes)).alias("e")).select("e.key", "e.probe", "fp")
    if n:
        # An entry goes to one block of its value, a probe to all.
        dealt = rows.join(F.broadcast(hot) if n <= BROADCAST_HOT else hot, "key", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
        own = F.array(F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
        block = F.explode(F.when(F.col("probe"), F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(own)).alias("block")
        rows = dealt.select("key", "probe", "fp", block).select((F.shiftleft("key", BLOCK_BITS) + F.col("block")).alias("key"), "probe", "fp")
    return rows.repartition("key").sortWithinPartitions("key", "probe").mapInPandas(tidy(_forest(max_bits)), "a long, b long")


def near_duplicates(docs: DataFrame, max_bits: int = 4, words: int = 4, seed: int = 42, segments: int | None = None,
                    doc_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``text_hash``, ``fp``, ``component_id`` (the smallest id reachable by links of at most ``max_bits`` bits) and ``component`` (its smallest fingerprint).

    Rows without words share fingerprint 0 and link like any other.  A null id
    is no smallest id unless all ids reachable are null; repeated rows get equal
    results.  Other columns are left out.  With ``segments`` unset, three are
    used up to 2**27 distinct fingerprints and two beyond (a segment should have
    about as many bits as it takes to number the fingerprints).
    """
    tmp = Scratch(docs.sparkSession, "simhash")
    prints = tmp.keep(fingerprints(docs, words, seed, doc_col, text_col), "fingerprints")
    distinct = tmp.keep(prints.groupBy("fp").agg(F.min("doc_id").alias("low")), "distinct")
    m = segments or (3 if distinct.count() <= 1 << 27 else 2)
    classes = components(near_links(distinct, max_bits, m, tmp), tmp).withColumnRenamed("node", "fp")
    named = distinct.join(classes, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    smallest = named.groupBy("component").agg(F.min("low").alias("component_id"))
    named = named.join(smallest, "component").select("fp", "component_id", "component")
    return prints.join(named, "fp").select("doc_id", "text_hash", "fp", "component_id", "component")


def hex_digits(fp: str = "fp"):
    return F.lpad(F.lower(F.hex(F.col(fp))), 16, "0")
