"""Benchmark decontamination with a distributed positional inverted index.

The index holds, per term and document, the positions of the term.  A first
pass counts every benchmark term over the whole corpus; each benchmark window
is then looked up by its rarest terms.  The second pass stores those terms'
postings.  Offset-adjusted intersection, rarest first: a posting of the rarest
term proposes a place at which the item would start, and only places that the
next rarest term's postings propose too are kept.  What is left is compared
word by word with the documents, which gives exact phrase matches (and, on
request, proximity matches).

Benchmark items are the query set: they go to all tasks in blocks of at most
about ``BLOCK_WORDS`` words, one pass over the corpus each.
"""

from __future__ import annotations

from itertools import repeat

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from sluice.llm.common import Scratch, id_key, restored, small_frame, text_hash, tidy

BLOCK_WORDS = 2_000_000
BROADCAST_PLACES = 500_000
"""Proposed places that may be sent to all executors; more are joined by a shuffle."""
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
WORDS = bytes(b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in LOWER)


def _words(text: bytes | None) -> list[bytes]:
    """Words: A-Z lower-cased, then runs of 0-9, a-z and bytes from 0x80 on."""
    return text.translate(WORDS).split() if text else []


def _in_order(items: set) -> list:
    return sorted(items - {None}) + [None] * (None in items)


class Queries:
    """One block of benchmark items as term sequences, with the anchors its windows are looked up by."""

    def __init__(self, items: list[tuple], window: int):
        self.window, self.vocab, self.sequences, self.owners = window, {}, [], []
        known: dict[tuple, int] = {}
        for item_id, words in items:
            seq = tuple(self.vocab.setdefault(w, len(self.vocab)) for w in words)
            if not seq:
                continue
            if seq not in known:
                known[seq] = len(self.sequences)
                self.sequences.append(seq)
                self.owners.append(set())
            self.owners[known[seq]].add(item_id)

    def anchors(self, count: dict[int, int]) -> set[tuple[int, int, int, int, int]]:
        """``(sequence, term, offset, second term, its offset)`` for each window; -1 where a window has one term only."""
        out = set()
        for q, seq in enumerate(self.sequences):
            n = min(self.window, len(seq))
            for a in range(len(seq) - n + 1):
                rare = sorted(range(a, a + n), key=lambda i: (count.get(seq[i], 0), seq[i], i))
                first = rare[0]
                second = next((i for i in rare if seq[i] != seq[first]), -1)
                out.add((q, seq[first], first, seq[second] if second >= 0 else -1, second))
        return out


def _term_ids(words: list[bytes], vocab: dict, none: int):
    import numpy as np

    return np.fromiter(map(vocab.get, words, repeat(none)), np.int32, len(words))


def term_counts(texts: DataFrame, vocab: dict[bytes, int]) -> dict[int, int]:
    """Occurrences of each vocabulary term over all documents."""
    def count(frames):
        import numpy as np
        import pandas as pd

        n = len(vocab)
        total = np.zeros(n + 1, np.int64)
        for pdf in frames:
            for t in pdf["text"]:
                total += np.bincount(_term_ids(_words(t), vocab, n), minlength=n + 1)
        seen = np.flatnonzero(total[:n])
        yield pd.DataFrame({"term": seen, "n": total[seen]})

    rows = texts.select("text").mapInPandas(tidy(count), "term int, n long").groupBy("term").agg(F.sum("n").alias("n"))
    return {r["term"]: r["n"] for r in rows.collect()}


def postings(texts: DataFrame, vocab: dict[bytes, int], terms: set[int] | None = None) -> DataFrame:
    """The index: ``term, id, th, positions`` for the given terms (None: all of the vocabulary).

    Each document also has an entry for term -1, whose one position is its number of words.
    """
    def index(frames):
        import numpy as np
        import pandas as pd

        n = len(vocab)
        wanted = np.zeros(n + 1, bool)
        wanted[list(terms) if terms is not None else slice(0, n)] = True
        for pdf in frames:
            rows = []
            for doc, th, text in zip(pdf["id"], pdf["th"], pdf["text"]):
                ids = _term_ids(_words(text), vocab, n)
                rows.append((-1, doc, th, [len(ids)]))
                at = np.flatnonzero(wanted[ids])
                if len(at):
                    at = at[np.argsort(ids[at], kind="stable")]
                    term = ids[at]
                    cut = np.flatnonzero(term[1:] != term[:-1]) + 1
                    rows += [(int(ids[p[0]]), doc, th, p) for p in np.split(at, cut)]
            yield pd.DataFrame(rows, columns=["term", "id", "th", "positions"])

    return texts.mapInPandas(tidy(index), "term int, id string, th long, positions array<int>")


def _ints(*names: str) -> StructType:
    return StructType([StructField(n, IntegerType()) for n in names])


def _places(index: DataFrame, anchors: set, spark) -> DataFrame:
    """``id, th, q, at``: sequence ``q`` would start at word ``at``, as both anchors of one of its windows say."""
    rows = sorted(anchors)
    first = [(q, t, o, k, 1 if t2 >= 0 else 3) for k, (q, t, o, t2, o2) in enumerate(rows)]
    second = [(q, t2, o2, k, 2) for k, (q, t, o, t2, o2) in enumerate(rows) if t2 >= 0]
    anchor = small_frame(spark, first + second, _ints("q", "term", "off", "pair", "side"))
    said = (index.where("term >= 0").join(F.broadcast(anchor), "term")
            .select("id", "th", "q", "pair", "side", F.explode("positions").alias("p"), "off")
            .select("id", "th", "q", "pair", "side", (F.col("p") - F.col("off")).alias("at")))
    both = said.groupBy("id", "th", "q", "pair", "at").agg(F.bit_or("side").alias("sides")).where("sides = 3")
    return both.select("id", "th", "q", "at").distinct()


def _phrase_hits(queries: Queries):
    """Per document the words inside occurrences of windows, as ``n_hit``, and the items that have such windows."""
    def check(frames):
        import numpy as np
        import pandas as pd

        vocab, n = queries.vocab, len(queries.vocab)
        sequences = [np.array(s, np.int32) for s in queries.sequences]
        for pdf in frames:
            rows = []
            for doc, th, text, places in zip(pdf["id"], pdf["th"], pdf["text"], pdf["places"]):
                ids = _term_ids(_words(text), vocab, n)
                hit, items = np.zeros(len(ids) + 1, np.int64), set()
                for place in places:
                    q, at = place["q"], place["at"]
                    seq = sequences[q]
                    need = min(queries.window, len(seq))
                    a, b = max(0, -at), min(len(seq), len(ids) - at)
                    if b - a < need:
                        continue
                    same = np.concatenate(([False], ids[at + a:at + b] == seq[a:b], [False]))
                    turn = np.flatnonzero(same[1:] != same[:-1])
                    for x, y in zip(turn[::2], turn[1::2]):
                        if y - x >= need:
                            hit[at + a + x] += 1
                            hit[at + a + y] -= 1
                            items |= queries.owners[q]
                if items:
                    spans = np.flatnonzero(np.diff(np.concatenate(([0], np.cumsum(hit)[:-1] > 0, [0])).astype(np.int8)))
                    rows.append((doc, th, spans.tolist(), _in_order(items)))
            yield pd.DataFrame(rows, columns=["id", "th", "spans", "items"])

    return check


def _near_hits(queries: Queries, slop: int):
    """As ``_phrase_hits`` for windows whose words all lie, in any order, within ``slop`` words more than the window has."""
    def check(frames):
        from collections import Counter

        import pandas as pd

        for pdf in frames:
            rows = []
            for doc, th, text, places in zip(pdf["id"], pdf["th"], pdf["text"], pdf["places"]):
                words = [queries.vocab.get(w, -1) for w in _words(text)]
                spans, items = set(), set()
                for q in {p["q"] for p in places}:
                    seq = queries.sequences[q]
                    n = min(queries.window, len(seq))
                    for a in range(len(seq) - n + 1):
                        need = Counter(seq[a:a + n])
                        have, left, missing = Counter(), 0, n
                        for right, w in enumerate(words):
                            have[w] += 1
                            missing -= have[w] <= need.get(w, 0)
                            while right - left >= n + slop:
                                missing += have[words[left]] <= need.get(words[left], 0)
                                have[words[left]] -= 1
                                left += 1
                            if not missing:
                                spans.add((left, right + 1))
                                items |= queries.owners[q]
                if items:
                    flat, end = [], -1
                    for x, y in sorted(spans):
                        if x > end:
                            flat += [x, y]
                        else:
                            flat[-1] = max(flat[-1], y)
                        end = flat[-1]
                    rows.append((doc, th, flat, _in_order(items)))
            yield pd.DataFrame(rows, columns=["id", "th", "spans", "items"])

    return check


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10, slop: int | None = None,
                       doc_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """Per row of ``docs``: ``doc_id, text_hash, n_words, n_hit, n_items, items, spans, contaminated``.

    A window is ``window`` consecutive words of a benchmark item (an item of
    fewer, but not none, is one window).  ``spans`` are the documents' word
    ranges ``[a, b, a, b, ...)`` inside occurrences of windows, ``n_hit`` the
    words in them, ``items`` the sorted ids of items with occurring windows.
    With ``slop`` set, a window also occurs where its words lie in any order
    within ``slop`` words more than it has.  Null texts have no words; items
    with a null id count as one item, listed as null; rows that repeat an id and
    a text get equal results.  An empty benchmark hits nothing.  Other columns
    are left out.
    """
    spark = docs.sparkSession
    tmp = Scratch(spark, "contamination")
    docs = docs.select(F.col(doc_col).alias("doc_id"), F.col(text_col).alias("text"))
    texts = docs.select(id_key("doc_id").alias("id"), text_hash("text").alias("th"),
                        F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    item_type = benchmark.schema[item_col].dataType.simpleString()
    items = benchmark.select(F.col(item_col).alias("item"), F.col("text").cast("binary").alias("text")).where("text is not null").distinct()
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // (6 * BLOCK_WORDS)))
    hits, lengths = [], None
    for b in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == b) if blocks > 1 else items
        queries = Queries([(r["item"], _words(bytes(r["text"]))) for r in part.collect()], window)
        anchors = queries.anchors(term_counts(texts, queries.vocab)) if queries.sequences else set()
        terms = {a[1] for a in anchors} | ({a[3] for a in anchors if a[3] >= 0} if slop is None else set())
        index = tmp.keep(postings(texts, queries.vocab, terms).sortWithinPartitions("term"), "postings")
        if lengths is None:
            lengths = index.where("term = -1").select("id", "th", F.col("positions")[0].cast("long").alias("n_words"))
        if not queries.sequences:
            continue
        if slop is None:
            places = _places(index, anchors, spark)
        else:
            by_term = small_frame(spark, sorted({(a[0], a[1]) for a in anchors}), _ints("q", "term"))
            places = index.where("term >= 0").join(F.broadcast(by_term), "term").select("id", "th", "q", F.lit(0).alias("at")).distinct()
        places = tmp.keep(places.groupBy("id", "th").agg(F.collect_list(F.struct("q", "at")).alias("places")), "places")
        total = places.agg(F.sum(F.size("places"))).first()[0] or 0
        to_check = texts.join(F.broadcast(places) if total <= BROADCAST_PLACES else places, ["id", "th"])
        check = _phrase_hits(queries) if slop is None else _near_hits(queries, slop)
        hits.append(tmp.keep(to_check.mapInPandas(tidy(check), f"id string, th long, spans array<int>, items array<{item_type}>"), "hits"))
    if hits:
        found = hits[0].dropDuplicates(["id", "th"])
        for h in hits[1:]:
            found = found.unionByName(h.dropDuplicates(["id", "th"]))
        if len(hits) > 1:
            found = found.groupBy("id", "th").agg(F.flatten(F.collect_list("spans")).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
            found = found.withColumn("spans", _merged("spans"))
    else:
        found = spark.createDataFrame([], f"id string, th long, spans array<int>, items array<{item_type}>")
    none = F.array().cast
    out = lengths.join(found, ["id", "th"], "left")
    spans, listed = F.coalesce("spans", none("array<int>")), F.coalesce("items", none(f"array<{item_type}>"))
    hit = F.aggregate(F.transform(spans, lambda x, i: F.when(i % 2 == 1, x).otherwise(-x)), F.lit(0).cast("long"), lambda s, x: s + x)
    return out.select(restored("id", docs.schema["doc_id"].dataType).alias("doc_id"), F.col("th").alias("text_hash"), "n_words", hit.alias("n_hit"), F.size(listed).cast("long").alias("n_items"),
                      listed.alias("items"), spans.alias("spans"), (hit > 0).alias("contaminated"))


def _merged(spans: str):
    """Word ranges of several blocks, in one sorted list without overlaps."""
    pairs = F.array_sort(F.transform(F.sequence(F.lit(0), F.greatest(F.size(spans) / 2 - 1, F.lit(0)).cast("int")), lambda i: F.struct(
        F.element_at(spans, (2 * i + 1).cast("int")).alias("a"), F.element_at(spans, (2 * i + 2).cast("int")).alias("b"))))
    step = lambda s, x: F.when((F.size(s) > 0) & (F.element_at(s, -1) >= x["a"]), F.concat(
        F.slice(s, 1, F.size(s) - 1), F.array(F.greatest(F.element_at(s, -1), x["b"])))).otherwise(F.concat(s, F.array(x["a"], x["b"])))
    return F.aggregate(pairs, F.array().cast("array<int>"), step)


def items_digest(items: str = "items"):
    """SHA-256 of the item ids, sorted as strings and comma-joined."""
    return F.sha2(F.concat_ws(",", F.array_sort(F.transform(items, lambda x: x.cast("string")))), 256)
