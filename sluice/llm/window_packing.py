"""Best-fit decreasing packing of tokenised documents into windows, by a segment tree over remaining capacity.

Overlong documents are first cut into full windows and a rest.  Pieces are then
placed by falling length, each into the open window with the least remaining
capacity that still takes it, or into a new window.

The leaves of the segment tree are the remaining capacities 0 to the window's
length, and each holds the open windows with that capacity as ranges of window
numbers; an inner node tells how many windows are open below it.  The tightest
window for a length is the first open leaf from that length on, found on the
way down.  Alike pieces are placed together: while a window keeps taking pieces
of a length it stays the tightest one, so ``capacity // length`` of them go into
each window of a leaf, as they would one by one.  The tree therefore sees no
piece, only how many there are of each length (one count per length up to the
window's), whatever the corpus holds; the pieces find their places from their
rank within their length (``ranks.py``).
"""

from __future__ import annotations

import zlib
from collections import deque

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from sluice.llm.common import Scratch, small_batches, tidy
from sluice.llm.ranks import RANK_FIELDS, TaskRanks, placed, ranked
from sluice.llm.tokens import ByteEncoder


class CapacityTree:
    """Open windows by remaining capacity."""

    def __init__(self, window: int):
        self.size = 1 << window.bit_length()
        self.open = [0] * (2 * self.size)
        self.ranges: list[deque] = [deque() for _ in range(window + 1)]

    def _add(self, capacity: int, n: int) -> None:
        i = capacity + self.size
        while i:
            self.open[i] += n
            i >>= 1

    def put(self, capacity: int, first: int, n: int) -> None:
        """Windows ``first`` to ``first + n - 1`` have that capacity left."""
        if n and capacity:
            self.ranges[capacity].append((first, n))
            self._add(capacity, n)

    def take(self, capacity: int, most: int) -> tuple[int, int]:
        """At most ``most`` windows of that capacity, as the first one's number and how many."""
        first, n = self.ranges[capacity].popleft()
        use = min(n, most)
        if use < n:
            self.ranges[capacity].appendleft((first + use, n - use))
        self._add(capacity, -use)
        return first, use

    def tightest(self, length: int) -> int | None:
        """The least capacity of an open window that takes ``length``."""
        i = length + self.size
        if not self.open[i]:
            # Up until there is something open to the right, then down to its leftmost leaf.
            while i > 1 and (i & 1 or not self.open[i + 1]):
                i >>= 1
            if i <= 1:
                return None
            i += 1
            while i < self.size:
                i *= 2
                if not self.open[i]:
                    i += 1
        return i - self.size


def best_fit_decreasing(lengths: dict[int, int], window: int) -> list[tuple[int, int, int, int, int]]:
    """Places for so many pieces of each length, as entries ``(length, lo, per, first, offset)`` of ``ranks.placed``."""
    tree, opened, out = CapacityTree(window), 0, []
    for length in sorted(lengths, reverse=True):
        lo, n = 0, lengths[length]
        while lo < n:
            capacity = tree.tightest(length)
            per = (capacity or window) // length
            most = -(-(n - lo) // per)
            if capacity is None:
                capacity, first, use = window, opened, most
                opened += use
            else:
                first, use = tree.take(capacity, most)
            out.append((length, lo, per, first, window - capacity))
            hi = min(n, lo + use * per)
            full, rest = divmod(hi - lo, per)
            tree.put(capacity - per * length, first, full)
            if rest:
                tree.put(capacity - rest * length, first + full, 1)
            lo = hi
    return out


def cut_documents(docs: DataFrame, tokenizer: str, window: int, end_id: int = 0, doc_col: str = "doc_id",
                  text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """Whole texts tokenised, ended by ``end_id`` and cut into full windows and a rest, with each piece's number among those of its length in its task."""
    small_batches(docs.sparkSession)
    end = int(end_id).to_bytes(4, "little")
    cols = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"] + ["ids"] * keep_ids

    def cut(batches):
        import pyarrow as pa

        enc, ranks = ByteEncoder(tokenizer), TaskRanks()
        for b in batches:
            rows, source = [], []
            for k, text in enumerate(b.column("text").to_pylist()):
                ids = enc.encode([text or ""])[0] + end
                for a in range(0, len(ids), 4 * window):
                    piece = ids[a:a + 4 * window]
                    rows.append((a // 4, len(piece) // 4, zlib.crc32(piece), len(ids) // 4, *([[*memoryview(piece).cast("I")]] * keep_ids)))
                    source.append(k)
            kinds = [pa.int64()] * 4 + [pa.list_(pa.int64())] * keep_ids
            made = [pa.array(x, t) for x, t in zip(list(zip(*rows)) or [[]] * len(kinds), kinds)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id").take(pa.array(source, pa.int64())), *made, *ranks.columns(made[1].to_numpy())], [*cols, "_part", "_nth"])

    rows = docs.select(F.col(doc_col).alias("doc_id"), F.col(text_col).alias("text"))
    made = [StructField(c, ArrayType(LongType()) if c == "ids" else LongType()) for c in cols[1:]]
    return rows.mapInArrow(tidy(cut), StructType([rows.schema["doc_id"], *made, *RANK_FIELDS]))


def pack_windows(docs: DataFrame, tokenizer: str, window: int = 1024, end_id: int = 0, doc_col: str = "doc_id",
                 text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """Pack ``docs`` into sequences of at most ``window`` tokens: a row per piece.

    Returns ``doc_id`` (of its own type), ``start`` (ids of its document before
    the piece), ``length``, ``ids_crc32`` (of the ids as little-endian unsigned
    32-bit numbers), ``doc_tokens`` (ids of the whole document, ``end_id``
    with them), with ``keep_ids`` the ``ids`` themselves, ``sequence_id`` (gapless
    from 0) and ``offset`` (place in the sequence, gapless from 0).

    Only documents longer than a window are cut.  A null or empty text is one
    piece holding ``end_id``; null ids and repeated rows are kept, each row being
    a document of its own; pieces of equal length take their places in any
    order.  An empty table gives an empty one.  Other columns are left out.
    """
    tmp = Scratch(docs.sparkSession, "windows")
    pieces = cut_documents(docs, tokenizer, window, end_id, doc_col, text_col, keep_ids)
    numbered, lengths = ranked(tmp.keep(pieces, "pieces"), tmp)
    return placed(numbered, best_fit_decreasing(lengths, window))


def padded_length(used: Column, window: int) -> Column:
    """Length that a sequence of ``used`` tokens is padded to: the window's, but a power of two stays as it is."""
    return F.when(used.bitwiseAND(used - 1) == 0, used).otherwise(F.lit(window).cast("long"))
