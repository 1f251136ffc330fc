"""Best-fit packing of tokenised documents into sequences of bounded length.

Bulk-synchronous best-fit.  Pieces are sorted by length, open sequences by their
gap (free places).  A round takes the longest length that is left.  A successor
sweep over the gap sizes hands it the smallest gaps that take it, tightest
first; its pieces compete by rank: piece ``i`` of a length takes gap ``i // m`` of
those handed to it, ``m`` pieces to a gap when several fit, and pieces for which
no gap is left open new sequences.  Then gaps are updated and the next round
begins, until no piece is left, so a gap is offered to all lengths that come
after it was made.

Rounds see only counts: at most ``max_len`` lengths and ``max_len`` gap sizes,
whatever the corpus holds, so they need no pass over the pieces.  Each piece
then finds its sequence from its rank within its length (``ranks.py``), which is
made of counts by task: no length, however common, is gathered or sorted.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import deque

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from sluice.llm.common import Scratch, small_batches, tidy
from sluice.llm.ranks import RANK_FIELDS, TaskRanks, numbered_by_task, placed, ranked
from sluice.llm.tokens import WordEncoder


def token_pieces(docs: DataFrame, tokenizer: str, max_len: int = 2048, end_id: int = 0,
                 doc_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """Tokenise whole texts, end each with ``end_id`` and cut what is longer than ``max_len``.

    Returns per piece: the document's id, ``piece`` (from 0), ``start`` (ids of
    its document before it), ``length``, ``ids_crc32`` over its ids as
    little-endian 32-bit, with ``keep_ids`` the ``ids`` themselves, and its number
    among the pieces of its length in its task (``_part, _nth``).  A null or empty
    text is one piece holding ``end_id``.  Null ids and repeated rows are kept;
    each row is a document of its own.  Other columns are left out.
    """
    small_batches(docs.sparkSession)
    end = int(end_id).to_bytes(4, "little")
    cols = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * keep_ids

    def pieces(batches):
        import pyarrow as pa

        enc, ranks = WordEncoder(tokenizer), TaskRanks()
        kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64()] + [pa.list_(pa.int64())] * keep_ids
        for b in batches:
            rows, source = [], []
            for doc, ids in enumerate(enc.encode([t or "" for t in b.column("text").to_pylist()])):
                ids += end
                for k, a in enumerate(range(0, len(ids), 4 * max_len)):
                    part = ids[a:a + 4 * max_len]
                    rows.append((k, a // 4, len(part) // 4, zlib.crc32(part), *([[*memoryview(part).cast("I")]] * keep_ids)))
                    source.append(doc)
            made = [pa.array(x, t) for x, t in zip(list(zip(*rows)) or [[]] * len(kinds), kinds)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id").take(pa.array(source, pa.int64())), *made, *ranks.columns(made[2].to_numpy())], [*cols, "_part", "_nth"])

    rows = docs.select(F.col(doc_col).alias("doc_id"), F.col(text_col).alias("text"))
    kinds = {"piece": IntegerType(), "ids": ArrayType(LongType())}
    schema = StructType([rows.schema["doc_id"], *[StructField(c, kinds.get(c, LongType())) for c in cols[1:]], *RANK_FIELDS])
    return rows.mapInArrow(tidy(pieces), schema)


def match(lengths: dict[int, int], max_len: int) -> list[tuple[int, int, int, int, int]]:
    """Rounds over so many pieces of each length: entries ``(length, lo, per, first, offset)`` of ``ranks.placed``."""
    sizes: list[int] = []  # of the gaps there are, sorted
    gaps: dict[int, deque] = {}  # by size the open sequences, as ranges (first, how many)
    opened, out = 0, []

    def update(size: int, first: int, n: int) -> None:
        if size and n:
            if not gaps.get(size):
                gaps[size] = deque()
                insort(sizes, size)
            gaps[size].append((first, n))

    for length in sorted(lengths, reverse=True):
        lo, n, made = 0, lengths[length], []
        while lo < n:
            at = bisect_left(sizes, length)
            if at < len(sizes):
                size = sizes[at]
                first, most = gaps[size].popleft()
            else:
                size, first, most = max_len, opened, n
            per = size // length
            use = min(most, -(-(n - lo) // per))
            if at == len(sizes):
                opened += use
            elif use < most:
                gaps[size].appendleft((first + use, most - use))
            elif not gaps[size]:
                sizes.pop(at)
            out.append((length, lo, per, first, max_len - size))
            full, rest = divmod(min(n - lo, use * per), per)
            made += [(size - per * length, first, full), (size - rest * length, first + full, 1 if rest else 0)]
            lo = min(n, lo + use * per)
        for gap in made:
            update(*gap)
    return out


def pack(pieces: DataFrame, max_len: int = 2048) -> DataFrame:
    """Give each row of ``pieces`` (any columns beside ``length``, 1 to ``max_len``) a ``sequence_id`` and an ``offset``.

    Sequences are numbered from 0 without gaps; within a sequence, offsets are
    gapless from 0.  Pieces of equal length take their places in any order.
    Columns named ``sequence_id``, ``offset`` or ``_part, _nth, _rank`` are
    replaced.  An empty table gives an empty one.
    """
    own = pieces.drop("sequence_id", "offset", "_part", "_nth", "_rank")
    return _packed(numbered_by_task(own), max_len)


def _packed(pieces: DataFrame, max_len: int) -> DataFrame:
    tmp = Scratch(pieces.sparkSession, "pack")
    rows, lengths = ranked(tmp.keep(pieces, "pieces"), tmp)
    return placed(rows, match(lengths, max_len)).select(*[c for c in pieces.columns if c not in ("_part", "_nth")], "sequence_id", "offset")


def pack_documents(docs: DataFrame, tokenizer: str, max_len: int = 2048, end_id: int = 0,
                   doc_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """Tokenise, cut and pack ``docs``: the columns of ``token_pieces`` but for the task's numbers, with ``sequence_id`` and ``offset``."""
    return _packed(token_pieces(docs, tokenizer, max_len, end_id, doc_col, text_col, keep_ids), max_len)
