"""Sharding that keeps linked documents together, by balanced label propagation.

Documents with equal texts form a group, which moves as one.  Groups are linked
through the long lines that they share; a line stands between them, so that one
held by a third of all documents adds a link per document and no pairs.

Propagation.  From a scatter by hash, each round joins the lines with their
groups' present shards and the groups with their lines: a group's votes for a
shard are its neighbours' shares of each line there.  A group wants the shard
with most votes, if that beats its own.  Half of the groups may move in a round,
another half each time: neighbours that both moved would only change places.
Moves from shard to shard are added up
and cut to what leaves no shard above its capacity; groups are ranked, larger
ones first, and move whole up to that quota.  Votes are taken anew in the next
round, from where the groups are then.

Settlement.  Each group wants the shard it has come to, or one with room for all
of it, and is taken whole up to each shard's capacity, larger ones first; a group
that was refused wants another shard in the next round.  A group larger than a
shard fills shards of its own first, and its rest is a group like others.
Groups that no shard took whole go, with the unlinked documents, to wherever
places are left, one group after the other, so that counts differ by one at most
and fewer groups are cut than there are shards, besides those larger than one.

Rounds work on one row per group and one per link.  Everything is DataFrame
expressions; the driver sees counts per shard and the few groups that are cut.
"""

from __future__ import annotations

from functools import reduce
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import Scratch, blocks_for, numbered

LAW = "rows"
LINE = 40
"""Characters of a line that links the documents that hold it, at least."""
SCALE = 1 << 20
"""A line's votes in all, in whole numbers so that their sums do not depend on order."""


def _piece(number: Column, ends: list[tuple[int, int]]) -> Column:
    """The shard of a place by its number, from ``(end, shard)`` in order; numbers past the last end get the last shard."""
    out = F.lit(ends[-1][1])
    for end, shard in reversed(ends[:-1]):
        out = F.when(number < end, F.lit(shard)).otherwise(out)
    return out


def _allowed(wanted: list[list[int]], held: list[int], capacity: list[int]) -> list[list[int]]:
    """Of the moves wanted from shard to shard, the most that leave no shard above its capacity (or above what it held)."""
    moves, shards = [[*row] for row in wanted], range(len(held))
    while True:
        over = False
        for b in shards:
            come, go = sum(moves[a][b] for a in shards), sum(moves[b])
            surplus = min(come, held[b] + come - go - max(capacity[b], held[b] - go))
            if surplus > 0:
                over = True
                for a in shards:
                    # Each origin gives up its share, rounded up, while any surplus is left.
                    cut = min(moves[a][b], -(-surplus * moves[a][b] // come)) if come else 0
                    cut = min(cut, surplus)
                    come -= moves[a][b]
                    moves[a][b] -= cut
                    surplus -= cut
        if not over:
            return moves


def _running(groups: DataFrame, cls: str, rows: int) -> DataFrame:
    """Add ``upto``: the sum of ``size`` within each ``cls`` up to and with this group, larger groups first.

    Groups are ordered by the binary digits of their size, then by ``hub``.
    Blocks of about 200,000 groups, cut along that order, are summed on their
    own and shifted by the blocks before: the order is the same for any number of blocks.
    """
    bits = (blocks_for(rows) - 1).bit_length()
    blocked = groups.withColumns({"_digits": -F.length(F.bin("size")), "_blk": F.shiftright("hub", 64 - bits) if bits else F.lit(0).cast("long")})
    block = [cls, "_digits", "_blk"]
    before = Window.partitionBy(cls).orderBy("_digits", "_blk").rowsBetween(Window.unboundedPreceding, -1)
    sums = blocked.groupBy(*block).agg(F.sum("size").alias("_sum")).select(*block, F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_base"))
    within = Window.partitionBy(*block).orderBy("hub").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (blocked.withColumn("_within", F.sum("size").over(within)).join(sums, block)
            .withColumn("upto", F.col("_within") + F.col("_base")).drop("_digits", "_blk", "_within", "_base"))


def line_links(rows: DataFrame) -> DataFrame:
    """``hub, line`` for each line of at least ``LINE`` characters that several groups share; ``rows`` hold ``hub`` and ``text``."""
    line = F.explode(F.array_distinct(F.transform(F.split("text", "\n"), lambda x: F.trim(x)))).alias("line")
    links = rows.select("hub", line).where(F.char_length("line") >= LINE).select("hub", F.xxhash64("line").alias("line")).distinct()
    shared = links.groupBy("line").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("line")
    return links.join(shared, "line")


def neighbour_votes(links: DataFrame, state: DataFrame, shards: int) -> DataFrame:
    """``hub, votes``: for each linked group and shard the neighbours' shares of its lines there, from the groups' present places ``state(hub, size, shard)``."""
    placed = links.join(state, "hub")
    per_line = placed.groupBy("line").agg(F.sum("size").alias("all"), F.array(*[F.sum(F.when(F.col("shard") == s, F.col("size")).otherwise(0)) for s in range(shards)]).alias("there"))
    # Without its own documents a group's line has all - size left to vote.
    share = [F.floor(SCALE * (F.get("there", F.lit(s)) - F.when(F.col("shard") == s, F.col("size")).otherwise(0)) / (F.col("all") - F.col("size"))) for s in range(shards)]
    return placed.join(per_line, "line").groupBy("hub").agg(F.array(*[F.sum(v).cast("long") for v in share]).alias("votes"))


def propagate(links: DataFrame, state: DataFrame, capacity: list[int], rounds: int, rows: int, tmp: Scratch) -> DataFrame:
    """``state(hub, size, shard)`` after so many rounds of moves towards the neighbours' shards, or as many as change anything."""
    shards = range(len(capacity))
    for turn in range(rounds):
        votes = neighbour_votes(links, state, len(capacity))
        best = F.array_max(F.transform(F.sequence(F.lit(0), F.lit(len(capacity) - 1)), lambda s: F.struct(
            F.get("votes", s).alias("votes"), (s == F.col("shard")).alias("own"), F.xxhash64("hub", s).alias("pref"), s.alias("shard"))))
        mine = F.pmod(F.xxhash64("hub", F.lit(turn)), F.lit(2)) == 0
        wish = state.where(mine).join(votes, "hub").withColumn("target", best["shard"]).where("target <> shard")
        wish = tmp.keep(_running(wish.withColumn("way", F.col("shard") * len(capacity) + F.col("target")), "way", rows), "moves")
        held = {r["shard"]: r["n"] for r in state.groupBy("shard").agg(F.sum("size").alias("n")).collect()}
        moving, quota = wish, None
        while True:
            sums = {(r["shard"], r["target"]): r["n"] for r in moving.groupBy("shard", "target").agg(F.sum("size").alias("n")).collect()}
            flows = [[sums.get((a, b), 0) for b in shards] for a in shards]
            quota = _allowed(flows, [held.get(s, 0) for s in shards], capacity)
            if quota == flows:
                break
            # Groups move whole, so less may leave a shard than was counted on: cut again until the sums hold.
            moving = wish.where(F.col("upto") <= F.get(F.array(*[F.lit(q).cast("long") for row in quota for q in row]), F.col("way")))
        if not any(map(any, quota)):
            break
        moved = moving.select("hub", F.col("target").alias("_to"))
        state = tmp.keep(state.join(moved, "hub", "left").select("hub", "size", F.coalesce("_to", "shard").alias("shard")), "state")
    return state


def _propagate(groups: DataFrame, held: list[int], capacity: list[int], rows: int, tmp: Scratch) -> tuple[DataFrame, DataFrame, list[int]]:
    """One round over the groups not settled: (hub, shard) of those taken, the others, and what each shard then holds."""
    shards = range(len(held))
    room = F.array(*[F.lit(c - h).cast("long") for c, h in zip(capacity, held)])
    fitting = F.filter(F.sequence(F.lit(0), F.lit(len(held) - 1)), lambda s: F.get(room, s) >= F.col("size"))
    # Votes, and a preference that differs from group to group, so that ties do not all go one way.
    best = F.array_max(F.transform(fitting, lambda s: F.struct(
        F.coalesce(F.try_element_at("votes", s), F.lit(0)).alias("votes"), F.xxhash64("hub", s).alias("pref"), s.alias("shard"))))
    wish = groups.withColumn("target", best["shard"])
    ranked = _running(wish.where("target is not null"), "target", rows).unionByName(
        wish.where("target is null").withColumn("upto", F.lit(None).cast("long")))
    ranked = tmp.keep(ranked, "wishes")
    wanted = {r["target"]: r["n"] for r in ranked.groupBy("target").agg(F.sum("size").alias("n")).collect()}
    # The last place stands for the groups not settled, which hold no shard's room.
    moves = [[0] * (len(held) + 1) for _ in shards] + [[*(wanted.get(s, 0) for s in shards), 0]]
    quota = _allowed(moves, [*held, sum(wanted.values())], [*capacity, sum(wanted.values())])[-1]
    ranked_in = F.coalesce(F.col("upto") <= F.get(F.array(*[F.lit(q).cast("long") for q in quota]), F.col("target")), F.lit(False))
    taken = ranked.where(ranked_in).select("hub", "size", F.col("target").alias("shard"))
    more = {r["shard"]: r["n"] for r in taken.groupBy("shard").agg(F.sum("size").alias("n")).collect()}
    return taken.select("hub", "shard"), ranked.where(~ranked_in).drop("target", "upto"), [h + more.get(s, 0) for s, h in enumerate(held)]


def shard_documents(docs: DataFrame, shards: int = 8, rounds: int = 6, doc_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: ``doc_id, size, text_crc32, law, shard, slot, grown_shard``.

    ``size`` is the text's UTF-8 bytes plus 1, ``shard`` 0 to ``shards - 1``
    with counts at most one apart (the law "rows"), ``slot`` the row's place in
    its shard, gapless from 0; ``grown_shard`` is null under this law.  A null
    text counts as empty.  Repeated rows and rows with null ids are rows of
    their own.  A group of equal texts larger than a shard fills one and goes on
    in the next; of the others at most ``shards - 1`` are cut.  Documents that
    share lines of ``LINE`` characters move together as far as that allows, in
    ``rounds`` rounds at most.  Other columns are left out.
    """
    tmp = Scratch(docs.sparkSession, "shards")
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = tmp.keep(docs.select(
        F.col(doc_col).alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("hub"),
        F.monotonically_increasing_id().alias("node")), "rows")
    n = base.count()
    capacity = [n // shards + (s < n % shards) for s in range(shards)]

    links = tmp.keep(line_links(docs.select(F.xxhash64(text).alias("hub"), text.alias("text"))), "links")
    linked = links.select("hub").distinct().withColumn("linked", F.lit(True))
    sizes = base.groupBy("hub").agg(F.count(F.lit(1)).alias("size")).join(linked, "hub", "left").where("size > 1 or linked")
    state = tmp.keep(sizes.select("hub", "size", F.pmod(F.xxhash64("hub", F.lit(1)), F.lit(shards)).cast("int").alias("shard")), "state")
    state = propagate(links, state, capacity, rounds, state.count(), tmp)
    groups = tmp.keep(state.select("hub", "size", F.create_map("shard", F.col("size")).alias("votes")), "groups")
    # Groups larger than a shard, fewer than there are shards: each fills the next shards, and its rest is settled with the others.
    held, pieces, rest, s = [0] * shards, {}, {}, 0
    for r in groups.where(F.col("size") > capacity[0]).select("hub", "size").orderBy(F.desc("size"), "hub").collect():
        pieces[r["hub"]], rest[r["hub"]] = [], r["size"]
        while 0 < capacity[min(s, shards - 1)] <= rest[r["hub"]]:
            held[s] = capacity[s]
            pieces[r["hub"]].append((r["size"] - rest[r["hub"]] + capacity[s], s))
            rest[r["hub"]] -= capacity[s]
            s += 1
    left = groups
    if pieces:
        size = F.col("size")
        for hub, k in rest.items():
            size = F.when(F.col("hub") == hub, F.lit(k)).otherwise(size)
        left = groups.withColumn("size", size.cast("long")).where("size > 0")
    many, settled = left.count(), []
    for _ in range(rounds):
        before = held
        taken, left, held = _propagate(left, held, capacity, many, tmp)
        settled.append(taken)
        if held == before:
            break

    # Places left, in shard order, are handed out by number: first to groups that no shard took, then to the unlinked.
    free = [(end, s) for s, end in enumerate(accumulate(c - h for c, h in zip(capacity, held)))]
    over = tmp.keep(_running(left.drop("votes").withColumn("all", F.lit(0)), "all", many).select(
        "hub", "size", "upto", _piece(F.col("upto") - F.col("size"), free).alias("shard"), _piece(F.col("upto") - 1, free).alias("last")), "over")
    spill = over.agg(F.max("upto")).first()[0] or 0
    settled = tmp.keep(reduce(DataFrame.unionByName, settled, over.where("shard = last").select("hub", "shard")), "settled")
    # Groups cut: the rest of those larger than a shard, and those that reach over the places left in a shard.
    for r in settled.where(F.col("hub").isin(*pieces)).collect() if pieces else []:
        pieces[r["hub"]].append((n, r["shard"]))
    for r in over.where("shard <> last").collect():
        done, at = pieces[r["hub"]][-1][0] if pieces.get(r["hub"]) else 0, r["upto"] - r["size"]
        pieces[r["hub"]] = [*pieces.get(r["hub"], []), *((done + end - at, s) for end, s in free if end > at)]

    cut = F.col("hub").isin(*pieces)
    seats = (base.where(~cut) if pieces else base).join(settled, "hub", "left")
    seated = tmp.keep(seats, "seats")
    number = numbered(seated.where("shard is null").withColumn("kind", F.lit(1)), ["kind"], ["node"], "number", n).withColumn("number", F.col("number") + spill)
    out = seated.where("shard is not null").unionByName(number.withColumn("shard", _piece(F.col("number"), free)).drop("kind", "number"))
    if pieces:
        part = numbered(base.where(cut), ["hub"], ["node"], "number", n)
        shard = F.lit(0)
        for hub, ends in pieces.items():
            shard = F.when(F.col("hub") == hub, _piece(F.col("number"), ends)).otherwise(shard)
        out = out.unionByName(part.withColumn("shard", shard).drop("number"))
    out = tmp.keep(out.drop("hub").withColumn("shard", F.col("shard").cast("int")), "placed")
    out = numbered(out, ["shard"], ["node"], "slot", n)
    return out.select("doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def cut_links(sharded: DataFrame, link: list[str]) -> DataFrame:
    """Per shard count: groups by the ``link`` columns that lie in more than one shard, as ``groups`` and ``cut``."""
    per = sharded.groupBy(*link).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("shard").alias("k")).where("n > 1")
    return per.agg(F.count(F.lit(1)).alias("groups"), F.coalesce(F.sum((F.col("k") > 1).cast("long")), F.lit(0)).alias("cut"))
