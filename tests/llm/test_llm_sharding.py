import random
import zlib
from collections import Counter, defaultdict

from llm_cases import ODD, no_docs, odd_docs

from sluice.llm.common import Scratch
from sluice.llm.sharding import SCALE, _allowed, line_links, neighbour_votes, propagate, shard_documents


def check(rows, texts, shards):
    sizes = Counter(r["shard"] for r in rows)
    counts = [sizes[s] for s in range(shards)]
    assert max(counts) - min(counts) <= 1 and sum(counts) == len(texts)
    for s in range(shards):
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(counts[s]))
    want = Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in texts)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == want
    assert {(r["law"], r["grown_shard"]) for r in rows} <= {("rows", None)}


def test_odd_documents(spark):
    check(shard_documents(odd_docs(spark, ["node", "hub", "shard", "slot", "size"]), 4).collect(), [(d, t) for d, t, *_ in ODD], 4)


def test_empty_table(spark):
    assert shard_documents(no_docs(spark)).collect() == []


def test_copies_stay_together(spark):
    texts = [(i, f"text {i % 40}") for i in range(200)] + [(1000 + i, f"alone {i}") for i in range(200)]
    rows = shard_documents(spark.createDataFrame(texts, "doc_id long, text string"), 8).collect()
    check(rows, texts, 8)
    of = defaultdict(set)
    for r in rows:
        of[r["text_crc32"]].add(r["shard"])
    assert sum(len(s) > 1 for s in of.values()) <= 2


def test_a_group_larger_than_a_shard(spark):
    texts = [(i, "hot") for i in range(300)] + [(1000 + i, f"t{i}") for i in range(500)]
    rows = shard_documents(spark.createDataFrame(texts, "doc_id long, text string"), 8).collect()
    check(rows, texts, 8)
    hot = Counter(r["shard"] for r in rows if r["doc_id"] < 1000)
    assert sorted(hot.values()) == [100, 100, 100]


def test_linked_documents_fill_all_shards(spark):
    texts = [(i, "hot") for i in range(300)] + [(1000 + i, f"t{i // 2}") for i in range(500)]
    check(shard_documents(spark.createDataFrame(texts, "doc_id long, text string"), 8).collect(), texts, 8)


def test_allowed_moves_never_overfill():
    r = random.Random(4)
    for _ in range(300):
        k = r.randint(1, 6)
        held, cap = [r.randint(0, 30) for _ in range(k)], [r.randint(5, 30) for _ in range(k)]
        wanted = [[0 if a == b else r.randint(0, held[a]) // k for b in range(k)] for a in range(k)]
        moves = _allowed(wanted, held, cap)
        for b in range(k):
            come, go = sum(moves[a][b] for a in range(k)), sum(moves[b])
            assert all(0 <= moves[a][b] <= wanted[a][b] for a in range(k))
            assert not come or held[b] + come - go <= cap[b]


def test_only_dataframe_operations(spark):
    plan = shard_documents(spark.createDataFrame([(1, "a"), (2, "a")], "doc_id long, text string"))._jdf.queryExecution().toString()
    assert not any(w in plan for w in ("Python", "Pandas", "Arrow"))


def cut_groups(rows):
    of = defaultdict(set)
    for r in rows:
        of[r["text_crc32"]].add(r["shard"])
    return sum(len(s) > 1 for s in of.values())


def test_groups_stay_whole_when_all_shards_fill(spark, monkeypatch):
    from sluice.llm import common, sharding

    for module in (common, sharding):  # several blocks, as a large table has
        monkeypatch.setattr(module, "blocks_for", lambda rows, per_block=50: max(1, -(-rows // per_block)), raising=False)
    texts = [(i, "hot") for i in range(1000)] + [(5000 + i, f"t{i // 4}") for i in range(2000)]
    rows = shard_documents(spark.createDataFrame(texts, "doc_id long, text string"), 8).collect()
    check(rows, texts, 8)
    assert cut_groups(rows) <= 8
    assert len({r["shard"] for r in rows if r["doc_id"] < 5000}) <= 4


def random_graph(r, groups, lines, shards):
    members = {line: sorted(r.sample(range(groups), r.randint(2, 4))) for line in range(lines)}
    links = [(g, line) for line, gs in members.items() for g in gs]
    state = {g: (r.randint(1, 4), r.randrange(shards)) for g in range(groups)}
    return links, state


def frames(spark, links, state):
    return (spark.createDataFrame(links, "hub long, line long"),
            spark.createDataFrame([(g, n, s) for g, (n, s) in state.items()], "hub long, size long, shard int"))


def brute_votes(links, state, shards):
    votes = {}
    for g, line in links:
        others = [state[h] for h, k in links if k == line and h != g]
        total = sum(n for n, _ in others)
        for s in range(shards):
            votes.setdefault(g, [0] * shards)[s] += SCALE * sum(n for n, t in others if t == s) // total
    return votes


def test_votes_match_brute_force(spark):
    r = random.Random(2)
    for _ in range(3):
        links, state = random_graph(r, 30, 25, 4)
        got = neighbour_votes(*frames(spark, links, state), 4).collect()
        assert {x["hub"]: x["votes"] for x in got} == brute_votes(links, state, 4)


def cut_weight(links, shard_of):
    """Lines whose groups lie in several shards."""
    of = defaultdict(set)
    for g, line in links:
        of[line].add(shard_of[g])
    return sum(len(s) > 1 for s in of.values())


def test_propagation_cuts_fewer_links_and_keeps_quotas(spark):
    r = random.Random(3)
    before = after = 0
    for _ in range(3):
        links, state = random_graph(r, 40, 30, 3)
        total = sum(n for n, _ in state.values())
        capacity = [-(-total // 3) + 4] * 3
        start = Counter()
        for n, s in state.values():
            start[s] += n
        end = propagate(*frames(spark, links, state), capacity, 6, 40, Scratch(spark, "test")).collect()
        assert {x["hub"]: x["size"] for x in end} == {g: n for g, (n, _) in state.items()}
        held = Counter()
        for x in end:
            held[x["shard"]] += x["size"]
        assert all(held[s] <= max(capacity[s], start[s]) for s in range(3))
        before += cut_weight(links, {g: s for g, (_, s) in state.items()})
        after += cut_weight(links, {x["hub"]: x["shard"] for x in end})
    assert after < 0.6 * before


def test_documents_that_share_lines_meet(spark):
    line = [f"a line of cluster {c} that is long enough to link its documents" for c in range(16)]
    texts = [(i, f"head {i}\n{line[i % 16]}\nshort\n{line[i % 16]} again") for i in range(320)] + [(1000 + i, f"alone {i}") for i in range(320)]
    rows = shard_documents(spark.createDataFrame(texts, "doc_id long, text string"), 4).collect()
    check(rows, texts, 4)
    together = Counter((r["doc_id"] % 16, r["shard"]) for r in rows if r["doc_id"] < 1000)
    assert sum(max(together[c, s] for s in range(4)) for c in range(16)) > 0.8 * 320


def test_line_links_are_shared_lines_only(spark):
    long = "x" * 40
    rows = spark.createDataFrame([(1, f"{long}\n{long}\nshort"), (2, f"  {long}  \nother {long}"), (3, "short\nshort"), (4, "")], "hub long, text string")
    got = line_links(rows).collect()
    assert sorted(r["hub"] for r in got) == [1, 2] and len({r["line"] for r in got}) == 1
