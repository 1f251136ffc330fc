import random
import re
from collections import defaultdict

import numpy as np
import pandas as pd
import pytest
from llm_cases import ODD, no_docs, odd_docs
from xxhash import xxh64_intdigest

from sluice.llm import simhash
from sluice.llm.common import Scratch
from sluice.llm.components import components
from sluice.llm.simhash import hex_digits, near_duplicates, near_links


def fingerprint(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    if not words:
        return 0
    hashes = [xxh64_intdigest(b" ".join(words[i:i + 4]), 42) for i in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(prints, bits=4):
    up = {p: p for p in prints}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    every = sorted(up)
    for i, a in enumerate(every):
        for b in every[i + 1:]:
            if (a ^ b).bit_count() <= bits:
                up[root(b)] = root(a)
    return {p: root(p) for p in every}


def test_odd_documents(spark):
    got = near_duplicates(odd_docs(spark, ["fp", "key", "low", "node"])).select("doc_id", hex_digits().alias("h"), "component_id").collect()
    prints = [(d, fingerprint(t)) for d, t, *_ in ODD]
    of = classes({p for _, p in prints})
    low = {}
    for d, p in prints:
        if d is not None:
            low[of[p]] = min(d, low.get(of[p], d))
    want = [(d, f"{p:016x}", low.get(of[p])) for d, p in prints]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_empty_table(spark):
    assert near_duplicates(no_docs(spark)).collect() == []


def signed(x):
    return x - (1 << 64) if x >> 63 else x


@pytest.mark.parametrize("segments", [2, 3, 5])
def test_links_connect_what_brute_force_connects(spark, segments):
    r = random.Random(segments)
    seeds = [r.getrandbits(64) for _ in range(30)] + [0, (1 << 64) - 1]
    prints = set(seeds)
    for s in seeds:
        for _ in range(12):
            for b in r.sample(range(64), r.randint(1, 6)):
                s ^= 1 << b
            prints.add(s)
    df = spark.createDataFrame([(signed(p), i) for i, p in enumerate(sorted(prints))], "fp long, low long")
    links = near_links(df, 4, segments, Scratch(spark, "test"))
    assert all(((x["a"] ^ x["b"]) & (1 << 64) - 1).bit_count() <= 4 for x in links.collect())
    got = {x["node"]: x["component"] for x in components(links, Scratch(spark, "test")).collect()}
    of = classes(prints)
    groups, want = {}, {}
    for p in prints:
        groups.setdefault(got.get(signed(p), signed(p)), set()).add(p)
        want.setdefault(of[p], set()).add(p)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


def test_a_large_bucket_yields_a_forest():
    r = random.Random(3)
    base = r.getrandbits(42)
    near = {base ^ sum(1 << b for b in r.sample(range(42), r.randint(0, 2))) for _ in range(400)}
    far = {r.getrandbits(42) for _ in range(100)}
    fps = np.array(sorted(near | far), np.int64)
    frame = pd.DataFrame({"key": 1, "probe": [False] * len(fps) + [True] * len(fps), "fp": np.concatenate([fps, fps])})
    links = pd.concat(simhash._forest(4)(iter([frame])))
    assert len(links) < 4 * len(fps)
    up = classes(fps.tolist())
    got = classes([])
    for f in fps.tolist():
        got[f] = f
    for a, b in links.values.tolist():
        assert (a ^ b).bit_count() <= 4
        ra, rb = a, b
        while got[ra] != ra:
            ra = got[ra]
        while got[rb] != rb:
            rb = got[rb]
        got[ra] = rb

    def root(x):
        while got[x] != x:
            x = got[x]
        return x

    assert len({root(f) for f in fps.tolist()}) == len(set(up.values()))


def test_components_of_a_long_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(200)]
    star = [(1000, 1001 + i) for i in range(300)] + [(5000, 5000)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(chain + star, "a long, b long"), Scratch(spark, "test")).collect()}
    assert all(got[i] == 0 for i in range(201)) and all(got[1000 + i] == 1000 for i in range(301)) and 5000 not in got


def test_hot_segment_value_is_dealt_to_several_tasks(spark, monkeypatch):
    """Fingerprints that share a segment's value, in one task or in many: the same components as brute force."""
    r = random.Random(8)
    base = r.getrandbits(64)
    prints = {base ^ sum(1 << b for b in r.sample(range(22, 64), k)) for k in (0, 2, 3, 9, 12) for _ in range(120)}
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    fps = spark.createDataFrame([(p,) for p in signed], "fp long").repartition(4)
    want = classes(prints)

    def found():
        tmp = Scratch(spark, "test")
        got = {x["node"] & (2**64 - 1): x["component"] for x in components(near_links(fps, 4, 3, tmp), tmp).collect()}
        members = defaultdict(set)
        for p in prints:
            members[got.get(p, p)].add(p)
        return sorted(map(sorted, members.values()))

    groups = defaultdict(set)
    for p, c in want.items():
        groups[c].add(p)
    expected = sorted(map(sorted, groups.values()))
    assert found() == expected
    monkeypatch.setattr(simhash, "HOT", 50)
    assert found() == expected
