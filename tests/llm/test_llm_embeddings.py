import math
import random

import numpy as np

from sluice.llm import embedding_dedup
from sluice.llm.embedding_dedup import near_vectors

ROWS = "vec_id long, embedding array<float>, label int"


def brute(rows, cosine=0.98):
    def fine(v):
        return v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)

    ok = [(i, np.array(v, np.float32).astype(float), lab) for i, (_, v, lab) in enumerate(rows) if lab is not None and fine(v)]
    links = {i: set() for i in range(len(rows))}
    for a, (i, v, lab) in enumerate(ok):
        for j, w, lab2 in ok[a + 1:]:
            if lab == lab2 and len(v) == len(w):
                x, y = v / abs(v).max(), w / abs(w).max()
                if x @ y / math.sqrt((x @ x) * (y @ y)) >= cosine:
                    links[i].add(j)
                    links[j].add(i)
    out = []
    for i, (vec, _, _) in enumerate(rows):
        reach, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()] - reach:
                reach.add(j)
                todo.append(j)
        ids = [rows[j][0] for j in reach if rows[j][0] is not None]
        low = min(ids) if ids else None
        out.append((vec, len(links[i]), low, None if vec is None or low is None else vec == low))
    return out


def check(spark, rows, **extra):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, ROWS).withColumns({c: F.lit("clash") for c in ("node", "cell", "v", "n", "block")})
    got = [tuple(r) for r in near_vectors(df, **extra).collect()]
    assert sorted(map(str, got)) == sorted(map(str, brute(rows)))


def cloud(n, dim, seed, labels=3):
    r = np.random.default_rng(seed)
    centres = r.standard_normal((6, dim))
    rows = []
    for i in range(n):
        v = centres[r.integers(6)] + r.standard_normal(dim) * r.choice([0.02, 0.1, 0.18, 1.0])
        rows.append((i, [float(np.float32(x)) for x in v], int(r.integers(labels))))
    return rows


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 1), (2, [1.0, 0.0], 1), (3, [2.0, 0.0], 1), (4, [1.0, 0.05], 1), (5, [0.0, 1.0], 1), (6, [1.0, 0.0], 2),
            (7, [1.0, 0.0], None), (8, None, 1), (9, [0.0, 0.0], 1), (10, [nan, 1.0], 1), (11, [inf, 1.0], 1), (12, [None, 1.0], 1),
            (13, [], 1), (14, [1.0, 0.0, 0.0], 1), (None, [1.0, 0.0], 1), (None, [-1.0, 0.0], 1), (2, [1.0, 0.0], 1),
            (15, [-0.0, 1.0], 1), (16, [1e38, 1e36], 1), (17, [1e-40, 0.0], 1), (18, [-1.0, 0.0], 2)]
    check(spark, rows)


def test_empty_table(spark):
    assert near_vectors(spark.createDataFrame([], ROWS)).collect() == []


def test_clouds_over_many_cells_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "CELL", 15)
    monkeypatch.setattr(embedding_dedup, "BLOCK", 10)
    check(spark, cloud(400, 8, 1))


def test_one_vector_very_often(spark):
    r = random.Random(2)
    rows = cloud(100, 6, 2, labels=1) + [(1000 + i, [1.0] * 6, 0) for i in range(300)]
    r.shuffle(rows)
    check(spark, rows)
