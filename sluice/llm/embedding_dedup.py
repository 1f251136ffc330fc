"""Near-duplicate vectors by an exact metric range join over pivot cells.

For unit vectors a cosine of at least ``c`` is a Euclidean distance of at most
``r = sqrt(2 - 2c)``.  Pivots partition each label's vectors: a vector is owned
by the cell of its nearest pivot.  By the triangle inequality a vector within
``r`` of one that pivot j owns is at most ``2r`` farther from pivot j than from
its own pivot, and at most ``r`` from the plane halfway between the two; it is
copied to exactly the cells for which both hold.  All of a vector's partners
are then in its own cell, and cells join independently.

Equal vectors are one entry with a weight.  A cell's owned vectors are dealt in
blocks over tasks, each with the cell's other vectors streamed past, so a cell
of any size is joined in bounded memory; tasks return a vector's number of
links and a spanning forest of the links instead of all pairs.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import Scratch
from sluice.llm.components import components

CELL = 500
"""Vectors a cell should own, on average."""
MAX_PIVOTS = 4096
"""Pivots over all labels: what is broadcast is bounded by this many vectors."""
BLOCK = 2000
"""Owned vectors per joining task."""
SLACK = 1e-6
"""Added to the radius while candidates are sought, far above rounding errors; links are checked by cosine alone."""


def _usable(embeddings: DataFrame, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """``vec_id, label, v`` and ``ok``, whether the vector can link; components stay floats if they are."""
    kind = embeddings.schema[vec_col].dataType.elementType.simpleString()
    kind = kind if kind == "float" else "double"
    v = F.col("v")
    fine = (F.col("label").isNotNull() & v.isNotNull() & (F.size(v) > 0)
            & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists(v, lambda x: x != 0))
    rows = embeddings.select(F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), F.col(vec_col).cast(f"array<{kind}>").alias("v"))
    # Minus zero equals zero.
    return rows.withColumn("ok", F.coalesce(fine, F.lit(False))).withColumn(
        "v", F.when(F.col("ok"), F.transform(v, lambda x: x + F.lit(0.0).cast(kind))))


def _unit(vectors):
    """Rows scaled to length 1, safe from overflow; float64."""
    import numpy as np

    m = np.array(vectors, np.float64)
    m /= np.abs(m).max(1, keepdims=True)
    return m / np.linalg.norm(m, axis=1, keepdims=True)


def near_vectors(embeddings: DataFrame, cosine: float = 0.98, id_col: str = "vec_id", vec_col: str = "embedding",
                 label_col: str = "label") -> DataFrame:
    """Per row: ``vec_id, n_links, component_id, kept``.

    Vectors link when their labels are equal and not null, their lengths are
    equal and their cosine in double precision is at least ``cosine``; null,
    empty and zero vectors and those with null or non-finite components link
    with nothing.  ``n_links`` counts the other rows linked directly,
    ``component_id`` is the smallest id reachable, ``kept`` tells whether it is
    the row's own.  Rows that repeat an id are rows of their own; a null id is
    no smallest id unless no other is reachable (then ``component_id`` and
    ``kept`` are null).  Other columns are left out.
    """
    spark = embeddings.sparkSession
    tmp = Scratch(spark, "vectors")
    radius = math.sqrt(max(0.0, 2 - 2 * cosine)) + SLACK
    rows = tmp.keep(_usable(embeddings, id_col, vec_col, label_col), "rows")
    same = (rows.where("ok").groupBy("label", "v").agg(F.min("vec_id").alias("low"), F.count(F.lit(1)).alias("n"))
            .withColumn("node", F.monotonically_increasing_id()).withColumn("dim", F.size("v")))
    same = tmp.keep(same, "distinct")

    groups = same.groupBy("label", "dim").count().collect()  # a count per label, not its vectors
    total = sum(g["count"] for g in groups)
    shares = [(g["label"], g["dim"], max(1, math.ceil(g["count"] / max(CELL, total / MAX_PIVOTS)))) for g in groups]
    label_type = same.schema["label"].dataType.simpleString()
    share = spark.createDataFrame(shares, f"label {label_type}, dim int, k int")
    picked = same.select("label", "dim", "v", F.xxhash64("v").alias("h")).join(F.broadcast(share), ["label", "dim"])
    counts = spark.createDataFrame([(g["label"], g["dim"], g["count"]) for g in groups], f"label {label_type}, dim int, size long")
    # About eight times the pivots by hash, of which the first by hash are taken: no label is ordered as a whole.
    picked = picked.join(F.broadcast(counts), ["label", "dim"]).where(F.pmod("h", F.lit(1 << 20)) * F.col("size") < F.col("k") * 8 * (1 << 20))
    w = Window.partitionBy("label", "dim").orderBy("h", "v")
    pivots: dict = {}
    for r in picked.withColumn("i", F.row_number().over(w)).where("i <= k").select("label", "dim", "v").collect():
        pivots.setdefault((r["label"], r["dim"]), []).append(r["v"])
    shipped, base = {}, 0
    for g in groups:
        key = (g["label"], g["dim"])
        # A label none of whose vectors was picked is one cell.
        shipped[key] = base, _unit(pivots[key]) if key in pivots else None
        base += len(pivots.get(key, "1"))
    shipped = spark.sparkContext.broadcast(shipped)

    def cells(frames):
        import numpy as np
        import pandas as pd

        for pdf in frames:
            out = []
            for g, part in pdf.groupby(["label", "dim"], sort=False):
                base, piv = shipped.value[g]
                u = _unit(part["v"].tolist())
                node, n = part["node"].to_numpy(), part["n"].to_numpy()
                if piv is None:
                    own, near = np.zeros(len(u), int), np.ones((len(u), 1), bool)
                else:
                    far = np.maximum(0, 2 - 2 * u @ piv.T)
                    own = far.argmin(1)
                    least = far[np.arange(len(u)), own][:, None]
                    apart = np.sqrt(np.maximum(0, 2 - 2 * piv @ piv.T))[own]
                    near = (np.sqrt(far) <= np.sqrt(least) + 2 * radius) & (far - least <= 2 * radius * apart + SLACK)
                    near[np.arange(len(u)), own] = True
                row, cell = np.nonzero(near)
                out.append(pd.DataFrame({"cell": base + cell, "node": node[row], "n": n[row], "own": own[row] == cell,
                                         "v": part["v"].to_numpy()[row]}))
            if out:
                yield pd.concat(out)

    dealt = same.mapInPandas(cells, f"cell long, node long, n long, own boolean, v {same.schema['v'].dataType.simpleString()}")
    dealt = tmp.keep(dealt, "cells")
    sizes = dealt.groupBy("cell").agg(F.ceil(F.sum(F.col("own").cast("int")) / BLOCK).cast("int").alias("blocks")).where("blocks > 0")
    mine = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    # In each of a cell's blocks its vectors come twice at most: as seekers (block's own) and as those sought.
    sought = dealt.join(sizes, "cell").select("cell", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(1).alias("role"), "node", "n", "v")
    seek = dealt.where("own").join(sizes, "cell").select("cell", mine.alias("block"), F.lit(0).alias("role"), "node", "n", "v")

    def joined(frames):
        import numpy as np
        import pandas as pd

        state = None  # of the current (cell, block): seekers' ids, unit vectors, weights, links so far, union-find

        def root(up, x):
            while up.get(x, x) != x:
                up[x] = up.get(up[x], up[x])
                x = up[x]
            return x

        def close(state):
            if state["u"] is None:
                return None
            return pd.DataFrame({"node": state["ids"], "links": state["links"], "other": np.full(len(state["ids"]), -1)})

        for pdf in frames:
            out = []
            key = pdf["cell"].to_numpy() * np.int64(1 << 20) + pdf["block"].to_numpy()
            for a, b in zip(*(lambda e: (e, [*e[1:], len(key)]))([0, *(np.flatnonzero(key[1:] != key[:-1]) + 1)])):
                part = pdf.iloc[a:b]
                if state is None or state["key"] != key[a]:
                    if state is not None:
                        out.append(close(state))
                    state = {"key": key[a], "parts": [], "u": None, "up": {}}
                seekers = part[part["role"] == 0]
                if len(seekers):
                    state["parts"].append(seekers)
                others = part[part["role"] == 1]
                if not len(others) or not (state["parts"] or state["u"] is not None):
                    continue
                if state["u"] is None:
                    own = pd.concat(state["parts"])
                    state.update(ids=own["node"].to_numpy(), u=_unit(own["v"].tolist()), links=np.zeros(len(own), np.int64), parts=[])
                ids, n = others["node"].to_numpy(), others["n"].to_numpy()
                u = _unit(others["v"].tolist())
                for k in range(0, len(ids), 1024):
                    i, j = np.nonzero(state["u"] @ u[k:k + 1024].T >= cosine)
                    j += k
                    x, y = state["ids"][i], ids[j]
                    np.add.at(state["links"], i, np.where(x == y, n[j] - 1, n[j]))
                    up, forest = state["up"], []
                    for p, q in zip(x[x < y].tolist(), y[x < y].tolist()):
                        rp, rq = root(up, p), root(up, q)
                        if rp != rq:
                            up[rp] = rq
                            forest.append((p, q))
                    if forest:
                        f = np.array(forest, np.int64)
                        out.append(pd.DataFrame({"node": f[:, 0], "links": 0, "other": f[:, 1]}))
            out = [o for o in out if o is not None]
            if out:
                yield pd.concat(out)
        if state is not None and (last := close(state)) is not None:
            yield last

    both = seek.unionByName(sought).repartition("cell", "block").sortWithinPartitions("cell", "block", "role")
    found = tmp.keep(both.mapInPandas(joined, "node long, links long, other long"), "links")
    direct = found.groupBy("node").agg(F.sum("links").alias("n_links"))
    classes = components(found.where("other >= 0").select(F.col("node").alias("a"), F.col("other").alias("b")), tmp)
    named = (same.join(direct, "node", "left").join(classes, "node", "left")
             .withColumn("component", F.coalesce("component", "node")))
    low = named.groupBy("component").agg(F.min("low").alias("component_id"))
    named = named.join(low, "component").select("label", "v", F.coalesce("n_links", F.lit(0)).alias("n_links"), "component_id")
    linked = rows.where("ok").join(named, ["label", "v"]).select("vec_id", "n_links", "component_id")
    alone = rows.where("not ok").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id") == F.col("component_id"))
