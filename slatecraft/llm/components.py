"""Connected components of a large edge list, as joins on written tables."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slatecraft.llm.frames import written

#: Edges that a task contracts at a time.
EDGES = 1_000_000


def contract(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every node of some edges but the smallest of its component among them, and that smallest one."""
    nodes, code = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = code[: len(u)], code[len(u) :]
    label = np.arange(len(nodes))
    while True:
        x, y = label[a], label[b]
        apart = x != y
        if not apart.any():
            break
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while (label[label] != label).any():
            label = label[label]
    rest = label != np.arange(len(nodes))
    return nodes[rest], nodes[label[rest]]


def contracted(edges: DataFrame, rows: int) -> tuple[DataFrame, int]:
    """Edges u, v (u > v) with the same components: each task hangs its edges' nodes on the smallest one; the tasks' number."""
    tasks = max(1, math.ceil(rows / EDGES))

    def local(batches):
        u, v, waiting = [], [], 0
        for batch in batches:
            u.append(batch["u"].to_numpy())
            v.append(batch["v"].to_numpy())
            waiting += len(batch)
            if waiting > 2 * EDGES:  # tasks hold unlike numbers of edges
                a, b = contract(np.concatenate(u), np.concatenate(v))
                if len(a) > EDGES:
                    yield pd.DataFrame({"u": a, "v": b})
                    a = b = a[:0]
                u, v, waiting = [a], [b], len(a)
        if u:
            a, b = contract(np.concatenate(u), np.concatenate(v))
            yield pd.DataFrame({"u": a, "v": b})

    return edges.coalesce(tasks).mapInPandas(local, "u long, v long"), tasks


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node``, ``component`` (its smallest node) for every node with an edge to another one.

    Tasks first contract the edges they hold; if one task holds all, that is the result. Else each round hangs
    larger neighbours on the smallest neighbour, then smaller ones, until every edge leads to the smallest node
    of its component. Minima are merged before the shuffle.
    """
    given = written(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u > v"))
    rows = given.count()
    now, tasks = contracted(given, rows)
    whole = tasks == 1 and rows <= EDGES  # no stretch was given out before the task's last edge
    now = written(now if whole else now.distinct())
    while not whole:
        both = now.select("u", "v").union(now.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # larger neighbours to the smallest one around
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct()
        large = written(large)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        # smaller neighbours, and the node itself, to the smallest one
        small = large.join(least, "u").select("u", "v", "m")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v"))).where("u > v").distinct()
        after = written(small)
        if after.count() == now.count() and after.exceptAll(now).isEmpty():
            break
        now = after
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(now.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
