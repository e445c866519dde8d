"""Near-duplicate vectors by a pivot-permutation index.

Reference vectors (pivots) are a bounded sample of vectors that lie far apart, so a group of near copies has few
of them and its members have the same nearest ones, however large it is. Every vector is described by its nearest pivots in order. An
inverted list of each label and pivot holds the vectors that have it among their nearest; two vectors that
share enough pivots are candidates and are verified by their cosine in double precision. A pair belongs to
the first list they share, so it is counted once. A long list is cut into blocks and compared block by
block. Tasks give counts by vector and one edge to the smallest vector that links reach in the block, never all pairs.

Where vectors lie too close for more than ``nearest`` squared such pivots, lists would compare no less than every
pair: all vectors of that width share one list, and every pair of a label is compared.

Equal vectors of a label are merged first and counted. Vectors that are null, zero or hold null or
non-finite numbers, and null labels, link with nothing and stand alone. Repeated ids are rows of one vector id
each. No rows give none; extra columns stay unread.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slatecraft.llm.components import components, contract
from slatecraft.llm.frames import written

#: Pairs of cosine 0.93 to 0.94 in 64 dimensions share two of the eight nearest in 4000 of 4000 trials.
PIVOTS = 256
NEAREST = 8
SHARED = 2
#: Pivots have a cosine below this to each other, and are looked for among so many vectors for each of them.
APART = 0.6
SAMPLED = 4
BLOCK = 2048


def _matrix(column: pd.Series, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.float64).reshape(-1, width)


def _unit(rows: np.ndarray) -> np.ndarray:
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)  # keeps squares in range
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def reference_points(merged: DataFrame, most: int) -> dict[int, np.ndarray]:
    """Unit pivots by number of components: at most ``most`` vectors in the order of a hash that lie apart from those before."""
    sample = merged.select("width", "v", "key").orderBy(F.xxhash64("key"), "key").limit(SAMPLED * most).collect()
    by_width: dict[int, list] = {}
    for row in sample:
        by_width.setdefault(row["width"], []).append(row["v"])
    return {w: apart(_unit(np.array(v)))[:most] for w, v in by_width.items()}


def apart(unit: np.ndarray) -> np.ndarray:
    """The rows whose cosine to every kept row before them is below ``APART``."""
    kept = []
    for i, row in enumerate(unit):
        if not kept or (unit[kept] @ row).max() < APART:
            kept.append(i)
    return unit[kept]


def described(merged: DataFrame, points: dict[int, np.ndarray], nearest: int) -> DataFrame:
    """The unit vector (bytes) and its ``nearest`` pivots, nearest first. Widths with few pivots use pivot 0 alone."""

    def near(batches):
        for batch in batches:
            for width, part in batch.groupby("width"):
                x = _unit(np.array(part["v"].tolist(), np.float64))
                if len(points.get(width, ())) > nearest**2:
                    order = np.argsort(-(x @ points[width].T), axis=1, kind="stable")[:, :nearest]
                else:
                    order = np.zeros((len(x), 1), np.int64)
                yield pd.DataFrame({"label": part["label"], "width": part["width"], "vec_id": part["vec_id"], "copies": part["copies"], "unit": [r.tobytes() for r in x], "near": [o.astype(np.int32) for o in order]})

    return merged.select("label", "width", "vec_id", "copies", "v").mapInPandas(near, "label string, width int, vec_id long, copies long, unit binary, near array<int>")


def compare(left: pd.DataFrame, right: pd.DataFrame | None, pivot: int, least: float, shared: int) -> pd.DataFrame:
    """Links of a list's block with itself, or with another block: by vector the copies linked and the smallest id reached."""
    both = left if right is None else pd.concat([left, right], ignore_index=True)
    x = _matrix(both["unit"], int(both["width"].iloc[0]))
    ids, copies = both["vec_id"].to_numpy(), both["copies"].to_numpy()
    has = np.zeros((len(both), 1 + max(max(n) for n in both["near"])), np.float32)
    for i, n in enumerate(both["near"]):
        has[i, n] = 1
    count, head, a, b = np.zeros(len(both), np.int64), ids.copy(), [], []
    half = len(left)
    need = min(shared, min(len(n) for n in both["near"]))
    for at in range(0, half, 512):
        rows, cols = slice(at, min(half, at + 512)), slice(0 if right is None else half, len(both))
        linked = (x[rows] @ x[cols].T >= least) & (has[rows] @ has[cols].T >= need) & (has[rows, :pivot] @ has[cols, :pivot].T == 0)
        if right is None:
            linked[np.arange(linked.shape[0]), np.arange(at, at + linked.shape[0])] = False
        else:
            count[cols] += copies[rows] @ linked
        count[rows] += linked @ copies[cols]
        i, j = np.nonzero(linked)
        u, v = contract(ids[rows][i], ids[cols][j])
        a.append(u)
        b.append(v)
    if a:  # links over a middle vector count as well
        u, v = contract(np.concatenate(a), np.concatenate(b))
        order = np.argsort(ids)
        head[order[np.searchsorted(ids, u, sorter=order)]] = v
    out = pd.DataFrame({"vec_id": ids, "n": count, "least": head})
    return out[out["n"] > 0]


def links(vectors: DataFrame, least: float = 0.93, pivots: int = PIVOTS, nearest: int = NEAREST, shared: int = SHARED, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label") -> DataFrame:
    """vec_id, n_links, component_id, kept."""
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("v"), F.col(label).cast("string").alias("label"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    good = F.coalesce(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite, F.lit(False))
    rows = rows.withColumn("key", F.when(good, F.md5(F.concat_ws(",", F.col("label"), F.col("v").cast("array<string>")))))
    merged = written(rows.where("key IS NOT NULL").groupBy("key").agg(F.first("label").alias("label"), F.first("v").alias("v"), F.min("vec_id").alias("vec_id"), F.count("*").alias("copies")).withColumn("width", F.size("v")))
    index = written(described(merged, reference_points(merged, pivots), nearest))
    posted = index.withColumn("pivot", F.explode("near"))
    blocks = posted.groupBy("label", "width", "pivot").agg(F.ceil(F.count("*") / F.lit(BLOCK)).cast("int").alias("blocks"))
    dealt = posted.join(blocks, ["label", "width", "pivot"]).withColumn("own", F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumn("low", F.least("own", "other")).withColumn("high", F.greatest("own", "other"))

    def task(key, group):
        _, _, pivot, low, high = key
        left, right = group[group["own"] == low], group[group["own"] == high]
        empty = pd.DataFrame({"vec_id": [], "n": [], "least": []}).astype("int64")
        if not len(left) or not len(right) or len(group) < 2:
            return empty
        return compare(left.reset_index(drop=True), None if low == high else right.reset_index(drop=True), int(pivot), least, shared)

    found = dealt.select("label", "width", "pivot", "low", "high", "own", "vec_id", "copies", "unit", "near").groupBy("label", "width", "pivot", "low", "high").applyInPandas(task, "vec_id long, n long, least long")
    found = written(found)
    totals = found.groupBy("vec_id").agg(F.sum("n").alias("n"))
    reached = components(found.select(F.col("vec_id").alias("a"), F.col("least").alias("b")))
    reps = merged.select("key", F.col("vec_id").alias("rep"), "copies")
    return (
        rows.select("vec_id", "key")
        .join(reps, "key", "left")
        .join(totals.withColumnRenamed("vec_id", "rep"), "rep", "left")
        .join(reached.withColumnRenamed("node", "rep"), "rep", "left")
        .select(
            "vec_id",
            (F.coalesce("n", F.lit(0)) + F.coalesce(F.col("copies") - 1, F.lit(0))).cast("long").alias("n_links"),
            F.coalesce("component", "rep", "vec_id").alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
    )
