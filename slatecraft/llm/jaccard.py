"""Jaccard join on word shingles by chosen paths.

A set of shingles chooses a few of its tokens by a hash that all sets share, anew for every run and level. Sets
that chose one token share a path. Paths with one set end; small ones are brute-forced; larger ones are split
by the next level's chosen tokens, unless their sets are alike already (few distinct minhash values) or the
levels are used up, then they are brute-forced block by block. Sets whose sketches agree enough become
candidates; all that these connect in a block are linked by one edge each to one of them. Within the components of these edges,
blocks of whole texts are compared exactly. Sets whose sizes are further apart than the threshold cannot be linked, so
large paths and components are cut into bands of sizes and only bands side by side are compared. In a block, sets that
share too few of their shingles with any other go first, the rest meet by the rarest of their shingles (a prefix that
two linked sets cannot both miss), and only sets that these connect are multiplied out. Tasks give counts by set, never all pairs.

Texts are lower-cased and split at white space. Texts shorter than a shingle have one shingle: all their words.
Sets that are equal are merged first and counted. Null and empty texts have no shingles and link with
nothing. Repeated rows are equal sets. No rows give none; only id and text are read. A pair of at least the
threshold shares a path in a run with probability over 0.8, so seven runs find more than 0.9999 of them.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slatecraft.llm.bytegrams import chunks
from slatecraft.llm.components import components, contract
from slatecraft.llm.frames import few_files, row_key, unused, whole_text, written

WORDS = 5
LEAST = 0.8
RUNS = 7
LEVELS = 4
#: Chosen tokens expected of a set at each level of a run.
CHOSEN = 2.0
#: Bins of a sketch: 2 to the power of 7.
SKETCH = 128
#: Sketches may agree on so many deviations less than the threshold says; small sets deviate more.
DEVIATIONS = 4.0
SMALL = 64
ALIKE = 0.5
BLOCK = 1024
#: Sets and letters of a block of texts; small components share one.
BLOCK_SETS = 4096
BLOCK_BYTES = 4_000_000
#: Sets on either side that are multiplied out at a time.
TILE = 512
#: Paths of so many sets are compared together, pair by pair.
FEW = 12

_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray, seed: int) -> np.ndarray:
    x = (x ^ np.uint64(seed * 0x632BE59BD9B4E019 % 2**64)) * _ODD
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def hashed(texts: list[str], words: int = WORDS) -> list[np.ndarray]:
    """By text: sorted distinct hashes of its shingles; none for a text without words."""
    plain = [" ".join(t.lower().split()).encode("utf-8", "surrogatepass") for t in texts]
    filled = [p for p in plain if p]
    if not filled:
        return [np.empty(0, np.uint64) for _ in texts]
    raw = np.frombuffer(b" ".join(filled) + b" ", np.uint8)
    ends = np.flatnonzero(raw == 32)
    starts = np.concatenate([[0], ends[:-1] + 1])
    # a word's hash: its bytes' codes times powers of an odd number, from the word's start
    codes = _mixed(np.arange(256, dtype=np.uint64) + np.uint64(1), 7)[raw]
    place = np.arange(len(raw)) - np.repeat(starts, np.diff(np.append(starts, len(raw))))
    power = np.cumprod(np.full(int(place.max()) + 1, 0x100000001B3, np.uint64))
    total = np.cumsum(codes * power[place])
    word = _mixed(total[ends] - np.concatenate([[np.uint64(0)], total[ends[:-1]]]), 11)

    def mixed_run(n: int, part: np.ndarray) -> np.ndarray:
        out = np.zeros(max(0, len(part) - n + 1), np.uint64)
        for k in range(n):
            out = _mixed(out + part[k : len(part) - n + 1 + k], 13 + k)
        return out

    every = mixed_run(words, word)  # windows across two texts are left out below
    out, at = [], 0
    for p in plain:
        if not p:
            out.append(np.empty(0, np.uint64))
            continue
        n = p.count(b" ") + 1
        out.append(np.unique(every[at : at + n - words + 1]) if n >= words else mixed_run(n, word[at : at + n]))
        at += n
    return out


def described(docs: DataFrame, words: int, doc_id: str, text: str) -> DataFrame:
    """row_key, doc_id, set_key, size, sketch and the chosen tokens of each run and level."""
    stretches = RUNS * LEVELS
    # each run and level has a stretch of the hash range of its own, which starts at the same place for all sets
    begin = (np.arange(stretches, dtype=np.float64) / stretches * 2.0**64).astype(np.uint64)
    bins = np.arange(SKETCH, dtype=np.uint64) << np.uint64(57)

    def sets(batches):
        import pyarrow as pa

        for batch in batches:
            keys, owns, texts = (batch.column(k).to_pylist() for k in range(3))
            at = 0
            for run in chunks(texts):
                found = hashed(run, words)
                kept = [i for i, s in enumerate(found) if len(s)]
                found, sizes, digests, sketches, lows, tokens, times = [found[i] for i in kept], [], [], [], [], [], []
                for s in found:
                    h = np.sort(_mixed(s, 5))
                    wide = np.uint64(min(2**63, int(CHOSEN / len(s) * 2**64)))
                    low, high = np.searchsorted(h, begin), np.searchsorted(h, begin + wide)
                    high += len(h) * (begin + wide < begin)  # runs round past the top
                    many = np.maximum(high - low, 1)  # an empty stretch takes the next token
                    spots = np.repeat(low - np.cumsum(many) + many, many) + np.arange(many.sum())
                    tokens.append(h[spots % len(h)])
                    times.append(many)
                    # one permutation: smallest hash of each of SKETCH bins; an empty bin takes the next full one's
                    spread = np.sort(_mixed(s, 6))
                    sketches.append(spread[np.searchsorted(spread, bins) % len(spread)].astype(np.uint16).tobytes())
                    lows.append(int(spread[0] & np.uint64(2**63 - 1)))
                    sizes.append(len(s))
                    digests.append(_digest(s))
                flat = np.concatenate(tokens).view(np.int64) if tokens else np.empty(0, np.int64)
                inner = np.concatenate([[0], np.cumsum(np.concatenate(times))]) if times else np.zeros(1)
                lists = pa.ListArray.from_arrays(pa.array(inner.astype(np.int32)), pa.array(flat))
                chosen = pa.ListArray.from_arrays(pa.array(np.arange(len(found) + 1, dtype=np.int32) * stretches), lists)
                columns = [
                    pa.array([keys[at + i] for i in kept], pa.string()), pa.array([owns[at + i] for i in kept], pa.int64()), pa.array(sizes, pa.int32()), pa.array(digests, pa.binary()),
                    pa.array(sketches, pa.binary()), pa.array(lows, pa.int64()), chosen,
                ]
                at += len(run)
                yield pa.RecordBatch.from_arrays(columns, ["row_key", "doc_id", "size", "set_key", "sketch", "low", "chosen"])

    rows = docs.select(row_key(F.col(doc_id), F.col(text)).alias("row_key"), F.col(doc_id).cast("long").alias("doc_id"), whole_text(text).alias("text"))
    return rows.mapInArrow(sets, "row_key string, doc_id long, size int, set_key binary, sketch binary, low long, chosen array<array<long>>")


def _digest(s: np.ndarray) -> bytes:
    import hashlib

    return hashlib.md5(s.tobytes()).digest()


def alike(sketches: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Share of equal bins of each of some sketches and each of others; both have a row for each bin."""
    same = np.zeros((sketches.shape[1], other.shape[1]), np.uint8)
    for mine, theirs in zip(sketches, other):
        same += mine[:, None] == theirs
    return same / np.float32(len(sketches))


def edges_across(linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect what a matrix of links connects, one for each row and column but the first of a component; columns count on after the rows."""
    n, m = linked.shape
    label = np.arange(n + m, dtype=np.int32)
    while True:
        columns = np.minimum(label[n:], np.where(linked, label[:n, None], np.int32(n + m)).min(axis=0, initial=n + m))
        rows = np.minimum(label[:n], np.where(linked, columns[None, :], np.int32(n + m)).min(axis=1, initial=n + m))
        least = np.concatenate([rows, columns])
        least = least[least]
        if (least == label).all():
            rest = np.flatnonzero(label != np.arange(n + m))
            return rest, label[rest]
        label = least


def in_blocks(rows: DataFrame, key: str, large: Column, blocks: Column, least: float) -> DataFrame:
    """Rows (with node and size) once for each pair of blocks of their key that they are compared in: own, low and high tell the blocks.

    Keys that are not large are one block. The others are cut into bands of sizes, each in so many blocks as the
    aggregate says; a block meets those of its band and of the bands beside it, as sets that are linked lie no further apart.
    """
    whole = rows.where(~large).select("*", *(F.lit(0).cast("long").alias(k) for k in ("own", "low", "high")))
    rows = rows.where(large).withColumn("band", F.floor(F.log("size") / F.lit(-math.log(max(least * 0.999, 1e-6)))).cast("long"))
    order = Window.partitionBy(key).orderBy("band")
    counts = rows.groupBy(key, "band").agg(blocks.cast("long").alias("blocks"))
    beside = [F.when(f("band").over(order) == F.col("band") + by, f("blocks").over(order)).otherwise(0).alias(name) for f, by, name in ((F.lag, -1, "before"), (F.lead, 1, "after"))]
    counts = written(counts.select("*", *beside))
    block = lambda band, k: band * F.lit(2**32) + k
    several = lambda name, by: F.transform(F.filter(F.sequence(F.lit(0).cast("long"), name), lambda k: k < F.col(name)), lambda k: block(F.col("band") + by, k))
    rows = rows.join(counts, [key, "band"]).withColumn("own", block(F.col("band"), F.pmod(F.xxhash64("node", F.lit(1)), F.col("blocks"))))
    rows = rows.withColumn("other", F.explode(F.concat(several("blocks", 0), several("before", -1), several("after", 1))))
    cut = rows.withColumn("low", F.least("own", "other")).withColumn("high", F.greatest("own", "other"))
    return whole.union(cut.select(*whole.columns))


def candidate_edges(sets: DataFrame, least: float = LEAST) -> DataFrame:
    """Edges a, b between sets (by node id) that share a path and whose sketches agree."""
    nodes = sets.select("node", "low", "chosen")
    leaves = None
    for level in range(LEVELS):
        runs = F.transform(F.sequence(F.lit(0), F.lit(RUNS - 1)), lambda r: F.struct(r.alias("run"), F.get("chosen", r * LEVELS + level).alias("tokens")))
        picked = nodes.select("node", "low", F.explode(runs).alias("r")).select("node", "low", "r.run", F.explode("r.tokens").alias("token"))
        if level == 0:
            at = picked.select("node", "low", F.xxhash64("run", "token").alias("path"), "run")
        else:
            at = deeper.join(picked.drop("low"), ["node", "run"]).select("node", "low", F.xxhash64("path", "token").alias("path"), "run")  # noqa: F821
        at = written(at)
        counts = at.groupBy("path").agg(F.count("*").alias("n"), F.approx_count_distinct("low").alias("kinds")).where("n > 1")
        split = (F.col("n") > SMALL) & (F.col("kinds") > ALIKE * F.col("n")) & F.lit(level < LEVELS - 1)
        counts = written(few_files(counts.withColumn("split", split), at.count() / 2))
        here = at.join(counts.where("NOT split").select("path", "n"), "path").select("path", "node", "n")
        leaves = here if leaves is None else leaves.union(here)
        split_counts = counts.where("split").select("path")
        if split_counts.isEmpty():
            break
        deeper = written(at.join(split_counts, "path", "left_semi"))
    leaves = leaves.join(sets.select("node", "size", "sketch"), "node")
    dealt = in_blocks(leaves, "path", F.col("n") > BLOCK, F.ceil(F.count("*") / F.lit(BLOCK)), least).select("path", "low", "high", "own", "node", "size", "sketch")
    # many small paths to a task: each task sorts its paths and compares one after another
    dealt = dealt.repartition(F.col("path"), F.col("low"), F.col("high")).sortWithinPartitions("path", "low", "high")

    def task(batches):
        rest = None
        for batch in batches:
            batch = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            marks = batch[["path", "low", "high"]].ne(batch[["path", "low", "high"]].shift()).any(axis=1).to_numpy().nonzero()[0]
            yield edges_of(batch, marks)
            rest = batch.iloc[marks[-1] :] if len(marks) else None
        if rest is not None and len(rest):
            yield edges_of(rest, np.array([0, len(rest)]))

    def agree(sketches, others, sizes, other_sizes):
        smaller, larger = np.minimum(sizes, other_sizes), np.maximum(sizes, other_sizes)
        deviation = np.sqrt(least * (1 - least) * (1 / SKETCH + 2 / smaller))
        return (alike(sketches, others) >= least - DEVIATIONS * deviation) & (smaller >= least * larger - 1e-6)

    def edges_of(batch, marks):
        if len(marks) < 2:
            return pd.DataFrame({"a": [], "b": []}, dtype="int64")
        batch = batch.iloc[: marks[-1]]
        node, own, low, high = (batch[k].to_numpy() for k in ("node", "own", "low", "high"))
        size = batch["size"].to_numpy(np.float64)
        sketch = np.frombuffer(b"".join(batch["sketch"]), np.uint16).reshape(-1, SKETCH)
        many = np.diff(marks)
        # small paths: each set and the one so many places on, where it has the same path
        path = np.repeat(np.arange(len(many)), many)
        few = np.where((many <= FEW)[path] & (low == high), path, -1)
        u, v = [], []
        for apart in range(1, FEW):
            mine = np.flatnonzero((few[:-apart] == few[apart:]) & (few[apart:] >= 0))
            for at in range(0, len(mine), 4096):
                i = mine[at : at + 4096]
                smaller, larger = np.minimum(size[i], size[i + apart]), np.maximum(size[i], size[i + apart])
                same = (sketch[i] == sketch[i + apart]).sum(axis=1) / np.float32(SKETCH)
                deviation = np.sqrt(least * (1 - least) * (1 / SKETCH + 2 / smaller))
                i = i[(same >= least - DEVIATIONS * deviation) & (smaller >= least * larger - 1e-6)]
                u.append(i)
                v.append(i + apart)
        for start, stop in zip(marks[:-1], marks[1:]):
            if few[start] >= 0 or stop - start < 2:
                continue
            first = second = np.arange(start, stop)
            if low[start] != high[start]:
                first, second = start + np.flatnonzero(own[start:stop] == low[start]), start + np.flatnonzero(own[start:stop] == high[start])
            mine, theirs = sketch[first].T.copy(), sketch[second].T.copy()
            near = np.zeros((len(first), len(second)), bool)
            for at in range(0, len(first), 256):
                near[at : at + 256] = agree(mine[:, at : at + 256], theirs, size[first[at : at + 256], None], size[None, second])
            x, y = edges_across(near)
            both = np.concatenate([first, second])
            u.append(both[x])
            v.append(both[y])
        u, v = contract(np.concatenate(u), np.concatenate(v))  # rows of one path only reach each other
        apart = node[u] != node[v]
        return pd.DataFrame({"a": node[u][apart], "b": node[v][apart]})

    return dealt.mapInPandas(task, "a long, b long")


def exact(groups: pd.DataFrame, cross: bool, words: int, least: float) -> pd.DataFrame:
    """By set: copies of the sets linked with it, and one set for all that links connect. Only sets of one component are linked, and across blocks those of two blocks."""
    sets = [s for run in chunks(groups["text"].tolist()) for s in hashed(run, words)]
    sizes, node, copies = np.array([len(s) for s in sets]), groups["node"].to_numpy(), groups["copies"].to_numpy()
    right = groups["own"].to_numpy() != groups["own"].min() if cross else np.zeros(len(sets), bool)
    owner = np.repeat(np.arange(len(sets)), sizes)
    component = _mixed(groups["component"].to_numpy().astype(np.int64).view(np.uint64), 3)
    code = np.unique(np.concatenate(sets) ^ component[owner], return_inverse=True)[1]
    del sets
    # linked sets share at least this many tokens, whatever the other's size
    needed = np.maximum(1, np.ceil(least * sizes - 1e-6)).astype(np.int64)
    while len(code):
        before = len(code)
        if cross:
            left, other = (np.bincount(code[right[owner] == side], minlength=code.max() + 1) for side in (False, True))
            shared = np.where(right[owner], left[code], other[code]) > 0
        else:
            shared = np.bincount(code)[code] > 1
        shared &= (np.bincount(owner[shared], minlength=len(sizes)) >= needed)[owner]
        code, owner = code[shared], owner[shared]
        if len(code) > 0.98 * before:
            break
    label = np.arange(len(sizes))
    # tokens that went come first, then rare ones: two linked sets have one of their first ones in common
    order = np.lexsort((code, np.bincount(code)[code], owner)) if len(code) else np.arange(0)
    code, owner = code[order], owner[order]
    left = np.bincount(owner, minlength=len(sizes))
    early = np.arange(len(owner)) - (np.cumsum(left) - left)[owner] < (left - needed + 1)[owner]
    by = np.flatnonzero(early)[np.argsort(code[early], kind="stable")]
    same = code[by[1:]] == code[by[:-1]]
    rest, root = contract(owner[by[1:]][same], owner[by[:-1]][same])
    label[rest] = root
    # sets, and tokens behind their sets, by what the first tokens connect
    members = np.lexsort((sizes, label))
    place = np.empty(len(members), np.int64)
    place[members] = np.arange(len(members))
    order = np.argsort(place[owner], kind="stable")
    code, owner = code[order], place[owner[order]]
    begins = np.flatnonzero(np.diff(label[members], prepend=-1))
    begins = np.append(begins, len(members))
    several = np.flatnonzero(np.diff(begins) > 1)
    sizes, right, copies = sizes[members], right[members], copies[members]
    counts = np.zeros(len(members), np.int64)
    heads = np.arange(len(members))
    for start, stop in zip(begins[several], begins[several + 1]):
        low, high = np.searchsorted(owner, [start, stop])
        some = slice(start, stop)
        counts[some], head = linked(code[low:high], owner[low:high] - start, sizes[some], right[some] if cross else None, copies[some], least)
        heads[some] = start + head
    out = pd.DataFrame({"node": node[members], "n": counts, "head": node[members][heads]})
    return out[out["n"] > 0]


def linked(code: np.ndarray, owner: np.ndarray, sizes: np.ndarray, right: np.ndarray | None, copies: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Copies of the sets linked with each of some sets, and the first set that links lead to; sets come by size, tokens by set."""
    n, u, v = np.zeros(len(sizes), np.int64), [], []
    code = np.unique(code, return_inverse=True)[1]
    tokens = int(code.max()) + 1 if len(code) else 0
    starts = np.searchsorted(owner, np.arange(len(sizes) + 1))
    mark = np.random.default_rng(0).integers(2**63, size=len(sizes), dtype=np.uint64)
    for a in range(0, len(sizes), TILE):
        mine = slice(a, min(a + TILE, len(sizes)))
        for b in range(a, len(sizes), TILE):
            theirs = slice(b, min(b + TILE, len(sizes)))
            if sizes[mine.stop - 1] < least * sizes[b] - 1e-6:
                break
            common = in_common(*((code[starts[t.start] : starts[t.stop]], owner[starts[t.start] : starts[t.stop]] - t.start, mark[t]) for t in (mine, theirs)), tokens, a == b)
            near = common >= least * (sizes[mine, None] + sizes[None, theirs] - common) - 1e-6
            if a == b:
                np.fill_diagonal(near, False)
            if right is not None:
                near &= right[mine, None] != right[None, theirs]
            n[mine] += near @ copies[theirs]
            if a != b:
                n[theirs] += copies[mine] @ near
            x, y = edges_across(near)
            both = np.concatenate([np.arange(mine.start, mine.stop), np.arange(theirs.start, theirs.stop)])
            u.append(both[x])
            v.append(both[y])
    rest, root = contract(np.concatenate(u), np.concatenate(v))
    head = np.arange(len(sizes))
    head[rest] = root
    return n, head


def in_common(mine: tuple, theirs: tuple, tokens: int, same: bool) -> np.ndarray:
    """Tokens that each set of one tile has in common with each of another; tokens that the same sets have are multiplied once."""
    (code, owner, mark), (other_code, other_owner, other_mark) = mine, theirs
    has, other_has = np.bincount(code, minlength=tokens), np.bincount(other_code, minlength=tokens)
    shared = has > 1 if same else (has > 0) & (other_has > 0)
    held, other_held = shared[code], shared[other_code]
    code, owner, other_code, other_owner = code[held], owner[held], other_code[other_held], other_owner[other_held]
    sums = np.zeros(tokens, np.uint64)
    np.add.at(sums, code, mark[owner])
    if not same:
        np.add.at(sums, other_code, other_mark[other_owner])
    first, column, times = np.unique(sums[shared], return_index=True, return_inverse=True, return_counts=True)[1:]
    at = np.full(tokens, -1)
    at[shared] = column
    one = np.zeros(tokens, bool)  # a token for each column stands for all
    one[np.flatnonzero(shared)[first]] = True
    out = np.zeros((len(mark), len(other_mark)), np.float32)
    keep, other_keep = one[code], one[other_code]
    column, owner, other_column, other_owner = at[code[keep]], owner[keep], at[other_code[other_keep]], other_owner[other_keep]
    step = 4096
    order, other_order = np.argsort(column, kind="stable"), np.argsort(other_column, kind="stable")
    column, owner, other_column, other_owner = column[order], owner[order], other_column[other_order], other_owner[other_order]
    for low in range(0, len(times), step):
        (p, q), (r, s) = np.searchsorted(column, [low, low + step]), np.searchsorted(other_column, [low, low + step])
        wide = min(step, len(times) - low)
        left, right = np.zeros((len(mark), wide), np.float32), np.zeros((len(other_mark), wide), np.float32)
        left[owner[p:q], column[p:q] - low] = times[column[p:q]]
        right[other_owner[r:s], other_column[r:s] - low] = 1
        out += left @ right.T
    return out


def join(docs: DataFrame, words: int = WORDS, least: float = LEAST, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """row_key, doc_id, class_id (smallest doc_id of the class), n_links (other rows linked directly), keeper (row_key kept of the class)."""
    sets = written(described(docs, words, doc_id, text))
    first = F.struct(F.col("doc_id").isNull(), "doc_id", "row_key")
    merged = sets.groupBy("set_key").agg(F.count("*").alias("copies"), F.min(first).alias("first"), F.first("size").alias("size"), F.first("sketch").alias("sketch"), F.first("low").alias("low"), F.first("chosen").alias("chosen"))
    merged = written(merged.withColumn("node", F.monotonically_increasing_id()).select("node", "set_key", "copies", F.col("first.doc_id").alias("doc_id"), F.col("first.row_key").alias("row_key"), "size", "sketch", "low", "chosen"))
    rough = written(components(candidate_edges(merged, least)))
    members = rough.join(merged.select("node", "row_key", "copies", "size"), "node")
    texts = docs.select(row_key(F.col(doc_id), F.col(text)).alias("row_key"), whole_text(text).alias("text"))
    bodies = written(members.join(texts, "row_key").dropDuplicates(["node"]).select("component", "node", "copies", "size", F.length("text").alias("letters"), "text"))
    full = F.greatest(F.ceil(F.count("*") / F.lit(BLOCK_SETS)), F.ceil(F.sum("letters") / F.lit(BLOCK_BYTES)))
    sizes = bodies.groupBy("component").agg((full > 1).alias("large"), F.count("*").alias("n"), F.sum("letters").alias("letters"))
    n, letters = sizes.where("NOT large").agg(F.sum("n"), F.sum("letters")).first()
    shared = max(1, math.ceil((n or 0) / BLOCK_SETS), math.ceil((letters or 0) / BLOCK_BYTES))
    dealt = in_blocks(bodies.join(sizes.select("component", "large"), "component"), "component", F.col("large"), full, least)
    # small components share blocks, which have numbers below 0
    dealt = dealt.withColumn("at", F.when(F.col("large"), F.col("component")).otherwise(-1 - F.pmod(F.xxhash64("component"), F.lit(shared))))

    def task(key, group):
        return exact(group, key[1] != key[2], words, least)

    found = written(dealt.select("at", "component", "low", "high", "own", "node", "copies", "text").groupBy("at", "low", "high").applyInPandas(task, "node long, n long, head long"))
    classes = components(found.select(F.col("node").alias("a"), F.col("head").alias("b")))
    totals = found.groupBy("node").agg(F.sum("n").alias("n"))
    named = merged.select("node", "set_key", "copies", "doc_id", "row_key").join(classes, "node", "left").join(totals, "node", "left").withColumn("component", F.coalesce("component", "node"))
    heads = named.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row_key")).alias("head"))
    named = named.join(heads, "component").select("set_key", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.col("head.doc_id").alias("class_id"), F.col("head.row_key").alias("keeper"))
    every = docs.select(row_key(F.col(doc_id), F.col(text)).alias("row_key"), F.col(doc_id).cast("long").alias("doc_id"), (F.trim(F.regexp_replace(whole_text(text), "\\s+", " ")) == "").alias("bare"))
    known = sets.select("row_key", "doc_id", "set_key").join(named, "set_key").select("row_key", "doc_id", "class_id", "n_links", "keeper")
    alone = every.join(sets.select("row_key").distinct(), "row_key", "left_anti").select("row_key", "doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"), F.col("row_key").alias("keeper"))
    return known.union(alone)


def deduplicate(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One document of each class, with all its columns; documents without words all stay."""
    key, repeated = unused(docs, "_key", "_repeated")
    keep = join(docs, doc_id=doc_id, text=text, **options).groupBy("row_key").agg(F.max(F.col("row_key") == F.col("keeper")).alias("kept"), F.count("*").alias("_times"), F.max("n_links").alias("links"))
    keep = written(keep.where("kept").select(F.col("row_key").alias(key), ((F.col("_times") > 1) & (F.col("links") > 0)).alias(repeated)))
    kept = docs.withColumn(key, row_key(F.col(doc_id), F.col(text))).join(keep, key)
    once = kept.where(~F.col(repeated)).select(*docs.columns)
    return once.union(kept.where(F.col(repeated)).dropDuplicates([key]).select(*docs.columns))
