"""Best-fit packing with linear grouping.

Documents become token ids and an end id; those over the capacity are cut into full pieces, of which the
first may be shorter. Lengths are whole numbers up to the capacity, so their histogram has at most as
many rows as the capacity: the plan is made on it, whatever the number of documents. Large lengths are
put in groups of equal cardinality and rounded up to the largest of their group; sequences are composed
of these few sizes; then actual lengths take the places of the rounded ones, and small lengths are fitted
best into what is left. The plan is a bounded list of stretches of equal sequences. A document finds its
place by its rank among pieces of its length: rank in the task plus a running total over tasks.

Null texts are empty and consist of the end id. Repeated rows are packed each. An empty table gives an
empty result. Only id and text are read; ``keep_ids`` keeps the ids (little-endian, unsigned 32 bits).
"""

from __future__ import annotations

import functools
import os
from bisect import bisect_left, insort
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from slatecraft.llm.frames import whole_text, written

PIECES = "doc_id long, piece int, start long, length int, ids binary, task int, task_rank long"
#: Chunks between spaces whose ids a worker remembers in each of two generations.
MEMO = 600_000
#: Text that is tokenised together, in bytes; a longer text is taken alone.
TOGETHER = 6_000_000
#: A space next to other white space, in any script.
_MEETS = r" [\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]|[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}] "


@functools.lru_cache(maxsize=2)
def encoder(path: str):
    """Arrow texts to one array of ids and where each text's begin in it.

    Between two single spaces ids don't depend on what lies around. So the chunks between the spaces of many texts are
    numbered first, each distinct one is looked up or encoded once, and the ids are gathered by number. A worker keeps
    the memory for its next tasks, in two generations: what is asked for again moves to the young one, and once that
    is full, the old one goes. Where white space meets a space, the whole text is encoded as it is.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    young: dict[str, bytes] = {}
    old: dict[str, bytes] = {}
    space = tokenizer.encode(" a", add_special_tokens=False).tokens[0][0]
    words = tokenizer.get_vocab(with_added_tokens=True)
    opens = np.zeros(max(words.values()) + 1, bool)
    opens[[i for w, i in words.items() if w.startswith(space)]] = True

    def encoded(texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encoded_chunks(chunks: list[str]) -> list[bytes]:
        """As one text; a chunk holds no space but the one before it, so its first id is the only one that opens with a space."""
        if not chunks:
            return []
        ids = np.array(tokenizer.encode_batch_fast([" " + " ".join(chunks)], add_special_tokens=False)[0].ids, "<u4")
        at = np.flatnonzero(opens[ids])
        if len(at) != len(chunks) or "" in chunks or at[0]:
            return encoded([" " + c for c in chunks])
        raw, at = ids.tobytes(), (np.append(at, len(ids)) * 4).tolist()
        return [raw[a:b] for a, b in zip(at, at[1:])]

    def of_chunks(chunks: list[str]) -> list[bytes]:
        nonlocal young, old
        if len(young) > MEMO:
            young, old = {}, young
        unknown = [c for c in chunks if c not in young]
        young.update((c, old[c]) for c in unknown if c in old)
        new = [c for c in unknown if c not in old]
        for lo in range(0, len(new), 2000):
            young.update(zip(new[lo : lo + 2000], encoded_chunks(new[lo : lo + 2000])))
        return [young[c] for c in chunks]

    def encode(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        whole = pc.match_substring_regex(texts, _MEETS).to_numpy(zero_copy_only=False)
        # a text that is taken whole is its first chunk and has no others
        split = pc.split_pattern(pc.if_else(pa.array(whole), "", texts), " ")
        coded = split.flatten().dictionary_encode()
        number = coded.indices.to_numpy().astype(np.int64)
        bounds = np.append(0, np.cumsum(pc.list_value_length(split).to_numpy())).astype(np.int64)
        at = bounds[:-1]
        firsts = coded.take(pa.array(at)).cast(texts.type)
        table = of_chunks(coded.dictionary.to_pylist())
        number[at] = len(table) + np.arange(len(texts))
        table += encoded(pc.if_else(pa.array(whole), texts, firsts).to_pylist())
        size = np.array([len(x) for x in table], np.int64) // 4
        start = np.append(0, np.cumsum(size))
        taken = size[number]
        ends = np.append(0, np.cumsum(taken))
        ids = np.frombuffer(b"".join(table), "<u4")[np.repeat(start[number] - ends[:-1], taken) + np.arange(ends[-1])]
        return ids, ends[bounds]

    return encode


def _together(texts: pa.Array):
    """Ranges of rows with about ``TOGETHER`` bytes, one row at least."""
    start = held = 0
    for i, size in enumerate(pc.binary_length(texts).to_pylist()):
        if held and held + size > TOGETHER:
            yield start, i
            start = i
            held = 0
        held += size
    if start < len(texts):
        yield start, len(texts)


def pieces(docs: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 2, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids, and the rank among the task's pieces of that length."""

    def cut(batches):
        encode, task = encoder(tokenizer), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            names, texts = batch.column(0), batch.column(1).cast(pa.large_string())
            for a, b in _together(texts):
                ids, begin = encode(texts[a:b])
                ids = np.insert(ids, begin[1:], end_id).astype("<u4")
                begin = begin + np.arange(len(begin))
                total = np.diff(begin)
                count = -(-total // capacity)
                doc = np.repeat(np.arange(b - a), count)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
                stop = total[doc] - (count[doc] - 1 - piece) * capacity
                start = np.maximum(stop - capacity, 0)
                length = stop - start
                # rank among the pieces of one length: those of the task so far, then in order
                order = np.argsort(length, kind="stable")
                ordered = length[order]
                new = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
                rank = np.empty(len(doc), np.int64)
                rank[order] = np.arange(len(doc)) - np.repeat(new, np.diff(np.append(new, len(doc)))) + seen[ordered]
                seen += np.bincount(length, minlength=capacity + 1)
                bounds = np.append(begin[doc] + start, begin[-1]) * 4
                yield pa.RecordBatch.from_arrays(
                    [
                        names[a:b].take(pa.array(doc)),
                        pa.array(piece.astype(np.int32)),
                        pa.array(start),
                        pa.array(length.astype(np.int32)),
                        pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(doc), [None, pa.py_buffer(bounds), pa.py_buffer(ids.tobytes())]).cast(pa.binary()),
                        pa.array(np.full(len(doc), task, np.int32)),
                        pa.array(rank),
                    ],
                    names=["doc_id", "piece", "start", "length", "ids", "task", "task_rank"],
                )

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), whole_text(text).alias("text"))
    return rows.mapInArrow(cut, PIECES)


def _compose(sizes: dict[int, int], capacity: int) -> list[tuple[int, list[int]]]:
    """Sequences of a few sizes: (how many, sizes in each). Each round fills one sequence as far as the sizes allow,
    starting with the largest, and repeats it while they last."""
    left, out = {s: c for s, c in sizes.items() if c}, []
    while left:
        order = sorted(left, reverse=True)
        room = capacity - order[0]
        reach, steps, full = 1, [], (1 << (room + 1)) - 1
        for s in order:
            for _ in range(min(left[s] - (s == order[0]), room // s)):
                more = (reach | reach << s) & full
                if more == reach:
                    break
                steps.append((s, reach))
                reach = more
        at, pattern = reach.bit_length() - 1, [order[0]]
        for s, before in reversed(steps):
            if not before >> at & 1:
                pattern.append(s)
                at -= s
        need = Counter(pattern)
        times = min(left[s] // n for s, n in need.items())
        out.append((times, sorted(pattern, reverse=True)))
        for s, n in need.items():
            left[s] -= n * times
            if not left[s]:
                del left[s]
    return out


def plan(histogram: dict[int, int], capacity: int, groups: int = 256, small: float = 0.25) -> list[tuple[int, list[tuple[int, int]]]]:
    """Stretches of equal sequences: (how many, [(length, times in each)]), from how many pieces have which length."""
    large = sorted((n, c) for n, c in histogram.items() if n > small * capacity)[::-1]
    total, group, queues, taken = sum(c for _, c in large), [], {}, 0
    for n, c in large:  # equal cardinality; a length is not split over groups
        if group and taken >= total / groups:
            queues[group[0][0]], group, taken = group, [], 0
        group.append([n, c])
        taken += c
    if group:
        queues[group[0][0]] = group
    open_: dict[int, list[list]] = defaultdict(list)  # room left: [how many, lengths]
    rooms: list[int] = []

    def add(count: int, lengths: list[tuple[int, int]], room: int) -> None:
        if room not in open_ or not open_[room]:
            insort(rooms, room)
        open_[room].append([count, lengths])

    for times, pattern in _compose({s: sum(c for _, c in q) for s, q in queues.items()}, capacity):
        while times:  # substitute actual lengths, a stretch of equal ones at a time
            need, firsts = Counter(pattern), []
            for s, n in need.items():
                firsts.append((s, n, queues[s][0]))
            step = min([times, *(f[1] // n for s, n, f in firsts)])
            if step:
                lengths = [(f[0], n) for _, n, f in firsts]
                for _, n, f in firsts:
                    f[1] -= n * step
            else:  # one sequence across the end of a stretch
                step, got = 1, Counter()
                for s, n, _ in firsts:
                    for _ in range(n):
                        while not queues[s][0][1]:
                            queues[s].pop(0)
                        queues[s][0][1] -= 1
                        got[queues[s][0][0]] += 1
                lengths = list(got.items())
            for s in need:
                while queues[s] and not queues[s][0][1]:
                    queues[s].pop(0)
            times -= step
            add(step, lengths, capacity - sum(n * k for n, k in lengths))
    for n, c in sorted(((n, c) for n, c in histogram.items() if n <= small * capacity), reverse=True):
        while c:
            at = bisect_left(rooms, n)
            if at == len(rooms):  # nothing fits: new sequences
                each = capacity // n
                if c >= each:
                    add(c // each, [(n, each)], capacity - each * n)
                if c % each:
                    add(1, [(n, c % each)], capacity - c % each * n)
                break
            room = rooms[at]
            stretch = open_[room][-1]
            each = min(room // n, c)
            times = min(stretch[0], c // each)
            stretch[0] -= times
            lengths = stretch[1]
            if not stretch[0]:
                open_[room].pop()
                if not open_[room]:
                    rooms.pop(at)
            add(times, [*lengths, (n, each)], room - each * n)
            c -= times * each
    return [(count, lengths) for stretches in open_.values() for count, lengths in stretches if count]


def places(stretches: list[tuple[int, list[tuple[int, int]]]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, rank after the last, first sequence, offset, times in each)."""
    rank, sequence, rows = Counter(), 0, []
    for count, lengths in stretches:
        offset = 0
        for n, each in lengths:
            rows.append((n, rank[n], rank[n] + count * each, sequence, offset, each))
            rank[n] += count * each
            offset += n * each
        sequence += count
    return rows


def place(cut: DataFrame, capacity: int = 1024) -> DataFrame:
    """Adds sequence_id and offset to written pieces; task and task_rank go."""
    spark = cut.sparkSession
    counts = cut.groupBy("task", "length").agg(F.count("*").alias("n"))
    counts = written(counts)
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most one row for each length
    rows = places(plan(histogram, capacity))
    where = spark.createDataFrame(rows or [(0, 0, 0, 0, 0, 1)], "length int, low long, high long, first long, at long, each long")
    ranked = cut.join(starts, ["task", "length"]).withColumn("rank", F.col("before") + F.col("task_rank"))
    # bounded by the lengths there are, not by the documents
    return (
        ranked.join(F.broadcast(where), "length")
        .where("rank >= low AND rank < high")
        .withColumn("sequence_id", F.col("first") + F.expr("(rank - low) DIV each"))
        .withColumn("offset", F.col("at") + (F.col("rank") - F.col("low")) % F.col("each") * F.col("length"))
        .drop("task", "task_rank", "before", "rank", "low", "high", "first", "at", "each")
    )


def pack(docs: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 2, keep_ids: bool = True, **columns) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset, and with ``keep_ids`` the ids."""
    cut = pieces(docs, tokenizer, capacity, end_id, **columns).withColumn("ids_crc32", F.crc32("ids"))
    return place(written(cut if keep_ids else cut.drop("ids")), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id and its ids, from packed pieces with ids."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit("").cast("binary"), lambda a, p: F.concat(a, p["ids"]))
    return packed.groupBy("sequence_id").agg(joined.alias("ids"))
