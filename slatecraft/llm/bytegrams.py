"""Windows of bytes of whole texts, packed into integers, and lookups of such integers."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import DataFrame

#: Ends a text; never occurs in UTF-8. Zero bytes stand before it.
END = b"\xff"
#: Bytes of texts worked on at a time (a longer text is worked on alone).
CHUNK = 1 << 20
#: Rows that a task packs at a time.
PACK_ROWS = 1 << 20
#: Of the generator that deals keys to shards; its products stay below 64 bits.
MODULUS, FACTOR = (1 << 31) - 1, 48_271


def encoded(column) -> Iterator[bytes]:
    """The bytes of the texts of an Arrow column, one at a time; null is empty."""
    return ((t.as_py() or "").encode("utf-8", "surrogatepass") for t in column)


def chunks(texts: Iterable[bytes]):
    """Runs of texts of about CHUNK bytes."""
    run, size = [], 0
    for text in texts:
        run.append(text)
        size += len(text)
        if size >= CHUNK:
            yield run
            run, size = [], 0
    if run:
        yield run


def keys(texts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """For every byte of every text, and its end: that byte and the ones before, ``width`` in all; lengths by text."""
    before = b"\0" * (width - 1)
    joined = np.frombuffer(b"".join([p for t in texts for p in (before, t, END)]), np.uint8)
    packed = np.zeros(len(joined) - width + 1, np.int64)
    for k in range(width):
        packed <<= 8
        packed |= joined[k : len(joined) - width + 1 + k]
    lengths = np.array([len(t) + 1 for t in texts], np.int64)
    # windows that end among the zeros before a text belong to none
    inside = np.ones(len(packed), bool)
    starts = np.cumsum(lengths + width - 1)[:-1]
    for k in range(1, width):
        inside[starts - k] = False
    return packed[inside], lengths


def by_text(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, np.concatenate([[0], np.cumsum(lengths)[:-1]])) if len(lengths) else np.zeros(0)


def distinct(values: np.ndarray) -> np.ndarray:
    """As ``np.unique``, which hashes: sorting whole numbers takes a sixth of its time."""
    values = np.sort(values)
    return values[np.append(True, values[1:] != values[:-1])] if len(values) else values


def shard(key, number: int):
    """The shard of a key that is not negative, the same for a Spark column and for an array."""
    return key % MODULUS * FACTOR % MODULUS % number


def dealt(key: np.ndarray, number: int) -> list[tuple[int, np.ndarray]]:
    """The shards that the keys fall into, and the positions of their keys, ascending."""
    own = shard(key, number)
    order = np.argsort(own, kind="stable")
    own = own[order]
    starts = np.flatnonzero(np.diff(own, prepend=-1))
    return list(zip(own[starts].tolist(), np.split(order, starts[1:])))


class Lookup:
    """From sorted integers to values; ``at`` gives positions, -1 where there is none."""

    def __init__(self, sorted_keys: np.ndarray):
        self.keys = sorted_keys
        bits = max(4, int(len(sorted_keys)).bit_length() + 1)
        self.shift = np.uint64(64 - bits)
        self.slots = np.full(1 << bits, -1, np.int32)
        self.slots[self._slot(sorted_keys)] = np.arange(len(sorted_keys), dtype=np.int32)

    def _slot(self, wanted: np.ndarray) -> np.ndarray:
        return ((wanted.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).view(np.int64)

    def at(self, wanted: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.full(len(wanted), -1, np.int32)
        found = self.slots[self._slot(wanted)]
        wrong = np.flatnonzero((found < 0) | (self.keys[found] != wanted))
        if len(wrong):  # another one has the slot, or it is not there
            rest = wanted[wrong]
            place = np.minimum(np.searchsorted(self.keys, rest), len(self.keys) - 1)
            found[wrong] = np.where(self.keys[place] == rest, place, -1)
        return found


def tables(batches):
    """Arrow batches, as tables of about PACK_ROWS."""
    import pyarrow as pa

    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= PACK_ROWS:
            yield pa.Table.from_batches(held)
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held)


def squeezed(values: np.ndarray) -> bytes:
    """Numbers of 8 bytes, first bytes first: like bytes lie together and take little room."""
    import pyarrow as pa

    return pa.compress(np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8).T).tobytes(), codec="zstd", asbytes=True)


def unsqueezed(data: bytes, n: int, kind: type) -> np.ndarray:
    import pyarrow as pa

    raw = pa.decompress(data, decompressed_size=8 * n, codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, n).T).view(kind).ravel()


def stored(rows) -> bytes:
    """An Arrow batch as compressed bytes."""
    import pyarrow as pa

    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 6))) as out:
        out.write_batch(rows)
    return sink.getvalue().to_pybytes()


def restored(data: bytes):
    """The batch, as a table."""
    import pyarrow as pa

    return pa.ipc.open_stream(data).read_all()


def packed(answers: DataFrame) -> DataFrame:
    """block, n, keys, numbers: block, key and lp of each task as a row for each of its blocks, by key, compressed.

    Millions of answers to a block are then some hundred rows to sort, move and hand over.
    """

    def pack(batches):
        import pyarrow as pa

        for table in tables(batches):
            block, key, lp = (table.column(c).to_numpy() for c in ("block", "key", "lp"))
            order = np.lexsort((key, block))
            block, key, lp = block[order], key[order], lp[order]
            starts = np.concatenate([[0], np.flatnonzero(np.diff(block)) + 1])
            ends = np.append(starts[1:], len(block))
            yield pa.record_batch(
                {
                    "block": pa.array(block[starts]),
                    "n": pa.array(ends - starts, pa.int64()),
                    "keys": pa.array([squeezed(np.diff(key[i:j], prepend=0)) for i, j in zip(starts, ends)], pa.binary()),
                    "numbers": pa.array([squeezed(lp[i:j]) for i, j in zip(starts, ends)], pa.binary()),
                }
            )

    kind = answers.schema["block"].dataType.simpleString()
    return answers.select("block", "key", "lp").mapInArrow(pack, f"block {kind}, n long, keys binary, numbers binary")


def unpacked(found) -> tuple[np.ndarray, np.ndarray]:
    """Keys, sorted, and their lp from packed rows (an Arrow table)."""
    key, lp = [np.empty(0, np.int64)], [np.empty(0)]
    for n, k, v in zip(*(found.column(c).to_pylist() for c in ("n", "keys", "numbers"))):
        key.append(np.cumsum(unsqueezed(k, n, np.int64)))
        lp.append(unsqueezed(v, n, np.float64))
    key = np.concatenate(key)
    order = np.argsort(key)
    return key[order], np.concatenate(lp)[order]
