"""Sorted runs of numbers: columns packed as bytes, cut by range of their first column.

Operators that count hashed n-grams or id pairs over a whole corpus exchange
them as such runs: a chunk of documents sends one row for each range, a task
meets all chunks' rows of a range, one range after the other.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame


def pack(columns: list[np.ndarray]) -> bytes:
    """Columns of one length as compressed bytes, each split into the planes of its bytes."""
    n = len(columns[0])
    raw = b"".join(np.ascontiguousarray(c).view(np.uint8).reshape(n, c.itemsize).T.tobytes() for c in columns) if n else b""
    return n.to_bytes(4, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def unpack(blob: bytes, kinds: list[str]) -> list[np.ndarray]:
    n, sizes = int.from_bytes(blob[:4], "little"), [np.dtype(k).itemsize for k in kinds]
    if not n:
        return [np.empty(0, k) for k in kinds]
    raw = np.frombuffer(pa.decompress(blob[4:], decompressed_size=n * sum(sizes), codec="zstd", asbytes=True), np.uint8)
    parts = np.split(raw, np.cumsum(sizes)[:-1] * n)
    return [np.ascontiguousarray(p.reshape(i, n).T).view(k).ravel() for p, i, k in zip(parts, sizes, kinds)]


def pack_sorted(columns: list[np.ndarray]) -> bytes:
    """As `pack`; the first column ascends and travels as differences."""
    return pack([np.diff(columns[0], prepend=columns[0].dtype.type(0)), *columns[1:]])


def unpack_sorted(blob: bytes, kinds: list[str]) -> list[np.ndarray]:
    got = unpack(blob, kinds)
    return [np.cumsum(got[0], dtype=got[0].dtype), *got[1:]]


def cuts(keys: np.ndarray, shift: int) -> tuple[np.ndarray, np.ndarray]:
    """Ranges of ascending keys by their bits above `shift`: each range's number and where it starts, with the end."""
    top = keys >> keys.dtype.type(shift)
    at = np.flatnonzero(np.concatenate([[True], top[1:] != top[:-1]])) if len(keys) else np.empty(0, int)
    return top[at].astype(np.int64), np.append(at, len(keys))


def ranges(total: int, held: int, least: int = 6, most: int = 12) -> int:
    """Bits for the number of ranges that keeps about `held` entries of
    `total` in each. `most` keeps a run's share of a range from getting tiny."""
    return min(most, max(least, (max(1, total) // held).bit_length()))


def packed_texts(src: DataFrame, chunk_bytes: int) -> DataFrame:
    """(chunk, blob): the rows of `src` (its column `text` is binary) in
    chunks of about `chunk_bytes` of text (16 more for each row);
    `unpack_texts` reads a blob."""
    def run(batches):
        part, made, held, size = TaskContext.get().partitionId() << 24, 0, [], 0

        def flush():
            table, sink = pa.Table.from_batches(held), pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                out.write_table(table.combine_chunks())
            return pa.RecordBatch.from_arrays([pa.array([part + made], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary())],
                                              ["chunk", "blob"])

        for b in batches:
            size_of = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(b.column("text")), 0), dtype=np.int64) + 16)
            at = 0
            while at < b.num_rows:
                before = size_of[at - 1] if at else 0
                end = min(b.num_rows, int(np.searchsorted(size_of, before + chunk_bytes - size)) + 1)
                held.append(b.slice(at, end - at))
                size += int(size_of[end - 1] - before)
                at = end
                if size >= chunk_bytes:
                    yield flush()
                    held, size, made = [], 0, made + 1
        if held:
            yield flush()

    return src.mapInArrow(run, "chunk long, blob binary")


def unpack_texts(blob: bytes) -> pa.Table:
    return pa.ipc.open_stream(blob).read_all()


def met(rows: DataFrame, key: str, schema: str, answer: Callable[[int, list[tuple]], Iterator[pa.RecordBatch]]) -> DataFrame:
    """`answer(key, rows)` for the rows of each key, as tuples: one key after
    the other in a task, never several at once."""
    names = [key, *(c for c in rows.columns if c != key)]

    def run(batches):
        held, now = [], None
        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns)):
                if held and row[0] != now:
                    yield from answer(now, held)
                    held = []
                now = row[0]
                held.append(row[1:])
        if held:
            yield from answer(now, held)

    return rows.select(*names).repartition(key).sortWithinPartitions(key).mapInArrow(run, schema)


def hashed(words, seed: int) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(w, seed) for w in words), np.uint64)


def mixed(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Hashes of pairs of hashes, in order."""
    z = (x + np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xD6E8FEB86659FD93)
    z ^= z >> np.uint64(32)
    z = (z + y) * np.uint64(0xBF58476D1CE4E5B9)
    z ^= z >> np.uint64(29)
    z *= np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(32))
