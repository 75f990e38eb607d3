"""A counting sketch of 64-bit hashes: a fixed number of counters, added up on
the executors in two rounds, whatever the number of rows and of tasks."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK_BITS = 16
#: Partial sums of the first round, at most; each joins so many tasks at least.
SALTS, TASKS_A_SALT = 64, 8


def packed(counts: np.ndarray) -> bytes:
    """Counters in as few bytes each as the largest needs, byte by byte: the low
    bytes of all come first, so that the zeros above them take hardly any room."""
    width = next(w for w in (1, 2, 4, 8) if w == 8 or int(counts.max(initial=0)) < 1 << 8 * w)
    planes = counts.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T
    press = zlib.compressobj(1, zlib.DEFLATED, zlib.MAX_WBITS, 9, zlib.Z_RLE)
    return bytes([width]) + press.compress(planes.tobytes()) + press.flush()


def unpacked(data: bytes) -> np.ndarray:
    """The counters that ``packed`` has written."""
    width = data[0]
    planes = np.frombuffer(zlib.decompress(data[1:]), np.uint8).reshape(width, -1)
    return np.ascontiguousarray(planes.T).view(f"<u{width}").ravel().astype(np.uint64)


def count_sketch(rows: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], Iterator[np.ndarray]]], bits: int) -> np.ndarray:
    """2**bits levels (bytes): 0 where nothing fell, else 1 + 4 * log2(count).
    ``make()`` runs once a task; its function gives the hashes of a batch, piece
    by piece."""
    chunk = 1 << CHUNK_BITS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        hashes = make()
        counts = np.zeros(1 << bits, dtype=np.uint32)
        for h in (h for batch in batches for h in hashes(batch)):
            if len(h):
                at, n = np.unique(h & np.uint64((1 << bits) - 1), return_counts=True)
                counts[at.astype(np.int64)] += n.astype(np.uint32)
        used = [(i, c) for i, c in enumerate(counts.reshape(-1, min(chunk, 1 << bits))) if c.any()]
        salt = TaskContext.get().partitionId() // TASKS_A_SALT % SALTS
        yield pa.RecordBatch.from_arrays(
            [pa.array([i for i, _ in used], pa.int32()), pa.array([salt] * len(used), pa.int32()),
             pa.array([packed(c) for _, c in used], pa.binary())],
            ["chunk", "salt", "counts"])

    def add(parts: pd.DataFrame) -> pd.DataFrame:
        total = None
        for c in parts["counts"]:
            x = unpacked(bytes(c))
            total = x if total is None else total + x
        return pd.DataFrame({"chunk": parts["chunk"].iloc[:1], "salt": parts["salt"].iloc[:1],
                             "counts": [packed(total)]})

    schema = "chunk int, salt int, counts binary"
    parts = (rows.mapInArrow(run, schema).groupBy("chunk", "salt").applyInPandas(add, schema)
                 .groupBy("chunk").applyInPandas(add, schema))
    level = np.zeros(1 << bits, dtype=np.uint8)
    for r in parts.select("chunk", "counts").toLocalIterator():
        c = unpacked(bytes(r.counts))
        level[r.chunk * chunk:r.chunk * chunk + len(c)] = np.where(
            c > 0, np.minimum(255, 1 + np.floor(4 * np.log2(np.maximum(c, 1)))), 0).astype(np.uint8)
    return level


#: Bits for a key of an id filter, and positions that a key sets.
KEY_BITS, PROBES = 16, 2
#: Largest filter: 2**FILTER_BITS bits (64 MB).  Beyond, keys are joined.
FILTER_BITS = 29


def without_ids(rows: DataFrame, column: str, gone: DataFrame) -> DataFrame:
    """``rows`` whose ``column`` is not among ``gone`` (id).  Rows that the id
    filter already clears stay where they are; only the others are joined."""
    ids = gone.select(F.col("id").alias("__gone"))
    test = id_filter(gone)
    if test is None:
        return rows.join(ids, F.col(f"`{column}`") == F.col("__gone"), "left_anti")

    @F.pandas_udf("boolean")
    def maybe(x: pd.Series) -> pd.Series:
        return pd.Series(test(x.fillna(0).to_numpy().astype(np.int64)))

    suspect = F.col(f"`{column}`").isNotNull() & maybe(F.col(f"`{column}`").cast("bigint"))
    checked = rows.where(suspect).join(ids, F.col(f"`{column}`") == F.col("__gone"), "left_anti")
    return rows.where(~suspect).unionByName(checked)


def _places(x: np.ndarray, bits: int) -> list[np.ndarray]:
    """The positions that each key sets."""
    from perfmart.llm.text import mix
    h = mix(x.astype(np.int64).view(np.uint64))
    low = np.uint64((1 << bits) - 1)
    return [(h >> np.uint64(32 * p)) & low if bits <= 32 else mix(h + np.uint64(p)) & low for p in range(PROBES)]


def id_filter(ids: DataFrame, most: int = FILTER_BITS) -> Callable[[np.ndarray], np.ndarray] | None:
    """A test that is true for each id of the one-column frame, and for about
    two of a hundred others: ``KEY_BITS`` bits for a key, so it is as selective
    for many keys as for few.  None if that takes more than 2**``most`` bits.
    The bits are set and joined on the executors."""
    bits = max(CHUNK_BITS, (KEY_BITS * ids.count() - 1).bit_length())
    if bits > most:
        return None
    size = min(1 << CHUNK_BITS, 1 << (bits - 3))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        field = np.zeros(1 << (bits - 3), dtype=np.uint8)
        for batch in batches:
            for at in _places(batch.column(0).to_numpy(zero_copy_only=False), bits):
                np.bitwise_or.at(field, (at >> np.uint64(3)).astype(np.int64), np.left_shift(1, (at & np.uint64(7)).astype(np.uint8), dtype=np.uint8))
        salt = TaskContext.get().partitionId() % SALTS
        used = [(i, c) for i, c in enumerate(field.reshape(-1, size)) if c.any()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([i for i, _ in used], pa.int32()), pa.array([salt] * len(used), pa.int32()),
             pa.array([zlib.compress(c.tobytes(), 1) for _, c in used], pa.binary())], ["chunk", "salt", "bits"])

    def either(parts: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(size, dtype=np.uint8)
        for c in parts["bits"]:
            total |= np.frombuffer(zlib.decompress(c), dtype=np.uint8)
        return pd.DataFrame({"chunk": parts["chunk"].iloc[:1], "salt": parts["salt"].iloc[:1], "bits": [zlib.compress(total.tobytes(), 1)]})

    schema = "chunk int, salt int, bits binary"
    parts = ids.mapInArrow(run, schema).groupBy("chunk", "salt").applyInPandas(either, schema).groupBy("chunk").applyInPandas(either, schema)
    field = np.zeros(1 << (bits - 3), dtype=np.uint8)
    for r in parts.select("chunk", "bits").toLocalIterator():
        field[r.chunk * size:(r.chunk + 1) * size] = np.frombuffer(zlib.decompress(bytes(r.bits)), dtype=np.uint8)
    shared = ids.sparkSession.sparkContext.broadcast(field)

    def test(x: np.ndarray) -> np.ndarray:
        field, out = shared.value, np.ones(len(x), dtype=bool)
        for at in _places(x, bits):
            out &= (field[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0
        return out
    return test
