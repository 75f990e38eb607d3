"""Shared helpers: table access, Arrow batches, and word hashing in numpy.

Text is handled as UTF-8 bytes.  Words are maximal runs of bytes accepted by a
256-entry table, found for a whole batch at once, and hashed to 64 bits by a
polynomial whose prefix sums give any word's or word sequence's value.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

#: Text bytes handled at once inside a task; one longer text is a slice of its own.
SLICE_BYTES = 1 << 19
#: Bytes of an Arrow batch between Spark and Python, in sessions that do not set them
#: (Spark's own limit is 64 MB, which the JVM and the worker both hold).
BATCH_BYTES, _BATCH_SETTING = 4 << 20, "spark.sql.execution.arrow.maxBytesPerBatch"


def bound_batches(spark: SparkSession) -> None:
    """Bounds Arrow batches by ``BATCH_BYTES``; a setting of the session stays."""
    if spark.conf.get(_BATCH_SETTING, None) is None:
        spark.conf.set(_BATCH_SETTING, str(BATCH_BYTES))


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The named columns of one input table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet").select(*columns)


def annotate(docs: DataFrame, fields: str, make: Callable[[], Callable[[list], list]],
             text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """``docs`` packed in the struct column ``row`` (so no name can clash) with
    computed columns beside it.  ``make()`` runs once a task and returns a
    function from a list of texts (bytes or None) to one list per field.
    ``carry``: the columns that ``row`` keeps (default: all)."""
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    extra = StructType.fromDDL(fields)
    whole = packed.schema["row"].dataType
    kept = whole if carry is None else StructType([whole[c] for c in carry])
    schema = StructType([StructField("row", kept, False), *extra.fields])
    from pyspark.sql.pandas.types import to_arrow_schema
    kinds = [f.type for f in to_arrow_schema(extra)]
    names = ["row", *extra.names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        for batch in batches:
            for part in slices(batch, text):
                texts = text_bytes(part.column(0), text)
                out = fn(texts)
                row = part.column(0)
                if carry is not None:
                    row = pa.StructArray.from_arrays([pc.struct_field(row, [c]) for c in carry], names=carry)
                yield pa.RecordBatch.from_arrays(
                    [row, *[pa.array(v, type=k) for v, k in zip(out, kinds, strict=True)]], names)

    return packed.mapInArrow(run, schema)


def text_bytes(rows: pa.StructArray, text: str) -> list:
    """The texts as bytes or None.  ``text``: a field, or a path of fields with dots."""
    return pc.struct_field(rows, text.split(".")).cast(pa.binary()).to_pylist()


def slices(batch: pa.RecordBatch, text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of about ``limit`` bytes of text."""
    size = pc.fill_null(pc.binary_length(pc.struct_field(batch.column(0), text.split("."))), 0).to_numpy(zero_copy_only=False)
    at = np.cumsum(size.astype(np.int64) + 64)
    i = 0
    while i < batch.num_rows:
        base = at[i - 1] if i else 0
        j = max(i + 1, int(np.searchsorted(at, base + limit, "right")))
        yield batch.slice(i, j - i)
        i = j


def lookup(accepts: Callable[[int], bool]) -> np.ndarray:
    return np.array([accepts(b) for b in range(256)])


#: [^\x20\x09-\x0D]+ : everything but ASCII white space.
NOT_SPACE = lookup(lambda b: b != 0x20 and not 0x09 <= b <= 0x0D)
#: [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ : ASCII digits, a-z (after lower-casing) and all beyond ASCII.
ALNUM = lookup(lambda b: 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80)
_LOWER = np.array([b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)], dtype=np.uint8)

_BASE = 0x9E3779B97F4A7C15 | 1
_WORD_BASE = 0xD6E8FEB86659FD93 | 1
_MASK = (1 << 64) - 1
_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**i modulo 2**64 for i < n, kept between calls."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        have = np.full(size, base & _MASK, dtype=np.uint64)
        have[0] = 1
        have = np.multiply.accumulate(have)
        _POWERS[base] = have
    return have[:n]


def _inverse(base: int) -> int:
    return pow(base, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words:
    """The words of a list of texts: byte ``start``/``end`` in ``buf``, 64-bit
    ``hash``, and ``first``: word offsets of each text (len(texts) + 1)."""

    def __init__(self, texts: list, accepts: np.ndarray, lower: bool = False):
        joined = b" ".join(t or b"" for t in texts) + b" "
        self.buf = np.frombuffer(joined, dtype=np.uint8)
        if lower:
            self.buf = _LOWER[self.buf]
        sizes = np.array([len(t or b"") + 1 for t in texts], dtype=np.int64)
        self.at = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        inside = accepts[self.buf].view(np.int8)
        step = np.diff(inside, prepend=np.int8(0))
        self.start = np.flatnonzero(step == 1)
        self.end = np.flatnonzero(step == -1)
        self.first = np.searchsorted(self.start, self.at)
        self._hash = None

    @property
    def hash(self) -> np.ndarray:
        if self._hash is None:
            n = len(self.buf)
            total = np.zeros(n + 1, dtype=np.uint64)
            np.cumsum((self.buf.astype(np.uint64) + np.uint64(1)) * powers(_BASE, n), out=total[1:])
            value = (total[self.end] - total[self.start]) * powers(_inverse(_BASE), n)[self.start]
            self._hash = mix(value + (self.end - self.start).astype(np.uint64) * np.uint64(0xA0761D6478BD642F))
        return self._hash

    def gram(self, k: int) -> np.ndarray:
        """Hash of the k words from each position (the last k - 1 positions of
        a text run over its end: mask them with ``whole``)."""
        h = self.hash
        n = len(h)
        total = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(h * powers(_WORD_BASE, n), out=total[1:])
        stop = np.minimum(np.arange(n) + k, n)
        return mix((total[stop] - total[:n]) * powers(_inverse(_WORD_BASE), n)[:n])

    def whole(self, k: int) -> np.ndarray:
        """Positions that start k words of one text."""
        n = len(self.start)
        ok = np.zeros(n + 1, dtype=np.int32)
        last = np.maximum(self.first[1:] - k + 1, self.first[:-1])
        np.add.at(ok, self.first[:-1], 1)
        np.add.at(ok, last, -1)
        return np.cumsum(ok)[:n] > 0

    def span_hash(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Hash of the words lo..hi-1 for each pair."""
        h = self.hash
        n = len(h)
        total = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(h * powers(_WORD_BASE, max(n, 1))[:n], out=total[1:])
        inv = powers(_inverse(_WORD_BASE), n + 1)
        return mix((total[hi] - total[lo]) * inv[lo] + (hi - lo).astype(np.uint64) * np.uint64(0xE7037ED1A0B428DB))
