"""An append that can be repeated: files of a batch and a ledger of batches.

    <path>/batch=<id>/part-*.parquet   files of one batch
    <path>/_ledger/<slice>.<digest>    one entry for each batch that counts

A data source writer: tasks write Parquet files of their own; only when all have
succeeded does the commit add an entry.  The entry's name is the slice and the digest of the batch's rows (their count and the sums
of two 64-bit hashes, whatever their order and partitions), so a batch that is
appended again, by a retried job or a second one at the same moment, finds its
entry and leaves no second copy.  An aborted append leaves no file that counts.

The folder must be one that the driver and all executors share.  File names come
from the task, so a lost executor's attempt never mixes with its repetition:
files that the commit does not know are removed by it.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

FORMAT = "perfmart_ledger"
LEDGER = "_ledger"
#: Hash columns that travel with the rows and are not stored.
HASHES = ("__h1", "__h2")
_MASK = (1 << 64) - 1


def _filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    """Any store that Arrow reaches; a path without a scheme is a shared mount."""
    if "://" not in path and not path.startswith("file:"):
        return pafs.LocalFileSystem(), path
    return pafs.FileSystem.from_uri(path if "://" in path else path.replace("file:", "file://", 1))


@dataclass
class Part(WriterCommitMessage):
    file: str | None
    rows: int
    sums: tuple[int, int]


class LedgerWriter(DataSourceArrowWriter):
    def __init__(self, options: dict, schema: StructType):
        self.path, self.slice = options["path"].rstrip("/"), options["slice"]
        self.batch = uuid.uuid4().hex
        self.columns = [f.name for f in schema.fields if f.name not in HASHES]

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Part:
        from pyspark import TaskContext

        fs, root = _filesystem(self.path)
        at = TaskContext.get()
        name = f"part-{at.partitionId():06d}-{at.taskAttemptId()}.parquet"
        writer, rows, sums = None, 0, [0, 0]
        try:
            for batch in iterator:
                if not batch.num_rows:
                    continue
                for i, h in enumerate(HASHES):
                    halves = batch.column(h).cast(pa.int64())
                    # 64-bit sums in two halves, so that none overflows
                    low = pc.sum(pc.bit_wise_and(halves, (1 << 32) - 1)).as_py()
                    high = pc.sum(pc.shift_right(halves, 32)).as_py()
                    sums[i] = (sums[i] + low + (high << 32)) & _MASK
                data = batch.select(self.columns)
                if writer is None:
                    fs.create_dir(f"{root}/batch={self.batch}", recursive=True)
                    writer = pq.ParquetWriter(f"{root}/batch={self.batch}/{name}", data.schema, filesystem=fs)
                writer.write_batch(data)
                rows += data.num_rows
        finally:
            if writer is not None:
                writer.close()
        return Part(name if writer is not None else None, rows, (sums[0], sums[1]))

    def commit(self, messages: list) -> None:
        """All tasks have succeeded: the batch counts, unless it did already."""
        fs, root = _filesystem(self.path)
        parts = [m for m in messages if m is not None]
        rows = sum(p.rows for p in parts)
        if not rows:
            return
        known = {p.file for p in parts}
        folder = f"{root}/batch={self.batch}"
        for f in fs.get_file_info(pafs.FileSelector(folder)):
            if f.base_name not in known:  # of an attempt that was repeated
                fs.delete_file(f.path)
        sums = [sum(p.sums[i] for p in parts) & _MASK for i in (0, 1)]
        if not _enter(fs, root, f"{self.slice}.{rows:x}-{sums[0]:016x}{sums[1]:016x}", self.batch):
            fs.delete_dir(folder)

    def abort(self, messages: list) -> None:
        fs, root = _filesystem(self.path)
        folder = f"{root}/batch={self.batch}"
        if fs.get_file_info(folder).type != pafs.FileType.NotFound:
            fs.delete_dir(folder)


def _enter(fs: pafs.FileSystem, root: str, name: str, batch: str) -> bool:
    """Add an entry; False if it is there.  An entry is a folder that holds an
    empty folder with the batch's name; of batches that enter at the same moment
    one counts (``_batch_of``), the same one for every reader."""
    entry = f"{root}/{LEDGER}/{name}"
    if _batch_of(fs, entry) is not None:
        return False
    fs.create_dir(f"{entry}/{batch}", recursive=True)
    return _batch_of(fs, entry) == batch


def _batch_of(fs: pafs.FileSystem, entry: str) -> str | None:
    """The batch that an entry names: of several that were added at the same
    moment the first by name, for every reader."""
    if fs.get_file_info(entry).type == pafs.FileType.NotFound:
        return None
    return min((f.base_name for f in fs.get_file_info(pafs.FileSelector(entry))), default=None)


class LedgerSource(DataSource):
    """``df.write.format(FORMAT).option("path", ...).option("slice", ...)``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema: StructType, overwrite: bool) -> LedgerWriter:
        if overwrite:
            raise ValueError("a ledger is appended to")
        return LedgerWriter(self.options, schema)


def append_once(df: DataFrame, path: str, slice_name: str) -> None:
    """Append ``df`` as a batch of ``slice_name``, unless the same rows have been
    appended to that slice before.  An empty frame appends nothing."""
    if not slice_name or any(c in slice_name for c in "./\\"):
        raise ValueError(f"not a slice name: {slice_name!r}")
    df.sparkSession.dataSource.register(LedgerSource)
    columns = [F.col(f"`{c}`") for c in df.columns]
    # nulls count by their place: a hash skips them
    marks = F.concat(*[F.when(c.isNull(), F.lit("0")).otherwise(F.lit("1")) for c in columns])
    hashed = df.withColumns({HASHES[0]: F.xxhash64(marks, *columns), HASHES[1]: F.xxhash64(F.lit(7), *columns, marks)})
    hashed.write.format(FORMAT).mode("append").option("path", path).option("slice", slice_name).save()


def batches(path: str) -> dict[str, str]:
    """Ledger entry -> batch."""
    fs, root = _filesystem(path.rstrip("/"))
    if fs.get_file_info(f"{root}/{LEDGER}").type == pafs.FileType.NotFound:
        return {}
    found = {f.base_name: _batch_of(fs, f.path) for f in fs.get_file_info(pafs.FileSelector(f"{root}/{LEDGER}"))}
    return {entry: batch for entry, batch in found.items() if batch is not None}


def read_appended(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The rows of all batches that count."""
    root = path.rstrip("/")
    folders = [f"{root}/batch={b}" for b in sorted(set(batches(path).values()))]
    if not folders:
        return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])
    return spark.read.schema(schema).parquet(*folders)
