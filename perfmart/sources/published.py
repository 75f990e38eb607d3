"""A published table whose slices are replaced as a whole or not at all.

Every publication writes its files in a folder of its own and then adds one
pointer that names, for every slice, the folder that holds it now:

    <path>/version=<number>-<id>/date=<value>/part-*    files of one publication
    <path>/_current/<number>                            slice and version, by line

Readers follow the last complete pointer.  Until it is there they see the former
slices, whatever has happened to a publication: files without a pointer are
never read.  A pointer is made by an exclusive create and ends with a line that
counts the others, so one that was cut short does not count, and of two
publications that began from the same pointer one is refused.  Pointers hold
one line a slice; rows never pass through the driver.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

POINTERS = "_current"
#: Publications whose files stay when older ones are removed: readers that
#: followed the pointer before the last one can finish.
KEEP = 2


@dataclass(frozen=True)
class Published:
    """What one publication did: rows are counted by the write itself."""
    path: str
    version: str | None     # None: the frame was empty, nothing has changed
    rows: int
    slices: tuple[str, ...]


class ConcurrentPublication(RuntimeError):
    """Another publication has set its pointer first; publish again."""


class _Folder:
    """Hadoop's view of one folder: any store that Spark reads."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm = spark._jvm
        self.path = path.rstrip("/")
        self.root = self.jvm.org.apache.hadoop.fs.Path(self.path)
        self.fs = self.root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def at(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")

    def names(self, name: str = "") -> list[str]:
        place = self.at(name) if name else self.root
        if not self.fs.exists(place):
            return []
        return sorted(s.getPath().getName() for s in self.fs.listStatus(place))

    def read(self, name: str) -> list[str]:
        stream = self.fs.open(self.at(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").split("\n")
        finally:
            stream.close()

    def create(self, name: str, lines: list[str]) -> None:
        """Fails if the file is there already."""
        stream = self.fs.create(self.at(name), False)
        try:
            stream.write(bytearray("\n".join(lines).encode()))
        finally:
            stream.close()

    def delete(self, name: str) -> None:
        self.fs.delete(self.at(name), True)


def _pointer(folder: _Folder, name: str) -> dict[str, str] | None:
    """Slice -> version of one pointer; None if it was cut short."""
    lines = folder.read(f"{POINTERS}/{name}")
    if lines[-1] != f"end {len(lines) - 1}":
        return None
    return dict(line.split("\t") for line in lines[:-1])


def _pointers(folder: _Folder) -> list[str]:
    return [n for n in folder.names(POINTERS) if n.isdigit()]


def current_slices(spark: SparkSession, path: str) -> dict[str, str]:
    """Slice folder name -> version, as readers see the table now."""
    folder = _Folder(spark, path)
    for name in reversed(_pointers(folder)):
        found = _pointer(folder, name)
        if found is not None:
            return found
    return {}


def publish(df: DataFrame, path: str, partition_col: str = "date", fmt: str = "parquet", keep: int = KEEP) -> Published:
    """Replace the slices (values of ``partition_col``) that occur in ``df`` and
    nothing else.  A failure at any moment leaves the former table; repeating a
    publication replaces its slices by themselves.  An empty frame changes
    nothing."""
    spark = df.sparkSession
    folder = _Folder(spark, path)
    numbers = _pointers(folder)
    number = int(numbers[-1]) + 1 if numbers else 1
    now = current_slices(spark, path)
    version = f"{number:012d}-{uuid.uuid4().hex[:8]}"
    counted = Observation()
    (df.observe(counted, F.count(F.lit(1)).alias("rows"))
       .write.partitionBy(partition_col).format(fmt).save(f"{folder.path}/version={version}"))
    rows = int(counted.get["rows"])
    made = tuple(n for n in folder.names(f"version={version}") if n.startswith(f"{partition_col}="))
    if not made:
        folder.delete(f"version={version}")
        return Published(path, None, 0, ())
    _set_pointer(folder, number, {**now, **dict.fromkeys(made, version)})
    _remove_old(folder, number, keep)
    return Published(path, version, rows, made)


def _set_pointer(folder: _Folder, number: int, slices: dict[str, str]) -> None:
    lines = [f"{name}\t{version}" for name, version in sorted(slices.items())]
    try:
        folder.create(f"{POINTERS}/{number:012d}", [*lines, f"end {len(lines)}"])
    except Exception as e:
        if folder.fs.exists(folder.at(f"{POINTERS}/{number:012d}")):
            raise ConcurrentPublication(f"{folder.path}: pointer {number} is set already") from e
        raise


def _remove_old(folder: _Folder, number: int, keep: int) -> None:
    """Folders that none of the last ``keep`` complete pointers names, and the
    pointers before these.  Later publications' folders are left alone."""
    kept: list[dict[str, str]] = []
    names = _pointers(folder)
    while names and len(kept) < keep:
        found = _pointer(folder, names.pop())
        if found is not None:
            kept.append(found)
    used = {v for slices in kept for v in slices.values()}
    for name in folder.names():
        version = name.removeprefix("version=")
        if version != name and version not in used and int(version.split("-")[0]) <= number:
            folder.delete(name)
    for name in names:
        folder.delete(f"{POINTERS}/{name}")


def read(spark: SparkSession, path: str, fmt: str = "parquet", schema: StructType | None = None) -> DataFrame:
    """The table as its last complete pointer has it.  With ``schema`` (the
    slice column included), also one to which nothing has been published."""
    slices = current_slices(spark, path)
    if not slices:
        if schema is None:
            raise FileNotFoundError(f"nothing has been published in {path}")
        return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])
    root = path.rstrip("/")
    reader = spark.read.format(fmt).option("basePath", root)
    if schema is not None:
        reader = reader.schema(StructType([*schema.fields, StructField("version", StringType())]))
    return reader.load([f"{root}/version={v}/{s}" for s, v in sorted(slices.items())]).drop("version")
