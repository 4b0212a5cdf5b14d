"""Input preparation and shared-folder helpers of the corpus operators."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from somaloom.session import checkpoint_root, cut_lineage

__all__ = ["checkpoint_root", "cut_lineage", "fresh_folder", "open_store", "pick", "slices", "table", "tidy", "unused"]

SLICE_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, cast; every other column is left behind, so no name can clash."""
    return df.select(*[F.col(f"`{name}`").cast(kind).alias(name) for name, kind in columns.items()])


def unused(df: DataFrame, name: str) -> str:
    """A column name like ``name`` that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def fresh_folder(spark: SparkSession, kind: str) -> str:
    """A path of its own in the shared folder."""
    return f"{checkpoint_root(spark)}/{kind}-{uuid.uuid4().hex}"


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into runs of rows whose ``column`` (nulls made empty) holds about ``limit`` bytes.

    A single longer value forms a run of its own; no value is cut.
    """
    for batch in batches:
        at = batch.schema.get_field_index(column)
        kind = batch.schema.field(at).type
        empty = b"" if pa.types.is_binary(kind) or pa.types.is_large_binary(kind) else ""
        batch = batch.set_column(at, batch.schema.field(at), pc.fill_null(batch.column(at), empty))
        sizes = pc.binary_length(batch.column(at)).to_numpy(zero_copy_only=False)
        start, held = 0, 0
        for row, size in enumerate(sizes):
            if row > start and held + size > limit:
                yield batch.slice(start, row - start)
                start, held = row, 0
            held += size
        if start < batch.num_rows:
            yield batch.slice(start)


def _give_back() -> None:
    """Hand freed memory back to the system; a worker process goes on to other tasks and keeps it otherwise."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library keeps no such pools
        pass


def tidy(work: Callable) -> Callable:
    """``work`` over Arrow batches, with memory handed back after each task."""

    def run(batches):
        try:
            yield from work(batches)
        finally:
            _give_back()

    return run


def open_store(path: str):
    """The Arrow file system of a path in the shared folder, and the path inside it."""
    from pyarrow import fs

    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))
