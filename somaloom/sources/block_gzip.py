"""Block-compressed call files, read by many tasks and written by one task a file.

A block-gzip file is a chain of gzip members of at most 64 KB whose header gives the member's length. A task
reads the lines that start in the members of its byte range: it looks for the first member at or after the
range's start (a candidate must decode and match its checksum), leaves out the line under way there, and reads
on over its end until the line under way ends. A file that is not block-compressed is an error.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SPAN = 64 << 20
MAGIC = b"\x1f\x8b\x08\x04"
MEMBER = 1 << 16  # fixed by the format: no member is longer
PAYLOAD = 0xFF00
LAST = bytes.fromhex("1f8b08040000000000ff0600424302001b0003000000000000000000")  # fixed by the format: the empty member that ends a file
BATCH_BYTES = 4 << 20


def _store(path: str):
    from pyarrow import fs

    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def _length(head: bytes) -> int | None:
    """Length of the member that starts with ``head``, from its BC field; None when it has none."""
    if len(head) < 18 or not head.startswith(MAGIC):
        return None
    at, end = 12, 12 + struct.unpack_from("<H", head, 10)[0]
    while at + 4 <= min(end, len(head)):
        size = struct.unpack_from("<H", head, at + 2)[0]
        if head[at:at + 2] == b"BC" and size == 2 and at + 6 <= len(head):
            return struct.unpack_from("<H", head, at + 4)[0] + 1
        at += 4 + size
    return None


def _decoded(member: bytes) -> bytes | None:
    try:
        one = zlib.decompressobj(31)
        text = one.decompress(member)
    except zlib.error:
        return None
    return text if one.eof and not one.unused_data else None


def members(f, start: int, size: int) -> Iterator[tuple[int, bytes]]:
    """(offset, text) of the members from the first one at or after ``start``."""
    def read(at: int, n: int) -> bytes:
        f.seek(at)
        return f.read(n)

    window = read(start, min(2 * MEMBER, size - start))
    at = window.find(MAGIC)
    while at >= 0:
        length = _length(window[at:at + MEMBER])
        text = _decoded(read(start + at, length)) if length and start + at + length <= size else None
        if text is not None:
            break
        if start == 0:
            raise ValueError("not a block-compressed file")
        at = window.find(MAGIC, at + 1)
    else:
        if start == 0 and size:
            raise ValueError("not a block-compressed file")
        return
    offset = start + at
    while True:
        yield offset, text
        offset += length
        if offset >= size:
            return
        member = read(offset, MEMBER)
        length = _length(member)
        text = _decoded(member[:length]) if length else None
        if text is None:
            raise ValueError(f"damaged member at byte {offset}")


def lines(f, start: int, end: int, size: int) -> Iterator[bytes]:
    """Lines owned by a byte range: those that start in its members, and the one that starts right behind them."""
    carry: list[bytes] = []
    skipping = start > 0
    for offset, text in members(f, start, size):
        if offset >= end:
            if skipping:
                return
            at = text.find(b"\n")
            carry.append(text if at < 0 else text[:at])
            if at < 0:
                continue
            yield b"".join(carry)
            return
        if skipping:
            at = text.find(b"\n")
            if at < 0:
                continue
            text, skipping = text[at + 1:], False
        *whole, rest = text.split(b"\n")
        if whole:
            yield b"".join([*carry, whole[0]])
            yield from whole[1:]
            carry = []
        carry.append(rest)
    if not skipping and any(carry):
        yield b"".join(carry)


class Span(InputPartition):
    def __init__(self, file: str, start: int, end: int, size: int):
        self.file, self.start, self.end, self.size = file, start, end, size


class CallLineReader(DataSourceReader):
    def __init__(self, options):
        self.path, self.span = options["path"], int(options.get("span", SPAN))
        self.chrom = options.get("chrom")
        self.low, self.high = int(options.get("start", -1)), int(options.get("end", 1 << 62))
        self.placed = self.chrom is not None or "start" in options or "end" in options

    def partitions(self):
        from pyarrow import fs

        store, root = _store(self.path)
        info = store.get_file_info(root)
        if info.type == fs.FileType.NotFound:
            raise FileNotFoundError(self.path)
        files = [info] if info.type == fs.FileType.File else [i for i in store.get_file_info(fs.FileSelector(root, recursive=True)) if i.type == fs.FileType.File and not i.base_name.startswith(("_", "."))]
        return [Span(i.path, at, min(at + self.span, i.size), i.size) for i in files for at in range(0, i.size, self.span)]

    def read(self, part):
        store, _ = _store(self.path)
        with store.open_input_file(part.file) as f:
            names = next((x for x in lines(f, 0, part.size, part.size) if not x.startswith(b"##")), b"")
            samples = names.decode().split("\t")[9:] if names.startswith(b"#CHROM") else []
            rows, held = [], 0
            for line in lines(f, part.start, part.end, part.size):
                if not line or line.startswith(b"#"):
                    continue
                chrom, pos = (*line.split(b"\t", 2), b"", b"")[:2]
                number = int(pos) if pos.isdigit() else None
                if self.placed and (number is None or not self.low <= number <= self.high or self.chrom not in (None, chrom.decode())):
                    continue
                rows.append((chrom.decode(), number, line.decode()))
                held += len(line)
                if held > BATCH_BYTES:
                    yield self.batch(part.file, samples, rows)
                    rows, held = [], 0
            if rows:
                yield self.batch(part.file, samples, rows)

    @staticmethod
    def batch(file: str, samples: list[str], rows: list[tuple]) -> pa.RecordBatch:
        n = len(rows)
        return pa.RecordBatch.from_arrays(
            [pa.array([file] * n), pa.array([samples] * n, pa.list_(pa.string())), pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows])],
            ["file", "samples", "chrom", "pos", "value"])


class CallLines(DataSource):
    """Lines of block-compressed call files with the sample names of their header.

    Options: ``span`` (bytes a task reads), ``chrom``, ``start``, ``end`` (inclusive; lines elsewhere never leave the task).
    """

    @classmethod
    def name(cls) -> str:
        return "call_lines"

    def schema(self) -> str:
        return "file string, samples array<string>, chrom string, pos bigint, value string"

    def reader(self, schema) -> DataSourceReader:
        return CallLineReader(self.options)


def read_call_lines(spark: SparkSession, path: str, span: int = SPAN, chrom: str | None = None, start: int | None = None, end: int | None = None) -> DataFrame:
    """``file, samples, chrom, pos, value`` of the records of a file or of all files of a folder."""
    spark.dataSource.register(CallLines)
    options = {"span": span, "chrom": chrom, "start": start, "end": end}
    return spark.read.format("call_lines").options(**{k: v for k, v in options.items() if v is not None}).load(path)


def _member(text: bytes) -> bytes:
    """One member; a payload that does not shrink is stored."""
    for level in (6, 0):
        squeeze = zlib.compressobj(level, zlib.DEFLATED, -15)
        body = squeeze.compress(text) + squeeze.flush()
        if len(body) + 26 <= MEMBER:
            break
    head = MAGIC + bytes(5) + b"\xff" + struct.pack("<H2sHH", 6, b"BC", 2, len(body) + 25)
    return head + body + struct.pack("<II", zlib.crc32(text), len(text))


def write_call_lines(rows: DataFrame, path: str, file: str = "file", order: str = "line_no", value: str = "value") -> None:
    """Each ``file``'s lines, in their order, as ``<path>/<file>.gz``. A file appears when it is whole; a repeated task writes the same file again."""
    sorted_rows = rows.select(F.col(file).cast("string").alias("file"), F.col(order).alias("line_no"), F.col(value).alias("value")).repartition("file").sortWithinPartitions("file", "line_no")

    def write(batches):
        store, root = _store(path)
        store.create_dir(root, recursive=True)
        name, out, temporary, held = None, None, None, bytearray()

        def close():
            if held:
                out.write(_member(bytes(held)))
                held.clear()
            out.write(LAST)
            out.close()
            store.move(temporary, f"{root}/{name}.gz")

        for batch in batches:
            for own, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if own != name:
                    if out is not None:
                        close()
                    name, temporary = own, f"{root}/.{uuid.uuid4().hex}"
                    out = store.open_output_stream(temporary)
                held += text.encode() + b"\n"
                while len(held) >= PAYLOAD:
                    out.write(_member(bytes(held[:PAYLOAD])))
                    del held[:PAYLOAD]
        if out is not None:
            close()
        yield pa.RecordBatch.from_pydict({"done": pa.array([1], pa.int32())})

    sorted_rows.mapInArrow(write, "done int").count()
