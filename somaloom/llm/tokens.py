"""Token-ID output: shards of independent zstandard frames with a trailing seek table.

A shard is a plain zstandard file, in the public seekable layout::

    frame 0 .. frame n-1      one per document: its ids, little-endian, 2 or 4 bytes each
    skippable frame           magic 0x184D2A50: the doc ids (8 bytes each) and a null flag each
    skippable frame           magic 0x184D2A5E: per frame its compressed size, its size, and the low
                              32 bits of its XXH64; then count, descriptor, magic 0x8F92EAB1

A reader seeks to the table at the end, then reads and decompresses only the frames
of the documents asked for, and checks each against its checksum.

Each task streams its range of documents to files of its own in the shared folder and
returns their names; the manifest, a table that Spark commits, says which files count.
A lost or repeated task leaves files that no manifest names.

Defined results: a null or empty text is the end id alone; a null ``doc_id`` keeps its null
and stands first; repeated rows are written once each, side by side; an empty table gives no
shard; other columns are ignored. Texts are never cut: a long one is one frame.
"""

from __future__ import annotations

import hashlib
import itertools
import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut_lineage, fresh_folder, open_store, pick, slices, tidy
from .words import NON_SPACE, Words, raw_bytes, split

INDEX_MAGIC, TABLE_MAGIC, END_MAGIC = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
SHARD_BYTES = 64 << 20
CACHED_WORDS = 3 << 18

_LETTERS = np.array([97 <= b <= 122 for b in range(256)])
_MARKS = np.array([chr(b) in ".,!$%&*#;:?" for b in range(256)])  # neither white space nor part of a contraction or special token


class WordEncoder:
    """Encode texts with a tokenizer that drops white space, one distinct word at a time.

    Such a tokenizer treats the runs between white space alone, and never joins an ASCII letter to one
    of the marks of ``_MARKS``, so ids of a text are those of its parts in order. Parts are known by
    hash and remembered in one pool of ids; parts of letters only are encoded many at a time. The
    pool starts anew when it holds ``CACHED_WORDS`` parts, so its size is bounded.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        for token, number in vocabulary.items():
            self.ends[number] = token.endswith("</w>")
        self.forget()

    def forget(self) -> None:
        self.place: dict[int, int] = {}
        self.pool = np.zeros(1 << 16, np.int32)
        self.starts = np.zeros(1 << 16, np.int64)  # part k has the ids starts[k] .. starts[k + 1]

    def _encode(self, words: list[str]) -> list[tuple[int, ...]]:
        known: dict[str, tuple[int, ...]] = {}
        plain = [w for w in words if w.isalpha()]
        for at in range(0, len(plain), 1000):
            some = plain[at : at + 1000]
            found = np.array(self.tokenizer.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, np.int64)
            cuts = (np.flatnonzero(self.ends[found]) + 1).tolist()
            if len(cuts) == len(some):  # else some letter's lower case is more than a letter
                flat = found.tolist()
                known.update(zip(some, map(tuple, (flat[a:b] for a, b in zip([0, *cuts], cuts)))))
        return [known[w] if w in known else tuple(self.tokenizer.encode(w, add_special_tokens=False).ids) for w in words]

    def _learn(self, hashes: list[int], words: list[str]) -> None:
        ids, first = self._encode(words), len(self.place)
        used = int(self.starts[first])
        flat = np.fromiter(itertools.chain.from_iterable(ids), np.int32)
        self.place.update(zip(hashes, range(first, first + len(words))))
        self.pool = _room(self.pool, used + len(flat))
        self.pool[used : used + len(flat)] = flat
        self.starts = _room(self.starts, first + len(words) + 1)
        self.starts[first + 1 : first + len(words) + 1] = used + np.cumsum([len(i) for i in ids])

    @staticmethod
    def _cased(texts: pa.Array, parts: Words) -> dict[int, str]:
        """Parts with the opening of a special token and capitals, which decide whether it is one; they get hashes of their own."""
        opens = np.flatnonzero((parts.data[:-1] == 60) & (parts.data[1:] == 124))
        out = {}
        if len(opens):
            raw = raw_bytes(texts)[0]
            for k in np.unique(np.searchsorted(parts.starts, opens, "right") - 1).tolist():
                own = raw[parts.starts[k] : parts.ends[k]].tobytes()
                if own != parts.data[parts.starts[k] : parts.ends[k]].tobytes():
                    out[k] = own.decode()
                    parts.hashes[k] = int.from_bytes(hashlib.blake2b(own, digest_size=8).digest(), "little")
        return out

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in order, and where each text's begin (one more than there are texts)."""
        if len(self.place) > CACHED_WORDS:
            self.forget()
        parts = split(texts, NON_SPACE, apart=(_LETTERS, _MARKS))
        cased = self._cased(texts, parts)
        codes, hashes = pd.factorize(parts.hashes)
        known = np.fromiter(map(self.place.get, hashes.tolist(), itertools.repeat(-1)), np.int64, len(hashes))
        new = np.flatnonzero(known < 0)
        if len(new):
            where = np.empty(len(hashes), np.int64)
            where[codes[::-1]] = np.arange(len(codes))[::-1]
            raw = parts.data.tobytes()
            first = len(self.place)
            self._learn(hashes[new].tolist(), [cased.get(k) or raw[parts.starts[k] : parts.ends[k]].decode() for k in where[new].tolist()])
            known[new] = np.arange(first, first + len(new))
        found = known[codes]
        begins = self.starts[found]
        sizes = self.starts[found + 1] - begins
        ends = np.concatenate([[0], np.cumsum(sizes)])
        ids = self.pool[np.repeat(begins - ends[:-1], sizes) + np.arange(ends[-1])]
        return ids, ends[parts.firsts]


def _room(array: np.ndarray, size: int) -> np.ndarray:
    """``array``, grown so that it holds ``size`` values."""
    return array if size <= len(array) else np.concatenate([array, np.zeros(max(size - len(array), len(array)), array.dtype)])


_encoders: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


class ShardWriter:
    """One shard, written as it grows."""

    def __init__(self, path: str, width: int):
        import zstandard

        store, inner = open_store(path)
        if path.startswith("file:") or "://" not in path:
            store.create_dir(inner.rsplit("/", 1)[0], recursive=True)
        self.path, self.width, self.out = path, width, store.open_output_stream(inner, compression=None)
        self.packer = zstandard.ZstdCompressor(level=3, write_checksum=False)
        self.table, self.doc_ids, self.n_tokens, self.size = [], [], 0, 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        import xxhash

        raw = ids.astype("<u2" if self.width == 2 else "<u4").tobytes()
        frame = self.packer.compress(raw)
        self.out.write(frame)
        self.table.append((len(frame), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
        self.doc_ids.append(doc_id)
        self.n_tokens += len(ids)
        self.size += len(frame)

    def close(self) -> dict:
        index = np.array([d or 0 for d in self.doc_ids], "<i8").tobytes() + bytes(d is None for d in self.doc_ids)
        self.out.write(struct.pack("<II", INDEX_MAGIC, len(index)) + index)
        entries = np.array(self.table, "<u4").tobytes()
        self.out.write(struct.pack("<II", TABLE_MAGIC, len(entries) + 9) + entries + struct.pack("<IBI", len(self.table), 0x80, END_MAGIC))
        self.out.close()
        return {"path": self.path, "width": self.width, "n_docs": len(self.table), "n_tokens": self.n_tokens}


class ShardReader:
    """Random access to the documents of a shard."""

    def __init__(self, path: str, width: int):
        store, inner = open_store(path)
        self.file, self.width = store.open_input_file(inner), width
        size = self.file.size()
        self.file.seek(size - 9)
        count, descriptor, magic = struct.unpack("<IBI", self.file.read(9))
        if magic != END_MAGIC or descriptor != 0x80:
            raise ValueError(f"{path}: no seek table")
        table_at = size - 9 - 12 * count - 8
        self.file.seek(table_at - 9 * count - 8)
        tail = self.file.read(8 + 9 * count + 8 + 12 * count)
        if struct.unpack_from("<II", tail) != (INDEX_MAGIC, 9 * count) or struct.unpack_from("<II", tail, 8 + 9 * count) != (TABLE_MAGIC, 12 * count + 9):
            raise ValueError(f"{path}: broken seek table")
        self.doc_ids = np.frombuffer(tail, "<i8", count, 8)
        self.missing = np.frombuffer(tail, np.uint8, count, 8 + 8 * count).astype(bool)
        table = np.frombuffer(tail, "<u4", 3 * count, 16 + 9 * count).reshape(count, 3).astype(np.int64)
        self.sizes, self.lengths, self.checks = table.T
        self.places = np.concatenate([[0], np.cumsum(self.sizes)])
        self.starts = np.concatenate([[0], np.cumsum(self.lengths // width)])

    def ids(self, k: int) -> bytes:
        """Ids of document k as little-endian unsigned 32-bit integers."""
        import xxhash
        import zstandard

        self.file.seek(int(self.places[k]))
        raw = zstandard.ZstdDecompressor().decompress(self.file.read(int(self.sizes[k])), max_output_size=int(self.lengths[k]))
        if len(raw) != self.lengths[k] or xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != self.checks[k]:
            raise ValueError(f"checksum of frame {k}")
        return raw if self.width == 4 else np.frombuffer(raw, "<u2").astype("<u4").tobytes()


MANIFEST = "shard long, path string, width int, n_docs long, n_tokens long"


def write_tokens(docs: DataFrame, tokenizer: str, end_id: int, order: list[str] | None = None, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Encode ``docs`` (doc_id, text and the ``order`` columns), write shards in ``order``; return the manifest.

    The order columns should be short: Spark samples them to cut the ranges.

    The manifest (shard, path, width, n_docs, n_tokens) ascends with ``shard`` as the documents do.
    """
    spark = docs.sparkSession
    if order is None:
        order, docs = ["doc_id", "tie"], docs.select("doc_id", "text", F.xxhash64("text").alias("tie"))
    folder = fresh_folder(spark, "tokens")
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ordered = docs.repartitionByRange(int(max(1, total // (shard_bytes // 4) + 1)), *order).sortWithinPartitions(*order).select("doc_id", "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, task, shard, made = encoder(tokenizer), TaskContext.get().partitionId(), None, []
        width = 2 if max(len(encode.ends) - 1, end_id, encode.tokenizer.get_vocab_size() - 1) < 1 << 16 else 4
        for batch in slices(batches, "text"):
            flat, cuts = encode(batch.column(1))
            for doc_id, start, end in zip(batch.column(0).to_pylist(), cuts[:-1].tolist(), cuts[1:].tolist()):
                if shard is None:
                    shard = ShardWriter(f"{folder}/shard-{task:06d}-{len(made):04d}-{uuid.uuid4().hex}.ids.zst", width)
                shard.add(doc_id, np.append(flat[start:end], end_id))
                if shard.size >= shard_bytes:
                    made.append(shard.close() | {"shard": task * 1_000_000 + len(made)})
                    shard = None
        if shard is not None:
            made.append(shard.close() | {"shard": task * 1_000_000 + len(made)})
        encode.forget()  # the worker process goes on to other tasks
        names = ["shard", "path", "width", "n_docs", "n_tokens"]
        kinds = [pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array([m[n] for m in made], k) for n, k in zip(names, kinds)], names=names)

    return cut_lineage(ordered.mapInArrow(tidy(write), MANIFEST))


def read_tokens(manifest: DataFrame, wanted: list[int] | None = None) -> DataFrame:
    """Documents of the shards: doc_id, start (ids of all documents before it), ids (binary, 4 bytes each).

    ``wanted`` names the doc ids to read; other frames are passed over without decompression.
    """
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one small row a shard
    named = manifest.withColumn("before", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))
    n_shards = max(1, manifest.count())
    asked = None if wanted is None else np.unique(np.array(wanted, np.int64))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                shard = ShardReader(row["path"], row["width"])
                rows = np.arange(len(shard.sizes)) if asked is None else np.flatnonzero(np.isin(shard.doc_ids, asked) & ~shard.missing)
                for some in np.split(rows, np.flatnonzero(np.diff(np.cumsum(shard.lengths[rows]) // (1 << 20))) + 1):
                    yield pa.RecordBatch.from_arrays([
                        pa.array([None if shard.missing[k] else int(shard.doc_ids[k]) for k in some], pa.int64()),
                        pa.array((shard.starts[some] + row["before"]).tolist(), pa.int64()),
                        pa.array([shard.ids(k) for k in some.tolist()], pa.binary())], names=["doc_id", "start", "ids"])

    return named.select("shard", "path", "width", "before").repartitionByRange(n_shards, "shard").mapInArrow(tidy(read), "doc_id long, start long, ids binary")


def token_digests(documents: DataFrame) -> DataFrame:
    """Per document: doc_id, start, n_tokens, ids_crc32."""
    return documents.select("doc_id", "start", F.expr("cast(octet_length(ids) div 4 as long)").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


def token_output(docs: DataFrame, tokenizer: str, end_id: int, order: list[str] | None = None) -> DataFrame:
    """Write ``docs`` as token shards and read them back as digests."""
    kept = pick(docs, doc_id="long", text="string") if order is None else docs
    return token_digests(read_tokens(write_tokens(kept, tokenizer, end_id, order)))
