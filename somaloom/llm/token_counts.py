"""Token counts from pre-token frequencies, without a token id ever being stored.

A tokenizer never joins pieces over the edge of a pre-token, so the tokens of a text are the sum, over
its distinct pre-tokens, of frequency times number of pieces. The job does just that:

1. tasks cut chunks of texts into pre-tokens. A chunk's distinct pre-tokens become rows; which of them each
   document holds how often goes, packed, to a file of the task, which the chunk's own row names;
2. the distinct pre-tokens of all chunks meet by value, and each is given to the tokenizer's model once; a
   pre-token however common is there once a chunk, not once a document;
3. the piece counts go back to their chunk, meet the frequencies of its documents, and are summed.

Pre-tokens are cut by the tokenizer's own normalizer and pre-tokenizer and compared as whole strings. Two kinds
of ``.json`` are known: those that drop white space (runs between ASCII white space are then cut once a chunk,
not once a place) and byte-level ones without a normalizer. Another kind, and a ``.model`` file, is refused with ``ValueError``.

Files count once the table of chunks, which Spark commits, names them; a lost or repeated task leaves files
that no row names.

Defined results: a null text is empty; an empty one has 0 bytes and 0 tokens; rows with a null or
repeated ``doc_id`` are counted each for itself; texts are never cut off, a long one is read in blocks that
end between pre-tokens; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpoint_root, fresh_folder, open_store, pick, slices, tidy

LIMIT = 2048
CHUNK_BYTES = 16 << 20
BLOCK_CHARS = 1 << 20
HELD = 1 << 18  # numbers that wait to be packed
ROWS = 1 << 14

WHOLE = " "  # marks what the whole tokenizer must read, as a place with an added token; byte-level spelling has no blank

CHUNKS = "chunk long, place int, word string, path string, start long, size long"
COUNTED = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


class Cutter:
    """Cuts texts into pre-tokens, spelled as the tokenizer's model takes them, and counts the pieces of one."""

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        if not path.endswith(".json"):
            raise ValueError(f"{path}: no known way to cut pre-tokens")
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        normalizer, pre, added = spec.get("normalizer") or {}, spec.get("pre_tokenizer") or {}, spec.get("added_tokens") or []
        steps = pre.get("pretokenizers", [])
        drops = bool(steps) and steps[0]["type"] == "Split" and steps[0]["behavior"] == "Removed" and steps[0]["invert"]
        drops = drops and [s["type"] for s in steps[1:]] == ["ByteLevel"] and not any(steps[1].get(k) for k in ("add_prefix_space", "use_regex"))
        drops = drops and all(s["type"] in ("NFC", "Replace", "Lowercase") for s in normalizer.get("normalizers", []))
        plain = not normalizer and pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space")
        if not drops and not plain or any(" " in t["content"] or t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in added):
            raise ValueError(f"{path}: no known way to cut pre-tokens")
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        normalize = self.tokenizer.normalizer.normalize_str if normalizer else str
        split = self.tokenizer.pre_tokenizer.pre_tokenize_str
        special = regex.compile("(" + "|".join(regex.escape(t["content"]) for t in added) + ")").split if added else lambda text: [text]
        lowers = drops and split(normalize("Ab")) == [("ab", (0, 2))]

        def cut(unit: str) -> list[str]:
            if lowers and unit.isascii() and unit.isalpha():
                return [unit.lower()]
            parts = special(unit)
            return [w for k, part in enumerate(parts) for w in ([WHOLE + part] if k % 2 else [p for p, _ in split(normalize(part))])]

        self.cut = cut
        #: strings whose pre-tokens are those of the text together: runs without white space, or the text itself
        self.units: Callable[[str], list[str]] = regex.compile(r"[^ \t-\r]+").findall if drops else lambda text: [text]
        self.by_unit = drops

    def pieces(self, words: list[str]) -> list[int]:
        model, whole = self.model.tokenize, self.tokenizer.encode
        return [len(whole(w[1:], add_special_tokens=False).ids) if w.startswith(WHOLE) else len(model(w)) for w in words]


class _Numbers(dict):
    """Numbers strings in the order of their first use."""

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        return number


def _blocks(text: str, limit: int = BLOCK_CHARS) -> Iterator[str]:
    """Parts of a long text; each ends before a lone blank between two other characters, where no pre-token goes on."""
    import regex

    edge, start = regex.compile(r"(?<=\S) (?=[A-Za-z0-9])"), 0
    while len(text) - start > limit:
        found = edge.search(text, start + limit)
        if found is None:
            break
        yield text[start : found.start()]
        start = found.start()
    yield text[start:] if start else text


def _varied(numbers: np.ndarray) -> bytes:
    """Unsigned numbers as seven-bit groups, low first, the high bit set on all but the last."""
    numbers = numbers.astype(np.uint64)
    size = np.ones(len(numbers), np.int64)
    for k in range(1, 10):
        size += numbers >= np.uint64(1 << 7 * k)
    ends = np.cumsum(size)
    out = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
    for k in range(int(size.max()) if len(size) else 0):
        has = np.flatnonzero(size > k)
        more = np.where(size[has] > k + 1, 128, 0).astype(np.uint64)
        out[(ends - size)[has] + k] = ((numbers[has] >> np.uint64(7 * k)) & np.uint64(127)) | more
    return out.tobytes()


def _read(data: bytes) -> np.ndarray:
    """The numbers that ``_varied`` packed."""
    raw = np.frombuffer(data, np.uint8)
    first = np.concatenate([[0], np.flatnonzero(raw < 128) + 1])
    size = np.diff(first)
    first = first[:-1]
    out = (raw[first] & 127).astype(np.uint64)
    for k in range(1, int(size.max()) if len(size) else 0):
        has = np.flatnonzero(size > k)
        out[has] |= (raw[first[has] + k] & np.uint8(127)).astype(np.uint64) << np.uint64(7 * k)
    return out


class _Chunk:
    """Distinct pre-tokens of the documents read so far, and their packed frequencies."""

    def __init__(self, cutter: Cutter):
        self.cutter, self.units, self.words = cutter, _Numbers(), _Numbers()
        self.inside, self.firsts = np.zeros(1 << 10, np.int32), np.zeros(1 << 10, np.int64)  # pre-tokens of unit k: inside[firsts[k] : firsts[k + 1]]
        self.known, self.held, self.n_docs, self.waiting, self.n_waiting, self.packed = 0, 0, 0, [], 0, []

    def _learn(self, fresh: list[str]) -> None:
        found = [[self.words[w] for w in self.cutter.cut(unit)] for unit in fresh]
        ends = self.firsts[self.known] + np.cumsum([len(f) for f in found])
        self.inside, self.firsts = _room(self.inside, int(ends[-1])), _room(self.firsts, self.known + len(fresh) + 1)
        self.inside[self.firsts[self.known] : ends[-1]] = [n for f in found for n in f]
        self.firsts[self.known + 1 : self.known + len(fresh) + 1] = ends
        self.known += len(fresh)

    def _block(self, block: str) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the distinct pre-tokens of a block of text, and how often each stands."""
        if not self.cutter.by_unit:
            words = self.cutter.cut(block)
            return np.unique(np.fromiter(map(self.words.__getitem__, words), np.int64, len(words)), return_counts=True)
        units = self.cutter.units(block)
        codes, n = np.unique(np.fromiter(map(self.units.__getitem__, units), np.int64, len(units)), return_counts=True)
        if len(self.units) > self.known:  # new units have the largest numbers, in the order they came
            self._learn(list(dict.fromkeys(u for u in units if self.units[u] >= self.known)))
        sizes = self.firsts[codes + 1] - self.firsts[codes]
        ends = np.cumsum(sizes)
        words = self.inside[np.repeat(self.firsts[codes] - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)]
        return _summed(words, np.repeat(n, sizes))

    def add(self, doc_id: int | None, text: str) -> None:
        found, times = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for block in _blocks(text):
            codes, n = self._block(block)
            found, times = _summed(np.concatenate([found, codes]), np.concatenate([times, n])) if len(found) else (codes, n)
        size = len(text.encode())
        self.held += size
        self.n_docs += 1
        head = [0, 0] if doc_id is None else [1, int(doc_id) & (1 << 64) - 1]
        self.waiting.append(np.concatenate([np.array([*head, size, len(found)], np.uint64), np.diff(found, prepend=0).astype(np.uint64), times.astype(np.uint64)]))
        self.n_waiting += len(self.waiting[-1])
        if self.n_waiting > HELD:
            self.pack()

    def pack(self) -> None:
        if self.waiting:
            self.packed.append(_varied(np.concatenate(self.waiting)))
        self.waiting, self.n_waiting = [], 0


def _summed(values: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values, ascending, with the sum of their times."""
    order = np.argsort(values, kind="stable")
    values, times = values[order].astype(np.int64), times[order]
    firsts = np.flatnonzero(np.diff(values, prepend=-1))
    return values[firsts], np.add.reduceat(times, firsts) if len(firsts) else times


def _room(array: np.ndarray, size: int) -> np.ndarray:
    """``array``, grown so that it holds ``size`` values."""
    return array if size <= len(array) else np.concatenate([array, np.zeros(max(size - len(array), len(array) // 2), array.dtype)])


def pre_token_chunks(docs: DataFrame, tokenizer: str, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Rows (chunk, place, word) of each chunk's distinct pre-tokens, and a row (chunk, -1, path, start, size) that names its frequencies."""
    folder = fresh_folder(docs.sparkSession, "pre-tokens")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        cutter, task, path, out, at, made = Cutter(tokenizer), TaskContext.get().partitionId(), f"{folder}/uses-{uuid.uuid4().hex}.zst", None, 0, 0
        packer = zstandard.ZstdCompressor(level=1)

        def rows(chunk: _Chunk) -> Iterator[pa.RecordBatch]:
            nonlocal out, at, made
            if out is None:
                store, inner = open_store(path)
                if path.startswith("file:") or "://" not in path:
                    store.create_dir(inner.rsplit("/", 1)[0], recursive=True)
                out = store.open_output_stream(inner, compression=None)
            chunk.pack()
            packed = packer.compress(b"".join(chunk.packed))
            out.write(packed)
            words = list(chunk.words)
            number = task * (1 << 24) + made
            for k in range(0, len(words), ROWS):
                some = words[k : k + ROWS]
                yield _chunk_rows([number] * len(some), range(k, k + len(some)), some, [None] * len(some), [None] * len(some), [None] * len(some))
            yield _chunk_rows([number], [-1], [None], [path], [at], [len(packed)])
            at, made = at + len(packed), made + 1

        chunk = _Chunk(cutter)
        for batch in slices(batches, "text"):
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                chunk.add(doc_id, text)
                if chunk.held >= chunk_bytes:
                    yield from rows(chunk)
                    chunk = _Chunk(cutter)
        if chunk.n_docs:
            yield from rows(chunk)
        if out is not None:
            out.close()

    spark = docs.sparkSession
    made = docs.mapInArrow(tidy(read), CHUNKS)
    path = f"{checkpoint_root(spark)}/table-{uuid.uuid4().hex}"
    made.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(made.schema).parquet(path)


def _chunk_rows(*columns) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=[c.split()[0] for c in CHUNKS.split(", ")])


def piece_counts(words: DataFrame, tokenizer: str) -> DataFrame:
    """(chunk, place, n) of (chunk, place, word): each distinct word is given to the tokenizer once."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter, before, pieces = Cutter(tokenizer), None, 0
        for batch in batches:  # equal words stand together, maybe over the edge of a batch
            runs = batch.column(2).dictionary_encode()
            distinct = runs.dictionary.to_pylist()
            known = bool(distinct) and distinct[0] == before
            n = np.array([pieces] * known + cutter.pieces(distinct[known:]), np.int64)
            if len(distinct):
                before, pieces = distinct[-1], int(n[-1])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n[runs.indices.to_numpy()], pa.int64())], names=["chunk", "place", "n"])

    return words.select("chunk", "place", "word").repartition("word").sortWithinPartitions("word").mapInArrow(tidy(count), "chunk long, place int, n long")


def count_tokens(docs: DataFrame, tokenizer: str, limit: int = LIMIT, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Bytes and tokens of each row of (doc_id, text), and whether it has more than ``limit`` tokens."""
    Cutter(tokenizer)  # an unknown kind is refused before any work
    chunks = pre_token_chunks(pick(docs, doc_id="long", text="string").fillna({"text": ""}), tokenizer, chunk_bytes)
    counted = piece_counts(chunks.filter("place >= 0"), tokenizer)
    both = F.shiftleft(F.col("place").cast("long"), 32) + F.col("n")  # one number a pre-token
    found = counted.groupBy("chunk").agg(F.collect_list(both).alias("found"))
    named = chunks.filter("place = -1").select("chunk", "path", "start", "size").join(found, "chunk", "left").select("path", "start", "size", "found")

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        for batch in batches:
            for row in range(batch.num_rows):
                path, start, size = (batch.column(k)[row].as_py() for k in range(3))
                found = batch.column(3)[row].values.to_numpy() if batch.column(3)[row].is_valid else np.zeros(0, np.int64)
                pieces = np.zeros(len(found), np.int64)
                pieces[found >> 32] = found & 0xFFFFFFFF
                store, inner = open_store(path)
                with store.open_input_file(inner) as file:
                    file.seek(start)
                    uses, at = _read(zstandard.ZstdDecompressor().decompress(file.read(size))), 0
                ids, sizes, tokens = [], [], []
                while at < len(uses):
                    there, doc_id, n_bytes, m = uses[at : at + 4].tolist()
                    ids.append(None if not there else doc_id - (1 << 64) * (doc_id >> 63))
                    sizes.append(n_bytes)
                    places, times = uses[at + 4 : at + 4 + m], uses[at + 4 + m : at + 4 + 2 * m]
                    tokens.append(int(pieces[np.cumsum(places.astype(np.int64))] @ times.astype(np.int64)))
                    at += 4 + 2 * m
                yield pa.RecordBatch.from_arrays([
                    pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(tokens, pa.int64()), pa.array([t > limit for t in tokens], pa.bool_())],
                    names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return named.mapInArrow(tidy(total), COUNTED)
