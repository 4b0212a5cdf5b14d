"""Deleted interpolation: an n-gram model whose mixture weights are learned on counts held out in turn.

The probability of a token mixes the maximum-likelihood estimates of all orders up to ``order`` and a
uniform one over the vocabulary and one unseen word. The weights depend on how often the context stood in
training (its longest seen part and the power of two of that count). They are learned by expectation
maximisation: every training token is predicted from the counts of all *other* documents, those of its own
deleted. What the passes gather is a histogram of estimates by context class, whose size does
not depend on the corpus; the iterations run on it.

Data flow, over whole texts of any number:

1. a task turns its documents into chunks of bounded text. A chunk counts its own n-grams, so a frequent
   one travels once a chunk, and deals them by hash to buckets as packed sorted runs;
2. a bucket adds up its runs and answers every chunk with the corpus counts of the chunk's n-grams;
3. a chunk and its answers meet in one row of a table, which the learning and the scoring pass read.

Tokens are the runs without ASCII white space of a text with A-Z lower-cased, then one end token. Words
are known by 64-bit hash, longer n-grams by 48 bits (two of 10**8 share one with probability 3e-7).

Defined results: a null or empty text is the end token alone; a null ``doc_id`` counts as the text '' (and
so is held out); repeated rows count and are scored each; without training text the uniform estimate
remains; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, pick, slices, tidy
from .words import _PLACE, LOWER, NON_SPACE, mix, raw_bytes, split

ORDER = 2
CHUNK_BYTES = 6 << 20
BUCKET_BYTES = 4 << 20
CLASSES = 64  # context classes of one order: powers of two of its count
CELLS = 80  # half octaves of a probability
END, BEGIN = mix(np.array([1, 2], np.uint64))
SMOOTH = 0.1


def pack(values: np.ndarray) -> bytes:
    """Non-negative integers as compressed byte planes."""
    import zstandard

    planes = np.ascontiguousarray(values.astype("<u8")).view(np.uint8).reshape(-1, 8).T
    used = max((k + 1 for k in range(8) if planes[k].any()), default=0) if len(values) else 0
    return np.array([len(values), used], "<u4").tobytes() + zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes[:used]).tobytes())


def unpack(blob: bytes) -> np.ndarray:
    import zstandard

    n, used = np.frombuffer(blob, "<u4", 2).tolist()
    planes = np.zeros((8, n), np.uint8)
    if n and used:
        planes[:used] = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob[8:], max_output_size=n * used), np.uint8).reshape(used, n)
    return np.ascontiguousarray(planes.T).view("<u8").ravel().astype(np.uint64)


def pack_sorted(values: np.ndarray) -> bytes:
    return pack(np.diff(values, prepend=np.uint64(0)))


def unpack_sorted(blob: bytes) -> np.ndarray:
    return np.cumsum(unpack(blob), dtype=np.uint64)


def held_out(doc_id: int | None) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 10 == 0


def gram_hashes(tokens: np.ndarray, place: np.ndarray, order: int) -> np.ndarray:
    """Hash of the n-gram that ends at each token; ``place`` is the token's place in its document."""
    if order == 1:
        return tokens
    total = tokens * _PLACE[0]
    for back in range(1, order):
        before = np.empty_like(tokens)
        before[:back], before[back:] = BEGIN, tokens[:-back]
        total = total + np.where(place >= back, before, BEGIN) * _PLACE[back]
    return mix(total) & np.uint64((1 << 48) - 1)


@dataclass
class Chunk:
    """Some documents as tokens: numbers of their words among the sorted word hashes."""

    doc_ids: list
    texts: pa.Array
    sizes: np.ndarray  # tokens of each document
    words: np.ndarray  # sorted distinct word hashes
    tokens: np.ndarray

    @classmethod
    def of(cls, doc_ids: list, texts: pa.Array) -> Chunk:
        found = split(texts, NON_SPACE)
        sizes = found.counts + 1
        hashes = np.full(int(sizes.sum()), END, np.uint64)
        hashes[np.arange(len(found.hashes)) + found.doc] = found.hashes
        words, tokens = np.unique(hashes, return_inverse=True)
        return cls(doc_ids, texts, sizes, words, tokens)

    def packed(self) -> list[bytes]:
        """The documents themselves: compressed text is shorter than its token numbers and word hashes."""
        import zstandard

        raw, offsets = raw_bytes(self.texts)
        ids = np.array([i or 0 for i in self.doc_ids], np.int64).view(np.uint64)
        text = zstandard.ZstdCompressor(level=3).compress(LOWER[raw].tobytes())
        return [pack(ids), pack(np.array([i is None for i in self.doc_ids])), pack(np.diff(offsets)), text]

    @classmethod
    def unpacked(cls, blobs: list[bytes]) -> Chunk:
        import zstandard

        ids, missing, lengths = unpack(blobs[0]).view(np.int64).tolist(), unpack(blobs[1]).tolist(), unpack(blobs[2]).astype(np.int64)
        offsets = np.concatenate([[0], np.cumsum(lengths)])
        data = zstandard.ZstdDecompressor().decompress(blobs[3], max_output_size=max(1, int(offsets[-1])))
        texts = pa.Array.from_buffers(pa.large_binary(), len(ids), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data)])
        return cls.of([None if m else i for i, m in zip(ids, missing)], texts)

    @property
    def training(self) -> np.ndarray:
        return np.array([not held_out(i) for i in self.doc_ids], bool)

    @property
    def place(self) -> np.ndarray:
        return np.arange(len(self.tokens)) - np.repeat(np.cumsum(self.sizes) - self.sizes, self.sizes)

    def grams(self, order: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For each order: sorted distinct n-grams, number of the n-gram at each token, own training counts."""
        weight, place = np.repeat(self.training, self.sizes).astype(np.float64), self.place
        for o in range(1, order + 1):
            if o == 1:
                known, number = self.words, self.tokens
            else:
                known, number = np.unique(gram_hashes(self.words[self.tokens], place, o), return_inverse=True)
            yield known, number, np.bincount(number, weight, len(known)).astype(np.int64)


def _bucket_of(hashes: np.ndarray, order: int, n: int) -> np.ndarray:
    """Bucket by the leading bits, so that a sorted list falls into consecutive buckets."""
    top = hashes >> np.uint64(32 if order == 1 else 16)
    return ((top * np.uint64(n)) >> np.uint64(32)).astype(np.int64)


def _chunks(docs: DataFrame, order: int, n_buckets: int, chunk_bytes: int) -> DataFrame:
    """Rows (kind, bucket, chunk, parts): kind 0 holds a chunk's documents, kind o its counts of order o."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        for number, batch in enumerate(slices(batches, "text", chunk_bytes)):
            name, chunk = (task << 32) + number, Chunk.of(batch.column(0).to_pylist(), batch.column(1))
            training = chunk.training
            rows = [(0, name, [*chunk.packed(), pack(np.array([training.sum(), chunk.sizes[training].sum()]))])]
            for o, (known, _, counts) in enumerate(chunk.grams(order), 1):
                bucket = _bucket_of(known, o, n_buckets)
                cuts = np.append(np.flatnonzero(np.diff(bucket, prepend=-1)), len(bucket))
                rows += [(o, int(bucket[a]), [pack_sorted(known[a:b]), pack(counts[a:b])]) for a, b in zip(cuts[:-1], cuts[1:])]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int64()),
                                              pa.array([name] * len(rows), pa.int64()), pa.array([r[2] for r in rows], pa.list_(pa.binary()))], names=["kind", "bucket", "chunk", "parts"])

    return docs.mapInArrow(tidy(run), "kind int, bucket long, chunk long, parts array<binary>")


def _answer(group: pa.Table) -> pa.Table:
    """Corpus counts for each run of one bucket; types: n-grams of the bucket that training has."""
    kinds, buckets, chunks, parts = (group.column(k).to_pylist() for k in ("kind", "bucket", "chunk", "parts"))
    types = [0] * len(chunks)
    if kinds[0]:
        runs, counts = [unpack_sorted(p[0]) for p in parts], [unpack(p[1]).astype(np.int64) for p in parts]
        _, number = np.unique(np.concatenate(runs), return_inverse=True)
        own = np.concatenate(counts)
        total = np.bincount(number, own).astype(np.int64)
        answers = np.split(total[number], np.cumsum([len(r) for r in runs])[:-1])
        parts, types[0] = [[pack(a)] for a in answers], int((total > 0).sum())
    return pa.table({"kind": pa.array(kinds, pa.int32()), "bucket": pa.array(buckets, pa.int64()), "chunk": pa.array(chunks, pa.int64()),
                     "parts": pa.array(parts, pa.list_(pa.binary())), "types": pa.array(types, pa.int64())})


def _joined(order: int):
    def run(group: pa.Table) -> pa.Table:
        rows = sorted(group.to_pylist(), key=lambda r: (r["kind"], r["bucket"]))
        documents = next(r["parts"] for r in rows if r["kind"] == 0)
        counts = [pack(np.concatenate([unpack(r["parts"][0]) for r in rows if r["kind"] == o])) for o in range(1, order + 1)]
        docs, tokens = unpack(documents[-1]).tolist()
        return pa.table({"documents": pa.array([documents[:-1]], pa.list_(pa.binary())), "counts": pa.array([counts], pa.list_(pa.binary())),
                         "types": pa.array([sum(r["types"] for r in rows if r["kind"] == 1)], pa.int64()), "docs": pa.array([docs], pa.int64()), "tokens": pa.array([tokens], pa.int64())})

    return run


CHUNK_TABLE = "documents array<binary>, counts array<binary>, types long, docs long, tokens long"


def count_chunks(docs: DataFrame, order: int = ORDER, chunk_bytes: int = CHUNK_BYTES, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """One row a chunk: its documents and, for each of its n-grams, the training count of the corpus."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    dealt = _chunks(docs, order, int(total // bucket_bytes + 1), chunk_bytes)
    answers = dealt.groupBy("kind", "bucket").applyInArrow(_answer, "kind int, bucket long, chunk long, parts array<binary>, types long")
    return cut_lineage(answers.groupBy("chunk").applyInArrow(_joined(order), CHUNK_TABLE))


@dataclass
class Totals:
    docs: int
    tokens: int
    types: int


class Estimates:
    """Estimates of every order, and the context class, for each token of a chunk.

    ``deleted`` takes the counts of a token's own document out of all counts that predict it.
    """

    def __init__(self, chunk: Chunk, corpus: list[bytes], totals: Totals, deleted: bool):
        counts, place = [], chunk.place
        doc = np.repeat(np.arange(len(chunk.sizes)), chunk.sizes)
        for (known, number, _), blob in zip(chunk.grams(len(corpus)), corpus):
            seen = unpack(blob).astype(np.int64)[number]
            if deleted:
                _, pair, own = np.unique(doc * len(known) + number, return_inverse=True, return_counts=True)
                seen = seen - own[pair]
            counts.append(seen)
        n_docs = totals.docs - int(deleted)
        n_tokens = np.maximum(totals.tokens - chunk.sizes[doc] * int(deleted), 1)
        self.counts = counts[0]
        self.ratios = [counts[0] / n_tokens]
        self.kind = np.zeros(len(place), np.int64)
        for o in range(2, len(corpus) + 1):
            context = np.where(place == 0, n_docs, np.concatenate([[0], counts[o - 2][:-1]]))
            self.ratios.append(counts[o - 1] / np.maximum(context, 1))
            seen = context > 0
            self.kind[seen] = (o - 1) * CLASSES + np.log2(context[seen]).astype(np.int64)


def _cell(p: np.ndarray) -> np.ndarray:
    """0 for no estimate, else its half octave."""
    return np.where(p > 0, np.clip(CELLS - 1 + np.floor(2 * np.log2(np.maximum(p, 1e-300))), 1, CELLS - 1), 0).astype(np.int64)


def histogram(table: DataFrame, totals: Totals, order: int) -> DataFrame:
    """Training tokens by context class and cell of each estimate: n and the sum of each estimate."""
    sums = [f"p{o}" for o in range(1, order + 1)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                chunk = Chunk.unpacked(row["documents"])
                use = np.repeat(chunk.training, chunk.sizes)
                if not use.any():
                    continue
                found = Estimates(chunk, row["counts"], totals, deleted=True)
                key = found.kind[use]
                ratios = [r[use] for r in found.ratios]
                for r in ratios:
                    key = key * CELLS + _cell(r)
                cells, number = np.unique(key, return_inverse=True)
                yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(np.bincount(number, minlength=len(cells)).astype(np.int64)),
                                                  *(pa.array(np.bincount(number, r, len(cells))) for r in ratios)], names=["cell", "n", *sums])

    rows = table.select("documents", "counts").mapInArrow(tidy(run), "cell long, n long, " + ", ".join(f"{s} double" for s in sums))
    return rows.groupBy("cell").agg(F.sum("n").alias("n"), *[F.sum(s).alias(s) for s in sums])


def learn_weights(cells: list, order: int, uniform: float, rounds: int = 200) -> np.ndarray:
    """Weights (context class x estimate; estimate 0 is the uniform one) by expectation maximisation.

    ``cells`` are histogram rows. A class without training tokens takes the weights of the next lower
    class of its order that has some, or equal weights.
    """
    weights = np.zeros((order * CLASSES, order + 1))
    kind = np.array([c["cell"] // CELLS**order for c in cells], np.int64)
    n = np.array([c["n"] for c in cells], np.float64)
    means = np.array([[uniform, *(c[f"p{o}"] / c["n"] for o in range(1, order + 1))] for c in cells]).reshape(len(cells), order + 1)
    for k in range(order * CLASSES):
        usable = np.arange(order + 1) <= k // CLASSES + 1
        own = kind == k
        if not own.any():
            weights[k] = weights[k - 1] if k % CLASSES and weights[k - 1].any() else usable / usable.sum()
            continue
        now, p, count = usable / usable.sum(), means[own] * usable, n[own]
        for _ in range(rounds):
            share = p * now
            share /= share.sum(axis=1, keepdims=True)
            new = (share * count[:, None]).sum(axis=0) / count.sum()
            new = np.maximum(new, 1e-7 * usable)
            new /= new.sum()
            if np.abs(new - now).max() < 1e-9:
                break
            now = new
        weights[k] = new
    return weights


RESULT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def score_documents(docs: DataFrame, order: int = ORDER, chunk_bytes: int = CHUNK_BYTES, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """One row per document of (doc_id, text): its log10 probability by the model (score) and by smoothed words (base_score)."""
    table = count_chunks(pick(docs, doc_id="long", text="string"), order, chunk_bytes, bucket_bytes)
    totals = Totals(*(v or 0 for v in table.agg(F.sum("docs"), F.sum("tokens"), F.sum("types")).first()))
    uniform = 1.0 / (totals.types + 1)
    weights = learn_weights(histogram(table, totals, order).sort("cell").collect(), order, uniform)
    floor = totals.tokens + SMOOTH * (totals.types + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                chunk = Chunk.unpacked(row["documents"])
                found = Estimates(chunk, row["counts"], totals, deleted=False)
                mixed = weights[found.kind, 0] * uniform
                for o, ratio in enumerate(found.ratios, 1):
                    mixed = mixed + weights[found.kind, o] * ratio
                starts = np.cumsum(chunk.sizes) - chunk.sizes
                added = lambda x: np.add.reduceat(x, starts)  # noqa: E731  every document has a token
                yield pa.RecordBatch.from_arrays([
                    pa.array(chunk.doc_ids, pa.int64()), pa.array(~chunk.training), pa.array(chunk.sizes), pa.array(added((found.counts > 0).astype(np.int64))),
                    pa.array(np.full(len(starts), totals.tokens, np.int64)), pa.array(added(np.log10((found.counts + SMOOTH) / floor))), pa.array(added(np.log10(mixed)))],
                    names=[c.split()[0] for c in RESULT.split(", ")])

    return table.select("documents", "counts").mapInArrow(tidy(run), RESULT)
