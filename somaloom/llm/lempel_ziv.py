"""Document fingerprints from Lempel-Ziv phrases.

A text's UTF-8 bytes are parsed into the phrases of LZ78: each is the longest phrase met before plus
one byte. Texts that compress well together share phrases. The fingerprint is the sorted list of the
``SIZE`` smallest 32-bit hashes of the phrase set, in hexadecimal; the likeness of two fingerprints is
the share of common values among the ``SIZE`` smallest of both together (an estimate of the Jaccard
index of the phrase sets).

Documents follow one another by descending id. Their sequence is cut at quantiles of the id into
buckets of bounded size; the first document of each bucket is copied to the end of the bucket before,
so every document meets its successor inside one sorted, streamed partition.

Defined results: a null text is empty; an empty text has the fingerprint '' and likeness 1.0 to
another of that fingerprint, 0.0 to any else; a null ``doc_id`` comes last; equal ids follow in order
of their text; a single document is its own successor; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pick, slices, tidy
from .words import span_hash

SIZE = 64
BUCKET_BYTES = 4 << 20
MAX_BUCKETS = 1 << 16  # beyond it buckets grow; they are streamed, never held


class Phrases:
    """The phrase dictionary of a text read so far; it can be copied and continued."""

    __slots__ = ("known", "node", "ends", "size")

    def __init__(self, known: dict | None = None, node: int = 0, ends: list | None = None, size: int = 0):
        self.known, self.node, self.ends, self.size = {} if known is None else known, node, [] if ends is None else ends, size

    def copy(self) -> Phrases:
        return Phrases(self.known.copy(), self.node, self.ends.copy(), self.size)

    def read(self, data: bytes) -> Phrases:
        """Parse on; phrase k ends at byte ends[k] and starts where the one before ends."""
        known, node = self.known, self.node
        get, add, fresh = known.get, self.ends.append, (len(known) + 1) << 8
        for place, byte in enumerate(data, self.size + 1):
            key = node | byte
            node = get(key, 0)
            if not node:
                known[key] = fresh
                fresh += 256
                add(place)
        self.node, self.size = node, self.size + len(data)
        return self


def signatures(texts: list[bytes], phrase_ends: list[list[int]], size: int = SIZE) -> list[np.ndarray]:
    """The smallest phrase hashes of each text, ascending."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    shift = np.cumsum([0, *map(len, texts)])
    counts = np.array([len(e) for e in phrase_ends])
    ends = np.concatenate([np.array(e, np.int64) + s for e, s in zip(phrase_ends, shift)] or [np.zeros(0, np.int64)])
    firsts = np.concatenate([[0], np.cumsum(counts)])
    starts = np.empty_like(ends)
    starts[1:] = ends[:-1]
    some = counts > 0
    starts[firsts[:-1][some]] = shift[:-1][some]
    hashes = (span_hash(data, starts, ends) >> np.uint64(32)).astype(np.uint32)
    out = []
    for a, b in zip(firsts[:-1], firsts[1:]):
        own = hashes[a:b]
        if len(own) > 2 * size:
            own = np.partition(own, 2 * size - 1)[: 2 * size]
        out.append(np.unique(own)[:size] if b - a <= 2 * size else _smallest(hashes[a:b], own, size))
    return out


def _smallest(every: np.ndarray, some: np.ndarray, size: int) -> np.ndarray:
    found = np.unique(some)
    return found[:size] if len(found) >= size else np.unique(every)[:size]


def likeness(a: np.ndarray, b: np.ndarray, size: int = SIZE) -> float:
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    one, two = set(a.tolist()), set(b.tolist())
    return sum(x in one and x in two for x in sorted(one | two)[:size]) / min(size, len(one | two))


def hexed(signature: np.ndarray) -> str:
    return signature.astype(">u4").tobytes().hex()


def fingerprint(text: str, size: int = SIZE) -> str:
    data = text.encode()
    return hexed(signatures([data], [Phrases().read(data).ends], size)[0])


def edited_text(text: str, following: str) -> str:
    """``text`` with its last third replaced by as many first code points of the following text."""
    cut = len(text) // 3
    return text[: len(text) - cut] + following[:cut]


RESULT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _with_following(docs: DataFrame, bucket_bytes: int) -> DataFrame:
    """Rows (bucket, tail, doc_id, text) in buckets of consecutive ids; tail marks the copied successor of a bucket."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = int(min(MAX_BUCKETS, total // bucket_bytes + 1))
    found = docs.select(F.percentile_approx("doc_id", [k / n for k in range(1, n)], 100 * n).alias("q")).first()[0] if n > 1 else []
    cuts = np.unique(np.array(found or [], np.int64))

    @F.pandas_udf("int")
    def bucket(ids: pd.Series) -> pd.Series:
        known = ids.notna().to_numpy()
        out = np.full(len(ids), len(cuts) + 1, np.int32)
        out[known] = len(cuts) - np.searchsorted(cuts, ids[known].to_numpy().astype(np.int64), "right")
        return pd.Series(out)

    placed = docs.withColumn("bucket", bucket("doc_id"))
    firsts = placed.groupBy("bucket").agg(F.max("doc_id").alias("top"), F.min(F.when(F.col("doc_id").isNull(), F.col("text"))).alias("head")).sort("bucket").collect()
    order = [r["bucket"] for r in firsts]
    before = {b: order[k - 1] for k, b in enumerate(order)}
    tops = {r["top"] for r in firsts if r["top"] is not None}
    heads = [r["head"] for r in firsts if r["top"] is None]

    @F.pandas_udf("int")
    def copied_to(ids: pd.Series, buckets: pd.Series) -> pd.Series:
        return pd.Series([before[b] if i in tops else None for i, b in zip(ids.tolist(), buckets.tolist())], dtype="Int32")

    target = copied_to(F.col("doc_id"), F.col("bucket"))
    if heads:
        target = F.coalesce(target, F.when(F.col("doc_id").isNull() & (F.col("text") == heads[0]), F.lit(before[len(cuts) + 1])))
    own = F.struct(F.col("bucket"), F.lit(False).alias("tail"))
    moved = F.struct(F.col("target").alias("bucket"), F.lit(True).alias("tail"))
    both = F.when(F.col("target").isNull(), F.array(own)).otherwise(F.array(own, moved))
    rows = placed.withColumn("target", target).select(F.explode(both).alias("b"), "doc_id", "text").select("b.bucket", "b.tail", "doc_id", "text")
    return rows.repartition(max(n, 1), "bucket").sortWithinPartitions("bucket", "tail", F.col("doc_id").desc_nulls_last(), "text")


def fingerprint_pairs(docs: DataFrame, size: int = SIZE, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Fingerprints of each document of (doc_id, text) and its edited text, and their likeness."""
    rows = _with_following(pick(docs, doc_id="long", text="string").fillna({"text": ""}), bucket_bytes)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: tuple | None = None  # bucket, id, text: the last document, whose successor has not come yet
        done: int | None = None  # bucket whose successor has been met
        for batch in slices(batches, "text"):
            pairs = []
            for bucket, tail, doc_id, text in zip(*(batch.column(k).to_pylist() for k in range(4))):
                if tail and done == bucket:
                    continue
                if waiting is not None:
                    pairs.append((waiting[1], waiting[2], text))
                waiting, done = (None, bucket) if tail else ((bucket, doc_id, text), done)
            yield _compared(pairs, size)

    return rows.mapInArrow(tidy(compare), RESULT)


def _compared(pairs: list[tuple[int | None, str, str]], size: int) -> pa.RecordBatch:
    texts, ends, edits, edit_ends = [], [], [], []
    for _, text, following in pairs:
        cut = len(text) // 3
        kept, rest, new = text[: len(text) - cut].encode(), text[len(text) - cut :].encode(), following[:cut].encode()
        shared = Phrases().read(kept)
        edit_ends.append(shared.copy().read(new).ends)
        ends.append(shared.read(rest).ends)
        texts.append(kept + rest)
        edits.append(kept + new)
    last = pairs[-1:] and pairs[-1][2].encode()
    chained = [k + 1 < len(pairs) and pairs[k][2] is pairs[k + 1][1] for k in range(len(pairs))]
    if pairs:  # successors are mostly the next pair's own texts; the others are parsed here
        extra = [k for k in range(len(pairs)) if not chained[k]]
        blobs = [last if k == len(pairs) - 1 else pairs[k][2].encode() for k in extra]
        found = signatures(texts + edits + blobs, ends + edit_ends + [Phrases().read(b).ends for b in blobs], size)
        own, changed = found[: len(pairs)], found[len(pairs) : 2 * len(pairs)]
        other = dict(zip(extra, found[2 * len(pairs) :]))
        nexts = [other[k] if k in other else own[k + 1] for k in range(len(pairs))]
    else:
        own = changed = nexts = []
    return pa.RecordBatch.from_arrays([
        pa.array([p[0] for p in pairs], pa.int64()), pa.array([len(p[1]) for p in pairs], pa.int64()),
        pa.array([hashlib.sha256(e).hexdigest() for e in edits], pa.string()),
        pa.array([hexed(s) for s in own], pa.string()), pa.array([hexed(s) for s in changed], pa.string()),
        pa.array([likeness(a, b, size) for a, b in zip(own, changed)], pa.float64()),
        pa.array([likeness(a, b, size) for a, b in zip(own, nexts)], pa.float64())],
        names=[c.split()[0] for c in RESULT.split(", ")])
