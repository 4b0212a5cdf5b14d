"""Centroid clustering of vectors over subvector dictionaries, in whole numbers.

Components become integers, and vectors are cut into blocks of ``width`` neighbouring dimensions. A chunk
of vectors is stored once, losslessly: for each block the distinct subvectors, and for each vector
their numbers (codes). A round then

1. computes the exact squared distance of each distinct subvector of a block to that part of each centroid;
2. adds, for each vector, the partial distances of its codes, and takes the nearest centroid;
3. counts codes by cluster, and adds counts times subvectors to the cluster's sums.

Dictionaries belong to chunks, as in columnar files, so that a vector never moves: no round shuffles more
than a row per task, cluster and dimension, and a vector that a third of the rows repeat is a code as any other.
Only centroids (k x dimensions) pass through the driver. All arithmetic is exact.

Kept are vectors of exactly ``dim`` components, none null or not finite. Centroids start as the ``k``
kept vectors of smallest sha256 of ``seed:vec_id`` (fewer if there are fewer); equal hashes (repeated ids)
follow in order of their components. Ties of distance go to the smaller centroid number. A centroid
without vectors stays.

Defined results: null, short, long and not finite vectors have no row; rows of a null ``vec_id`` are clustered
but never start a centroid, unless no other row is left to; repeated rows count each; an empty table gives no
rows; other columns are ignored. Components whose integer is 2**27 or more are refused with ``OverflowError``, since
a squared distance might not fit a long.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, pick

K, ROUNDS, DIM, SCALE, SEED, WIDTH = 40, 5, 64, 256, 2, 2
CHUNK_ROWS = 1 << 15
STEP = 1 << 12  # vectors whose distances are held at a time
LARGEST = 1 << 27

CHUNKS = "vec_ids array<long>, entries array<int>, subvectors binary, codes binary"
CLUSTERED = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"


def kept_vectors(vectors: DataFrame, dim: int = DIM) -> DataFrame:
    """(vec_id, embedding as doubles) of the vectors that can be clustered."""
    known = pick(vectors, vec_id="long", embedding="array<double>")
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return known.filter((F.size("embedding") == dim) & F.coalesce(finite, F.lit(False)))


def whole(values: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x) as integers."""
    out = np.floor(values * float(scale))
    if len(out) and np.abs(out).max() >= LARGEST:
        raise OverflowError(f"a component times {scale} is {LARGEST} or more")
    return out.astype(np.int64)


def first_centroids(kept: DataFrame, k: int = K, scale: int = SCALE, seed: int = SEED) -> np.ndarray:
    """The k kept vectors of smallest hash, in its order."""
    order = kept.select(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256).alias("h"), "embedding")
    rows = order.orderBy(F.col("h").asc_nulls_last(), "embedding").limit(k).collect()
    return whole(np.array([r["embedding"] for r in rows], np.float64), scale) if rows else np.zeros((0, 0), np.int64)


class Chunk:
    """Vectors as codes into a dictionary of distinct subvectors for each block of dimensions."""

    def __init__(self, entries: np.ndarray, subvectors: np.ndarray, codes: np.ndarray):
        self.entries, self.subvectors, self.codes = entries, subvectors, codes  # entries of each block; all their subvectors; codes[block, vector]
        self.firsts = np.concatenate([[0], np.cumsum(entries)])

    @staticmethod
    def encode(vectors: np.ndarray, width: int = WIDTH) -> Chunk:
        n, dim = vectors.shape
        blocks = -(-dim // width)
        padded = np.zeros((n, blocks * width), np.int64)
        padded[:, :dim] = vectors
        entries, subs, codes = [], [], np.empty((blocks, n), np.int32)
        for b in range(blocks):
            part = np.ascontiguousarray(padded[:, b * width : (b + 1) * width])
            found, at = np.unique(part.view(np.dtype((np.void, 8 * width))).ravel(), return_inverse=True)
            codes[b] = at
            entries.append(len(found))
            subs.append(found.view(np.int64).reshape(-1, width))
        return Chunk(np.array(entries), np.concatenate(subs), codes)

    def parts(self) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
        width = self.subvectors.shape[1]
        for b in range(len(self.entries)):
            yield slice(b * width, (b + 1) * width), self.subvectors[self.firsts[b] : self.firsts[b + 1]], self.codes[b]

    def nearest(self, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cluster and squared distance of each vector; the distance of a subvector to a centroid is computed once."""
        width, n = self.subvectors.shape[1], self.codes.shape[1]
        wide = np.zeros((len(centroids), len(self.entries) * width), np.int64)
        wide[:, : centroids.shape[1]] = centroids
        tables = [((subs[:, None, :] - wide[None, :, dims]) ** 2).sum(axis=2) for dims, subs, _ in self.parts()]
        cluster, distance = np.empty(n, np.int32), np.empty(n, np.int64)
        for start in range(0, n, STEP):
            some = self.codes[:, start : start + STEP]
            total = tables[0][some[0]]
            for table, codes in zip(tables[1:], some[1:]):
                total += table[codes]
            best = total.argmin(axis=1)
            cluster[start : start + STEP] = best
            distance[start : start + STEP] = total[np.arange(len(best)), best]
        return cluster, distance

    def sums(self, cluster: np.ndarray, k: int, dim: int) -> np.ndarray:
        """Componentwise sums of the vectors of each cluster: code counts times subvectors."""
        out = np.zeros((k, len(self.entries) * self.subvectors.shape[1]), np.int64)
        for dims, subs, codes in self.parts():
            used = np.bincount(cluster.astype(np.int64) * len(subs) + codes, minlength=k * len(subs)).reshape(k, len(subs))
            out[:, dims] = used @ subs
        return out[:, :dim]


def encoded_vectors(kept: DataFrame, dim: int = DIM, scale: int = SCALE, width: int = WIDTH, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """A row per chunk of vectors: ids, entries of each block, distinct subvectors, codes."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, values, held = [], [], 0

        def row() -> pa.RecordBatch:
            chunk = Chunk.encode(np.concatenate(values), width)
            return pa.RecordBatch.from_arrays([
                pa.array([[i for some in ids for i in some]], pa.list_(pa.int64())), pa.array([chunk.entries.tolist()], pa.list_(pa.int32())),
                pa.array([chunk.subvectors.astype("<i4").tobytes()], pa.binary()),
                pa.array([chunk.codes.astype("<u2" if chunk.entries.max() <= 1 << 16 else "<u4").tobytes()], pa.binary())], names=[c.split()[0] for c in CHUNKS.split(", ")])

        for batch in batches:
            for start in range(0, batch.num_rows, chunk_rows):
                some = batch.slice(start, chunk_rows)
                ids.append(some.column(0).to_pylist())
                values.append(whole(some.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim), scale))
                held += some.num_rows
                if held >= chunk_rows:
                    yield row()
                    ids, values, held = [], [], 0
        if held:
            yield row()

    return cut_lineage(kept.mapInArrow(encode, CHUNKS))


def _chunks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[pa.Array, Chunk]]:
    for batch in batches:
        for k in range(batch.num_rows):
            ids, entries = batch.column(0)[k].values, batch.column(1)[k].values.to_numpy()
            raw, n = batch.column(3)[k].as_py(), len(ids)
            codes = np.frombuffer(raw, "<u2" if len(raw) == 2 * n * len(entries) else "<u4").reshape(len(entries), n)
            yield ids, Chunk(entries.astype(np.int64), np.frombuffer(batch.column(2)[k].as_py(), "<i4").astype(np.int64).reshape(-1, width), codes)


def _round(encoded: DataFrame, centroids: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sums, counts and summed distances of the clusters; Spark adds a few rows of each task."""
    k, dim = centroids.shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((k, dim + 2), np.int64)
        for _, chunk in _chunks(batches, width):
            cluster, distance = chunk.nearest(centroids)
            totals[:, :dim] += chunk.sums(cluster, k, dim)
            totals[:, dim] += np.bincount(cluster, minlength=k)
            np.add.at(totals[:, dim + 1], cluster, distance)
        used = np.flatnonzero(totals[:, dim])
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(totals[used].tolist(), pa.list_(pa.int64()))], names=["cluster", "totals"])

    parts = encoded.mapInArrow(add, "cluster int, totals array<long>").select("cluster", F.posexplode("totals").alias("place", "n"))
    out = np.zeros((k, dim + 2), np.int64)
    for r in parts.groupBy("cluster", "place").agg(F.sum("n").alias("n")).collect():  # at most k x (dim + 2) rows
        out[r["cluster"], r["place"]] = r["n"]
    return out[:, :dim], out[:, dim], out[:, dim + 1]


def cluster_vectors(vectors: DataFrame, k: int = K, rounds: int = ROUNDS, dim: int = DIM, scale: int = SCALE, seed: int = SEED, width: int = WIDTH, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Cluster (vec_id, embedding): per kept vector its cluster, squared distance, the inertias and its centroid's hash."""
    kept = kept_vectors(vectors, dim)
    centroids = first_centroids(kept, k, scale, seed)
    if not len(centroids):
        return vectors.sparkSession.createDataFrame([], CLUSTERED)
    encoded = encoded_vectors(kept, dim, scale, width, chunk_rows)
    for _ in range(rounds):
        sums, counts, _ = _round(encoded, centroids, width)
        some = counts > 0
        centroids = centroids.copy()
        centroids[some] = sums[some] // counts[some][:, None]
    inertias = _round(encoded, centroids, width)[2]
    inertia = sum(inertias.tolist())
    digests = np.array([hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()])

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, chunk in _chunks(batches, width):
            cluster, distance = chunk.nearest(centroids)
            yield pa.RecordBatch.from_arrays([
                ids, pa.array(cluster, pa.int32()), pa.array(distance, pa.int64()), pa.array(inertias[cluster], pa.int64()),
                pa.array([inertia] * len(ids), pa.int64()), pa.array(digests[cluster].tolist(), pa.string())], names=[c.split()[0] for c in CLUSTERED.split(", ")])

    return encoded.mapInArrow(assign, CLUSTERED)
