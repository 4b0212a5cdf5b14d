"""Benchmark decontamination: every passage of every document is a BM25 query against the test items.

Index: an item is indexed in parts of at most ``CELL`` words; a part's terms have BM25 weights divided
by the part's own score, so a passage that holds all its words scores 1. Parts stand in small blocks, and for
each term a block keeps its largest weight.

Retrieval (block-max WAND, a batch of passages at a time): the most frequent terms, whose weights in a
block cannot reach half of the threshold together, are left for later. The block maxima of all other
terms of a passage are added up; only blocks whose sum and what was left reach the threshold are opened,
and their parts scored exactly. Every part at or above the threshold is found, as if all were scored.

Passages are ``2 * CELL`` words long and start every ``CELL`` words, so each part lies whole inside one.

Verification: a document for which a part of an item was retrieved is compared with the item as a whole,
wherever in it the words stand. An item with a question mark inside is a question and an answer (all after its
last question mark), any other is one piece. The document leaks the item if it holds at least ``OVERLAP`` of
the five-word runs of each piece; of an answer of fewer than ``SHORT`` words, of its words.

The test items are read in shards of bounded size, each a broadcast index; documents pass from one
shard's scan to the next in the same task, so nothing is shuffled.

Defined results: a null text holds no passage; null or wordless items are never found; equal items are
all found; repeated documents are judged each; an empty benchmark leaves every document clean; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import pick, slices, tidy
from .words import ALNUM, SHINGLE, shingles, split

CELL = 64
THRESHOLD = 0.5
OVERLAP = 0.5
SHORT = 2 * SHINGLE
BLOCK_PARTS = 2
K1, B = 1.2, 0.75
SHARD_BYTES = 8 << 20
MAX_CELLS = 1 << 19  # values of one accumulation array; a worker holds several

FOUND = "struct<items:array<long>,score:double>"


def question_and_answer(text: str) -> tuple[str, str]:
    """An item's question and answer; the answer is '' if there is one sentence only."""
    body = text.rstrip()
    at = body.rfind("?", 0, len(body) - 1)
    if at < 0:
        at = max(body.rfind(mark, 0, len(body) - 1) for mark in (". ", "! ", ".\n", "!\n", "\n"))
    return (body[: at + 1], body[at + 1 :]) if at >= 0 else (body, "")


def _runs(hashes: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """Distinct hashes of the runs of ``size`` words of one text."""
    return np.unique(shingles(np.zeros(len(hashes), np.int64), hashes, size)[1])


def _pieces(text: str) -> list[tuple[int, np.ndarray]]:
    """(words a run, distinct runs) of what a leak must hold of an item: question and answer, or the whole."""
    question, answer = question_and_answer(text)
    halves = [split(pa.array([half])).hashes for half in (question, answer)]
    if not question.endswith("?") or not all(map(len, halves)):
        halves = [split(pa.array([text])).hashes]
    sizes = [min(SHINGLE, len(halves[0]))] + [1 if len(w) < SHORT else SHINGLE for w in halves[1:]]
    return [(size, _runs(w, size)) for size, w in zip(sizes, halves) if len(w)]


class ItemIndex:
    """Block-max postings of test items, given as (item_id, text)."""

    def __init__(self, items: list[tuple[int, str]], frequency: dict[int, int], n_parts: int, mean_words: float, threshold: float, overlap: float):
        self.threshold, self.overlap = threshold, overlap
        self.items = [i for i, _ in items]
        self.pieces = [_pieces(text) for _, text in items]
        parts: list[tuple[int, list[int]]] = [(k, w[a : a + CELL]) for k, (_, text) in enumerate(items)
                                              for w in [split(pa.array([text])).hashes.tolist()] for a in range(0, len(w), CELL)]
        self.part_item = np.array([k for k, _ in parts], np.int64)
        postings: dict[int, list[tuple[int, float]]] = defaultdict(list)
        for p, (_, words) in enumerate(parts):
            counts = np.unique(np.array(words, np.uint64), return_counts=True)
            weights = {}
            for term, tf in zip(counts[0].tolist(), counts[1].tolist()):
                df = frequency[term]
                weights[term] = np.log(1 + (n_parts - df + 0.5) / (df + 0.5)) * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(words) / mean_words))
            own = sum(weights.values())
            for term, weight in weights.items():
                postings[term].append((p, weight / own))
        self.terms = np.array(sorted(postings), np.uint64)
        lists = [postings[t] for t in self.terms.tolist()]
        self.first = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int64)
        self.part = np.array([p for x in lists for p, _ in x], np.int64)
        self.weight = np.array([w for x in lists for _, w in x])
        self.n_blocks = max(1, -(-len(parts) // BLOCK_PARTS))
        self._block_maxima()

    def _block_maxima(self) -> None:
        term = np.repeat(np.arange(len(self.terms)), np.diff(self.first))
        key, inverse = np.unique(term * self.n_blocks + self.part // BLOCK_PARTS, return_inverse=True)
        top = np.zeros(len(key))
        np.maximum.at(top, inverse, self.weight)
        owner, block = key // self.n_blocks, key % self.n_blocks
        self.block_first = np.searchsorted(owner, np.arange(len(self.terms) + 1))
        self.block, self.top = block, top
        later = np.zeros(self.n_blocks)  # what the terms left for later can add to a part of each block
        self.early = np.ones(len(self.terms), bool)
        for t in np.argsort(-np.diff(self.first), kind="stable"):
            own = slice(self.block_first[t], self.block_first[t + 1])
            more = later.copy()
            more[block[own]] += top[own]
            if more.max() >= self.threshold / 2:
                break
            later, self.early[t] = more, False
        self.later = later

    def search(self, texts: pa.Array) -> tuple[list[list[int]], list[float]]:
        """Leaked item ids of each text, ascending, and the best retrieval score among them (0 without any)."""
        words = split(texts, ALNUM)
        leaks: list[list[int]] = [[] for _ in range(len(texts))]
        best = [0.0] * len(texts)
        if not len(self.terms) or not len(words.hashes):
            return leaks, best
        at = np.minimum(np.searchsorted(self.terms, words.hashes), len(self.terms) - 1)
        term = np.where(self.terms[at] == words.hashes, at, -1)
        firsts = words.firsts
        cells_of = -(-np.diff(firsts) // CELL)  # cells of each text; one more separates texts
        cell_first = np.concatenate([[0], np.cumsum(cells_of + 1)])
        place = np.arange(len(term)) - firsts[words.doc]
        cell = cell_first[words.doc] + place // CELL
        hit = np.flatnonzero((term >= 0) & self.early[term])
        bounds = self._bounds(cell[hit], term[hit], int(cell_first[-1]))
        retrieved: dict[int, dict[int, float]] = defaultdict(dict)
        for passage, blocks in bounds:
            doc = int(np.searchsorted(cell_first, passage, "right") - 1)
            start = int(firsts[doc] + (passage - cell_first[doc]) * CELL)
            end = min(start + 2 * CELL, int(firsts[doc + 1]))
            if start >= end:  # the cell between two texts
                continue
            for part, score in self._parts(term[start:end], blocks):
                item = int(self.part_item[part])
                retrieved[doc][item] = max(score, retrieved[doc].get(item, 0.0))
        for doc, items in retrieved.items():
            own, held = words.hashes[firsts[doc] : firsts[doc + 1]], {}
            for item, score in items.items():
                if self._verified(item, own, held):
                    leaks[doc].append(self.items[item])
                    best[doc] = max(best[doc], score)
        return [sorted(set(found)) for found in leaks], best

    def _bounds(self, cell: np.ndarray, term: np.ndarray, n_cells: int):
        """Passages (named by their first cell) with the blocks that may hold a part at the threshold."""
        step = max(2, MAX_CELLS // self.n_blocks)
        for low in range(0, n_cells, step - 1):  # one cell is counted twice, for the passage across
            a, b = np.searchsorted(cell, [low, low + step])
            if a == b:
                continue
            t = term[a:b]
            counts = self.block_first[t + 1] - self.block_first[t]
            ends = np.cumsum(counts)
            entry = np.repeat(self.block_first[t] - (ends - counts), counts) + np.arange(ends[-1])
            key = np.repeat(cell[a:b] - low, counts) * self.n_blocks + self.block[entry]
            sums = np.bincount(key, self.top[entry], (step + 1) * self.n_blocks).reshape(step + 1, self.n_blocks)
            reach = sums[:-2] + sums[1:-1] + self.later >= self.threshold - 1e-9
            reach &= sums[:-2] + sums[1:-1] > 0
            rows, blocks = np.nonzero(reach)
            cuts = np.flatnonzero(np.diff(rows)) + 1
            for r, found in zip(np.split(rows, cuts), np.split(blocks, cuts)):
                if len(r):
                    yield int(r[0]) + low, found

    def _parts(self, term: np.ndarray, blocks: np.ndarray) -> list[tuple[int, float]]:
        """Parts of the blocks whose score by the distinct terms reaches the threshold."""
        term = np.unique(term[term >= 0])
        counts = self.first[term + 1] - self.first[term]
        ends = np.cumsum(counts)
        entry = np.repeat(self.first[term] - (ends - counts), counts) + np.arange(ends[-1])
        entry = entry[np.isin(self.part[entry] // BLOCK_PARTS, blocks)]
        part, inverse = np.unique(self.part[entry], return_inverse=True)
        score = np.bincount(inverse, self.weight[entry])
        good = score >= self.threshold - 1e-9
        return list(zip(part[good].tolist(), score[good].tolist()))

    def _verified(self, item: int, own: np.ndarray, held: dict[int, np.ndarray]) -> bool:
        """Do the words of a document hold enough of each piece? ``held`` keeps its runs by size."""
        for size, runs in self.pieces[item]:
            if size not in held:
                held[size] = _runs(own, size) if len(own) >= size else own[:0]
            if np.isin(runs, held[size], assume_unique=True).sum() < self.overlap * len(runs):
                return False
        return True


def build_indexes(items: DataFrame, threshold: float = THRESHOLD, overlap: float = OVERLAP, shard_bytes: int = SHARD_BYTES) -> list[ItemIndex]:
    """Indexes of (item_id, text), each over items of at most about ``shard_bytes`` of text, with common statistics."""
    items = pick(items, item_id="long", text="string").filter("item_id IS NOT NULL AND text IS NOT NULL")

    def terms(batches):
        for batch in slices(batches, "text"):
            words = split(batch.column(0), ALNUM)
            first = words.firsts[words.doc]
            part = (words.doc.astype(np.int64) << 32) + (np.arange(len(first)) - first) // CELL
            own = np.unique(np.stack([part.view(np.uint64), words.hashes], 1), axis=0) if len(first) else np.zeros((0, 2), np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([own[:, 1].view(np.int64), [0]])), pa.array([1] * len(own) + [0]),
                                              pa.array([0] * len(own) + [len(np.unique(part))]), pa.array([0] * len(own) + [len(first)])], names=["term", "df", "parts", "words"])

    counted = items.select("text").mapInArrow(tidy(terms), "term long, df long, parts long, words long")
    totals = counted.agg(F.sum("parts"), F.sum("words"), F.sum("df")).first()
    if not totals[1]:
        return []
    size = items.agg(F.sum(F.octet_length("text"))).first()[0]
    n = int(size // shard_bytes + 1)
    shard = F.pmod(F.xxhash64("item_id", "text"), F.lit(n))
    out = []
    for k in range(n):  # one shard is a single broadcast; only a benchmark of gigabytes has several
        rows = sorted((r["item_id"], r["text"]) for r in items.filter(shard == k).collect())
        if rows:
            own = np.unique(split(pa.array([t for _, t in rows])).hashes).view(np.int64).tolist()
            wanted = items.sparkSession.createDataFrame(pa.table({"term": pa.array(own, pa.int64())}))
            frequency = {r["term"] % 2**64: r["df"] for r in counted.groupBy("term").agg(F.sum("df").alias("df")).join(wanted, "term").collect()}
            out.append(ItemIndex(rows, frequency, totals[0], totals[1] / totals[0], threshold, overlap))
    return out


def leaked_items(text: Column | str, index: ItemIndex) -> Column:
    """Leaked item ids of one index, and the best score, for each text."""

    @F.arrow_udf(FOUND)
    def found(column: pa.Array) -> pa.Array:
        kind = pa.struct([("items", pa.list_(pa.int64())), ("score", pa.float64())])
        parts = []
        for part in slices([pa.RecordBatch.from_arrays([column], names=["text"])], "text"):
            leaks, best = index.search(part.column(0))
            parts.append(pa.StructArray.from_arrays([pa.array(leaks, kind[0].type), pa.array(best, pa.float64())], fields=list(kind)))
        return pa.concat_arrays(parts) if parts else pa.array([], kind)

    return found(text)


def decontamination(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, overlap: float = OVERLAP) -> DataFrame:
    """One row per document of (doc_id, text): doc_id, contaminated, item_ids (ascending), score."""
    rows = pick(docs, doc_id="long", text="string").select("doc_id", "text", F.expr("cast(array() as array<long>)").alias("item_ids"), F.lit(0.0).alias("score"))
    for index in build_indexes(items, threshold, overlap):
        rows = rows.withColumn("f", leaked_items("text", index)).select(
            "doc_id", "text", F.concat("item_ids", "f.items").alias("item_ids"), F.greatest("score", "f.score").alias("score"))
    ids = F.array_sort(F.array_distinct("item_ids"))
    return rows.select("doc_id", (F.size("item_ids") > 0).alias("contaminated"), ids.alias("item_ids"), "score")


def without_leaks(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, overlap: float = OVERLAP) -> DataFrame:
    """``docs`` without the documents that leak a test item."""
    for index in build_indexes(items, threshold, overlap):
        docs = docs.filter(F.size(leaked_items(F.col("text").cast("string"), index)["items"]) == 0)
    return docs
