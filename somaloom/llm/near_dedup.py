"""Near-duplicate documents by ProbMinHash.

Shingles are five words; each weighs 1, however often it stands in a document. Each shingle is a Poisson
process of that rate: its arrivals fall into random registers, a register keeps the first arrival, and
a shingle stops when its next arrival is later than every register of its document. Two documents agree
in a register with the probability Jaccard index of their shingles, which for equal weights is the Jaccard
index of the sets, so bands of registers bring alike documents together; pairs are then verified on whole shingle sets (``similar``).

Documents with the same words are one item from the start, so exact copies, however many, add no pairs.

Defined results: a null text is empty; a document without words is a class of its own; a document of
fewer than five words has one shingle, all of them; a null ``doc_id`` never names a class with another
id in it; rows of one doc_id are judged by their own texts; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut_lineage, pick, slices, tidy, unused
from .similar import BANDS, ROWS, THRESHOLD, band_hashes, link_items
from .words import _BASE, mix, shingles, split, tally, whole_hash


def prob_minhash(doc: np.ndarray, element: np.ndarray, weight: np.ndarray, n_docs: int, size: int) -> np.ndarray:
    """Signatures (n_docs x size) of weighted sets, given as (doc, element, weight) in order of doc."""
    first = np.full(n_docs * size, np.inf)
    winner = np.zeros(n_docs * size, np.uint64)
    latest = np.full(n_docs, np.inf)
    seed, clock, active, turn = mix(element), np.zeros(len(element)), np.arange(len(element)), 0
    while len(active):
        turn += 1
        draw = mix(seed[active] + np.uint64(turn * int(_BASE) % 2**64))
        clock[active] -= np.log(((draw >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53) / weight[active]
        going = clock[active] < latest[doc[active]]
        active, draw = active[going], draw[going]
        slot = doc[active] * size + (mix(draw ^ _BASE) % np.uint64(size)).astype(np.int64)
        np.minimum.at(first, slot, clock[active])
        won = first[slot] == clock[active]
        winner[slot[won]] = element[active[won]]
        touched = np.unique(doc[active])
        latest[touched] = first.reshape(n_docs, size)[touched].max(axis=1)
    return winner.reshape(n_docs, size)


def sketch(column: pa.Array, rows: int = ROWS, bands: int = BANDS) -> pa.RecordBatch:
    """key (hash of the word sequence), n (distinct shingles) and band hashes of each text; 0 and none without words."""
    words = split(column)
    n_docs = len(column)
    doc, values, _ = tally(*shingles(words.doc, words.hashes))
    signatures = prob_minhash(doc, values, np.ones(len(values)), n_docs, rows * bands)
    sizes = np.bincount(doc, minlength=n_docs)
    hashed = [row if size else row[:0] for row, size in zip(band_hashes(signatures, rows).view(np.int64), sizes)]
    return pa.RecordBatch.from_arrays([
        pa.array(whole_hash(words.doc, words.hashes, n_docs).view(np.int64)), pa.array(sizes.astype(np.int32)),
        pa.array(hashed, pa.list_(pa.int64()))], names=["key", "n", "bands"])


def shingle_sets(docs: DataFrame) -> DataFrame:
    """(key, shingles) of the rows of (key, text) whose text has that key: the sorted distinct shingle hashes as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            words = split(batch.column(1))
            own = np.flatnonzero(whole_hash(words.doc, words.hashes, batch.num_rows).view(np.int64) == batch.column(0).to_numpy())
            doc, values, _ = tally(*shingles(words.doc, words.hashes))
            cuts = np.searchsorted(doc, np.arange(batch.num_rows + 1))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(own)), pa.array([values[cuts[k] : cuts[k + 1]].tobytes() for k in own], pa.binary())], names=["key", "shingles"])

    return docs.select("key", "text").mapInArrow(tidy(run), "key long, shingles binary")


def _word_key(text: Column) -> Column:
    """Hash of the word sequence of each text; 0 without words."""

    @F.arrow_udf("long")
    def key(column: pa.Array) -> pa.Array:
        parts = [pa.array([], pa.int64())]
        for part in slices([pa.RecordBatch.from_arrays([column], names=["text"])], "text"):
            words = split(part.column(0))
            parts.append(pa.array(whole_hash(words.doc, words.hashes, part.num_rows).view(np.int64)))
        return pa.concat_arrays(parts)

    return key(text)


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document of (doc_id, text): doc_id, class_id, n_links.

    ``class_id`` is the smallest doc_id of the class; ``n_links`` counts the verified links of the
    document's text to different texts of the class that the search needed to find the class.
    """
    return _classes(docs, threshold).select("doc_id", "class_id", "n_links")


def _classes(docs: DataFrame, threshold: float) -> DataFrame:
    """``near_duplicates`` with the key of the row's text and the least key of the class id's rows in the class."""
    docs = pick(docs, doc_id="long", text="string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = sketch(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), *found.columns], names=["doc_id", *found.schema.names])

    rows = cut_lineage(docs.mapInArrow(tidy(run), "doc_id long, key long, n int, bands array<long>"))
    worded = rows.filter("n > 0")
    heads = worded.groupBy("key").agg(F.min("doc_id").alias("head"))
    top = F.min(F.when(F.col("head").isNotNull(), F.struct("head", "key")))
    items = worded.groupBy("key").agg(F.first("n").alias("n"), F.first("bands").alias("bands"))

    def sets_of(keys: DataFrame) -> DataFrame:
        named = heads.join(keys, "key").select("key", F.col("head").alias("doc_id"))
        return shingle_sets(docs.join(named, "doc_id").select("key", "text")).dropDuplicates(["key"])

    found = link_items(items.join(heads.filter("head is not null").select("key"), "key", "left_semi"), sets_of, threshold)
    if found is None:
        classes = heads.select("key", F.col("head").alias("class_id"), F.col("key").alias("class_key"), F.lit(0).cast("long").alias("n_links"))
    else:
        links, labels = found
        ends = links.select(F.col("a").alias("key")).union(links.select("b")).groupBy("key").agg(F.count("*").alias("n_links"))
        joined = labels.join(heads, "key")
        tops = joined.groupBy("label").agg(top.alias("top")).select("label", F.col("top.head").alias("class_id"), F.col("top.key").alias("class_key"))
        linked = joined.join(tops, "label").select("key", "class_id", "class_key").join(ends, "key")
        classes = (heads.join(linked, "key", "left")
                   .select("key", F.coalesce("class_id", "head").alias("class_id"), F.coalesce("class_key", "key").alias("class_key"), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links")))
    alone = rows.filter("n = 0").select("doc_id", "key", F.col("doc_id").alias("class_id"), F.col("key").alias("class_key"), F.lit(0).cast("long").alias("n_links"))
    return worded.select("doc_id", "key").join(classes, "key").select("doc_id", "key", "class_id", "class_key", "n_links").unionByName(alone)


def keep_one_of_each(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with one row of each class: of the class id's rows in it, that of the least key and text.

    Rows of one doc_id whose texts fall into different classes are judged each for itself. Rows without a
    doc_id all stay.
    """
    key, turn = unused(docs, "word_key"), unused(docs, "turn")
    kept_id, kept_key = unused(docs, "kept_id"), unused(docs, "kept_key")
    firsts = (_classes(docs, threshold).filter("doc_id = class_id AND key = class_key").select(F.col("doc_id").alias(kept_id), F.col("key").alias(kept_key)).distinct())
    text = F.col("text").cast("string")
    named = docs.filter(F.col("doc_id").cast("long").isNotNull()).withColumn(key, _word_key(text))
    kept = named.join(firsts, (F.col("doc_id").cast("long") == F.col(kept_id)) & (F.col(key) == F.col(kept_key)), "left_semi")
    once = Window.partitionBy(F.col("doc_id").cast("long"), key).orderBy(text)
    kept = kept.withColumn(turn, F.row_number().over(once)).filter(F.col(turn) == 1).drop(turn, key)
    return kept.unionByName(docs.filter(F.col("doc_id").cast("long").isNull()))
