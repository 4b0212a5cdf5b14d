"""Exact links and components among items whose minimum hashes collide.

An item is a distinct text or paragraph: a 64-bit ``key``, the number ``n`` of its distinct shingles
and a list of band hashes. Two items are linked when the Jaccard index of their shingle sets reaches
the threshold. The search never writes all pairs of a bucket:

1. in each bucket every item is compared with its smallest key, and components are formed from what holds;
2. items whose buckets still hold several components go on, but only those of which so many shingles
   stand in other such items that a link is possible: texts that merely share a passage drop out here;
3. those left form families by common buckets. A family is dealt into blocks of bounded size; a task
   compares two blocks at once and gives out only links that join parts of them. Items of the family's largest component are not
   compared with one another.

Comparisons of one hot item are dealt to groups of bounded size too. Links, labels and shingles stay in
Spark; each step is a table in the shared folder.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut_lineage, tidy
from .words import _PLACE, mix

THRESHOLD = 0.8
ROWS, BANDS = 4, 20  # a pair of likeness 0.8 is missed with probability (1 - 0.8**4)**20 = 3e-5
GROUP_ITEMS = 256
GROUP_SHINGLES = 1 << 20  # of the items compared in one group, on average
COLUMNS = 1 << 14  # shingles compared at a time


def band_hashes(signatures: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One 64-bit hash for each band of ``rows`` values, different for different bands."""
    n, k = signatures.shape
    parts = signatures.reshape(n, k // rows, rows)
    total = np.zeros((n, k // rows), np.uint64)
    for j in range(rows):
        total += parts[:, :, j] * _PLACE[j]
    return mix(total + mix(np.arange(k // rows, dtype=np.uint64) + np.uint64(77)))


def _verify(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """(a, b, similarity) of the pairs (a, b) whose shingle sets are alike; ``sets`` has (key, shingles)."""
    salted = pairs.select("a", "b", F.pmod(F.xxhash64("b"), F.col("salts")).alias("salt"))
    members = salted.join(sets, salted["b"] == sets["key"]).select("a", "salt", "key", "shingles")
    centres = salted.select("a", "salt").distinct().join(sets, F.col("a") == sets["key"]).select("a", "salt", "key", "shingles")

    def compare(group: pa.Table) -> pa.Table:
        keys, blobs = group.column("key").to_pylist(), group.column("shingles").to_pylist()
        centre = group.column("a")[0].as_py()
        own = np.frombuffer(blobs[keys.index(centre)], np.uint64)
        found = {}
        for key, blob in zip(keys, blobs):
            if key != centre and key not in found:
                other = np.frombuffer(blob, np.uint64)
                place = np.searchsorted(own, other)
                common = int((own[np.minimum(place, len(own) - 1)] == other).sum())
                found[key] = common / (len(own) + len(other) - common)
        near = [k for k, v in found.items() if v >= threshold]
        return pa.table({"a": pa.array([centre] * len(near), pa.int64()), "b": pa.array(near, pa.int64()), "similarity": pa.array([found[k] for k in near], pa.float64())})

    return members.unionByName(centres).groupBy("a", "salt").applyInArrow(compare, "a long, b long, similarity double")


def _salts(pairs: DataFrame) -> DataFrame:
    """Add the number of groups that the comparisons of each ``a`` are dealt to; ``n`` is the size of ``b``."""
    counted = pairs.groupBy("a").agg(_groups("*", "n").alias("salts"))
    return pairs.join(counted, "a")


def _groups(items: str, shingles: str):
    """How many groups of bounded items and shingles a set of rows makes; both are aggregated."""
    return F.greatest(F.count(items) / GROUP_ITEMS, F.sum(shingles) / GROUP_SHINGLES).cast("int") + 1


def components(links: DataFrame) -> DataFrame:
    """(key, label): for every key of the links (a, b), the smallest key of its component.

    A key has rows (key, low) of lower keys that it is linked with, itself at first. A round puts each low's own least low in
    its place, then ties a key's other lows to its least one; so rows never become more, long chains halve, and each key
    ends with one row, its label. A round is one table and three shuffles, however many rows a key has.
    """
    ends = F.explode(F.array(*[F.struct(F.greatest(x, y).alias("key"), F.least(x, y).alias("low")) for x, y in ("ab", "aa", "bb")])).alias("end")
    rows = links.select(ends).select("end.key", "end.low")
    least, moved = F.min("low").over(Window.partitionBy("key")), F.col("moved") | (F.col("low") != F.col("least"))
    while True:
        own = rows.groupBy(F.col("key").alias("low")).agg(F.min("low").alias("least"))
        down = rows.join(own, "low").select("key", F.col("least").alias("low"), (F.col("least") != F.col("low")).alias("moved"))
        met = down.repartition("key").groupBy("key", "low").agg(F.max("moved").alias("moved")).withColumn("least", least)
        rows = cut_lineage(met.select(F.when(F.col("low") != F.col("least"), F.col("low")).otherwise(F.col("key")).alias("key"), F.col("least").alias("low"), moved.alias("moved")))
        if rows.filter("moved").isEmpty():
            return rows.select("key", F.col("low").alias("label"))
        rows = rows.select("key", "low")


def _alike_size(threshold: float, a: str = "n", b: str = "m"):
    return F.least(a, b) >= F.greatest(a, b) * threshold - 1e-9


def link_items(items: DataFrame, sets_of, threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame] | None:
    """Links (a, b, similarity) and labels (key, label) among ``items`` (key, n, bands); None without any.

    ``sets_of(keys)`` gives (key, shingles) for a table of keys: sorted 64-bit hashes as bytes.
    """
    spread = items.select("key", "n", F.explode("bands").alias("bucket"))
    crowds = (spread.groupBy("bucket").agg(F.count("*").alias("c"), F.min(F.struct("key", "n")).alias("first")).filter("c > 1")
              .select("bucket", F.col("first.key").alias("first"), F.col("first.n").alias("m")))
    crowded = cut_lineage(spread.join(crowds, "bucket").select("bucket", "key", "n", "first", "m"))
    if crowded.isEmpty():
        return None
    sets = cut_lineage(sets_of(crowded.select("key").distinct()))
    pairs = crowded.filter("key <> first").filter(_alike_size(threshold)).select(F.col("first").alias("a"), F.col("key").alias("b"), "n").distinct()
    links = cut_lineage(_verify(_salts(cut_lineage(pairs)), sets, threshold))
    labels = None if links.isEmpty() else components(links)
    rest = _rest(crowded, labels, sets, threshold)
    if rest is not None:
        links = links.unionByName(rest)
        labels = components(links)
    return None if labels is None else (links, labels)


def _rest(crowded: DataFrame, labels: DataFrame | None, sets: DataFrame, threshold: float) -> DataFrame | None:
    """Links between different labels inside mixed buckets; None without any."""
    rows = crowded.select("bucket", "key", "n")
    rows = rows.withColumn("label", F.col("key")) if labels is None else rows.join(labels, "key", "left").withColumn("label", F.coalesce("label", "key"))
    mixed = rows.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low <> high").select("bucket")
    rows = cut_lineage(rows.join(mixed, "bucket", "left_semi"))
    able = _able(rows.select("key", "n").distinct(), sets, threshold)
    rows = cut_lineage(rows.join(able, "key", "left_semi"))
    if rows.isEmpty():
        return None
    tops = rows.groupBy("bucket").agg(F.min("key").alias("first"))
    edges = rows.join(tops, "bucket").filter("key <> first").select(F.col("first").alias("a"), F.col("key").alias("b")).distinct()
    families = components(edges).select("key", F.col("label").alias("family"))
    members = cut_lineage(rows.select("key", "label", "n").distinct().join(families, "key"))
    sizes = members.groupBy("family", "label").agg(F.count("*").alias("c"), F.sum("n").alias("n")).groupBy("family").agg(
        F.max(F.struct("c", "label", "n")).alias("top"), F.sum("c").alias("c"), F.sum("n").alias("n")).filter("c > top.c")
    blocks = lambda c, n: F.expr(f"cast(greatest(({c}) / {GROUP_ITEMS}, ({n}) / {GROUP_SHINGLES}) as int) + 1")
    sizes = sizes.select("family", F.col("top.label").alias("main"), blocks("top.c", "top.n").alias("mains"), blocks("c - top.c", "n - top.n").alias("others"))
    # items of a family's largest label meet all blocks of the others; these meet each other too
    block = F.when(F.col("label") == F.col("main"), F.pmod(F.xxhash64("key"), F.col("mains"))).otherwise(F.pmod(F.xxhash64("key"), F.col("others")))
    placed = members.join(sizes, "family").withColumn("block", block.cast("int")).withColumn("is_main", F.col("label") == F.col("main"))
    across = placed.select("family", "key", "label", "is_main", "block", F.explode(F.when(F.col("is_main"), F.sequence(F.lit(0), F.col("others") - 1)).otherwise(
        F.sequence(F.lit(0), F.col("mains") - 1))).alias("other"))
    across = across.select("family", "key", "label", F.when(F.col("is_main"), F.col("block")).otherwise(-1 - F.col("block")).alias("side"),
                           F.when(F.col("is_main"), F.col("block")).otherwise(F.col("other")).alias("left"),
                           F.when(F.col("is_main"), -1 - F.col("other")).otherwise(-1 - F.col("block")).alias("right"))
    inner = placed.filter("NOT is_main").select("family", "key", "label", "block", F.explode(F.sequence(F.lit(0), F.col("others") - 1)).alias("other"))
    inner = inner.select("family", "key", "label", (-1 - F.col("block")).alias("side"), (-1 - F.least("block", "other")).alias("left"), (-1 - F.greatest("block", "other")).alias("right"))
    dealt = across.unionByName(inner).join(sets, "key")
    found = cut_lineage(dealt.groupBy("family", "left", "right").applyInArrow(_block_links(threshold), "a long, b long, similarity double"))
    return None if found.isEmpty() else found


def _able(items: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Keys of the items (key, n) of which enough shingles stand in another of the items for any link."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                values = np.frombuffer(blob, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(values), key)), pa.array(values)], names=["key", "shingle"])

    flat = items.select("key").join(sets, "key").select("key", "shingles").mapInArrow(tidy(unpack), "key long, shingle long")
    lone = (flat.groupBy("shingle").agg(F.count("*").alias("c"), F.min("key").alias("key")).filter("c = 1")
            .groupBy("key").agg(F.count("*").alias("lone")))
    return items.join(lone, "key", "left").filter(F.col("n") - F.coalesce("lone", F.lit(0)) >= F.col("n") * threshold - 1e-9).select("key")


def _forest(i: np.ndarray, j: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of links (i, j), those that join what labels and earlier links do not: one fewer than the parts they join."""
    part = np.unique(labels, return_inverse=True)[1].tolist()
    above, kept = list(range(len(part))), []

    def root(x: int) -> int:
        while above[x] != x:
            above[x] = x = above[above[x]]
        return x

    for k, (a, b) in enumerate(zip(i.tolist(), j.tolist())):
        a, b = root(part[a]), root(part[b])
        if a != b:
            above[max(a, b)] = min(a, b)
            kept.append(k)
    return i[kept], j[kept]


def _block_links(threshold: float):
    """Compare two blocks of a family (or one with itself) all at once; only links that join parts leave the task."""

    def run(group: pa.Table) -> pa.Table:
        left, right = group.column("left")[0].as_py(), group.column("right")[0].as_py()
        keys, labels, sides = (group.column(c).to_numpy() for c in ("key", "label", "side"))
        sets = [np.frombuffer(b, np.uint64) for b in group.column("shingles").to_pylist()]
        sizes = np.array([len(x) for x in sets], np.float64)
        owner = np.repeat(np.arange(len(sets)), sizes.astype(np.int64))
        _, token, df = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        shared = df[token] > 1
        _, token = np.unique(token[shared], return_inverse=True)
        owner = owner[shared]
        common = np.zeros((len(sets), len(sets)), np.float32)
        order = np.argsort(token, kind="stable")
        token, owner = token[order], owner[order]
        for start in range(0, int(token[-1]) + 1 if len(token) else 0, COLUMNS):
            a, b = np.searchsorted(token, [start, start + COLUMNS])
            held = np.zeros((len(sets), COLUMNS), np.float32)
            held[owner[a:b], token[a:b] - start] = 1
            common += held @ held.T
        similarity = common / np.maximum(sizes[:, None] + sizes[None, :] - common, 1)
        good = (similarity >= threshold - 1e-9) & (labels[:, None] != labels[None, :])
        good &= np.triu(np.ones_like(good), 1) if left == right else (sides[:, None] == left) & (sides[None, :] == right)
        i, j = _forest(*np.nonzero(good), labels)
        return pa.table({"a": pa.array(keys[i], pa.int64()), "b": pa.array(keys[j], pa.int64()), "similarity": pa.array(similarity[i, j].astype(np.float64))})

    return run
