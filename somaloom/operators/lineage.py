"""Lineage operators: genotype subsets, character alignment, variant placement on a tree."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from somaloom.functions.variants import is_snv_strict, vaf

CHUNK = 1_000_000
COUNTS_PER_TASK = 1 << 20


def genotype_table(calls: DataFrame, ids: DataFrame) -> DataFrame:
    """``(sample_id, variant_id, gt)`` of the matrix variants."""
    return calls.select("sample_id", "variant_id", "gt").join(ids.select("variant_id"), "variant_id", "left_semi")


def class_subset(counts: DataFrame, kind: str = "both") -> DataFrame:
    """SNV, indel or all variants, without samples lacking depth or support in that subset."""
    snv = is_snv_strict()
    rows = counts if kind == "both" else counts.filter(snv if kind == "snv" else ~snv)
    alive = rows.groupBy("sample_id").agg(F.sum("nr").alias("a"), F.sum("nv").alias("b")).filter("a > 0 AND b > 0")
    return rows.join(alive.select("sample_id"), "sample_id", "left_semi")


def alignment_strings(genotypes: DataFrame) -> DataFrame:
    """One A / T / ? string per sample over all variants, plus an all-A ancestor, named SC1, SC2, …

    ``genotypes``: ``variant_id, sample_id, chrom, pos, genotype`` (0, 0.5, 1). Strings are built
    per megabase first, so a sample's variants are never sorted as one list.
    """
    letter = F.when(F.col("genotype") == 1, "T").when(F.col("genotype") == 0.5, "?").otherwise("A")
    part = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "variant_id", letter.alias("c")))), lambda s: s.getField("c")), "")
    pieces = genotypes.groupBy("sample_id", "chrom", F.floor(F.col("pos") / CHUNK).alias("mb")).agg(part.alias("s"))
    whole = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("chrom", "mb", "s"))), lambda s: s.getField("s")), "")
    tips = pieces.groupBy("sample_id").agg(whole.alias("sequence"))
    length = genotypes.agg(F.count_distinct("variant_id")).scalar()
    root = genotypes.sparkSession.range(1).select(
        F.lit("Ancestral").alias("sample_id"), F.repeat(F.lit("A"), length.cast("int")).alias("sequence"))
    # numbers are given to the names alone: one short row per sample
    number = F.row_number().over(W.orderBy("sample_id")) + 1
    names = genotypes.select("sample_id").distinct().withColumn("short_name", F.concat(F.lit("SC"), number.cast("string")))
    return root.withColumn("short_name", F.lit("SC1")).unionByName(tips.join(names, "sample_id"))


def place_variants(counts: DataFrame, edge_tips: DataFrame, err: float = 0.01, carried: float = 0.5) -> DataFrame:
    """Most likely edge of every variant and the probability that it lies elsewhere.

    Below the edge reads carry the variant with probability ``carried``, elsewhere with
    ``err``. Against "nowhere", an edge gains only in its own tips, so the counts are
    joined to the edges above each sample instead of to all edges.
    """
    gain = F.col("nv") * math.log(carried / err) + (F.col("nr") - F.col("nv")) * math.log((1 - carried) / (1 - err))
    per_edge = counts.join(edge_tips, "sample_id").groupBy("variant_id", "edge_id").agg(F.sum(gain).alias("g"))
    top = F.max("g").over(W.partitionBy("variant_id"))
    best = per_edge.withColumn("_w", F.exp(F.col("g") - top)).groupBy("variant_id").agg(
        F.min_by("edge_id", F.struct((-F.round("g", 9)).alias("g"), F.col("edge_id").alias("e"))).alias("edge_id"), F.sum("_w").alias("_s"))
    return best.select("variant_id", "edge_id", (1 - 1 / F.col("_s")).alias("p_elsewhere"))


def _tour(edges: pd.DataFrame) -> pd.DataFrame:
    """Tip ranges of one tree, tips numbered as a walk over it meets them."""
    edges = edges.sort_values("edge_id")
    names = dict(zip(edges["edge_id"], edges["sample_id"], strict=True))
    below: dict = {e: [] for e in names}
    stack = []
    for e, up in zip(edges["edge_id"], edges["parent_id"], strict=True):
        if pd.isna(up) or up not in below:
            stack.append((e, False))
        else:
            below[up].append(e)
    stack.reverse()
    first, last, tips = {}, {}, 0
    while stack:
        e, done = stack.pop()
        if done:
            last[e] = tips - 1
            continue
        first[e] = tips
        tips += names[e] is not None
        stack.append((e, True))
        stack.extend((c, False) for c in reversed(below[e]))
    if len(first) < len(names):
        raise ValueError(f"edges without a way to a root in tree {edges['tree_id'].iloc[0]}")
    out = edges[["tree_id", "edge_id", "sample_id"]].assign(first=edges["edge_id"].map(first), last=edges["edge_id"].map(last))
    return out[out["first"] <= out["last"]]


def tip_ranges(edges: DataFrame) -> DataFrame:
    """Each edge of a tree as a range of tips: ``tree_id, edge_id, sample_id, first, last``.

    ``edges``: ``tree_id, edge_id, parent_id`` (NULL at a root), ``sample_id`` of edges that end in a tip. A row an edge,
    however deep the tree; edges above no tip are left out; a cycle is an error. A task walks one tree.
    """
    schema = "tree_id string, edge_id bigint, sample_id string, first bigint, last bigint"
    typed = edges.select(F.col("tree_id").cast("string"), F.col("edge_id").cast("bigint"), F.col("parent_id").cast("bigint"), F.col("sample_id").cast("string"))
    return typed.groupBy("tree_id").applyInPandas(_tour, schema)


class _Forest:
    """The distinct tip ranges of one tree, numbered outermost first, for questions about edges between two of them.

    Ranges either nest or do not touch. Edges over the same tips (``first``, ``last``) are one node: they gain the same.
    """

    def __init__(self, edge: np.ndarray, first: np.ndarray, last: np.ndarray):
        order = np.lexsort((-last, first))
        edge, first, last = edge[order], first[order], last[order]
        new = np.r_[True, (np.diff(first) != 0) | (np.diff(last) != 0)]
        starts = np.flatnonzero(new)
        self.first, self.last = first[starts], last[starts]
        own, least = np.diff(np.r_[starts, len(edge)]), np.minimum.reduceat(edge, starts)
        parent, depth, edges = [], [], []
        n = int(last.max()) + 1
        leaf, shared, stack, k = [], [], [], 0  # innermost node of each tip, of each tip and the next
        firsts, lasts, counts = self.first.tolist(), self.last.tolist(), own.tolist()
        for tip in range(n):
            while stack and lasts[stack[-1]] < tip:
                stack.pop()
            if tip:
                shared.append(stack[-1] if stack else -1)
            while k < len(firsts) and firsts[k] == tip:
                up = stack[-1] if stack else -1
                parent.append(up)
                depth.append(depth[up] + 1 if up >= 0 else 1)
                edges.append((edges[up] if up >= 0 else 0) + counts[k])
                stack.append(k)
                k += 1
            leaf.append(stack[-1] if stack else -1)
        self.leaf, self.depth, self.edges = np.array(leaf), np.array([*depth, 0]), np.array([*edges, 0])  # the last stands for "none", -1
        self.up, self.least = [np.array([*parent, -1])], [np.r_[least, np.iinfo(np.int64).max]]
        while (self.up[-1] >= 0).any():  # ancestors 2 ** j levels up and the least edge on the way
            up, low = self.up[-1], self.least[-1]
            self.least.append(np.minimum(low, low[up]))
            self.up.append(up[up])
        self.over = [np.array(shared, np.int64)]
        while 2 ** len(self.over) <= n - 1:  # least of 2 ** j neighbours: the outermost node
            half, low = 2 ** (len(self.over) - 1), self.over[-1]
            self.over.append(np.minimum(low[:-half], low[half:]))

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Innermost node over the tips ``a < b``, -1 without one."""
        level = np.frexp(b - a)[1] - 1
        out = np.empty(len(a), np.int64)
        for j in np.unique(level):
            at = level == j
            out[at] = np.minimum(self.over[j][a[at]], self.over[j][b[at] - 2**j])
        return out

    def least_edge(self, node: np.ndarray, above: np.ndarray) -> np.ndarray:
        """Least edge on the way from ``node`` up to, but without, its ancestor ``above``."""
        steps, out = self.depth[node] - self.depth[above], np.full(len(node), np.iinfo(np.int64).max)
        for j in range(len(self.up)):
            on = steps >> j & 1 == 1
            out[on] = np.minimum(out[on], self.least[j][node[on]])
            node = np.where(on, self.up[j][node], node)
        return out


def _best_edges(variant: np.ndarray, tip: np.ndarray, support: np.ndarray, other: np.ndarray, weights: tuple[float, float], tree: _Forest) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``variant, edge, p_elsewhere`` of numbered variants, from their counts at tips.

    What an edge gains changes only where ways up from counted tips meet, so a variant of ``m`` counted tips has at most
    ``2 m`` different gains, each of a run of edges. Counts are summed as whole numbers, hence exactly.
    """
    order = np.lexsort((tip, variant))
    variant, tip = variant[order], tip[order]
    n = len(tree.leaf)
    key = variant * n + tip
    sums = [np.r_[0.0, np.cumsum(x[order])] for x in (support, other)]
    place = np.flatnonzero(np.r_[True, np.diff(key) != 0])
    v, t = variant[place], tip[place]
    node = tree.leaf[t]
    next_to = np.flatnonzero(np.diff(v) == 0)
    meet = tree.common(t[next_to], t[next_to + 1])
    size = len(tree.first)
    joint = np.unique(np.r_[v * size + node, (v[next_to] * size + meet)[meet >= 0]])
    v, node = joint // size, joint % size
    # a node's next one above it is what it shares with the one before it, as outer nodes come first
    above = np.full(len(v), -1)
    same = np.flatnonzero(np.diff(v) == 0) + 1
    before, own = node[same - 1], node[same]
    inside = tree.last[before] >= tree.last[own]
    above[same[inside]] = before[inside]
    apart = same[~inside]
    above[apart] = tree.common(tree.last[node[apart - 1]], tree.first[node[apart]])
    low, high = np.searchsorted(key, v * n + tree.first[node]), np.searchsorted(key, v * n + tree.last[node], "right")
    gain = sum(w * (x[high] - x[low]) for w, x in zip(weights, sums))
    starts = np.flatnonzero(np.r_[True, np.diff(v) != 0])
    length = np.diff(np.r_[starts, len(v)])
    top = np.maximum.reduceat(gain, starts)
    total = np.add.reduceat(np.exp(gain - np.repeat(top, length)) * (tree.edges[node] - tree.edges[above]), starts)
    best = np.flatnonzero(np.round(gain, 9) == np.repeat(np.round(top, 9), length))
    edge = tree.least_edge(node[best], above[best])
    first = np.flatnonzero(np.r_[True, np.diff(v[best]) != 0])
    return v[starts], np.minimum.reduceat(edge, first), 1 - 1 / total


def place_on_trees(counts: DataFrame, ranges: DataFrame, err: float = 0.01, carried: float = 0.5) -> DataFrame:
    """:func:`place_variants` over :func:`tip_ranges`: ``tree_id, variant_id, edge_id, p_elsewhere``.

    Tips stand in the order of the tour, so what an edge gains is a difference of two prefix sums over tips. Counts
    (``tree_id, variant_id, sample_id, nv, nr``) are shuffled once and never repeated along a path; a tree goes to
    each of the groups of about ``COUNTS_PER_TASK`` counts that its variants are dealt to. Work follows the counts, not variants
    x edges: see :func:`_best_edges`. Edges without a counted tip are no candidates.
    """
    weights = (math.log(carried / err), math.log((1 - carried) / (1 - err)))
    parts = counts.groupBy("tree_id").agg(F.expr(f"CAST(ceil(count(*) / {COUNTS_PER_TASK}) AS INT)").alias("_n"))
    tips = ranges.filter("sample_id IS NOT NULL").select("tree_id", "sample_id", F.col("first").alias("tip"))
    split = [F.col("nv").cast("double").alias("support"), (F.col("nr") - F.col("nv")).cast("double").alias("other")]
    rows = counts.select("tree_id", "sample_id", "variant_id", *split).dropna().join(tips, ["tree_id", "sample_id"]).join(parts, "tree_id")
    rows = rows.select("tree_id", F.pmod(F.xxhash64("variant_id"), "_n").cast("int").alias("part"), "variant_id", "tip", "support", "other")
    trees = ranges.join(parts, "tree_id").select("tree_id", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)).alias("part"), "edge_id", "first", "last")

    def best(rows: pd.DataFrame, tree: pd.DataFrame) -> pd.DataFrame:
        names = ["tree_id", "variant_id", "edge_id", "p_elsewhere"]
        if rows.empty or tree.empty:
            return pd.DataFrame({n: [] for n in names})
        code, variants = pd.factorize(rows["variant_id"])
        number, edge, elsewhere = _best_edges(code.astype(np.int64), *[rows[c].to_numpy() for c in ("tip", "support", "other")], weights,
                                              _Forest(*[tree[c].to_numpy() for c in ("edge_id", "first", "last")]))
        return pd.DataFrame({"tree_id": rows["tree_id"].iloc[0], "variant_id": np.asarray(variants)[number], "edge_id": edge, "p_elsewhere": elsewhere})[names]

    return rows.groupBy("tree_id", "part").cogroup(trees.groupBy("tree_id", "part")).applyInPandas(
        best, "tree_id string, variant_id string, edge_id bigint, p_elsewhere double")


def placed_table(placed: DataFrame, p_cut: float = 0.01) -> DataFrame:
    return placed.withColumn("confident", F.col("p_elsewhere") < p_cut)


def placement_master(placed: DataFrame, phylogeny: DataFrame) -> DataFrame:
    """Both placements in one table with their provenance."""
    a = placed.withColumn("provenance", F.lit("unfiltered_variant_placement"))
    b = phylogeny.withColumn("provenance", F.lit("phylogeny_filtered_variant_placement"))
    return a.unionByName(b, allowMissingColumns=True)


def branch_lengths(placed: DataFrame, edges: DataFrame) -> DataFrame:
    """Confidently placed variants per edge, 0 for edges without."""
    counts = placed.filter("confident").groupBy("edge_id").agg(F.count(F.lit(1)).alias("n"))
    return edges.select("edge_id").distinct().join(counts, "edge_id", "left").select("edge_id", F.coalesce("n", F.lit(0)).alias("length"))


def placed_vaf(placed: DataFrame, counts: DataFrame, edge_tips: DataFrame, mandatory: DataFrame | None = None) -> DataFrame:
    """VAF (NULL without depth) of variants placed on internal edges, less mandatory variants that fail QC."""
    internal = edge_tips.groupBy("edge_id").agg(F.count(F.lit(1)).alias("k")).filter("k > 1").select("edge_id")
    kept = placed.select("variant_id", "edge_id").join(internal, "edge_id", "left_semi")
    if mandatory is not None:
        kept = kept.join(mandatory.filter("passes_both <> 'Yes'").select("variant_id"), "variant_id", "left_anti")
    rows = counts.select("variant_id", "sample_id", "nv", "nr").join(kept, "variant_id")
    return rows.withColumn("vaf", vaf(empty=None))
