"""Genotype tables, character alignment and tree placement."""

from pyspark.sql import functions as F

from catalog.base import VIEWS, Data, query
from catalog.counts import nvnr, rounded
from somaloom.operators import germline_stats as G
from somaloom.operators import lineage as L
from somaloom.plans import lineage as P

VIEWS["placed"] = """
SELECT variant_id, arg_min(edge_id, struct_pack(g := -round(g, 9), e := edge_id)) AS edge_id, 1 - 1 / sum(exp(g - top)) AS p_elsewhere
FROM (SELECT *, max(g) OVER (PARTITION BY variant_id) AS top FROM (SELECT variant_id, edge_id, sum(nv * ln(0.5 / 0.01) + (nr - nv) * ln(0.5 / 0.99)) AS g FROM {nvnr} JOIN {edge_tips} USING (sample_id) GROUP BY 1, 2)) GROUP BY 1"""


def placed(d: Data):
    return L.placed_table(L.place_variants(nvnr(d), d.edge_tips))


@query("genotype_table", "SELECT sample_id, variant_id, gt FROM {calls} WHERE variant_id IN (SELECT variant_id FROM {sites} WHERE pos % 4 = 1)")
def genotype_table(d):
    return L.genotype_table(d.calls, d.sites.filter("pos % 4 = 1"))


@query("class_subset", """
SELECT variant_id, sample_id, nv, nr FROM (SELECT *, sum(nr) OVER (PARTITION BY sample_id) AS a, sum(nv) OVER (PARTITION BY sample_id) AS b FROM {nvnr} WHERE NOT (length(ref) = 1 AND length(alt) = 1)) WHERE a > 0 AND b > 0""")
def class_subset(d):
    return L.class_subset(nvnr(d), "indel").select("variant_id", "sample_id", "nv", "nr")


@query("alignment_strings", """
WITH g AS (SELECT *, CASE WHEN x < 0.1 * h THEN 'A' WHEN x >= 0.3 * h THEN 'T' ELSE '?' END AS c FROM (SELECT *, CAST(nv AS DOUBLE) / greatest(nr, 1) AS x, CASE WHEN chrom = 'chrX' THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS h FROM {nvnr})),
s AS (SELECT 'Ancestral' AS sample_id, repeat('A', CAST((SELECT count(DISTINCT variant_id) FROM g) AS INT)) AS sequence
UNION ALL SELECT sample_id, string_agg(c, '' ORDER BY chrom, pos // 1000000, pos, variant_id) FROM g GROUP BY 1)
SELECT sample_id, sequence, 'SC' || row_number() OVER (ORDER BY sample_id <> 'Ancestral', sample_id) AS short_name FROM s""")
def alignment_strings(d):
    return L.alignment_strings(G.genotype_discretize(nvnr(d)))


@query("place_variants", "SELECT variant_id, edge_id, round(p_elsewhere, 6) AS p_elsewhere, p_elsewhere < 0.01 AS confident FROM {placed}")
def place_variants(d):
    return rounded(placed(d), "p_elsewhere")


@query("placement_master", """
SELECT variant_id, edge_id, NULL::STRING AS note, 'unfiltered_variant_placement' AS provenance FROM {placed}
UNION ALL SELECT variant_id, edge_id, 'tree', 'phylogeny_filtered_variant_placement' FROM {placed} WHERE p_elsewhere < 0.01""")
def placement_master(d):
    p = placed(d)
    return L.placement_master(p.select("variant_id", "edge_id"), p.filter("confident").select("variant_id", "edge_id", F.lit("tree").alias("note"))).select("variant_id", "edge_id", "note", "provenance")


@query("branch_lengths", """
SELECT e.edge_id, count(p.variant_id) AS length FROM (SELECT DISTINCT edge_id FROM {edge_tips}) e LEFT JOIN {placed} p ON p.edge_id = e.edge_id AND p.p_elsewhere < 0.01 GROUP BY 1""")
def branch_lengths(d):
    return L.branch_lengths(placed(d), d.edge_tips)


@query("placed_vaf", """
SELECT n.variant_id, n.sample_id, n.nv, n.nr, p.edge_id, CASE WHEN n.nr > 0 THEN round(least(CAST(n.nv AS DOUBLE) / n.nr, 1), 6) END AS vaf FROM {nvnr} n JOIN {placed} p USING (variant_id)
WHERE p.edge_id >= 100 AND variant_id NOT IN (SELECT variant_id FROM {sites} WHERE pos % 14 = 0)""")
def placed_vaf(d):
    failing = d.sites.selectExpr("variant_id", "CASE WHEN pos % 14 = 0 THEN 'No' ELSE 'Yes' END AS passes_both")
    return L.placed_vaf(placed(d), nvnr(d), d.edge_tips, failing)


# a tree a third of the suppliers, whose tips are numbered so that a node's parent is half its number
VIEWS["tree_counts"] = """
SELECT concat('tree_', CAST(l_suppkey % 3 AS STRING)) AS tree_id, CAST(l_partkey AS STRING) AS variant_id, CAST(l_suppkey AS STRING) AS sample_id,
       l_suppkey + 1048576 AS tip, CAST(sum(CASE WHEN (l_partkey + l_suppkey % 8) % 4 = 0 AND l_linenumber < 5 THEN 1 ELSE 0 END) AS BIGINT) AS nv, count(*) AS nr
FROM {lineitem} GROUP BY 1, 2, 3, 4"""


VIEWS["placed_on_trees"] = """
SELECT tree_id, variant_id, CAST(arg_min(edge_id, struct_pack(g := -round(g, 9), e := edge_id)) AS BIGINT) AS edge_id, 1 - 1 / sum(exp(g - top)) AS p_elsewhere
FROM (SELECT *, max(g) OVER (PARTITION BY tree_id, variant_id) AS top FROM (
  SELECT tree_id, variant_id, tip >> h AS edge_id, sum(nv * ln(0.5 / 0.01) + (nr - nv) * ln(0.5 / 0.99)) AS g FROM {tree_counts}, (SELECT unnest(range(21)) AS h) GROUP BY 1, 2, 3))
GROUP BY 1, 2"""


def _trees(d: Data):
    """Trees of 21 levels; the twin joins every count to all edges above it."""
    nodes = d.tree_counts.select("tree_id", "sample_id", "tip").distinct().select("tree_id", "sample_id", "tip", F.explode(F.sequence(F.lit(0), F.lit(20))).alias("h"))
    node = F.expr("shiftright(CAST(tip AS BIGINT), h)")
    edges = nodes.select("tree_id", node.alias("edge_id"), F.expr("CASE WHEN h < 20 THEN shiftright(CAST(tip AS BIGINT), h + 1) END").alias("parent_id"),
                         F.when(F.col("h") == 0, F.col("sample_id")).alias("sample_id")).distinct()
    return P.lineage_trees(d.tree_counts, edges, p_cut=0.9)


@query("place_on_trees", "SELECT tree_id, variant_id, edge_id, round(p_elsewhere, 6) AS p_elsewhere FROM {placed_on_trees}")
def place_on_trees(d):
    return rounded(_trees(d)["placed"].drop("confident"), "p_elsewhere")


@query("tree_branch_lengths", """
SELECT e.tree_id, e.edge_id, count(p.variant_id) AS length FROM (SELECT DISTINCT tree_id, tip >> h AS edge_id FROM {tree_counts}, (SELECT unnest(range(21)) AS h)) e
LEFT JOIN {placed_on_trees} p ON p.tree_id = e.tree_id AND p.edge_id = e.edge_id AND p.p_elsewhere < 0.9 GROUP BY 1, 2""")
def tree_branch_lengths(d):
    return _trees(d)["branch_lengths"]
