"""Lineage and signatures from the count tables of a cohort."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from somaloom.operators import germline_stats, lineage, signatures
from somaloom.session import cut_lineage


def lineage_tables(counts: DataFrame, edge_tips: DataFrame, kind: str = "both", sex: str = "male", mandatory: DataFrame | None = None) -> dict[str, DataFrame]:
    """Alignment for the tree search and, given its tree, the placement of every variant."""
    subset = lineage.class_subset(counts, kind)
    genotypes = germline_stats.genotype_discretize(subset, sex)
    placed = lineage.placed_table(lineage.place_variants(subset, edge_tips))
    return {
        "alignment": lineage.alignment_strings(genotypes), "placed": placed,
        "branch_lengths": lineage.branch_lengths(placed, edge_tips), "placed_vaf": lineage.placed_vaf(placed, subset, edge_tips, mandatory),
    }


def lineage_trees(counts: DataFrame, edges: DataFrame, p_cut: float = 0.01) -> dict[str, DataFrame]:
    """Placement on many trees at once, deep ones included.

    ``counts``: ``tree_id, variant_id, sample_id, nv, nr``; ``edges``: ``tree_id, edge_id, parent_id, sample_id``. The tip ranges
    are written once and read for tips and edges; a length is the number of confident variants of an edge.
    """
    ranges = cut_lineage(lineage.tip_ranges(edges))
    placed = lineage.placed_table(lineage.place_on_trees(counts, ranges), p_cut)
    found = placed.filter("confident").groupBy("tree_id", "edge_id").agg(F.count(F.lit(1)).alias("n"))
    lengths = ranges.join(found, ["tree_id", "edge_id"], "left").select("tree_id", "edge_id", F.coalesce("n", F.lit(0)).alias("length"))
    return {"ranges": ranges, "placed": placed, "branch_lengths": lengths}


def signature_tables(called: DataFrame, catalog: DataFrame, project: str, genome: str) -> dict[str, DataFrame]:
    """Signature input, spectra, refit and coverage. ``called`` needs ``context`` (three reference bases)."""
    table = signatures.variant_table(called, project, genome)
    contexts = signatures.context_counts(called.filter("call = 1"))
    fitted = signatures.signature_refit(contexts.withColumnRenamed("context_class", "feature"), catalog)
    return {
        "variant_table": table, "spectrum": signatures.mutation_spectrum(table), "contexts": contexts, "activities": fitted,
        "stats": signatures.signature_stats(fitted), "fractions": signatures.signature_fraction(fitted),
    }
