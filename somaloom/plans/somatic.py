"""Somatic filtering of a cohort: reads, calls and annotation in, labelled tables out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from somaloom.functions.variants import caller_verdict
from somaloom.operators import annotation, cascade, germline, germline_stats, joins, pileup, provenance
from somaloom.operators.pileup import ArtifactCutoffs
from somaloom.session import cut_lineage


def somatic_filter(
    obs: DataFrame, calls: DataFrame, annotated: DataFrame, bulk: DataFrame, mandatory: DataFrame | None = None,
    sex: str = "male", preset: str = "wgs", cutoffs: ArtifactCutoffs = ArtifactCutoffs(), max_af: float = 0.01,
    min_pass_cells: int = 1, germline_pct: float = 70,
) -> dict[str, DataFrame]:
    """One cohort from observations to provenance.

    ``obs``: read-bases (``sample_id, chrom, pos, ref, allele, allele_id, strand, mq, bq,
    bp_start, aln_score, clipped``); ``calls``: one row per variant and cell with ``gt, filter,
    ad_alt, dp``; ``annotated``: annotation records; ``bulk`` / ``mandatory``: variant ids.

    The strongest record of a variant passes the population filter (``af`` too where the records have
    it). The first statistical pass runs on the calls' own depths; only its survivors and the
    priority variants reach the pileup, so observations elsewhere are dropped before any of them
    is counted. Three stages that later stages re-read are written to the checkpoint folder;
    everything else is one plan per output.
    """
    ml = germline.ml_verdict_counts(calls.withColumn("mlv", caller_verdict()), min_pass_cells)
    kept = ml.filter("verdict = 'keep'").select("variant_id")
    records = joins.keep_chosen(annotated, kept)
    tie = "csq_raw" if "csq_raw" in records.columns else "consequence"
    strongest = annotation.best_annotation(records, tie=tie)
    population = annotation.population_filter(strongest, max_af, af="af" if "af" in records.columns else None)
    labelled = population.withColumn("verdict", annotation.clin_verdict())
    per_variant = population.select("variant_id", "filter_status", "filter_reason")
    passing = per_variant.filter("filter_status = 'PASS'").select("variant_id")
    priority = annotation.priority_variants(labelled, passing).select("variant_id", "impact", "verdict").dropDuplicates(["variant_id"])
    if mandatory is not None:
        priority = joins.merge_mandatory(priority, mandatory)
    bulk_status = joins.bulk_filter(passing, bulk, priority)
    chosen = bulk_status.filter("bulk_status <> 'Fail'").select("variant_id")

    called = joins.keep_chosen(calls, chosen).select("variant_id", "sample_id", "chrom", "pos", "ref", "alt", F.col("ad_alt").alias("nv"), F.col("dp").alias("nr"))
    depths = pileup.complete_grid(called, calls, ["variant_id", "chrom", "pos", "ref", "alt"], ["nv", "nr"])
    first = germline_stats.first_pass_verdict(germline_stats.first_pass(depths, sex=sex))
    survivors, first = joins.rescue_union(first, first.filter("stat_pass"), priority)
    first, survivors = cut_lineage(first), cut_lineage(joins.keep_chosen(chosen, survivors))

    loci = joins.keep_chosen(calls, survivors).select("chrom", "pos").distinct()
    metrics = pileup.pileup_metrics(obs.join(loci, ["chrom", "pos"], "left_semi"))
    flagged = cut_lineage(pileup.variant_pass(pileup.artifact_filters(metrics, cutoffs, disable_bppos=preset == "wes")))
    counts = cut_lineage(pileup.nv_nr_long(flagged, survivors))
    second = cut_lineage(germline_stats.second_pass(counts, sex=sex))
    verdicts = flagged.filter("alt <> 'REF'").groupBy("variant_id").agg(
        F.when(F.bool_or("variant_pass"), "Pass").otherwise("Fail").alias("pileup_verdict"))
    membership = cascade.scheme_membership(counts, second, verdicts, preset)
    staged = cascade.vaf_split(counts, second, verdicts, mandatory, preset)
    master = provenance.master_table(bulk_status, first.select("variant_id", "statistical_status", "rho"), per_variant, verdicts,
                                     second.select("variant_id", "germline_q"))
    annotated_master = joins.annotate_priority(master, priority)
    labels = germline.germline_labels(calls, first, per_variant, bulk_status, germline_pct)
    funnel = provenance.filter_funnel(master, kept, membership)
    return {
        "ml_verdicts": ml, "population": per_variant, "priority": priority, "bulk_status": bulk_status,
        "pileup": flagged, "counts": counts, "first_pass": first, "second_pass": second,
        "cascade": staged, "membership": membership, "cell_counts": cascade.per_cell_counts(staged),
        "scheme_summary": cascade.scheme_summary(staged), "master": annotated_master,
        "annotation_table": provenance.annotation_table(annotated_master), "funnel": funnel,
        "upstream_counts": provenance.upstream_counts(calls, master), "germline_labels": labels,
        "germline_prevalence": germline.germline_prevalence_long(labels, calls),
        "ado_intervals": germline.ado_intervals(germline.ado_table(calls)),
    }
