"""QC of a run: scores, status, copy-number noise."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from somaloom.functions import quality
from somaloom.operators import cnv, joins
from somaloom.session import cut_lineage


def copy_number(bins: DataFrame, segments: DataFrame, gc: DataFrame | None = None) -> dict[str, DataFrame]:
    """Raw bins and segment ids (``sample_id, chrom, bin_start, segment``) to copy numbers and noise measures."""
    normal = cnv.normalize_bins(bins)
    if gc is not None:
        corrected = cnv.gc_correct(bins, gc).select("sample_id", "chrom", "bin_start", "corrected")
        normal = normal.join(corrected, ["sample_id", "chrom", "bin_start"]).withColumn("normal", F.col("corrected")).drop("corrected")
    cn = cut_lineage(cnv.copy_number_grid(cnv.segment_medians(normal.join(segments, ["sample_id", "chrom", "bin_start"]))))
    return {"bins": cn, "summary": cnv.cnv_summary_metrics(cn), "segments": cnv.cnv_segments(cn), "ploidy": cnv.average_ploidy(cn), "bin_stats": cnv.bin_stats(bins)}


def score_run(metrics: DataFrame, profile: str, cnv_metrics: DataFrame | None = None) -> DataFrame:
    """Per-sample metrics with score and status; ``cnv_metrics`` adds ``skew_cnv`` and ``mapd_cnv_log2``."""
    if cnv_metrics is not None:
        metrics = joins.metrics_with_cnv(metrics, cnv_metrics, columns=["skew_cnv", "mapd_cnv_log2"])
    scored = metrics.withColumn("_score", quality.qc_score(profile))
    return scored.withColumns(quality.qc_status(profile, "_score")).drop("_score")
