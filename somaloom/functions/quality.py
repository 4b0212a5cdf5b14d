"""QC scores, verdicts and copy-number quality classes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: (metric, comparison, cutoff) of each scoring profile
PROFILES: dict[str, list[tuple[str, str, float]]] = {
    "dna": [
        ("preseq_count", ">", 3500000000),
        ("pct_chimeras", "<", 0.2),
        ("pct_chrm", "<", 0.2),
        ("mapd_cnv_log2", "<", 0.25),
        ("skew_cnv", "<", 0.25),
    ],
    "wgs": [
        ("total_reads", ">=", 50000000),
        ("pct_duplication", "<", 0.25),
        ("pct_chimeras", "<", 0.15),
        ("pct_1x", ">=", 0.9),
        ("pct_5x", ">=", 0.7),
    ],
    "wes": [
        ("total_reads", ">=", 500000),
        ("pct_target_bases_10x", ">=", 0.75),
        ("zero_cvg_targets_pct", "<", 0.05),
        ("fold_80_base_penalty", "<", 5),
    ],
    "rna": [
        ("prop_mappability", ">", 0.7),
        ("prop_exonic", ">", 0.7),
        ("prop_intergenic", "<", 0.1),
        ("prop_mitochondrial", "<", 0.1),
        ("protein_coding_genes", ">", 500),
    ],
}


def qc_score(profile: str, cutoffs: dict[str, float] | None = None) -> Column:
    """Number of metrics on the good side of their cutoff; a NULL metric scores 0."""
    total = F.lit(0)
    for metric, op, cutoff in PROFILES[profile]:
        limit = F.lit(float((cutoffs or {}).get(metric, cutoff)))
        x = F.col(metric).cast("double")
        good = {">": x > limit, ">=": x >= limit, "<": x < limit}[op]
        total = total + F.when(good, 1).otherwise(0)
    return total


def qc_status(profile: str, score="qc_score", total_reads="total_reads") -> dict[str, Column]:
    """Final ``qc_score`` / ``qc_status``; a sample without reads fails with no score."""
    s = F.col(score)
    good, border = (3, 2) if profile == "wes" else (4, 3)
    missing = "FAIL" if profile == "dna" else "PENDING"
    empty = F.coalesce(F.col(total_reads), F.lit(0)) == 0
    status = (
        F.when(empty, "FAIL").when(s.isNull(), missing)
        .when(s >= good, "PASS").when(s == border, "Borderline").otherwise("FAIL")
    )
    return {"qc_score": F.when(~empty, s), "qc_status": status}


def cnv_quadrant(mapd="mapd_cnv_log2", skew="skew_cnv") -> Column:
    """Noise / evenness class of a copy-number profile."""
    noisy, uneven = F.col(mapd) >= 0.25, F.col(skew) >= 0.25
    ideal = (F.col(mapd) < 0.2) & (F.col(skew) < 0.2)
    clear_noise = noisy & (F.col(skew) < 0.2)
    clear_uneven = uneven & (F.col(mapd) < 0.2)
    return (
        F.when(F.col(mapd).isNull() | F.col(skew).isNull(), F.lit(None))
        .when(ideal, "Ideal").when(clear_noise, "Noisier").when(clear_uneven, "Uneven")
        .when(noisy | uneven, "Noisier and Uneven").otherwise("Border")
    )


def ploidy_label(x="ploidy") -> Column:
    """Copy-number label, everything from 4 on pooled."""
    return F.when(F.col(x) >= 4, ">=4").otherwise(F.round(F.col(x)).cast("int").cast("string"))


def ploidy_capped(x="ploidy", cap: int = 8) -> Column:
    """Copy number cut at ``cap`` before distances are taken."""
    return F.least(F.col(x), F.lit(cap))


def coverage_fraction(mean_coverage="mean_coverage", target: float = 1.0, name="biosample") -> dict[str, Column]:
    """Down-sampling fraction to ``target`` and the coverage-labelled sample name."""
    mean = F.col(mean_coverage)
    enough = mean > target
    reached = F.when(enough, F.lit(target)).otherwise(mean)
    return {
        "fraction": F.when(enough, F.try_divide(F.lit(float(target)), mean)).otherwise(F.lit(1.0)),
        "labelled_name": F.format_string("%s_cov%02dx", F.col(name), F.floor(reached).cast("int")),
    }
