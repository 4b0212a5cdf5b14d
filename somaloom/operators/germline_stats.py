"""Cohort-level germline and overdispersion tests (first and second statistical pass)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from somaloom.functions.ranks import bh_adjust
from somaloom.functions.stats import betabinom_rho_of, binomial_less_pvalue, log10_or_neg_inf
from somaloom.functions.variants import on_sex_chromosome

VARIANT = ("variant_id", "chrom", "ref", "alt")


def _haploid(sex: str) -> Column:
    """Rows tested as haploid: X and Y of a male donor."""
    return on_sex_chromosome() if sex == "male" else F.lit(False)


def expected_fraction(sex: str) -> Column:
    """Expected germline allele fraction: 0.5, or 0.95 where the donor is haploid."""
    return F.when(_haploid(sex), 0.95).otherwise(0.5)


def raise_depth(counts: DataFrame) -> DataFrame:
    """Where a cell reports more support than depth, depth is raised to the support."""
    return counts.withColumn("nr", F.greatest("nr", "nv"))


def group_depth(counts: DataFrame, min_depth: float = -1, max_depth: float = 9999999, sex: str = "male") -> DataFrame:
    """Mean depth per variant over all cells and the strict-bounds depth filter (halved where haploid)."""
    half = F.when(_haploid(sex), 2.0).otherwise(1.0)
    means = counts.groupBy(*VARIANT).agg(F.avg("nr").alias("mean_depth"))
    return means.withColumn(
        "depth_filter", (F.col("mean_depth") > min_depth / half) & (F.col("mean_depth") < max_depth / half)
    )


def germline_pvalues(counts: DataFrame, sex: str = "male") -> DataFrame:
    """Pooled one-sided binomial test per variant; 1 without coverage."""
    pooled = counts.groupBy(*VARIANT).agg(F.sum("nv").alias("nv_total"), F.sum("nr").alias("nr_total"))
    return pooled.withColumn("germline_p", binomial_less_pvalue("nv_total", "nr_total", expected_fraction(sex)))


def betabinom_rho(counts: DataFrame, empty_as_one: bool = False, key: str = "variant_id") -> DataFrame:
    """Maximum-likelihood overdispersion per variant on a fixed grid; the first maximum wins.

    Cells with equal (nv, nr) are one weighted entry before they move; a variant then is one row of arrays, scored as
    a whole (:func:`somaloom.functions.stats.betabinom_best`). Variants without information tie and take the first grid
    value; those without coverage have no row. ``empty_as_one`` counts a cell without reads as one reference read.
    """
    nr = F.greatest("nr", F.lit(1)) if empty_as_one else F.col("nr")
    pairs = counts.groupBy(key, "nv", nr.alias("nr")).agg(F.count(F.lit(1)).alias("cells"))
    entries = pairs.groupBy(key).agg(F.collect_list(F.struct("nv", "nr", "cells")).alias("_e"))
    rho = betabinom_rho_of(F.col("_e.nv"), F.col("_e.nr"), F.col("_e.cells"))
    return entries.select(key, rho.alias("rho")).filter("rho IS NOT NULL")


def variant_totals(counts: DataFrame, min_depth: float, max_depth: float, sex: str) -> DataFrame:
    """Depth, pooled counts, carriers and germline p-value of every variant in one aggregate."""
    half = F.when(_haploid(sex), 2.0).otherwise(1.0)
    return counts.groupBy(*VARIANT).agg(
        F.avg("nr").alias("mean_depth"), F.sum("nv").alias("nv_total"), F.sum("nr").alias("nr_total"),
        F.count_if(F.col("nv") > 0).alias("n_carriers"),
    ).withColumns({
        "depth_filter": (F.col("mean_depth") > min_depth / half) & (F.col("mean_depth") < max_depth / half),
        "germline_p": binomial_less_pvalue("nv_total", "nr_total", expected_fraction(sex)),
    })


def first_pass(counts: DataFrame, min_depth: float = -1, max_depth: float = 9999999, sex: str = "male") -> DataFrame:
    """Depth, germline p-value and overdispersion of every variant.

    Overdispersion is estimated only for variants seen in several cells that pass depth
    and whose p-value, adjusted within the chromosome, is below 0.05; NULL otherwise.
    """
    counts = raise_depth(counts)
    stats = variant_totals(counts, min_depth, max_depth, sex)
    adjusted = bh_adjust(stats, "germline_p", by=["chrom"], out="_chrom_q")
    tested = adjusted.filter((F.col("_chrom_q") < 0.05) & F.col("depth_filter") & (F.col("n_carriers") > 1))
    rho = betabinom_rho(counts.join(tested.select("variant_id"), "variant_id", "left_semi"), empty_as_one=True)
    return (
        stats.join(rho, "variant_id", "left")
        .withColumns({"germline_p_log10": log10_or_neg_inf("germline_p"), "sex": F.lit(sex)})
        .select(*VARIANT, "mean_depth", "depth_filter", "germline_p", "germline_p_log10", "rho", "sex")
    )


def first_pass_verdict(stats: DataFrame, q_cut: float = -5, rho_cut: float = 0.1) -> DataFrame:
    """Global BH, germline and overdispersion filters and their combined verdict text."""
    q = bh_adjust(stats, "germline_p", out="germline_q")
    spell = lambda flag: F.upper(F.col(flag).cast("string"))
    return (
        q.withColumn("germline_q_log10", log10_or_neg_inf("germline_q"))
        .withColumns({
            "germline_filter": F.coalesce(F.col("germline_q_log10") < q_cut, F.lit(False)),
            "betabinom_filter": F.col("rho").isNull() | (F.col("rho") > rho_cut),
        })
        .withColumn("verdict", F.concat_ws("_", spell("depth_filter"), spell("germline_filter"), spell("betabinom_filter")))
        .withColumn("stat_pass", F.col("verdict") == "TRUE_TRUE_TRUE")
    )


def low_vaf_in_positive(counts: DataFrame, min_reads: int = 3, sex: str = "male") -> DataFrame:
    """Pooled binomial test over the cells with at least ``min_reads`` supporting reads; 0 when none has."""
    strong = F.col("nv") >= min_reads
    pooled = counts.groupBy(*VARIANT).agg(
        F.sum(F.when(strong, F.col("nv")).otherwise(0)).alias("k"),
        F.sum(F.when(strong, F.col("nr")).otherwise(0)).alias("n"),
    )
    p = binomial_less_pvalue("k", F.greatest("n", "k"), expected_fraction(sex))
    return pooled.withColumn("p_positive", F.when(F.col("k") > 0, p).otherwise(0.0)).drop("k", "n")


def low_vaf_flag(counts: DataFrame, threshold: float) -> DataFrame:
    """True where some cell's NV/NR (depth 0 counted as 1) exceeds ``threshold``."""
    share = F.col("nv") / F.greatest("nr", F.lit(1))
    return counts.groupBy("variant_id").agg(F.bool_or(share > threshold).alias("low_vaf"))


def second_pass(
    counts: DataFrame, q_cut: float = 2, rho_snv: float = 0, rho_indel: float = 0,
    min_depth: float = -1, max_depth: float = 9999999, sex: str = "male",
    min_vaf: float = 0, min_positive_reads: int = 0,
) -> DataFrame:
    """Second statistical pass: BH within chromosome, depth, overdispersion of every variant.

    ``second_pass`` is Pass when all filters in use hold. ``min_vaf`` and
    ``min_positive_reads`` switch the two optional filters on.
    """
    stats = variant_totals(counts, min_depth, max_depth, sex).drop("nv_total", "nr_total", "n_carriers")
    out = bh_adjust(stats, "germline_p", by=["chrom"], out="germline_q")
    out = out.join(betabinom_rho(counts), "variant_id", "left")
    indel = (F.length("ref") > 1) | (F.length("alt") > 1)
    out = out.withColumns({
        "germline_filter": F.coalesce(log10_or_neg_inf("germline_q") < q_cut, F.lit(False)),
        "betabinom_filter": F.coalesce(F.col("rho") > F.when(indel, float(rho_indel)).otherwise(float(rho_snv)), F.lit(False)),
    })
    passed = F.col("depth_filter") & F.col("germline_filter") & F.col("betabinom_filter")
    if min_vaf > 0:
        out = out.join(low_vaf_flag(counts, min_vaf), "variant_id")
        passed = passed & F.col("low_vaf")
    if min_positive_reads > 0:
        out = out.join(low_vaf_in_positive(counts, min_positive_reads, sex).select("variant_id", "p_positive"), "variant_id")
        passed = passed & (F.col("p_positive") > 1e-3)
    return out.withColumn("second_pass", F.when(passed, "Pass").otherwise("Fail"))


def cell_pvalues(counts: DataFrame, sex: str = "male", adjust: bool = False) -> DataFrame:
    """Binomial p-value of every (variant, cell), depth 0 taken as 1; optionally BH over the whole matrix."""
    p = counts.withColumn("p_value", binomial_less_pvalue("nv", F.greatest("nr", F.lit(1)), expected_fraction(sex)))
    return bh_adjust(p, "p_value", out="q_value") if adjust else p


def infer_sex(counts: DataFrame) -> DataFrame:
    """``female`` when mean X/Y depth exceeds 0.8 of the autosomal depth, else ``male``.

    Without both kinds of chromosome the answer is ``female``.
    """
    sex_chrom = on_sex_chromosome()
    depth = counts.agg(
        F.avg(F.when(sex_chrom, F.col("nr"))).alias("xy_depth"),
        F.avg(F.when(~sex_chrom, F.col("nr"))).alias("autosomal_depth"),
    )
    both = F.col("xy_depth").isNotNull() & F.col("autosomal_depth").isNotNull()
    low = F.col("xy_depth") <= 0.8 * F.col("autosomal_depth")
    return depth.withColumn("sex", F.when(both & low, "male").otherwise("female"))


def genotype_discretize(
    counts: DataFrame, sex: str = "male", absent: float = 0.1, present: float = 0.3
) -> DataFrame:
    """Genotype 0 / 0.5 / 1 from VAF; cutoffs are doubled where the donor is haploid."""
    share = F.col("nv") / F.greatest("nr", F.lit(1))
    scale = F.when(_haploid(sex), 2.0).otherwise(1.0)
    return counts.withColumn(
        "genotype", F.when(share < absent * scale, 0.0).when(share >= present * scale, 1.0).otherwise(0.5)
    )


def genotype_prob(
    counts: DataFrame, sex: str = "male", min_reads: int | None = 2, min_p: float | None = 0.05,
    min_vaf: Sequence[float] | None = (0.2, 0.7),
) -> DataFrame:
    """Genotype 1 when read, p-value and VAF gates hold, else 0 or 0.5 ("not sure").

    ``min_vaf`` gives the autosomal and the haploid bound. A gate set to None is off.
    P-values are compared with a tolerance of 1e-12, so a value equal to its cutoff
    up to rounding counts as above it.
    """
    p = cell_pvalues(counts, sex)
    share = F.col("nv") / F.greatest("nr", F.lit(1))
    above = lambda cut: F.col("p_value") > cut - 1e-12
    gate = F.lit(True)
    if min_reads is not None:
        gate = gate & (F.col("nv") >= min_reads)
    if min_p is not None:
        gate = gate & above(min_p)
    if min_vaf is not None:
        gate = gate & (share > F.when(_haploid(sex), float(min_vaf[1])).otherwise(float(min_vaf[0])))
    unsure = (
        ((F.col("nv") > 0) & above(0.01) & ~gate)
        | ((F.col("nv") >= 3) & above(0.001) & ~gate)
        | ((F.col("nv") == 0) & above(0.05))
    )
    return p.withColumn("genotype", F.when(unsure, 0.5).when(gate, 1.0).otherwise(0.0))
