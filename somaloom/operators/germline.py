"""Germline labels, prevalence and allele-dropout operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from somaloom.functions.variants import gt_flags, vaf, vaf_decile
from somaloom.operators.sets import hash_sample

# fixed values: labels of the ten allele-frequency deciles
DECILES = ("[0-0.1)", "[0.1-0.2)", "[0.2-0.3)", "[0.3-0.4)", "[0.4-0.5)",
           "[0.5-0.6)", "[0.6-0.7)", "[0.7-0.8)", "[0.8-0.9)", "[0.9-1]")


def vaf_gt_discordance(calls: DataFrame, nv: str = "nv", nr: str = "nr", gt: str = "gt") -> DataFrame:
    """VAF, Concordant / Discordant per call and the cohort's discordant share."""
    out = calls.withColumns({
        "vaf": vaf(nv, nr, empty=None),
        "verdict": F.when(F.translate(gt, "|", "/") == "0/0", "Discordant").otherwise("Concordant"),
    })
    share = calls.agg(F.round(F.avg((F.translate(gt, "|", "/") == "0/0").cast("double")), 6)).scalar()
    return out.withColumn("discordant_proportion", share)


def ml_verdict_counts(calls: DataFrame, min_pass: int = 1) -> DataFrame:
    """Carriers, accepted and rejected calls per variant, and keep / drop. ``mlv`` is 0, 1 or NULL."""
    per = calls.groupBy("variant_id").agg(
        F.count("mlv").alias("n_carry"), F.count_if(F.col("mlv") == 0).alias("n_pass"),
        F.count_if(F.col("mlv") == 1).alias("n_reject"),
    )
    return per.withColumns({
        "reject_fraction": F.coalesce(F.try_divide(F.col("n_reject").cast("double"), F.col("n_carry")), F.lit(0.0)),
        "verdict": F.when(F.col("n_pass") >= min_pass, "keep").otherwise("drop"),
    })


def ml_verdict_summary(per_variant: DataFrame) -> DataFrame:
    """Cohort totals of :func:`ml_verdict_counts`."""
    keep = F.count_if(F.col("verdict") == "keep")
    n = F.count(F.lit(1))
    share = lambda k: F.coalesce(F.round(100 * F.try_divide(k.cast("double"), n), 2), F.lit(0.0))
    return per_variant.agg(n.alias("total_variants"), keep.alias("usable_variants"), (n - keep).alias("filtered_variants"),
                           share(keep).alias("pct_kept"), share(n - keep).alias("pct_filtered"))


def prevalence(calls: DataFrame, gt: str = "gt") -> DataFrame:
    """Het and non-reference cells per variant, as counts and as shares of the whole cohort."""
    cohort = calls.agg(F.count_distinct("sample_id")).scalar()
    flags = gt_flags(gt)
    per = calls.groupBy("variant_id").agg(
        F.count_if(flags["het"]).alias("n_het"), F.count_if(flags["non_ref"]).alias("n_non_ref"))
    return per.withColumns({
        "het_pct": F.col("n_het") / cohort * 100,
        "prevalence": F.col("n_non_ref") / cohort,
    })


def germline_labels(calls: DataFrame, stats: DataFrame, population: DataFrame, bulk: DataFrame | None, pct: float = 70) -> DataFrame:
    """Twelve germline columns for every called variant.

    ``stats``: ``variant_id, germline_q_log10, rho``; ``population``: ``variant_id,
    filter_reason``; ``bulk``: ``variant_id, bulk_status`` or None when no bulk sample
    was given (all Pass). Het share must exceed ``pct`` for the statistical label and
    reach it for the other two.
    """
    likely = F.coalesce((F.col("germline_q_log10") > -1) & (F.col("rho").isNull() | (F.col("rho") < 0.1)), F.lit(False))
    df = prevalence(calls).join(stats.select("variant_id", "germline_q_log10", "rho"), "variant_id", "left")
    df = df.withColumn("_cand", likely)
    by_af = population.filter(F.col("filter_reason") == "AF_filter").select("variant_id", F.lit(True).alias("_af")).distinct()
    df = df.join(by_af, "variant_id", "left").withColumn("_af", F.coalesce("_af", F.lit(False)))
    if bulk is None:
        df = df.withColumn("remaining_after_bulk", F.lit("Pass"))
    else:
        df = df.join(bulk.select("variant_id", F.col("bulk_status").alias("remaining_after_bulk")), "variant_id", "left")
        df = df.withColumn("remaining_after_bulk", F.coalesce("remaining_after_bulk", F.lit("Not_evaluated")))
    confirmed = F.col("_cand") & (F.col("het_pct") > pct)
    fail = F.col("remaining_after_bulk") == "Fail"
    reach = F.col("het_pct") >= pct
    yes = lambda c: F.when(c, "Yes").otherwise("No")
    share = F.round("prevalence", 4)
    return df.select(
        "variant_id",
        yes(confirmed).alias("high_confidence_germline"), yes(F.col("_cand")).alias("germline_from_stats"),
        F.when(F.col("_af"), "AF_filter").otherwise("Not_filtered").alias("vep_af_filter"),
        yes(F.col("_af") & reach).alias("vep_high_confidence"), "remaining_after_bulk",
        yes(fail & reach).alias("bulk_high_confidence"),
        *[F.when(cond, value).alias(f"{name}_{kind}")
          for name, cond in (("stats", confirmed), ("vep_af", F.col("_af")), ("bulk_fail", fail))
          for kind, value in (("count", F.col("n_non_ref")), ("proportion", share))],
    )


def germline_prevalence_long(labels: DataFrame, calls: DataFrame) -> DataFrame:
    """The three labelled sets as ``(variant_id, filter, prevalence)`` rows."""
    stats = labels.filter("germline_from_stats = 'Yes'").select("variant_id").join(
        prevalence(calls).select("variant_id", F.round("prevalence", 6).alias("prevalence")), "variant_id")
    parts = [stats.select("variant_id", F.lit("GERMLINE_FROM_STATS").alias("filter"), "prevalence")]
    for name, cond, col in (("VEP_AF_filter", "vep_af_filter = 'AF_filter'", "vep_af_proportion"),
                            ("Bulk_Fail", "remaining_after_bulk = 'Fail'", "bulk_fail_proportion")):
        parts.append(labels.filter(cond).select("variant_id", F.lit(name).alias("filter"), F.col(col).alias("prevalence")))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def prevalence_histogram(long: DataFrame, threshold: float) -> DataFrame:
    """Variants per set, prevalence rounded to 0.1, and Pass / Fail against the threshold."""
    status = F.when(F.col("prevalence") >= threshold, "Pass").otherwise("Fail").alias("status")
    return long.groupBy("filter", F.bround("prevalence", 1).alias("prevalence_bin"), status).agg(F.count(F.lit(1)).alias("n"))


def prevalence_summary(long: DataFrame, threshold: float) -> DataFrame:
    """Variants, passing variants and median prevalence per set (prevalences take few distinct values)."""
    return long.groupBy("filter").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("prevalence") >= threshold).alias("n_pass"),
        F.round(F.median("prevalence"), 3).alias("median"))


def ado_table(calls: DataFrame, proportion: float = 1.0, seed: int = 0, provenance: str = "germline") -> DataFrame:
    """Alternate-allele frequency per call (0 without depth), a seeded share of the sites."""
    freq = F.when(F.col("dp") > 0, F.col("ad_alt").cast("double") / F.greatest("dp", F.lit(1))).otherwise(0.0)
    table = calls.select("sample_id", "variant_id", "chrom", "pos", "ref", "alt", "ad_alt", "dp", freq.alias("freq"),
                         F.lit(provenance).alias("provenance"))
    return hash_sample(table, proportion, "variant_id", seed)


def ado_intervals(table: DataFrame, min_depth: int = 2) -> DataFrame:
    """Sites and share of sites per frequency decile and sample; empty deciles included."""
    decile = vaf_decile("freq")
    counts = table.filter(F.col("dp") >= min_depth).groupBy("sample_id").agg(
        *[F.count_if(decile == i).alias(f"d{i}") for i in range(len(DECILES))], F.count(F.lit(1)).alias("_n"))
    pairs = F.array(*[F.struct(F.lit(name).alias("interval"), F.col(f"d{i}").alias("freq")) for i, name in enumerate(DECILES)])
    rows = counts.select("sample_id", "_n", F.explode(pairs).alias("p"))
    return rows.select("sample_id", "p.interval", "p.freq", (F.col("p.freq") / F.col("_n")).alias("prop"))


def ado_balance(intervals: DataFrame) -> DataFrame:
    """Share of sites with allele frequency in [0.2, 0.8) per sample."""
    middle = F.col("interval").isin(*DECILES[2:8])
    return intervals.filter(middle).groupBy("sample_id").agg(F.sum("prop").alias("ado_perc"))


def ado_comparison(intervals: DataFrame, by: str = "provenance") -> DataFrame:
    """Samples, total entries and mean sites per sample of each provenance."""
    out = intervals.groupBy(by).agg(F.count_distinct("sample_id").alias("n_samples"), F.sum("freq").alias("n_total"))
    return out.withColumn("n_sites", F.bround(F.col("n_total") / F.col("n_samples")).cast("bigint"))


def vcf_stats(calls: DataFrame) -> DataFrame:
    """Per sample: SNVs, indels, transitions, transversions and genotype counts of the carried variants."""
    flags = gt_flags("gt")
    snv = (F.length("ref") == 1) & (F.length("alt") == 1)
    transition = F.concat("ref", "alt").isin("AG", "GA", "CT", "TC")
    carried = flags["has_alt"]
    out = calls.groupBy("sample_id").agg(
        F.count_if(carried & snv).alias("n_snv"), F.count_if(carried & ~snv).alias("n_indel"),
        F.count_if(carried & snv & transition).alias("n_ts"), F.count_if(carried & snv & ~transition).alias("n_tv"),
        F.count_if(flags["het"]).alias("n_het"), F.count_if(carried & ~flags["has_ref"]).alias("n_hom_alt"),
        F.count_if(~carried).alias("n_ref"))
    return out.withColumn("ts_tv", F.round(F.try_divide(F.col("n_ts").cast("double"), F.col("n_tv")), 6))
