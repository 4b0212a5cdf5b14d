"""Staged allele-fraction cascade: which cell carries which variant, stage by stage.

Every per-variant condition is a window over ``variant_id``. The input is one row per
(variant, cell), so such a partition holds as many rows as the cohort has cells; the
count table is shuffled once and all stages are read off the same partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from somaloom.functions.stats import log10_floored
from somaloom.functions.variants import is_snv_strict, vaf

def _per_variant():
    return W.partitionBy("variant_id")


@dataclass(frozen=True)
class CascadePreset:
    """Gates of the cascade (fixed values)."""

    min_rho: float = 0.2
    max_log10_q: float = -5
    depth: int = 5
    strict_reads: int = 3
    relaxed_reads: int = 2
    singleton_vaf: float = 0.30
    anchor_vaf: float = 0.30
    relaxed_vaf: float = 0.10
    covered_share: float = 0.70


PRESETS = {"wgs": CascadePreset(), "wes": CascadePreset(depth=10)}
STAGES = ("unfiltered", "hqstat", "qc", "depth", "phylogeny")


def with_evidence(counts: DataFrame) -> DataFrame:
    """Drop variants without a supporting read in any cell; add carrier count and class."""
    carriers = F.count_if(F.col("nv") > 0).over(_per_variant())
    return (
        counts.withColumn("n_carriers", carriers).filter("n_carriers > 0")
        .withColumn("class", F.when(F.col("n_carriers") == 1, "singleton").otherwise("shared"))
    )


def shared_retained(stats: DataFrame, preset: CascadePreset = PRESETS["wgs"]) -> Column:
    """Overdispersed and clearly non-germline; NULL statistics do not qualify."""
    return F.coalesce(
        (F.col("rho") >= preset.min_rho) & (log10_floored("germline_q") <= preset.max_log10_q), F.lit(False)
    )


def hqstat(df: DataFrame, preset: CascadePreset = PRESETS["wgs"]) -> DataFrame:
    """Statistical set: every singleton plus the retained shared variants."""
    return df.filter((F.col("class") == "singleton") | shared_retained(df, preset))


def anchor_call(df: DataFrame, preset: CascadePreset = PRESETS["wgs"]) -> DataFrame:
    """Per-cell call (0/1).

    A singleton needs the strict gate. A shared variant with at least one cell through
    the strict gate (its anchor) is called in other cells at the relaxed gate; without
    an anchor every cell needs the strict one.
    """
    k = preset
    deep = F.col("nr") >= k.depth
    strict = deep & (F.col("nv") >= k.strict_reads)
    anchor = strict & (F.col("vaf") >= k.anchor_vaf)
    relaxed = deep & (F.col("nv") >= k.relaxed_reads) & (F.col("vaf") >= k.relaxed_vaf)
    call = (
        F.when(F.col("class") == "singleton", strict & (F.col("vaf") >= k.singleton_vaf))
        .when(F.bool_or(anchor).over(_per_variant()), relaxed).otherwise(anchor)
    )
    return df.withColumn("call", call.cast("int"))


def called_somewhere(df: DataFrame) -> DataFrame:
    """Keep variants called in at least one cell (also the clean-up after an append)."""
    return df.withColumn("_n", F.sum("call").over(_per_variant())).filter("_n > 0").drop("_n")


def phylogeny_covered(df: DataFrame, preset: CascadePreset = PRESETS["wgs"]) -> DataFrame:
    """Keep variants covered at the depth gate in enough cells."""
    covered = F.count_if(F.col("nr") >= preset.depth).over(_per_variant())
    cells = F.count(F.lit(1)).over(_per_variant())
    return df.withColumn("_c", covered >= cells * F.lit(preset.covered_share)).filter("_c").drop("_c")


def append_mandatory(kept: DataFrame, evidence: DataFrame, mandatory: DataFrame) -> DataFrame:
    """Add mandatory variants absent from ``kept`` out of the evidence table; call is any support."""
    ids = mandatory.select("variant_id").distinct()
    missing = ids.join(kept.select("variant_id"), "variant_id", "left_anti")
    extra = evidence.join(missing, "variant_id", "left_semi").withColumn("call", (F.col("nv") > 0).cast("int"))
    return kept.unionByName(extra.select(*kept.columns))


def cascade_cells(
    counts: DataFrame, stats: DataFrame, verdicts: DataFrame, preset: str | CascadePreset = "wgs"
) -> DataFrame:
    """Evidence-bearing cells with their call and one flag per stage.

    ``stats``: ``variant_id, rho, germline_q`` of the second pass. ``verdicts``:
    ``variant_id, pileup_verdict``. All flags are variant-level.
    """
    k = PRESETS[preset] if isinstance(preset, str) else preset
    per_variant = stats.select("variant_id", "rho", "germline_q").join(
        verdicts.select("variant_id", "pileup_verdict"), "variant_id", "full"
    )
    cells = with_evidence(counts.select("variant_id", "sample_id", "nv", "nr"))
    cells = cells.join(per_variant, "variant_id", "left").withColumn("vaf", vaf())
    cells = anchor_call(cells, k).withColumns({
        "_called": F.max("call").over(_per_variant()),
        "_covered": F.count_if(F.col("nr") >= k.depth).over(_per_variant()),
        "_cells": F.count(F.lit(1)).over(_per_variant()),
    })
    in_stat = (F.col("class") == "singleton") | shared_retained(cells, k)
    cells = cells.withColumn("hqstat", in_stat)
    cells = cells.withColumn("qc", F.col("hqstat") & F.coalesce(F.col("pileup_verdict") == "Pass", F.lit(False)))
    cells = cells.withColumn("depth", F.col("qc") & (F.col("_called") == 1))
    covered = F.col("_covered") >= F.col("_cells") * F.lit(k.covered_share)
    return cells.withColumn("phylogeny", F.col("depth") & covered).drop("_called", "_covered", "_cells")


def vaf_split(
    counts: DataFrame, stats: DataFrame, verdicts: DataFrame, mandatory: DataFrame | None = None,
    preset: str | CascadePreset = "wgs",
) -> DataFrame:
    """All stages as one long table ``(variant_id, sample_id, nr, nv, vaf, call, stage)``.

    A call means any support before the artifact stage, the anchor-aware call after it.
    With ``mandatory`` two more stages carry the depth and phylogeny sets plus the
    mandatory variants, without rows that no cell supports.
    """
    cells = cascade_cells(counts, stats, verdicts, preset)
    supported = (F.col("nv") > 0).cast("int")
    entry = lambda stage, flag, call: F.when(flag, F.struct(F.lit(stage).alias("stage"), call.alias("call")))
    entries = [
        entry("unfiltered", F.lit(True), supported),
        entry("hqstat", F.col("hqstat"), supported),
        entry("qc", F.col("qc"), F.col("call")),
        entry("depth", F.col("depth"), F.col("call")),
        entry("phylogeny", F.col("phylogeny"), F.col("call")),
    ]
    if mandatory is not None:
        ids = mandatory.select("variant_id", F.lit(True).alias("_m")).distinct()
        cells = cells.join(ids, "variant_id", "left").withColumn("_m", F.coalesce("_m", F.lit(False)))
        for stage in ("depth", "phylogeny"):
            call = F.when(F.col(stage), F.col("call")).otherwise(supported)
            entries.append(entry(f"{stage}_mandatory", F.col(stage) | F.col("_m"), call))
    staged = cells.withColumn("_e", F.explode(F.filter(F.array(*entries), lambda e: e.isNotNull())))
    return staged.select("variant_id", "sample_id", "nr", "nv", "vaf", F.col("_e.call").alias("call"), F.col("_e.stage").alias("stage"))


def scheme_membership(
    counts: DataFrame, stats: DataFrame, verdicts: DataFrame, preset: str | CascadePreset = "wgs",
    min_depth: int = 0, min_pct: float = 0,
) -> DataFrame:
    """One 0/1 flag per scheme for every variant of the count table."""
    flags = cascade_cells(counts, stats, verdicts, preset).groupBy("variant_id").agg(
        *[F.bool_or(s).cast("int").alias(s) for s in STAGES[1:]]
    )
    gate = unfiltered_gate(counts, min_depth, min_pct).withColumn("unfiltered", F.lit(1))
    ids = counts.select("variant_id").distinct()
    joined = ids.join(gate, "variant_id", "left").join(flags, "variant_id", "left")
    return joined.select("variant_id", *[F.coalesce(s, F.lit(0)).alias(f"scheme_{s}") for s in STAGES])


def unfiltered_gate(counts: DataFrame, min_depth: int = 0, min_pct: float = 0) -> DataFrame:
    """Variants deep enough in enough cells and with support in at least one."""
    share = F.avg((F.col("nr") >= min_depth).cast("double")) * 100
    stats = counts.groupBy("variant_id").agg(share.alias("_s"), F.max("nv").alias("_nv"))
    return stats.filter((F.col("_s") >= min_pct) & (F.col("_nv") > 0)).select("variant_id")


def scheme_subset(rows: DataFrame, membership: DataFrame, scheme: str = "scheme_depth") -> DataFrame:
    """Rows of the variants that belong to a scheme."""
    return rows.join(membership.filter(F.col(scheme) == 1).select("variant_id"), "variant_id", "left_semi")


def per_cell_counts(staged: DataFrame, by: Sequence[str] = ("stage", "sample_id")) -> DataFrame:
    """SNV / INDEL calls per cell and stage; cells without a call keep a zero row."""
    parts = F.split("variant_id", "_")
    snv = is_snv_strict(F.get(parts, F.size(parts) - 2), F.get(parts, F.size(parts) - 1))
    called = F.col("call") == 1
    return staged.groupBy(*by).agg(
        F.count_if(called & snv).alias("n_snv"), F.count_if(called & ~snv).alias("n_indel")
    )


def scheme_summary(staged: DataFrame) -> DataFrame:
    """SNV / INDEL variants per scheme, total and SNV share."""
    parts = F.split("variant_id", "_")
    snv = is_snv_strict(F.get(parts, F.size(parts) - 2), F.get(parts, F.size(parts) - 1))
    ids = staged.select("stage", "variant_id").distinct()
    return ids.groupBy("stage").agg(F.count_if(snv).alias("n_snv"), F.count_if(~snv).alias("n_indel")).withColumns({
        "n_total": F.col("n_snv") + F.col("n_indel"),
        "pct_snv": F.round(100 * F.try_divide(F.col("n_snv").cast("double"), F.col("n_snv") + F.col("n_indel")), 6),
    })


def scheme_sample_spread(cell_counts: DataFrame) -> DataFrame:
    """Median and inter-quartile range over cells of the calls per scheme (one row per cell and scheme)."""
    total = (F.col("n_snv") + F.col("n_indel")).alias("n")
    q = F.percentile("n", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    out = cell_counts.select("stage", total).groupBy("stage").agg(q.alias("q"))
    return out.select("stage", F.col("q")[0].alias("q25"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q75"),
                      (F.col("q")[2] - F.col("q")[0]).alias("iqr"))
