"""Copy-number operators over genome bins.

Groups here are the bins of one sample, or of one chromosome of it: their size is set by
the genome and the bin width, not by the number of reads or samples.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from somaloom.operators.joins import assign_intervals
from somaloom.operators.pileup import MAD_SCALE, complete_grid
from somaloom.operators.sets import natural_chromosome_key

POOLED = 9999999


def bin_counts(reads: DataFrame, bins: DataFrame, width: int = 1_000_000) -> DataFrame:
    """Reads per bin and sample, empty bins included. Bins are closed ``[start, end]``."""
    hits = assign_intervals(reads, bins, width).groupBy("chrom", "start", "end", "sample_id").agg(F.count(F.lit(1)).alias("raw_count"))
    all_bins = bins.select("chrom", "start", "end").join(hits, ["chrom", "start", "end"], "left").filter("sample_id IS NOT NULL")
    empty = bins.select("chrom", "start", "end").join(hits, ["chrom", "start", "end"], "left_anti")
    first = reads.agg(F.min("sample_id")).scalar()
    present = all_bins.unionByName(empty.select("*", first.alias("sample_id"), F.lit(0).cast("bigint").alias("raw_count")))
    return complete_grid(present, reads, ["chrom", "start", "end"], ["raw_count"])


def bin_stats(bins: DataFrame, value: str = "raw_count") -> DataFrame:
    """Per sample: reads, bins, mean, sd, dispersion and five-number summary of the bin counts."""
    mean, sd = F.round(F.avg(value), 2), F.round(F.stddev(value), 2)
    q = lambda p: F.percentile(value, p)
    return bins.groupBy("sample_id").agg(
        F.sum(value).alias("reads"), F.count(F.lit(1)).alias("bins"), mean.alias("mean"), sd.alias("sd"),
        F.round(F.try_divide(sd, mean), 2).alias("dispersion"), F.min(value).alias("min"),
        q(0.25).alias("q25"), q(0.5).alias("median"), q(0.75).alias("q75"), F.max(value).alias("max"))


def normalize_bins(bins: DataFrame, value: str = "raw_count") -> DataFrame:
    """(x + 1) over the sample mean of x + 1, and its log2."""
    x = F.col(value) + 1
    scaled = bins.withColumn("normal", x / F.avg(x).over(W.partitionBy("sample_id")))
    return scaled.withColumn("log2_ratio", F.log2("normal"))


def _lowess(x: np.ndarray, y: np.ndarray, share: float, rounds: int = 3) -> np.ndarray:
    """Robust local linear fit at every x (tricube weights, bisquare reweighting)."""
    order = np.argsort(x, kind="stable")
    xs, ys = x[order], y[order]
    n = len(xs)
    k = max(2, min(n, int(share * n + 1e-7)))
    start = np.clip(np.arange(n) - k + 1, 0, n - k)
    for _ in range(k):  # slide each window, from the leftmost that holds its point, towards its nearest neighbours
        right = np.minimum(start + k, n - 1)
        move = (start + k < n) & (xs - xs[start] > xs[right] - xs)
        if not move.any():
            break
        start = start + move
    idx = start[:, None] + np.arange(k)[None, :]
    gap = np.abs(xs[idx] - xs[:, None])
    reach = np.maximum(gap.max(axis=1, keepdims=True), 1e-12)
    tricube = np.clip(1 - (gap / reach) ** 3, 0, None) ** 3 + 1e-12
    robust = np.ones(n)
    fit = ys.copy()
    for _ in range(rounds + 1):
        w = tricube * robust[idx]
        w = w / np.maximum(w.sum(axis=1, keepdims=True), 1e-300)
        xm, ym = (w * xs[idx]).sum(1), (w * ys[idx]).sum(1)
        dx = xs[idx] - xm[:, None]
        var = (w * dx * dx).sum(1)
        slope = np.where(var > 1e-12, (w * dx * ys[idx]).sum(1) / np.maximum(var, 1e-12), 0.0)
        fit = ym + slope * (xs - xm)
        spread = 6 * np.median(np.abs(ys - fit))
        if spread <= 1e-10 * max(1.0, np.abs(ys).max()):  # nothing but rounding is left
            break
        robust = np.clip(1 - ((ys - fit) / spread) ** 2, 0, None) ** 2
    out = np.empty(n)
    out[order] = fit
    return out


def gc_correct(bins: DataFrame, gc: DataFrame, share: float = 0.05, value: str = "raw_count") -> DataFrame:
    """Bin signal with its smooth dependence on GC removed, one sample's bins at a time."""
    return gc_correct_normal(normalize_bins(bins, value).join(gc, ["chrom", "bin_start"]), share)


def gc_correct_normal(bins: DataFrame, share: float = 0.05) -> DataFrame:
    """The same for bins that have ``normal`` and ``gc`` already."""
    joined = bins.select("sample_id", "chrom", "bin_start", "gc", "normal")

    def correct(pdf: pd.DataFrame) -> pd.DataFrame:
        log_y = np.log(pdf["normal"].to_numpy())
        smooth = _lowess(pdf["gc"].to_numpy(dtype=float), log_y, share)
        return pdf.assign(corrected=np.exp(log_y - smooth))

    return joined.groupBy("sample_id").applyInPandas(correct, "sample_id string, chrom string, bin_start long, gc double, normal double, corrected double")


def segment_medians(bins: DataFrame, value: str = "normal", segment: str = "segment") -> DataFrame:
    """Segment medians rescaled to a sample mean of 1."""
    med = F.percentile(value, 0.5).over(W.partitionBy("sample_id", segment))
    flat = bins.withColumn("_m", med)
    return flat.withColumn("fixed", F.col("_m") / F.avg("_m").over(W.partitionBy("sample_id"))).drop("_m")


def ploidy_grid(low: float = 1.5, high: float = 6.0, step: float = 0.05) -> list[float]:
    return [low + step * i for i in range(round((high - low) / step) + 1)]


def copy_number_grid(bins: DataFrame, value: str = "fixed", grid: Sequence[float] | None = None, given: DataFrame | None = None) -> DataFrame:
    """Multiplier that brings the bins nearest to whole numbers, and the rounded copy numbers.

    The squared distance of every grid multiplier is a partial aggregate. ``given``
    (``sample_id, ploidy``) overrides the choice for its samples. Equal errors take the
    smaller multiplier.
    """
    grid = list(grid or ploidy_grid())
    x = F.col(value)
    tried = bins.select("sample_id", x.alias("_x"), F.explode(F.array(*[F.lit(m) for m in grid])).alias("multiplier"))
    scaled = F.col("_x") * F.col("multiplier")
    errors = tried.groupBy("sample_id", "multiplier").agg(F.round(F.sum(F.pow(scaled - F.bround(scaled), 2)), 9).alias("error"))
    best = errors.groupBy("sample_id").agg(F.min(F.struct("error", "multiplier")).alias("b")).select(
        "sample_id", F.col("b.multiplier").alias("multiplier"), F.col("b.error").alias("error"))
    if given is not None:
        best = best.join(given.select("sample_id", F.col("ploidy").cast("double").alias("_g")), "sample_id", "left").withColumn(
            "multiplier", F.coalesce("_g", "multiplier")).drop("_g")
    return bins.join(best, "sample_id").withColumn("cn", F.bround(x * F.col("multiplier")).cast("int"))


def average_ploidy(bins: DataFrame) -> DataFrame:
    return bins.groupBy("sample_id").agg(F.avg("cn").alias("average_ploidy"))


def _genome_order(chrom: str = "chrom", start: str = "bin_start") -> list[Column]:
    return [*natural_chromosome_key(chrom), F.col(start).asc()]


def adjacent_differences(bins: DataFrame, value: str = "y") -> DataFrame:
    """Absolute step to the previous bin of the chromosome, plain and log2; NULL at chromosome starts."""
    before = F.lag(value).over(W.partitionBy("sample_id", "chrom").orderBy("bin_start"))
    return bins.withColumns({
        "diff": F.abs(F.col(value) - before),
        "diff_log2": F.abs(F.log2(F.col(value)) - F.log2(before)),
    })


def change_count(bins: DataFrame, value: str = "cn") -> DataFrame:
    """Copy-number changes along the whole genome, chromosome borders included."""
    before = F.lag(value).over(W.partitionBy("sample_id").orderBy(*_genome_order()))
    return bins.withColumn("_c", F.col(value) != before).groupBy("sample_id").agg(F.count_if("_c").alias("n_segments"))


def rebin_blocks(bins: DataFrame, size: int) -> DataFrame:
    """Block number of every distinct bin: bins join a block until their bases reach ``size``."""
    distinct = bins.select("chrom", "bin_start", "bin_end").distinct()

    def number(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("bin_start", ignore_index=True)
        blocks, total, block = [], 0, 1
        for bases in (pdf["bin_end"] - pdf["bin_start"]).to_numpy():
            total += bases
            if total >= size:
                block, total = block + 1, bases
            blocks.append(block)
        return pdf.assign(block=blocks)

    return distinct.groupBy("chrom").applyInPandas(number, "chrom string, bin_start long, bin_end long, block int")


def rebin(bins: DataFrame, size: int, mean: Sequence[str] = ("normal",), median: Sequence[str] = ("cn",)) -> DataFrame:
    """Bins merged into blocks of about ``size`` bases, with block means and medians."""
    blocks = rebin_blocks(bins, size)
    joined = bins.join(blocks, ["chrom", "bin_start", "bin_end"])
    return joined.groupBy("sample_id", "chrom", "block").agg(
        F.min("bin_start").alias("bin_start"), F.max("bin_end").alias("bin_end"),
        *[F.avg(c).alias(c) for c in mean], *[F.median(c).alias(c) for c in median]).drop("block")


def mad(df: DataFrame, value: str, by: Sequence[str], out: str = "mad") -> DataFrame:
    """1.4826 x median absolute deviation per group."""
    by = list(by)
    centred = df.withColumn("_d", F.abs(F.col(value) - F.percentile(value, 0.5).over(W.partitionBy(*by))))
    return centred.groupBy(*by).agg((F.percentile("_d", 0.5) * MAD_SCALE).alias(out))


def weighted_mad(df: DataFrame, value: str = "y", level: str = "cn") -> DataFrame:
    """Mean of per-copy-number MADs weighted by bins; levels with a single bin are pooled into one."""
    n = F.count(F.lit(1)).over(W.partitionBy("sample_id", level))
    pooled = df.withColumn("_level", F.when(n == 1, POOLED).otherwise(F.col(level)))
    sizes = pooled.groupBy("sample_id", "_level").agg(F.count(F.lit(1)).alias("_n"))
    mads = mad(pooled, value, ["sample_id", "_level"], "_mad").join(sizes, ["sample_id", "_level"])
    return mads.groupBy("sample_id").agg((F.sum(F.col("_mad") * F.col("_n")) / F.sum("_n")).alias("mad_aware"))


def skewness(bins: DataFrame) -> DataFrame:
    """1 - weighted balance of bins above and below their copy number, over levels having both."""
    sides = bins.groupBy("sample_id", "cn").agg(F.count_if(F.col("y") >= F.col("cn")).alias("u"), F.count_if(F.col("y") < F.col("cn")).alias("d"))
    both = sides.filter("u > 0 AND d > 0").select("sample_id", (F.col("u") + F.col("d")).alias("w"), (F.least("u", "d") / F.greatest("u", "d")).alias("r"))
    return both.groupBy("sample_id").agg((1 - F.sum(F.col("w") * F.col("r")) / F.sum("w")).alias("skew_cnv"))


def cnv_summary_metrics(bins: DataFrame, rebin_size: int = 5_000_000) -> DataFrame:
    """Segment counts, noise, step and skew measures per sample.

    ``bins`` needs ``sample_id, chrom, bin_start, bin_end, normal, multiplier, cn``; the
    signal is ``normal * multiplier``.
    """
    df = bins.withColumn("y", F.col("normal") * F.col("multiplier"))
    off = F.abs(F.col("y") - F.col("cn"))
    naive = F.abs(2 - F.col("y"))
    diploid = F.when(F.col("cn") == 2, off)
    steps = lambda d, suffix: adjacent_differences(d).groupBy("sample_id").agg(
        F.median("diff").alias(f"mapd{suffix}"), F.median("diff_log2").alias(f"mapd_log2{suffix}"))
    coarse = rebin(df, rebin_size, mean=("normal", "multiplier"), median=("cn",)).withColumn("y", F.col("normal") * F.col("multiplier"))
    base = df.groupBy("sample_id").agg(
        F.max("multiplier").alias("genome_ploidy"),
        F.round(100.0 * F.count_if(F.col("cn").isin(1, 2, 3)) / F.count(F.lit(1)), 3).alias("pct_cn_123"),
        F.avg(naive).alias("noise_naive_mean"), F.avg(off).alias("noise_cn_aware_mean"), F.avg(diploid).alias("noise_two_mean"),
        F.median(naive).alias("noise_naive_median"), F.median(off).alias("noise_cn_aware_median"), F.median(diploid).alias("noise_two_median"))
    for part in (change_count(df), mad(df, "y", ["sample_id"], "mad_traditional"), weighted_mad(df), steps(df, ""), steps(coarse, "_rebin"), skewness(df)):
        base = base.join(part, "sample_id", "left")
    return base


def cnv_segments(bins: DataFrame) -> DataFrame:
    """Runs of equal copy number other than two: start, end, copy number and AMP / DEL."""
    order = W.partitionBy("sample_id", "chrom").orderBy("bin_start")
    new_run = F.coalesce(F.col("cn") != F.lag("cn").over(order), F.lit(True)).cast("int")
    runs = bins.withColumn("_n", new_run).withColumn("_run", F.sum("_n").over(order.rowsBetween(W.unboundedPreceding, 0)))
    merged = runs.groupBy("sample_id", "chrom", "_run", "cn").agg(
        F.min("bin_start").alias("start"), F.max("bin_end").alias("end"), F.count(F.lit(1)).alias("n_bins"))
    return merged.filter("cn <> 2").drop("_run").withColumn("kind", F.when(F.col("cn") > 2, "AMP").otherwise("DEL"))
