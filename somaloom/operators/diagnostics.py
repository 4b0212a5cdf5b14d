"""Threshold sweeps, depth funnels, sparsity summaries and two-dimensional bin counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from somaloom.functions.ranks import exact_quantiles
from somaloom.functions.variants import nr_bin, vaf, vaf_decile

# fixed values: candidate call gates (VAF, depth, reads)
CALL_GATES = {"VAF>=0.10 NR>=5 NV>=2": (0.10, 5, 2), "VAF>=0.20 NR>=5 NV>=2": (0.20, 5, 2), "VAF>=0.30 NR>=10 NV>=3": (0.30, 10, 3)}


def depth_funnel(counts: DataFrame, depths: Sequence[int], min_pct: float = 50) -> tuple[DataFrame, DataFrame]:
    """Variants with support, per minimum depth: for the cohort and per cell (zeros kept).

    A depth counts for a variant when ``min_pct`` percent of the cells reach it. The depths
    a variant meets are found in one aggregate; only supported cells are then unpacked.
    """
    share = lambda d: F.avg((F.col("nr") >= d).cast("double"))
    met = counts.groupBy("variant_id").agg(
        F.filter(F.array(*[F.when(share(d) >= min_pct / 100, F.lit(d)) for d in depths]), lambda d: d.isNotNull()).alias("_d"),
        F.max("nv").alias("_nv"))
    levels = F.explode(F.array(*[F.lit(d) for d in depths])).alias("min_depth")
    cohort = met.filter("_nv > 0").select(F.explode("_d").alias("min_depth")).groupBy("min_depth").agg(F.count(F.lit(1)).alias("n"))
    frame = counts.sparkSession.range(1).select(levels)
    cohort = frame.join(cohort, "min_depth", "left").select("min_depth", F.coalesce("n", F.lit(0)).alias("n_variants"))
    cells = counts.filter("nv > 0").join(met.select("variant_id", "_d"), "variant_id").select("sample_id", F.explode("_d").alias("min_depth"))
    found = cells.groupBy("sample_id", "min_depth").agg(F.count(F.lit(1)).alias("n"))
    grid = counts.select("sample_id").distinct().select("sample_id", levels)
    per_cell = grid.join(found, ["sample_id", "min_depth"], "left").select("sample_id", "min_depth", F.coalesce("n", F.lit(0)).alias("n_variants"))
    return cohort, per_cell


def depth_funnel_spread(per_cell: DataFrame) -> DataFrame:
    """Quartiles and mean over cells per minimum depth (whole-number counts)."""
    q = lambda p: F.percentile("n_variants", p)
    return per_cell.groupBy("min_depth").agg(q(0.25).alias("q25"), q(0.5).alias("median"), q(0.75).alias("q75"), F.avg("n_variants").alias("mean"), F.count(F.lit(1)).alias("n_cells"))


def vaf_sparsity(counts: DataFrame) -> DataFrame:
    """Mean and largest VAF over supported cells, share and number of them, depth at the largest VAF.

    Cells within 1e-10 of the largest VAF tie; the deepest of them gives the depth.
    """
    x = F.col("nv") / F.greatest("nr", F.lit(1))
    seen = F.col("nv") > 0
    top = F.max(F.when(seen, F.struct(F.round(x, 10).alias("x"), F.col("nr"))))
    return counts.groupBy("variant_id").agg(
        F.avg(F.when(seen, x)).alias("mean_vaf"), F.max(F.when(seen, x)).alias("max_vaf"),
        F.avg(seen.cast("double")).alias("prop_cells"), F.count_if(seen).alias("n_cells"), top.getField("nr").alias("depth_at_max"),
    ).filter("n_cells > 0")


def sparsity_summary(sparsity: DataFrame) -> DataFrame:
    """Fifteen summary metrics of :func:`vaf_sparsity` as ``(metric, value)`` rows."""
    p, m = F.col("prop_cells"), F.col("mean_vaf")
    pct = lambda cond: F.avg(cond.cast("double")) * 100
    shares = sparsity.agg(
        F.count(F.lit(1)).cast("double").alias("n_variants_rows"), pct(p <= 0).alias("pct_prop_cells_0"), pct((p > 0) & (p <= 0.05)).alias("pct_prop_cells_to_0.05"),
        pct((p > 0.05) & (p <= 0.10)).alias("pct_prop_cells_to_0.10"), pct(p > 0.10).alias("pct_prop_cells_above_0.10"), pct(m <= 0).alias("pct_mean_vaf_0"),
        pct((m > 0) & (m < 0.01)).alias("pct_mean_vaf_below_0.01"), pct((m >= 0.01) & (m < 0.05)).alias("pct_mean_vaf_below_0.05"), pct(m >= 0.05).alias("pct_mean_vaf_from_0.05"))
    long = shares.unpivot([], [f"`{c}`" for c in shares.columns], "metric", "value")
    values = sparsity.unpivot([], ["prop_cells", "mean_vaf", "max_vaf"], "name", "value")
    q = exact_quantiles(values, "value", {"median": 0.5, "q90": 0.9}, by=["name"]).unpivot(["name"], ["median", "q90"], "kind", "value")
    return long.unionByName(q.select(F.concat_ws("_", "kind", "name").alias("metric"), "value"))


def pooled_vaf(counts: DataFrame, threshold: float = 0.1) -> DataFrame:
    """Cohort VAF of the pooled reads and the share of covered cells above ``threshold``."""
    covered = F.col("nr") > 0
    carries = covered & (F.col("nv") > F.col("nr") * threshold)
    return counts.groupBy("variant_id").agg(
        (F.sum("nv") / F.greatest(F.sum("nr"), F.lit(1))).alias("pooled_vaf"),
        (F.count_if(carries) / F.greatest(F.count_if(covered), F.lit(1))).alias("cell_fraction"))


def _bin(x: Column, low: float, high: float, n: int) -> Column:
    return F.least(F.greatest(F.floor((x - low) / (high - low) * n), F.lit(0)), F.lit(n - 1)).cast("int")


def hist2d(df: DataFrame, x: str, y: str, x_range: Sequence[float], y_range: Sequence[float], nx: int = 50, ny: int = 50) -> DataFrame:
    """Counts on a rectangular grid. Rows outside the x range are left out, y is squeezed into its range."""
    inside = df.filter(F.col(x).between(x_range[0], x_range[1]) & F.col(y).isNotNull())
    return inside.groupBy(_bin(F.col(x), *x_range, nx).alias("x_bin"), _bin(F.col(y), *y_range, ny).alias("y_bin")).agg(F.count(F.lit(1)).alias("n"))


def threshold_sweep(df: DataFrame, value: str, steps: int = 200, upper: float = 0.995, direction: str = ">=") -> DataFrame:
    """Share of rows passing at ``steps`` thresholds from the minimum to the ``upper`` quantile.

    Each row is counted under the highest threshold it reaches, and the counts are summed
    over the thresholds: the data are read once however many thresholds there are.
    """
    known = df.filter(F.col(value).isNotNull()).select(F.col(value).cast("double").alias("v"))
    q = exact_quantiles(known, "v", {"low": 0.0, "high": upper})
    bounds = q.select(F.struct("low", "high")).scalar()
    grid_at = lambda b, i: b.getField("low") + i * (b.getField("high") - b.getField("low")) / (steps - 1)
    grid = known.sparkSession.range(steps).withColumn("_b", bounds).select(F.col("id").cast("int").alias("step"), grid_at(F.col("_b"), F.col("id")).alias("threshold"))
    near = known.withColumn("_b", bounds).withColumn("_w", (F.col("_b.high") - F.col("_b.low")) / (steps - 1))
    guess = F.floor(F.try_divide(F.col("v") - F.col("_b.low"), F.col("_w")))
    guess = F.least(F.greatest(F.coalesce(guess, F.lit(steps - 1)), F.lit(0)), F.lit(steps - 1))
    near = near.withColumn("_i", guess)
    reach = (F.when((F.col("_i") < steps - 1) & (grid_at(F.col("_b"), F.col("_i") + 1) <= F.col("v")), F.col("_i") + 1)
             .when(grid_at(F.col("_b"), F.col("_i")) > F.col("v"), F.col("_i") - 1).otherwise(F.col("_i")))
    counted = near.groupBy(reach.cast("int").alias("step")).agg(F.count(F.lit(1)).alias("c"))
    total = known.agg(F.count(F.lit(1))).scalar()
    down = W.orderBy(F.desc("step")).rowsBetween(W.unboundedPreceding, 0)  # at most ``steps`` rows
    share = F.coalesce(F.sum("c").over(down), F.lit(0)) / total
    share = share if direction == ">=" else 1 - share
    return grid.join(counted, "step", "left").select("step", "threshold", share.alias("pass_fraction"))


def pass_rates(flagged: DataFrame, flags: Sequence[str] = ("as_pass", "clip_pass", "bppos_pass")) -> DataFrame:
    """Pass share of each filter and of all together, over supported alternate rows."""
    every = F.lit(True)
    for f in flags:
        every = every & F.col(f)
    rates = flagged.agg(*[F.avg(F.col(f).cast("double")).alias(f) for f in flags], F.avg(every.cast("double")).alias("all"), F.count(F.lit(1)).alias("n"))
    return rates.unpivot(["n"], [*flags, "all"], "filter", "pass_rate")


def binary_threshold_combos(counts: DataFrame, gates: dict[str, tuple[float, int, int]] = CALL_GATES) -> DataFrame:
    """How many variants have how many called cells, under each candidate gate."""
    x = vaf(digits=None)
    hit = lambda g: F.count_if((x >= g[0]) & (F.col("nr") >= g[1]) & (F.col("nv") >= g[2]))
    per = counts.groupBy("variant_id").agg(*[hit(g).alias(f"g{i}") for i, g in enumerate(gates.values())])
    pairs = F.array(*[F.struct(F.lit(name).alias("combo"), F.col(f"g{i}").alias("n_called")) for i, name in enumerate(gates)])
    return per.select(F.explode(pairs).alias("p")).select("p.*").groupBy("combo", "n_called").agg(F.count(F.lit(1)).alias("n_variants"))


def depth_support_profile(counts: DataFrame) -> DataFrame:
    """Median and 99th percentile of covered depth and of supporting reads (whole numbers)."""
    nr, nv = F.when(F.col("nr") > 0, F.col("nr")), F.when(F.col("nv") > 0, F.col("nv"))
    q = lambda x, p: F.percentile(x, p)
    return counts.agg(q(nr, 0.5).alias("nr_median"), q(nr, 0.99).alias("nr_p99"), q(nv, 0.5).alias("nv_median"), q(nv, 0.99).alias("nv_p99"))


def vaf_histogram(counts: DataFrame) -> DataFrame:
    """Covered entries per depth class and VAF decile."""
    return counts.filter("nr > 0").groupBy(nr_bin().alias("nr_class"), vaf_decile(vaf()).alias("decile")).agg(F.count(F.lit(1)).alias("n"))
