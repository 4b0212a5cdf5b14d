"""Read-level QC: duplicates, yield, depth profiles, insert sizes, score tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from somaloom.functions.ranks import exact_quantiles
from somaloom.operators.joins import assign_intervals

DEPTH_CAP = 250
_NO_QUALITY = -(10**10)  # stands before the negative of any quality
_ID_FIRST, _ID_SPAN = "9223372036854775809BD", "100000000000000000000BD"  # ids from 1, NULL as 0
DEPTH_LEVELS = (1, 5, 10, 15, 20, 25, 30, 40, 50, 60, 70, 80, 90, 100)


def _ratio(a: Column, b: Column, empty=0.0) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(empty))


def read_rank(reads: DataFrame, quality: str, read_id: str) -> Column:
    """Order of reads, the best smallest: high quality first, then the small id, NULLs before all others.

    Whole numbers become one decimal, whose minimum is aggregated by hashing; other types stay a struct, which is sorted.
    """
    small = ["tinyint", "smallint", "int"]
    kind = lambda name: reads.select(name).schema[0].dataType.simpleString()
    if kind(quality) not in small or kind(read_id) not in [*small, "bigint"]:
        return F.struct((-F.col(quality)).alias("q"), F.col(read_id).alias("r"))
    q = F.coalesce(-F.col(quality).cast("decimal(11,0)"), F.lit(_NO_QUALITY).cast("decimal(11,0)"))
    r = F.coalesce(F.col(read_id).cast("decimal(20,0)") + F.expr(_ID_FIRST), F.lit(0).cast("decimal(21,0)"))
    return q * F.expr(_ID_SPAN) + r


def _rank_parts(rank: Column, packed: bool) -> tuple[Column, Column]:
    """The negative quality and the id that a rank was made of."""
    if not packed:
        return rank["q"], rank["r"]
    r = F.pmod(rank, F.expr(_ID_SPAN))
    q = F.try_divide(rank - r, F.expr(_ID_SPAN)).cast("bigint")
    return F.when(q != _NO_QUALITY, q), F.when(r != 0, (r - F.expr(_ID_FIRST)).cast("bigint"))


def mark_duplicates(reads: DataFrame, keys: Sequence[str] = ("sample_id", "chrom", "pos", "strand"),
                    quality: str = "sum_bq", read_id: str = "read_id") -> DataFrame:
    """Flag all but the best read of each copy group (same library, position, strand and mate).

    The best read is found by an aggregate, which combines map-side, and joined back;
    a group holding very many copies is split by the adaptive skew join, not sorted in one task.
    A read with a NULL key (unmapped) is no copy of another.
    """
    keys = list(keys)
    whole = reads.dropna(subset=keys)
    best = whole.groupBy(*keys).agg(F.min(read_rank(reads, quality, read_id)).alias("_best"))
    q, r = _rank_parts(F.col("_best"), best.schema["_best"].dataType.typeName() == "decimal")
    flagged = whole.join(best.select(*keys, q.alias("_q"), r.alias("_r")), keys)
    kept = (F.col(read_id) == F.col("_r")) & (-F.col(quality) == F.col("_q"))
    flagged = flagged.withColumn("is_duplicate", ~kept).drop("_q", "_r")
    unkeyed = reads.filter(" OR ".join(f"`{k}` IS NULL" for k in keys)).withColumn("is_duplicate", F.lit(False))
    return flagged.unionByName(unkeyed.select(*flagged.columns))


def quality_yield(reads: DataFrame, by: str = "sample_id", bq: str = "bq") -> DataFrame:
    """Bases and their Q20 / Q30 share."""
    n = F.count(bq)
    return reads.groupBy(by).agg(n.alias("total_bases"), _ratio(F.count_if(F.col(bq) >= 20), n).alias("q20_rate"),
                                 _ratio(F.count_if(F.col(bq) >= 30), n).alias("q30_rate"))


def dup_metrics(counts: DataFrame) -> DataFrame:
    """Duplication rates from read counts; pair counts are half the paired reads.

    Columns in: ``paired_reads, dup_pair_reads, optical_pair_reads, single_reads, dup_single_reads``.
    """
    half = lambda c: F.floor(F.col(c) / 2)
    pairs, dups, optical = half("paired_reads"), half("dup_pair_reads"), half("optical_pair_reads")
    return counts.withColumns({
        "read_pairs_examined": pairs, "read_pair_duplicates": dups, "read_pair_optical_duplicates": optical,
        "pct_duplication": F.round(_ratio(dups + F.col("dup_single_reads"), pairs + F.col("single_reads")), 6),
        "pct_optical_duplicates": _ratio(optical, pairs), "pct_pcr_duplicates": _ratio(dups - optical, pairs),
    })


def flag_duplication(flags: DataFrame) -> DataFrame:
    """Duplication from flag counts: duplicates over mapped reads, over primary reads when none is mapped."""
    base = F.when(F.col("mapped") > 0, F.col("mapped")).otherwise(F.col("primary"))
    return flags.withColumn("pct_duplication", _ratio(F.col("duplicates"), base))


def align_ratios(counts: DataFrame) -> DataFrame:
    """Aligned and passing-filter share of all reads; 0 without reads."""
    total = F.col("total_reads")
    return counts.withColumns({"pct_aligned": _ratio(F.col("aligned_reads"), total), "pct_pf": _ratio(F.col("pf_reads"), total)})


def insert_size_stats(pairs: DataFrame, by: str = "sample_id", size: str = "insert_size") -> DataFrame:
    """Median, MAD, mean, sd, min, max and count of whole-number insert sizes, from their histogram."""
    x, c = F.col(size), F.col("c")
    hist = pairs.groupBy(by, size).agg(F.count(F.lit(1)).alias("c"))
    n, s1, s2 = F.sum(c), F.sum(c * x), F.sum(c * x * x)
    base = hist.groupBy(by).agg(
        F.percentile(x, 0.5, c).alias("insert_median"), (s1 / n).alias("insert_mean"),
        F.when(n > 1, F.sqrt(F.try_divide((n * s2 - s1 * s1).cast("double"), (n * (n - 1)).cast("double")))).alias("insert_std"),
        F.min(x).alias("insert_min"), F.max(x).alias("insert_max"), n.alias("insert_read_pairs"))
    mad = hist.join(base.select(by, "insert_median"), by).groupBy(by).agg(
        F.percentile(F.abs(x - F.col("insert_median")), 0.5, c).alias("insert_mad"))
    return base.join(mad, by)


def chrom_coverage(depth: DataFrame) -> DataFrame:
    """Summed depth, mean depth and share of positions at 15x or more, per chromosome."""
    n = F.count(F.lit(1))
    return depth.groupBy("sample_id", "chrom").agg(
        F.sum("depth").alias("total_coverage"), F.avg("depth").alias("average_coverage"),
        (100 * _ratio(F.count_if(F.col("depth") >= 15), n)).alias("pct_above_15"))


def mitochondrial_share(by_chrom: DataFrame, names: Sequence[str] = ("chrM", "MT")) -> DataFrame:
    """Covered bases and the mitochondrial share, over all rows of the chromosome table."""
    total = F.sum("total_coverage")
    mito = F.sum(F.when(F.col("chrom").isin(*names), F.col("total_coverage")).otherwise(0))
    return by_chrom.groupBy("sample_id").agg(total.alias("cov_total_bases"), mito.alias("cov_chrm_bases"), _ratio(mito, total).alias("pct_chrm"))


def aligned_blocks(reads: DataFrame, pos: str = "pos", cigar: str = "cigar") -> DataFrame:
    """One row per stretch of aligned bases (``start``, ``end``, closed) of each read: M, = and X of its CIGAR; D and N move on without bases."""
    ops = F.regexp_extract_all(cigar, F.lit("([0-9]+)([MIDNSHP=X])"), F.lit(2))
    sizes = F.transform(F.regexp_extract_all(cigar, F.lit("([0-9]+)([MIDNSHP=X])"), F.lit(1)), lambda n: n.cast("bigint"))
    steps = F.zip_with(ops, sizes, lambda o, n: F.struct(o.alias("o"), n.alias("n")))
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")

    def step(acc, x):
        at, moves, bases = acc["at"], x["o"].isin("M", "=", "X", "D", "N"), x["o"].isin("M", "=", "X")
        block = F.struct(at.alias("start"), (at + x["n"] - 1).alias("end"))
        return F.struct((at + F.when(moves, x["n"]).otherwise(0)).alias("at"), F.when(bases & (x["n"] > 0), F.concat(acc["found"], F.array(block))).otherwise(acc["found"]).alias("found"))

    found = F.aggregate(steps, F.struct(F.col(pos).cast("bigint").alias("at"), none.alias("found")), step)["found"]
    return reads.withColumn("_b", F.explode(found)).withColumns({"start": F.col("_b.start"), "end": F.col("_b.end")}).drop("_b")


def depth_runs(blocks: DataFrame, by: Sequence[str] = ("sample_id", "chrom"), span: int = 1 << 20) -> DataFrame:
    """Runs of equal positive depth (``start``, ``end``, ``depth``) from aligned blocks, by a sweep over their ends.

    A block is +1 at its start and -1 behind its end; equal places are summed before they move. Stretches of ``span`` bases are summed
    each in its own task and carry in the sum of all stretches before, so that no chromosome is one task. Rows follow the blocks, never the bases.
    """
    by = list(by)
    events = blocks.select(*by, F.explode(F.array(
        F.struct(F.col("start").cast("bigint").alias("pos"), F.lit(1).alias("step")), F.struct((F.col("end").cast("bigint") + 1).alias("pos"), F.lit(-1).alias("step")))).alias("_e"))
    steps = events.groupBy(*by, F.col("_e.pos").alias("pos")).agg(F.sum("_e.step").alias("step")).filter("step <> 0").withColumn("_part", F.floor(F.col("pos") / span))
    parts = steps.groupBy(*by, "_part").agg(F.sum("step").alias("_sum"), F.min("pos").alias("_first"))
    order = W.partitionBy(*by).orderBy("_part")  # a row a stretch
    carried = parts.select(*by, "_part", F.coalesce(F.sum("_sum").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_before"), F.lead("_first").over(order).alias("_next"))
    inside = W.partitionBy(*by, "_part").orderBy("pos")
    swept = steps.withColumns({"_inside": F.sum("step").over(inside), "_to": F.lead("pos").over(inside)}).join(carried, [*by, "_part"])
    runs = swept.select(*by, F.col("pos").alias("start"), (F.coalesce("_to", "_next") - 1).alias("end"), (F.col("_before") + F.col("_inside")).alias("depth"))
    return runs.filter("depth > 0")


def _depth_histogram(depth: DataFrame, territory: int, cap: int) -> DataFrame:
    """Positions per (sample, capped depth), with the uncovered rest of the territory as depth 0. Rows are positions, or runs with ``start`` and ``end``."""
    size = F.col("end") - F.col("start") + 1 if {"start", "end"} <= set(depth.columns) else F.lit(1)
    hist = depth.groupBy("sample_id", F.least("depth", F.lit(cap)).alias("d")).agg(F.sum(size).alias("c"))
    zero = hist.filter("d > 0").groupBy("sample_id").agg((F.lit(territory) - F.sum("c")).alias("c")).select("sample_id", F.lit(0).cast("bigint").alias("d"), "c")
    return hist.filter("d > 0").unionByName(zero)


def coverage_profile(depth: DataFrame, territory: int, cap: int = DEPTH_CAP, levels: Sequence[int] = DEPTH_LEVELS) -> DataFrame:
    """Depth statistics over a territory, uncovered positions counting as 0.

    Works on the depth histogram, at most ``cap`` + 1 rows per sample.
    """
    hist = _depth_histogram(depth, territory, cap)
    d, c = F.col("d"), F.col("c")
    n, s1, s2 = F.sum(c), F.sum(c * d), F.sum(c * d * d)
    base = hist.groupBy("sample_id").agg(
        (s1 / n).alias("mean_coverage"),
        F.sqrt(F.try_divide((n * s2 - s1 * s1).cast("double"), (n * (n - 1)).cast("double"))).alias("sd_coverage"),
        F.percentile(d, 0.5, c).alias("median_coverage"),
        *[(F.sum(F.when(d >= level, c).otherwise(0)) / n).alias(f"pct_{level}x") for level in levels])
    mad = hist.join(base.select("sample_id", "median_coverage"), "sample_id").groupBy("sample_id").agg(
        F.percentile(F.abs(d - F.col("median_coverage")), 0.5, c).alias("mad_coverage"))
    return base.join(mad, "sample_id")


def target_coverage(depth: DataFrame, targets: DataFrame, levels: Sequence[int] = (1, 10, 20, 30), near: int = 250, width: int = 1000) -> DataFrame:
    """Capture metrics per sample over disjoint closed target intervals.

    Mean depth and depth shares run over all target bases; fold-80 is the mean over the
    20th percentile of the covered bases. Bases outside are near (within ``near``) or off.
    """
    size = targets.agg(F.sum(F.col("end") - F.col("start") + 1)).scalar()
    n_targets = targets.agg(F.count(F.lit(1))).scalar()
    on = assign_intervals(depth, targets, width)
    hist = on.groupBy("sample_id", "depth").agg(F.count(F.lit(1)).alias("c"))
    d, c = F.col("depth"), F.col("c")
    stats = hist.groupBy("sample_id").agg(
        F.sum(d * c).alias("on_target_bases"), F.percentile(d, 0.2, c).alias("p20"),
        *[F.sum(F.when(d >= level, c).otherwise(0)).alias(f"n_{level}x") for level in levels])
    touched = on.groupBy("sample_id").agg(F.count_distinct("target").alias("hit"))
    padded = targets.select("chrom", (F.col("start") - near).alias("start"), (F.col("end") + near).alias("end"))
    around = assign_intervals(depth, padded, width + 2 * near).select("sample_id", "chrom", "pos", "depth").distinct()
    totals = depth.groupBy("sample_id").agg(F.sum("depth").alias("all_bases"))
    near_sum = around.groupBy("sample_id").agg(F.sum("depth").alias("near_or_on"))
    out = totals.join(stats, "sample_id", "left").join(touched, "sample_id", "left").join(near_sum, "sample_id", "left")
    zero = lambda name: F.coalesce(F.col(name), F.lit(0))
    mean = zero("on_target_bases") / size
    return out.select(
        "sample_id", mean.alias("mean_target_coverage"), (1 - zero("hit") / n_targets).alias("zero_cvg_targets_pct"),
        *[(zero(f"n_{level}x") / size).alias(f"pct_target_bases_{level}x") for level in levels],
        F.try_divide(mean, F.col("p20")).alias("fold_80_base_penalty"),
        _ratio(zero("on_target_bases"), F.col("all_bases")).alias("pct_on_target"),
        _ratio(zero("near_or_on") - zero("on_target_bases"), F.col("all_bases")).alias("pct_near_target"),
        _ratio(F.col("all_bases") - zero("near_or_on"), F.col("all_bases")).alias("pct_off_target"))


def score_distribution(scored: DataFrame, score: str = "qc_score") -> DataFrame:
    """Samples and share of samples per score."""
    counts = scored.groupBy(score).agg(F.count(F.lit(1)).alias("n"))
    total = scored.agg(F.count(F.lit(1))).scalar()
    return counts.withColumn("pct", F.round(100 * F.col("n") / total, 6))


def score_by_group(scored: DataFrame, scores: Sequence[int], group: str = "grp", score: str = "qc_score") -> DataFrame:
    """Samples per group (rows) and score (columns)."""
    wide = scored.groupBy(group).pivot(score, list(scores)).count().na.fill(0)
    return wide.select(group, *[F.col(str(s)).alias(f"score_{s}") for s in scores])


def score_quantiles(scored: DataFrame, metrics: Sequence[str], score: str = "qc_score") -> DataFrame:
    """Five-number summary of each metric per score, exact at any number of samples."""
    probs = {"p0": 0.0, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p100": 1.0}
    long = scored.unpivot([score], [F.col(m).cast("double").alias(m) for m in metrics], "metric", "value")
    return exact_quantiles(long, "value", probs, by=["metric", score])
