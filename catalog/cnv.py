"""Copy-number bins, segments and noise measures."""

from pyspark.sql import functions as F

from catalog.base import VIEWS, Data, query
from catalog.counts import r6, rounded
from somaloom.functions import quality as Q
from somaloom.operators import cnv as V

VIEWS["nbins"] = """
SELECT *, bin_start + 1000000 AS bin_end, CAST(raw_count + 1 AS DOUBLE) / avg(raw_count + 1) OVER (PARTITION BY sample_id) AS normal,
       concat(chrom, '_', CAST(CAST(floor(bin_start / 13000000) AS BIGINT) AS STRING)) AS segment FROM {bins}"""
VIEWS["fixed"] = """
SELECT *, md / avg(md) OVER (PARTITION BY sample_id) AS fixed FROM (SELECT *, median(normal) OVER (PARTITION BY sample_id, segment) AS md FROM {nbins})"""
VIEWS["grid"] = """
SELECT sample_id, arg_min(m, struct_pack(e := e, m := m)) AS multiplier, min(e) AS error FROM (SELECT sample_id, m, round(sum(pow(fixed * m - round_even(fixed * m, 0), 2)), 9) AS e
FROM {fixed} CROSS JOIN (SELECT CAST(1.5 AS DOUBLE) + CAST(0.05 AS DOUBLE) * i AS m FROM range(0, 91) r(i)) GROUP BY 1, 2) GROUP BY 1"""
VIEWS["cnbins"] = """
SELECT f.*, g.multiplier, g.error, CAST(round_even(fixed * multiplier, 0) AS INT) AS cn, normal * multiplier AS y,
       CAST(substr(chrom, 4) AS INT) AS chrom_no FROM {fixed} f JOIN {grid} g USING (sample_id)"""


def nbins(d: Data):
    n = V.normalize_bins(d.bins).withColumn("bin_end", F.col("bin_start") + 1000000)
    return n.withColumn("segment", F.concat_ws("_", "chrom", F.floor(F.col("bin_start") / 13000000)))


def cnbins(d: Data):
    return V.copy_number_grid(V.segment_medians(nbins(d)))


def y(d: Data):
    return cnbins(d).withColumn("y", F.col("normal") * F.col("multiplier"))


@query("bin_counts", """
SELECT b.chrom, b.start, b.end_pos AS "end", s.sample_id, coalesce(c.n, 0) AS raw_count
FROM (SELECT DISTINCT chrom, (pos // 500) * 500 AS start, (pos // 500) * 500 + 499 AS end_pos FROM {sites} UNION ALL SELECT 'chr1', 9000000, 9000499 FROM {region} WHERE r_regionkey = 0) b CROSS JOIN {samples} s
LEFT JOIN (SELECT sample_id, chrom, (pos // 500) * 500 AS start, count(*) AS n FROM {obs} GROUP BY 1, 2, 3) c ON c.sample_id = s.sample_id AND c.chrom = b.chrom AND c.start = b.start""")
def bin_counts(d):
    bins = d.sites.selectExpr("chrom", "(pos div 500) * 500 AS start", "(pos div 500) * 500 + 499 AS end").distinct()
    bins = bins.unionAll(d.region.filter("r_regionkey = 0").selectExpr("'chr1' AS chrom", "9000000L AS start", "9000499L AS end"))
    return V.bin_counts(d.obs.select("sample_id", "chrom", "pos"), bins, width=500)


@query("bin_stats", """
SELECT sample_id, CAST(sum(raw_count) AS BIGINT) AS reads, count(*) AS bins, round(avg(raw_count), 2) AS mean, round(stddev_samp(raw_count), 2) AS sd,
       round(round(stddev_samp(raw_count), 2) / round(avg(raw_count), 2), 2) AS dispersion, min(raw_count) AS min, quantile_cont(raw_count, 0.25) AS q25,
       quantile_cont(raw_count, 0.5) AS median, quantile_cont(raw_count, 0.75) AS q75, max(raw_count) AS max FROM {bins} GROUP BY 1""")
def bin_stats(d):
    return V.bin_stats(d.bins)


@query("normalize_bins", "SELECT sample_id, chrom, bin_start, round(normal, 6) AS normal, round(log2(normal), 6) AS log2_ratio FROM {nbins}")
def normalize_bins(d):
    return rounded(V.normalize_bins(d.bins).select("sample_id", "chrom", "bin_start", "normal", "log2_ratio"), "normal", "log2_ratio")


@query("gc_correct")
def gc_correct(d):
    gc = d.bins.select("chrom", "bin_start").distinct().withColumn("gc", 0.3 + F.pmod(F.col("bin_start") / 1000000 * 7, F.lit(31)) / 100)
    return V.gc_correct(d.bins, gc)


@query("gc_correct_linear", """
SELECT sample_id, chrom, bin_start, round(gc, 6) AS gc, CAST(1.0 AS DOUBLE) AS corrected
FROM (SELECT *, 0.3 + CAST((bin_start // 1000000 * 7 + raw_count) % 31 AS DOUBLE) / 100 AS gc FROM {bins})""")
def gc_correct_linear(d):
    """Bins whose log signal is a straight line in GC: all of it is removed."""
    gc = d.bins.select("sample_id", "chrom", "bin_start", (0.3 + F.pmod(F.floor(F.col("bin_start") / 1000000) * 7 + F.col("raw_count"), F.lit(31)) / 100).alias("gc"))
    line = gc.withColumn("normal", F.exp(2 * F.col("gc") - 1))
    return rounded(V.gc_correct_normal(line), "gc", "corrected").select("sample_id", "chrom", "bin_start", "gc", "corrected")


@query("segment_medians", "SELECT sample_id, chrom, bin_start, round(fixed, 6) AS fixed FROM {fixed}")
def segment_medians(d):
    return rounded(V.segment_medians(nbins(d)).select("sample_id", "chrom", "bin_start", "fixed"), "fixed")


@query("copy_number_grid", "SELECT sample_id, chrom, bin_start, round(multiplier, 6) AS multiplier, round(error, 6) AS error, cn FROM {cnbins}")
def copy_number_grid(d):
    return rounded(cnbins(d).select("sample_id", "chrom", "bin_start", "multiplier", "error", "cn"), "multiplier", "error")


@query("average_ploidy", "SELECT sample_id, round(avg(cn), 6) AS average_ploidy FROM {cnbins} GROUP BY 1")
def average_ploidy(d):
    return rounded(V.average_ploidy(cnbins(d)), "average_ploidy")


@query("ploidy_cap", """
SELECT sample_id, chrom, bin_start, CASE WHEN cn * 2 >= 4 THEN '>=4' ELSE CAST(cn * 2 AS STRING) END AS label, least(cn * 2, 8) AS capped FROM {cnbins}""")
def ploidy_cap(d):
    p = cnbins(d).withColumn("ploidy", F.col("cn") * 2)
    return p.select("sample_id", "chrom", "bin_start", Q.ploidy_label().alias("label"), Q.ploidy_capped().alias("capped"))


@query("adjacent_differences", """
SELECT sample_id, chrom, bin_start, round(abs(y - p), 6) AS diff, round(abs(log2(y) - log2(p)), 6) AS diff_log2
FROM (SELECT *, lag(y) OVER (PARTITION BY sample_id, chrom ORDER BY bin_start) AS p FROM {cnbins})""")
def adjacent_differences(d):
    return rounded(V.adjacent_differences(y(d)).select("sample_id", "chrom", "bin_start", "diff", "diff_log2"), "diff", "diff_log2")


@query("change_count", """
SELECT sample_id, count(*) FILTER (WHERE cn <> p) AS n_segments FROM (SELECT sample_id, cn, lag(cn) OVER (PARTITION BY sample_id ORDER BY chrom_no, bin_start) AS p FROM {cnbins}) GROUP BY 1""")
def change_count(d):
    return V.change_count(cnbins(d))


VIEWS["rebinned"] = """
SELECT sample_id, chrom, min(bin_start) AS bin_start, max(bin_end) AS bin_end, avg(normal) AS normal, max(multiplier) AS multiplier, median(cn) AS cn
FROM {cnbins} JOIN (SELECT chrom, bin_start, (row_number() OVER (PARTITION BY chrom ORDER BY bin_start) - 1) // 4 AS block FROM (SELECT DISTINCT chrom, bin_start FROM {bins})) USING (chrom, bin_start)
GROUP BY sample_id, chrom, block"""


@query("rebin", "SELECT sample_id, chrom, bin_start, bin_end, round(normal, 6) AS normal, cn FROM {rebinned}")
def rebin(d):
    return rounded(V.rebin(cnbins(d), 5000000), "normal")


_AWARE = """SELECT sample_id, sum(m * n) / sum(n) AS mad_aware FROM (SELECT sample_id, l, count(*) AS n, 1.4826 * mad(y) AS m FROM (
  SELECT sample_id, y, CASE WHEN count(*) OVER (PARTITION BY sample_id, cn) = 1 THEN 9999999 ELSE cn END AS l FROM {cnbins}) GROUP BY 1, 2) GROUP BY 1"""


@query("mad", f"SELECT sample_id, round(1.4826 * mad(y), 6) AS mad, round(any_value(mad_aware), 6) AS mad_aware FROM {{cnbins}} JOIN ({_AWARE}) USING (sample_id) GROUP BY 1")
def mad(d):
    return rounded(V.mad(y(d), "y", ["sample_id"]).join(V.weighted_mad(y(d)), "sample_id"), "mad", "mad_aware")


_DOUBLES = ("genome_ploidy", "pct_cn_123", "noise_naive_mean", "noise_cn_aware_mean", "noise_two_mean", "noise_naive_median", "noise_cn_aware_median", "noise_two_median",
            "mad_traditional", "mad_aware", "mapd", "mapd_log2", "mapd_rebin", "mapd_log2_rebin", "skew_cnv")


@query("cnv_summary_metrics", f"""
WITH a AS (SELECT sample_id, max(multiplier) AS genome_ploidy, round(100.0 * count(*) FILTER (WHERE cn IN (1, 2, 3)) / count(*), 3) AS pct_cn_123, avg(abs(2 - y)) AS noise_naive_mean,
   avg(abs(y - cn)) AS noise_cn_aware_mean, avg(abs(y - cn)) FILTER (WHERE cn = 2) AS noise_two_mean, median(abs(2 - y)) AS noise_naive_median, median(abs(y - cn)) AS noise_cn_aware_median,
   median(abs(y - cn)) FILTER (WHERE cn = 2) AS noise_two_median, 1.4826 * mad(y) AS mad_traditional FROM {{cnbins}} GROUP BY 1),
b AS (SELECT sample_id, median(abs(y - p)) AS mapd, median(abs(log2(y) - log2(p))) AS mapd_log2 FROM (SELECT *, lag(y) OVER (PARTITION BY sample_id, chrom ORDER BY bin_start) AS p FROM {{cnbins}}) GROUP BY 1),
c AS (SELECT sample_id, median(abs(y - p)) AS mapd_rebin, median(abs(log2(y) - log2(p))) AS mapd_log2_rebin FROM (SELECT *, lag(y) OVER (PARTITION BY sample_id, chrom ORDER BY bin_start) AS p FROM (SELECT *, normal * multiplier AS y FROM {{rebinned}})) GROUP BY 1),
e AS (SELECT sample_id, count(*) FILTER (WHERE cn <> p) AS n_segments FROM (SELECT sample_id, cn, lag(cn) OVER (PARTITION BY sample_id ORDER BY chrom_no, bin_start) AS p FROM {{cnbins}}) GROUP BY 1),
s AS (SELECT sample_id, 1 - sum((u + v) * (least(u, v) / greatest(u, v))) / sum(u + v) AS skew_cnv FROM (SELECT sample_id, cn, count(*) FILTER (WHERE y >= cn) AS u, count(*) FILTER (WHERE y < cn) AS v FROM {{cnbins}} GROUP BY 1, 2) WHERE u > 0 AND v > 0 GROUP BY 1)
SELECT sample_id, n_segments, {r6(*_DOUBLES)} FROM a LEFT JOIN b USING (sample_id) LEFT JOIN c USING (sample_id) LEFT JOIN e USING (sample_id) LEFT JOIN s USING (sample_id) LEFT JOIN ({_AWARE}) USING (sample_id)""")
def cnv_summary_metrics(d):
    return rounded(V.cnv_summary_metrics(d.saved("cnbins", lambda: cnbins(d))), *_DOUBLES)


@query("cnv_segments", """
SELECT sample_id, chrom, cn, min(bin_start) AS start, max(bin_end) AS "end", count(*) AS n_bins, CASE WHEN cn > 2 THEN 'AMP' ELSE 'DEL' END AS kind FROM (
SELECT *, row_number() OVER (PARTITION BY sample_id, chrom ORDER BY bin_start) - row_number() OVER (PARTITION BY sample_id, chrom, cn ORDER BY bin_start) AS g FROM {cnbins})
WHERE cn <> 2 GROUP BY sample_id, chrom, cn, g""")
def cnv_segments(d):
    return V.cnv_segments(cnbins(d))
