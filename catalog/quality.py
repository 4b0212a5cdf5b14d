"""QC scores, read-level metrics and coverage."""

from pyspark.sql import functions as F

from catalog.base import VIEWS, Data, query
from catalog.counts import r6, rounded
from catalog.joins import TARGETS, targets
from somaloom.functions import quality as Q
from somaloom.operators import coverage as C
from somaloom.operators import optical as O

_OPS = {">": ">", ">=": ">=", "<": "<"}
SCORE = {p: " + ".join(f"CASE WHEN {m} {op} {cut} THEN 1 ELSE 0 END" for m, op, cut in rules) for p, rules in Q.PROFILES.items()}
VIEWS["scored"] = f"SELECT *, {SCORE['wgs']} AS qc_score FROM {{qc}}"


def scored(d: Data):
    return d.qc.withColumn("qc_score", Q.qc_score("wgs"))


@query("qc_score", "SELECT biosample, " + ", ".join(f"{SCORE[p]} AS {p}_score" for p in SCORE) + " FROM {qc}")
def qc_score(d):
    return d.qc.select("biosample", *[Q.qc_score(p).alias(f"{p}_score") for p in Q.PROFILES])


@query("qc_status", f"""
SELECT biosample, CASE WHEN total_reads > 0 THEN s END AS qc_score, CASE WHEN total_reads = 0 THEN 'FAIL' WHEN s IS NULL THEN 'PENDING' WHEN s >= 4 THEN 'PASS' WHEN s = 3 THEN 'Borderline' ELSE 'FAIL' END AS qc_status,
       CASE WHEN total_reads = 0 THEN 'FAIL' WHEN w >= 3 THEN 'PASS' WHEN w = 2 THEN 'Borderline' ELSE 'FAIL' END AS wes_status
FROM (SELECT *, CASE WHEN mapd_cnv_log2 > 0.38 THEN NULL ELSE {SCORE['wgs']} END AS s, {SCORE['wes']} AS w FROM {{qc}})""")
def qc_status(d):
    s = d.qc.withColumns({"s": F.when(F.col("mapd_cnv_log2") > 0.38, None).otherwise(Q.qc_score("wgs")), "w": Q.qc_score("wes")})
    return s.select("biosample", *[c.alias(n) for n, c in Q.qc_status("wgs", "s").items()], Q.qc_status("wes", "w")["qc_status"].alias("wes_status"))


@query("cnv_quadrant", """
SELECT biosample, CASE WHEN skew_cnv IS NULL THEN NULL WHEN mapd_cnv_log2 < 0.2 AND skew_cnv < 0.2 THEN 'Ideal' WHEN mapd_cnv_log2 >= 0.25 AND skew_cnv < 0.2 THEN 'Noisier'
       WHEN mapd_cnv_log2 < 0.2 AND skew_cnv >= 0.25 THEN 'Uneven' WHEN mapd_cnv_log2 >= 0.25 OR skew_cnv >= 0.25 THEN 'Noisier and Uneven' ELSE 'Border' END AS quadrant FROM {qc}""")
def cnv_quadrant(d):
    return d.qc.select("biosample", Q.cnv_quadrant().alias("quadrant"))


@query("coverage_fraction", """
SELECT biosample, CASE WHEN x > 10 THEN round(10 / x, 6) ELSE 1.0 END AS fraction,
       concat(biosample, '_cov', lpad(CAST(CAST(floor(least(x, 10)) AS INT) AS STRING), 2, '0'), 'x') AS labelled_name FROM (SELECT biosample, CAST(total_reads AS DOUBLE) / 10000000 AS x FROM {qc})""")
def coverage_fraction(d):
    cols = Q.coverage_fraction("x", 10.0)
    return d.qc.select("biosample", (F.col("total_reads") / 10000000).alias("x")).select(
        "biosample", F.round(cols["fraction"], 6).alias("fraction"), cols["labelled_name"].alias("labelled_name"))


@query("score_distribution", """
SELECT qc_score, count(*) AS n, round(100.0 * count(*) / (SELECT count(*) FROM {scored}), 6) AS pct FROM {scored} GROUP BY 1""")
def score_distribution(d):
    return C.score_distribution(scored(d))


@query("score_by_group", "SELECT grp, " + ", ".join(f"count(*) FILTER (WHERE qc_score = {i}) AS score_{i}" for i in range(6)) + " FROM {scored} GROUP BY 1")
def score_by_group(d):
    return C.score_by_group(scored(d), range(6))


@query("score_quantiles", """
SELECT metric, qc_score, round(quantile_cont(value, 0.0), 6) AS p0, round(quantile_cont(value, 0.25), 6) AS p25, round(quantile_cont(value, 0.5), 6) AS p50,
       round(quantile_cont(value, 0.75), 6) AS p75, round(quantile_cont(value, 1.0), 6) AS p100
FROM (SELECT qc_score, 'total_reads' AS metric, CAST(total_reads AS DOUBLE) AS value FROM {scored} UNION ALL SELECT qc_score, 'skew_cnv', skew_cnv FROM {scored} UNION ALL SELECT qc_score, 'pct_1x', pct_1x FROM {scored})
WHERE value IS NOT NULL GROUP BY 1, 2""")
def score_quantiles(d):
    return rounded(C.score_quantiles(scored(d), ["total_reads", "skew_cnv", "pct_1x"]), "p0", "p25", "p50", "p75", "p100")


@query("mark_duplicates", """
SELECT read_id, sample_id, chrom, pos, strand, bq, rk > 1 AS is_duplicate FROM (
  SELECT *, rank() OVER (PARTITION BY sample_id, chrom, pos, strand ORDER BY bq DESC, read_id) AS rk FROM {obs})""")
def mark_duplicates(d):
    return C.mark_duplicates(d.obs.select("read_id", "sample_id", "chrom", "pos", "strand", "bq"), quality="bq")


@query("mark_duplicates_unmapped", """
SELECT read_id, chrom, pos, bq, chrom IS NOT NULL AND rk > 1 AS is_duplicate FROM (
  SELECT *, rank() OVER (PARTITION BY sample_id, chrom, pos, strand ORDER BY bq DESC, read_id) AS rk FROM (
    SELECT read_id, sample_id, CASE WHEN mq < 25 THEN NULL ELSE chrom END AS chrom, pos, strand, bq FROM {obs}))""")
def mark_duplicates_unmapped(d):
    """Reads without a place are kept and are no duplicates."""
    rows = d.obs.selectExpr("read_id", "sample_id", "CASE WHEN mq < 25 THEN NULL ELSE chrom END AS chrom", "pos", "strand", "bq")
    return C.mark_duplicates(rows, quality="bq").select("read_id", "chrom", "pos", "bq", "is_duplicate")


VIEWS["clusters"] = """
SELECT read_id, sample_id, chrom, pos, strand, bq, mq >= 25 AS paired, read_id % 3 AS tile, (read_id * 37) % 1000 AS x, (read_id * 53) % 700 AS y FROM {obs}"""

# twin of the chains: reads reached from each read over pairs within 100 pixels
_OPTICAL = """
SELECT r.*, rank() OVER (PARTITION BY sample_id, chrom, pos, strand ORDER BY bq DESC, r.read_id) > 1 AS is_duplicate,
       rank() OVER (PARTITION BY sample_id, chrom, pos, strand, tile, c.cluster ORDER BY bq DESC, r.read_id) > 1 AS is_optical
FROM {clusters} r JOIN (
  WITH RECURSIVE near AS (SELECT a.read_id AS a, b.read_id AS b FROM {clusters} a JOIN {clusters} b USING (sample_id, chrom, pos, strand, tile) WHERE abs(a.x - b.x) <= 100 AND abs(a.y - b.y) <= 100),
  reach AS (SELECT a, b FROM near UNION SELECT r.a, n.b FROM reach r JOIN near n ON n.a = r.b)
  SELECT a AS read_id, min(b) AS cluster FROM reach GROUP BY 1) c ON c.read_id = r.read_id"""


def _flagged(d):
    return O.optical_duplicates(d.saved("marked", lambda: C.mark_duplicates(d.clusters, quality="bq")), quality="bq")


@query("optical_duplicates", f"SELECT read_id, sample_id, tile, is_duplicate, is_optical FROM ({_OPTICAL})")
def optical_duplicates(d):
    return _flagged(d).select("read_id", "sample_id", "tile", "is_duplicate", "is_optical")


@query("dup_metrics_from_reads", f"""
SELECT sample_id, e AS read_pairs_examined, u AS read_pair_duplicates, o AS read_pair_optical_duplicates, round((u + s_dup) / (e + s), 6) AS pct_duplication,
       round(o / e, 6) AS pct_optical_duplicates, round((u - o) / e, 6) AS pct_pcr_duplicates
FROM (SELECT sample_id, count(*) FILTER (WHERE paired) // 2 AS e, count(*) FILTER (WHERE paired AND is_duplicate) // 2 AS u, count(*) FILTER (WHERE paired AND is_optical) // 2 AS o,
             count(*) FILTER (WHERE NOT paired) AS s, count(*) FILTER (WHERE NOT paired AND is_duplicate) AS s_dup FROM ({_OPTICAL}) GROUP BY 1)""")
def dup_metrics_from_reads(d):
    """Duplicates, optical ones included, found in the reads themselves."""
    counts = O.duplicate_counts(_flagged(d))
    return rounded(C.dup_metrics(counts).select("sample_id", "read_pairs_examined", "read_pair_duplicates", "read_pair_optical_duplicates", "pct_duplication",
                                                "pct_optical_duplicates", "pct_pcr_duplicates"), "pct_optical_duplicates", "pct_pcr_duplicates")


@query("quality_yield", """
SELECT sample_id, count(*) AS total_bases, round(avg(CASE WHEN bq >= 20 THEN 1.0 ELSE 0 END), 6) AS q20_rate, round(avg(CASE WHEN bq >= 30 THEN 1.0 ELSE 0 END), 6) AS q30_rate FROM {obs} GROUP BY 1""")
def quality_yield(d):
    return rounded(C.quality_yield(d.obs), "q20_rate", "q30_rate")


_DUP = """SELECT sample_id, count(*) FILTER (WHERE mq >= 25) AS paired_reads, count(*) FILTER (WHERE mq >= 25 AND clipped) AS dup_pair_reads,
  count(*) FILTER (WHERE mq >= 50 AND clipped) AS optical_pair_reads, count(*) FILTER (WHERE mq < 25) AS single_reads, count(*) FILTER (WHERE mq < 25 AND clipped) AS dup_single_reads FROM {obs} GROUP BY 1"""


@query("dup_metrics", f"""
SELECT sample_id, e AS read_pairs_examined, u AS read_pair_duplicates, o AS read_pair_optical_duplicates, round((u + dup_single_reads) / (e + single_reads), 6) AS pct_duplication,
       round(o / e, 6) AS pct_optical_duplicates, round((u - o) / e, 6) AS pct_pcr_duplicates
FROM (SELECT *, paired_reads // 2 AS e, dup_pair_reads // 2 AS u, optical_pair_reads // 2 AS o FROM ({_DUP}))""")
def dup_metrics(d):
    n = lambda cond: F.count_if(F.expr(cond))
    counts = d.obs.groupBy("sample_id").agg(
        n("mq >= 25").alias("paired_reads"), n("mq >= 25 AND clipped").alias("dup_pair_reads"), n("mq >= 50 AND clipped").alias("optical_pair_reads"),
        n("mq < 25").alias("single_reads"), n("mq < 25 AND clipped").alias("dup_single_reads"))
    return rounded(C.dup_metrics(counts).drop("paired_reads", "dup_pair_reads", "optical_pair_reads", "single_reads", "dup_single_reads"),
                   "pct_optical_duplicates", "pct_pcr_duplicates")


@query("flag_duplication", """
SELECT biosample, round(CASE WHEN m > 0 THEN u / m WHEN total_reads > 0 THEN u / total_reads ELSE 0 END, 6) AS pct_duplication
FROM (SELECT biosample, CAST(total_reads AS DOUBLE) AS total_reads, CAST(total_reads // 10 AS DOUBLE) AS u, CASE WHEN total_reads % 3 = 0 THEN 0 ELSE CAST(total_reads - 5 AS DOUBLE) END AS m FROM {qc})""")
def flag_duplication(d):
    f = d.qc.selectExpr("biosample", "total_reads AS primary", "total_reads div 10 AS duplicates", "CASE WHEN total_reads % 3 = 0 THEN 0 ELSE total_reads - 5 END AS mapped")
    return C.flag_duplication(f).select("biosample", F.round("pct_duplication", 6).alias("pct_duplication"))


@query("align_ratios", """
SELECT biosample, round(coalesce((total_reads - 7) / nullif(total_reads, 0), 0), 6) AS pct_aligned, round(coalesce((total_reads // 2) / nullif(total_reads, 0), 0), 6) AS pct_pf FROM {qc}""")
def align_ratios(d):
    c = d.qc.selectExpr("biosample", "total_reads", "total_reads - 7 AS aligned_reads", "total_reads div 2 AS pf_reads")
    return C.align_ratios(c).select("biosample", F.round("pct_aligned", 6).alias("pct_aligned"), F.round("pct_pf", 6).alias("pct_pf"))


@query("insert_size_stats", """
SELECT sample_id, median(x) AS insert_median, round(avg(x), 6) AS insert_mean, round(stddev_samp(x), 6) AS insert_std, min(x) AS insert_min, max(x) AS insert_max,
       count(*) AS insert_read_pairs, mad(x) AS insert_mad FROM (SELECT sample_id, 200 + 2 * bp_start AS x FROM {obs}) GROUP BY 1""")
def insert_size_stats(d):
    return rounded(C.insert_size_stats(d.obs.select("sample_id", (200 + 2 * F.col("bp_start")).alias("insert_size"))), "insert_mean", "insert_std")


VIEWS["depth"] = "SELECT sample_id, CASE WHEN pos % 29 = 0 THEN 'chrM' ELSE chrom END AS chrom, pos, count(*) AS depth FROM {obs} GROUP BY 1, 2, 3"


@query("chrom_coverage", """
SELECT sample_id, chrom, CAST(sum(depth) AS BIGINT) AS total_coverage, round(avg(depth), 6) AS average_coverage,
       round(100 * avg(CASE WHEN depth >= 15 THEN 1.0 ELSE 0 END), 6) AS pct_above_15 FROM {depth} GROUP BY 1, 2""")
def chrom_coverage(d):
    return rounded(C.chrom_coverage(d.depth), "average_coverage", "pct_above_15")


@query("mitochondrial_share", """
SELECT sample_id, CAST(sum(depth) AS BIGINT) AS cov_total_bases, CAST(sum(CASE WHEN chrom = 'chrM' THEN depth ELSE 0 END) AS BIGINT) AS cov_chrm_bases,
       round(sum(CASE WHEN chrom = 'chrM' THEN depth ELSE 0 END) / sum(depth), 6) AS pct_chrm FROM {depth} GROUP BY 1""")
def mitochondrial_share(d):
    return rounded(C.mitochondrial_share(C.chrom_coverage(d.depth)), "pct_chrm")


VIEWS["alignments"] = """
SELECT read_id, sample_id, chrom, pos + read_id % 40 AS pos, mq, CASE read_id % 5 WHEN 0 THEN '10S30M' WHEN 1 THEN '12M5D8M' WHEN 2 THEN '5M3I10M' WHEN 3 THEN '4M100N6M2H' ELSE '25M' END AS cigar FROM {obs}"""
VIEWS["blocks"] = """
SELECT sample_id, chrom, pos AS start, pos + CASE read_id % 5 WHEN 0 THEN 29 WHEN 1 THEN 11 WHEN 2 THEN 4 WHEN 3 THEN 3 ELSE 24 END AS stop FROM {alignments} WHERE mq >= 20
UNION ALL SELECT sample_id, chrom, pos + CASE read_id % 5 WHEN 1 THEN 17 WHEN 2 THEN 5 ELSE 104 END, pos + CASE read_id % 5 WHEN 1 THEN 24 WHEN 2 THEN 14 ELSE 109 END
FROM {alignments} WHERE mq >= 20 AND read_id % 5 IN (1, 2, 3)"""
VIEWS["base_depth"] = "SELECT sample_id, chrom, p AS pos, count(*) AS depth FROM (SELECT sample_id, chrom, unnest(range(start, stop + 1)) AS p FROM {blocks}) GROUP BY 1, 2, 3"


def runs(d: Data):
    return C.depth_runs(C.aligned_blocks(d.alignments.filter("mq >= 20")), span=512)


@query("depth_runs", """
SELECT sample_id, chrom, depth, count(*) AS n_positions, CAST(sum(pos) AS BIGINT) AS sum_of_positions FROM {base_depth} GROUP BY 1, 2, 3""")
def depth_runs(d):
    n = F.col("end") - F.col("start") + 1
    return runs(d).groupBy("sample_id", "chrom", "depth").agg(F.sum(n).alias("n_positions"), F.sum(n * (F.col("start") + F.col("end")) / 2).cast("bigint").alias("sum_of_positions"))


@query("coverage_profile_from_reads", """
WITH x AS (SELECT sample_id, least(depth, 250) AS v FROM {base_depth} UNION ALL
  SELECT sample_id, unnest(list_transform(range(0, 40000 - n), lambda i: 0)) FROM (SELECT sample_id, count(*) AS n FROM {base_depth} GROUP BY 1))
SELECT sample_id, round(avg(v), 6) AS mean_coverage, round(stddev_samp(v), 6) AS sd_coverage, median(v) AS median_coverage, mad(v) AS mad_coverage,
  round(avg(CASE WHEN v >= 1 THEN 1.0 ELSE 0 END), 6) AS pct_1x, round(avg(CASE WHEN v >= 5 THEN 1.0 ELSE 0 END), 6) AS pct_5x FROM x GROUP BY 1""")
def coverage_profile_from_reads(d):
    return rounded(C.coverage_profile(runs(d), 40000, levels=(1, 5)), "mean_coverage", "sd_coverage", "pct_1x", "pct_5x")


@query("coverage_profile", """
WITH x AS (SELECT sample_id, least(depth, 250) AS v FROM {depth} UNION ALL
  SELECT sample_id, unnest(list_transform(range(0, 1000 - n), lambda i: 0)) FROM (SELECT sample_id, count(*) AS n FROM {depth} GROUP BY 1))
SELECT sample_id, round(avg(v), 6) AS mean_coverage, round(stddev_samp(v), 6) AS sd_coverage, median(v) AS median_coverage, mad(v) AS mad_coverage,
       round(avg(CASE WHEN v >= 1 THEN 1.0 ELSE 0 END), 6) AS pct_1x, round(avg(CASE WHEN v >= 20 THEN 1.0 ELSE 0 END), 6) AS pct_20x FROM x GROUP BY 1""")
def coverage_profile(d):
    return rounded(C.coverage_profile(d.depth, 1000, levels=(1, 20)), "mean_coverage", "sd_coverage", "pct_1x", "pct_20x")


@query("target_coverage", f"""
WITH t AS ({TARGETS}), z AS (SELECT sum(end_pos - start + 1) AS size, count(*) AS n FROM t),
o AS (SELECT d.*, t.target FROM {{depth}} d JOIN t ON t.chrom = d.chrom AND d.pos BETWEEN t.start AND t.end_pos),
e AS (SELECT DISTINCT d.* FROM {{depth}} d JOIN t ON t.chrom = d.chrom AND d.pos BETWEEN t.start - 250 AND t.end_pos + 250)
SELECT a.sample_id, round(b / size, 6) AS mean_target_coverage, round(1 - h / n, 6) AS zero_cvg_targets_pct, round(n1 / size, 6) AS pct_target_bases_1x, round(n10 / size, 6) AS pct_target_bases_10x,
       round((b / size) / p20, 6) AS fold_80_base_penalty, round(b / al, 6) AS pct_on_target, round((nr - b) / al, 6) AS pct_near_target, round((al - nr) / al, 6) AS pct_off_target
FROM (SELECT sample_id, sum(depth) AS al FROM {{depth}} GROUP BY 1) a
JOIN (SELECT sample_id, sum(depth) AS b, count(DISTINCT target) AS h, quantile_cont(depth, 0.2) AS p20, count(*) FILTER (WHERE depth >= 1) AS n1, count(*) FILTER (WHERE depth >= 10) AS n10 FROM o GROUP BY 1) USING (sample_id)
JOIN (SELECT sample_id, sum(depth) AS nr FROM e GROUP BY 1) USING (sample_id) CROSS JOIN z""")
def target_coverage(d):
    t = C.target_coverage(d.depth, targets(d), levels=(1, 10), width=100)
    return rounded(t, *[c for c in t.columns if c != "sample_id"])
