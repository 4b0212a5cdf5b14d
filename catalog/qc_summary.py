"""QC summary rows out of report texts, a set of reports for every customer row."""

from pyspark.sql import functions as F

from catalog.base import Data, query, spread
from somaloom.sources import qc_summary as Q


def _report(kind: str, header: str, values: str, lead: str = "## METRICS CLASS\\n", tail: str = "\\n\\n## HISTOGRAM\\nBIN\\tVALUE\\n1\\t2\\n") -> str:
    tabs = lambda names: "\\t".join(names.split())
    cells = ", '\\t', ".join(f"CAST({v} AS STRING)" for v in values.split("|"))
    return f"struct('{kind}' AS kind, concat('{lead}{tabs(header)}\\n', {cells}, '{tail}') AS text)"


def reports(d: Data):
    """Every seventh biosample lacks its duplicate report, every fifth its insert sizes; zero-read ones have empty counts."""
    parts = [
        "struct('read_counts' AS kind, concat(total_reads, '\\n', total_reads DIV 2, '\\n') AS text)",
        "struct('preseq' AS kind, concat(' ', preseq_count, '\\n') AS text)",
        "struct('flagstat' AS kind, concat('100 + 0 primary\\n', n % 50, ' + 0 primary duplicates\\n', 80 + n % 3, ' + 0 primary mapped (80 : N/A)\\n') AS text)",
        "struct('coverage' AS kind, concat('Target\\ttotal\\nchr1:1-5\\t', 1000 + n, '.0\\nchrM:1-9\\t', n % 100, '\\nMT\\t7\\nchr2:1\\tx\\n') AS text)",
        "struct('trim' AS kind, concat('{\"summary\": {\"before_filtering\": {\"total_reads\": ', n, ', \"q30_rate\": ', CASE WHEN n % 2 = 0 THEN '0' ELSE '0.5' END, '}}}') AS text)",
        "struct('alignment' AS kind, concat('CATEGORY\\tTOTAL_READS\\tPF_READS\\tPF_READS_ALIGNED\\tPCT_CHIMERAS\\tPF_MISMATCH_RATE\\nFIRST_OF_PAIR\\t1\\t1\\t1\\t1\\t1\\n', CASE WHEN n % 3 = 0 THEN 'UNPAIRED' ELSE 'PAIR' END, "
        "'\\t', total_reads, '\\t', total_reads DIV 2, '\\t', total_reads DIV 4, '\\t', CASE WHEN n % 4 = 0 THEN '' ELSE CAST(pct_chimeras AS STRING) END, '\\t0.01\\n') AS text)",
        _report("quality_yield", "TOTAL_READS TOTAL_BASES Q20_BASES Q30_BASES", "9|1000|800|n % 700"),
        "CASE WHEN n % 7 <> 0 THEN " + _report("dedup", "LIBRARY READ_PAIRS_EXAMINED READ_PAIR_DUPLICATES READ_PAIR_OPTICAL_DUPLICATES PERCENT_DUPLICATION ESTIMATED_LIBRARY_SIZE", "'lib'|n|n DIV 2|n DIV 4|pct_duplication|''") + " END",
        "CASE WHEN n % 5 <> 0 THEN " + _report("insert_size", "MEDIAN_INSERT_SIZE MEDIAN_ABSOLUTE_DEVIATION MIN_INSERT_SIZE MEAN_INSERT_SIZE STANDARD_DEVIATION READ_PAIRS PAIR_ORIENTATION WIDTH_OF_50_PERCENT", "n % 400|n % 40|2|n % 400 + 0.5|'?'|n|'FR'|n % 60") + " END",
        _report("coverage_metrics", "GENOME_TERRITORY MEAN_COVERAGE PCT_1X PCT_5X HET_SNP_Q", "1000|n % 60|pct_1x|pct_5x|n % 20"),
        _report("target_metrics", "BAIT_SET MEAN_TARGET_COVERAGE FOLD_80_BASE_PENALTY ZERO_CVG_TARGETS_PCT PCT_TARGET_BASES_10X ON_BAIT_BASES", "'b'|n % 90|CASE WHEN n % 6 = 0 THEN '?' ELSE CAST(fold_80_base_penalty AS STRING) END|zero_cvg_targets_pct|pct_target_bases_10x|n"),
    ]
    rows = spread(d.qc, "biosample").withColumn("n", F.regexp_extract("biosample", r"(\d+)$", 1).cast("bigint"))
    return rows.select("biosample", F.explode(F.filter(F.expr(f"array({', '.join(parts)})"), lambda r: r.isNotNull())).alias("r")).select("biosample", "r.*")


_BASE = "SELECT q.*, CAST(substr(biosample, 6) AS BIGINT) AS n FROM {qc} q"


@query("dna_qc_summary", f"""
SELECT biosample, total_reads, total_reads // 2 AS final_reads, total_reads <> total_reads // 2 AS subsampled, n AS fastp_total_reads,
  CASE WHEN n % 2 = 0 THEN (n % 700) / 1000.0 ELSE 0.5 END AS fastp_q30_rate, total_reads AS align_total_reads, pct_aligned, pct_pf,
  CAST(0.01 AS DOUBLE) AS pct_error, chimeras AS pct_chimeras, CASE WHEN n % 7 <> 0 THEN pct_duplication END AS pct_duplication,
  CASE WHEN n % 7 <> 0 THEN 0::BIGINT END AS dedup_estimated_library_size, CASE WHEN n % 7 <> 0 THEN CASE WHEN n > 0 THEN round(CAST(n // 4 AS DOUBLE) / n, 6) ELSE 0 END END AS pct_optical_duplicates,
  CASE WHEN n % 7 <> 0 THEN CASE WHEN n > 0 THEN round(CAST(n // 2 - n // 4 AS DOUBLE) / n, 6) ELSE 0 END END AS pct_pcr_duplicates,
  CASE WHEN n % 5 <> 0 THEN CAST(n % 400 AS DOUBLE) END AS insert_size, NULL::DOUBLE AS insert_std, CASE WHEN n % 5 <> 0 THEN 'FR' END AS insert_pair_orientation,
  CASE WHEN n % 5 <> 0 THEN CAST(n % 60 AS DOUBLE) END AS insert_width_of_50_pct, CASE WHEN n % 5 <> 0 THEN 0::BIGINT END AS insert_width_of_95_pct, NULL::DOUBLE AS gc_at_dropout,
  1007 + n + n % 100 AS cov_total_bases, 7 + n % 100 AS cov_chrm_bases, round(chrm, 6) AS pct_chrm, preseq_count, CAST(mapd_cnv_log2 AS STRING) AS ginkgo_cnv_mapd,
  CASE WHEN total_reads > 0 THEN score END AS qc_score, CASE WHEN total_reads = 0 THEN 'FAIL' WHEN score >= 4 THEN 'PASS' WHEN score = 3 THEN 'Borderline' ELSE 'FAIL' END AS qc_status, 'v1' AS pipeline_version
FROM (SELECT *, CAST(CAST(preseq_count > 3500000000 AS INT) + CAST(chimeras < 0.2 AS INT) + CAST(chrm < 0.2 AS INT) + CAST(mapd_cnv_log2 < 0.25 AS INT) + CAST(coalesce(skew_cnv, 999) < 0.25 AS INT) AS BIGINT) AS score
  FROM (SELECT *, CASE WHEN n % 4 = 0 THEN 0.0 ELSE pct_chimeras END AS chimeras, (7 + n % 100) / CAST(1007 + n + n % 100 AS DOUBLE) AS chrm,
     CASE WHEN total_reads > 0 THEN round(CAST(total_reads // 4 AS DOUBLE) / total_reads, 6) ELSE 0 END AS pct_aligned, CASE WHEN total_reads > 0 THEN round(CAST(total_reads // 2 AS DOUBLE) / total_reads, 6) ELSE 0 END AS pct_pf
     FROM ({_BASE})))""")
def dna_qc_summary(d):
    cnv = d.qc.selectExpr("biosample", "mapd_cnv_log2 AS mapd", "skew_cnv AS skew", "2 AS ploidy", "2.5 AS average_ploidy")
    rows = Q.dna_qc_summary(reports(d), cnv, pipeline_version="v1")
    r6 = [F.round(c, 6).alias(c) for c in ("pct_aligned", "pct_pf", "pct_optical_duplicates", "pct_pcr_duplicates", "pct_chrm")]
    return rows.select("biosample", "total_reads", "final_reads", "subsampled", "fastp_total_reads", "fastp_q30_rate", "align_total_reads", "pct_error", "pct_chimeras", "pct_duplication",
                       "dedup_estimated_library_size", "insert_size", "insert_std", "insert_pair_orientation", "insert_width_of_50_pct", "insert_width_of_95_pct", "gc_at_dropout",
                       "cov_total_bases", "cov_chrm_bases", "preseq_count", "ginkgo_cnv_mapd", F.col("qc_score").cast("bigint").alias("qc_score"), "qc_status", "pipeline_version", *r6)


def _run_summary(mode: str, score: str, good: int) -> str:
    return f"""
SELECT biosample, reads AS total_reads, CASE WHEN n % 4 = 0 THEN 0.0 ELSE pct_chimeras END AS pct_chimeras, round(dup, 6) AS pct_duplication, (n % 700) / 1000.0 AS sentieon_q30_rate,
  CASE WHEN n % 7 <> 0 THEN n END AS read_pairs_examined, CASE WHEN n % 5 <> 0 THEN CAST(n % 40 AS DOUBLE) END AS insert_mad, CASE WHEN n % 5 <> 0 THEN 2::BIGINT END AS insert_min,
  CAST(n % 60 AS DOUBLE) AS mean_coverage, pct_1x, CAST(0 AS DOUBLE) AS pct_10x, n % 20 AS het_snp_q, CAST(n % 90 AS DOUBLE) AS mean_target_coverage, fold AS fold_80_base_penalty,
  pct_target_bases_10x, n AS on_bait_bases, '{mode}' AS mode, CASE WHEN reads > 0 THEN score END AS qc_score,
  CASE WHEN reads = 0 THEN 'FAIL' WHEN score >= {good} THEN 'PASS' WHEN score = {good - 1} THEN 'Borderline' ELSE 'FAIL' END AS qc_status
FROM (SELECT *, CAST({score} AS BIGINT) AS score FROM (SELECT *, CASE WHEN n % 10 = 3 THEN 4 * total_reads ELSE total_reads END AS reads, CASE WHEN n % 6 <> 0 THEN fold_80_base_penalty END AS fold,
  CASE WHEN n % 7 <> 0 THEN pct_duplication ELSE (n % 50) / (80.0 + n % 3) END AS dup FROM ({_BASE})))"""


def _run_rows(d, mode):
    counts = d.qc.withColumn("n", F.regexp_extract("biosample", r"(\d+)$", 1).cast("bigint")).filter("n % 10 = 3").selectExpr("biosample", "4 * total_reads AS total_reads")
    rows = Q.wgs_qc_summary(reports(d), counts, mode)
    return rows.select("biosample", "total_reads", "pct_chimeras", F.round("pct_duplication", 6).alias("pct_duplication"), "sentieon_q30_rate", "read_pairs_examined", "insert_mad", "insert_min",
                       "mean_coverage", "pct_1x", "pct_10x", "het_snp_q", "mean_target_coverage", "fold_80_base_penalty", "pct_target_bases_10x", "on_bait_bases", "mode",
                       F.col("qc_score").cast("bigint").alias("qc_score"), "qc_status")


@query("wgs_qc_summary", _run_summary("wgs", "CAST(reads >= 50000000 AS INT) + CAST(dup < 0.25 AS INT) + CAST(CASE WHEN n % 4 = 0 THEN 0.0 ELSE pct_chimeras END < 0.15 AS INT) + CAST(pct_1x >= 0.9 AS INT) + CAST(pct_5x >= 0.7 AS INT)", 4))
def wgs_qc_summary(d):
    return _run_rows(d, "wgs")


@query("wes_qc_summary", _run_summary("wes", "CAST(reads >= 500000 AS INT) + CAST(pct_target_bases_10x >= 0.75 AS INT) + CAST(zero_cvg_targets_pct < 0.05 AS INT) + CAST(coalesce(fold < 5, FALSE) AS INT)", 3))
def wes_qc_summary(d):
    return _run_rows(d, "wes")
