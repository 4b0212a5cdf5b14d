"""Germline labels, prevalence and allele dropout."""

from pyspark.sql import functions as F

from catalog.base import VIEWS, Data, query
from catalog.provenance import bulk_status, first_status, vep_once
from somaloom.functions.variants import caller_verdict
from somaloom.functions.stats import log10_or_neg_inf
from somaloom.operators import germline as G

PCT = 40

VIEWS["prevalence"] = """
SELECT variant_id, count(*) FILTER (WHERE gt = '0/1') AS n_het, count(*) FILTER (WHERE gt <> '0/0') AS n_non_ref,
       100.0 * count(*) FILTER (WHERE gt = '0/1') / (SELECT count(DISTINCT sample_id) FROM {calls}) AS het_pct,
       CAST(count(*) FILTER (WHERE gt <> '0/0') AS DOUBLE) / (SELECT count(DISTINCT sample_id) FROM {calls}) AS prevalence FROM {calls} GROUP BY 1"""
VIEWS["glabels"] = f"""
SELECT variant_id, CASE WHEN cand AND het_pct > {PCT} THEN 'Yes' ELSE 'No' END AS high_confidence_germline, CASE WHEN cand THEN 'Yes' ELSE 'No' END AS germline_from_stats,
  CASE WHEN af THEN 'AF_filter' ELSE 'Not_filtered' END AS vep_af_filter, CASE WHEN af AND het_pct >= {PCT} THEN 'Yes' ELSE 'No' END AS vep_high_confidence,
  bulk AS remaining_after_bulk, CASE WHEN bulk = 'Fail' AND het_pct >= {PCT} THEN 'Yes' ELSE 'No' END AS bulk_high_confidence,
  CASE WHEN cand AND het_pct > {PCT} THEN n_non_ref END AS stats_count, CASE WHEN cand AND het_pct > {PCT} THEN round(prevalence, 4) END AS stats_proportion,
  CASE WHEN af THEN n_non_ref END AS vep_af_count, CASE WHEN af THEN round(prevalence, 4) END AS vep_af_proportion,
  CASE WHEN bulk = 'Fail' THEN n_non_ref END AS bulk_fail_count, CASE WHEN bulk = 'Fail' THEN round(prevalence, 4) END AS bulk_fail_proportion, prevalence AS raw_prevalence
FROM (SELECT p.*, coalesce(f.germline_q > 0.1 AND (f.rho IS NULL OR f.rho < 0.1), FALSE) AS cand, coalesce(v.filter_reason = 'AF_filter', FALSE) AS af,
        CASE WHEN e.variant_id IS NULL THEN 'Not_evaluated' ELSE b.bulk_status END AS bulk
      FROM {{prevalence}} p LEFT JOIN {{first_status}} f USING (variant_id) LEFT JOIN {{vep_once}} v USING (variant_id) LEFT JOIN {{bulk_status}} b USING (variant_id)
      LEFT JOIN (SELECT DISTINCT variant_id FROM {{calls}} WHERE ad_alt > 0) e USING (variant_id))"""
VIEWS["glong"] = """
SELECT variant_id, 'GERMLINE_FROM_STATS' AS filter, round(raw_prevalence, 6) AS prevalence FROM {glabels} WHERE germline_from_stats = 'Yes'
UNION ALL SELECT variant_id, 'VEP_AF_filter', vep_af_proportion FROM {glabels} WHERE vep_af_filter = 'AF_filter'
UNION ALL SELECT variant_id, 'Bulk_Fail', bulk_fail_proportion FROM {glabels} WHERE remaining_after_bulk = 'Fail'"""


def labels(d: Data):
    stats = first_status(d).withColumn("germline_q_log10", log10_or_neg_inf("germline_q"))
    return d.saved("labels", lambda: G.germline_labels(d.calls, stats, vep_once(d), bulk_status(d), PCT))


def prevalence_rows(d: Data):
    return G.germline_prevalence_long(labels(d), d.calls)


_MLV = """SELECT variant_id, count(*) AS n_carry, count(*) FILTER (WHERE filter IN ('PASS', '.')) AS n_pass, count(*) FILTER (WHERE filter NOT IN ('PASS', '.')) AS n_reject,
       CASE WHEN count(*) FILTER (WHERE filter IN ('PASS', '.')) >= 17 THEN 'keep' ELSE 'drop' END AS verdict FROM {calls} GROUP BY 1"""


@query("ml_verdict_counts", f"SELECT *, round(CAST(n_reject AS DOUBLE) / n_carry, 6) AS reject_fraction FROM ({_MLV})")
def ml_verdict_counts(d):
    c = d.calls.select("variant_id", caller_verdict().alias("mlv"))
    return G.ml_verdict_counts(c, 17).withColumn("reject_fraction", F.round("reject_fraction", 6))


@query("ml_verdict_summary", f"""
SELECT count(*) AS total_variants, count(*) FILTER (WHERE verdict = 'keep') AS usable_variants, count(*) FILTER (WHERE verdict = 'drop') AS filtered_variants,
       round(100.0 * count(*) FILTER (WHERE verdict = 'keep') / count(*), 2) AS pct_kept, round(100.0 * count(*) FILTER (WHERE verdict = 'drop') / count(*), 2) AS pct_filtered FROM ({_MLV})""")
def ml_verdict_summary(d):
    return G.ml_verdict_summary(G.ml_verdict_counts(d.calls.select("variant_id", caller_verdict().alias("mlv")), 17))


@query("prevalence", "SELECT variant_id, n_het, n_non_ref, round(het_pct, 6) AS het_pct, round(prevalence, 6) AS prevalence FROM {prevalence}")
def prevalence(d):
    return G.prevalence(d.calls).select("variant_id", "n_het", "n_non_ref", F.round("het_pct", 6).alias("het_pct"), F.round("prevalence", 6).alias("prevalence"))


@query("germline_labels", "SELECT * EXCLUDE (raw_prevalence) FROM {glabels}")
def germline_labels(d):
    return labels(d)


@query("germline_prevalence_long", "SELECT * FROM {glong}")
def germline_prevalence_long(d):
    return prevalence_rows(d)


@query("prevalence_histogram", f"""
SELECT filter, round_even(prevalence, 1) AS prevalence_bin, CASE WHEN prevalence >= {PCT / 100} THEN 'Pass' ELSE 'Fail' END AS status, count(*) AS n FROM {{glong}} GROUP BY 1, 2, 3""")
def prevalence_histogram(d):
    return G.prevalence_histogram(prevalence_rows(d), PCT / 100)


@query("prevalence_summary", f"""
SELECT filter, count(*) AS n, count(*) FILTER (WHERE prevalence >= {PCT / 100}) AS n_pass, round(median(prevalence), 3) AS median FROM {{glong}} GROUP BY 1""")
def prevalence_summary(d):
    return G.prevalence_summary(prevalence_rows(d), PCT / 100)


@query("ado_table", """
SELECT sample_id, variant_id, chrom, pos, ref, alt, ad_alt, dp, round(CAST(ad_alt AS DOUBLE) / dp, 6) AS freq, 'germline' AS provenance FROM {calls}""")
def ado_table(d):
    return G.ado_table(d.calls).withColumn("freq", F.round("freq", 6))


VIEWS["ado"] = """
SELECT s.sample_id, i.interval, coalesce(c.n, 0) AS freq, coalesce(c.n, 0) / CAST(t.n AS DOUBLE) AS prop
FROM (SELECT sample_id, count(*) AS n FROM {calls} WHERE dp >= 2 GROUP BY 1) t JOIN (SELECT DISTINCT sample_id FROM {calls}) s USING (sample_id)
CROSS JOIN (SELECT unnest(['[0-0.1)', '[0.1-0.2)', '[0.2-0.3)', '[0.3-0.4)', '[0.4-0.5)', '[0.5-0.6)', '[0.6-0.7)', '[0.7-0.8)', '[0.8-0.9)', '[0.9-1]']) AS interval, unnest(range(0, 10)) AS k) i
LEFT JOIN (SELECT sample_id, CASE WHEN x >= 0.9 THEN 9 WHEN x >= 0.8 THEN 8 WHEN x >= 0.7 THEN 7 WHEN x >= 0.6 THEN 6 WHEN x >= 0.5 THEN 5 WHEN x >= 0.4 THEN 4
             WHEN x >= 0.3 THEN 3 WHEN x >= 0.2 THEN 2 WHEN x >= 0.1 THEN 1 ELSE 0 END AS k, count(*) AS n
           FROM (SELECT sample_id, CAST(ad_alt AS DOUBLE) / dp AS x FROM {calls} WHERE dp >= 2) GROUP BY 1, 2) c ON c.sample_id = s.sample_id AND c.k = i.k"""


@query("ado_intervals", "SELECT sample_id, interval, freq, round(prop, 6) AS prop FROM {ado}")
def ado_intervals(d):
    return G.ado_intervals(G.ado_table(d.calls)).withColumn("prop", F.round("prop", 6))


@query("ado_balance", "SELECT sample_id, round(sum(prop), 6) AS ado_perc FROM {ado} WHERE substr(interval, 2, 3) IN ('0.2', '0.3', '0.4', '0.5', '0.6', '0.7') GROUP BY 1")
def ado_balance(d):
    return G.ado_balance(G.ado_intervals(G.ado_table(d.calls))).withColumn("ado_perc", F.round("ado_perc", 6))


@query("ado_comparison", """
SELECT 'germline' AS provenance, count(DISTINCT sample_id) AS n_samples, CAST(sum(freq) AS BIGINT) AS n_total, CAST(round_even(sum(freq) / count(DISTINCT sample_id), 0) AS BIGINT) AS n_sites FROM {ado}""")
def ado_comparison(d):
    return G.ado_comparison(G.ado_intervals(G.ado_table(d.calls)).withColumn("provenance", F.lit("germline")))


@query("vcf_stats", """
SELECT sample_id, n_snv, n_indel, n_ts, n_snv - n_ts AS n_tv, n_het, n_hom_alt, n_ref, round(CAST(n_ts AS DOUBLE) / nullif(n_snv - n_ts, 0), 6) AS ts_tv FROM (
SELECT sample_id, count(*) FILTER (WHERE gt <> '0/0' AND length(alt) = 1) AS n_snv, count(*) FILTER (WHERE gt <> '0/0' AND length(alt) > 1) AS n_indel,
  count(*) FILTER (WHERE gt <> '0/0' AND ref || alt IN ('AG', 'GA', 'CT', 'TC')) AS n_ts, count(*) FILTER (WHERE gt = '0/1') AS n_het,
  count(*) FILTER (WHERE gt = '1/1') AS n_hom_alt, count(*) FILTER (WHERE gt = '0/0') AS n_ref FROM {calls} GROUP BY 1)""")
def vcf_stats(d):
    return G.vcf_stats(d.calls)
