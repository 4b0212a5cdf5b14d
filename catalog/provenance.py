"""Master table, funnels, redundancy and influence."""

from pyspark.sql import functions as F

from catalog.annotation import population
from catalog.base import VIEWS, Data, query
from catalog.cascade import MANDATORY, mandatory_ids, membership, saved_nvnr, second, staged, verdicts
from catalog.counts import filtered, nvnr
from catalog.joins import bulk_ids, priority_ids
from somaloom.operators import cascade as C
from somaloom.operators import germline_stats as G
from somaloom.operators import joins as J
from somaloom.operators import provenance as P

VIEWS["vep_once"] = """
SELECT variant_id, min(filter_status) AS filter_status, min(filter_reason) AS filter_reason FROM {population} GROUP BY 1"""
VIEWS["first_status"] = """
SELECT v.variant_id, v.germline_q, v.rho, CASE WHEN v.germline_filter AND v.betabinom_filter THEN 'Pass' WHEN p.variant_id IS NOT NULL THEN 'Rescued' ELSE 'Fail' END AS statistical_status
FROM {verdicts} v LEFT JOIN (SELECT variant_id FROM {sites} WHERE pos % 12 = 0 OR pos % 7 = 1) p ON p.variant_id = v.variant_id"""
VIEWS["master"] = """
SELECT variant_id, b.bulk_status AS bulk_bulk_status, f.statistical_status AS binom_statistical_status, f.rho AS binom_rho,
       v.filter_status AS vep_filter_status, v.filter_reason AS vep_filter_reason, p.pileup_verdict AS pileup_pileup_verdict, s.germline_q AS second_germline_q
FROM (SELECT * FROM {bulk_status} WHERE variant_id IN (SELECT variant_id FROM {calls} WHERE ad_alt > 0)) b FULL JOIN {first_status} f USING (variant_id) FULL JOIN {vep_once} v USING (variant_id)
FULL JOIN {pileup_verdicts} p USING (variant_id) FULL JOIN {second} s USING (variant_id)"""


def vep_once(d: Data):
    return population(d).groupBy("variant_id").agg(F.min("filter_status").alias("filter_status"), F.min("filter_reason").alias("filter_reason"))


def first_status(d: Data):
    v = d.saved("first", lambda: G.first_pass_verdict(d.saved("first_stats", lambda: G.first_pass(d.saved("nvnr", lambda: nvnr(d))))))
    return J.rescue_union(v.select("variant_id", "germline_q", "rho", "stat_pass"), v.filter("stat_pass"), priority_ids(d))[1]


def bulk_status(d: Data):
    carried = d.calls.filter("ad_alt > 0").select("variant_id").distinct()
    return J.bulk_filter(carried, bulk_ids(d), priority_ids(d))


def master(d: Data):
    return P.master_table(bulk_status(d), first_status(d).select("variant_id", "statistical_status", "rho"), vep_once(d), verdicts(d),
                          second(d).select("variant_id", "germline_q"))


@query("master_table", """
SELECT variant_id, bulk_bulk_status, binom_statistical_status, round(binom_rho, 9) AS binom_rho, vep_filter_status, vep_filter_reason,
       pileup_pileup_verdict, round(second_germline_q, 6) AS second_germline_q,
       CASE WHEN e.n_carriers = 1 THEN 'singleton' WHEN e.n_carriers > 1 THEN 'shared' ELSE 'none' END AS split_class,
       CASE WHEN e.n_carriers > 1 THEN CASE WHEN e.hqstat THEN 'Yes' ELSE 'No' END ELSE '.' END AS split_retained,
       CASE WHEN e.hqstat THEN 'Yes' ELSE 'No' END AS split_hqstat, CASE WHEN e.qc THEN 'Yes' ELSE 'No' END AS split_qc,
       CASE WHEN e.depth THEN 'Yes' ELSE 'No' END AS split_depth, CASE WHEN e.phylogeny THEN 'Yes' ELSE 'No' END AS split_phylogeny
FROM {master} LEFT JOIN (SELECT variant_id, max(n_carriers) AS n_carriers, bool_or(hqstat) AS hqstat, bool_or(qc) AS qc, bool_or(depth) AS depth, bool_or(phylogeny) AS phylogeny
  FROM {cascade} GROUP BY 1) e USING (variant_id)""")
def master_table(d):
    cells = C.cascade_cells(saved_nvnr(d), second(d), verdicts(d))
    flags = cells.groupBy("variant_id").agg(F.min("class").alias("class"), F.bool_or("hqstat").alias("retained"),
                                            *[F.bool_or(s).alias(s) for s in ("hqstat", "qc", "depth", "phylogeny")])
    m = P.master_table(bulk_status(d), first_status(d).select("variant_id", "statistical_status", "rho"), vep_once(d), verdicts(d),
                       second(d).select("variant_id", "germline_q"), flags)
    return m.withColumns({"binom_rho": F.round("binom_rho", 9), "second_germline_q": F.round("second_germline_q", 6)})


@query("annotation_table", """
SELECT variant_id, vep_filter_status, bulk_bulk_status, binom_statistical_status, priority_variant, round(log10(greatest(second_germline_q, 1e-300)), 6) AS log10_q
FROM (SELECT m.*, CASE WHEN p.variant_id IS NULL THEN 'No' ELSE 'Yes' END AS priority_variant FROM {master} m LEFT JOIN (SELECT variant_id FROM {sites} WHERE pos % 12 = 0 OR pos % 7 = 1) p ON p.variant_id = m.variant_id)
WHERE priority_variant = 'Yes' OR (vep_filter_status = 'PASS' AND bulk_bulk_status = 'Pass' AND binom_statistical_status = 'Pass')""")
def annotation_table(d):
    m = J.annotate_priority(master(d), priority_ids(d))
    t = P.annotation_table(m)
    return t.select("variant_id", "vep_filter_status", "bulk_bulk_status", "binom_statistical_status", "priority_variant",
                    F.round(F.greatest("second_germline_q_log10", F.lit(-300.0)), 6).alias("log10_q"))


@query("upstream_counts", """
SELECT sample_id, stage, count(*) FILTER (WHERE keep AND length(ref) = length(alt)) AS n_snv, count(*) FILTER (WHERE keep AND length(ref) <> length(alt)) AS n_indel
FROM (SELECT sample_id, ref, alt, unnest(['pre_bulk', 'post_vep', 'post_bulk', 'post_binom']) AS stage,
        unnest([TRUE, coalesce(vep_filter_status = 'PASS', FALSE), coalesce(bulk_bulk_status = 'Pass', FALSE), coalesce(binom_statistical_status = 'Pass', FALSE)]) AS keep
      FROM {calls} LEFT JOIN {master} USING (variant_id) WHERE ad_alt > 0) GROUP BY 1, 2""")
def upstream_counts(d):
    return P.upstream_counts(d.calls, master(d))


VIEWS["funnel"] = """
SELECT stage, n_input, n_passing, n_input - n_passing AS n_removed, round(100.0 * n_passing / nullif(n_input, 0), 6) AS pct_of_input, round(100.0 * n_passing / total, 6) AS pct_of_total
FROM (SELECT total, unnest(['merged', 'population_filter', 'bulk_filter', 'statistical_filter', 'split_hqstat', 'split_qc', 'split_depth', 'split_phylogeny']) AS stage,
        unnest([total, total, vep, binom_in, u, h, q, dp]) AS n_input, unnest([total, vep, bulk, binom, h, q, dp, ph]) AS n_passing
      FROM (SELECT count(*) FILTER (WHERE vep_filter_status = 'PASS') AS vep, count(*) FILTER (WHERE bulk_bulk_status = 'Pass') AS bulk,
                   count(binom_statistical_status) AS binom_in, count(*) FILTER (WHERE binom_statistical_status = 'Pass') AS binom FROM {master}) m,
           (SELECT CAST(sum(scheme_unfiltered) AS BIGINT) AS u, CAST(sum(scheme_hqstat) AS BIGINT) AS h, CAST(sum(scheme_qc) AS BIGINT) AS q,
                   CAST(sum(scheme_depth) AS BIGINT) AS dp, CAST(sum(scheme_phylogeny) AS BIGINT) AS ph FROM {membership}) s, (SELECT count(*) AS total FROM {sites}) t)"""


def funnel(d: Data):
    return P.filter_funnel(master(d), d.sites, membership(d))


@query("filter_funnel", "SELECT * FROM {funnel}")
def filter_funnel(d):
    return funnel(d)


VIEWS["redundancy"] = """
SELECT n_variants, a AS both_pass, b AS stat_only, c AS qc_only, n_variants - a - b - c AS both_fail, a + b AS stat_pass, a + c AS qc_pass,
       round(coalesce(a / nullif(a + b + c, 0), 0), 4) AS jaccard, round(coalesce(a / nullif(a + b, 0), 0), 4) AS stat_kept_by_qc,
       round(coalesce(a / nullif(a + c, 0), 0), 4) AS qc_kept_by_stat,
       CASE WHEN b = 0 AND c = 0 THEN 'Fully redundant' WHEN b = 0 THEN 'QC redundant after HQStat' WHEN c = 0 THEN 'HQStat redundant after QC' ELSE 'Complementary' END AS verdict
FROM (SELECT count(*) AS n_variants, count(*) FILTER (WHERE h AND q) AS a, count(*) FILTER (WHERE h AND NOT q) AS b, count(*) FILTER (WHERE NOT h AND q) AS c
      FROM (SELECT scheme_hqstat = 1 AS h, coalesce(p.pileup_verdict = 'Pass', FALSE) AS q FROM {membership} m LEFT JOIN {pileup_verdicts} p USING (variant_id)))"""


def redundancy(d: Data):
    return P.filter_redundancy(membership(d), verdicts(d).filter("pileup_verdict = 'Pass'"))


@query("filter_redundancy", "SELECT * FROM {redundancy}")
def filter_redundancy(d):
    return redundancy(d)


VIEWS["influence"] = """
WITH x AS (SELECT variant_id, as_pass AS a, clip_pass AS c, bppos_pass AS b FROM {filtered} WHERE alt <> 'REF' AND variant_id IN (SELECT variant_id FROM {membership} WHERE scheme_hqstat = 1)),
v AS (SELECT variant_id, bool_or(a AND c AND b) AS f, bool_or(c AND b) AS na, bool_or(a AND b) AS nc, bool_or(a AND c) AS nb FROM x GROUP BY 1),
l AS (SELECT count(*) FILTER (WHERE f) AS f, count(*) FILTER (WHERE na) AS na, count(*) FILTER (WHERE nc) AS nc, count(*) FILTER (WHERE nb) AS nb FROM v)
SELECT 'variant_loo' AS section, 'candidate_full' AS key, f AS value FROM l UNION ALL SELECT 'variant_loo', 'AS_removes', na - f FROM l
UNION ALL SELECT 'variant_loo', 'PropClipped_removes', nc - f FROM l UNION ALL SELECT 'variant_loo', 'BPPos_removes', nb - f FROM l
UNION ALL SELECT 'cellvariant_gross', 'AS_fail', count(*) FILTER (WHERE NOT a) FROM x UNION ALL SELECT 'cellvariant_gross', 'PropClipped_fail', count(*) FILTER (WHERE NOT c) FROM x
UNION ALL SELECT 'cellvariant_gross', 'BPPos_fail', count(*) FILTER (WHERE NOT b) FROM x UNION ALL SELECT 'cellvariant_gross', 'evaluable', count(*) FROM x
UNION ALL SELECT 'cellvariant_combo', CASE WHEN a AND c AND b THEN 'pass_all_3' ELSE concat_ws(',', CASE WHEN NOT a THEN 'AS' END, CASE WHEN NOT c THEN 'Clip' END, CASE WHEN NOT b THEN 'BPPos' END) END, count(*) FROM x GROUP BY 2"""


def influence(d: Data):
    return P.filter_influence(d.saved("filtered", lambda: filtered(d)).filter("alt <> 'REF'"), membership(d))


@query("filter_influence", "SELECT * FROM {influence}")
def filter_influence(d):
    return influence(d)


@query("pileup_fail_classes", """
SELECT passes_somewhere, fail_class, count(*) AS n_cells FROM (
SELECT fail_class, bool_or(fail_class = 'Pass') OVER (PARTITION BY variant_id) AS passes_somewhere FROM (
SELECT variant_id, CASE WHEN as_pass AND clip_pass AND bppos_pass THEN 'Pass' WHEN NOT as_pass AND NOT clip_pass AND NOT bppos_pass THEN 'All three fail'
  ELSE concat_ws(' + ', CASE WHEN NOT as_pass THEN 'AS' END, CASE WHEN NOT clip_pass THEN 'Clipping' END, CASE WHEN NOT bppos_pass THEN 'BPPos' END) END AS fail_class
FROM {filtered} WHERE alt <> 'REF')) GROUP BY 1, 2""")
def pileup_fail_classes(d):
    return P.fail_class_summary(P.pileup_fail_classes(filtered(d).filter("alt <> 'REF'")))


@query("cohort_metrics", """
SELECT 'funnel' AS section, stage || '_' || k AS key, CAST(v AS STRING) AS value FROM (SELECT stage, unnest(['n_input', 'n_passing', 'n_filtered']) AS k, unnest([n_input, n_passing, n_removed]) AS v FROM {funnel})
UNION ALL SELECT 'scheme', stage || '_' || k, CAST(v AS STRING) FROM (SELECT stage, unnest(['snv', 'indel', 'total']) AS k, unnest([s, i, s + i]) AS v FROM (
  SELECT stage, count(DISTINCT variant_id) FILTER (WHERE length(ref) = 1 AND length(alt) = 1) AS s, count(DISTINCT variant_id) FILTER (WHERE NOT (length(ref) = 1 AND length(alt) = 1)) AS i FROM {staged} GROUP BY 1))
UNION ALL SELECT 'redundancy', k, v FROM (SELECT unnest(['n_variants', 'both_pass', 'verdict']) AS k, unnest([CAST(n_variants AS STRING), CAST(both_pass AS STRING), verdict]) AS v FROM {redundancy})
UNION ALL SELECT 'qc_' || section, key, CAST(value AS STRING) FROM {influence}""")
def cohort_metrics(d):
    return P.cohort_metrics(funnel(d), C.scheme_summary(staged(d)), redundancy(d).select("n_variants", "both_pass", "verdict"), influence(d))


@query("mandatory_status", f"""
SELECT variant_id, CASE WHEN m.variant_id IS NULL THEN 'No' ELSE 'Yes' END AS in_matrices, h AS hqstat, q AS qc, CASE WHEN h = 'Pass' AND q = 'Pass' THEN 'Yes' ELSE 'No' END AS passes_both
FROM (SELECT i.variant_id, m.variant_id AS mv, CASE WHEN scheme_hqstat IS NULL THEN 'NA' WHEN scheme_hqstat = 1 THEN 'Pass' ELSE 'Fail' END AS h,
  coalesce(p.pileup_verdict, 'NA') AS q FROM ({MANDATORY}) i LEFT JOIN {{membership}} m ON m.variant_id = i.variant_id LEFT JOIN {{pileup_verdicts}} p ON p.variant_id = i.variant_id)
LEFT JOIN {{membership}} m USING (variant_id)""")
def mandatory_status(d):
    return P.mandatory_status(mandatory_ids(d), membership(d), verdicts(d))


@query("cohort_burden", """
SELECT count(*) AS n_cells, count(*) FILTER (WHERE n > 0) AS n_cells_with_variant, min(n) AS min_variants, median(n) AS median_variants, round(avg(n), 6) AS mean_variants, max(n) AS max_variants
FROM (SELECT sample_id, count(*) FILTER (WHERE ad_alt > 2) AS n FROM {calls} GROUP BY 1)""")
def cohort_burden(d):
    return P.cohort_burden(d.calls.groupBy("sample_id").agg(F.count_if(F.col("ad_alt") > 2).alias("n_total")))
