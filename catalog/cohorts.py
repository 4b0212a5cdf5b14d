"""Sparse counts of three cohorts: parts are sites, suppliers are cells, so both grow with the tables.

The twins build the full cell x variant grid of each cohort; the queries never do, but for the two that return it.
"""

from pyspark.sql import functions as F

from catalog.base import VIEWS, Data, query
from catalog.germline_stats import HALF, bh_ties, pbinom, rho_sql
from somaloom.functions.stats import log10_floored
from somaloom.operators import cohorts as K
from somaloom.operators import pileup as P
from somaloom.operators.cascade import CascadePreset

PRESET = CascadePreset(min_rho=0.01, max_log10_q=-1, depth=3, strict_reads=2, relaxed_reads=1, singleton_vaf=0.3, anchor_vaf=0.3, relaxed_vaf=0.1, covered_share=0.05)

VIEWS["cobs"] = """
SELECT r.*, CASE WHEN is_alt THEN alt ELSE 'REF' END AS allele,
       concat(chrom, '_', CAST(pos AS STRING), '_', ref, '_', CASE WHEN is_alt THEN alt ELSE ref END) AS allele_id,
       concat(chrom, '_', CAST(pos AS STRING), '_', ref, '_', alt) AS variant_id
FROM (SELECT concat('C', CAST(l_suppkey % 3 AS STRING)) AS cohort, concat('cell_', CAST(l_suppkey AS STRING)) AS sample_id,
       CASE WHEN l_partkey % 23 = 22 THEN 'chrX' ELSE concat('chr', CAST(l_partkey % 23 + 1 AS STRING)) END AS chrom,
       1000 + l_partkey * 37 AS pos, substr('ACGT', CAST(l_partkey % 4 + 1 AS INT), 1) AS ref,
       concat(substr('CGTA', CAST(l_partkey % 4 + 1 AS INT), 1), CASE WHEN l_partkey % 9 = 0 THEN 'TT' ELSE '' END) AS alt,
       CASE l_partkey % 5 WHEN 0 THEN l_linenumber % 2 = 1 WHEN 1 THEN l_suppkey % 2 = l_partkey % 2 AND l_linenumber <> 7
            WHEN 2 THEN l_suppkey % 3 = 1 AND l_linenumber >= 3 WHEN 3 THEN l_linenumber = 7 AND l_discount > 0.04 ELSE FALSE END AS is_alt,
       CASE WHEN l_linestatus = 'O' THEN 'R' ELSE 'F' END AS strand, CAST(20 + l_orderkey % 41 AS INT) AS mq, CAST(24 + l_linenumber * 3 AS INT) AS bq,
       CAST(floor(l_quantity * 3) AS INT) AS bp_start, CAST(round(128 + l_discount * 300) AS INT) AS aln_score, l_returnflag = 'A' AND l_tax > 0.05 AS clipped
FROM {lineitem}) r"""
VIEWS["ccells"] = "SELECT concat('C', CAST(s_suppkey % 3 AS STRING)) AS cohort, concat('cell_', CAST(s_suppkey AS STRING)) AS sample_id FROM {supplier}"
VIEWS["csizes"] = "SELECT cohort, count(*) AS n_cells FROM {ccells} GROUP BY 1"
VIEWS["centries"] = """
SELECT cohort, variant_id, sample_id, count(*) FILTER (WHERE mq >= 30 AND bq >= 30) AS nr, count(*) FILTER (WHERE is_alt AND mq >= 30 AND bq >= 30) AS nv
FROM {cobs} GROUP BY 1, 2, 3"""
VIEWS["cgrid"] = """
SELECT v.cohort, v.variant_id, c.sample_id, v.chrom, v.pos, v.ref, v.alt, coalesce(e.nv, 0) AS nv, coalesce(e.nr, 0) AS nr
FROM (SELECT DISTINCT cohort, variant_id, chrom, pos, ref, alt FROM {cobs}) v JOIN {ccells} c ON c.cohort = v.cohort
LEFT JOIN {centries} e ON e.cohort = v.cohort AND e.variant_id = v.variant_id AND e.sample_id = c.sample_id"""
VIEWS["cpvals"] = f"""
SELECT *, {pbinom('k', 'n', HALF)} AS p FROM (
SELECT cohort, variant_id, concat(cohort, '|', variant_id) AS id, chrom, ref, alt, CAST(sum(nv) AS BIGINT) AS k, CAST(sum(nr) AS BIGINT) AS n, avg(nr) AS mean_depth,
       count(*) FILTER (WHERE nv > 0) AS n_carriers FROM {{cgrid}} GROUP BY 1, 2, 3, 4, 5, 6)"""
_ID = "SELECT concat(cohort, '|', variant_id) AS variant_id, nv, {nr} AS nr FROM {{cgrid}}"
_TESTED = _ID.format(nr="greatest(nr, 1)") + " WHERE concat(cohort, '|', variant_id) IN (SELECT id FROM (" + bh_ties("p", "SELECT * FROM {cpvals}", "cohort, chrom") + ") WHERE q < 0.05 AND n_carriers > 1)"
VIEWS["cstats"] = f"SELECT v.*, r.rho FROM {{cpvals}} v LEFT JOIN ({rho_sql(_TESTED)}) r ON r.variant_id = v.id"
VIEWS["cverdicts"] = f"""
SELECT *, coalesce(log10(greatest(germline_q, 1e-300)) < -1, FALSE) AS germline_filter, rho IS NULL OR rho > 0.1 AS betabinom_filter
FROM ({bh_ties('p', 'SELECT * FROM {cstats}', 'cohort', 'germline_q')})"""
VIEWS["csecond"] = f"""
SELECT v.*, r.rho FROM ({bh_ties('p', 'SELECT * FROM {cpvals}', 'cohort, chrom', 'germline_q')}) v LEFT JOIN ({rho_sql(_ID.format(nr='nr'))}) r ON r.variant_id = v.id"""
VIEWS["cmetrics"] = VIEWS["metrics"].replace("{obs}", "{cobs}")
VIEWS["cfiltered"] = VIEWS["filtered"].replace("{metrics}", "{cmetrics}")
VIEWS["cpileup"] = """
SELECT c.cohort, f.variant_id, bool_or(as_pass AND clip_pass AND bppos_pass) AS passes FROM {cfiltered} f JOIN {ccells} c ON c.sample_id = f.sample_id
WHERE alt <> 'REF' GROUP BY 1, 2"""
VIEWS["ccascade"] = """
SELECT *, qc AND called > 0 AS depth, qc AND called > 0 AND covered >= 0.05 * cells AS phylogeny FROM (
SELECT *, hqstat AND coalesce(passes, FALSE) AS qc, max(call) OVER w AS called, count(*) FILTER (WHERE nr >= 3) OVER w AS covered, count(*) OVER w AS cells FROM (
SELECT *, CAST(CASE WHEN n_carriers = 1 THEN nr >= 3 AND nv >= 2 AND vaf >= 0.3 WHEN bool_or(nr >= 3 AND nv >= 2 AND vaf >= 0.3) OVER w
            THEN nr >= 3 AND nv >= 1 AND vaf >= 0.1 ELSE nr >= 3 AND nv >= 2 AND vaf >= 0.3 END AS INT) AS call,
       n_carriers = 1 OR coalesce(rho >= 0.01 AND log10(greatest(germline_q, 1e-300)) <= -1, FALSE) AS hqstat
FROM (SELECT g.*, CASE WHEN nr > 0 THEN round(least(CAST(nv AS DOUBLE) / nr, 1), 6) ELSE 0.0 END AS vaf, count(*) FILTER (WHERE nv > 0) OVER w AS n_carriers
      FROM {cgrid} g WINDOW w AS (PARTITION BY cohort, variant_id)) e
LEFT JOIN (SELECT cohort, variant_id, rho, germline_q FROM {csecond}) s USING (cohort, variant_id)
LEFT JOIN {cpileup} p USING (cohort, variant_id) WHERE n_carriers > 0 WINDOW w AS (PARTITION BY cohort, variant_id))
WINDOW w AS (PARTITION BY cohort, variant_id))"""
_STAGED = " UNION ALL ".join(
    f"SELECT cohort, variant_id, sample_id, nr, nv, vaf, ref, alt, {call} AS call, '{stage}' AS stage FROM {{ccascade}}{where}"
    for stage, call, where in (("unfiltered", "CAST(nv > 0 AS INT)", ""), ("hqstat", "CAST(nv > 0 AS INT)", " WHERE hqstat"), ("qc", "call", " WHERE qc"),
                               ("depth", "call", " WHERE depth"), ("phylogeny", "call", " WHERE phylogeny")))


def cells(d: Data):
    return K.number_cells(d.ccells)


def sparse(d: Data):
    """The one pass over the reads; every other query of a run starts from what it wrote."""
    return d.saved("sparse", lambda: K.compress(K.entries_from_obs(d.cobs), cells(d)))


def second(d: Data):
    return d.saved("csecond", lambda: K.second_pass(sparse(d), q_cut=-1, rho_snv=0.01, rho_indel=0.05))


def verdicts(d: Data):
    passed = P.variant_pass(P.artifact_filters(P.pileup_metrics(d.cobs, carry=["cohort"])), ["cohort"]).filter("alt <> 'REF'")
    return passed.groupBy("cohort", "variant_id").agg(P.pass_fail(F.bool_or("variant_pass")).alias("pileup_verdict"))


def flagged(d: Data):
    return d.saved("cflagged", lambda: K.cascade(sparse(d), second(d), verdicts(d), PRESET))


@query("cohort_cells", "SELECT cohort, sample_id, CAST(row_number() OVER (PARTITION BY cohort ORDER BY sample_id) AS INT) AS cell, CAST(count(*) OVER (PARTITION BY cohort) AS INT) AS n_cells FROM {ccells}")
def cohort_cells(d):
    return cells(d)


@query("cohort_sparse_counts", """
SELECT cohort, variant_id, chrom, pos, CAST(count(*) AS INT) AS n_cells, CAST(count(*) FILTER (WHERE nr > 0) AS INT) AS n_stored,
       coalesce(list(cell ORDER BY cell) FILTER (WHERE nr > 0), []) AS cells, coalesce(list(CAST(nv AS INT) ORDER BY cell) FILTER (WHERE nr > 0), []) AS nv,
       coalesce(list(CAST(nr AS INT) ORDER BY cell) FILTER (WHERE nr > 0), []) AS nr
FROM (SELECT *, CAST(dense_rank() OVER (PARTITION BY cohort ORDER BY sample_id) AS INT) AS cell FROM {cgrid}) GROUP BY 1, 2, 3, 4""")
def cohort_sparse_counts(d):
    return K.compress(K.entries_from_obs(d.cobs), cells(d)).select("cohort", "variant_id", "chrom", "pos", "n_cells", F.size("cells").alias("n_stored"), "cells", "nv", "nr")


@query("cohort_grid", "SELECT cohort, variant_id, sample_id, chrom, pos, ref, alt, CAST(nv AS INT) AS nv, CAST(nr AS INT) AS nr FROM {cgrid}")
def cohort_grid(d):
    return K.grid(K.compress(K.entries_from_obs(d.cobs), cells(d)), cells(d))


@query("cohort_entries_from_metrics", """
SELECT v.cohort, v.variant_id, m.sample_id, v.chrom, v.pos, v.ref, v.alt, m.nr, coalesce(a.nv, 0) AS nv
FROM (SELECT DISTINCT c.cohort, f.variant_id, f.chrom, f.pos, f.ref, f.alt FROM {cmetrics} f JOIN {ccells} c ON c.sample_id = f.sample_id WHERE f.alt <> 'REF') v
JOIN (SELECT DISTINCT c.cohort, f.sample_id, chrom, pos, depth_hq AS nr FROM {cmetrics} f JOIN {ccells} c ON c.sample_id = f.sample_id) m
  ON m.cohort = v.cohort AND m.chrom = v.chrom AND m.pos = v.pos
LEFT JOIN (SELECT sample_id, variant_id, n_hq_f + n_hq_r AS nv FROM {cmetrics}) a ON a.sample_id = m.sample_id AND a.variant_id = v.variant_id""")
def cohort_entries_from_metrics(d):
    return K.entries_from_metrics(d.saved("cmetrics", lambda: P.pileup_metrics(d.cobs, carry=["cohort"])))


@query("cohort_first_pass", """
SELECT cohort, variant_id, round(mean_depth, 6) AS mean_depth, n_carriers, round(log10(greatest(p, 1e-300)), 6) AS germline_p_log10, round(rho, 9) AS rho FROM {cstats}""")
def cohort_first_pass(d):
    s = K.first_pass(sparse(d))
    return s.select("cohort", "variant_id", F.round("mean_depth", 6).alias("mean_depth"), F.col("n_carriers").cast("long").alias("n_carriers"),
                    F.round(log10_floored("germline_p"), 6).alias("germline_p_log10"), F.round("rho", 9).alias("rho"))


@query("cohort_first_pass_verdict", """
SELECT cohort, variant_id, round(log10(greatest(germline_q, 1e-300)), 6) AS germline_q_log10, germline_filter, betabinom_filter,
       concat('TRUE_', upper(CAST(germline_filter AS STRING)), '_', upper(CAST(betabinom_filter AS STRING))) AS verdict FROM {cverdicts}""")
def cohort_first_pass_verdict(d):
    v = K.first_pass_verdict(K.first_pass(sparse(d)), q_cut=-1)
    return v.select("cohort", "variant_id", F.round(log10_floored("germline_q"), 6).alias("germline_q_log10"), "germline_filter", "betabinom_filter", "verdict")


@query("cohort_second_pass", """
SELECT cohort, variant_id, round(mean_depth, 6) AS mean_depth, round(log10(greatest(germline_q, 1e-300)), 6) AS germline_q_log10, round(rho, 9) AS rho,
       CASE WHEN log10(greatest(germline_q, 1e-300)) < -1 AND rho > CASE WHEN length(ref) > 1 OR length(alt) > 1 THEN 0.05 ELSE 0.01 END THEN 'Pass' ELSE 'Fail' END AS second_pass
FROM {csecond}""")
def cohort_second_pass(d):
    return second(d).select("cohort", "variant_id", F.round("mean_depth", 6).alias("mean_depth"), F.round(log10_floored("germline_q"), 6).alias("germline_q_log10"),
                            F.round("rho", 9).alias("rho"), "second_pass")


_CALLS = """SELECT cohort, variant_id, sample_id, CASE WHEN sum(CAST(is_alt AS INT)) = 0 THEN '0/0' WHEN sum(CAST(is_alt AS INT)) >= 0.8 * count(*) THEN '1/1' ELSE '0/1' END AS gt
FROM {cobs} GROUP BY cohort, variant_id, sample_id"""
VIEWS["ccalls"] = _CALLS


@query("cohort_prevalence", """
SELECT cohort, variant_id, count(*) FILTER (WHERE gt = '0/1') AS n_het, count(*) FILTER (WHERE gt <> '0/0') AS n_non_ref,
       round(100.0 * count(*) FILTER (WHERE gt = '0/1') / max(n_cells), 6) AS het_pct, round(CAST(count(*) FILTER (WHERE gt <> '0/0') AS DOUBLE) / max(n_cells), 6) AS prevalence
FROM {ccalls} JOIN {csizes} USING (cohort) GROUP BY 1, 2""")
def cohort_prevalence(d):
    p = K.prevalence(d.ccalls, cells(d))
    return p.select("cohort", "variant_id", "n_het", "n_non_ref", F.round("het_pct", 6).alias("het_pct"), F.round("prevalence", 6).alias("prevalence"))


@query("cohort_vaf_split", f"SELECT cohort, variant_id, sample_id, CAST(nr AS INT) AS nr, CAST(nv AS INT) AS nv, vaf, call, stage FROM ({_STAGED})")
def cohort_vaf_split(d):
    return K.vaf_split(flagged(d), cells(d))


@query("cohort_staged_entries", f"SELECT cohort, variant_id, stage, count(*) FILTER (WHERE nr > 0) AS n_entries, CAST(sum(call) AS BIGINT) AS n_calls FROM ({_STAGED}) GROUP BY 1, 2, 3")
def cohort_staged_entries(d):
    return K.staged(flagged(d)).groupBy("cohort", "variant_id", "stage").agg(F.count(F.lit(1)).alias("n_entries"), F.sum("call").alias("n_calls"))


@query("cohort_cell_counts", f"""
SELECT c.cohort, g.stage, c.sample_id, count(*) FILTER (WHERE call = 1 AND length(ref) = 1 AND length(alt) = 1) AS n_snv,
       count(*) FILTER (WHERE call = 1 AND NOT (length(ref) = 1 AND length(alt) = 1)) AS n_indel
FROM {{ccells}} c CROSS JOIN (SELECT unnest(['unfiltered', 'hqstat', 'qc', 'depth', 'phylogeny']) AS stage) g
LEFT JOIN ({_STAGED}) s ON s.cohort = c.cohort AND s.sample_id = c.sample_id AND s.stage = g.stage GROUP BY 1, 2, 3""")
def cohort_cell_counts(d):
    return K.cell_counts(flagged(d), cells(d))


_FUNNEL = ["SELECT cohort, 'first_pass_depth' AS stage, count(*) AS n_input, count(*) AS n_passing FROM {cverdicts} GROUP BY 1",
           "SELECT cohort, 'first_pass_germline', count(*), count(*) FILTER (WHERE germline_filter) FROM {cverdicts} GROUP BY 1",
           "SELECT cohort, 'first_pass_betabinom', count(*) FILTER (WHERE germline_filter), count(*) FILTER (WHERE germline_filter AND betabinom_filter) FROM {cverdicts} GROUP BY 1",
           "SELECT v.cohort, 'evidence', v.n, coalesce(e.n, 0) FROM (SELECT cohort, count(*) AS n FROM {cverdicts} GROUP BY 1) v LEFT JOIN (SELECT cohort, count(DISTINCT variant_id) AS n FROM {ccascade} GROUP BY 1) e ON e.cohort = v.cohort"]
_FUNNEL += [f"SELECT cohort, 'split_{b}', count(DISTINCT variant_id){'' if a == 'unfiltered' else f' FILTER (WHERE {a})'}, count(DISTINCT variant_id) FILTER (WHERE {b}) FROM {{ccascade}} GROUP BY 1"
            for a, b in (("unfiltered", "hqstat"), ("hqstat", "qc"), ("qc", "depth"), ("depth", "phylogeny"))]


@query("cohort_filter_funnel", f"""
SELECT f.cohort, stage, n_input, n_passing, n_input - n_passing AS n_removed, CASE WHEN n_input > 0 THEN round(100.0 * n_passing / n_input, 2) END AS pct_of_input,
       round(100.0 * n_passing / t.n, 2) AS pct_of_total
FROM ({' UNION ALL '.join(_FUNNEL)}) f JOIN (SELECT cohort, count(*) AS n FROM {{cverdicts}} GROUP BY 1) t ON t.cohort = f.cohort""")
def cohort_filter_funnel(d):
    return K.funnel(K.first_pass_verdict(K.first_pass(sparse(d)), q_cut=-1), flagged(d))


@query("cohort_scheme_membership", """
SELECT s.cohort, s.variant_id, CAST(count(e.nv) > 0 AS INT) AS scheme_unfiltered, CAST(coalesce(bool_or(hqstat), FALSE) AS INT) AS scheme_hqstat,
       CAST(coalesce(bool_or(qc), FALSE) AS INT) AS scheme_qc, CAST(coalesce(bool_or(depth), FALSE) AS INT) AS scheme_depth, CAST(coalesce(bool_or(phylogeny), FALSE) AS INT) AS scheme_phylogeny
FROM (SELECT DISTINCT cohort, variant_id FROM {cobs}) s LEFT JOIN {ccascade} e ON e.cohort = s.cohort AND e.variant_id = s.variant_id GROUP BY 1, 2""")
def cohort_scheme_membership(d):
    return K.membership(flagged(d), sparse(d))
