"""The staged allele-fraction cascade and its summaries."""

from pyspark.sql import functions as F

from catalog.base import VIEWS, Data, query
from catalog.counts import filtered, nvnr
from somaloom.operators import cascade as C
from somaloom.operators import germline_stats as G

VIEWS["pileup_verdicts"] = """
SELECT variant_id, CASE WHEN bool_or(variant_pass) THEN 'Pass' ELSE 'Fail' END AS pileup_verdict
FROM {filtered} WHERE alt <> 'REF' GROUP BY 1"""

VIEWS["evidence"] = """
SELECT * FROM (SELECT variant_id, sample_id, nv, nr, ref, alt, CASE WHEN nr > 0 THEN round(least(CAST(nv AS DOUBLE) / nr, 1), 6) ELSE 0.0 END AS vaf,
       count(*) FILTER (WHERE nv > 0) OVER (PARTITION BY variant_id) AS n_carriers FROM {nvnr}) WHERE n_carriers > 0"""

VIEWS["cascade"] = """
SELECT *, qc AND called > 0 AS depth, qc AND called > 0 AND covered >= 0.7 * cells AS phylogeny FROM (
SELECT *, hqstat AND coalesce(pileup_verdict = 'Pass', FALSE) AS qc, max(call) OVER (PARTITION BY variant_id) AS called,
       count(*) FILTER (WHERE nr >= 5) OVER (PARTITION BY variant_id) AS covered, count(*) OVER (PARTITION BY variant_id) AS cells FROM (
SELECT *, CAST(CASE WHEN n_carriers = 1 THEN nr >= 5 AND nv >= 3 AND vaf >= 0.3
            WHEN bool_or(nr >= 5 AND nv >= 3 AND vaf >= 0.3) OVER (PARTITION BY variant_id) THEN nr >= 5 AND nv >= 2 AND vaf >= 0.1
            ELSE nr >= 5 AND nv >= 3 AND vaf >= 0.3 END AS INT) AS call,
       n_carriers = 1 OR coalesce(rho >= 0.2 AND log10(greatest(germline_q, 1e-300)) <= -5, FALSE) AS hqstat
FROM {evidence} e LEFT JOIN (SELECT variant_id, rho, germline_q FROM {second}) s USING (variant_id)
LEFT JOIN {pileup_verdicts} p USING (variant_id))) c"""

VIEWS["staged"] = """
SELECT variant_id, sample_id, nr, nv, vaf, ref, alt, CAST(nv > 0 AS INT) AS call, 'unfiltered' AS stage FROM {cascade}
UNION ALL SELECT variant_id, sample_id, nr, nv, vaf, ref, alt, CAST(nv > 0 AS INT), 'hqstat' FROM {cascade} WHERE hqstat
UNION ALL SELECT variant_id, sample_id, nr, nv, vaf, ref, alt, call, 'qc' FROM {cascade} WHERE qc
UNION ALL SELECT variant_id, sample_id, nr, nv, vaf, ref, alt, call, 'depth' FROM {cascade} WHERE depth
UNION ALL SELECT variant_id, sample_id, nr, nv, vaf, ref, alt, call, 'phylogeny' FROM {cascade} WHERE phylogeny"""


def verdicts(d: Data):
    f = d.saved("filtered", lambda: filtered(d)).filter("alt <> 'REF'")
    return f.groupBy("variant_id").agg(F.when(F.bool_or("variant_pass"), "Pass").otherwise("Fail").alias("pileup_verdict"))


def second(d: Data):
    return d.saved("second", lambda: G.second_pass(saved_nvnr(d), q_cut=-2, rho_snv=0.01, rho_indel=0.05))


def saved_nvnr(d: Data):
    return d.saved("nvnr", lambda: nvnr(d))


def staged(d: Data, mandatory=None):
    return C.vaf_split(saved_nvnr(d), second(d), verdicts(d), mandatory)


def mandatory_ids(d: Data):
    return d.sites.filter("pos % 10 = 7").select("variant_id").unionAll(d.sites.selectExpr("variant_id || 'N' AS variant_id").filter("length(variant_id) % 2 = 0"))


MANDATORY = ("SELECT variant_id FROM {sites} WHERE pos % 10 = 7 UNION ALL "
             "SELECT variant_id || 'N' FROM {sites} WHERE length(variant_id || 'N') % 2 = 0")


@query("evidence_class", """
SELECT variant_id, sample_id, nv, nr, n_carriers, CASE WHEN n_carriers = 1 THEN 'singleton' ELSE 'shared' END AS class FROM {evidence}""")
def evidence_class(d):
    return C.with_evidence(nvnr(d)).select("variant_id", "sample_id", "nv", "nr", "n_carriers", "class")


@query("shared_retained", """
SELECT variant_id, n_carriers FROM (SELECT DISTINCT variant_id, n_carriers FROM {evidence}) JOIN {second} USING (variant_id)
WHERE n_carriers > 1 AND rho >= 0.2 AND log10(greatest(germline_q, 1e-300)) <= -5""")
def shared_retained(d):
    classes = C.with_evidence(saved_nvnr(d)).select("variant_id", "n_carriers", "class").distinct()
    joined = classes.join(second(d).select("variant_id", "rho", "germline_q"), "variant_id")
    return joined.filter((F.col("class") == "shared") & C.shared_retained(joined)).select("variant_id", "n_carriers")


@query("hqstat_set", "SELECT DISTINCT variant_id FROM {cascade} WHERE hqstat")
def hqstat_set(d):
    classes = C.with_evidence(saved_nvnr(d)).select("variant_id", "class").distinct()
    joined = classes.join(second(d).select("variant_id", "rho", "germline_q"), "variant_id", "left")
    return C.hqstat(joined).select("variant_id")


@query("anchor_call", "SELECT variant_id, sample_id, vaf, call FROM {cascade}")
def anchor_call(d):
    from somaloom.functions.variants import vaf

    return C.anchor_call(C.with_evidence(nvnr(d)).withColumn("vaf", vaf())).select("variant_id", "sample_id", "vaf", "call")


@query("called_and_covered", """
SELECT DISTINCT variant_id FROM (SELECT variant_id, called, count(*) FILTER (WHERE nr >= 4) OVER (PARTITION BY variant_id) AS covered, cells FROM {cascade})
WHERE called > 0 AND covered >= 0.7 * cells""")
def called_and_covered(d):
    from somaloom.functions.variants import vaf

    cells = C.anchor_call(C.with_evidence(nvnr(d)).withColumn("vaf", vaf()))
    return C.phylogeny_covered(C.called_somewhere(cells), C.CascadePreset(depth=4)).select("variant_id").distinct()


@query("append_mandatory", f"""
SELECT variant_id, sample_id, nv, nr, call FROM {{cascade}} WHERE called > 0
UNION ALL SELECT variant_id, sample_id, nv, nr, CAST(nv > 0 AS INT) FROM {{cascade}} WHERE called = 0 AND variant_id IN ({MANDATORY})""")
def append_mandatory(d):
    from somaloom.functions.variants import vaf

    cells = C.anchor_call(C.with_evidence(nvnr(d)).withColumn("vaf", vaf()))
    kept = C.called_somewhere(cells).select("variant_id", "sample_id", "nv", "nr", "call")
    return C.called_somewhere(C.append_mandatory(kept, cells, mandatory_ids(d)))


@query("vaf_split", "SELECT variant_id, sample_id, nr, nv, vaf, call, stage FROM {staged}")
def vaf_split(d):
    return staged(d)


@query("vaf_split_mandatory", f"""
SELECT stage, count(*) AS n_rows, CAST(sum(call) AS BIGINT) AS n_calls FROM (
  SELECT stage, call FROM {{staged}}
  UNION ALL SELECT 'depth_mandatory', CASE WHEN depth THEN call ELSE CAST(nv > 0 AS INT) END FROM {{cascade}} WHERE depth OR variant_id IN ({MANDATORY})
  UNION ALL SELECT 'phylogeny_mandatory', CASE WHEN phylogeny THEN call ELSE CAST(nv > 0 AS INT) END FROM {{cascade}} WHERE phylogeny OR variant_id IN ({MANDATORY}))
GROUP BY 1""")
def vaf_split_mandatory(d):
    return staged(d, mandatory_ids(d)).groupBy("stage").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("call").alias("n_calls"))


_COUNTS = """SELECT stage, sample_id, count(*) FILTER (WHERE call = 1 AND length(ref) = 1 AND length(alt) = 1) AS n_snv,
       count(*) FILTER (WHERE call = 1 AND NOT (length(ref) = 1 AND length(alt) = 1)) AS n_indel FROM {staged} GROUP BY 1, 2"""


@query("vaf_split_cell_counts", _COUNTS)
def vaf_split_cell_counts(d):
    return C.per_cell_counts(staged(d))


@query("scheme_summary", """
SELECT stage, n_snv, n_indel, n_snv + n_indel AS n_total, round(100.0 * n_snv / (n_snv + n_indel), 6) AS pct_snv FROM (
SELECT stage, count(DISTINCT variant_id) FILTER (WHERE length(ref) = 1 AND length(alt) = 1) AS n_snv,
       count(DISTINCT variant_id) FILTER (WHERE NOT (length(ref) = 1 AND length(alt) = 1)) AS n_indel FROM {staged} GROUP BY 1)""")
def scheme_summary(d):
    return C.scheme_summary(staged(d))


@query("scheme_sample_spread", f"""
SELECT stage, quantile_cont(n, 0.25) AS q25, quantile_cont(n, 0.5) AS median, quantile_cont(n, 0.75) AS q75,
       quantile_cont(n, 0.75) - quantile_cont(n, 0.25) AS iqr FROM (SELECT stage, n_snv + n_indel AS n FROM ({_COUNTS})) GROUP BY 1""")
def scheme_sample_spread(d):
    return C.scheme_sample_spread(C.per_cell_counts(staged(d)))


@query("unfiltered_gate", """
SELECT variant_id FROM {nvnr} GROUP BY 1 HAVING 100.0 * count(*) FILTER (WHERE nr >= 4) / count(*) >= 50 AND max(nv) > 0""")
def unfiltered_gate(d):
    return C.unfiltered_gate(nvnr(d), 4, 50)


_MEMBERSHIP = """SELECT s.variant_id, CAST(coalesce(max(e.nv), 0) > 0 AS INT) AS scheme_unfiltered, CAST(coalesce(bool_or(hqstat), FALSE) AS INT) AS scheme_hqstat,
       CAST(coalesce(bool_or(qc), FALSE) AS INT) AS scheme_qc, CAST(coalesce(bool_or(depth), FALSE) AS INT) AS scheme_depth,
       CAST(coalesce(bool_or(phylogeny), FALSE) AS INT) AS scheme_phylogeny
FROM {sites} s LEFT JOIN {cascade} e ON e.variant_id = s.variant_id GROUP BY 1"""
VIEWS["membership"] = _MEMBERSHIP


def membership(d: Data):
    return d.saved("membership", lambda: C.scheme_membership(saved_nvnr(d), second(d), verdicts(d)))


@query("scheme_membership", "SELECT * FROM {membership}")
def scheme_membership(d):
    return membership(d)


@query("scheme_subset", """
SELECT c.variant_id, c.sample_id, c.gt FROM {calls} c WHERE c.variant_id IN (SELECT variant_id FROM {membership} WHERE scheme_depth = 1)""")
def scheme_subset(d):
    return C.scheme_subset(d.calls, membership(d)).select("variant_id", "sample_id", "gt")
