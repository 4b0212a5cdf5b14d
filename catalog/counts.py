"""Pileup decoding, pileup metrics, artifact filters and count tables."""

from pyspark.sql import functions as F

from catalog.base import Data, query
from somaloom.operators import pileup as P


def nvnr(d: Data):
    """Full cell x site count grid, from one aggregation of the reads."""
    counts = P.allele_counts(d.obs)
    return P.complete_grid(counts, d.obs, ["variant_id"], ["nv", "nr"], carry=["chrom", "pos", "ref", "alt"]).select(
        "variant_id", "sample_id", "chrom", "pos", "ref", "alt", "nv", "nr")


def metrics(d: Data):
    return P.pileup_metrics(d.obs)


def filtered(d: Data):
    return P.variant_pass(P.artifact_filters(metrics(d)))


def rounded(df, *cols):
    return df.withColumns({c: F.round(c, 6) for c in cols})


def r6(*cols):
    """SQL select-list pieces rounding each column to six digits."""
    return ", ".join(f"round({c}, 6) AS {c}" for c in cols)


METRIC_DOUBLES = ("median_as", "prop_clipped", "prop_under_f", "prop_under_r", "prop_upper_f", "prop_upper_r",
                  "sd_f", "sd_r", "mad_f", "mad_r")


def packed_pileup(d: Data):
    """Each read becomes one packed pileup row of four observations: the read's own base
    behind a read-start mark, an insertion on the reverse strand, a deletion and a reference base."""
    start = "CASE read_id % 4 WHEN 0 THEN '^]' WHEN 1 THEN '^+' WHEN 2 THEN '^^' ELSE '^$' END"
    base = ("CASE WHEN NOT is_alt THEN CASE WHEN strand = 'F' THEN '.' ELSE ',' END "
            "WHEN strand = 'F' THEN substr(alt, 1, 1) ELSE lower(substr(alt, 1, 1)) END")
    return d.obs.selectExpr(
        "read_id", "sample_id", "chrom", "pos", "ref",
        f"CASE WHEN read_id % 13 = 0 THEN '' ELSE concat({start}, {base}, '$', ',+2ag', '*', '.-1c') END AS read_bases",
        "CASE WHEN read_id % 13 = 0 THEN '' ELSE concat(char(33 + bq), char(34), char(35), char(36)) END AS bq",
        "CASE WHEN read_id % 13 = 0 THEN '' ELSE concat(char(33 + mq), char(37), char(38), char(39)) END AS mq",
        "concat_ws(',', bp_start, '7', '8', '9') AS bp_start",
        "concat_ws(',', aln_score, '101', '102', '*') AS aln_score",
        "concat_ws(',', CASE WHEN clipped THEN '5S145M' ELSE '150M' END, '150M', '3H147M', '150M') AS cigar",
    )


@query("phred_decode", """
SELECT read_id, CASE WHEN read_id % 13 = 0 THEN [] ELSE [CAST(bq AS INT), 1, 2, 3] END AS bq,
       [CAST(bp_start AS INT), 7, 8, 9] AS bp_start FROM {obs}""")
def phred_decode(d):
    return packed_pileup(d).select("read_id", P.phred_decode("bq").alias("bq"), P.int_list("bp_start").alias("bp_start"))


@query("explode_pileup", """
SELECT read_id, CAST(k AS INT) AS read_no, sample_id, chrom, pos, ref,
  CASE WHEN empty THEN ['Z', 'A'][k + 1] WHEN k = 0 THEN CASE WHEN is_alt THEN substr(alt, 1, 1) ELSE 'REF' END
       WHEN k = 1 THEN '+2AG' WHEN k = 2 THEN 'DELREFCIGAR' ELSE '-1C' END AS allele,
  CASE WHEN empty THEN 'F' WHEN k = 0 THEN strand WHEN k = 1 THEN 'R' ELSE 'F' END AS strand,
  CASE WHEN empty THEN NULL WHEN k = 0 THEN mq ELSE k + 3 END AS mq,
  CASE WHEN empty THEN NULL WHEN k = 0 THEN bq ELSE k END AS bq,
  CASE WHEN k = 0 THEN bp_start ELSE k + 6 END AS bp_start,
  CASE WHEN k = 0 THEN aln_score WHEN k < 3 THEN 100 + k END AS aln_score,
  CASE WHEN k = 0 THEN clipped ELSE k = 2 END AS clipped,
  CASE WHEN empty THEN concat(chrom, '_', CAST(pos AS STRING), '_', ref, '_', ['Z', 'A'][k + 1])
       WHEN k = 0 THEN concat(chrom, '_', CAST(pos AS STRING), '_', ref, '_', CASE WHEN is_alt THEN substr(alt, 1, 1) ELSE ref END)
       WHEN k = 1 THEN concat(chrom, '_', CAST(pos AS STRING), '_', ref, '_', ref, 'AG')
       WHEN k = 2 THEN concat(chrom, '_', CAST(pos AS STRING), '_', ref, '_DELREFCIGAR')
       ELSE concat(chrom, '_', CAST(pos AS STRING), '_', ref, 'C_', ref) END AS variant_id
FROM (SELECT o.*, read_id % 13 = 0 AS empty, CAST(unnest([0, 1, 2, 3]) AS INT) AS k FROM {obs} o)
WHERE NOT empty OR k < 2""")
def explode_pileup(d):
    rows = P.explode_pileup(packed_pileup(d), keys=("read_id", "sample_id", "chrom", "pos", "ref"))
    return rows.withColumn("variant_id", P.pileup_variant_id()).drop("cigar")


@query("pileup_metrics", f"""
SELECT sample_id, variant_id, chrom, pos, ref, alt, n_all_f, n_all_r, n_hq_f, n_hq_r, depth_all, depth_hq,
       {r6(*METRIC_DOUBLES)} FROM {{metrics}}""")
def pileup_metrics(d):
    return rounded(metrics(d), *METRIC_DOUBLES)


@query("artifact_filters", "SELECT sample_id, variant_id, as_pass, clip_pass, bppos_pass FROM {filtered}")
def artifact_filters(d):
    return P.artifact_filters(metrics(d)).select("sample_id", "variant_id", "as_pass", "clip_pass", "bppos_pass")


@query("artifact_filters_no_bppos", """
SELECT sample_id, variant_id, as_pass, clip_pass, alt <> 'REF' AS bppos_pass FROM {filtered}""")
def artifact_filters_no_bppos(d):
    return P.artifact_filters(metrics(d), disable_bppos=True).select(
        "sample_id", "variant_id", "as_pass", "clip_pass", "bppos_pass")


@query("variant_pass", """
SELECT sample_id, variant_id, CASE WHEN as_pass THEN 'Pass' ELSE 'Fail' END AS as_filter,
       CASE WHEN variant_pass THEN 'Pass' ELSE 'Fail' END AS verdict FROM {filtered}""")
def variant_pass(d):
    return filtered(d).select("sample_id", "variant_id", P.pass_fail("as_pass").alias("as_filter"),
                              P.pass_fail("variant_pass").alias("verdict"))


_CHOSEN = "SELECT variant_id FROM {sites} WHERE pos % 4 <> 1"
_PRIORITY = "SELECT variant_id FROM {sites} WHERE pos % 7 = 2"


@query("pileup_status", f"""
SELECT sample_id, variant_id, CASE WHEN as_pass THEN 'Pass' ELSE 'Fail' END AS as_filter, CASE WHEN clip_pass THEN 'Pass' ELSE 'Fail' END AS propclipped_filter,
       CASE WHEN bppos_pass THEN 'Pass' ELSE 'Fail' END AS bppos_filter, CASE WHEN chosen AND kept THEN 'Pass' ELSE 'Fail' END AS depth_filter,
       CASE WHEN chosen AND NOT kept THEN 'Yes' ELSE 'No' END AS present_vcf_not_in_bam, CASE WHEN variant_pass AND NOT chosen THEN 'Yes' ELSE 'No' END AS present_bam_not_in_vcf,
       CASE WHEN chosen AND kept THEN 'Pass' ELSE 'Fail' END AS verdict
FROM (SELECT f.*, variant_id IN ({_CHOSEN}) AS chosen, variant_pass OR (alt <> 'REF' AND variant_id IN ({_PRIORITY})) AS kept FROM {{filtered}} f)""")
def pileup_status(d):
    rows = P.pileup_status(filtered(d), d.sites.filter("pos % 4 <> 1"), d.sites.filter("pos % 7 = 2"))
    return rows.select("sample_id", "variant_id", "as_filter", "propclipped_filter", "bppos_filter", "depth_filter",
                       "present_vcf_not_in_bam", "present_bam_not_in_vcf", "verdict")


@query("prefilter_aggregate", """
SELECT variant_id, count(*) AS n_cells, min(chrom) AS chrom, min(pos) AS pos, min(ref) AS ref, min(alt) AS alt,
       round(avg(n_hq_f), 4) AS mean_n_hq_f, round(avg(median_as), 4) AS mean_median_as, round(avg(sd_r), 4) AS mean_sd_r,
       round(avg(depth_hq), 4) AS mean_depth_hq,
       count(*) FILTER (WHERE as_pass) AS n_as_pass, count(*) FILTER (WHERE clip_pass) AS n_clip_pass,
       count(*) FILTER (WHERE bppos_pass) AS n_bppos_pass, CASE WHEN bool_or(variant_pass) THEN 'Pass' ELSE 'Fail' END AS verdict
FROM {filtered} WHERE alt <> 'REF' GROUP BY variant_id""")
def prefilter_aggregate(d):
    return P.prefilter_aggregate(filtered(d)).select(
        "variant_id", "n_cells", "chrom", "pos", "ref", "alt", "mean_n_hq_f", "mean_median_as", "mean_sd_r",
        "mean_depth_hq", "n_as_pass", "n_clip_pass", "n_bppos_pass", "verdict")


@query("nv_nr_long", """
SELECT v.variant_id, s.sample_id, v.chrom, v.pos, v.ref, v.alt, coalesce(a.n_hq_f + a.n_hq_r, 0) AS nv, coalesce(p.depth_hq, 0) AS nr
FROM (SELECT DISTINCT variant_id, chrom, pos, ref, alt FROM {filtered} WHERE alt <> 'REF' AND variant_pass) v CROSS JOIN {samples} s
LEFT JOIN {metrics} a ON a.variant_id = v.variant_id AND a.sample_id = s.sample_id
LEFT JOIN (SELECT DISTINCT sample_id, chrom, pos, depth_hq FROM {metrics}) p
  ON p.sample_id = s.sample_id AND p.chrom = v.chrom AND p.pos = v.pos""")
def nv_nr_long(d):
    f = filtered(d)
    return P.nv_nr_long(f, f.filter("variant_pass").select("variant_id").distinct())


@query("complete_grid", "SELECT variant_id, sample_id, chrom, pos, ref, alt, nv, nr FROM {nvnr}")
def complete_grid(d):
    return nvnr(d)


@query("locus_depth", """
SELECT c.sample_id, c.variant_id, c.chrom, c.pos, coalesce(m.nr, 0) AS nr FROM {calls} c
LEFT JOIN (SELECT sample_id, chrom, pos, count(*) AS nr FROM {obs} WHERE mq >= 50 AND bq >= 36 GROUP BY ALL) m
  ON m.sample_id = c.sample_id AND m.chrom = c.chrom AND m.pos = c.pos""")
def locus_depth(d):
    depth = d.obs.filter("mq >= 50 AND bq >= 36").groupBy("sample_id", "chrom", "pos").agg(F.count(F.lit(1)).alias("nr"))
    return P.locus_depth(d.calls.select("sample_id", "variant_id", "chrom", "pos"), depth)


@query("attach_cigar", """
SELECT o.qname, o.flag, o.variant_id, a.cigar
FROM (SELECT read_id AS qname, CASE WHEN strand = 'R' THEN 16 ELSE 0 END AS flag, variant_id FROM {obs}) o
LEFT JOIN (SELECT read_id AS qname, CASE WHEN strand = 'R' THEN 16 ELSE 0 END AS flag,
                  min(CASE WHEN clipped THEN '5S145M' ELSE '150M' END) AS cigar
           FROM {obs} WHERE mq >= 25 GROUP BY 1, 2) a ON a.qname = o.qname AND a.flag = o.flag""")
def attach_cigar(d):
    keyed = d.obs.selectExpr("read_id AS qname", "CASE WHEN strand = 'R' THEN 16 ELSE 0 END AS flag", "variant_id", "mq", "clipped")
    alignments = keyed.filter("mq >= 25").selectExpr("qname", "flag", "CASE WHEN clipped THEN '5S145M' ELSE '150M' END AS cigar")
    return P.attach_cigar(keyed.drop("mq", "clipped"), alignments)


_FOCAL = "SELECT variant_id, chrom, pos FROM {sites} WHERE pos % 3 <> 0 UNION ALL SELECT variant_id || 'T', chrom, pos FROM {sites} WHERE pos % 5 = 0"
_FOCAL_PILEUP = f"""
SELECT sample_id, focal_id AS variant_id, chrom, pos, CASE WHEN k = 2 THEN 'REF' ELSE alt END AS alt,
       CASE WHEN k = 2 THEN 0 ELSE n_hq_f END AS n_hq_f, CASE WHEN k = 2 THEN 0 ELSE n_hq_r END AS n_hq_r, depth_hq, as_pass
FROM (SELECT *, row_number() OVER (PARTITION BY sample_id, focal_id ORDER BY k, variant_id) AS rn
      FROM (SELECT m.*, f.variant_id AS focal_id, CASE WHEN m.variant_id = f.variant_id THEN 0 WHEN alt = 'REF' THEN 1 ELSE 2 END AS k
            FROM {{filtered}} m JOIN ({_FOCAL}) f ON f.chrom = m.chrom AND f.pos = m.pos)) WHERE rn = 1"""


def focal_ids(d):
    s = d.sites
    return s.filter("pos % 3 <> 0").select("variant_id", "chrom", "pos").unionAll(
        s.filter("pos % 5 = 0").selectExpr("variant_id || 'T' AS variant_id", "chrom", "pos"))


@query("focal_pileup", f"SELECT sample_id, variant_id, chrom, pos, alt, n_hq_f, n_hq_r, depth_hq FROM ({_FOCAL_PILEUP})")
def focal_pileup(d):
    return P.focal_pileup(filtered(d), focal_ids(d)).select(
        "sample_id", "variant_id", "chrom", "pos", "alt", "n_hq_f", "n_hq_r", "depth_hq")


@query("sample_annotation", f"""
SELECT t.variant_id, s.sample_id, CASE WHEN p.alt = 'REF' THEN 0 ELSE p.n_hq_f END AS sample_n_hq_f, p.depth_hq AS sample_depth_hq
FROM (SELECT DISTINCT variant_id FROM ({_FOCAL})) t CROSS JOIN (SELECT DISTINCT sample_id FROM ({_FOCAL_PILEUP})) s
LEFT JOIN ({_FOCAL_PILEUP}) p ON p.variant_id = t.variant_id AND p.sample_id = s.sample_id""")
def sample_annotation(d):
    focal = P.focal_pileup(filtered(d), focal_ids(d))
    return P.sample_annotation(focal, focal_ids(d).select("variant_id").distinct(), ["n_hq_f", "depth_hq"])


@query("one_row_per_allele", """
SELECT sample_id, chrom, pos, alt, n_hq_f FROM (
  SELECT *, row_number() OVER (PARTITION BY sample_id, chrom, pos ORDER BY CASE WHEN alt = 'REF' THEN 1 ELSE 0 END, alt) AS rn FROM {metrics}) WHERE rn = 1""")
def one_row_per_allele(d):
    return P.one_row_per_allele(metrics(d).select("sample_id", "chrom", "pos", "alt", "n_hq_f"), ("sample_id", "chrom", "pos"))


@query("locus_max_depth", """
SELECT sample_id, variant_id, max(CASE WHEN alt <> 'REF' THEN depth_hq ELSE 0 END) OVER (PARTITION BY sample_id, chrom, pos) AS nr FROM {metrics}""")
def locus_max_depth(d):
    own = metrics(d).withColumn("depth_hq", F.when(F.col("alt") != "REF", F.col("depth_hq")))
    return P.locus_max_depth(own).select("sample_id", "variant_id", "nr")
