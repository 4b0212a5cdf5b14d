"""Variant keys, genotypes, allele depths and their row-level classes."""

from pyspark.sql import functions as F

from catalog.base import query
from somaloom.functions import variants as V


@query("variant_id_roundtrip", """
SELECT variant_id, chrom || '_random_1' AS chrom, pos, ref, alt,
       chrom || '_random_1_' || CAST(pos AS STRING) || '_' || ref || '_' || alt AS long_id FROM {sites}""")
def variant_id_roundtrip(d):
    """Ids are built and parsed back, with underscores inside the contig name."""
    ids = d.sites.select(
        "variant_id",
        V.make_variant_id(F.concat("chrom", F.lit("_random_1")), "pos", "ref", "alt").alias("long_id"),
    )
    return V.with_variant_parts(ids, "long_id")


@query("split_multiallelic", """
SELECT chrom, pos, ref, unnest(string_split(alts, ',')) AS alt FROM (
  SELECT chrom, pos, ref, alt || ',' || ref || 'A,' || 'T' AS alts FROM {calls})""")
def split_multiallelic(d):
    many = d.calls.select("chrom", "pos", "ref", F.concat_ws(",", "alt", F.concat("ref", F.lit("A")), F.lit("T")).alias("alt"))
    return V.split_multiallelic(many)


@query("variant_class", """
SELECT variant_id, length(ref) = 1 AND length(alt) = 1 AS snv_strict, length(ref) = length(alt) AS snv_equal_length,
  CASE WHEN length(ref) = 1 AND length(alt) = 1 THEN 'SNP' WHEN length(ref) = 2 AND length(alt) = 2 THEN 'DBS' ELSE 'INDEL' END AS mut_type,
  CASE WHEN length(ref) = length(alt) AND length(ref) <= 2 THEN pos ELSE pos + length(ref) - 1 END AS pos_end
FROM (SELECT variant_id, pos, CASE WHEN pos % 5 = 0 THEN ref || 'C' ELSE ref END AS ref,
             CASE WHEN pos % 5 = 0 THEN substr(alt || 'GG', 1, 2) ELSE alt END AS alt FROM {sites})""")
def variant_class(d):
    s = d.sites.select(
        "variant_id", "pos",
        F.expr("CASE WHEN pos % 5 = 0 THEN ref || 'C' ELSE ref END AS ref"),
        F.expr("CASE WHEN pos % 5 = 0 THEN substr(alt || 'GG', 1, 2) ELSE alt END AS alt"),
    )
    return s.select(
        "variant_id", V.is_snv_strict().alias("snv_strict"), V.is_snv_equal_length().alias("snv_equal_length"),
        V.mutation_type().alias("mut_type"), V.mutation_end().alias("pos_end"),
    )


@query("alt_depth", """
SELECT variant_id, sample_id, CASE WHEN dp % 7 = 0 THEN 0 ELSE ad_alt END AS ad_alt FROM {calls}""")
def alt_depth(d):
    ad = F.when(F.col("dp") % 7 == 0, ".").otherwise(F.concat_ws(",", F.col("dp") - F.col("ad_alt"), F.col("ad_alt")))
    return d.calls.select("variant_id", "sample_id", V.alt_depth(ad).alias("ad_alt"))


_GT = "CASE WHEN dp % 11 = 0 THEN './.' WHEN dp % 11 = 1 THEN replace(gt, '/', '|') WHEN dp % 11 = 2 THEN '0/1/1' ELSE gt END"


@query("genotype_flags", f"""
SELECT variant_id, sample_id, gt, list_contains(a, '0') AS has_ref,
       len(list_filter(a, lambda x: x <> '0' AND x <> '.')) > 0 AS has_alt,
       list_contains(a, '0') AND len(list_filter(a, lambda x: x <> '0' AND x <> '.')) > 0 AS het,
       replace(gt, '|', '/') NOT IN ('0/0', './.', '.') AS non_ref,
       CASE WHEN gt = './.' THEN '0/0' ELSE gt END AS gt_filled
FROM (SELECT *, string_split(replace(gt, '|', '/'), '/') AS a FROM (SELECT variant_id, sample_id, {_GT} AS gt FROM {{calls}}))""")
def genotype_flags(d):
    g = d.calls.select("variant_id", "sample_id", F.expr(f"{_GT} AS gt"))
    return g.withColumns(V.gt_flags()).withColumn("gt_filled", V.fill_missing_gt())


@query("caller_verdict", """
SELECT variant_id, sample_id, CASE WHEN filter IN ('PASS', '.') THEN 0 ELSE 1 END AS mlv FROM {calls}""")
def caller_verdict(d):
    return d.calls.select("variant_id", "sample_id", V.caller_verdict().alias("mlv"))


@query("vaf", """
SELECT variant_id, sample_id, CASE WHEN nr > 0 THEN round(least(CAST(nv AS DOUBLE) / nr, 1.0), 6) ELSE 0.0 END AS vaf,
       CASE WHEN nr > 0 THEN round(least(CAST(nv AS DOUBLE) / nr, 1.0), 6) END AS vaf_or_null FROM {nvnr}""")
def vaf(d):
    from catalog.counts import nvnr

    return nvnr(d).select("variant_id", "sample_id", V.vaf().alias("vaf"), V.vaf(empty=None).alias("vaf_or_null"))


@query("bin_labels", """
SELECT variant_id, sample_id, CASE WHEN x >= 0.9 THEN 9 WHEN x >= 0.8 THEN 8 WHEN x >= 0.7 THEN 7 WHEN x >= 0.6 THEN 6
  WHEN x >= 0.5 THEN 5 WHEN x >= 0.4 THEN 4 WHEN x >= 0.3 THEN 3 WHEN x >= 0.2 THEN 2 WHEN x >= 0.1 THEN 1 ELSE 0 END AS decile,
  CASE WHEN dp >= 20 THEN '>=20' WHEN dp >= 10 THEN '10-19' WHEN dp >= 5 THEN '5-9' WHEN dp >= 1 THEN '1-4' END AS nr_class,
  CASE WHEN 100 * x >= 90 THEN '>=90' WHEN 100 * x >= 70 THEN '70-90' WHEN 100 * x >= 50 THEN '50-70' ELSE '<50' END AS support,
  CASE WHEN x < 0.25 THEN 'low' WHEN x < 0.5 THEN 'mid' ELSE 'high' END AS class
FROM (SELECT variant_id, sample_id, dp, CAST(ad_alt AS DOUBLE) / dp AS x FROM {calls})""")
def bin_labels(d):
    c = d.calls.withColumn("x", F.col("ad_alt").cast("double") / F.col("dp"))
    return c.select(
        "variant_id", "sample_id", V.vaf_decile("x").alias("decile"), V.nr_bin("dp").alias("nr_class"),
        V.support_bin(F.col("x") * 100).alias("support"),
        V.bin_label("x", [0, 0.25, 0.5, 1], ["low", "mid", "high"]).alias("class"),
    )


@query("alt_calls_only", """
SELECT DISTINCT chrom, pos, ref, alt FROM {calls} WHERE gt <> '0/0' AND alt <> 'NON_REF'""")
def alt_calls_only(d):
    from somaloom.operators.sets import alt_calls_only as keep

    return keep(d.calls, distinct_on=["chrom", "pos", "ref", "alt"]).select("chrom", "pos", "ref", "alt")


@query("digital_genotype", """
SELECT variant_id, sample_id, CASE WHEN nr = 0 THEN 'No depth' WHEN nv = 0 THEN '0/0'
  WHEN CAST(nv AS DOUBLE) / nr >= 0.8 THEN '1/1' ELSE '0/1' END AS digital_gt FROM {nvnr}""")
def digital_genotype(d):
    from catalog.counts import nvnr

    m = nvnr(d).withColumn("vaf", V.vaf(digits=None)).withColumn("call", (F.col("nv") > 0).cast("int"))
    return m.select("variant_id", "sample_id", V.digital_genotype().alias("digital_gt"))


@query("vaf_gt_discordance", """
SELECT variant_id, sample_id, round(CAST(ad_alt AS DOUBLE) / dp, 6) AS vaf, gt, verdict,
       round(avg(CASE WHEN verdict = 'Discordant' THEN 1.0 ELSE 0.0 END) OVER (), 6) AS discordant_proportion
FROM (SELECT *, CASE WHEN gt = '0/0' THEN 'Discordant' ELSE 'Concordant' END AS verdict FROM {calls})""")
def vaf_gt_discordance(d):
    from somaloom.operators.germline import vaf_gt_discordance as op

    return op(d.calls, nv="ad_alt", nr="dp").select("variant_id", "sample_id", "vaf", "gt", "verdict", "discordant_proportion")
