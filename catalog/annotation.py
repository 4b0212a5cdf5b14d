"""Annotation expansion, population filter and verdicts."""

from pyspark.sql import functions as F

from catalog.base import VIEWS, Data, query
from somaloom.operators import annotation as A

VIEWS["verdict_rows"] = """
SELECT *, CASE clin_sig WHEN 'pathogenic' THEN 'Pathogenic' WHEN 'likely_pathogenic' THEN 'Likely_Pathogenic'
  WHEN 'uncertain_significance' THEN 'VUS' WHEN 'benign' THEN 'Benign' WHEN 'likely_benign' THEN 'Benign'
  ELSE CASE impact WHEN 'HIGH' THEN 'Deleterious' WHEN 'MODERATE' THEN 'Possibly_Deleterious' WHEN 'LOW' THEN 'Benign' ELSE 'Unknown' END END AS verdict
FROM {annotation}"""
VIEWS["population"] = """
SELECT variant_id, csq_no, max_af, existing, CASE WHEN max_af > 0.01 THEN 'REMOVED' ELSE 'PASS' END AS filter_status,
       CASE WHEN max_af > 0.01 THEN 'AF_filter' ELSE '.' END AS filter_reason FROM {annotation}"""
VIEWS["best"] = """
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY variant_id ORDER BY rank_score DESC, w DESC, csq_no) AS rn FROM (
SELECT *, w * 10 + CASE clin_sig WHEN 'pathogenic' THEN 8 WHEN 'likely_pathogenic' THEN 7 WHEN 'uncertain_significance' THEN 2
       WHEN 'likely_benign' THEN -2 WHEN 'benign' THEN -4 ELSE 0 END AS rank_score
FROM (SELECT *, CASE impact WHEN 'HIGH' THEN 4 WHEN 'MODERATE' THEN 3 WHEN 'LOW' THEN 2 ELSE 1 END AS w FROM {annotation}))) WHERE rn = 1"""


def best(d: Data):
    return A.best_annotation(d.annotation, tie="csq_no")


def population(d: Data):
    return A.population_filter(d.annotation, af=None)


@query("expand_csq", """
SELECT csq_no, variant_id, CASE k WHEN 0 THEN impact ELSE 'MODIFIER' END AS "IMPACT", CASE k WHEN 0 THEN symbol ELSE NULL END AS "SYMBOL",
       CASE k WHEN 0 THEN clin_sig END AS "CLIN_SIG" FROM (SELECT *, unnest(CASE WHEN csq_no % 5 = 0 THEN [0] ELSE [0, 1] END) AS k FROM {annotation}) WHERE csq_no % 11 <> 0
UNION ALL SELECT csq_no, variant_id, NULL, NULL, NULL FROM {annotation} WHERE csq_no % 11 = 0""")
def expand_csq(d):
    text = ("CASE WHEN csq_no % 11 = 0 THEN '' ELSE concat(impact, '|', symbol, '|', coalesce(clin_sig, ''), '|extra', "
            "CASE WHEN csq_no % 5 = 0 THEN '' ELSE ',MODIFIER' END) END AS csq")
    return A.expand_csq(d.annotation.selectExpr("csq_no", "variant_id", text), ["IMPACT", "SYMBOL", "CLIN_SIG"]).drop("csq_raw")


@query("gene_tokens", """
SELECT csq_no, variant_id, CASE WHEN consequence = 'intergenic_variant' THEN symbol || ',' || 'X' || csq_no || ',' || gene
  WHEN csq_no % 4 = 0 THEN 'NoGene' ELSE symbol || ',' || gene END AS genes_affected,
  CASE WHEN consequence = 'intergenic_variant' THEN 3 WHEN csq_no % 4 = 0 THEN 0 ELSE 2 END AS n_genes FROM {annotation}""")
def gene_tokens(d):
    rows = d.annotation.selectExpr(
        "csq_no", "variant_id", "consequence",
        "CASE WHEN consequence = 'intergenic_variant' THEN concat(symbol, '-X', csq_no) WHEN csq_no % 4 = 0 THEN '.' ELSE concat(symbol, '&', gene) END AS symbol",
        "CASE WHEN csq_no % 4 = 0 AND consequence <> 'intergenic_variant' THEN '' ELSE gene END AS gene")
    t = A.gene_tokens()
    return rows.select("csq_no", "variant_id", t["genes_affected"].alias("genes_affected"), t["n_genes"].alias("n_genes"))


@query("population_filter", "SELECT variant_id, csq_no, filter_status, filter_reason FROM {population}")
def population_filter(d):
    return population(d).select("variant_id", "csq_no", "filter_status", "filter_reason")


@query("population_filter_existing", """
SELECT variant_id, csq_no, CASE WHEN coalesce(max_af <= 0.01, TRUE) AND ev THEN 'PASS' ELSE 'REMOVED' END AS filter_status,
       CASE WHEN coalesce(max_af <= 0.01, TRUE) AND ev THEN '.' ELSE concat_ws(';', CASE WHEN NOT ev THEN 'existing_variation_filter' END,
         CASE WHEN max_af > 0.01 THEN 'AF_filter' END) END AS filter_reason
FROM (SELECT *, existing IS NULL OR existing NOT LIKE 'rs%' OR csq_no % 3 = 0 AS ev FROM {annotation})""")
def population_filter_existing(d):
    rows = d.annotation.withColumn("existing", F.expr("CASE WHEN csq_no % 3 = 0 THEN concat(existing, '&COSV9') ELSE existing END"))
    return A.population_filter(rows, use_existing=True, af=None).select("variant_id", "csq_no", "filter_status", "filter_reason")


@query("population_filter_af", """
SELECT variant_id, csq_no, CASE WHEN coalesce(greatest(a, b) <= 0.01, TRUE) AND coalesce(max_af <= 0.01, TRUE) THEN 'PASS' ELSE 'REMOVED' END AS filter_status
FROM (SELECT *, CAST(csq_no % 17 AS DOUBLE) / 1000 AS a, CASE WHEN csq_no % 4 <> 0 THEN CAST(csq_no % 23 AS DOUBLE) / 1000 END AS b FROM {annotation})""")
def population_filter_af(d):
    """Frequencies with one or two values; the larger counts."""
    a, b = "CAST(csq_no % 17 AS DOUBLE) / 1000", "CAST(csq_no % 23 AS DOUBLE) / 1000"
    rows = d.annotation.withColumn("af", F.expr(f"CASE WHEN csq_no % 4 <> 0 THEN concat({a}, '&', {b}) ELSE CAST({a} AS STRING) END"))
    return A.population_filter(rows).select("variant_id", "csq_no", "filter_status")


@query("clin_verdict", "SELECT variant_id, csq_no, verdict FROM {verdict_rows}")
def clin_verdict(d):
    return d.annotation.select("variant_id", "csq_no", A.clin_verdict().alias("verdict"))


@query("relevance_verdict", """
SELECT csq_no, variant_id,
  CASE WHEN trunc THEN 'truncating_splice' WHEN mis THEN 'missense_inframe' WHEN syn THEN 'synonymous' WHEN inter THEN 'intergenic_distal' ELSE 'other' END AS consequence_class,
  CASE WHEN lp THEN 'likely_pathogenic' WHEN pa THEN 'pathogenic' WHEN be THEN 'benign_family' WHEN co THEN 'conflicting_or_vus' ELSE 'unreported_or_other' END AS clin_summary,
  CASE WHEN pa OR lp THEN 'clinical_pathogenic' WHEN trunc THEN 'high_impact_truncating' WHEN impact IN ('HIGH', 'MODERATE') AND mis AND NOT be THEN 'damaging_coding'
       WHEN co THEN 'conflicting_classification' WHEN syn AND coalesce(max_af <= 0.001, TRUE) THEN 'synonymous_rare' WHEN inter THEN 'non_coding_intergenic' ELSE 'see_consequence' END AS evidence,
  CASE WHEN pa OR (lp AND (trunc OR impact = 'HIGH')) THEN 'Pathogenic'
       WHEN NOT be AND (lp OR trunc OR (impact = 'HIGH' AND (mis OR spl)) OR (impact = 'MODERATE' AND mis AND coalesce(max_af <= 0.001, TRUE))) THEN 'Deleterious'
       WHEN co THEN 'Uncertain' WHEN be OR (syn AND coalesce(max_af <= 0.05, TRUE)) THEN 'Benign' ELSE 'Other' END AS relevance
FROM (SELECT *, coalesce(clin_sig, '') = 'likely_pathogenic' AS lp, coalesce(clin_sig, '') = 'pathogenic' AS pa, coalesce(clin_sig, '') IN ('benign', 'likely_benign') AS be,
       coalesce(clin_sig, '') LIKE 'uncertain%' AS co, impact = 'HIGH' AND consequence IN ('frameshift_variant', 'splice_donor_variant') AS trunc,
       consequence = 'missense_variant' AS mis, consequence = 'synonymous_variant' AS syn, consequence = 'intergenic_variant' AS inter, consequence LIKE 'splice%' AS spl
      FROM {annotation})""")
def relevance_verdict(d):
    return A.relevance_verdict(d.annotation).select("csq_no", "variant_id", "consequence_class", "clin_summary", "evidence", "relevance")


@query("existing_variation_combined", """
SELECT csq_no, variant_id, CASE WHEN a IS NULL AND b IS NULL THEN 'NoRecord' ELSE concat_ws('|', a, b) END AS existing_variation_combined
FROM (SELECT csq_no, variant_id, existing AS a, CASE WHEN csq_no % 3 = 0 THEN concat('rs', CAST(csq_no AS STRING)) END AS b FROM {annotation})""")
def existing_variation_combined(d):
    second = F.expr("CASE csq_no % 3 WHEN 0 THEN concat(' rs', CAST(csq_no AS STRING)) WHEN 1 THEN ' ' END")
    rows = d.annotation.withColumn("vep_existing", second)
    return rows.select("csq_no", "variant_id", A.existing_variation_combined().alias("existing_variation_combined"))


@query("priority_variants", """
SELECT variant_id, csq_no, impact, verdict FROM {verdict_rows} WHERE variant_id IN (SELECT variant_id FROM {population} WHERE filter_status = 'PASS')
  AND ((impact = 'HIGH' AND verdict <> 'Benign') OR (verdict IN ('Pathogenic', 'Likely_Pathogenic') AND impact IN ('HIGH', 'MODERATE')))""")
def priority_variants(d):
    rows = d.annotation.select("variant_id", "csq_no", "impact", A.clin_verdict().alias("verdict"))
    return A.priority_variants(rows, population(d).filter("filter_status = 'PASS'"))


@query("impact_verdict_table", """
SELECT impact, count(*) FILTER (WHERE verdict = 'Benign') AS "Benign", count(*) FILTER (WHERE verdict = 'VUS') AS "VUS",
       count(*) FILTER (WHERE verdict = 'Pathogenic') AS "Pathogenic", count(*) FILTER (WHERE verdict = 'Likely_Pathogenic') AS "Likely_Pathogenic",
       count(*) FILTER (WHERE verdict = 'Deleterious') AS "Deleterious" FROM {verdict_rows} GROUP BY 1""")
def impact_verdict_table(d):
    rows = d.annotation.select("impact", A.clin_verdict().alias("verdict"))
    return A.impact_verdict_table(rows, ["Benign", "VUS", "Pathogenic", "Likely_Pathogenic", "Deleterious"])


@query("best_annotation", "SELECT variant_id, csq_no, impact, clin_sig, rank_score FROM {best}")
def best_annotation(d):
    return best(d).select("variant_id", "csq_no", "impact", "clin_sig", "rank_score")
