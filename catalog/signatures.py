"""Signature activities, mutation spectra and gene counts."""

from pyspark.sql import functions as F

from catalog.base import VIEWS, Data, query
from catalog.counts import nvnr, rounded
from catalog.joins import aligned
from somaloom.operators import expression as E
from somaloom.operators import signatures as S

VIEWS["called"] = """
SELECT variant_id, sample_id, chrom, pos, CASE WHEN pos % 7 = 0 THEN ref || 'A' ELSE ref END AS ref, CASE WHEN pos % 7 = 0 THEN substr(alt, 1, 1) || 'C' ELSE alt END AS alt,
       concat(substr('ACGT', CAST(pos % 3 + 1 AS INT), 1), ref, substr('TGCA', CAST(pos % 4 + 1 AS INT), 1)) AS context, CAST(nv > 0 AS INT) AS call FROM {nvnr}"""
VIEWS["vtable"] = """
SELECT *, CASE WHEN length(ref) = 1 AND length(alt) = 1 THEN 'SNP' WHEN length(ref) = 2 AND length(alt) = 2 THEN 'DBS' ELSE 'INDEL' END AS mut_type,
  CASE WHEN length(ref) = 1 AND length(alt) = 1 THEN CASE WHEN ref IN ('A', 'G') THEN translate(ref, 'ACGT', 'TGCA') || '>' || translate(alt, 'ACGT', 'TGCA') ELSE ref || '>' || alt END END AS sub,
  CASE WHEN ref IN ('A', 'G') THEN reverse(translate(context, 'ACGT', 'TGCA')) ELSE context END AS ctx FROM {called} WHERE call = 1"""
_CALLED = ["variant_id", "sample_id", "chrom", "pos", "CASE WHEN pos % 7 = 0 THEN ref || 'A' ELSE ref END AS ref", "CASE WHEN pos % 7 = 0 THEN substr(alt, 1, 1) || 'C' ELSE alt END AS alt",
           "concat(substr('ACGT', CAST(pos % 3 + 1 AS INT), 1), ref, substr('TGCA', CAST(pos % 4 + 1 AS INT), 1)) AS context", "CAST(nv > 0 AS INT) AS call"]


def called(d: Data):
    return nvnr(d).selectExpr(*_CALLED)


@query("signature_variant_table", """
SELECT 'P' AS project, sample_id, '.' AS id, 'GRCh38' AS genome, mut_type, chrom, pos AS pos_start, CASE WHEN mut_type = 'INDEL' THEN pos + length(ref) - 1 ELSE pos END AS pos_end, ref, alt, 'SOMATIC' AS type FROM {vtable}""")
def signature_variant_table(d):
    return S.variant_table(called(d), "P", "GRCh38")


@query("mutation_spectrum", """
SELECT sample_id, count(*) FILTER (WHERE mut_type = 'SNP') AS snp, count(*) FILTER (WHERE mut_type = 'DBS') AS dbs, count(*) FILTER (WHERE mut_type = 'INDEL') AS indel,
       """ + ", ".join(f"count(*) FILTER (WHERE sub = '{s}') AS \"{s.replace('>', '_to_')}\"" for s in S.SUBSTITUTIONS) + " FROM {vtable} GROUP BY 1")
def mutation_spectrum(d):
    return S.mutation_spectrum(S.variant_table(called(d), "P", "GRCh38"))


@query("context_counts", """
SELECT sample_id, substr(ctx, 1, 1) || '[' || sub || ']' || substr(ctx, 3, 1) AS context_class, count(*) AS n FROM {vtable} WHERE sub IS NOT NULL GROUP BY 1, 2""")
def context_counts(d):
    return S.context_counts(called(d).filter("call = 1"))


@query("merge_activities", "SELECT sample_id, signature, CAST(sum(activity) AS BIGINT) AS activity FROM {activity} GROUP BY 1, 2")
def merge_activities(d):
    return S.merge_activities(*[d.activity.filter(F.col("method") == m) for m in "ABC"])


@query("widen_activities", "SELECT sample_id, " + ", ".join(f"CAST(coalesce(sum(activity) FILTER (WHERE signature = 'SBS{i}'), 0) AS BIGINT) AS \"SBS{i}\"" for i in range(11)) + " FROM {activity} GROUP BY 1")
def widen_activities(d):
    return S.widen_activities(d.activity, [f"SBS{i}" for i in range(11)])


VIEWS["sigcov"] = """
SELECT v.sample_id, v.n AS input_variants, coalesce(a.n, 0) AS assigned, coalesce(a.n, 0) / CAST(v.n AS DOUBLE) AS proportion
FROM (SELECT sample_id, count(*) AS n FROM {vtable} GROUP BY 1) v LEFT JOIN (SELECT sample_id, CAST(sum(f) AS BIGINT) AS n FROM (SELECT sample_id, method, floor(sum(activity * 0.375::DOUBLE)) AS f FROM {activity} GROUP BY 1, 2) GROUP BY 1) a USING (sample_id)"""


def sigcov(d: Data):
    act = d.activity.select("sample_id", F.col("method").alias("mut_type"), (F.col("activity") * 0.375).alias("activity"))
    return S.signature_coverage(called(d).filter("call = 1"), act)


@query("signature_coverage", "SELECT sample_id, input_variants, assigned, round(proportion, 6) AS proportion FROM {sigcov}")
def signature_coverage(d):
    return rounded(sigcov(d), "proportion")


@query("cohort_assignment", "SELECT round(100.0 * sum(assigned) / sum(input_variants), 6) AS assigned_pct FROM {sigcov}")
def cohort_assignment(d):
    return rounded(S.cohort_assignment(sigcov(d)), "assigned_pct")


VIEWS["act"] = "SELECT sample_id, signature, CAST(sum(activity) AS BIGINT) AS activity FROM {activity} GROUP BY 1, 2"


def act(d: Data):
    return S.merge_activities(d.activity)


@query("signature_stats", """
SELECT signature, round(avg(x), 6) AS mean_activity, round(stddev_samp(x), 6) AS sd_activity, round(stddev_samp(x) / avg(x), 6) AS cv, count(*) FILTER (WHERE x > 0) AS n_active_samples
FROM (SELECT g.signature, s.sample_id, coalesce(a.activity, 0) AS x FROM (SELECT DISTINCT signature FROM {act}) g CROSS JOIN (SELECT DISTINCT sample_id FROM {act}) s LEFT JOIN {act} a ON a.signature = g.signature AND a.sample_id = s.sample_id) GROUP BY 1 HAVING avg(x) > 0""")
def signature_stats(d):
    return rounded(S.signature_stats(act(d)), "mean_activity", "sd_activity", "cv")


@query("signature_fraction", "SELECT sample_id, signature, activity, round(activity / greatest(sum(activity) OVER (PARTITION BY sample_id), 1e-9), 6) AS fraction FROM {act}")
def signature_fraction(d):
    return rounded(S.signature_fraction(act(d)), "fraction")


@query("cosine_similarity", "SELECT sample_id, round(sum(a * b) / (sqrt(sum(a * a)) * sqrt(sum(b * b))), 6) AS cosine FROM {aligned} GROUP BY 1")
def cosine_similarity(d):
    return rounded(S.cosine_similarity(aligned(d), "a", "b"), "cosine")


@query("detection_rate", """
SELECT signature, round(a, 6) AS a, round(b, 6) AS b, round(c, 6) AS c, round(greatest(a, b, c), 6) AS max_rate, CAST(a > 0 AS INT) + CAST(b > 0 AS INT) + CAST(c > 0 AS INT) AS n_methods
FROM (SELECT signature, 100 * avg(CASE WHEN a > 0 THEN 1.0 ELSE 0 END) AS a, 100 * avg(CASE WHEN b > 0 THEN 1.0 ELSE 0 END) AS b, 100 * avg(CASE WHEN c > 5 THEN 1.0 ELSE 0 END) AS c FROM {aligned} GROUP BY 1)""")
def detection_rate(d):
    a = aligned(d).withColumn("c", F.when(F.col("c") > 5, F.col("c")).otherwise(0))
    return rounded(S.detection_rate(a, ["a", "b", "c"]), "a", "b", "c", "max_rate")


_RANK = "rank() OVER ({p}ORDER BY {c}) + (count(*) OVER (PARTITION BY {q}{c}) - 1) / 2.0"


@query("method_correlation", f"""
SELECT round(corr(x, y), 6) AS pearson, round(corr(rx, ry), 6) AS spearman FROM (SELECT x, y, {_RANK.format(p='', q='', c='x')} AS rx, {_RANK.format(p='', q='', c='y')} AS ry
FROM (SELECT sample_id, sum(a) AS x, sum(b) AS y FROM {{aligned}} GROUP BY 1))""")
def method_correlation(d):
    return rounded(S.method_correlation(aligned(d), "a", "b"), "pearson", "spearman")


@query("signature_correlation", f"""
SELECT signature, round(corr(rx, ry), 6) AS spearman FROM (SELECT signature, {_RANK.format(p='PARTITION BY signature ', q='signature, ', c='a')} AS rx, {_RANK.format(p='PARTITION BY signature ', q='signature, ', c='b')} AS ry FROM {{aligned}}) GROUP BY 1""")
def signature_correlation(d):
    return rounded(S.signature_correlation(aligned(d), "a", "b", ["a", "b", "c"]), "spearman")


@query("bray_curtis", """
SELECT a.sample_id AS a, b.sample_id AS b, round(1 - 2.0 * sum(least(a.activity, b.activity)) / (any_value(ta.t) + any_value(tb.t)), 6) AS distance
FROM {act} a JOIN {act} b ON a.signature = b.signature AND a.sample_id < b.sample_id
JOIN (SELECT sample_id, sum(activity) AS t FROM {act} GROUP BY 1) ta ON ta.sample_id = a.sample_id JOIN (SELECT sample_id, sum(activity) AS t FROM {act} GROUP BY 1) tb ON tb.sample_id = b.sample_id GROUP BY 1, 2""")
def bray_curtis(d):
    return rounded(S.bray_curtis(act(d), block=7), "distance")


@query("signature_refit")
def signature_refit(d):
    catalog = d.orders.groupBy(F.concat(F.lit("P"), F.col("o_orderkey") % 4).alias("signature"), F.concat(F.lit("SBS"), (F.col("o_custkey") * F.col("o_orderkey")) % 11).alias("feature")).agg(F.count(F.lit(1)).cast("double").alias("weight"))
    return rounded(S.signature_refit(act(d).select("sample_id", F.col("signature").alias("feature"), F.col("activity").alias("n")), catalog), "activity", "cosine")


_PROJECT = "CASE WHEN sample_id < 'cell_09' THEN 'P1' ELSE 'P2' END"


@query("signature_refit_projects", f"""
WITH a AS (SELECT {_PROJECT} AS project, sample_id, signature AS feature, activity FROM {{act}}),
w AS (SELECT project, feature, CASE WHEN feature < CASE project WHEN 'P1' THEN 'SBS3' ELSE 'SBS7' END THEN 'low' ELSE 'high' END AS signature, CAST(length(feature) AS DOUBLE) AS weight
      FROM (SELECT DISTINCT p.project, f.feature FROM (SELECT DISTINCT project FROM a) p CROSS JOIN (SELECT DISTINCT feature FROM a) f))
SELECT s.project, s.sample_id, w.signature, round(sum(coalesce(a.activity, 0) * w.weight) / sum(w.weight * w.weight), 6) AS activity
FROM (SELECT DISTINCT project, sample_id FROM a) s JOIN w ON w.project = s.project LEFT JOIN a ON a.sample_id = s.sample_id AND a.feature = w.feature GROUP BY 1, 2, 3""")
def signature_refit_projects(d):
    """Two projects, each with a catalog of its own."""
    counts = act(d).select(F.expr(_PROJECT).alias("project"), "sample_id", F.col("signature").alias("feature"), F.col("activity").alias("n"))
    features = counts.select("feature").distinct().withColumn("project", F.explode(F.array(F.lit("P1"), F.lit("P2"))))
    cut = F.when(F.col("project") == "P1", "SBS3").otherwise("SBS7")
    catalog = features.select("project", "feature", F.when(F.col("feature") < cut, "low").otherwise("high").alias("signature"), F.length("feature").cast("double").alias("weight"))
    return rounded(S.signature_refit(counts, catalog, max_loss=-1.0, project="project").select("project", "sample_id", "signature", "activity"), "activity")


@query("signature_refit_disjoint", """
WITH w AS (SELECT signature AS feature, CASE WHEN signature < 'SBS3' THEN 'low' ELSE 'high' END AS signature, CAST(length(signature) AS DOUBLE) AS weight FROM (SELECT DISTINCT signature FROM {act}))
SELECT s.sample_id, w.signature, round(sum(coalesce(a.activity, 0) * w.weight) / sum(w.weight * w.weight), 6) AS activity
FROM (SELECT DISTINCT sample_id FROM {act}) s CROSS JOIN w LEFT JOIN {act} a ON a.sample_id = s.sample_id AND a.signature = w.feature GROUP BY 1, 2""")
def signature_refit_disjoint(d):
    """Signatures that share no class: each activity is the least-squares one by itself."""
    counts = act(d).select("sample_id", F.col("signature").alias("feature"), F.col("activity").alias("n"))
    catalog = counts.select("feature").distinct().select("feature", F.when(F.col("feature") < "SBS3", "low").otherwise("high").alias("signature"), F.length("feature").cast("double").alias("weight"))
    return rounded(S.signature_refit(counts, catalog, max_loss=-1.0).select("sample_id", "signature", "activity"), "activity")


@query("gene_matrix", "SELECT gene, " + ", ".join(f"CAST(coalesce(sum(n) FILTER (WHERE sample_id = 'cell_{i:02d}'), 0) AS BIGINT) AS cell_{i:02d}" for i in range(24)) + " FROM {expression} GROUP BY 1")
def gene_matrix(d):
    return E.gene_matrix(d.expression, [f"cell_{i:02d}" for i in range(24)])


_TWO_IDS = "SELECT sample_id, gene AS gene_id, concat('S', CAST(CAST(substr(gene, 2) AS INT) % 100 AS STRING)) AS gene, n FROM {expression}"


@query("gene_matrix_by_id", f"SELECT gene_id, gene, {', '.join(f"CAST(coalesce(sum(n) FILTER (WHERE sample_id = 'cell_{i:02d}'), 0) AS BIGINT) AS cell_{i:02d}" for i in range(24))} FROM ({_TWO_IDS}) GROUP BY 1, 2")
def gene_matrix_by_id(d):
    """Three ids share each symbol and keep a row each."""
    counts = d.expression.selectExpr("sample_id", "gene AS gene_id", "concat('S', CAST(substr(gene, 2) AS INT) % 100) AS gene", "n")
    return E.gene_matrix(counts, [f"cell_{i:02d}" for i in range(24)], ["gene_id", "gene"])


@query("housekeeping_cv", """
SELECT gene, round(stddev_samp(x) / avg(x), 6) AS cv FROM (SELECT g.gene, coalesce(e.n, 0) AS x FROM (SELECT DISTINCT gene FROM {expression} WHERE gene IN ('G1', 'G5', 'G77')) g
CROSS JOIN (SELECT DISTINCT sample_id FROM {expression}) s LEFT JOIN {expression} e ON e.gene = g.gene AND e.sample_id = s.sample_id) GROUP BY 1""")
def housekeeping_cv(d):
    return rounded(E.housekeeping_cv(d.expression, ["G1", "G5", "G77"]), "cv")


VIEWS["lognorm"] = """
WITH k AS (SELECT * FROM {expression} WHERE n > 0 AND sample_id IN (SELECT sample_id FROM {expression} WHERE n > 0 GROUP BY 1 HAVING count(*) > 200)),
f AS (SELECT * FROM k WHERE gene IN (SELECT gene FROM k GROUP BY 1 HAVING count(*) >= 5))
SELECT sample_id, gene, n, ln(n / sum(n) OVER (PARTITION BY sample_id) * 10000 + 1) AS value FROM f"""


@query("log_normalize", "SELECT sample_id, gene, n, round(value, 6) AS value FROM {lognorm}")
def log_normalize(d):
    return rounded(E.log_normalize(d.expression, 200, 5), "value")


@query("dispersion_topn", """
WITH g AS (SELECT gene, sum(value) / k AS mean, (sum(value * value) - sum(value) * sum(value) / k) / (k - 1) / (sum(value) / k) AS dispersion FROM {lognorm} CROSS JOIN (SELECT count(DISTINCT sample_id) AS k FROM {lognorm}) GROUP BY gene, k),
b AS (SELECT g.*, CAST(list_sum(list_transform(range(1, 20), lambda i: CAST(g.mean > lo + (hi - lo) * i / 20 AS INT))) AS INT) AS bin FROM g CROSS JOIN (SELECT min(mean) AS lo, max(mean) AS hi FROM g))
SELECT gene, round(mean, 6) AS mean, round(dispersion, 6) AS dispersion, bin, round(z, 6) AS z FROM (SELECT *, abs((dispersion - avg(dispersion) OVER (PARTITION BY bin)) / nullif(stddev_samp(dispersion) OVER (PARTITION BY bin), 0)) AS z FROM b)
ORDER BY z DESC NULLS LAST, gene LIMIT 50""")
def dispersion_topn(d):
    return rounded(E.dispersion_topn(E.log_normalize(d.expression, 200, 5), 50), "mean", "dispersion", "z")
