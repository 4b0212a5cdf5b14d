"""Keyed joins, id filters, intervals and set operators."""

from pyspark.sql import functions as F

from catalog.base import VIEWS, Data, query
from catalog.counts import nvnr
from somaloom.operators import joins as J
from somaloom.operators import sets as S

BULK = "SELECT variant_id FROM {sites} WHERE pos % 6 = 0"
PRIORITY = "SELECT variant_id FROM {sites} WHERE pos % 12 = 0 OR pos % 7 = 1"
VIEWS["bulk_status"] = f"""
SELECT variant_id, CASE WHEN variant_id NOT IN ({BULK}) THEN 'Pass' WHEN variant_id IN ({PRIORITY}) THEN 'Rescued' ELSE 'Fail' END AS bulk_status FROM {{sites}}"""


def bulk_ids(d: Data):
    return d.sites.filter("pos % 6 = 0").select("variant_id")


def priority_ids(d: Data):
    return d.sites.filter("pos % 12 = 0 OR pos % 7 = 1").select("variant_id")


@query("join_on_sample", """
SELECT a.sample_id, a.variant_id, a.dp, b.n_reads FROM {calls} a
JOIN (SELECT sample_id, count(*) AS n_reads FROM {obs} GROUP BY 1) b ON b.sample_id = a.sample_id""")
def join_on_sample(d):
    totals = d.obs.groupBy("sample_id").agg(F.count(F.lit(1)).alias("n_reads"))
    return J.join_on_sample(d.calls.select("sample_id", "variant_id", "dp"), totals)


@query("join_on_group", """
SELECT q.grp AS group_id, q.biosample, p.n_parts FROM {qc} q
JOIN (SELECT c_mktsegment AS grp, count(*) AS n_parts FROM {customer} GROUP BY 1) p ON p.grp = q.grp""")
def join_on_group(d):
    sizes = d.customer.groupBy(F.col("c_mktsegment").alias("group_id")).agg(F.count(F.lit(1)).alias("n_parts"))
    return J.join_on_group(d.qc.select(F.col("grp").alias("group_id"), "biosample"), sizes)


@query("group_chromosomes", """
SELECT grp AS group_id, unnest(list_concat(list_transform(range(1, 23), lambda i: 'chr' || i), ['chrX', 'chrEBV'])) AS chrom
FROM (SELECT DISTINCT grp FROM {qc})""")
def group_chromosomes(d):
    return J.group_chromosomes(d.qc.select(F.col("grp").alias("group_id")).distinct(), sex="female", extra=["chrEBV"])


@query("keep_chosen", f"SELECT variant_id, sample_id, gt FROM {{calls}} WHERE variant_id IN ({PRIORITY})")
def keep_chosen(d):
    return J.keep_chosen(d.calls.select("variant_id", "sample_id", "gt"), priority_ids(d))


@query("drop_listed", f"SELECT variant_id, sample_id, gt FROM {{calls}} WHERE variant_id NOT IN ({BULK})")
def drop_listed(d):
    return J.drop_listed(d.calls.select("variant_id", "sample_id", "gt"), bulk_ids(d))


@query("bulk_filter", "SELECT variant_id, bulk_status FROM {bulk_status}")
def bulk_filter(d):
    return J.bulk_filter(d.sites.select("variant_id"), bulk_ids(d), priority_ids(d))


@query("rescue_union", f"""
SELECT variant_id, pos, CASE WHEN pos % 5 = 0 THEN 'Pass' WHEN variant_id IN ({PRIORITY}) THEN 'Rescued' ELSE 'Fail' END AS statistical_status,
       pos % 5 = 0 OR variant_id IN ({PRIORITY}) AS chosen FROM {{sites}}""")
def rescue_union(d):
    chosen, tagged = J.rescue_union(d.sites.select("variant_id", "pos"), d.sites.filter("pos % 5 = 0"), priority_ids(d))
    return tagged.join(chosen.withColumn("chosen", F.lit(True)), "variant_id", "left").withColumn("chosen", F.coalesce("chosen", F.lit(False)))


@query("merge_mandatory", """
SELECT variant_id, impact, verdict FROM (SELECT DISTINCT variant_id, 'HIGH' AS impact, 'Pathogenic' AS verdict FROM {sites} WHERE pos % 9 = 1)
UNION ALL SELECT variant_id, '.', 'MandatoryVariant' FROM {sites} WHERE pos % 6 = 0 AND pos % 9 <> 1""")
def merge_mandatory(d):
    priority = d.sites.filter("pos % 9 = 1").select("variant_id", F.lit("HIGH").alias("impact"), F.lit("Pathogenic").alias("verdict"))
    return J.merge_mandatory(priority, bulk_ids(d))


@query("metrics_with_cnv", """
SELECT q.biosample, q.total_reads, coalesce(c.skew_cnv, 999.0) AS skew_cnv, coalesce(c.mapd_cnv_log2, 999.0) AS mapd_cnv_log2
FROM {qc} q LEFT JOIN (SELECT * FROM {qc} WHERE total_reads > 60000000) c ON c.biosample = q.biosample""")
def metrics_with_cnv(d):
    cnv = d.qc.filter("total_reads > 60000000").selectExpr("biosample", "CAST(skew_cnv AS STRING) AS skew_cnv", "CAST(mapd_cnv_log2 AS STRING) AS mapd_cnv_log2")
    return J.metrics_with_cnv(d.qc.select("biosample", "total_reads"), cnv, columns=["skew_cnv", "mapd_cnv_log2"])


@query("annotate_priority", f"""
SELECT s.variant_id, CASE WHEN p.variant_id IS NULL THEN '.' ELSE 'HIGH' END AS impact,
       CASE WHEN p.variant_id IS NULL THEN 'No' ELSE 'Yes' END AS priority_variant
FROM {{sites}} s LEFT JOIN ({PRIORITY}) p ON p.variant_id = s.variant_id""")
def annotate_priority(d):
    return J.annotate_priority(d.sites.select("variant_id"), priority_ids(d).withColumn("impact", F.lit("HIGH")))


@query("annotate_variants", """
SELECT c.sample_id, c.chrom, c.pos, c.ref, c.alt, t.tag FROM {calls} c
LEFT JOIN (SELECT chrom, pos, ref, alt, 'T' || (pos % 10) AS tag FROM {sites} WHERE pos % 3 = 0) t USING (chrom, pos, ref, alt)""")
def annotate_variants(d):
    tags = d.sites.filter("pos % 3 = 0").selectExpr("chrom", "pos", "ref", "alt", "concat('T', pos % 10) AS tag")
    return J.annotate_variants(d.calls.select("sample_id", "chrom", "pos", "ref", "alt"), tags)


TARGETS = "SELECT chrom, pos - 20 AS start, pos + 60 AS end_pos, 'target_' || pos AS target FROM {sites} WHERE pos % 4 = 0"


def targets(d: Data):
    return d.sites.filter("pos % 4 = 0").selectExpr("chrom", "pos - 20 AS start", "pos + 60 AS end", "concat('target_', pos) AS target")


@query("assign_intervals", f"""
SELECT c.sample_id, c.variant_id, t.target FROM {{calls}} c JOIN ({TARGETS}) t ON t.chrom = c.chrom AND c.pos BETWEEN t.start AND t.end_pos""")
def assign_intervals(d):
    return J.assign_intervals(d.calls, targets(d), width=50).select("sample_id", "variant_id", "target")


_SPANS = """SELECT p_partkey AS span_id, CASE WHEN (p_partkey % 400) % 23 = 22 THEN 'chrX' ELSE concat('chr', CAST((p_partkey % 400) % 23 + 1 AS STRING)) END AS chrom,
  CAST((p_partkey * 7919) % 20000 AS BIGINT) AS start, CAST((p_partkey * 7919) % 20000 + CASE p_partkey % 9 WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN 30 WHEN 3 THEN 500 WHEN 4 THEN 4000
  WHEN 5 THEN 60000 WHEN 6 THEN 1000000 WHEN 7 THEN 10000000 ELSE 100000000 END AS BIGINT) AS stop FROM {part}"""
VIEWS["spans"] = _SPANS


@query("assign_intervals_any_length", """
SELECT v.variant_id, s.span_id FROM {sites} v JOIN {spans} s ON s.chrom = v.chrom AND v.pos BETWEEN s.start AND s.stop""")
def assign_intervals_any_length(d):
    """Intervals of one base to a hundred million, none listed more than twice."""
    return J.assign_intervals(d.sites, d.spans.withColumnRenamed("stop", "end"), width=64).select("variant_id", "span_id")


@query("check_aligned", """
SELECT variant_id, sample_id, CASE WHEN dp % 5 = 0 THEN 'nv' ELSE 'nr' END AS missing_in FROM {calls} WHERE (dp % 5 = 0) <> (dp % 3 = 0)""")
def check_aligned(d):
    return J.check_aligned(d.calls.filter("dp % 3 <> 0"), d.calls.filter("dp % 5 <> 0")).select(
        "variant_id", "sample_id", F.when(F.col("missing_in") == "nr", "nr").otherwise("nv").alias("missing_in"))


VIEWS["aligned"] = """
SELECT s.sample_id, g.signature, coalesce(w.a, 0) AS a, coalesce(w.b, 0) AS b, coalesce(w.c, 0) AS c
FROM (SELECT sample_id FROM {activity} GROUP BY 1 HAVING count(DISTINCT method) = 3) s
CROSS JOIN (SELECT DISTINCT signature FROM {activity}) g
LEFT JOIN (SELECT sample_id, signature, CAST(sum(activity) FILTER (WHERE method = 'A') AS BIGINT) AS a, CAST(sum(activity) FILTER (WHERE method = 'B') AS BIGINT) AS b,
                  CAST(sum(activity) FILTER (WHERE method = 'C') AS BIGINT) AS c FROM {activity} GROUP BY 1, 2) w
  ON w.sample_id = s.sample_id AND w.signature = g.signature"""


def aligned(d: Data):
    return J.align_methods(d.activity, ["A", "B", "C"]).select(
        "sample_id", "signature", F.col("A").alias("a"), F.col("B").alias("b"), F.col("C").alias("c"))


@query("align_methods", "SELECT * FROM {aligned}")
def align_methods(d):
    return aligned(d)


@query("usable_samples", """
SELECT biosample, CASE WHEN total_reads % 7 = 0 THEN 'GROUP1' ELSE grp END AS grp, total_reads FROM {qc} WHERE total_reads > 0 AND skew_cnv IS NOT NULL""")
def usable_samples(d):
    meta = d.qc.selectExpr("biosample", "CASE WHEN total_reads % 7 = 0 THEN 'NA' ELSE concat(' ', grp) END AS grp", "total_reads")
    return J.usable_samples(d.qc.filter("skew_cnv IS NOT NULL"), d.qc.filter("total_reads > 0"), meta)


# ---- set, ordering and sampling operators ----------------------------------------------------------


@query("distinct_ids", "SELECT DISTINCT chrom, pos FROM {calls}")
def distinct_ids(d):
    return S.distinct_ids(d.calls, "chrom", "pos")


@query("union_ids", f"SELECT variant_id FROM ({BULK}) UNION SELECT variant_id FROM ({PRIORITY})")
def union_ids(d):
    return S.union_ids(bulk_ids(d), priority_ids(d))


@query("intersect_ids", f"SELECT variant_id FROM ({BULK}) INTERSECT SELECT variant_id FROM ({PRIORITY})")
def intersect_ids(d):
    return S.intersect_ids(bulk_ids(d), priority_ids(d))


@query("subtract_ids", f"SELECT variant_id FROM ({BULK}) EXCEPT SELECT variant_id FROM ({PRIORITY})")
def subtract_ids(d):
    return S.subtract_ids(bulk_ids(d), priority_ids(d))


@query("concat_rows", f"SELECT variant_id FROM ({BULK}) UNION ALL SELECT variant_id FROM ({PRIORITY})")
def concat_rows(d):
    return S.concat_rows(bulk_ids(d), priority_ids(d))


@query("branch", """
SELECT variant_id, sample_id, CASE WHEN dp > 20 THEN 'deep' WHEN ad_alt > 0 THEN 'alt' ELSE 'other' END AS stream FROM {calls}""")
def branch(d):
    streams = S.branch(d.calls, deep=F.col("dp") > 20, alt=F.col("ad_alt") > 0)
    return S.concat_rows(*[df.select("variant_id", "sample_id", F.lit(name).alias("stream")) for name, df in streams.items()])


@query("group_to_list", """
SELECT chrom, array_to_string(list_sort(list(DISTINCT sample_id)), ',') AS members FROM {calls} GROUP BY 1""")
def group_to_list(d):
    return S.group_to_list(d.calls, "chrom", "sample_id").withColumn("members", F.array_join("members", ","))


@query("order_natural", "SELECT variant_id, chrom, pos FROM {sites}")
def order_natural(d):
    return S.order_natural(d.sites.select("variant_id", "chrom", "pos"))


@query("top_n", "SELECT variant_id, sample_id, ad_alt FROM {calls} ORDER BY ad_alt DESC, variant_id, sample_id LIMIT 100")
def top_n(d):
    return S.top_n(d.calls.select("variant_id", "sample_id", "ad_alt"), "ad_alt", 100, "variant_id", "sample_id")


@query("order_by_total", "SELECT signature, CAST(sum(activity) AS BIGINT) AS total FROM {activity} GROUP BY 1 ORDER BY 2 DESC, 1")
def order_by_total(d):
    return S.order_by_total(d.activity, "signature", "activity")


@query("report_head", "SELECT signature, total FROM (SELECT signature, CAST(sum(activity) AS BIGINT) AS total FROM {activity} GROUP BY 1) ORDER BY total DESC, signature LIMIT 5")
def report_head(d):
    return S.head(S.order_by_total(d.activity, "signature", "activity"), 5)


def _drawn(key: str, seed: int) -> str:
    return f"CAST('0x' || substr(md5(CAST({key} AS STRING) || ':{seed}'), 1, 8) AS BIGINT)"


@query("cap_per_group", f"""
SELECT chrom, variant_id, sample_id FROM {{calls}}
QUALIFY row_number() OVER (PARTITION BY chrom ORDER BY {_drawn("(variant_id || '|' || sample_id)", 0)}, variant_id || '|' || sample_id) <= 50""")
def cap_per_group(d):
    rows = d.calls.withColumn("row_id", F.concat_ws("|", "variant_id", "sample_id"))
    return S.cap_per_group(rows, "chrom", 50, "row_id").select("chrom", "variant_id", "sample_id")


@query("subsample_to_target", f"""
WITH t AS (SELECT sample_id, count(*) AS total_reads FROM {{obs}} GROUP BY 1)
SELECT o.sample_id, t.total_reads, count(*) FILTER (WHERE t.total_reads <= 1000 OR {_drawn("o.read_id", 0)} < 1000.0 / t.total_reads * 4294967296) AS final_reads,
       t.total_reads > 1000 AS subsampled
FROM {{obs}} o JOIN t ON t.sample_id = o.sample_id GROUP BY ALL""")
def subsample_to_target(d):
    return S.subsample_to_target(d.obs, 1000)[1]


@query("hash_sample", f"SELECT read_id, sample_id, variant_id FROM {{obs}} WHERE {_drawn('read_id', 7)} < 0.25 * 4294967296")
def hash_sample(d):
    return S.hash_sample(d.obs, 0.25, "read_id", seed=7).select("read_id", "sample_id", "variant_id")


@query("has_rows", """
SELECT stream, count(*) AS n FROM (SELECT CASE WHEN length(ref) = length(alt) THEN 'snv' ELSE 'indel' END AS stream FROM {sites}) GROUP BY 1""")
def has_rows(d):
    kinds = {"snv": d.sites.filter("length(ref) = length(alt)"), "indel": d.sites.filter("length(ref) <> length(alt)"), "none": d.sites.filter("pos < 0")}
    kept = [df.select(F.lit(k).alias("stream")) for k, df in kinds.items() if S.has_rows(df)]
    return S.concat_rows(*kept).groupBy("stream").agg(F.count(F.lit(1)).alias("n"))
