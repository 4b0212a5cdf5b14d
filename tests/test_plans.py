"""The three end-to-end plans run on projected tables."""

from pyspark.sql import functions as F

from catalog.base import Data
from catalog.cnv import nbins
from catalog.signatures import called
from somaloom.plans import lineage, qc, somatic

SF = "/root/testdata/sf0.001"


def test_somatic_plan(spark):
    d = Data(spark, SF)
    bulk = d.sites.filter("pos % 6 = 0").select("variant_id")
    out = somatic.somatic_filter(d.obs, d.calls, d.annotation, bulk, germline_pct=40)
    stages = {r.stage: r.n_passing for r in out["funnel"].collect()}
    assert stages["merged"] == 200 and stages["population_filter"] >= stages["bulk_filter"] > 0
    assert stages["split_hqstat"] >= stages["split_qc"] >= stages["split_depth"]
    # only survivors of the first pass and priority variants are counted again
    ids = lambda df: {r.variant_id for r in df.select("variant_id").distinct().collect()}
    passed, priority = ids(out["first_pass"].filter("stat_pass")), ids(out["priority"])
    chosen = ids(out["bulk_status"].filter("bulk_status <> 'Fail'"))
    assert ids(out["second_pass"]) <= (passed | priority) & chosen and ids(out["counts"]) <= ids(out["first_pass"])
    records = d.annotation.groupBy("variant_id").agg(F.min(F.expr("CASE impact WHEN 'HIGH' THEN 0 WHEN 'MODERATE' THEN 1 WHEN 'LOW' THEN 2 ELSE 3 END")).alias("k"))
    assert out["population"].count() == out["population"].select("variant_id").distinct().count() <= records.count()
    for name in ("master", "annotation_table", "cell_counts", "germline_labels", "ado_intervals"):
        assert out[name].limit(1).count() == 1, name


def test_qc_plan(spark):
    d = Data(spark, SF)
    out = qc.copy_number(d.bins.withColumn("bin_end", F.col("bin_start") + 1000000), nbins(d).select("sample_id", "chrom", "bin_start", "segment"))
    assert out["summary"].count() == d.bins.select("sample_id").distinct().count() and out["segments"].columns[0] == "sample_id"
    status = {r.qc_status for r in qc.score_run(d.qc, "wgs").collect()}
    assert status <= {"PASS", "Borderline", "FAIL"}
    empty = qc.score_run(d.qc, "dna", d.qc.filter("total_reads > 0")).filter("total_reads = 0").collect()
    assert empty and all(r.qc_score is None and r.qc_status == "FAIL" for r in empty)


def test_lineage_plan(spark):
    d = Data(spark, SF)
    from catalog.counts import nvnr

    out = lineage.lineage_tables(nvnr(d), d.edge_tips)
    n_edges = d.edge_tips.select("edge_id").distinct().count()
    kept = nvnr(d).groupBy("sample_id").agg(F.sum("nr").alias("a"), F.sum("nv").alias("b")).filter("a > 0 AND b > 0").count()
    assert out["branch_lengths"].count() == n_edges and out["alignment"].count() == kept + 1
    c = called(d)
    catalog = c.filter("length(ref) = 1 AND length(alt) = 1").select("context", "ref", "alt").distinct()
    from somaloom.operators.signatures import context_class

    catalog = catalog.select(context_class().alias("feature"), F.concat(F.lit("S"), F.pmod(F.xxhash64("context"), F.lit(3))).alias("signature"), F.lit(1.0).alias("weight")).distinct()
    sig = lineage.signature_tables(c, catalog, "P", "GRCh38")
    assert sig["activities"].count() > 0 and sig["spectrum"].count() > 0
