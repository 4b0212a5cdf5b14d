"""Text sources and sinks, over text that Spark renders from the given tables."""

import uuid

from pyspark.sql import functions as F

from catalog.base import Data, query, spread
from catalog.counts import nvnr
from somaloom.session import checkpoint_root
from somaloom.sources import block_gzip as B
from somaloom.sources import reports as R
from somaloom.sources import sheets as S
from somaloom.sources import sinks as K
from somaloom.sources import vcf as X


def scratch(d: Data, name: str) -> str:
    return f"{checkpoint_root(d.spark)}/{name}-{uuid.uuid4().hex}"


@query("sample_sheet", """
SELECT biosample, CASE WHEN total_reads % 7 = 0 THEN 'GROUP1' ELSE grp END AS "group", CASE WHEN total_reads % 5 = 0 THEN NULL ELSE 's3/' || biosample END AS vcf FROM {qc}""")
def sample_sheet(d):
    """A sheet is written as CSV (byte-order mark, padded names and values) and read back."""
    path = scratch(d, "sheet")
    d.qc.selectExpr("concat(' ', biosample, ' ') AS `﻿biosampleName`", "CASE WHEN total_reads % 7 = 0 THEN '' ELSE grp END AS groups",
                    "CASE WHEN total_reads % 5 = 0 THEN ' ' ELSE concat('s3/', biosample) END AS ` vcf`").write.option("header", True).csv(path)
    return S.read_sample_sheet(d.spark, path)


@query("split_lanes", """
SELECT biosample, CAST(unnest([0, 1, 2]) AS INT) AS lane, unnest([biosample || '_L1_R1', biosample || '_L2_R1', biosample || '_L3_R1']) AS read1, unnest([biosample || '_L1_R2', biosample || '_L2_R2', biosample || '_L3_R2']) AS read2 FROM {qc}""")
def split_lanes(d):
    sheet = d.qc.select("biosample", *[F.concat_ws("|", *[F.concat("biosample", F.lit(f"_L{i}_R{r}")) for i in (1, 2, 3)]).alias(f"read{r}") for r in (1, 2)])
    return S.split_lanes(sheet)


def vcf_lines(d: Data):
    """The calls rendered as one call file per cell."""
    head = d.calls.select("sample_id").distinct().select(
        F.col("sample_id").alias("file"), F.explode(F.array(F.lit("##fileformat=VCFv4.2"), F.concat(F.lit("#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\t"), F.col("sample_id")))).alias("value"))
    ad = F.concat(F.col("dp") - F.col("ad_alt"), F.lit(","), F.col("ad_alt"))
    short = F.col("dp") % 3 == 0
    body = d.calls.select(F.col("sample_id").alias("file"), F.concat_ws(
        "\t", "chrom", F.col("pos").cast("string"), F.lit("."), "ref", "alt", F.lit("50"), "filter", F.concat(F.lit("DP="), F.col("dp"), F.lit(";SOMATIC;AF=.")),
        F.when(short, "GT:AD:DP:GQ").otherwise("GT:DP"), F.when(short, F.concat_ws(":", "gt", ad, F.col("dp").cast("string"))).otherwise(F.concat_ws(":", "gt", F.col("dp").cast("string")))).alias("value"))
    return head.unionByName(body)


@query("parse_vcf", """
SELECT variant_id, sample_id, chrom, pos, ref, alt, filter, gt AS fmt_gt, CASE WHEN dp % 3 = 0 THEN (dp - ad_alt) || ',' || ad_alt END AS fmt_ad, CAST(dp AS STRING) AS fmt_dp,
       NULL::STRING AS fmt_gq, CAST(dp AS STRING) AS info_dp, NULL::STRING AS info_af FROM {calls}""")
def parse_vcf(d):
    rows = X.vcf_fields(X.parse_vcf(vcf_lines(d)), ["DP", "AF"], ["GT", "AD", "DP", "GQ"])
    return rows.drop("file", "id", "qual")


@query("read_vcf", "SELECT sample_id, count(*) AS n_records, CAST(sum(dp) AS BIGINT) AS dp FROM {calls} GROUP BY 1")
def read_vcf(d):
    """Call files on disk, one per cell, read in one scan."""
    path = scratch(d, "vcf")
    lines = vcf_lines(d)
    lines.repartition("file").sortWithinPartitions("file", ~F.col("value").startswith("#"), F.col("value")).write.partitionBy("file").text(path)
    rows = X.vcf_fields(X.read_vcf(d.spark, path), fmt=["DP"])
    return rows.groupBy("sample_id").agg(F.count(F.lit(1)).alias("n_records"), F.sum(F.col("fmt_dp").cast("bigint")).alias("dp"))


def _block_files(d: Data) -> str:
    path = scratch(d, "calls")
    lines = vcf_lines(d).withColumn("line_no", F.struct(~F.col("value").startswith("#"), ~F.col("value").startswith("##"), F.col("value")))
    B.write_call_lines(lines, path)
    return path


@query("read_block_vcf", """
SELECT variant_id, sample_id, chrom, pos, ref, alt, filter, gt AS fmt_gt, CAST(dp AS STRING) AS fmt_dp, CAST(dp AS STRING) AS info_dp FROM {calls}""")
def read_block_vcf(d):
    """Block-compressed call files, one per cell, read back by several tasks each."""
    return X.vcf_fields(X.read_block_vcf(d.spark, _block_files(d), span=4096), ["DP"], ["GT", "DP"]).drop("file", "id", "qual")


@query("read_block_vcf_region", "SELECT variant_id, sample_id, CAST(dp AS STRING) AS fmt_dp FROM {calls} WHERE chrom = 'chr3' AND pos BETWEEN 4000 AND 12000")
def read_block_vcf_region(d):
    """One region of the same files."""
    return X.vcf_fields(X.read_block_vcf(d.spark, _block_files(d), chrom="chr3", start=4000, end=12000), fmt=["DP"]).select("variant_id", "sample_id", "fmt_dp")


@query("metric_report", """
SELECT biosample, CASE WHEN total_reads % 4 = 0 THEN total_reads ELSE 2 * total_reads END AS align_total_reads, CASE WHEN total_reads % 3 = 0 THEN NULL ELSE pct_chimeras END AS align_pct_chimeras FROM {qc}""")
def metric_report(d):
    text = ("concat('# comment\\n\\nCATEGORY\\tTOTAL_READS\\tPCT_CHIMERAS\\nFIRST_OF_PAIR\\t1\\t0.5\\nUNPAIRED\\t', total_reads, '\\t', CASE WHEN total_reads % 3 = 0 THEN '?' ELSE CAST(pct_chimeras AS STRING) END, '\\n', "
            "CASE WHEN total_reads % 4 = 0 THEN '' ELSE concat('PAIR\\t', 2 * total_reads, '\\t', CASE WHEN total_reads % 3 = 0 THEN '' ELSE CAST(pct_chimeras AS STRING) END, '\\n') END) AS text")
    reports = spread(d.qc, "biosample").selectExpr("biosample", text)
    return R.parse_metric_report(reports, "CATEGORY", {"TOTAL_READS": "align_total_reads bigint", "PCT_CHIMERAS": "align_pct_chimeras double"}, ["PAIR", "UNPAIRED"])


@query("metric_report_single", """
SELECT biosample, total_reads AS read_pairs_examined, pct_duplication AS pct_duplication, NULL::BIGINT AS library_size FROM {qc}""")
def metric_report_single(d):
    text = "concat('## METRICS\\nLIBRARY\\tREAD_PAIRS_EXAMINED\\tPERCENT_DUPLICATION\\tESTIMATED_LIBRARY_SIZE\\nlib1\\t', total_reads, '\\t', pct_duplication, '\\n\\n## HISTOGRAM\\nBIN\\tVALUE\\n1\\t2\\n') AS text"
    return R.parse_metric_report(spread(d.qc, "biosample").selectExpr("biosample", text), "LIBRARY", {
        "READ_PAIRS_EXAMINED": "read_pairs_examined bigint", "PERCENT_DUPLICATION": "pct_duplication double", "ESTIMATED_LIBRARY_SIZE": "library_size bigint"})


@query("trim_json", """
SELECT biosample, total_reads AS trim_total_reads, 0::BIGINT AS trim_total_bases, pct_1x AS trim_q20_rate, CASE WHEN total_reads % 2 = 0 THEN 7 ELSE 0 END::BIGINT AS trim_adapter_trimmed_reads, pct_duplication AS trim_duplication_rate FROM {qc}""")
def trim_json(d):
    text = ("concat('{\"summary\": {\"before_filtering\": {\"total_reads\": ', total_reads, ', \"q20_rate\": ', pct_1x, '}}, ', CASE WHEN total_reads % 2 = 0 THEN '\"adapter_cutting\": {\"adapter_trimmed_reads\": 7}, ' ELSE '' END, "
            "'\"duplication\": {\"rate\": ', pct_duplication, '}}') AS text")
    return R.parse_trim_json(d.qc.selectExpr("biosample", text)).select(
        "biosample", "trim_total_reads", "trim_total_bases", "trim_q20_rate", "trim_adapter_trimmed_reads", "trim_duplication_rate")


@query("flagstat", "SELECT biosample, total_reads AS primary, total_reads // 10 AS duplicates, CASE WHEN total_reads % 3 = 0 THEN 0 ELSE total_reads // 2 END AS mapped FROM {qc}")
def flagstat(d):
    text = ("concat(total_reads + 9, ' + 0 in total (QC-passed reads + QC-failed reads)\\n', total_reads, ' + 0 primary\\n3 + 0 duplicates\\n', total_reads div 10, ' + 0 primary duplicates\\n', "
            "CASE WHEN total_reads % 3 = 0 THEN '' ELSE concat(total_reads div 2, ' + 0 primary mapped (95.45% : N/A)\\n') END) AS text")
    return R.parse_flagstat(d.qc.selectExpr("biosample", text))


@query("matrix_roundtrip", "SELECT variant_id, sample_id, nv AS n FROM {nvnr}")
def matrix_roundtrip(d):
    """Long counts to a wide tab-separated file and back."""
    path = scratch(d, "matrix")
    S.write_matrix(nvnr(d), [f"cell_{i:02d}" for i in range(24)], "nv").write.option("header", True).option("sep", "\t").csv(path)
    return S.read_matrix(d.spark, path)


@query("write_matrix", "SELECT variant_id, " + ", ".join(f"CAST(coalesce(sum(nv) FILTER (WHERE sample_id = 'cell_{i:02d}'), 0) AS BIGINT) AS cell_{i:02d}" for i in range(24)) + " FROM {nvnr} WHERE nv > 0 GROUP BY 1")
def write_matrix(d):
    return S.write_matrix(nvnr(d).filter("nv > 0"), [f"cell_{i:02d}" for i in range(24)], "nv")


@query("enforce_schema", """
SELECT biosample, CASE WHEN total_reads % 3 = 0 THEN NULL ELSE CAST(round_even(total_reads / 4.0, 0) AS BIGINT) END AS total_reads, skew_cnv AS skew_cnv, total_reads % 2 = 0 AS subsampled FROM {qc}""")
def enforce_schema(d):
    raw = d.qc.selectExpr("biosample", "CASE WHEN total_reads % 3 = 0 THEN 'n/a' ELSE CAST(total_reads / 4.0 AS STRING) END AS total_reads", "coalesce(CAST(skew_cnv AS STRING), 'NA') AS skew_cnv",
                          "CASE WHEN total_reads % 2 = 0 THEN 'true' ELSE 'false' END AS subsampled")
    return K.enforce_schema(raw, ["biosample"], ["skew_cnv"], ["total_reads"], ["subsampled"])


@query("write_partitioned", "SELECT grp AS workspace, 'w' || (total_reads % 3) AS workflow_id, biosample, total_reads, pct_1x FROM {qc}")
def write_partitioned(d):
    path = scratch(d, "summary")
    K.write_partitioned(d.qc.selectExpr("grp AS workspace", "concat('w', total_reads % 3) AS workflow_id", "biosample", "total_reads", "pct_1x"), path, keys=("workspace", "workflow_id"))
    return d.spark.read.schema("biosample string, total_reads bigint, pct_1x double, workspace string, workflow_id string").parquet(path)


@query("bins_long", """
SELECT sample_id AS biosample, chrom AS chr, bin_start AS start, bin_start + 1000000 AS "end", CAST(raw_count % 5 AS DOUBLE) AS ploidy, raw_count, 'run1' AS dataset_id, CAST(1000000 AS INT) AS bin_size FROM (
SELECT g.chrom, g.bin_start, s.sample_id, coalesce(b.raw_count, 0) AS raw_count FROM (SELECT DISTINCT chrom, bin_start FROM {bins}) g CROSS JOIN (SELECT DISTINCT sample_id FROM {bins}) s
LEFT JOIN {bins} b ON b.chrom = g.chrom AND b.bin_start = g.bin_start AND b.sample_id = s.sample_id)""")
def bins_long(d):
    names = [r["sample_id"] for r in d.bins.select("sample_id").distinct().sort("sample_id").collect()]  # they name the columns
    wide = d.bins.groupBy(F.col("chrom").alias("chr"), F.col("bin_start").alias("start"), (F.col("bin_start") + 1000000).alias("end")).pivot("sample_id", names).agg(F.first("raw_count")).na.fill(0)
    seg = wide.select("chr", "start", "end", *[(F.col(n) % 5).alias(f"{n}_sorted") for n in names])
    return K.checked_bins(K.bins_long(seg, wide, dataset_id="run1", bin_size=1000000))


@query("manifest", """
SELECT grp AS "group", 'p' || (k % 9) AS param, arg_max('path' || k, k) AS path FROM (SELECT grp, CAST(substr(biosample, 6) AS BIGINT) AS k FROM {qc}) WHERE grp = (SELECT arg_min(grp, CAST(substr(biosample, 6) AS BIGINT)) FROM {qc}) GROUP BY 1, 2""")
def manifest(d):
    k = "CAST(substr(biosample, 6) AS BIGINT)"
    return S.resolve_manifest(d.qc.selectExpr(f"{k} AS line_no", "grp AS group", f"concat('p', {k} % 9) AS param", f"concat('path', {k}) AS path"))


@query("emit_manifest", """
SELECT grp AS "group", unnest(['nr', 'nv']) AS param, unnest(['out/' || grp || '/nr.tsv', 'out/' || grp || '/nv.tsv']) AS path FROM (SELECT DISTINCT grp FROM {qc})""")
def emit_manifest(d):
    return S.emit_manifest(d.qc.select(F.col("grp").alias("group")).distinct(), {"nr": "out/{group}/nr.tsv", "nv": "out/{group}/nv.tsv"})


@query("metrics_json", """
SELECT section, '{' || string_agg('"' || key || '": ' || CASE WHEN key = 'label' THEN '"' || value || '"' ELSE value END, ', ' ORDER BY key) || '}' AS json
FROM (SELECT grp AS section, unnest(['n', 'mean', 'label']) AS key, unnest([CAST(count(*) AS STRING), CAST(sum(total_reads) % 1000 AS STRING) || '.5', 'seg "' || grp || '"']) AS value FROM {qc} GROUP BY 1)
GROUP BY 1""".replace("'\"' || value || '\"'", "'\"' || replace(value, '\"', '\\\"') || '\"'"))
def metrics_json(d):
    t = d.qc.groupBy(F.col("grp").alias("section")).agg(F.count(F.lit(1)).cast("string").alias("n"), F.concat((F.sum("total_reads") % 1000).cast("string"), F.lit(".5")).alias("mean"))
    flat = t.withColumn("label", F.concat(F.lit('seg "'), F.col("section"), F.lit('"'))).unpivot(["section"], ["n", "mean", "label"], "key", "value")
    return K.metrics_json(flat)


@query("concat_shards", "SELECT biosample, total_reads FROM {qc}")
def concat_shards(d):
    """Same-header shards are read back as one folder."""
    path = scratch(d, "shards")
    d.qc.select("biosample", "total_reads").repartition(5).write.option("header", True).csv(path)
    return d.spark.read.option("header", True).schema("biosample string, total_reads bigint").csv(path)


@query("status_csv", """SELECT biosample AS "biosampleName", CASE WHEN total_reads = 0 THEN 'FAIL' ELSE 'PASS' END AS qc_status, 'qc' AS pipeline, '1.0' AS pipeline_version FROM {qc}""")
def status_csv(d):
    return K.status_csv(d.qc.selectExpr("biosample", "CASE WHEN total_reads = 0 THEN 'FAIL' ELSE 'PASS' END AS qc_status", "'qc' AS pipeline", "'1.0' AS pipeline_version", "total_reads"))
