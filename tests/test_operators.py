"""Operators without an SQL twin, text decoding, skew and invariants."""

import os
import random
import statistics

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from somaloom.operators import cnv, coverage, diagnostics, joins, pileup, sets, signatures
from somaloom.sources import reports, sheets, sinks, vcf


def decode(spark, bases, bq="", mq=""):
    df = spark.createDataFrame([("s", "chr1", 10, "C", bases, bq, mq, "1,2,3,4,5,6,7,8", "9,9,9,9,9,9,9,9", "M,M,M,M,M,M,M,M")],
                               "sample_id string, chrom string, pos bigint, ref string, read_bases string, bq string, mq string, bp_start string, aln_score string, cigar string")
    out = pileup.explode_pileup(df).withColumn("id", pileup.pileup_variant_id()).orderBy("read_no").collect()
    return [(r.allele, r.strand) for r in out], out


@pytest.mark.parametrize("bases,want", [
    (".,Aa", [("REF", "F"), ("REF", "R"), ("A", "F"), ("A", "R")]),
    ("^+.$^$,^^T", [("REF", "F"), ("REF", "R"), ("T", "F")]),
    (".+12ACGTACGTACGTg,-2tt*", [("+12ACGTACGTACGT", "F"), ("G", "R"), ("-2TT", "R"), ("DELREFCIGAR", "F")]),
    ("^].+1A$.", [("+1A", "F"), ("REF", "F")]),
    ("", [("Z", "F"), ("A", "F")]),
    (None, [("Z", "F"), ("A", "F")]),
])
def test_pileup_strings(spark, bases, want):
    assert decode(spark, bases)[0] == want


def test_pileup_ids_and_qualities(spark):
    rows = decode(spark, ".+2AG,-1tG*", "!I5A", "~~!!")[1]
    assert [r.id for r in rows] == ["chr1_10_C_CAG", "chr1_10_CT_C", "chr1_10_C_G", "chr1_10_C_DELREFCIGAR"]
    assert [r.bq for r in rows] == [0, 40, 20, 32] and [r.mq for r in rows] == [93, 93, 0, 0]


def test_metrics_of_one_allele_match_numpy(spark):
    rng = random.Random(1)
    bp = [rng.randint(0, 149) for _ in range(41)]
    rows = [("s", "chr1", 5, "A", "T", "id", "F" if i % 3 else "R", 60, 20 + i % 30, b, 130 + i, i % 4 == 0) for i, b in enumerate(bp)]
    df = spark.createDataFrame(rows, "sample_id string, chrom string, pos bigint, ref string, allele string, allele_id string, strand string, mq int, bq int, bp_start int, aln_score int, clipped boolean")
    r = pileup.pileup_metrics(df).collect()[0]
    hq = np.array([b for i, b in enumerate(bp) if i % 3 and 20 + i % 30 >= 30])
    assert r.n_hq_f == len(hq) and r.sd_f == pytest.approx(hq.std(ddof=1))
    assert r.mad_f == pytest.approx(1.4826 * np.median(abs(hq - np.median(hq)))) and r.prop_under_f == pytest.approx((hq < 15).mean())
    assert r.median_as == np.median([130 + i for i in range(41)]) and r.depth_all == 41


def test_duplicates_in_one_huge_copy_group(spark):
    reads = spark.range(20000).selectExpr("id AS read_id", "'s' AS sample_id", "'chr1' AS chrom", "CASE WHEN id % 3 = 0 THEN 7 ELSE id END AS pos", "'F' AS strand", "id % 40 AS sum_bq")
    out = coverage.mark_duplicates(reads)
    kept = out.filter("pos = 7 AND NOT is_duplicate").collect()
    assert len(kept) == 1 and kept[0].sum_bq == 39 and out.count() == 20000


def test_cap_per_group_is_exact_and_repeatable(spark):
    df = spark.range(5000).selectExpr("CAST(id AS STRING) AS row_id", "CASE WHEN id % 3 = 0 THEN 'hot' ELSE CONCAT('k', id % 400) END AS k")
    a = sets.cap_per_group(df, "k", 20, "row_id", seed=1)
    counts = {r.k: r["count"] for r in a.groupBy("k").count().collect()}
    sizes = {r.k: r["count"] for r in df.groupBy("k").count().collect()}
    assert counts == {k: min(20, n) for k, n in sizes.items()}
    again = sets.cap_per_group(df.repartition(7), "k", 20, "row_id", seed=1, salts=5)
    assert {r.row_id for r in a.collect()} == {r.row_id for r in again.collect()}


def test_subsampling_reaches_its_target_and_keeps_mates(spark):
    reads = spark.range(40000).selectExpr("CASE WHEN id < 36000 THEN 'big' ELSE 'small' END AS sample_id", "CAST(id DIV 2 AS STRING) AS read_id", "id % 2 AS mate")
    kept, counts = sets.subsample_to_target(reads, 9000)
    n = {r.sample_id: r for r in counts.collect()}
    assert n["small"].final_reads == 4000 and not n["small"].subsampled
    assert n["big"].total_reads == 36000 and abs(n["big"].final_reads - 9000) < 600
    assert kept.groupBy("sample_id", "read_id").count().filter("count <> 2").count() == 0


def test_intervals_match_brute_force(spark):
    rng = random.Random(2)
    pts = [(f"c{rng.randint(1, 2)}", rng.randint(0, 3000), i) for i in range(300)]
    ivs = [(c, s, s + rng.choice([0, 5, 900]), f"t{k}") for k, (c, s) in enumerate((f"c{rng.randint(1, 2)}", rng.randint(0, 3000)) for _ in range(40))]
    got = joins.assign_intervals(spark.createDataFrame(pts, "chrom string, pos bigint, i int"), spark.createDataFrame(ivs, "chrom string, start bigint, end bigint, target string"), width=100)
    assert sorted((r.i, r.target) for r in got.collect()) == sorted((i, t) for c, p, i in pts for d, s, e, t in ivs if c == d and s <= p <= e)


def test_threshold_sweep_of_a_constant_and_a_ramp(spark):
    flat = diagnostics.threshold_sweep(spark.createDataFrame([(5.0,)] * 4, "v double"), "v", steps=10).collect()
    assert all(r.pass_fraction == 1.0 for r in flat)
    ramp = diagnostics.threshold_sweep(spark.range(101).selectExpr("CAST(id AS DOUBLE) AS v"), "v", steps=11, upper=1.0, direction="<").orderBy("step").collect()
    assert [round(r.pass_fraction * 101) for r in ramp] == [10 * i for i in range(11)]


def test_gc_correction_removes_the_trend(spark):
    rng = np.random.default_rng(4)
    gc = rng.uniform(0.3, 0.6, 600)
    raw = np.round(200 * np.exp(2 * (gc - 0.45)) * rng.uniform(0.95, 1.05, 600)).astype(int)
    pdf = pd.DataFrame({"sample_id": "s", "chrom": "chr1", "bin_start": np.arange(600) * 10, "raw_count": raw})
    gcs = pd.DataFrame({"chrom": "chr1", "bin_start": np.arange(600) * 10, "gc": gc})
    out = cnv.gc_correct(spark.createDataFrame(pdf), spark.createDataFrame(gcs), share=0.2).toPandas()
    assert abs(np.corrcoef(out.gc, out.corrected)[0, 1]) < 0.1 < abs(np.corrcoef(out.gc, out.normal)[0, 1])
    assert abs(out.corrected.mean() - 1) < 0.02 and out.corrected.std() < 0.05


def test_refit_recovers_a_sparse_mixture(spark):
    rng = np.random.default_rng(8)
    cat = rng.dirichlet(np.ones(30) * 0.3, 6).T
    rows = [(f"f{i}", f"S{j}", float(cat[i, j])) for i in range(30) for j in range(6)]
    y = 700 * cat[:, 1] + 300 * cat[:, 4]
    counts = spark.createDataFrame([("a", f"f{i}", float(v)) for i, v in enumerate(y)], "sample_id string, feature string, n double")
    out = {r.signature: r for r in signatures.signature_refit(counts, spark.createDataFrame(rows, "feature string, signature string, weight double")).collect()}
    assert out["S1"].activity == pytest.approx(700, rel=0.1) and out["S4"].activity == pytest.approx(300, rel=0.25)
    assert sum(r.activity > 0 for r in out.values()) <= 3 and out["S1"].cosine > 0.99


@pytest.mark.parametrize("block", [2, 5, 100])
def test_bray_curtis_has_every_pair_once(spark, block):
    rng = random.Random(6)
    data = {f"s{i}": {f"f{j}": rng.randint(0, 5) for j in range(6)} for i in range(13)}
    df = spark.createDataFrame([(s, f, n) for s, fs in data.items() for f, n in fs.items()], "sample_id string, signature string, activity int")
    got = {(r.a, r.b): r.distance for r in signatures.bray_curtis(df, block=block).collect()}
    names = sorted(data)
    assert len(got) == 13 * 12 // 2
    for i, a in enumerate(names):
        for b in names[i + 1:]:
            shared = sum(min(data[a][f], data[b][f]) for f in data[a])
            assert got[a, b] == pytest.approx(1 - 2 * shared / (sum(data[a].values()) + sum(data[b].values())))


def test_files_on_disk(spark, tmp_path):
    sheet = tmp_path / "sheet.csv"
    sheet.write_text("﻿biosampleName, groups ,vcf\nA , ,x.vcf\nB,g2,\n", encoding="utf-8")
    rows = {r.biosample: r for r in sheets.read_sample_sheet(spark, str(sheet)).collect()}
    assert rows["A"].group == "GROUP1" and rows["B"].group == "g2" and rows["B"].vcf is None
    man = tmp_path / "m.csv"
    man.write_text("group,param,path\ng1,nr,/a,b\nbad\ng2,nr,/x\ng1,nv,/c\n")
    assert sorted((r.param, r.path) for r in sheets.read_manifest(spark, str(man)).collect()) == [("nr", "/a,b"), ("nv", "/c")]
    call = tmp_path / "c.vcf"
    call.write_text("##x\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\ts1\ts2\nchr1\t5\t.\tA\tT\t.\tPASS\tDP=3;X\tGT:AD\t0/1:1,2\t./.\n")
    got = {r.sample_id: r for r in vcf.vcf_fields(vcf.read_vcf(spark, str(call)), ["DP"], ["GT", "AD"]).collect()}
    assert got["s1"].fmt_ad == "1,2" and got["s2"].fmt_ad is None and got["s2"].info_dp == "3"
    rep = tmp_path / "A1.txt"
    rep.write_text("CATEGORY\tTOTAL_READS\nUNPAIRED\t7\n")
    out = reports.parse_metric_report(reports.read_reports(spark, str(rep)), "CATEGORY", {"TOTAL_READS": "n bigint"}, ["PAIR", "UNPAIRED"]).collect()
    assert out[0].n == 7 and out[0].file == "A1.txt"


def test_partitioned_write(spark, tmp_path):
    df = spark.range(50).selectExpr("'w' AS workspace", "'f' AS workflow_id", "concat('b', id % 3) AS biosample", "id AS n")
    sinks.write_partitioned(df, str(tmp_path / "out"))
    assert sorted(os.listdir(tmp_path / "out" / "workspace=w" / "workflow_id=f"))[:1] == ["biosample=b0"]
    assert spark.read.parquet(str(tmp_path / "out")).count() == 50


def test_call_file_keeps_every_sample(spark):
    from somaloom.sources.vcf import parse_vcf

    names = [f"s{k}" for k in range(40)]
    lines = ["##x", "\t".join(["#CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", "FORMAT", *names]),
             "\t".join(["chr1", "5", ".", "A", "T", ".", "PASS", "AC=1", "GT:DP", *[f"0/1:{k}" for k in range(40)]]), "chr1\t6\t.\tA\tT\t.\tPASS\tAC=1"]
    got = parse_vcf(spark.createDataFrame([("f", v) for v in lines], "file string, value string")).filter("pos = 5").collect()
    assert {(r.sample_id, r.fmt["DP"]) for r in got} == {(f"s{k}", str(k)) for k in range(40)}


def test_reads_without_a_place_are_kept(spark):
    from somaloom.operators import coverage

    reads = spark.createDataFrame([(1, "a", "c", 1, "F", 9), (2, "a", "c", 1, "F", 8), (3, "a", None, None, None, 5), (4, "a", None, None, None, 5)],
                                  "read_id long, sample_id string, chrom string, pos int, strand string, sum_bq int")
    assert {(r.read_id, r.is_duplicate) for r in coverage.mark_duplicates(reads).collect()} == {(1, False), (2, True), (3, False), (4, False)}


def test_largest_of_several_frequencies_counts(spark):
    from somaloom.operators import annotation

    rows = spark.createDataFrame([("0.001&0.5", None, None), ("0.001&0.002", "0.003", None), (None, None, None), ("0.001", "0.2,0.001", None)], "af string, max_af string, existing string")
    assert [r.filter_status for r in annotation.population_filter(rows).collect()] == ["REMOVED", "PASS", "PASS", "REMOVED"]


def test_bin_of_one_input_ends_the_run(spark):
    from somaloom.sources import sinks

    seg = spark.createDataFrame([("c", 1, 2, 2.0)], "chr string, start int, end int, s1 double")
    raw = spark.createDataFrame([("c", 1, 2, 5), ("c", 3, 4, 6)], "chr string, start int, end int, s1 long")
    with pytest.raises(Exception, match="bin in one input only"):
        sinks.checked_bins(sinks.bins_long(seg, raw)).collect()
    assert sinks.checked_bins(sinks.bins_long(seg, raw.filter("start = 1"))).count() == 1


def test_pileup_medians_of_many_alleles_at_once(spark):
    draw = random.Random(5)
    rows = [("s", f"v{k}", "chr1", k, "A", "C", draw.choice("FR"), draw.choice((20, 60)), 40, draw.choice((None, *range(1, 150))), draw.choice((None, 120, 150, 155)), False)
            for k in range(60) for _ in range(k % 9 + 1)]
    obs = spark.createDataFrame(rows, "sample_id string, allele_id string, chrom string, pos int, ref string, allele string, strand string, mq int, bq int, bp_start int, aln_score int, clipped boolean")
    found = pileup.pileup_metrics(obs)
    assert "percentile(" not in found._jdf.queryExecution().optimizedPlan().toString()
    middle = lambda values: statistics.median(values) if values else None
    for r in found.collect():
        own = [o for o in rows if o[1] == r.variant_id]
        assert r.median_as == middle([o[10] for o in own if o[10] is not None])
        for strand, mad in (("F", r.mad_f), ("R", r.mad_r)):
            at = [o[9] for o in own if o[6] == strand and o[7] >= 30 and o[9] is not None]
            want = middle([abs(x - middle(at)) for x in at])
            assert mad is None if want is None else mad == pytest.approx(want * 1.4826)
