"""Interval tree, depth sweep, refit, smoothing, repeatable runs and QC rows against brute force."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from somaloom.operators import cnv, coverage, joins, signatures
from somaloom.sources import qc_summary, sinks


def test_intervals_of_any_length(spark):
    draw = random.Random(9)
    spans = [(c, s, s + n, k) for k, (c, s, n) in enumerate((draw.choice("ab"), draw.randrange(1 << 30), draw.choice([0, 1, 90, 5000, 10**5, 10**7, 10**8])) for _ in range(120))]
    spans += [("a", (1 << 29) - 3, (1 << 29) + 3, 500), ("a", 0, 1 << 31, 501), ("a", 5, 4, 502), ("a", None, 9, 503), ("b", 7, 7, 504)]
    points = [(draw.choice("abc"), draw.randrange(1 << 30), k) for k in range(300)] + [("a", (1 << 29) - 1, 900), ("a", 1 << 29, 901), ("b", 7, 902), (None, 7, 903), ("a", None, 904)]
    points += [(c, x, 1000 + k) for k, (c, s, e, _) in enumerate(spans[:60]) for x in (s, e)]
    p, s = spark.createDataFrame(points, "chrom string, pos bigint, i int"), spark.createDataFrame(spans, "chrom string, start bigint, end bigint, t int")
    got = joins.assign_intervals(p, s, width=100)
    assert sorted((r.i, r.t) for r in got.collect()) == sorted(
        (i, t) for c, x, i in points for d, a, b, t in spans if c == d and None not in (x, a, b) and a <= x <= b)
    assert joins.assign_intervals(p, s.limit(0)).count() == 0


def test_depth_runs(spark):
    draw = random.Random(2)
    cigars = ["20M", "5S10M", "3M2D4M", "3M2I4M", "4M50N4M", "10=2X3H", "7S", "*", None, "0M3M"]
    reads = [("s1" if draw.random() < 0.8 else "s2", "c1" if draw.random() < 0.7 else "c2", draw.randrange(300), draw.choice(cigars)) for _ in range(400)]
    reads += [("s1", "c1", 150, "20M")] * 200
    depth = {}
    for s, c, at, cigar in reads:
        number = ""
        for ch in cigar or "":
            if ch.isdigit():
                number += ch
                continue
            n, number = int(number or 0), ""
            if ch in "M=X":
                for x in range(at, at + n):
                    depth[s, c, x] = depth.get((s, c, x), 0) + 1
            at += n if ch in "M=XDN" else 0
    df = spark.createDataFrame(reads, "sample_id string, chrom string, pos long, cigar string").repartition(3)
    for span in (16, 1 << 20):
        runs = coverage.depth_runs(coverage.aligned_blocks(df), span=span).collect()
        got = {}
        for r in runs:
            for x in range(r.start, r.end + 1):
                assert (r.sample_id, r.chrom, x) not in got
                got[r.sample_id, r.chrom, x] = r.depth
        assert got == depth
    assert coverage.depth_runs(coverage.aligned_blocks(df.limit(0))).count() == 0


def plain_refit(weights, y, max_loss):
    """Backward elimination with a fresh non-negative fit for every trial."""
    keep = list(range(weights.shape[1]))
    score = lambda some: signatures._cosine(weights[:, some] @ signatures._nnls(weights[:, some], y), y)
    best = score(keep)
    while len(keep) > 1:
        value, drop = max(((round(score([k for k in keep if k != d]), 12), d) for d in keep))
        if best - value > max_loss:
            break
        keep.remove(drop)
        best = value
    x = np.zeros(weights.shape[1])
    x[keep] = signatures._nnls(weights[:, keep], y)
    return x


def test_refit_by_downdates_equals_fresh_fits(spark):
    draw = np.random.default_rng(12)
    weights = draw.dirichlet(np.ones(24) * 0.4, 9).T
    samples = {f"s{k}": draw.poisson(weights @ (draw.gamma(0.5, 400, 9))).astype(float) for k in range(25)} | {"none": np.zeros(24), "mix": weights @ np.array([500, 0, 0, 300, 0, 0, 0, 9, 0.0])}
    for y in samples.values():
        got = signatures._Refit(weights, y).eliminate(0.004)[0]
        assert np.allclose(got, plain_refit(weights, y, 0.004), rtol=1e-6, atol=1e-6)
    rows = [("p", s, f"f{i:02d}", float(v)) for s, y in samples.items() for i, v in enumerate(y)] + [("p", "s0", "unknown", 5.0), ("q", "s0", "f00", 3.0), ("lone", "z", "f00", 1.0)]
    catalog = [("p", f"f{i:02d}", f"S{j}", float(weights[i, j])) for i in range(24) for j in range(9)] + [("q", "f00", "only", 2.0)]
    counts = spark.createDataFrame(rows, "project string, sample_id string, feature string, n double").repartition(4)
    out = signatures.signature_refit(counts, spark.createDataFrame(catalog, "project string, feature string, signature string, weight double"), project="project").collect()
    got = {(r.project, r.sample_id, r.signature): r.activity for r in out}
    for s, y in samples.items():
        assert np.allclose([got["p", s, f"S{j}"] for j in range(9)], plain_refit(weights, y, 0.004), rtol=1e-6, atol=1e-6)
    assert got["q", "s0", "only"] == pytest.approx(1.5) and not any(k[0] == "lone" for k in got)


def plain_lowess(x, y, share, rounds=3):
    """Local linear fits point by point, each on its nearest neighbours by distance."""
    n = len(x)
    k = max(2, min(n, int(share * n + 1e-7)))
    robust, fit = np.ones(n), np.zeros(n)
    for _ in range(rounds + 1):
        for i in range(n):
            near = np.argsort(np.abs(x - x[i]), kind="stable")[:k]
            d = np.abs(x[near] - x[i])
            w = np.clip(1 - (d / max(d.max(), 1e-12)) ** 3, 0, None) ** 3 * robust[near] + 1e-15
            a, b = np.polyfit(x[near] - x[i], y[near], 1, w=np.sqrt(w))
            fit[i] = b
        spread = 6 * np.median(np.abs(y - fit))
        robust = np.clip(1 - ((y - fit) / spread) ** 2, 0, None) ** 2
    return fit


def test_smoothing_equals_point_by_point_fits():
    draw = np.random.default_rng(7)
    x = np.sort(draw.uniform(0.3, 0.6, 150))
    y = np.sin(8 * x) + draw.normal(0, 0.05, 150)
    y[::17] += 1.0
    order = draw.permutation(150)
    got = cnv._lowess(x[order], y[order], 0.3)
    assert np.allclose(got, plain_lowess(x, y, 0.3)[order], atol=1e-9)
    line = cnv._lowess(x, 3 * x - 1, 0.1)
    assert np.allclose(line, 3 * x - 1, atol=1e-9)


def test_runs_repeat_without_new_rows(spark, tmp_path):
    path, runs = str(tmp_path / "data"), str(tmp_path / "runs")
    rows = lambda run, n: spark.range(n).selectExpr("'w' AS workspace", f"'{run}' AS workflow_id", "CASE WHEN id % 4 = 3 THEN NULL ELSE concat('b', id % 4) END AS biosample", "id AS n")
    for _ in range(2):
        sinks.write_run(rows("one", 40), path, runs, "one")
        sinks.write_run(rows("two", 12), path, runs, "two")
    assert spark.read.parquet(path).count() == 52 == sinks.read_runs(spark, path, runs).count()
    sinks.write_run(rows("two", 12).filter("biosample = 'b1'"), path, runs, "two")  # a repeat that holds less
    assert sinks.read_runs(spark, path, runs).filter("workflow_id = 'two'").count() == 3
    sinks.write_run(rows("two", 0), path, runs, "two")
    assert sinks.read_runs(spark, path, runs).count() == 40
    assert {r.run_id for r in spark.read.parquet(runs).filter("n_rows IS NOT NULL").select("run_id").distinct().collect()} == {"one"}


def test_qc_rows_of_awkward_reports(spark):
    rows = [("a", "read_counts", "10\n5\n"), ("a", "alignment", "CATEGORY\tTOTAL_READS\tPF_READS\nPAIR\tx\t4\n"), ("a", "preseq", "junk"), ("b", "insert_size", "no header here"),
            ("c", None, "x"), (None, "preseq", "5"), ("d", "odd", "x"), ("e", "preseq", "4000000000"), ("e", "read_counts", "")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "biosample string, kind string, text string, qc_score int")
    got = {r.biosample: r for r in qc_summary.dna_qc_summary(df.drop("qc_score"), workspace="w").collect()}
    assert set(got) == {"a", "b", "d", "e"} and got["a"].workspace == "w"
    a = got["a"]
    assert (a.total_reads, a.final_reads, a.subsampled, a.align_total_reads, a.align_pf_reads, a.align_bad_cycles, a.pct_aligned, a.preseq_count) == (10, 5, True, None, 4, 0, None, 0)
    assert got["b"].insert_size is None and got["b"].qc_score is None and got["b"].qc_status == "FAIL" and got["e"].preseq_count == 4000000000
    assert qc_summary.dna_qc_summary(df.limit(0)).count() == 0 and qc_summary.wgs_qc_summary(df).count() == 4
