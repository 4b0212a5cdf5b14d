"""Sparse counts of several cohorts: shares and adjustments stay within a cohort; empty cells are implied."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from catalog.base import Data
from catalog.cohorts import PRESET
from somaloom.functions import stats
from somaloom.operators import cascade as C
from somaloom.operators import cohorts as K
from somaloom.operators import germline_stats as G
from somaloom.session import cut_lineage

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def data(spark):
    d = Data(spark, SF)
    cells = K.number_cells(d.ccells)
    sparse = d.saved("sparse", lambda: K.compress(K.entries_from_obs(d.cobs), cells))
    return d, cells, sparse


def plain_rho(cells):
    """Grid argmax of the beta-binomial likelihood, term by term."""
    cells = [(k, n) for k, n in cells if n > 0]
    if not cells:
        return None
    mu = sum(k for k, _ in cells) / sum(n for _, n in cells)
    rise = lambda x, n: sum(math.log(x + i) for i in range(n))
    best = None
    for i, rho in enumerate(stats.rho_grid()):
        s = (1 - rho) / rho
        ll = round(sum(rise(mu * s, k) + rise((1 - mu) * s, n - k) - rise(s, n) for k, n in cells), 7)
        if best is None or ll > best[0]:
            best = (ll, rho)
    return best[1]


def test_overdispersion_from_distinct_counts():
    draw = np.random.default_rng(4)
    variants = [[(int(draw.binomial(n, p)), int(n)) for n in draw.poisson(8, 30)] for p in (0.01, 0.2, 0.5, 0.9)]
    variants += [[(0, 5), (0, 3)], [(4, 4)], [(0, 0)], [], [(1, 900), (800, 900), (0, 2)], [(2, 3)] * 40 + [(0, 9)] * 40]
    got = stats.betabinom_best([[k for k, _ in v] for v in variants], [[n for _, n in v] for v in variants], [[1] * len(v) for v in variants])
    want = [plain_rho(v) for v in variants]
    assert [None if np.isnan(g) else round(g, 12) for g in got] == [None if w is None else round(w, 12) for w in want]
    weighted = stats.betabinom_best([[2, 0]], [[3, 9]], [[40, 40]])
    assert weighted[0] == got[-1] and not len(stats.betabinom_best([], [], []))


def test_one_cohort_does_not_depend_on_the_others(spark, data):
    d, cells, sparse = data
    every = {(r.cohort, r.variant_id): r for r in K.first_pass_verdict(K.first_pass(sparse), q_cut=-1).collect()}
    for cohort in ("C0", "C1", "C2"):
        alone = K.first_pass_verdict(K.first_pass(sparse.filter(F.col("cohort") == cohort)), q_cut=-1).collect()
        assert alone and all(r == every[r.cohort, r.variant_id] for r in alone)


def test_sparse_statistics_equal_the_dense_ones(spark, data):
    """The dense operators on the full grid of one cohort give the same numbers."""
    d, cells, sparse = data
    one = sparse.filter("cohort = 'C1'")
    dense = K.grid(one, cells).drop("cohort")
    assert dense.count() == one.count() * cells.filter("cohort = 'C1'").count()
    rounded = lambda df, *cols: sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.select("variant_id", *cols).fillna(-1.0).collect())
    a, b = K.first_pass(one), G.first_pass(dense)
    assert rounded(a, "mean_depth", "germline_p", "rho") == rounded(b, "mean_depth", "germline_p", "rho")
    a, b = K.second_pass(one, -1, 0.01, 0.05), G.second_pass(dense, -1, 0.01, 0.05)
    assert rounded(a, "germline_q", "rho", "second_pass") == rounded(b, "germline_q", "rho", "second_pass")
    verdicts = one.select("cohort", "variant_id", F.when(F.hash("variant_id") % 3 != 0, "Pass").otherwise("Fail").alias("pileup_verdict"))
    flagged = K.cascade(one, a, verdicts, PRESET)
    split = K.vaf_split(flagged, cells.filter("cohort = 'C1'")).drop("cohort")
    want = C.vaf_split(dense, b, verdicts, preset=PRESET)
    key = lambda r: (r.stage, r.variant_id, r.sample_id, r.nr, r.nv, r.vaf, r.call)
    got = sorted(map(key, split.collect()))
    assert got == sorted(map(key, want.collect())) and {g[0] for g in got} >= {"unfiltered", "hqstat", "qc"}
    counts = {(r.stage, r.sample_id): (r.n_snv, r.n_indel) for r in K.cell_counts(flagged, cells.filter("cohort = 'C1'")).collect()}
    for r in C.per_cell_counts(want).collect():
        assert counts[r.stage, r.sample_id] == (r.n_snv, r.n_indel)


ENTRIES = "cohort string, variant_id string, chrom string, pos long, ref string, alt string, sample_id string, nv long, nr long, cell string, n_cells string"


def test_awkward_sheets_and_entries(spark):
    sheet = spark.createDataFrame([("A", "s1"), ("A", "s1"), ("A", "s2"), ("A", "s3"), ("B", "s1"), ("B", None), (None, "s9")], "cohort string, sample_id string")
    cells = K.number_cells(sheet)
    assert sorted(map(tuple, cells.collect())) == [("A", "s1", 1, 3), ("A", "s2", 2, 3), ("A", "s3", 3, 3), ("B", "s1", 1, 1)]
    site = ("chr1", 5, "A", "C")
    rows = [("A", "v", *site, "s3", 2, 4, "x", "x"), ("A", "v", *site, "s1", 0, 3, "x", "x"), ("A", "w", *site, "s1", 0, 0, "x", "x"),
            ("B", "v", *site, "s1", 1, 0, "x", "x"), ("A", "v", *site, "unlisted", 9, 9, "x", "x"), (None, "v", *site, "s1", 1, 1, "x", "x")]
    entries = spark.createDataFrame(rows, ENTRIES).drop("cell", "n_cells")
    sparse = K.compress(entries, cells)
    got = {(r.cohort, r.variant_id): (r.n_cells, r.cells, r.nv, r.nr) for r in sparse.collect()}
    assert got == {("A", "v"): (3, [1, 3], [0, 2], [3, 4]), ("A", "w"): (3, [], [], []), ("B", "v"): (1, [1], [1], [0])}
    dense = sorted((r.cohort, r.variant_id, r.sample_id, r.nv, r.nr) for r in K.grid(sparse, cells).collect())
    assert dense == [("A", "v", "s1", 0, 3), ("A", "v", "s2", 0, 0), ("A", "v", "s3", 2, 4), ("A", "w", "s1", 0, 0), ("A", "w", "s2", 0, 0), ("A", "w", "s3", 0, 0), ("B", "v", "s1", 1, 0)]
    totals = {(r.cohort, r.variant_id): (r.nv_total, r.nr_total, r.mean_depth, r.n_carriers) for r in K.totals(sparse, raise_depth=True).collect()}
    assert totals == {("A", "v"): (2, 7, 7 / 3, 1), ("A", "w"): (0, 0, 0.0, 0), ("B", "v"): (1, 1, 1.0, 1)}
    empty = K.compress(entries.limit(0), cells)
    assert K.first_pass_verdict(K.first_pass(empty)).count() == 0 and K.grid(empty, cells).count() == 0


def test_no_plan_makes_the_grid(spark, data):
    d, cells, sparse = data
    scored = K.totals(sparse).join(sparse.select("cohort", "variant_id", K.overdispersion(sparse, empty_as_one=True).alias("rho")), ["cohort", "variant_id"])
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "NestedLoop" not in plan and "Cartesian" not in plan


def test_cohort_plan(spark):
    from somaloom.plans.cohorts import cohort_filter

    d = Data(spark, SF)
    out = cohort_filter(d.cobs, d.ccells, preset=PRESET, q_cut=-1, second_q_cut=-1)
    stages = {(r.cohort, r.stage): r.n_passing for r in out["funnel"].collect()}
    for cohort in ("C0", "C1", "C2"):
        assert stages[cohort, "first_pass_depth"] >= stages[cohort, "first_pass_germline"] >= stages[cohort, "first_pass_betabinom"] > 0
        assert stages[cohort, "evidence"] >= stages[cohort, "split_hqstat"] >= stages[cohort, "split_qc"] >= stages[cohort, "split_depth"]
    assert out["cell_counts"].count() == 5 * out["cells"].count() and out["membership"].count() == out["counts"].count()


def test_entries_meet_their_locus_once(spark):
    rows = [("C1", s, v, "chr1", 5, "A", a, n, 0, 9) for s, v, a, n in [("s1", "ref", "REF", 4), ("s1", "v1", "C", 3), ("s1", "v2", "G", 2), ("s2", "ref", "REF", 9), (None, "v1", "C", 9)]]
    metrics = spark.createDataFrame(rows, "cohort string, sample_id string, variant_id string, chrom string, pos int, ref string, alt string, n_hq_f long, n_hq_r long, depth_hq long")
    found = K.entries_from_metrics(metrics)
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 1
    assert sorted((r.variant_id, str(r.sample_id), r.nr, r.nv) for r in found.collect()) == [
        ("v1", "None", 9, 0), ("v1", "s1", 9, 3), ("v1", "s2", 9, 0), ("v2", "None", 9, 0), ("v2", "s1", 9, 2), ("v2", "s2", 9, 0)]


def test_stages_unpack_in_many_tasks(spark):
    """Few bytes become many rows: they are dealt to all tasks first, and no row is lost or made twice."""
    cells = K.number_cells(cut_lineage(spark.createDataFrame([("A", s) for s in ("s1", "s2", "s3")] + [("B", "s1")], "cohort string, sample_id string")))
    rows = [("A", f"v{i}", [2], [3], [4], [0.75], [1], True, i % 2 == 0, False, False) for i in range(40)] + [("B", "v0", [], [], [], [], [], False, False, False, False)]
    flagged = cut_lineage(spark.createDataFrame(
        rows, "cohort string, variant_id string, cells array<int>, nv array<int>, nr array<int>, vaf array<double>, call array<int>, hqstat boolean, qc boolean, depth boolean, phylogeny boolean").coalesce(1))
    split = K.vaf_split(flagged, cells)
    held = [n for n in split.rdd.glom().map(len).collect() if n]
    assert len(held) > 1 and max(held) < sum(held)
    got = sorted(map(tuple, split.collect()))
    full = {"s1": (0, 0, 0.0, 0), "s2": (4, 3, 0.75, 1), "s3": (0, 0, 0.0, 0)}
    want = [("A", f"v{i}", s, *full[s], stage) for i in range(40) for s in full for stage in ("unfiltered", "hqstat", *["qc"] * (i % 2 == 0))]
    assert got == sorted(want + [("B", "v0", "s1", 0, 0, 0.0, 0, "unfiltered")])


def test_grid_comes_in_tiles(spark):
    """Names come again after a block of cells, not after the cohort; a single task's sparse rows unpack in many; no row is lost or made twice."""
    sizes = {"A": 2 * K.TILE_CELLS + 3, "B": 2, "C": K.TILE_CELLS}
    sheet = [(c, f"{c}{i:05}") for c, n in sizes.items() for i in range(1, n + 1)]
    cells = K.number_cells(cut_lineage(spark.createDataFrame(sheet, "cohort string, sample_id string")))
    stored = {("A", f"v{i}"): sorted({1, i + 1, K.TILE_CELLS, K.TILE_CELLS + 1, 2 * K.TILE_CELLS + 3} if i % 7 else set()) for i in range(3 * K.TILE_ROWS)}
    stored |= {("A", "all"): list(range(1, sizes["A"] + 1)), ("B", "v1"): [2], ("B", "v2"): [], ("C", "v1"): [K.TILE_CELLS], ("D", "v1"): [1], (None, "v1"): [1]}
    rows = [(c, v, "chr1", 7, None if v == "v3" else "A", "C", sizes.get(c, 1), at, [k % 5 for k in at], [k % 5 + 1 for k in at]) for (c, v), at in stored.items()]
    sparse = cut_lineage(spark.createDataFrame(
        rows, "cohort string, variant_id string, chrom string, pos long, ref string, alt string, n_cells int, cells array<int>, nv array<int>, nr array<int>").coalesce(1))
    tasks = [t for t in K.grid(sparse, cells).rdd.glom().collect() if t]
    assert len(tasks) > 1
    want = {(c, v, f"{c}{i:05}", "chr1", 7, None if v == "v3" else "A", "C", *((i % 5, i % 5 + 1) if i in set(at) else (0, 0)))
            for (c, v), at in stored.items() for i in range(1, sizes.get(c, 0) + 1)}
    got = [tuple(r) for t in tasks for r in t]
    assert len(got) == len(want) and set(got) == want
    for task in tasks:
        last, again = {}, []
        for k, r in enumerate(task):
            again.append(k - last.get(r.sample_id, k))
            last[r.sample_id] = k
        again = sorted(x for x in again if x)
        assert again[len(again) // 2] <= K.TILE_CELLS and len(again) > len(task) / 2


def test_a_cell_twice_in_a_row_is_refused(spark):
    cells = K.number_cells(spark.createDataFrame([("A", "s1"), ("A", "s2")], "cohort string, sample_id string"))
    row = [("A", "v", "chr1", 5, "A", "C", [2, 1, 2], [1, 1, 1], [1, 1, 1])]
    with pytest.raises(Exception, match="stands twice"):
        K.grid(spark.createDataFrame(row, "cohort string, variant_id string, chrom string, pos long, ref string, alt string, cells array<int>, nv array<int>, nr array<int>"), cells).collect()
