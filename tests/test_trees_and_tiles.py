"""Optical duplicates and placement over tip ranges against brute force."""

import math
import random

import pytest

from somaloom.operators import coverage, lineage, optical

READS = "read_id bigint, sample_id string, chrom string, pos bigint, strand string, bq int, tile int, x bigint, y bigint"


def plain_optical(reads, distance):
    """Read ids flagged, by walks over all pairs of a copy group's tile."""
    groups = {}
    for r in reads:
        if None not in (*r[1:5], *r[6:]):
            groups.setdefault((r[1:5], r[6]), []).append(r)
    flagged = set()
    for own in groups.values():
        left = set(range(len(own)))
        while left:
            todo, cluster = [left.pop()], []
            while todo:
                a = todo.pop()
                cluster.append(own[a])
                near = {b for b in left if abs(own[a][7] - own[b][7]) <= distance and abs(own[a][8] - own[b][8]) <= distance}
                left -= near
                todo.extend(near)
            flagged |= {r[0] for r in sorted(cluster, key=lambda r: (-r[5], r[0]))[1:]}
    return flagged


@pytest.mark.parametrize(("n", "side", "distance"), [(400, 3000, 100), (400, 200, 7), (300, 40, 0), (500, 500, 20)])
def test_optical_clusters(spark, n, side, distance):
    draw = random.Random(n + side)
    reads = [(i, "s", "c1" if draw.random() < 0.8 else "c2", 5, draw.choice("FR"), draw.randrange(4), draw.randrange(2), draw.randrange(-side, side), draw.randrange(side)) for i in range(n)]
    got = optical.optical_duplicates(spark.createDataFrame(reads, READS), quality="bq", distance=distance).collect()
    assert len(got) == n and {r.read_id for r in got if r.is_optical} == plain_optical(reads, distance)


def test_optical_chain_and_awkward_reads(spark):
    chain = [(i, "s", "c", 1, "F", 30, 1, i * 100, i * 37) for i in range(40)]  # one long chain over many cells
    odd = [(100, "s", None, 1, "F", 30, 1, 0, 0), (101, "s", "c", 1, "F", 30, None, 0, 0), (102, "s", "c", 1, "F", 30, 1, None, 0), (103, "s", "c", 1, "F", 99, 1, 4001, 1443),
           (104, "s", "c", 1, "F", 1, 2, 0, 0), (104, "s", "c", 1, "F", 1, 2, 0, 0)]
    df = spark.createDataFrame(chain + odd, READS)
    flagged = optical.optical_duplicates(coverage.mark_duplicates(df, quality="bq"), quality="bq")
    got = flagged.collect()
    assert {r.read_id for r in got if r.is_optical} == set(range(1, 40)) and len(got) == 46  # 103 is 101 pixels off
    assert all(r.is_duplicate for r in got if r.is_optical)
    assert optical.optical_duplicates(df.limit(0), quality="bq").count() == 0
    from pyspark.sql import functions as F
    counts = optical.duplicate_counts(flagged.withColumn("paired", F.col("read_id") < 100)).first()
    assert (counts.paired_reads, counts.optical_pair_reads, counts.single_reads) == (40, 39, 6)


def test_optical_reads_meet_their_cells_once(spark):
    df = spark.createDataFrame([(i, "s", "c", 1, "F", 30, 1, i * 100, i * 37) for i in range(9)], READS)
    plan = optical.optical_duplicates(df, quality="bq")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1


def test_optical_corner_that_outermost_reads_leave_open(spark):
    # cells of 11 pixels: of the reads nearest to the corner one pair is 12 pixels apart, the other two are 10
    places = [(5, 6), (9, 1), (11, 18), (19, 11)]
    for turn in (1, -1):
        df = spark.createDataFrame([(i, "s", "c", 1, "F", 30, 1, x, turn * y + (10 if turn < 0 else 0)) for i, (x, y) in enumerate(places)], READS)
        got = optical.optical_duplicates(df, quality="bq", distance=10).collect()
        assert {r.read_id for r in got if r.is_optical} == {1, 2, 3}


@pytest.mark.parametrize("kinds", ["bq int, read_id bigint", "bq double, read_id string"])
def test_best_read_with_nulls(spark, kinds):
    ids = [1, 2, None, 3, -(2**63), 2**63 - 1]
    rows = [(g, q, i) for g, qs in enumerate([(5, 5, 5, 7, 7, 7), (None, 9, 9, 9, None, 9), (-(2**31) + 1, 2**31 - 1, 0, 0, 2**31 - 1, 2**31 - 1)]) for q, i in zip(qs, ids)]
    if "string" in kinds:
        rows = [(g, None if q is None else float(q), None if i is None else f"{i + 2**63:020d}") for g, q, i in rows]
    df = spark.createDataFrame(rows, f"g int, {kinds}")
    got = coverage.mark_duplicates(df, keys=["g"], quality="bq").collect()
    for g in range(3):
        own = [r[1:] for r in rows if r[0] == g]
        q, i = min(own, key=lambda r: (r[0] is not None, -(r[0] or 0), 0 if r[1] is None else int(r[1]) + 2**64))
        differs = lambda a, b: None if a is None or b is None else a != b
        either = lambda a, b: True if True in (a, b) else None if None in (a, b) else False
        want = {r: either(differs(r[1], i), differs(r[0], q)) for r in own}
        assert {(r.bq, r.read_id): r.is_duplicate for r in got if r.g == g} == want


def edge_tips(edges):
    """Every tip below each edge, by climbing from the tips."""
    up = {(t, e): p for t, e, p, _ in edges}
    out = []
    for t, e, _, name in edges:
        at = e
        while name is not None and at is not None:
            out.append((t, at, name))
            at = up[t, at]
    return out


def test_ranges_hold_the_tips_below(spark):
    draw = random.Random(4)
    edges = []
    for t in ("a", "b"):
        for e in range(60):
            edges.append((t, e, draw.randrange(e) if e else None, f"{t}{e}" if draw.random() < 0.6 else None))
    ranges = lineage.tip_ranges(spark.createDataFrame(edges, "tree_id string, edge_id bigint, parent_id bigint, sample_id string")).collect()
    place = {(r.tree_id, r.sample_id): r.first for r in ranges if r.sample_id is not None}
    below = {}
    for t, e, name in edge_tips(edges):
        below.setdefault((t, e), set()).add(place[t, name])
    assert {(r.tree_id, r.edge_id): set(range(r.first, r.last + 1)) for r in ranges} == below


def test_placement_equals_the_joined_one(spark, monkeypatch):
    monkeypatch.setattr(lineage, "COUNTS_PER_TASK", 50)
    draw = random.Random(5)
    edges = [("t", e, None if e == 0 else draw.randrange(e), f"c{e}" if e > 10 else None) for e in range(40)]
    counts = [("t", f"v{v}", f"c{c}", (n := draw.randrange(1, 20)) and draw.choice([0, n // 2]), n) for v in range(30) for c in range(11, 40) if draw.random() < 0.7]
    df = spark.createDataFrame(counts, "tree_id string, variant_id string, sample_id string, nv bigint, nr bigint")
    tips = spark.createDataFrame([(e, s) for _, e, s in edge_tips(edges)], "edge_id bigint, sample_id string")
    want = {r.variant_id: (r.edge_id, round(r.p_elsewhere, 6)) for r in lineage.place_variants(df, tips).collect()}
    ranges = lineage.tip_ranges(spark.createDataFrame(edges, "tree_id string, edge_id bigint, parent_id bigint, sample_id string"))
    assert {r.variant_id: (r.edge_id, round(r.p_elsewhere, 6)) for r in lineage.place_on_trees(df, ranges).collect()} == want
    assert lineage.place_on_trees(df.limit(0), ranges).count() == 0


def test_placement_on_a_long_chain(spark):
    """Tip k hangs on inner edge k of a path, so an edge of the path holds all later tips."""
    n = 5_000
    edges = [("t", k, k - 1 if k else None, None) for k in range(n)] + [("t", n + k, k, f"c{k}") for k in range(n)]
    ranges = lineage.tip_ranges(spark.createDataFrame(edges, "tree_id string, edge_id bigint, parent_id bigint, sample_id string"))
    assert ranges.count() == 2 * n
    counts = [("t", f"v{s}", f"c{k}", 10 if k >= s else 0, 20) for s in (3, 2500, 4990) for k in range(n)]
    got = lineage.place_on_trees(spark.createDataFrame(counts, "tree_id string, variant_id string, sample_id string, nv bigint, nr bigint"), ranges).collect()
    assert {r.variant_id: r.edge_id for r in got} == {"v3": 3, "v2500": 2500, "v4990": 4990}
    gap = math.exp(20 * math.log(0.5 / 0.99))  # one tip without support more, the nearest other edge
    assert all(r.p_elsewhere == pytest.approx(gap, rel=1e-3) for r in got)


def test_a_cycle_is_an_error(spark):
    loop = spark.createDataFrame([("t", 1, 2, None), ("t", 2, 1, "c"), ("t", 3, None, "d")], "tree_id string, edge_id bigint, parent_id bigint, sample_id string")
    with pytest.raises(Exception, match="without a way to a root"):
        lineage.tip_ranges(loop).collect()


@pytest.mark.parametrize("seed", range(4))
def test_placement_in_a_forest_equals_the_joined_one(spark, seed):
    """Several roots, inner edges with tips of their own, runs of edges over the same tips, few counts of many tips."""
    draw = random.Random(seed)
    edges = [("t", e, None if e < 3 else draw.randrange(max(0, e - draw.choice([1, 30])), e), f"c{e}" if draw.random() < 0.5 else None) for e in range(120)]
    number = draw.sample(range(1000), 120)
    edges = [(t, number[e], None if p is None else number[p], s) for t, e, p, s in edges]
    names = [s for *_, s in edges if s]
    counts = [("t", f"v{v}", c, draw.randrange(0, 3), 3) for v in range(40) for c in draw.sample(names, draw.choice([1, 2, 5, 20]))]
    df = spark.createDataFrame(counts, "tree_id string, variant_id string, sample_id string, nv bigint, nr bigint")
    tips = spark.createDataFrame([(e, s) for _, e, s in edge_tips(edges)], "edge_id bigint, sample_id string")
    want = {r.variant_id: (r.edge_id, round(r.p_elsewhere, 6)) for r in lineage.place_variants(df, tips).collect()}
    ranges = lineage.tip_ranges(spark.createDataFrame(edges, "tree_id string, edge_id bigint, parent_id bigint, sample_id string"))
    assert {r.variant_id: (r.edge_id, round(r.p_elsewhere, 6)) for r in lineage.place_on_trees(df, ranges).collect()} == want


def test_placement_follows_the_counts():
    """Ten counts a variant on a tree of 200 000 tips: far fewer steps than variants x edges."""
    import time

    import numpy as np

    n, m = 1 << 17, 20_000
    level = range(18)
    first = np.concatenate([np.arange(0, n, 1 << h) for h in level])
    tree = lineage._Forest(np.arange(len(first)), first, np.concatenate([np.arange(0, n, 1 << h) + (1 << h) - 1 for h in level]))
    draw = np.random.default_rng(1)
    began = time.process_time()
    v, edge, elsewhere = lineage._best_edges(np.repeat(np.arange(m), 10), draw.integers(0, n, 10 * m), np.ones(10 * m), np.ones(10 * m), (3.9, -0.68), tree)
    assert len(v) == m and (edge == len(first) - 1).mean() > 0.9 and time.process_time() - began < 60
