"""Distribution functions, ranks and quantiles against direct computation."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from somaloom.functions import ranks, stats
from somaloom.operators import germline_stats as G


def direct_cdf(k, n, p):
    return sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))


def test_binomial_cdf_matches_the_direct_sum():
    cases = [(k, n, p) for n in (1, 7, 40, 300) for k in {0, 1, n // 3, n // 2, n - 1, n} if k >= 0 for p in (0.05, 0.5, 0.95)]
    k, n, p = (np.array(v, dtype=float) for v in zip(*cases))
    got = stats.binomial_cdf(k, n, p)
    for (a, b, c), g in zip(cases, got):
        assert g == pytest.approx(min(1.0, direct_cdf(a, b, c)), rel=1e-9, abs=1e-300)


def test_binomial_cdf_at_large_depth_is_finite_and_monotone():
    k = np.arange(0, 100001, 5000, dtype=float)
    got = stats.binomial_cdf(k, np.full(k.shape, 100000.0), np.full(k.shape, 0.5))
    assert (np.diff(got) >= 0).all() and got[-1] == 1.0 and 0.5 <= got[10] <= 0.51


def test_log_rising_keeps_digits_for_large_arguments():
    x, n = np.array([1e-6, 0.3, 5.0, 1e6, 1e9]), np.array([3.0, 5.0, 0.0, 50.0, 7.0])
    want = [sum(math.log(a + i) for i in range(int(b))) for a, b in zip(x, n)]
    assert np.allclose(stats.log_rising(x, n), want, rtol=1e-12, atol=1e-12)


def python_bh(p):
    n, order = len(p), sorted(range(len(p)), key=lambda i: -p[i])
    q, low = [0.0] * n, 1.0
    for rank, i in enumerate(order):
        low = min(low, p[i] * n / (n - rank))
        q[i] = low
    return q


def test_bh_with_a_third_of_all_values_tied(spark):
    rng = random.Random(3)
    p = [1.0] * 400 + [0.0] * 10 + [rng.random() ** 6 for _ in range(700)] + [1e-310, 1e-200, 0.999999]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(p)], "i int, p double")
    got = {r.i: r.q for r in ranks.bh_adjust(df, "p").collect()}
    want = python_bh(p)
    assert all(got[i] == pytest.approx(w, rel=1e-12, abs=1e-320) for i, w in enumerate(want))


def test_bh_by_group_and_null(spark):
    rows = [("a", 0.01), ("a", 0.04), ("a", None), ("b", 0.04), ("b", 0.04)]
    got = sorted((r.g, r.p or -1, r.q) for r in ranks.bh_adjust(spark.createDataFrame(rows, "g string, p double"), "p", ["g"]).collect())
    assert got == [("a", -1, None), ("a", 0.01, pytest.approx(0.02)), ("a", 0.04, pytest.approx(0.04)), ("b", 0.04, pytest.approx(0.04)), ("b", 0.04, pytest.approx(0.04))]


def test_ranks_and_quantiles_over_mixed_magnitudes(spark):
    rng = random.Random(5)
    values = [rng.choice([-1, 1]) * 10 ** rng.uniform(-12, 12) for _ in range(800)] + [0.0] * 200 + [1.0] * 100
    df = spark.createDataFrame([(v,) for v in values], "v double")
    q = ranks.exact_quantiles(df, "v", {"a": 0, "b": 0.1, "c": 0.5, "d": 0.975, "e": 1}).collect()[0]
    assert list(q) == pytest.approx([float(np.quantile(values, p)) for p in (0, 0.1, 0.5, 0.975, 1)], rel=1e-12)
    got = {r.v: r.avg_rank for r in ranks.average_rank(df, "v").collect()}
    ordered = sorted(values)
    for v in (0.0, 1.0, ordered[0], ordered[-1]):
        places = [i + 1 for i, w in enumerate(ordered) if w == v]
        assert got[v] == sum(places) / len(places)


def brute_rho(nv, nr):
    mu = sum(nv) / sum(nr)
    best = None
    for i, rho in enumerate(stats.rho_grid()):
        s = (1 - rho) / rho
        rise = lambda x, n: sum(math.log(x + j) for j in range(n))
        ll = round(sum(rise(mu * s, k) + rise((1 - mu) * s, n - k) - rise(s, n) for k, n in zip(nv, nr)), 7)
        if best is None or ll > best[0]:
            best = (ll, rho)
    return best[1]


def test_rho_matches_brute_force(spark):
    rng = random.Random(9)
    cohorts = {f"v{j}": [(rng.randint(0, n), n) for n in (rng.randint(1, 30) for _ in range(12))] for j in range(6)}
    cohorts["even"] = [(5, 10)] * 12
    rows = [(v, f"s{i}", k, n) for v, cells in cohorts.items() for i, (k, n) in enumerate(cells)]
    df = spark.createDataFrame(rows, "variant_id string, sample_id string, nv bigint, nr bigint")
    got = {r.variant_id: r.rho for r in G.betabinom_rho(df).collect()}
    for v, cells in cohorts.items():
        assert got[v] == pytest.approx(brute_rho([c[0] for c in cells], [c[1] for c in cells]))


def test_empty_cells_count_as_one_reference_read_when_asked(spark):
    rows = [("v", "a", 5, 10), ("v", "b", 0, 0), ("v", "c", 4, 9)]
    df = spark.createDataFrame(rows, "variant_id string, sample_id string, nv bigint, nr bigint")
    assert G.betabinom_rho(df, empty_as_one=True).collect()[0].rho == pytest.approx(brute_rho([5, 0, 4], [10, 1, 9]))


def test_binomial_tail_at_any_depth():
    from somaloom.functions import stats

    for n in (1e8, 1e10, 1e12):  # just above one half, by half the chance of the middle value
        got = stats.binomial_cdf([n / 2], [n], [0.5])[0]
        assert abs(got - 0.5 - 0.5 / np.sqrt(np.pi * n / 2)) < 1e-11
    # the expansion and the fraction agree where both hold
    k = np.array([4.6e5, 5.0e5, 5.004e5, 3.0e5 - 300]) * 10
    n, p = np.full(4, 1e7), np.array([0.46, 0.5, 0.5, 0.3])
    near = stats._beta_large(n - k, k + 1, 1 - p)
    assert np.allclose(near, stats.binomial_cdf(k, n, p), rtol=0, atol=1e-7)


def test_fraction_that_does_not_converge_is_an_error(monkeypatch):
    from somaloom.functions import stats

    monkeypatch.setattr(stats.math, "sqrt", lambda x: -99.0)
    with pytest.raises(ArithmeticError):
        stats._beta_fraction(np.array([5e5]), np.array([5e5]), np.array([0.5]))


def test_close_and_tied_values_fall_into_even_ranges(spark):
    """A million values within one per cent, 60 % of all rows one value: no range is above three times the median."""
    n = 1_000_000
    x = F.when(F.pmod(F.xxhash64("id"), F.lit(5)) < 3, 0.995).otherwise(0.99 + F.pmod(F.xxhash64("id", F.lit(7)), F.lit(10**9)) / 1e11)
    df = spark.range(n).select("id", x.alias("p"))
    written = ranks.value_ranges(df, "p")
    sizes = sorted(r["count"] for r in written.groupBy("_range").count().collect())
    assert len(sizes) >= 4 and sizes[-1] <= 3 * sizes[len(sizes) // 2]
    order = written.groupBy("_range").agg(F.min("p").alias("a"), F.max("p").alias("b")).orderBy("_range").collect()
    assert all(one.b < two.a for one, two in zip(order, order[1:]))
    tasks = sorted(r["count"] for r in ranks.dealt(written).groupBy(F.spark_partition_id().alias("t")).count().collect())
    assert tasks[-1] <= 3 * tasks[len(tasks) // 2]
    q = ranks.bh_adjust(df, "p")
    per_task = sorted(r["count"] for r in q.groupBy(F.spark_partition_id().alias("t")).count().collect())
    assert per_task[-1] <= 3 * per_task[len(per_task) // 2]
    values = {r.p: r["count"] for r in df.groupBy("p").count().collect()}
    p = np.array(sorted(values))
    high = np.cumsum([values[v] for v in p.tolist()])
    want = np.minimum(1, np.minimum.accumulate((p * n / high)[::-1])[::-1])
    got = {r.p: r.q for r in q.select("p", "q").distinct().collect()}
    assert len(got) == len(p) and np.allclose([got[v] for v in p.tolist()], want, rtol=1e-12)


def test_ranks_with_clashing_names_and_empty_tables(spark):
    rows = [(1, 0.5, 9, True, 3), (2, 0.1, 9, None, 3), (3, 0.5, None, None, 3), (4, None, 9, None, 3)]
    df = spark.createDataFrame(rows, "i int, p double, ties int, _is_hot boolean, _range int")
    got = {r.i: r.q for r in ranks.bh_adjust(df.drop("_is_hot", "_range"), "p").collect()}
    assert got == {1: 0.5, 2: pytest.approx(0.3), 3: 0.5, 4: None}
    assert ranks.bh_adjust(df.limit(0), "p").count() == 0 and ranks.average_rank(df.limit(0), "p").count() == 0
    again = ranks.bh_adjust(ranks.bh_adjust(df.select("i", "p"), "p"), "p")
    assert again.columns == ["i", "p", "q"] and again.count() == 4
