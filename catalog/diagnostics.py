"""Depth funnels, sparsity, sweeps and bin counts."""

from pyspark.sql import functions as F

from catalog.base import VIEWS, query
from catalog.counts import filtered, nvnr, rounded
from somaloom.operators import diagnostics as D

_MET = """(SELECT variant_id, CAST(unnest([1, 5, 10, 20]) AS INT) AS min_depth, unnest([avg(CASE WHEN nr >= 1 THEN 1.0 ELSE 0 END), avg(CASE WHEN nr >= 5 THEN 1.0 ELSE 0 END),
  avg(CASE WHEN nr >= 10 THEN 1.0 ELSE 0 END), avg(CASE WHEN nr >= 20 THEN 1.0 ELSE 0 END)]) AS share, max(nv) AS nv FROM {nvnr} GROUP BY 1)"""
_DEPTHS = "(SELECT CAST(unnest([1, 5, 10, 20]) AS INT) AS min_depth)"
VIEWS["depth_cells"] = f"""
SELECT s.sample_id, d.min_depth, count(c.variant_id) AS n_variants FROM {{samples}} s CROSS JOIN {_DEPTHS} d
LEFT JOIN (SELECT n.sample_id, m.min_depth, n.variant_id FROM {{nvnr}} n JOIN {_MET} m ON m.variant_id = n.variant_id AND m.share >= 0.5 WHERE n.nv > 0) c
  ON c.sample_id = s.sample_id AND c.min_depth = d.min_depth GROUP BY 1, 2"""
DEPTHS = (1, 5, 10, 20)


@query("depth_funnel", f"""
SELECT d.min_depth, count(m.variant_id) AS n_variants FROM {_DEPTHS} d LEFT JOIN {_MET} m ON m.min_depth = d.min_depth AND m.share >= 0.5 AND m.nv > 0 GROUP BY 1""")
def depth_funnel(d):
    return D.depth_funnel(nvnr(d), DEPTHS, 50)[0]


@query("depth_funnel_cells", "SELECT * FROM {depth_cells}")
def depth_funnel_cells(d):
    return D.depth_funnel(nvnr(d), DEPTHS, 50)[1]


@query("depth_funnel_spread", """
SELECT min_depth, quantile_cont(n_variants, 0.25) AS q25, quantile_cont(n_variants, 0.5) AS median, quantile_cont(n_variants, 0.75) AS q75, round(avg(n_variants), 6) AS mean, count(*) AS n_cells FROM {depth_cells} GROUP BY 1""")
def depth_funnel_spread(d):
    return rounded(D.depth_funnel_spread(D.depth_funnel(nvnr(d), DEPTHS, 50)[1]), "mean")


VIEWS["sparse"] = """
SELECT variant_id, avg(x) AS mean_vaf, max(x) AS max_vaf, count(x) / CAST(count(*) AS DOUBLE) AS prop_cells, count(x) AS n_cells, (max(struct_pack(x := round(x, 10), r := nr)) FILTER (WHERE x IS NOT NULL)).r AS depth_at_max
FROM (SELECT variant_id, CASE WHEN nv > 0 THEN CAST(nv AS DOUBLE) / greatest(nr, 1) END AS x, CASE WHEN nv > 0 THEN nr END AS nr FROM {nvnr}) GROUP BY 1 HAVING count(x) > 0"""


@query("vaf_sparsity", "SELECT variant_id, round(mean_vaf, 6) AS mean_vaf, round(max_vaf, 6) AS max_vaf, round(prop_cells, 6) AS prop_cells, n_cells, depth_at_max FROM {sparse}")
def vaf_sparsity(d):
    return rounded(D.vaf_sparsity(nvnr(d)), "mean_vaf", "max_vaf", "prop_cells")


_SH = ["count(*)", "100 * avg(CASE WHEN prop_cells <= 0 THEN 1.0 ELSE 0 END)", "100 * avg(CASE WHEN prop_cells > 0 AND prop_cells <= 0.05 THEN 1.0 ELSE 0 END)",
       "100 * avg(CASE WHEN prop_cells > 0.05 AND prop_cells <= 0.1 THEN 1.0 ELSE 0 END)", "100 * avg(CASE WHEN prop_cells > 0.1 THEN 1.0 ELSE 0 END)", "100 * avg(CASE WHEN mean_vaf <= 0 THEN 1.0 ELSE 0 END)",
       "100 * avg(CASE WHEN mean_vaf > 0 AND mean_vaf < 0.01 THEN 1.0 ELSE 0 END)", "100 * avg(CASE WHEN mean_vaf >= 0.01 AND mean_vaf < 0.05 THEN 1.0 ELSE 0 END)", "100 * avg(CASE WHEN mean_vaf >= 0.05 THEN 1.0 ELSE 0 END)",
       *[f"quantile_cont({c}, {q})" for c in ("prop_cells", "mean_vaf", "max_vaf") for q in (0.5, 0.9)]]
_NM = ["n_variants_rows", "pct_prop_cells_0", "pct_prop_cells_to_0.05", "pct_prop_cells_to_0.10", "pct_prop_cells_above_0.10", "pct_mean_vaf_0", "pct_mean_vaf_below_0.01", "pct_mean_vaf_below_0.05",
       "pct_mean_vaf_from_0.05", *[f"{k}_{c}" for c in ("prop_cells", "mean_vaf", "max_vaf") for k in ("median", "q90")]]


@query("sparsity_summary", f"SELECT unnest({_NM}) AS metric, round(unnest([{', '.join('CAST(' + s + ' AS DOUBLE)' for s in _SH)}]), 6) AS value FROM {{sparse}}")
def sparsity_summary(d):
    return rounded(D.sparsity_summary(D.vaf_sparsity(nvnr(d))), "value")


@query("pooled_vaf", """
SELECT variant_id, round(CAST(sum(nv) AS DOUBLE) / greatest(sum(nr), 1), 6) AS pooled_vaf,
       round(CAST(count(*) FILTER (WHERE nr > 0 AND nv > nr * 0.1::DOUBLE) AS DOUBLE) / greatest(count(*) FILTER (WHERE nr > 0), 1), 6) AS cell_fraction FROM {nvnr} GROUP BY 1""")
def pooled_vaf(d):
    return rounded(D.pooled_vaf(nvnr(d)), "pooled_vaf", "cell_fraction")


@query("hist2d", """
SELECT CAST(least(greatest(floor((nr - 0) / 60.0 * 12), 0), 11) AS INT) AS x_bin, CAST(least(greatest(floor((nv - 0) / 10.0 * 5), 0), 4) AS INT) AS y_bin, count(*) AS n FROM {nvnr} WHERE nr BETWEEN 0 AND 60 GROUP BY 1, 2""")
def hist2d(d):
    return D.hist2d(nvnr(d), "nr", "nv", (0, 60), (0, 10), 12, 5)


@query("threshold_sweep", """
WITH x AS (SELECT median_as AS v FROM {filtered} WHERE alt <> 'REF' AND n_hq_f + n_hq_r > 0), b AS (SELECT min(v) AS lo, quantile_cont(v, 0.995) AS hi, count(*) AS n FROM x),
g AS (SELECT CAST(i AS INT) AS step, lo + i * (hi - lo) / 199 AS t, n FROM b CROSS JOIN range(0, 200) r(i))
SELECT step, round(t, 6) AS threshold, round(CAST(count(x.v) AS DOUBLE) / any_value(n), 6) AS pass_fraction FROM g LEFT JOIN x ON x.v >= g.t GROUP BY 1, 2""")
def threshold_sweep(d):
    rows = d.saved("filtered", lambda: filtered(d)).filter("alt <> 'REF' AND n_hq_f + n_hq_r > 0")
    return rounded(D.threshold_sweep(rows, "median_as"), "threshold", "pass_fraction")


@query("pass_rates", """
WITH x AS (SELECT * FROM {filtered} WHERE alt <> 'REF' AND n_hq_f + n_hq_r > 0)
SELECT (SELECT count(*) FROM x) AS n, unnest(['as_pass', 'clip_pass', 'bppos_pass', 'all']) AS filter, round(unnest([avg(CASE WHEN as_pass THEN 1.0 ELSE 0 END), avg(CASE WHEN clip_pass THEN 1.0 ELSE 0 END),
  avg(CASE WHEN bppos_pass THEN 1.0 ELSE 0 END), avg(CASE WHEN as_pass AND clip_pass AND bppos_pass THEN 1.0 ELSE 0 END)]), 6) AS pass_rate FROM x""")
def pass_rates(d):
    return rounded(D.pass_rates(filtered(d).filter("alt <> 'REF' AND n_hq_f + n_hq_r > 0")), "pass_rate")


@query("binary_threshold_combos", """
SELECT combo, n_called, count(*) AS n_variants FROM (SELECT variant_id, unnest(['VAF>=0.10 NR>=5 NV>=2', 'VAF>=0.20 NR>=5 NV>=2', 'VAF>=0.30 NR>=10 NV>=3']) AS combo,
  unnest([count(*) FILTER (WHERE x >= 0.1 AND nr >= 5 AND nv >= 2), count(*) FILTER (WHERE x >= 0.2 AND nr >= 5 AND nv >= 2), count(*) FILTER (WHERE x >= 0.3 AND nr >= 10 AND nv >= 3)]) AS n_called
  FROM (SELECT *, CASE WHEN nr > 0 THEN CAST(nv AS DOUBLE) / nr ELSE 0 END AS x FROM {nvnr}) GROUP BY 1) GROUP BY 1, 2""")
def binary_threshold_combos(d):
    return D.binary_threshold_combos(nvnr(d))


@query("depth_support_profile", """
SELECT quantile_cont(nr, 0.5) FILTER (WHERE nr > 0) AS nr_median, quantile_cont(nr, 0.99) FILTER (WHERE nr > 0) AS nr_p99, quantile_cont(nv, 0.5) FILTER (WHERE nv > 0) AS nv_median,
       quantile_cont(nv, 0.99) FILTER (WHERE nv > 0) AS nv_p99 FROM {nvnr}""")
def depth_support_profile(d):
    return D.depth_support_profile(nvnr(d))


@query("vaf_histogram", """
SELECT CASE WHEN nr >= 20 THEN '>=20' WHEN nr >= 10 THEN '10-19' WHEN nr >= 5 THEN '5-9' ELSE '1-4' END AS nr_class, CASE WHEN x >= 0.9 THEN 9 WHEN x >= 0.8 THEN 8 WHEN x >= 0.7 THEN 7 WHEN x >= 0.6 THEN 6
  WHEN x >= 0.5 THEN 5 WHEN x >= 0.4 THEN 4 WHEN x >= 0.3 THEN 3 WHEN x >= 0.2 THEN 2 WHEN x >= 0.1 THEN 1 ELSE 0 END AS decile, count(*) AS n
FROM (SELECT nr, round(CAST(nv AS DOUBLE) / nr, 6) AS x FROM {nvnr} WHERE nr > 0) GROUP BY 1, 2""")
def vaf_histogram(d):
    return D.vaf_histogram(nvnr(d))
