"""Statistical passes over the count table."""

from pyspark.sql import functions as F

from catalog.base import VIEWS, query
from catalog.counts import nvnr
from somaloom.functions import ranks as R
from somaloom.functions.stats import binomial_less_pvalue
from somaloom.operators import germline_stats as G


def pbinom(k: str, n: str, p: str) -> str:
    """SQL for P(X <= k), X ~ Binomial(n, p), as a sum of exact log terms."""
    return (f"CASE WHEN {n} = 0 OR {k} >= {n} THEN 1.0 ELSE least(1.0, list_sum(list_transform(range(0, CAST({k} AS BIGINT) + 1), "
            f"lambda i: exp(lgamma({n} + 1.0) - lgamma(i + 1.0) - lgamma({n} - i + 1.0) + i * ln({p}) + ({n} - i) * ln(1 - {p}))))) END")


def bh(p: str, source: str, by: str = "", out: str = "q") -> str:
    """SQL text adding a Benjamini-Hochberg column to ``source``."""
    part = f"PARTITION BY {by}" if by else ""
    return (f"SELECT *, least(1.0, min({p} * _n / _r) OVER ({part} ORDER BY {p} DESC ROWS UNBOUNDED PRECEDING)) AS {out}_raw FROM ("
            f"SELECT *, count(*) OVER ({part}) AS _n, count(*) OVER ({part} ORDER BY {p} RANGE UNBOUNDED PRECEDING) AS _r FROM ({source}))")


def bh_ties(p: str, source: str, by: str = "", out: str = "q") -> str:
    """As :func:`bh`, with the value shared by equal p."""
    part = f"{by}, " if by else ""
    return f"SELECT *, min({out}_raw) OVER (PARTITION BY {part}{p}) AS {out} FROM ({bh(p, source, by, out)})"


HALF = "CASE WHEN chrom = 'chrX' THEN 0.95 ELSE 0.5 END"

VIEWS["pooled"] = """
SELECT variant_id, chrom, ref, alt, CAST(sum(nv) AS BIGINT) AS k, CAST(sum(nr) AS BIGINT) AS n, avg(nr) AS mean_depth,
       count(*) FILTER (WHERE nv > 0) AS n_carriers FROM {nvnr} GROUP BY 1, 2, 3, 4"""
VIEWS["pvals"] = f"SELECT *, {pbinom('k', 'n', HALF)} AS p FROM {{pooled}}"


def rho_sql(source: str) -> str:
    """SQL twin of the grid likelihood: ``source`` has variant_id, nv, nr."""
    rise = lambda x, n: f"coalesce(list_sum(list_transform(range(0, {n}), lambda j: ln({x} + j))), 0)"
    return f"""
SELECT variant_id, pow(10, -6 + 0.05 * arg_min(i, struct_pack(l := -round(ll, 7), i := i))) AS rho FROM (
  SELECT variant_id, i, sum({rise('mu * s', 'nv')} + {rise('(1 - mu) * s', 'nr - nv')} - {rise('s', 'nr')}) AS ll
  FROM (SELECT c.variant_id, c.nv, c.nr, m.mu, g.i, (1 - pow(10, -6 + 0.05 * g.i)) / pow(10, -6 + 0.05 * g.i) AS s
        FROM ({source}) c JOIN (SELECT variant_id, sum(nv) / sum(nr) AS mu FROM ({source}) GROUP BY 1) m USING (variant_id)
        CROSS JOIN range(0, 120) g(i) WHERE c.nr > 0)
  GROUP BY 1, 2) GROUP BY 1"""


@query("binomial_less_pvalue", f"SELECT variant_id, k, n, round({pbinom('k', 'n', '0.3')}, 6) AS p FROM {{pooled}}")
def binomial(d):
    pooled = nvnr(d).groupBy("variant_id").agg(F.sum("nv").alias("k"), F.sum("nr").alias("n"))
    return pooled.select("variant_id", "k", "n", F.round(binomial_less_pvalue("k", "n", 0.3), 6).alias("p"))


@query("group_depth", """
SELECT variant_id, round(mean_depth, 6) AS mean_depth, CASE WHEN chrom = 'chrX' THEN mean_depth > 1.5 AND mean_depth < 1000
       ELSE mean_depth > 3 AND mean_depth < 2000 END AS depth_filter FROM {pooled}""")
def group_depth(d):
    g = G.group_depth(nvnr(d), 3, 2000)
    return g.select("variant_id", F.round("mean_depth", 6).alias("mean_depth"), "depth_filter")


@query("bh_adjust", f"""
SELECT variant_id, round(q, 6) AS q, round(cq, 6) AS chrom_q
FROM ({bh_ties('p', 'SELECT variant_id, chrom, p FROM {pvals}')}) JOIN
     (SELECT variant_id, q AS cq FROM ({bh_ties('p', 'SELECT variant_id, chrom, p FROM {pvals}', 'chrom')})) USING (variant_id)""")
def bh_adjust(d):
    p = G.germline_pvalues(nvnr(d)).select("variant_id", "chrom", F.col("germline_p").alias("p"))
    both = R.bh_adjust(R.bh_adjust(p, "p"), "p", by=["chrom"], out="chrom_q")
    return both.select("variant_id", F.round("q", 6).alias("q"), F.round("chrom_q", 6).alias("chrom_q"))


@query("average_rank", """
SELECT l_orderkey, l_linenumber, l_extendedprice,
       rank() OVER (ORDER BY l_quantity) + (count(*) OVER (PARTITION BY l_quantity) - 1) / 2.0 AS quantity_rank,
       rank() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice)
         + (count(*) OVER (PARTITION BY l_returnflag, l_extendedprice) - 1) / 2.0 AS price_rank FROM {lineitem}""")
def average_rank(d):
    rows = d.lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity", "l_returnflag")
    ranked = R.average_rank(rows, "l_quantity", out="quantity_rank")
    ranked = R.average_rank(ranked, "l_extendedprice", by=["l_returnflag"], out="price_rank")
    return ranked.select("l_orderkey", "l_linenumber", "l_extendedprice", "quantity_rank", "price_rank")


@query("exact_quantiles", """
SELECT l_returnflag, round(quantile_cont(l_extendedprice, 0.0), 6) AS q0, round(quantile_cont(l_extendedprice, 0.25), 6) AS q25,
       round(quantile_cont(l_extendedprice, 0.5), 6) AS q50, round(quantile_cont(l_extendedprice, 0.99), 6) AS q99,
       round(quantile_cont(l_extendedprice, 1.0), 6) AS q100 FROM {lineitem} GROUP BY 1""")
def exact_quantiles(d):
    q = R.exact_quantiles(d.lineitem, "l_extendedprice", {"q0": 0, "q25": 0.25, "q50": 0.5, "q99": 0.99, "q100": 1}, ["l_returnflag"])
    return q.select("l_returnflag", *[F.round(c, 6).alias(c) for c in ("q0", "q25", "q50", "q99", "q100")])


@query("betabinom_rho", f"SELECT variant_id, round(rho, 9) AS rho FROM ({rho_sql('SELECT variant_id, nv, nr FROM {nvnr}')})")
def betabinom_rho(d):
    return G.betabinom_rho(nvnr(d)).select("variant_id", F.round("rho", 9).alias("rho"))


_TESTED = ("SELECT variant_id, nv, greatest(nr, 1) AS nr FROM {nvnr} WHERE variant_id IN (SELECT variant_id FROM ("
           + bh_ties("p", "SELECT * FROM {pvals}", "chrom") + ") WHERE q < 0.05 AND n_carriers > 1)")
VIEWS["stats"] = f"""
SELECT v.variant_id, v.chrom, v.ref, v.alt, v.mean_depth, TRUE AS depth_filter, v.p AS germline_p, r.rho
FROM {{pvals}} v LEFT JOIN ({rho_sql(_TESTED)}) r ON r.variant_id = v.variant_id"""
VIEWS["verdicts"] = f"""
SELECT *, germline_q > 0 AND log10(CASE WHEN germline_q > 0 THEN germline_q ELSE 1 END) < -5 OR germline_q = 0 AS germline_filter,
       rho IS NULL OR rho > 0.1 AS betabinom_filter FROM ({bh_ties('germline_p', 'SELECT * FROM {stats}', '', 'germline_q')})"""


@query("first_pass", """
SELECT variant_id, round(mean_depth, 6) AS mean_depth, depth_filter, round(germline_p, 6) AS germline_p,
       round(log10(greatest(germline_p, 1e-300)), 6) AS germline_p_log10, round(rho, 9) AS rho FROM {stats}""")
def first_pass(d):
    s = G.first_pass(nvnr(d))
    return s.select("variant_id", F.round("mean_depth", 6).alias("mean_depth"), "depth_filter",
                    F.round("germline_p", 6).alias("germline_p"),
                    F.round(F.greatest("germline_p_log10", F.lit(-300.0)), 6).alias("germline_p_log10"),
                    F.round("rho", 9).alias("rho"))


@query("first_pass_verdict", """
SELECT variant_id, round(germline_q, 6) AS germline_q, germline_filter, betabinom_filter,
       concat('TRUE_', upper(CAST(germline_filter AS STRING)), '_', upper(CAST(betabinom_filter AS STRING))) AS verdict FROM {verdicts}""")
def first_pass_verdict(d):
    v = G.first_pass_verdict(G.first_pass(nvnr(d)))
    return v.select("variant_id", F.round("germline_q", 6).alias("germline_q"), "germline_filter", "betabinom_filter", "verdict")


VIEWS["second"] = f"""
SELECT v.variant_id, v.chrom, v.ref, v.alt, v.mean_depth, v.q AS germline_q, r.rho
FROM ({bh_ties('p', 'SELECT * FROM {pvals}', 'chrom')}) v
LEFT JOIN ({rho_sql('SELECT variant_id, nv, nr FROM {nvnr}')}) r ON r.variant_id = v.variant_id"""


@query("second_pass", """
SELECT variant_id, round(mean_depth, 6) AS mean_depth, round(germline_q, 6) AS germline_q, round(rho, 9) AS rho,
       CASE WHEN log10(greatest(germline_q, 1e-300)) < -2 AND rho > CASE WHEN length(ref) > 1 OR length(alt) > 1 THEN 0.05 ELSE 0.01 END
       THEN 'Pass' ELSE 'Fail' END AS second_pass FROM {second}""")
def second_pass(d):
    s = G.second_pass(nvnr(d), q_cut=-2, rho_snv=0.01, rho_indel=0.05)
    return s.select("variant_id", F.round("mean_depth", 6).alias("mean_depth"), F.round("germline_q", 6).alias("germline_q"),
                    F.round("rho", 9).alias("rho"), "second_pass")


@query("low_vaf_in_positive", f"""
SELECT variant_id, round(CASE WHEN k = 0 THEN 0 ELSE {pbinom('k', 'n', HALF)} END, 6) AS p_positive
FROM (SELECT variant_id, chrom, coalesce(CAST(sum(nv) FILTER (WHERE nv >= 3) AS BIGINT), 0) AS k,
             coalesce(CAST(sum(nr) FILTER (WHERE nv >= 3) AS BIGINT), 0) AS n FROM {{nvnr}} GROUP BY 1, 2)""")
def low_vaf_in_positive(d):
    return G.low_vaf_in_positive(nvnr(d)).select("variant_id", F.round("p_positive", 6).alias("p_positive"))


@query("low_vaf_flag", """
SELECT variant_id, bool_or(CAST(nv AS DOUBLE) / greatest(nr, 1) > 0.6) AS low_vaf FROM {nvnr} GROUP BY 1""")
def low_vaf_flag(d):
    return G.low_vaf_flag(nvnr(d), 0.6)


_CELL = f"SELECT *, {pbinom('nv', 'm', HALF)} AS p FROM (SELECT *, greatest(nr, 1) AS m FROM {{nvnr}})"


@query("cell_pvalues", f"""
SELECT variant_id, sample_id, round(p, 6) AS p_value, round(q, 6) AS q_value FROM ({bh_ties('p', 'SELECT variant_id, sample_id, round(p, 12) AS p FROM (' + _CELL + ')')})""")
def cell_pvalues(d):
    c = G.cell_pvalues(nvnr(d)).withColumn("p_value", F.round("p_value", 12))
    c = R.bh_adjust(c, "p_value", out="q_value")
    return c.select("variant_id", "sample_id", F.round("p_value", 6).alias("p_value"), F.round("q_value", 6).alias("q_value"))


@query("infer_sex", """
SELECT round(x, 6) AS xy_depth, round(a, 6) AS autosomal_depth, CASE WHEN x <= 0.8 * a THEN 'male' ELSE 'female' END AS sex
FROM (SELECT avg(nr) FILTER (WHERE chrom = 'chrX') AS x, avg(nr) FILTER (WHERE chrom <> 'chrX') AS a FROM {nvnr})""")
def infer_sex(d):
    s = G.infer_sex(nvnr(d))
    return s.select(F.round("xy_depth", 6).alias("xy_depth"), F.round("autosomal_depth", 6).alias("autosomal_depth"), "sex")


@query("genotype_discretize", """
SELECT variant_id, sample_id, CASE WHEN x < 0.1 * h THEN 0.0::DOUBLE WHEN x >= 0.3 * h THEN 1.0::DOUBLE ELSE 0.5::DOUBLE END AS genotype
FROM (SELECT *, CAST(nv AS DOUBLE) / greatest(nr, 1) AS x, CASE WHEN chrom = 'chrX' THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS h FROM {nvnr})""")
def genotype_discretize(d):
    return G.genotype_discretize(nvnr(d)).select("variant_id", "sample_id", "genotype")


@query("genotype_prob", f"""
SELECT variant_id, sample_id, CASE WHEN (nv > 0 AND p > 0.01 - 1e-12 AND NOT gate) OR (nv >= 3 AND p > 0.001 - 1e-12 AND NOT gate) OR (nv = 0 AND p > 0.05 - 1e-12)
       THEN 0.5::DOUBLE WHEN gate THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS genotype
FROM (SELECT *, nv >= 2 AND p > 0.05 - 1e-12 AND CAST(nv AS DOUBLE) / m > CASE WHEN chrom = 'chrX' THEN 0.7 ELSE 0.2 END AS gate FROM ({_CELL}))""")
def genotype_prob(d):
    return G.genotype_prob(nvnr(d)).select("variant_id", "sample_id", "genotype")
