"""Projected tables and the query registry.

The given tables hold no genomics data, so each projection below re-reads one of
them as the table an operator expects. Projections are portable SQL: the same
text runs in Spark (here) and in the SQL twin of a query.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from somaloom.session import cut_lineage

TABLES = ("lineitem", "orders", "customer", "part", "supplier", "nation", "region", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations")

VIEWS: dict[str, str] = {}

# one observation (read-base) at one of at most 400 sites in 24 cells
VIEWS["reads"] = """
SELECT l_orderkey*10 + l_linenumber AS read_id,
       concat('cell_', lpad(CAST(l_suppkey % 24 AS STRING), 2, '0')) AS sample_id,
       CASE WHEN (l_partkey % 400) % 23 = 22 THEN 'chrX'
            ELSE concat('chr', CAST((l_partkey % 400) % 23 + 1 AS STRING)) END AS chrom,
       1000 + (l_partkey % 400) * 37 AS pos,
       substr('ACGT', CAST((l_partkey % 400) % 4 + 1 AS INT), 1) AS ref,
       concat(substr('CGTA', CAST((l_partkey % 400) % 4 + 1 AS INT), 1),
              CASE WHEN (l_partkey % 400) % 9 = 0 THEN 'TT' ELSE '' END) AS alt,
       CASE (l_partkey % 400) % 5
            WHEN 0 THEN l_linenumber % 2 = 1
            WHEN 1 THEN l_suppkey % 24 = (l_partkey % 400) % 24 AND l_linenumber <> 7
            WHEN 2 THEN l_suppkey % 24 < 6 AND l_linenumber >= 3
            WHEN 3 THEN l_linenumber = 7 AND l_discount > 0.08
            ELSE FALSE END AS is_alt,
       CASE WHEN l_linestatus = 'O' THEN 'R' ELSE 'F' END AS strand,
       CAST(20 + l_orderkey % 41 AS INT) AS mq,
       CAST(24 + l_linenumber * 3 AS INT) AS bq,
       CAST(floor(l_quantity * 3) AS INT) AS bp_start,
       CAST(round(128 + l_discount * 300) AS INT) AS aln_score,
       l_returnflag = 'A' AND l_tax > 0.05 AS clipped
FROM {lineitem}"""

# the same reads with the observed allele spelled as a pileup does (REF or the alternate)
VIEWS["obs"] = """
SELECT r.*, CASE WHEN is_alt THEN alt ELSE 'REF' END AS allele,
       concat(chrom, '_', CAST(pos AS STRING), '_', ref, '_', CASE WHEN is_alt THEN alt ELSE ref END) AS allele_id,
       concat(chrom, '_', CAST(pos AS STRING), '_', ref, '_', alt) AS variant_id
FROM {reads} r"""

VIEWS["calls"] = """
SELECT sample_id, chrom, pos, ref, alt, variant_id, dp, ad_alt,
       CASE WHEN ad_alt = 0 THEN '0/0' WHEN ad_alt >= 0.8*dp THEN '1/1' ELSE '0/1' END AS gt,
       CASE WHEN (pos + dp) % 4 = 0 THEN 'MLrejected' WHEN pos % 2 = 0 THEN 'PASS' ELSE '.' END AS filter
FROM (SELECT sample_id, chrom, pos, ref, alt, variant_id, count(*) AS dp,
             CAST(sum(CASE WHEN is_alt THEN 1 ELSE 0 END) AS BIGINT) AS ad_alt
      FROM {obs} GROUP BY sample_id, chrom, pos, ref, alt, variant_id) t"""

VIEWS["sites"] = "SELECT DISTINCT variant_id, chrom, pos, ref, alt FROM {obs}"

VIEWS["samples"] = "SELECT DISTINCT sample_id FROM {obs}"

VIEWS["annotation"] = """
SELECT v.variant_id, v.chrom, v.pos, v.ref, v.alt, p.p_partkey AS csq_no, p.p_brand AS symbol,
       CASE p.p_size % 4 WHEN 0 THEN 'HIGH' WHEN 1 THEN 'MODERATE' WHEN 2 THEN 'LOW' ELSE 'MODIFIER' END AS impact,
       CASE p.p_size % 7 WHEN 0 THEN 'pathogenic' WHEN 1 THEN 'likely_pathogenic' WHEN 2 THEN 'uncertain_significance'
            WHEN 3 THEN 'benign' WHEN 4 THEN 'likely_benign' END AS clin_sig,
       CASE WHEN p.p_size % 3 = 0 THEN NULL ELSE CAST(p.p_size AS DOUBLE) / 1000 END AS max_af,
       CASE WHEN p.p_size % 5 = 0 THEN concat('rs', CAST(p.p_partkey AS STRING)) WHEN p.p_size % 5 = 1 THEN 'COSV1' END AS existing,
       concat('ENSG', CAST(p.p_partkey % 97 AS STRING)) AS gene,
       CASE p.p_partkey % 6 WHEN 0 THEN 'missense_variant' WHEN 1 THEN 'synonymous_variant' WHEN 2 THEN 'frameshift_variant'
            WHEN 3 THEN 'intergenic_variant' WHEN 4 THEN 'intron_variant' ELSE 'splice_donor_variant' END AS consequence
FROM {sites} v
JOIN {part} p ON 1000 + (p.p_partkey % 400) * 37 = v.pos"""

VIEWS["bins"] = """
SELECT concat('cell_', lpad(CAST(user_id % 24 AS STRING), 2, '0')) AS sample_id,
       concat('chr', CAST(1 + (day(ts) - 1) % 6 AS STRING)) AS chrom,
       CAST((hour(ts) + 24 * floor((day(ts) - 1) / 6)) AS BIGINT) * 1000000 AS bin_start,
       count(*) AS raw_count
FROM {events} GROUP BY 1, 2, 3"""

VIEWS["qc"] = """
SELECT concat('cell_', CAST(c_custkey AS STRING)) AS biosample, c_mktsegment AS grp,
       CASE WHEN c_custkey % 17 = 0 THEN 0 ELSE CAST(floor(abs(c_acctbal) * 20000) AS BIGINT) END AS total_reads,
       CAST(c_custkey % 50 AS DOUBLE) / 100 AS pct_duplication, CAST(c_custkey % 31 AS DOUBLE) / 100 AS pct_chimeras,
       1 - CAST(c_custkey % 23 AS DOUBLE) / 100 AS pct_1x, 1 - CAST(c_custkey % 43 AS DOUBLE) / 100 AS pct_5x,
       CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE CAST(c_custkey % 37 AS DOUBLE) / 100 END AS skew_cnv,
       CAST(c_custkey % 41 AS DOUBLE) / 100 AS mapd_cnv_log2,
       CAST(floor(abs(c_acctbal) * 1000000) AS BIGINT) AS preseq_count,
       CAST(c_custkey % 29 AS DOUBLE) / 100 AS pct_chrm,
       1 - CAST(c_custkey % 37 AS DOUBLE) / 100 AS pct_target_bases_10x,
       CAST(c_custkey % 11 AS DOUBLE) / 100 AS zero_cvg_targets_pct,
       1 + CAST(c_custkey % 9 AS DOUBLE) AS fold_80_base_penalty,
       1 - CAST(c_custkey % 47 AS DOUBLE) / 100 AS prop_mappability,
       1 - CAST(c_custkey % 53 AS DOUBLE) / 100 AS prop_exonic,
       CAST(c_custkey % 19 AS DOUBLE) / 100 AS prop_intergenic,
       CAST(c_custkey % 16 AS DOUBLE) / 100 AS prop_mitochondrial,
       CAST(c_custkey % 1200 AS DOUBLE) AS protein_coding_genes
FROM {customer}"""

VIEWS["activity"] = """
SELECT CASE o_orderkey % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'B' ELSE 'C' END AS method,
       concat('cell_', lpad(CAST(o_custkey % 24 AS STRING), 2, '0')) AS sample_id,
       concat('SBS', CAST(o_custkey % 11 AS STRING)) AS signature, count(*) AS activity
FROM {orders} GROUP BY 1, 2, 3"""

VIEWS["expression"] = """
SELECT concat('cell_', lpad(CAST(l_suppkey % 24 AS STRING), 2, '0')) AS sample_id,
       concat('G', CAST(l_partkey % 300 AS STRING)) AS gene, CAST(sum(l_quantity) AS BIGINT) AS n
FROM {lineitem} GROUP BY 1, 2"""

VIEWS["edge_tips"] = """
SELECT CAST(c AS INT) AS edge_id, concat('cell_', lpad(CAST(c AS STRING), 2, '0')) AS sample_id
FROM (SELECT DISTINCT l_suppkey % 24 AS c FROM {lineitem}) a
UNION ALL SELECT CAST(100 + floor(c / 6) AS INT), concat('cell_', lpad(CAST(c AS STRING), 2, '0'))
FROM (SELECT DISTINCT l_suppkey % 24 AS c FROM {lineitem}) b
UNION ALL SELECT CAST(200 + floor(c / 12) AS INT), concat('cell_', lpad(CAST(c AS STRING), 2, '0'))
FROM (SELECT DISTINCT l_suppkey % 24 AS c FROM {lineitem}) d"""

# high-quality counts per cell and site on the full cell x site grid (the SQL twin of the count matrices)
VIEWS["nvnr"] = """
SELECT v.variant_id, s.sample_id, v.chrom, v.pos, v.ref, v.alt,
       coalesce(c.nv, 0) AS nv, coalesce(c.nr, 0) AS nr
FROM {sites} v CROSS JOIN {samples} s
LEFT JOIN (SELECT variant_id, sample_id, count(*) AS nr,
                  CAST(sum(CASE WHEN is_alt THEN 1 ELSE 0 END) AS BIGINT) AS nv
           FROM {obs} WHERE mq >= 30 AND bq >= 30 GROUP BY variant_id, sample_id) c
  ON c.variant_id = v.variant_id AND c.sample_id = s.sample_id"""

# per (cell, allele) pileup metrics and their pass flags (SQL twins of the pileup operators)
VIEWS["metrics"] = """
SELECT m.*, CAST(sum(n_all_f + n_all_r) OVER (PARTITION BY sample_id, chrom, pos) AS BIGINT) AS depth_all,
       CAST(sum(n_hq_f + n_hq_r) OVER (PARTITION BY sample_id, chrom, pos) AS BIGINT) AS depth_hq
FROM (
SELECT sample_id, allele_id AS variant_id, chrom, pos, ref, allele AS alt,
       count(*) FILTER (WHERE strand = 'F') AS n_all_f, count(*) FILTER (WHERE strand = 'R') AS n_all_r,
       count(*) FILTER (WHERE strand = 'F' AND hq) AS n_hq_f, count(*) FILTER (WHERE strand = 'R' AND hq) AS n_hq_r,
       median(aln_score) AS median_as, avg(CASE WHEN clipped THEN 1.0 ELSE 0.0 END) AS prop_clipped,
       avg(CASE WHEN bp_start < 15 THEN 1.0 ELSE 0.0 END) FILTER (WHERE strand = 'F' AND hq) AS prop_under_f,
       avg(CASE WHEN bp_start < 15 THEN 1.0 ELSE 0.0 END) FILTER (WHERE strand = 'R' AND hq) AS prop_under_r,
       avg(CASE WHEN bp_start > 135 THEN 1.0 ELSE 0.0 END) FILTER (WHERE strand = 'F' AND hq) AS prop_upper_f,
       avg(CASE WHEN bp_start > 135 THEN 1.0 ELSE 0.0 END) FILTER (WHERE strand = 'R' AND hq) AS prop_upper_r,
       stddev_samp(bp_start) FILTER (WHERE strand = 'F' AND hq) AS sd_f,
       stddev_samp(bp_start) FILTER (WHERE strand = 'R' AND hq) AS sd_r,
       1.4826 * mad(bp_start) FILTER (WHERE strand = 'F' AND hq) AS mad_f,
       1.4826 * mad(bp_start) FILTER (WHERE strand = 'R' AND hq) AS mad_r
FROM (SELECT o.*, mq >= 30 AND bq >= 30 AS hq FROM {obs} o)
GROUP BY 1, 2, 3, 4, 5, 6) m"""

_SPREAD = "(coalesce(prop_under_{a}, 1) < 0.4 AND coalesce(prop_upper_{a}, 1) < 0.4)"
_WIDE = "(coalesce(sd_{a}, 0) > {sd} AND coalesce(mad_{a}, 0) > {mad})"
_ONE = {a: "(" + _SPREAD.format(a=a) + " OR " + _WIDE.format(a=a, sd=12, mad=8) + ")" for a in "fr"}
_TWO = {a: "(" + _SPREAD.format(a=a) + " AND (" + _WIDE.format(a=a, sd=25, mad=12) + " OR "
        + _WIDE.format(a=b, sd=25, mad=12) + "))" for a, b in (("f", "r"), ("r", "f"))}
VIEWS["filtered"] = f"""
SELECT f.*, bool_or(as_pass AND clip_pass AND bppos_pass) OVER (PARTITION BY variant_id) AS variant_pass
FROM (
SELECT m.*, alt <> 'REF' AND median_as >= 140 AS as_pass, alt <> 'REF' AND prop_clipped < 0.4 AS clip_pass,
       alt <> 'REF' AND CASE WHEN n_hq_f > 1 AND n_hq_r > 1 THEN {_TWO['f']} OR {_TWO['r']}
            WHEN n_hq_f > 1 THEN {_ONE['f']} WHEN n_hq_r > 1 THEN {_ONE['r']} ELSE FALSE END AS bppos_pass
FROM {{metrics}} m) f"""

_REF = re.compile(r"\{(\w+)\}")


def _chain(sql: str, seen: list[str]) -> list[str]:
    for name in _REF.findall(sql):
        if name in VIEWS and name not in seen:
            _chain(VIEWS[name], seen)
            if name not in seen:
                seen.append(name)
    return seen


def expand(sql: str) -> str:
    """Full SQL text: the needed projections as a WITH chain, then the query."""
    strip = lambda text: _REF.sub(lambda m: m.group(1) if m.group(1) in VIEWS or m.group(1) in TABLES else m.group(0), text)
    body = strip(sql.strip())
    names = _chain(sql, [])
    if not names:
        return body
    chain = ",\n".join(f"{n} AS ({strip(VIEWS[n]).strip()})" for n in names)
    return f"WITH {chain}{',' + body[4:] if body.upper().startswith('WITH ') else chr(10) + body}"


@dataclass
class Data:
    """Lazily built DataFrames over one scale-factor folder."""

    spark: SparkSession
    sf_dir: str
    _made: dict[str, DataFrame] = field(default_factory=dict)

    def __getattr__(self, name: str) -> DataFrame:
        if name in self._made:
            return self._made[name]
        if name in TABLES:
            df = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        elif name in VIEWS:
            needs = {n: getattr(self, n) for n in dict.fromkeys(_REF.findall(VIEWS[name]))}
            df = self.spark.sql(VIEWS[name], **needs)
        else:
            raise AttributeError(name)
        self._made[name] = df
        return df


    def saved(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """A stage that several later stages re-read, written once to the checkpoint folder."""
        key = f"saved:{name}"
        if key not in self._made:
            self._made[key] = cut_lineage(build())
        return self._made[key]


def spread(df: DataFrame, key: str, rows: int = 1 << 15) -> DataFrame:
    """``df`` dealt by ``key`` to tasks of about ``rows`` rows, for rows that become long texts: a small file would be one task."""
    return df.repartition(df.count() // rows + 1, key)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_RAW_SQL: dict[str, str] = {}


def oracle() -> dict[str, str]:
    """Full SQL text of every query that has a twin."""
    return {name: expand(sql) for name, sql in _RAW_SQL.items()}


def query(name: str, sql: str | None = None):
    """Register ``fn(Data) -> DataFrame`` and, when the result is SQL-expressible, its SQL twin."""

    def register(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = lambda spark, sf_dir: fn(Data(spark, sf_dir))
        if sql is not None:
            _RAW_SQL[name] = sql
        return fn

    return register
