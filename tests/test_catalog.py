"""Registered queries: each twin parses, the entry point runs, and a sample of queries equals its twin."""

import duckdb
import pytest

import __spark_entry__ as E
from catalog.base import TABLES
from tools.check import compare

SF = "/root/testdata/sf0.001"
SAMPLE = ["variant_id_roundtrip", "explode_pileup", "pileup_metrics", "nv_nr_long", "second_pass", "vaf_split", "focal_pileup", "germline_labels",
          "filter_influence", "best_annotation", "target_coverage", "cnv_summary_metrics", "exact_quantiles", "bray_curtis", "place_variants", "parse_vcf", "place_on_trees", "optical_duplicates", "read_block_vcf"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_twin_binds_and_names_exist(con):
    queries, twins = E.queries(), E.oracle_sql()
    assert set(twins) <= set(queries) and len(queries) > 180
    for name, sql in twins.items():
        con.sql(f"EXPLAIN {sql}")


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["stage", "sample_id", "n_snv", "n_indel"] and df.count() > 0


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_twin(spark, con, name):
    problems = compare(E.queries()[name](spark, SF).toArrow(), con.sql(E.oracle_sql()[name]).to_arrow_table())
    assert not problems, problems
