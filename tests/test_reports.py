"""Reports with many fields, and their spread over tasks."""

import time

from pyspark.sql import functions as F

from catalog.base import spread
from somaloom.sources import reports


def test_report_fields_are_parsed_once(spark):
    """A wide header: a value is looked up by its place, without parsing the report again for each field."""
    wide = "\t".join(f"F{k}" for k in range(300))
    rows = spark.range(2_000).selectExpr("id", f"concat('# x\\nCATEGORY\\t{wide}\\nOTHER\\t1\\nUNPAIRED', repeat('\\t7', 300), '\\nPAIR\\t5', repeat('\\t', 299), '\\nPAIR\\t1\\n') AS text")
    began = time.monotonic()
    got = reports.parse_metric_report(rows, "CATEGORY", {"F0": "a bigint", "F299": "z bigint"}, ["PAIR", "UNPAIRED"]).groupBy("a", "z").count().collect()
    assert [(r.a, r.z, r["count"]) for r in got] == [(5, None, 2_000)] and time.monotonic() - began < 20
    short = spark.createDataFrame([("A\tB\tC\n1\t2",), ("A\tB\n1\t2\t3",), ("A",), ("x",), (None,)], "text string")
    assert [r[0] for r in short.select(reports.report_fields(F.col("text"), "A")).collect()] == [{"A": "1", "B": "2", "C": None}, {"A": "1", "B": "2"}, None, None, None]
    assert spread(spark.range(1_000).withColumnRenamed("id", "biosample"), "biosample", 100).rdd.getNumPartitions() == 11
