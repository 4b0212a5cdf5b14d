"""Metric reports of external tools: header/value blocks, trimming JSON, flag counts.

A report is one small file; each is parsed inside one row and files are spread over tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_reports(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """``(file, text)``, one row per report file."""
    return spark.read.text(paths, wholetext=True).select(F.col("_metadata.file_name").alias("file"), F.col("value").alias("text"))


def _bound(value: Column, work) -> Column:
    """``work`` of a value that is computed once; a lambda over arrays computes what stands outside of it again for each element."""
    return F.element_at(F.transform(F.array(value), work), 1)


def report_fields(text: Column, header: str, preferred: Sequence[str] = ()) -> Column:
    """Field map of the line after the header line that starts with ``header``.

    With ``preferred`` the value line is the one whose first field comes first in that list
    (``PAIR`` before ``UNPAIRED``); other lines are not used.
    """
    def found(lines: Column) -> Column:
        at = F.array_position(F.transform(lines, lambda s: s.startswith(header)), F.lit(True))
        return _bound(F.struct(lines.alias("lines"), at.alias("at")), placed)

    def placed(r: Column) -> Column:
        lines, at = r["lines"], r["at"]
        keys = F.split(F.get(lines, (at - 1).cast("int")), "\t")
        rest = F.when(at > 0, F.slice(lines, (at + 1).cast("int"), F.greatest(F.size(lines) - at, F.lit(0)).cast("int")))
        return _bound(F.struct(keys.alias("keys"), F.size(keys).alias("n"), rest.alias("rest")), chosen)

    def chosen(r: Column) -> Column:
        rest, n = r["rest"], r["n"]
        whole = lambda category: lambda s: s.startswith(category + "\t") & (F.size(F.split(s, "\t")) == n)
        line = F.coalesce(*[F.get(F.filter(rest, whole(c)), F.lit(0)) for c in preferred]) if preferred else F.get(rest, F.lit(0))
        return _bound(F.struct(r["keys"].alias("keys"), F.slice(F.split(line, "\t"), F.lit(1), n).alias("values")), named)

    def named(r: Column) -> Column:
        keys, values = r["keys"], r["values"]
        return F.when(values.isNotNull(), F.map_from_arrays(keys, F.zip_with(keys, values, lambda k, v: v)))

    return _bound(F.transform(F.split(text, "\r?\n"), lambda s: F.rtrim(s)), found)


def parse_metric_report(reports: DataFrame, header: str, fields: dict[str, str], preferred: Sequence[str] = (), text: str = "text") -> DataFrame:
    """Typed metric columns; ``fields`` maps a report field to ``name type``. Unreadable values are NULL."""
    mapped = reports.withColumn("_f", report_fields(F.col(text), header, preferred))
    cols = {}
    for source, spec in fields.items():
        name, kind = spec.split()
        cols[name] = F.try_element_at("_f", F.lit(source)).try_cast(kind)
    return mapped.withColumns(cols).drop("_f", text)


_SIDE = T.StructType([T.StructField(n, t) for n, t in (
    ("total_reads", T.LongType()), ("total_bases", T.LongType()), ("q20_rate", T.DoubleType()), ("q30_rate", T.DoubleType()),
    ("gc_content", T.DoubleType()), ("read1_mean_length", T.LongType()), ("read2_mean_length", T.LongType()))])
TRIM_SCHEMA = T.StructType([
    T.StructField("summary", T.StructType([T.StructField("before_filtering", _SIDE), T.StructField("after_filtering", _SIDE)])),
    T.StructField("adapter_cutting", T.StructType([T.StructField("adapter_trimmed_reads", T.LongType()), T.StructField("adapter_trimmed_bases", T.LongType())])),
    T.StructField("duplication", T.StructType([T.StructField("rate", T.DoubleType())])),
])


def parse_trim_json(reports: DataFrame, text: str = "text") -> DataFrame:
    """Trimming report to flat columns, 0 where a value is missing."""
    j = reports.withColumn("_j", F.from_json(text, TRIM_SCHEMA))
    before, after = "_j.summary.before_filtering", "_j.summary.after_filtering"
    paths = {
        "trim_total_reads": f"{before}.total_reads", "trim_total_bases": f"{before}.total_bases", "trim_q20_rate": f"{before}.q20_rate",
        "trim_q30_rate": f"{before}.q30_rate", "trim_gc_content": f"{before}.gc_content", "trim_read1_mean_length": f"{before}.read1_mean_length",
        "trim_read2_mean_length": f"{before}.read2_mean_length", "trim_reads_after_filter": f"{after}.total_reads", "trim_q30_rate_after": f"{after}.q30_rate",
        "trim_adapter_trimmed_reads": "_j.adapter_cutting.adapter_trimmed_reads", "trim_adapter_trimmed_bases": "_j.adapter_cutting.adapter_trimmed_bases",
        "trim_duplication_rate": "_j.duplication.rate",
    }
    return j.withColumns({n: F.coalesce(F.col(p), F.lit(0)) for n, p in paths.items()}).drop("_j", text)


def parse_flagstat(reports: DataFrame, text: str = "text") -> DataFrame:
    """QC-pass counts of primary, duplicate and mapped reads; 0 where a line is missing."""
    find = lambda what: F.coalesce(F.regexp_extract(text, rf"(?m)^\s*(\d+) \+ \d+ {what}", 1).try_cast("bigint"), F.lit(0))
    return reports.withColumns({"primary": find("primary$"), "duplicates": find("primary duplicates"), "mapped": find("primary mapped")}).drop(text)
