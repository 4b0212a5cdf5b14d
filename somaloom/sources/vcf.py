"""Variant-call text to rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from somaloom.sources.block_gzip import SPAN, read_call_lines

FIXED = ("chrom", "pos", "id", "ref", "alt", "qual", "filter")


def parse_vcf(lines: DataFrame, file: str = "file", line: str = "value") -> DataFrame:
    """One row per (variant, sample) with INFO and FORMAT maps.

    FORMAT keys differ from row to row; keys without a value are ``.``. Sample names come from
    the one header line of each file, joined on the file name.
    """
    parts = F.split(line, "\t")
    names = lines.filter(F.col(line).startswith("#CHROM")).select(file, F.slice(parts, F.lit(10), F.size(parts) - 9).alias("_names"))
    body = lines.filter(~F.col(line).startswith("#") & (F.col(line) != "")).select(file, parts.alias("_p"))
    return _per_sample(body.join(names, file), file)


def _per_sample(body: DataFrame, file: str) -> DataFrame:
    """``_p`` (fields of a record) and ``_names`` (samples of its file) to one row per sample."""
    field = lambda i: F.get("_p", F.lit(i))
    rows = body.select(
        file, *[field(i).alias(n) for i, n in enumerate(FIXED)], field(7).alias("_info"), F.split(field(8), ":").alias("_keys"),
        F.slice("_p", F.lit(10), F.greatest(F.size("_p") - 9, F.lit(0))).alias("_values"), "_names",
    ).withColumn("pos", F.col("pos").try_cast("bigint"))
    per_sample = rows.select(file, *FIXED, "_info", "_keys", F.explode(F.arrays_zip("_names", "_values")).alias("_z"))
    values = F.split(F.col("_z._values"), ":")
    padded = F.transform("_keys", lambda k, i: F.coalesce(F.get(values, i), F.lit(".")))
    return per_sample.select(
        file, F.concat_ws("_", "chrom", "pos", "ref", "alt").alias("variant_id"), F.col("_z._names").alias("sample_id"), *FIXED,
        F.str_to_map("_info", F.lit(";"), F.lit("=")).alias("info"), F.map_from_arrays("_keys", padded).alias("fmt"))


def read_vcf(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Plain or gzip call files. Files are read line by line, so a large one is split when uncompressed."""
    lines = spark.read.text(paths).select(F.col("_metadata.file_path").alias("file"), "value")
    return parse_vcf(lines)


def read_block_vcf(spark: SparkSession, path: str, span: int = SPAN, chrom: str | None = None, start: int | None = None, end: int | None = None) -> DataFrame:
    """Block-compressed call files, each read by as many tasks as it has spans; records outside the region are left out while reading."""
    rows = read_call_lines(spark, path, span, chrom, start, end)
    return _per_sample(rows.select("file", F.split("value", "\t").alias("_p"), F.col("samples").alias("_names")), "file")


def vcf_fields(df: DataFrame, info: Sequence[str] = (), fmt: Sequence[str] = ()) -> DataFrame:
    """Named INFO / FORMAT keys as columns; absent, empty and ``.`` become NULL."""
    def pick(column: str, key: str):
        value = F.try_element_at(column, F.lit(key))
        return F.when(~value.isin("", "."), value)
    return df.withColumns({**{f"info_{k.lower()}": pick("info", k) for k in info}, **{f"fmt_{k.lower()}": pick("fmt", k) for k in fmt}}).drop("info", "fmt")
