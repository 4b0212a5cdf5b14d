"""Sample sheets, manifests and wide matrices."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# fixed values: sheet column -> accepted spellings, first filled one wins
SHEET_ALIASES = {
    "biosample": ("biosampleName", "biosample", "sampleId"),
    "group": ("groups", "group"),
}
DEFAULT_GROUP = "GROUP1"


def normalize_sheet(df: DataFrame) -> DataFrame:
    """Clean names (byte-order mark, blanks) and values, resolve aliases, default the group."""
    clean = df.select([
        F.nullif(F.trim(F.col(f"`{c}`").cast("string")), F.lit("")).alias(c.replace("﻿", "").strip()) for c in df.columns
    ])
    out = clean
    for name, spellings in SHEET_ALIASES.items():
        present = [F.col(s) for s in spellings if s in clean.columns]
        default = [F.lit(DEFAULT_GROUP)] if name == "group" else []
        if present or default:
            out = out.withColumn(name, F.coalesce(*present, *default))
    return out.drop(*[s for name, sp in SHEET_ALIASES.items() for s in sp if s != name])


def read_sample_sheet(spark: SparkSession, path: str) -> DataFrame:
    """Header CSV, every column a string."""
    return normalize_sheet(spark.read.option("header", True).option("inferSchema", False).csv(path))


def split_lanes(sheet: DataFrame, read1: str = "read1", read2: str = "read2") -> DataFrame:
    """One row per sequencing lane of pipe-delimited read files."""
    lanes = F.arrays_zip(F.split(read1, "\\|").alias("a"), F.split(read2, "\\|").alias("b"))
    rest = [c for c in sheet.columns if c not in (read1, read2)]
    out = sheet.select(*rest, F.posexplode(lanes).alias("lane", "_z"))
    return out.select(*rest, "lane", F.trim("_z.a").alias(read1), F.trim("_z.b").alias(read2))


def resolve_manifest(rows: DataFrame) -> DataFrame:
    """Parameters of the first group listed; rows of other groups are left out, later entries win.

    ``rows``: ``line_no, group, param, path``.
    """
    chosen = rows.agg(F.min_by("group", "line_no")).scalar()
    own = rows.withColumn("_g", chosen).filter(F.col("group") == F.col("_g"))
    return own.groupBy("group", "param").agg(F.max_by("path", "line_no").alias("path"))


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """``group,param,path`` CSV with header; lines with fewer fields are skipped."""
    text = spark.read.text(path, wholetext=True)
    lines = text.select(F.posexplode(F.split("value", "\n")).alias("line_no", "line")).filter("line_no > 0")
    parts = F.split("line", ",", 3)
    return resolve_manifest(lines.filter(F.size(parts) == 3).select(
        "line_no", *[F.trim(F.get(parts, F.lit(i))).alias(n) for i, n in enumerate(("group", "param", "path"))]))


def emit_manifest(groups: DataFrame, params: dict[str, str]) -> DataFrame:
    """Manifest rows of each group; ``{group}`` in a path is the group's name."""
    pairs = F.array(*[F.struct(F.lit(p).alias("param"), F.replace(F.lit(t), F.lit("{group}"), F.col("group")).alias("path")) for p, t in params.items()])
    return groups.select("group", F.explode(pairs).alias("p")).select("group", "p.*")


def matrix_long(wide: DataFrame, key: str = "variant_id", value: str = "n", sample: str = "sample_id") -> DataFrame:
    """Wide matrix (first column the key) to long rows; unreadable and missing entries are 0."""
    cols = [c for c in wide.columns if c != key]
    cast = wide.select(key, *[F.coalesce(F.col(f"`{c}`").try_cast("bigint"), F.lit(0)).alias(c) for c in cols])
    return cast.unpivot([key], [f"`{c}`" for c in cols], sample, value)


def read_matrix(spark: SparkSession, path: str, value: str = "n") -> DataFrame:
    """Tab-separated count matrix with header to long rows."""
    wide = spark.read.option("header", True).option("sep", "\t").csv(path)
    return matrix_long(wide.withColumnRenamed(wide.columns[0], "variant_id"), value=value)


def write_matrix(long: DataFrame, samples: Sequence[str], value: str = "n", key: str = "variant_id", sample: str = "sample_id") -> DataFrame:
    """Long rows to the wide matrix with 0 fill, for the sink only."""
    return long.groupBy(key).pivot(sample, list(samples)).agg(F.first(value)).na.fill(0)
