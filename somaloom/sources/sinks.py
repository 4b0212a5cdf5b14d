"""Typed outputs: schema enforcement, partitioned Parquet, status lists, nested JSON."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PARTITION_KEYS = ("workspace", "workflow_id", "biosample")


def enforce_schema(df: DataFrame, strings: Sequence[str] = (), doubles: Sequence[str] = (), bigints: Sequence[str] = (), booleans: Sequence[str] = ()) -> DataFrame:
    """Cast named columns; what cannot be read is NULL and whole numbers are rounded half to even."""
    cols = {}
    for c in df.columns:
        col = F.col(c)
        if c in strings:
            cols[c] = col.cast("string")
        elif c in doubles:
            cols[c] = col.try_cast("double")
        elif c in bigints:
            cols[c] = F.bround(col.try_cast("double")).try_cast("bigint")
        elif c in booleans:
            cols[c] = col.try_cast("boolean")
    return df.withColumns(cols)


def write_partitioned(df: DataFrame, path: str, keys: Sequence[str] = PARTITION_KEYS, mode: str = "append") -> None:
    """Hive-style Parquet. Rows are dealt by the keys; the adaptive rebalance splits a large key over as many tasks as its size asks for."""
    dealt = df.hint("rebalance", *keys)
    dealt.write.mode(mode).partitionBy(*keys).parquet(path)


def write_run(df: DataFrame, path: str, runs: str, run_id: str, keys: Sequence[str] = PARTITION_KEYS) -> None:
    """Write the partitions of one run; a repeat of the run leaves the same rows.

    Only partitions that ``df`` holds are replaced, as a whole. When they are there, the run's row list - one row per partition with its number
    of rows - replaces the run's former list in the table of runs. Readers that go by that table (:func:`read_runs`) see a run when it is
    complete; partitions that a repeat no longer holds are left out by them.
    """
    keys = list(keys)
    spark = df.sparkSession
    df.hint("rebalance", *keys).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)
    text = [F.col(k).cast("string").alias(k) for k in keys]
    written = df.groupBy(*text).agg(F.count(F.lit(1)).alias("n_rows")).withColumn("run_id", F.lit(run_id))
    none = spark.createDataFrame([(None,) * len(keys) + (None, run_id)], ", ".join([*(f"`{k}` string" for k in keys), "n_rows bigint", "run_id string"]))  # a run without rows is a run
    written.unionByName(none).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(runs)


def read_runs(spark: SparkSession, path: str, runs: str, keys: Sequence[str] = PARTITION_KEYS) -> DataFrame:
    """Rows of the partitions that some committed run lists."""
    keys = list(keys)
    listed = spark.read.parquet(runs).filter("n_rows IS NOT NULL").select(*keys).distinct()
    data = spark.read.option("recursiveFileLookup", "false").parquet(path)
    own = [F.col(k).cast("string").alias(f"_{k}") for k in keys]
    same = [F.col(f"_{k}").eqNullSafe(F.col(f"l.{k}")) for k in keys]
    cond = same[0]
    for c in same[1:]:
        cond = cond & c
    return data.select("*", *own).join(listed.alias("l"), cond, "left_semi").drop(*[f"_{k}" for k in keys])


def bins_long(segcopy: DataFrame, raw: DataFrame, **metadata) -> DataFrame:
    """Wide copy numbers and raw counts to long rows per (sample, bin), with constant metadata columns."""
    keys = ["chr", "start", "end"]
    long = lambda df, name: df.unpivot(keys, [f"`{c}`" for c in df.columns if c not in keys], "biosample", name)
    a = long(segcopy.select(*keys, *[F.col(f"`{c}`").cast("double").alias(c.replace("_sorted", "")) for c in segcopy.columns if c not in keys]), "ploidy")
    b = long(raw.select(*keys, *[F.col(f"`{c}`").cast("bigint").alias(c.replace("_sorted", "")) for c in raw.columns if c not in keys]), "raw_count")
    joined = a.join(b, ["biosample", *keys], "full")
    return joined.withColumns({k: F.lit(v) for k, v in metadata.items()})


def bins_mismatch(long: DataFrame) -> DataFrame:
    """Bins found in only one of the two inputs; must be empty."""
    return long.filter("ploidy IS NULL OR raw_count IS NULL").select("biosample", "chr", "start", "end")


def checked_bins(long: DataFrame) -> DataFrame:
    """The same rows; a bin found in only one of the two inputs ends the run."""
    both = F.col("ploidy").isNotNull() & F.col("raw_count").isNotNull()
    where = F.concat_ws(" ", F.lit("bin in one input only:"), "biosample", "chr", "start", "end")
    return long.withColumn("raw_count", F.when(both, F.col("raw_count")).otherwise(F.raise_error(where).cast("bigint")))


def status_csv(df: DataFrame) -> DataFrame:
    """Status list of a run."""
    return df.select(F.col("biosample").alias("biosampleName"), "qc_status", "pipeline", "pipeline_version")


def metrics_json(flat: DataFrame) -> DataFrame:
    """``section, key, value`` strings to one JSON object per section; numeric texts stay unquoted.

    A report has tens of keys per section.
    """
    quoted = F.when(F.col("value").rlike(r"^-?[0-9]+(\.[0-9]+)?$"), F.col("value")).otherwise(
        F.concat(F.lit('"'), F.replace(F.replace("value", F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit('"')))
    entry = F.concat(F.lit('"'), F.col("key"), F.lit('": '), quoted)
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("key", entry.alias("e")))), lambda s: s.getField("e")), ", ")
    return flat.groupBy("section").agg(F.concat(F.lit("{"), body, F.lit("}")).alias("json"))
