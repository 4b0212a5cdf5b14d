"""Set, top-k, sampling and ordering operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from somaloom.functions.variants import gt_flags

# one million steps of the hash-sampling scale
SAMPLE_SCALE = 1 << 32


def drawn(key, seed: int):
    """A number below 2**32 drawn by the key and seed: the first half of a digest's hexadecimal digits, as any engine can compute it."""
    digest = F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def distinct_ids(df: DataFrame, *keys: str) -> DataFrame:
    return df.select(*keys).distinct()


def union_ids(*parts: DataFrame) -> DataFrame:
    """Set union of id tables with the same columns."""
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.distinct()


def intersect_ids(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.intersect(b.select(*a.columns))


def subtract_ids(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.distinct().join(b.select(*a.columns), a.columns, "left_anti")


def concat_rows(*parts: DataFrame) -> DataFrame:
    """Bag union (also used to gather same-header shards)."""
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def branch(df: DataFrame, **predicates: Column) -> dict[str, DataFrame]:
    """Disjoint streams: each row goes to the first predicate it meets, the rest to ``other``."""
    taken = F.lit(False)
    streams = {}
    for name, predicate in predicates.items():
        hit = F.coalesce(predicate, F.lit(False))
        streams[name] = df.filter(hit & ~taken)
        taken = taken | hit
    streams["other"] = df.filter(~taken)
    return streams


def group_to_list(df: DataFrame, key: str, value: str, out: str = "members") -> DataFrame:
    """Distinct members per group, sorted. Meant for members of bounded number (files or samples of a cohort)."""
    return df.groupBy(key).agg(F.sort_array(F.collect_set(value)).alias(out))


def alt_calls_only(
    df: DataFrame, gt: str = "gt", alt: str = "alt", distinct_on: Sequence[str] | None = None
) -> DataFrame:
    """Rows with an ALT allele in the genotype, without the ``NON_REF`` placeholder."""
    kept = df.filter(gt_flags(gt)["has_alt"] & ~F.col(alt).isin("NON_REF", "<NON_REF>"))
    return kept.dropDuplicates(list(distinct_on)) if distinct_on else kept


def natural_chromosome_key(chrom="chrom") -> list[Column]:
    """Sort key: numbered chromosomes by number, then the named ones (X, Y, M)."""
    bare = F.regexp_replace(chrom, "^chr", "")
    number = bare.try_cast("int")
    return [number.asc_nulls_last(), bare.asc()]


def order_natural(df: DataFrame, chrom: str = "chrom", pos: str = "pos") -> DataFrame:
    return df.orderBy(*natural_chromosome_key(chrom), F.col(pos))


def top_n(df: DataFrame, col: str, n: int, *ties: str) -> DataFrame:
    """The ``n`` rows with the largest ``col`` (a per-task top-n, then a merge of those)."""
    return df.orderBy(F.col(col).desc_nulls_last(), *ties).limit(n)


def order_by_total(df: DataFrame, key: str, value: str) -> DataFrame:
    """Keys with their total, largest first."""
    totals = df.groupBy(key).agg(F.sum(value).alias("total"))
    return totals.orderBy(F.desc("total"), key)


def head(df: DataFrame, n: int = 20) -> DataFrame:
    """First ``n`` rows of a report table."""
    return df.limit(n)


def cap_per_group(df: DataFrame, key: str, n: int, row_id: str, seed: int = 0, salts: int = 64) -> DataFrame:
    """A seeded random sample of at most ``n`` rows of every ``key``.

    The rows with the smallest hash are kept. A group of any size is first cut to
    ``n`` rows inside each of ``salts`` sub-groups, so no task sorts a whole group.
    """
    order = drawn(row_id, seed)
    salted = df.withColumn("_h", order).withColumn("_salt", F.pmod(F.xxhash64("_h", F.lit("salt")), F.lit(salts)))
    first = W.partitionBy(key, "_salt").orderBy("_h", row_id)
    second = W.partitionBy(key).orderBy("_h", row_id)
    return (
        salted.withColumn("_r", F.row_number().over(first)).filter(F.col("_r") <= n)
        .withColumn("_r", F.row_number().over(second)).filter(F.col("_r") <= n)
        .drop("_h", "_salt", "_r")
    )


def hash_sample(df: DataFrame, proportion, key: str, seed: int = 0) -> DataFrame:
    """Deterministic sample: rows sharing ``key`` (mates of a pair) stay or go together."""
    share = F.lit(float(proportion)) if isinstance(proportion, (int, float)) else proportion
    return df.filter((share >= 1) | (drawn(key, seed) < share * SAMPLE_SCALE))


def subsample_to_target(
    df: DataFrame, n: int, sample: str = "sample_id", key: str = "read_id", seed: int = 0
) -> tuple[DataFrame, DataFrame]:
    """Sample every library down to about ``n`` reads; libraries at or below ``n`` pass whole.

    Returns the kept reads and a table ``(sample, total_reads, final_reads, subsampled)``.
    The totals are one row per library and are joined back, never gathered.
    """
    totals = df.groupBy(sample).agg(F.count(F.lit(1)).alias("total_reads"))
    share = totals.withColumn("_p", F.least(F.lit(1.0), F.lit(float(n)) / F.col("total_reads")))
    kept = hash_sample(df.join(share, sample), F.col("_p"), key, seed).drop("_p", "total_reads")
    final = kept.groupBy(sample).agg(F.count(F.lit(1)).alias("final_reads"))
    counts = totals.join(final, sample, "left").select(
        sample, "total_reads", F.coalesce("final_reads", F.lit(0)).alias("final_reads"),
        (F.col("total_reads") > n).alias("subsampled"),
    )
    return kept, counts


def has_rows(df: DataFrame) -> bool:
    """Gate for an optional branch; a one-row action."""
    return not df.isEmpty()
