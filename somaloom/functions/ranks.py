"""Exact ranks, quantiles and Benjamini-Hochberg without a single-task sort.

``rank() over (order by x)`` without a partition sends the whole table to one
task. Here equal values are first counted (a partial aggregate, so ties however
many cost one row). The distinct values are then cut into ranges of about equal numbers of rows:
Spark samples them, chooses splitters and cuts again where a range came out heavy. The ranges do not
depend on how values are spread - a million values within one per cent are cut as finely as any. They
are written once, with their number, in ``spark.checkpoint.dir``, so that every later step, and a task
repeated after a loss, sees the same ranges. Only range totals, as many as ranges and groups, are scanned in order.

Results go back to the rows by value. A value that more than one row in ``HOT`` has is one of fewer than ``HOT``: the list of those
is broadcast, their rows are dealt over ``SALTS`` keys and their results are copied to each, so that no value is a task of its own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from somaloom.session import cut_lineage

RANGES_PER_PARTITION = 1
HOT = 1000
SALTS = 64


def _known(value: str, by: Sequence[str]):
    known = F.col(value).isNotNull()
    for c in by:
        known = known & F.col(c).isNotNull()
    return known


def value_ranges(df: DataFrame, value: str, by: Sequence[str] = (), n_ranges: int | None = None) -> DataFrame:
    """Distinct (``by``, ``value``) with their ties and the number of their range; ranges ascend and hold about equal numbers of rows."""
    by = list(by)
    if n_ranges is None:
        n_ranges = RANGES_PER_PARTITION * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = df.filter(_known(value, by)).groupBy(*by, value).agg(F.count(F.lit(1)).alias("ties"))
    return cut_lineage(counts.repartitionByRange(n_ranges, *by, value).withColumn("_range", F.spark_partition_id()))


def distinct_ranks(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Distinct values with tie count and ranks.

    Columns: ``by``, ``value``, ``ties``, ``rank_max`` (number of values <= it), ``n_total`` and the
    internal ``_range``. NULL values have no rank.
    """
    return ranks_of(value_ranges(df, value, by), value, by)


def ranks_of(ranges: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """:func:`distinct_ranks` of ranges already written."""
    by = list(by)
    ordered = W.partitionBy(*by).orderBy("_range") if by else W.orderBy("_range")  # a row a range and group
    sizes = ranges.groupBy(*by, "_range").agg(F.sum("ties").alias("_size"))
    totals = sizes.select(
        *by, "_range",
        F.coalesce(F.sum("_size").over(ordered.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
        F.sum("_size").over(ordered.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)).alias("n_total"))
    inside = W.partitionBy("_range", *by).orderBy(value).rowsBetween(W.unboundedPreceding, W.currentRow)
    ranked = dealt(ranges).withColumn("_inside", F.sum("ties").over(inside)).join(totals, [*by, "_range"])
    return ranked.select(*by, value, "ties", (F.col("_before") + F.col("_inside")).alias("rank_max"), "n_total", "_range")


def dealt(ranges: DataFrame) -> DataFrame:
    """Written ranges, each whole in one task; windows over a range need no other exchange."""
    n = RANGES_PER_PARTITION * int(ranges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return ranges.repartitionByRange(n, "_range")


def to_rows(df: DataFrame, ranges: DataFrame, results: DataFrame, keys: Sequence[str], out: str) -> DataFrame:
    """Give each row of ``df`` the result (``keys``, ``ties``, ``out``) of its keys; rows without one get NULL."""
    keys = list(keys)
    hot = F.col("ties") * HOT > F.coalesce(ranges.agg(F.sum("ties")).scalar(), F.lit(0))
    known = F.broadcast(ranges.filter(hot).select(*keys, F.lit(True).alias("_is_hot")))  # fewer than HOT rows
    own = [c for c in df.columns if c not in (out, "_is_hot", "_salt")]
    spread = [c for c in own if not isinstance(df.schema[c].dataType, (T.MapType, T.VariantType))]
    salted = df.select(*own).join(known, keys, "left").withColumn(
        "_salt", F.when(F.col("_is_hot"), F.pmod(F.xxhash64(*spread), F.lit(SALTS)).cast("int")).otherwise(0))
    salts = F.when(hot, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    found = results.select(*keys, F.col(out), F.explode(salts).alias("_salt"))
    return salted.join(found, [*keys, "_salt"], "left").select(*own, out)


def bh_adjust(df: DataFrame, p: str, by: Sequence[str] = (), out: str = "q") -> DataFrame:
    """Add Benjamini-Hochberg q-values of column ``p``, adjusted within ``by``."""
    by = list(by)
    ranges = value_ranges(df, p, by)
    ranked = ranks_of(ranges, p, by).withColumn("_raw", F.col(p) * F.col("n_total") / F.col("rank_max"))
    later = (W.partitionBy(*by) if by else W).orderBy(F.desc("_range")).rowsBetween(W.unboundedPreceding, -1)
    minima = ranked.groupBy(*by, "_range").agg(F.min("_raw").alias("_low")).select(*by, "_range", F.min("_low").over(later).alias("_after"))
    inside = W.partitionBy("_range", *by).orderBy(F.desc(p)).rowsBetween(W.unboundedPreceding, W.currentRow)
    adjusted = ranked.withColumn("_within", F.min("_raw").over(inside)).join(minima, [*by, "_range"]).select(
        *by, p, "ties", F.least(F.lit(1.0), "_within", F.coalesce("_after", F.lit(1.0))).alias(out))
    return to_rows(df, ranges, adjusted, [*by, p], out)


def average_rank(df: DataFrame, value: str, by: Sequence[str] = (), out: str = "avg_rank") -> DataFrame:
    """Add the average rank of ``value`` within ``by`` (ties share the mean rank)."""
    by = list(by)
    ranges = value_ranges(df, value, by)
    ranks = ranks_of(ranges, value, by).select(*by, value, "ties", (F.col("rank_max") - (F.col("ties") - 1) / 2.0).alias(out))
    return to_rows(df, ranges, ranks, [*by, value], out)


def exact_quantiles(df: DataFrame, value: str, probs: dict[str, float], by: Sequence[str] = ()) -> DataFrame:
    """Exact linear-interpolated quantiles per ``by`` group, one column per entry of ``probs``.

    Unlike ``percentile``, no task holds the distinct values of a whole group.
    """
    by = list(by)
    ranked = distinct_ranks(df, value, by).withColumn("_first", F.col("rank_max") - F.col("ties"))
    aggs = []
    for name, prob in probs.items():
        spot = (F.col("n_total") - 1) * F.lit(float(prob))
        for side, rank in (("lo", F.floor(spot) + 1), ("hi", F.ceil(spot) + 1)):
            hit = (F.col("_first") < rank) & (rank <= F.col("rank_max"))
            aggs.append(F.max(F.when(hit, F.col(value).cast("double"))).alias(f"{name}_{side}"))
    aggs.append(F.max("n_total").alias("_n"))
    out = ranked.groupBy(*by).agg(*aggs)
    cols = []
    for name, prob in probs.items():
        spot = (F.col("_n") - 1) * F.lit(float(prob))
        part = spot - F.floor(spot)
        lo, hi = F.col(f"{name}_lo"), F.col(f"{name}_hi")
        cols.append((lo + part * (hi - lo)).alias(name))
    return out.select(*by, *cols)
