"""Gene-count operators: matrix, housekeeping variation, normalisation, dispersed genes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# fixed values: housekeeping gene symbols
HOUSEKEEPING = ("GAPDH", "ACTB", "RPL36", "HINT1", "TBP", "PPIA", "B2M", "HPRT1", "UBC", "RPL13A", "PGK1", "EIF3K", "RPLP0", "GUSB", "CLTC", "HMBS")


def gene_matrix(counts: DataFrame, samples: Sequence[str], keys: Sequence[str] = ("gene",)) -> DataFrame:
    """Genes x samples with 0 fill. ``keys`` name a gene; with an id among them, ids that share a symbol stay apart."""
    return counts.groupBy(*keys).pivot("sample_id", list(samples)).agg(F.sum("n")).na.fill(0)


def housekeeping_cv(counts: DataFrame, genes: Sequence[str] = HOUSEKEEPING, keys: Sequence[str] = ("gene",)) -> DataFrame:
    """sd / mean over all samples (absent counts are 0) of the housekeeping genes, picked by symbol (``gene``)."""
    n = counts.agg(F.count_distinct("sample_id")).scalar()
    sums = counts.filter(F.col("gene").isin(*genes)).groupBy(*keys).agg(
        F.sum("n").cast("double").alias("s1"), F.sum(F.col("n") * F.col("n")).cast("double").alias("s2")).withColumn("k", n)
    mean = F.col("s1") / F.col("k")
    sd = F.sqrt(F.try_divide(F.col("s2") - F.col("s1") * mean, F.col("k") - 1))
    return sums.select(*keys, F.try_divide(sd, mean).alias("cv"))


def log_normalize(counts: DataFrame, min_genes: int = 1000, min_cells: int = 1, scale: float = 10000) -> DataFrame:
    """ln(x / total * scale + 1) in cells with more than ``min_genes`` genes, for genes seen in ``min_cells`` of them."""
    seen = counts.filter("n > 0")
    cells = seen.groupBy("sample_id").agg(F.count(F.lit(1)).alias("g")).filter(F.col("g") > min_genes).select("sample_id")
    kept = seen.join(cells, "sample_id", "left_semi")
    genes = kept.groupBy("gene").agg(F.count(F.lit(1)).alias("c")).filter(F.col("c") >= min_cells).select("gene")
    kept = kept.join(genes, "gene", "left_semi")
    totals = kept.groupBy("sample_id").agg(F.sum("n").alias("_t"))
    return kept.join(totals, "sample_id").withColumn("value", F.log1p(F.col("n") / F.col("_t") * scale)).drop("_t")


def gene_dispersion(normed: DataFrame, bins: int = 20) -> DataFrame:
    """Variance / mean per gene over all cells and its distance from genes of similar mean.

    Genes are cut into ``bins`` equal-width classes of the mean, closed on the right.
    """
    k = normed.agg(F.count_distinct("sample_id")).scalar()
    sums = normed.groupBy("gene").agg(F.sum("value").alias("s1"), F.sum(F.col("value") * F.col("value")).alias("s2")).withColumn("k", k)
    mean = F.col("s1") / F.col("k")
    genes = sums.select("gene", mean.alias("mean"), F.try_divide((F.col("s2") - F.col("s1") * mean) / (F.col("k") - 1), mean).alias("dispersion"))
    ends = genes.agg(F.struct(F.min("mean").alias("lo"), F.max("mean").alias("hi"))).scalar()
    cut = genes.withColumn("_e", ends)
    index = sum(((F.col("mean") > F.col("_e.lo") + (F.col("_e.hi") - F.col("_e.lo")) * i / bins).cast("int") for i in range(1, bins)), F.lit(0))
    cut = cut.withColumn("bin", index).drop("_e")
    # one row per gene: a class holds at most the genes of the genome
    peers = W.partitionBy("bin")
    z = F.abs(F.try_divide(F.col("dispersion") - F.avg("dispersion").over(peers), F.stddev("dispersion").over(peers)))
    return cut.select("gene", "mean", "dispersion", "bin", z.alias("z"))


def dispersion_topn(normed: DataFrame, n: int = 500, bins: int = 20) -> DataFrame:
    """The ``n`` genes furthest from the dispersion of their class."""
    return gene_dispersion(normed, bins).orderBy(F.col("z").desc_nulls_last(), "gene").limit(n)
