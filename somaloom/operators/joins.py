"""Keyed joins, id filters with provenance, and interval assignment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from somaloom.operators.pileup import complete_grid

AUTOSOMES = {"human": 22, "mouse": 19}


def join_on_sample(a: DataFrame, b: DataFrame, key: str = "sample_id") -> DataFrame:
    """Inner join of two per-sample tables."""
    return a.join(b, key)


def join_on_group(a: DataFrame, b: DataFrame, key: str = "group_id") -> DataFrame:
    """Many-to-many join of cohort members with cohort-level inputs."""
    return a.join(b, key)


def group_chromosomes(groups: DataFrame, species: str = "human", sex: str = "male", extra: Sequence[str] = ()) -> DataFrame:
    """One row per (group, chromosome) of the genome; Y only for a male donor. A literal list, unpacked in place."""
    names = [f"chr{i}" for i in range(1, AUTOSOMES[species] + 1)] + ["chrX"] + (["chrY"] if sex == "male" else [])
    return groups.withColumn("chrom", F.explode(F.array(*[F.lit(c) for c in (*names, *extra)])))


def keep_chosen(df: DataFrame, ids: DataFrame, key: str = "variant_id") -> DataFrame:
    return df.join(ids.select(key), key, "left_semi")


def drop_listed(df: DataFrame, ids: DataFrame, key: str = "variant_id") -> DataFrame:
    return df.join(ids.select(key), key, "left_anti")


def _flag(ids: DataFrame, name: str) -> DataFrame:
    return ids.select("variant_id", F.lit(True).alias(name)).distinct()


def bulk_filter(chosen: DataFrame, bulk: DataFrame, priority: DataFrame) -> DataFrame:
    """Provenance of the bulk filter: Fail when the bulk sample has the variant, Rescued when it is a priority one.

    An empty bulk table passes everything.
    """
    return (
        chosen.join(_flag(bulk, "_bulk"), "variant_id", "left").join(_flag(priority, "_prio"), "variant_id", "left")
        .withColumn("bulk_status", F.when(F.col("_bulk").isNull(), "Pass").when(F.col("_prio"), "Rescued").otherwise("Fail"))
        .drop("_bulk", "_prio")
    )


def rescue_union(results: DataFrame, stat_pass: DataFrame, priority: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Chosen ids (statistical passes and priority variants) and the results with Pass / Rescued / Fail."""
    chosen = stat_pass.select("variant_id").union(priority.select("variant_id")).distinct()
    tagged = (
        results.join(_flag(stat_pass, "_pass"), "variant_id", "left").join(_flag(priority, "_prio"), "variant_id", "left")
        .withColumn("statistical_status", F.when(F.col("_pass"), "Pass").when(F.col("_prio"), "Rescued").otherwise("Fail"))
        .drop("_pass", "_prio")
    )
    return chosen, tagged


def merge_mandatory(priority: DataFrame, mandatory: DataFrame) -> DataFrame:
    """Priority table plus the mandatory ids it lacks, marked ``MandatoryVariant``."""
    missing = mandatory.select("variant_id").filter("variant_id <> ''").distinct().join(
        priority.select("variant_id"), "variant_id", "left_anti")
    filler = {c: F.lit(".") for c in priority.columns if c not in ("variant_id", "verdict")}
    extra = missing.withColumns({**filler, "verdict": F.lit("MandatoryVariant")})
    return priority.unionByName(extra)


def metrics_with_cnv(metrics: DataFrame, cnv: DataFrame, key: str = "biosample", columns: Sequence[str] = ("skew_cnv",)) -> DataFrame:
    """Add copy-number metrics; a sample without them (or with an unreadable value) gets 999."""
    found = metrics.drop(*columns).join(cnv.select(key, *columns), key, "left")
    return found.withColumns({c: F.coalesce(F.col(c).try_cast("double"), F.lit(999.0)) for c in columns})


def annotate_priority(master: DataFrame, priority: DataFrame) -> DataFrame:
    """Priority columns on the master table, ``.`` where absent, and a Yes / No flag."""
    added = [c for c in priority.columns if c != "variant_id"]
    joined = master.join(priority.withColumn("_p", F.lit(True)), "variant_id", "left")
    return joined.withColumns({
        **{c: F.coalesce(F.col(c).cast("string"), F.lit(".")) for c in added},
        "priority_variant": F.when(F.col("_p"), "Yes").otherwise("No"),
    }).drop("_p")


def annotate_variants(calls: DataFrame, table: DataFrame, keys: Sequence[str] = ("chrom", "pos", "ref", "alt")) -> DataFrame:
    """Tag columns joined on the exact allele."""
    return calls.join(table, list(keys), "left")


def _enclosing(start: Column, end: Column, finest: int) -> Column:
    """Shift of the smallest bin of the tree that holds start and end: ``finest``, then three bits more a level."""
    apart = F.length(F.bin(start.bitwiseXOR(end)))
    return F.greatest(F.lit(finest), F.lit(finest) + 3 * F.ceil((apart - finest) / 3)).cast("int")


def assign_intervals(points: DataFrame, intervals: DataFrame, width: int = 1 << 14,
                     chrom: str = "chrom", pos: str = "pos", start: str = "start", end: str = "end") -> DataFrame:
    """Points inside closed intervals of any lengths.

    Bins are a fixed tree: the finest hold about ``width`` bases, each level above eight of them. An interval is cut where it
    crosses the coarsest bin edge inside it and each half filed in the smallest bin that holds it, so it is listed at most twice,
    however long. A point is looked up in its one bin of each level that any interval uses. Both meet in an equi join; halves
    are disjoint, so no pair is met twice.
    """
    finest = max(1, int(width).bit_length() - 1)
    s, e = F.col(start).cast("bigint"), F.col(end).cast("bigint")
    apart = F.length(F.bin(s.bitwiseXOR(e)))  # bits below the common prefix
    edge = F.call_function("shiftleft", F.call_function("shiftright", e, apart - 1), apart - 1)
    whole = (s == e) | (apart <= finest)
    halves = F.when(whole, F.array(F.struct(s.alias("a"), e.alias("b")))).otherwise(
        F.array(F.struct(s.alias("a"), (edge - 1).alias("b")), F.struct(edge.alias("a"), e.alias("b"))))
    listed = intervals.filter(s <= e).withColumn("_h", F.explode(halves)).withColumn("_shift", _enclosing(F.col("_h.a"), F.col("_h.b"), finest))
    listed = listed.withColumn("_b", F.call_function("shiftright", F.col("_h.a"), F.col("_shift")))
    used = F.coalesce(listed.agg(F.sort_array(F.collect_set("_shift"))).scalar(), F.array().cast("array<int>"))
    located = points.withColumn("_shift", F.explode(used)).withColumn("_b", F.call_function("shiftright", F.col(pos).cast("bigint"), F.col("_shift")))
    hit = (F.col(pos) >= F.col("_h.a")) & (F.col(pos) <= F.col("_h.b"))
    return located.join(listed, [chrom, "_shift", "_b"]).filter(hit).drop("_b", "_shift", "_h")


def check_aligned(nr: DataFrame, nv: DataFrame, keys: Sequence[str] = ("variant_id", "sample_id")) -> DataFrame:
    """Keys found in only one of two count tables, with the side they miss; empty when aligned."""
    keys = list(keys)
    a = nr.select(*keys).distinct().withColumn("_a", F.lit(1))
    b = nv.select(*keys).distinct().withColumn("_b", F.lit(1))
    lonely = a.join(b, keys, "full").filter("_a IS NULL OR _b IS NULL")
    return lonely.select(*keys, F.when(F.col("_a").isNull(), "nr").otherwise("nv").alias("missing_in"))


def align_methods(activity: DataFrame, methods: Sequence[str]) -> DataFrame:
    """Samples common to all methods x all signatures, one activity column per method, 0 filled."""
    rows = activity.filter(F.col("method").isin(*methods))
    common = rows.groupBy("sample_id").agg(F.count_distinct("method").alias("n")).filter(F.col("n") == len(methods))
    kept = rows.join(common.select("sample_id"), "sample_id", "left_semi")
    wide = kept.groupBy("sample_id", "signature").pivot("method", list(methods)).agg(F.sum("activity")).na.fill(0)
    return complete_grid(wide, rows, ["sample_id"], list(methods), sample="signature")


def usable_samples(cnv: DataFrame, metrics: DataFrame, metadata: DataFrame, key: str = "biosample") -> DataFrame:
    """Metadata of the samples present everywhere; a missing group becomes ``GROUP1``."""
    both = cnv.select(key).distinct().join(metrics.select(key).distinct(), key)
    grp = F.trim("grp")
    return metadata.join(both, key).withColumn("grp", F.when(grp.isNull() | grp.isin("", "NA"), "GROUP1").otherwise(grp))
