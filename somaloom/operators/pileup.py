"""Pileup operators: decoding, per-allele metrics, artifact filters and count tables.

Reads are one row per observed base. Every statistic that R takes over a list of
reads is a partial aggregate here, and position statistics come from a histogram
over read positions, whose size per allele is bounded by the read length; a site
with very many reads never gathers in one task.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from somaloom.functions import pileup_text

MAD_SCALE = 1.4826


@dataclass(frozen=True)
class ArtifactCutoffs:
    """Per-cell artifact thresholds (fixed default values)."""

    aln_score: float = 140
    prop_clipped: float = 0.4
    prop_under: float = 0.4
    prop_upper: float = 0.4
    sd_indiv: float = 12
    mad_indiv: float = 8
    sd_both: float = 25
    mad_both: float = 12
    sd_extreme: float = 25
    mad_extreme: float = 12


# ---- decoding -------------------------------------------------------------------------------------


def phred_decode(packed) -> Column:
    """Packed quality string to an array of ints (ASCII - 33)."""
    text = F.col(packed) if isinstance(packed, str) else packed
    return F.transform(F.filter(F.split(text, ""), lambda c: c != ""), lambda c: F.ascii(c) - 33)


def int_list(packed) -> Column:
    """Comma list to an array of ints; unreadable entries are NULL."""
    return F.transform(F.split(packed, ","), lambda c: c.try_cast("int"))


def explode_pileup(df: DataFrame, keys: Sequence[str] = ("sample_id", "chrom", "pos", "ref")) -> DataFrame:
    """Packed pileup rows (``read_bases, bq, mq, bp_start, aln_score, cigar``) to one row per read-base.

    Whole Arrow columns are decoded at once (:mod:`somaloom.functions.pileup_text`, which states the rules), in runs of
    about a megabyte of bases; no shuffle.
    """
    keys = list(keys)
    packed = ["read_bases", "bq", "mq", "bp_start", "aln_score", "cigar"]
    kinds = [*(df.schema[k] for k in keys), *T.StructType.fromDDL(
        "read_no int, allele string, strand string, mq int, bq int, bp_start int, aln_score int, cigar string, clipped boolean").fields]

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pileup_text.slices(batch, "read_bases"):
                yield pileup_text.decode(part, keys)

    shaped = df.select(*keys, *[F.col(c).cast("string").alias(c) for c in packed])
    return shaped.mapInArrow(decode, T.StructType(kinds))


def pileup_variant_id(chrom="chrom", pos="pos", ref="ref", allele="allele") -> Column:
    """VariantId of an observed allele (REF, substitution, ``+n`` insertion, ``-n`` deletion)."""
    a, r = F.col(allele), F.col(ref)
    changed = F.regexp_replace(a, "^[+-][0-9]+", "")
    before = F.when(a.startswith("-"), F.concat(r, changed)).otherwise(r)
    after = (
        F.when(a == "REF", r).when(a.startswith("+"), F.concat(r, changed))
        .when(a.startswith("-"), r).otherwise(a)
    )
    return F.concat_ws("_", chrom, F.col(pos).cast("string"), before, after)


def attach_cigar(pileup_reads: DataFrame, alignments: DataFrame) -> DataFrame:
    """Look up the CIGAR and alignment score of each observation by (qname, flag).

    A key listed twice keeps its smallest entry, so no observation is multiplied.
    """
    keys = ["qname", "flag"]
    found = [c for c in ("cigar", "aln_score") if c in alignments.columns]
    lookup = alignments.groupBy(*keys).agg(F.min(F.struct(*found)).alias("_a")).select(*keys, "_a.*")
    return pileup_reads.join(lookup, keys, "left")


# ---- per-allele metrics ---------------------------------------------------------------------------

LOCUS = ("sample_id", "chrom", "pos")
METRIC_KEYS = ("sample_id", "variant_id", "chrom", "pos", "ref", "alt")


def _medians(group: np.ndarray, value: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
    """Weighted median of each of ``n`` groups; NaN for an empty one."""
    order = np.lexsort((value, group))
    value, upto = value[order], np.cumsum(weight[order])
    size = np.bincount(group, weight, n).astype(np.int64)
    first = np.cumsum(size) - size
    out = np.full(n, np.nan)
    some = np.flatnonzero(size)
    low, high = (value[np.searchsorted(upto, (first + half)[some], "right")] for half in ((size - 1) // 2, size // 2))
    out[some] = np.where(low == high, low, low * 0.5 + high * 0.5)
    return out


def _middles(counts: pa.Array) -> pa.Array:
    """Median score, and median distance of the read positions of each strand from their median, of lists of counts."""
    n = len(counts)
    strand, x, score, c = (v.to_numpy(zero_copy_only=False) for v in counts.flatten().flatten())
    row = np.repeat(np.arange(n), np.diff(counts.offsets.to_numpy()))
    scored = ~np.isnan(score)
    out = {"score": _medians(row[scored], score[scored], c[scored], n)}
    for k, name in enumerate("fr"):
        at = (strand == k) & ~np.isnan(x)
        centre = _medians(row[at], x[at], c[at], n)
        out[name] = _medians(row[at], np.abs(x[at] - centre[row[at]]), c[at], n)
    return pa.StructArray.from_arrays([pa.array(v, pa.float64(), from_pandas=True) for v in out.values()], names=list(out))


def pileup_metrics(
    obs: DataFrame, mq: int = 30, bq: int = 30, bp: int = 15, read_length: int = 150,
    allele: str = "allele", variant_id: str = "allele_id", carry: Sequence[str] = (),
) -> DataFrame:
    """Counts and position statistics per (sample, allele), with position depths.

    Reads are counted once, by strand, quality, read position, score and clipping; everything follows from those counts. Dealt by
    locus, they serve the metrics and the position depths without another exchange; the counts of an allele are one list, of
    which the medians of many alleles are read at once. ``carry`` names columns that
    depend on the sample only (its cohort).
    """
    keys = [*carry, *METRIC_KEYS]
    hq = F.coalesce((F.col("mq") >= mq) & (F.col("bq") >= bq), F.lit(False))
    counts = obs.groupBy(
        *carry, "sample_id", F.col(variant_id).alias("variant_id"), "chrom", "pos", "ref", F.col(allele).alias("alt"),
        (F.col("strand") == "F").alias("fwd"), hq.alias("hq"), "bp_start", "aln_score", F.col("clipped").cast("double").alias("clipped"),
    ).agg(F.count(F.lit(1)).alias("c")).repartition(*carry, *LOCUS)
    x, c, fwd = F.col("bp_start"), F.col("c"), F.col("fwd")
    known = F.col("clipped").isNotNull()

    def side(strand):
        at = F.col("hq") & strand
        w = F.when(at, c)
        n, m = F.sum(w), F.sum(F.when(x.isNotNull(), w))
        s1, s2 = F.sum(w * x), F.sum(w * x * x)
        return {
            "under": F.sum(F.when(at, F.when(x < bp, c).otherwise(0))) / n,
            "upper": F.sum(F.when(at, F.when(x > read_length - bp, c).otherwise(0))) / n,
            "sd": F.when(m > 1, F.sqrt(F.try_divide((m * s2 - s1 * s1).cast("double"), (m * (m - 1)).cast("double")))),
        }

    sides = {"f": side(fwd), "r": side(~fwd)}
    total = lambda cond: F.coalesce(F.sum(F.when(cond, c)), F.lit(0))
    strand = F.when(F.col("hq"), F.when(fwd, 0).when(~fwd, 1))
    metrics = counts.groupBy(*keys).agg(
        total(fwd).alias("n_all_f"), total(~fwd).alias("n_all_r"),
        total(fwd & F.col("hq")).alias("n_hq_f"), total(~fwd & F.col("hq")).alias("n_hq_r"),
        (F.sum(F.col("clipped") * c) / F.sum(F.when(known, c))).alias("prop_clipped"),
        *[sides[strand][name].alias(f"{out}_{strand}") for name, out in (("under", "prop_under"), ("sd", "sd"), ("upper", "prop_upper")) for strand in ("f", "r")],
        F.collect_list(F.struct(strand.alias("strand"), x.cast("double").alias("x"), F.col("aln_score").cast("double").alias("score"), "c")).alias("_h"),
    )
    metrics = position_depth(metrics, carry).withColumn("_m", F.arrow_udf(_middles, "struct<score:double,f:double,r:double>")("_h"))
    metrics = metrics.withColumns({"median_as": F.col("_m.score"), "mad_f": F.col("_m.f") * MAD_SCALE, "mad_r": F.col("_m.r") * MAD_SCALE})
    named = [f"{name}_{strand}" for name in ("prop_under", "sd", "mad", "prop_upper") for strand in ("f", "r")]
    return metrics.select(*keys, "n_all_f", "n_all_r", "n_hq_f", "n_hq_r", "median_as", "prop_clipped", *named, "depth_all", "depth_hq")


def position_depth(metrics: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """All-read and HQ depth over every allele at the locus (rows are already one per allele)."""
    locus = W.partitionBy(*carry, *LOCUS)
    return metrics.withColumns({
        "depth_all": F.sum(F.col("n_all_f") + F.col("n_all_r")).over(locus),
        "depth_hq": F.sum(F.col("n_hq_f") + F.col("n_hq_r")).over(locus),
    })


# ---- artifact filters -----------------------------------------------------------------------------


def artifact_filters(
    metrics: DataFrame, cutoffs: ArtifactCutoffs = ArtifactCutoffs(),
    disable_qc: bool = False, disable_bppos: bool = False,
) -> DataFrame:
    """Add per-cell ``as_pass``, ``clip_pass`` and ``bppos_pass``. REF rows never pass."""
    k = cutoffs
    prop = lambda name: F.coalesce(F.col(name), F.lit(1.0))
    spread = lambda name: F.coalesce(F.col(name), F.lit(0.0))
    off_edges = lambda s: (prop(f"prop_under_{s}") < k.prop_under) & (prop(f"prop_upper_{s}") < k.prop_upper)
    wide = lambda s, sd, mad: (spread(f"sd_{s}") > sd) & (spread(f"mad_{s}") > mad)
    many_f, many_r = F.col("n_hq_f") > 1, F.col("n_hq_r") > 1
    single = lambda s: off_edges(s) | wide(s, k.sd_indiv, k.mad_indiv)
    both = lambda s, other: off_edges(s) & (wide(s, k.sd_both, k.mad_both) | wide(other, k.sd_extreme, k.mad_extreme))
    bppos = (
        F.when(many_f & many_r, both("f", "r") | both("r", "f"))
        .when(many_f, single("f")).when(many_r, single("r")).otherwise(False)
    )
    min_as, max_clip = (0, 2) if disable_qc else (k.aln_score, k.prop_clipped)
    if disable_qc or disable_bppos:
        bppos = F.lit(True)
    alt = F.col("alt") != "REF"
    return metrics.withColumns({
        "as_pass": alt & F.coalesce(F.col("median_as") >= min_as, F.lit(False)),
        "clip_pass": alt & F.coalesce(F.col("prop_clipped") < max_clip, F.lit(False)),
        "bppos_pass": alt & bppos,
    })


def variant_pass(filtered: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Add the variant-level ``variant_pass``: some cell (of the cohort) passes all three artifact filters."""
    all_three = F.col("as_pass") & F.col("clip_pass") & F.col("bppos_pass")
    verdict = filtered.groupBy(*carry, "variant_id").agg(F.bool_or(all_three).alias("variant_pass"))
    return filtered.join(verdict, [*carry, "variant_id"])


def pileup_status(filtered: DataFrame, chosen: DataFrame, priority: DataFrame | None = None) -> DataFrame:
    """The seven status columns of the pileup table, for rows with ``variant_pass``.

    ``chosen``: variants of the call files that are left; ``priority``: those kept although no cell passes. A chosen variant
    is in the count matrix when some cell passes all artifact filters, or when it is a priority variant with rows in the pileup.
    ``depth_filter`` and ``verdict`` tell whether it is; ``present_vcf_not_in_bam`` marks chosen variants left out of the matrix,
    ``present_bam_not_in_vcf`` passing variants that no call file holds.
    """
    ids = chosen.select("variant_id", F.lit(True).alias("_chosen")).distinct()
    rows = filtered.join(ids, "variant_id", "left").withColumn("_chosen", F.coalesce("_chosen", F.lit(False)))
    rescued = F.lit(False)
    if priority is not None:
        rows = rows.join(priority.select("variant_id", F.lit(True).alias("_priority")).distinct(), "variant_id", "left")
        rescued = F.coalesce(F.col("_priority"), F.lit(False)) & (F.col("alt") != "REF")
    kept = F.col("_chosen") & (F.col("variant_pass") | rescued)
    yes = lambda flag: F.when(flag, "Yes").otherwise("No")
    out = rows.withColumns({
        "as_filter": pass_fail("as_pass"), "propclipped_filter": pass_fail("clip_pass"), "bppos_filter": pass_fail("bppos_pass"),
        "depth_filter": pass_fail(kept), "present_vcf_not_in_bam": yes(F.col("_chosen") & ~kept),
        "present_bam_not_in_vcf": yes(F.col("variant_pass") & ~F.col("_chosen")), "verdict": pass_fail(kept)})
    return out.drop("_chosen", "_priority")


def pass_fail(flag) -> Column:
    """Boolean to the ``Pass`` / ``Fail`` spelling used in output tables."""
    return F.when(F.col(flag) if isinstance(flag, str) else flag, "Pass").otherwise("Fail")


def prefilter_aggregate(filtered: DataFrame) -> DataFrame:
    """One row per alternate variant: cells, means (4 digits), pass counts, verdict."""
    means = ("n_all_f", "n_all_r", "n_hq_f", "n_hq_r", "median_as", "prop_clipped", "prop_under_f", "prop_under_r",
             "prop_upper_f", "prop_upper_r", "sd_f", "sd_r", "mad_f", "mad_r", "depth_all", "depth_hq")
    return filtered.filter(F.col("alt") != "REF").groupBy("variant_id").agg(
        F.count(F.lit(1)).alias("n_cells"),
        *[F.min(c).alias(c) for c in ("chrom", "pos", "ref", "alt")],
        *[F.round(F.avg(c), 4).alias(f"mean_{c}") for c in means],
        *[F.count_if(F.col(c)).alias(f"n_{c}") for c in ("as_pass", "clip_pass", "bppos_pass")],
        F.when(F.bool_or("variant_pass"), "Pass").otherwise("Fail").alias("verdict"),
    )


# ---- count tables ---------------------------------------------------------------------------------


def sample_array(df: DataFrame, sample: str = "sample_id") -> Column:
    """All sample names as one array value (as many entries as the cohort has cells)."""
    return df.agg(F.sort_array(F.collect_set(sample))).scalar()


def complete_grid(
    present: DataFrame, samples: DataFrame, keys: Sequence[str], values: Sequence[str],
    fill=0, sample: str = "sample_id", carry: Sequence[str] = (),
) -> DataFrame:
    """Every (key, sample) pair; pairs absent from ``present`` get ``fill``.

    The values of a key are packed into one list of samples, the missing samples are added to it
    and the list is unpacked, so the dense table is written map-side, is never shuffled, and comes
    out partitioned by ``keys``; the work is in proportion to the samples. ``carry`` names columns
    that depend on the key only.
    """
    packed = present.groupBy(*keys).agg(
        *[F.min(c).alias(c) for c in carry],
        F.collect_list(F.struct(F.col(sample), *values)).alias("_cells"),
    ).withColumn("_all", sample_array(samples, sample))
    kind = packed.schema["_cells"].dataType.elementType
    bare = F.transform(
        F.array_except("_all", F.col("_cells").getField(sample)),
        lambda s: F.struct(s.alias(sample), *[F.lit(fill).cast(kind[v].dataType).alias(v) for v in values]),
    )
    grid = packed.withColumn("_cell", F.explode(F.concat("_cells", bare)))
    cell = lambda v: F.col("_cell").getField(v)
    return grid.select(*keys, *carry, cell(sample).alias(sample), *[F.coalesce(cell(v), F.lit(fill)).alias(v) for v in values])


def locus_depth(nv_ids: DataFrame, depth: DataFrame, nr: str = "nr") -> DataFrame:
    """Depth of each (variant, sample) looked up by locus; no coverage is 0."""
    found = nv_ids.join(depth.select("sample_id", "chrom", "pos", nr), ["sample_id", "chrom", "pos"], "left")
    return found.withColumn(nr, F.coalesce(nr, F.lit(0)))


def nv_nr_long(metrics: DataFrame, variants: DataFrame | None = None) -> DataFrame:
    """Long count table ``(variant_id, sample_id, chrom, pos, ref, alt, nv, nr)`` on the full grid.

    ``nv`` is the HQ support of the alternate allele, ``nr`` the HQ depth of its locus in
    that sample; 0 where there is none. ``variants`` (ids) restricts the alternates.

    Two maps over samples - support per variant, depth per locus - are joined on the
    locus, merged, and the grid is unpacked after the join.
    """
    alts = metrics.filter(F.col("alt") != "REF")
    if variants is not None:
        alts = alts.join(variants.select("variant_id"), "variant_id", "left_semi")
    support = alts.groupBy("variant_id", "chrom", "pos", "ref", "alt").agg(
        F.map_from_entries(F.collect_list(F.struct("sample_id", F.col("n_hq_f") + F.col("n_hq_r")))).alias("_nv")
    )
    depth = (
        metrics.groupBy("chrom", "pos", "sample_id").agg(F.max("depth_hq").alias("d"))
        .groupBy("chrom", "pos").agg(F.map_from_entries(F.collect_list(F.struct("sample_id", "d"))).alias("_nr"))
    )
    both = F.map_zip_with("_nv", "_nr", lambda s, nv, nr: F.struct(F.coalesce(nv, F.lit(0)).alias("nv"), F.coalesce(nr, F.lit(0)).alias("nr")))
    joined = support.join(depth, ["chrom", "pos"]).withColumn("_both", both).withColumn("_all", sample_array(metrics))
    kind = joined.schema["_both"].dataType.valueType
    none = F.struct(*[F.lit(0).cast(kind[v].dataType).alias(v) for v in ("nv", "nr")])
    bare = F.transform(F.array_except("_all", F.map_keys("_both")), lambda s: F.struct(s.alias("key"), none.alias("value")))
    grid = joined.withColumn("_cell", F.explode(F.concat(F.map_entries("_both"), bare)))
    return grid.select(
        "variant_id", F.col("_cell.key").alias("sample_id"), "chrom", "pos", "ref", "alt",
        F.col("_cell.value.nv").alias("nv"), F.col("_cell.value.nr").alias("nr"),
    )


def allele_counts(obs: DataFrame, mq: int = 30, bq: int = 30, variant_id: str = "variant_id") -> DataFrame:
    """HQ support and depth when every observation names its candidate variant (``is_alt`` tells the allele).

    The short way to the count table when position statistics are not needed.
    """
    hq = (F.col("mq") >= mq) & (F.col("bq") >= bq)
    return obs.groupBy(F.col(variant_id).alias("variant_id"), "chrom", "pos", "ref", "alt", "sample_id").agg(
        F.count_if(hq & F.col("is_alt")).alias("nv"), F.count_if(hq).alias("nr")
    )


def focal_pileup(filtered: DataFrame, focal: DataFrame) -> DataFrame:
    """Pileup rows re-keyed to the focal variants at their locus, one per (sample, variant).

    An exact ALT row wins. Otherwise a REF row (the sample's own, or one made from
    another allele's row with zero support) stands for the variant.
    """
    ids = focal.select(F.col("variant_id").alias("focal_id"), "chrom", "pos")
    at_locus = filtered.join(ids, ["chrom", "pos"])
    exact = F.col("variant_id") == F.col("focal_id")
    is_ref = F.col("alt") == "REF"
    support = ("n_all_f", "n_all_r", "n_hq_f", "n_hq_r")
    borrowed = ~exact & ~is_ref
    rest = [c for c in filtered.columns if c not in ("sample_id", "variant_id")]
    shaped = at_locus.select(
        "sample_id", F.col("focal_id").alias("variant_id"),
        F.when(exact, 0).when(is_ref, 1).otherwise(2).alias("_rank"), F.col("variant_id").alias("_source"),
        *[
            (F.when(borrowed, 0).otherwise(F.col(c)).alias(c) if c in support
             else F.when(borrowed, "REF").otherwise(F.col(c)).alias(c) if c == "alt" else F.col(c))
            for c in rest
        ],
    )
    best = shaped.groupBy("sample_id", "variant_id").agg(
        F.min_by(F.struct(*rest), F.struct("_rank", "_source")).alias("_b")
    )
    return best.select("sample_id", "variant_id", *[F.col(f"_b.{c}").alias(c) for c in rest])


def one_row_per_allele(rows: DataFrame, keys: Sequence[str] = ("sample_id", "variant_id")) -> DataFrame:
    """Of several rows of a (sample, variant) keep one; an ALT row beats a REF row."""
    keys = list(keys)
    rest = [c for c in rows.columns if c not in keys]
    best = rows.groupBy(*keys).agg(
        F.min_by(F.struct(*rest), F.struct((F.col("alt") == "REF").alias("r"), F.col("alt").alias("a"))).alias("_b")
    )
    return best.select(*keys, *[F.col(f"_b.{c}").alias(c) for c in rest])


def sample_annotation(focal: DataFrame, table: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """Per-sample metric columns of every variant of ``table``.

    The ALT row of the sample if it has one, else its REF row with zero support, else NULL.
    """
    support = {"n_all_f", "n_all_r", "n_hq_f", "n_hq_r"}
    single = one_row_per_allele(focal.select("sample_id", "variant_id", "alt", *metrics))
    shaped = single.select(
        "sample_id", "variant_id",
        *[
            (F.when(F.col("alt") == "REF", 0).otherwise(F.col(m)) if m in support else F.col(m)).alias(f"sample_{m}")
            for m in metrics
        ],
    )
    grid = table.withColumn("sample_id", F.explode(sample_array(focal)))
    return grid.join(shaped, ["sample_id", "variant_id"], "left")


def locus_max_depth(annotated: DataFrame, depth: str = "depth_hq") -> DataFrame:
    """Co-located variants of a sample share the largest depth seen at the locus."""
    locus = W.partitionBy("sample_id", "chrom", "pos")
    return annotated.withColumn("nr", F.coalesce(F.max(depth).over(locus), F.lit(0)))
