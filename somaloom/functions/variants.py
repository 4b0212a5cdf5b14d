"""Column functions over variant keys, genotypes and allele depths.

Everything here is a plain Catalyst expression, so a caller's filter or
projection stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEX_CHROMOSOMES = ("X", "Y", "chrX", "chrY")


def make_variant_id(chrom="chrom", pos="pos", ref="ref", alt="alt") -> Column:
    """``CHROM_POS_REF_ALT``."""
    return F.concat_ws("_", chrom, F.col(pos).cast("string") if isinstance(pos, str) else pos, ref, alt)


def parse_variant_id(variant_id="variant_id") -> dict[str, Column]:
    """Split an id from the right, so contig names may themselves contain ``_``."""
    parts = F.split(variant_id, "_")
    n = F.size(parts)
    return {
        "chrom": F.array_join(F.slice(parts, F.lit(1), F.greatest(n - 3, F.lit(0))), "_"),
        "pos": F.get(parts, n - 3).try_cast("bigint"),
        "ref": F.get(parts, n - 2),
        "alt": F.get(parts, n - 1),
    }


def with_variant_parts(df: DataFrame, variant_id: str = "variant_id") -> DataFrame:
    return df.withColumns(parse_variant_id(variant_id))


def split_multiallelic(df: DataFrame, alt: str = "alt") -> DataFrame:
    """One row per ALT allele of a comma list."""
    return df.withColumn(alt, F.explode(F.split(alt, ",")))


def is_snv_strict(ref="ref", alt="alt") -> Column:
    """SNV when both alleles are one base (matrix and per-cell counts)."""
    return (F.length(ref) == 1) & (F.length(alt) == 1)


def is_snv_equal_length(ref="ref", alt="alt") -> Column:
    """SNV when both alleles have the same length (upstream and cohort counts)."""
    return F.length(ref) == F.length(alt)


def mutation_type(ref="ref", alt="alt") -> Column:
    """SNP / DBS / INDEL classes of the signature input."""
    r, a = F.length(ref), F.length(alt)
    return F.when((r == 1) & (a == 1), "SNP").when((r == 2) & (a == 2), "DBS").otherwise("INDEL")


def mutation_end(pos="pos", ref="ref", alt="alt") -> Column:
    """End column of the signature input: ``pos`` for SNP and DBS, last REF base for INDEL."""
    p = F.col(pos) if isinstance(pos, str) else pos
    return F.when(mutation_type(ref, alt) == "INDEL", p + F.length(ref) - 1).otherwise(p)


def alt_depth(ad="ad") -> Column:
    """Alternate depth from an ``AD`` list: the number after the last comma; missing is 0."""
    return F.coalesce(F.substring_index(F.col(ad) if isinstance(ad, str) else ad, ",", -1).try_cast("bigint"), F.lit(0))


def _alleles(gt) -> Column:
    return F.split(F.translate(gt, "|", "/"), "/")


def gt_flags(gt="gt") -> dict[str, Column]:
    """Phase- and ploidy-agnostic genotype flags."""
    alleles = _alleles(gt)
    has_ref = F.exists(alleles, lambda a: a == "0")
    has_alt = F.exists(alleles, lambda a: (a != "0") & (a != "."))
    return {
        "has_ref": has_ref,
        "has_alt": has_alt,
        "het": has_ref & has_alt,
        "non_ref": ~F.translate(gt, "|", "/").isin("0/0", "./.", "."),
    }


def fill_missing_gt(gt="gt") -> Column:
    """``./.`` becomes a reference call."""
    return F.when(F.translate(gt, "|", "/").isin("./.", "."), F.lit("0/0")).otherwise(F.col(gt))


def caller_verdict(flt="filter") -> Column:
    """0 when the caller accepted the record (``PASS`` or ``.``), else 1."""
    return F.when(F.col(flt).isin("PASS", "."), 0).otherwise(1)


def on_sex_chromosome(chrom="chrom") -> Column:
    return F.col(chrom).isin(*SEX_CHROMOSOMES) if isinstance(chrom, str) else chrom.isin(*SEX_CHROMOSOMES)


def vaf(nv="nv", nr="nr", digits: int | None = 6, empty=0.0) -> Column:
    """NV/NR capped at 1. ``empty`` is the value at zero depth (0.0, or None for NULL)."""
    nv, nr = (F.col(c) if isinstance(c, str) else c for c in (nv, nr))
    ratio = F.least(F.try_divide(nv.cast("double"), nr.cast("double")), F.lit(1.0))
    value = F.when(nr > 0, ratio).otherwise(F.lit(empty).cast("double"))
    return value if digits is None else F.round(value, digits)


def bin_label(x, breaks: list[float], labels: list[str]) -> Column:
    """Half-open bins ``[b0,b1) [b1,b2) …`` with the last one closed; outside is NULL."""
    x = F.col(x) if isinstance(x, str) else x
    if len(labels) != len(breaks) - 1:
        raise ValueError("one label per bin expected")
    out = F.lit(None).cast("string")
    last = len(labels) - 1
    for i in range(last, -1, -1):
        upper = (x <= breaks[i + 1]) if i == last else (x < breaks[i + 1])
        out = F.when((x >= breaks[i]) & upper, F.lit(labels[i])).otherwise(out)
    return out


def vaf_decile(x) -> Column:
    """Index 0…9 of the allele-frequency decile, 1.0 in the last one; outside [0, 1] is NULL."""
    x = F.col(x) if isinstance(x, str) else x
    index = F.lit(0)
    for edge in (0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9):
        index = index + (x >= edge).cast("int")
    return F.when((x >= 0) & (x <= 1), index)


def nr_bin(nr="nr") -> Column:
    """Depth classes 1-4, 5-9, 10-19, >=20; zero depth has none."""
    n = F.col(nr) if isinstance(nr, str) else nr
    return F.when(n >= 20, ">=20").when(n >= 10, "10-19").when(n >= 5, "5-9").when(n >= 1, "1-4")


def support_bin(pct) -> Column:
    """Branch-support classes in percent."""
    p = F.col(pct) if isinstance(pct, str) else pct
    return F.when(p >= 90, ">=90").when(p >= 70, "70-90").when(p >= 50, "50-70").when(p >= 0, "<50")


def digital_genotype(call="call", vaf_col="vaf", nr="nr") -> Column:
    """Genotype text of one cell: no depth, no call, het, or hom from VAF 0.8 on."""
    return (
        F.when(F.col(nr) <= 0, "No depth")
        .when(F.col(call) == 0, "0/0")
        .when(F.col(vaf_col) >= 0.8, "1/1")
        .otherwise("0/1")
    )
