"""Transcript-annotation operators: expansion, population filter, verdicts, best record."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: impact classes by weight
IMPACT_WEIGHTS = {"HIGH": 4, "MODERATE": 3, "LOW": 2, "MODIFIER": 1}
# fixed values: consequence patterns
TRUNCATING = "frameshift|stop_gained|stop_lost|start_lost|splice_donor|splice_acceptor|nonsense"
CODING = ("missense|frameshift|stop_gained|splice|intron|synonymous|utr|upstream|downstream|"
          "intergenic|non_coding|inframe")
DISTAL = "downstream|upstream|utr|intron|intergenic|non_coding"
DISTAL_BUT_SEVERE = "splice_donor|splice_acceptor|frameshift|stop_gained"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _missing_to_null(c) -> Column:
    c = _col(c)
    return F.when(c.isin("", ".", "NA"), F.lit(None)).otherwise(c)


def expand_csq(df: DataFrame, fields: Sequence[str], csq: str = "csq") -> DataFrame:
    """One row per annotation record; short records are padded with NULL, long ones cut.

    A NULL or empty string still gives one row with all fields NULL.
    """
    records = F.explode_outer(F.when(F.col(csq) != "", F.split(csq, ",")))
    parts = df.withColumn("csq_raw", records).withColumn("_parts", F.split("csq_raw", "\\|"))
    out = parts.withColumns(
        {name: F.nullif(F.get("_parts", F.lit(i)), F.lit("")) for i, name in enumerate(fields)}
    )
    return out.drop("_parts", csq)


def gene_tokens(symbol="symbol", gene="gene", consequence="consequence") -> dict[str, Column]:
    """Distinct genes hit, their count, and a printable list (``NoGene`` when none)."""
    sym, gen = F.trim(_missing_to_null(symbol)), F.trim(_missing_to_null(gene))
    between_genes = (
        F.lower(_col(consequence)).contains("intergenic") & sym.contains("-") & ~sym.contains(",")
    )
    pair = F.when(F.coalesce(between_genes, F.lit(False)), F.split(sym, "-")).otherwise(F.split(sym, "[,;&|]"))
    tokens = F.concat(
        F.coalesce(pair, F.array().cast("array<string>")),
        F.coalesce(F.split(gen, "[,;&]"), F.array().cast("array<string>")),
    )
    tokens = F.array_distinct(
        F.filter(F.transform(tokens, lambda t: F.trim(t)), lambda t: ~t.isin("", "-", "."))
    )
    return {
        "genes": tokens,
        "genes_affected": F.when(F.size(tokens) == 0, "NoGene").otherwise(F.array_join(tokens, ",")),
        "n_genes": F.size(tokens),
    }


def population_filter(
    df: DataFrame,
    max_af: float = 0.01,
    use_existing: bool = False,
    af: str | None = "af",
    top_af: str = "max_af",
    existing: str = "existing",
) -> DataFrame:
    """Add ``filter_status`` (PASS / REMOVED) and ``filter_reason``.

    A frequency passes when missing or at most ``max_af``; of several (``0.5&0.01``) the largest
    counts. With ``use_existing`` a
    record known only under ``rs`` numbers is removed too.
    """
    largest = lambda c: F.array_max(F.transform(F.split(F.col(c).cast("string"), "[&,]"), lambda v: v.try_cast("double")))
    below = lambda c: F.coalesce(largest(c) <= max_af, F.lit(True))
    keep_af = below(top_af) if af is None else below(af) & below(top_af)
    ids = F.split(F.translate(_missing_to_null(existing), "&", ","), ",")
    keep_ev = F.lit(True)
    if use_existing:
        novel = F.exists(ids, lambda x: (x != "") & ~x.rlike("^rs[0-9]+$"))
        keep_ev = F.coalesce(novel, F.lit(True))
    reason = F.concat_ws(
        ";", F.when(~keep_ev, "existing_variation_filter"), F.when(~keep_af, "AF_filter")
    )
    return df.withColumns({
        "filter_status": F.when(keep_ev & keep_af, "PASS").otherwise("REMOVED"),
        "filter_reason": F.when(reason == "", ".").otherwise(reason),
    })


def clin_verdict(clin_sig="clin_sig", impact="impact") -> Column:
    """Verdict from clinical significance (whole terms), else from the impact class."""
    terms = F.split(F.lower(_missing_to_null(clin_sig)), "[,/&]")
    has = lambda *names: F.exists(terms, lambda t: F.trim(t).isin(*names))
    known = _missing_to_null(clin_sig).isNotNull()
    return (
        F.when(known & has("pathogenic"), "Pathogenic")
        .when(known & has("likely_pathogenic"), "Likely_Pathogenic")
        .when(known & F.exists(terms, lambda t: t.contains("uncertain")), "VUS")
        .when(known & has("benign", "likely_benign"), "Benign")
        .when(known, "Unknown")
        .when(_col(impact) == "HIGH", "Deleterious")
        .when(_col(impact) == "MODERATE", "Possibly_Deleterious")
        .when(_col(impact) == "LOW", "Benign")
        .otherwise("Unknown")
    )


def existing_variation_combined(own="existing", found="vep_existing") -> Column:
    """Known ids of both annotations joined by ``|``; ``NoRecord`` without any."""
    given = lambda c: F.when(F.trim(_col(c)) != "", F.trim(_col(c)))
    return F.when(given(own).isNull() & given(found).isNull(), "NoRecord").otherwise(F.concat_ws("|", given(own), given(found)))


def relevance_verdict(
    df: DataFrame, impact="impact", consequence="consequence", clin_sig="clin_sig", max_af="max_af"
) -> DataFrame:
    """Consequence class, clinical summary, evidence and a five-tier relevance verdict."""
    text = lambda c: F.coalesce(F.lower(_col(c).cast("string")), F.lit(""))
    imp, cons, clin = text(impact), text(consequence), text(clin_sig)
    af = _col(max_af).try_cast("double")
    rare = lambda limit: af.isNull() | (af <= limit)

    likely_path = clin.contains("likely_pathogenic")
    path = clin.contains("pathogenic") & ~likely_path & ~clin.contains("benign")
    benign = clin.rlike("(^|,)\\s*benign|likely_benign")
    conflict = clin.rlike("conflicting|uncertain|vus")
    truncating = (imp == "high") & cons.rlike(TRUNCATING)
    missense = cons.rlike("missense|inframe")
    synonymous = cons.contains("synonymous_variant") & ~cons.rlike("missense|frameshift")
    intergenic = cons.contains("intergenic_variant") & ~cons.rlike("missense|frameshift|splice")
    distal = cons.rlike(DISTAL) & ~cons.rlike(DISTAL_BUT_SEVERE) & ~path & ~likely_path
    unknown = _col(impact).isNull() & _col(consequence).isNull() & _col(clin_sig).isNull()
    deleterious = ~benign & (
        likely_path | truncating
        | ((imp == "high") & (missense | cons.contains("splice")))
        | ((imp == "moderate") & missense & rare(0.001))
    )
    return df.withColumns({
        "consequence_class": F.when(truncating, "truncating_splice").when(missense, "missense_inframe")
        .when(synonymous, "synonymous").when(intergenic, "intergenic_distal").otherwise("other"),
        "clin_summary": F.when(likely_path, "likely_pathogenic").when(path, "pathogenic")
        .when(benign, "benign_family").when(conflict, "conflicting_or_vus").otherwise("unreported_or_other"),
        "coding_region": F.when(cons.rlike(CODING), "coding_or_near_gene").otherwise("other"),
        "evidence": F.when(path | likely_path, "clinical_pathogenic").when(truncating, "high_impact_truncating")
        .when(imp.isin("high", "moderate") & missense & ~benign, "damaging_coding")
        .when(conflict, "conflicting_classification").when(synonymous & rare(0.001), "synonymous_rare")
        .when(intergenic, "non_coding_intergenic").otherwise("see_consequence"),
        "relevance": F.when(path | (likely_path & (truncating | (imp == "high"))), "Pathogenic")
        .when(deleterious, "Deleterious")
        .when(conflict & ~path & ~likely_path, "Uncertain")
        .when(benign | (synonymous & rare(0.05)), "Benign")
        .when(distal, "Other").when(unknown, "Uncertain").otherwise("Other"),
    })


def priority_variants(annotated: DataFrame, passing: DataFrame, key: str = "variant_id") -> DataFrame:
    """Annotated variants that pass the filters and are clinically or functionally notable."""
    severe = F.col("impact").isin("HIGH", "MODERATE")
    notable = ((F.col("impact") == "HIGH") & (F.col("verdict") != "Benign")) | (
        F.col("verdict").isin("Pathogenic", "Likely_Pathogenic") & severe
    )
    return annotated.filter(notable).join(passing.select(key), key, "left_semi")


def impact_verdict_table(
    annotated: DataFrame, verdicts: Sequence[str] | None = None, impact="impact", verdict="verdict"
) -> DataFrame:
    """Impact x verdict contingency table with 0 for absent pairs."""
    grouped = annotated.groupBy(F.col(impact).alias("impact"))
    table = grouped.pivot(verdict, list(verdicts) if verdicts else None).count()
    return table.na.fill(0)


def clinical_rank(clin_sig="clin_sig") -> Column:
    """Signed clinical weight added to the impact weight when records are ranked."""
    s = F.coalesce(F.lower(_col(clin_sig)), F.lit(""))
    has = s.contains
    add = lambda cond, n: F.when(cond, n).otherwise(0)
    return (
        add(has("pathogenic") & ~s.rlike("likely_pathogenic|benign"), 8)
        + add(has("likely_pathogenic"), 7)
        + add(s.rlike("uncertain|vus|conflicting"), 2)
        - add(has("likely_benign"), 2)
        - add(has("benign") & ~s.rlike("likely_benign|pathogenic"), 4)
    )


def best_annotation(df: DataFrame, key: str = "variant_id", tie: str = "csq_raw") -> DataFrame:
    """The strongest record per variant; ties go to the higher impact, then to ``tie``.

    An aggregate, not a window: it combines map-side, so a variant with very many
    records costs one row per task.
    """
    weight = F.lit(0)
    for name, value in IMPACT_WEIGHTS.items():
        weight = F.when(F.upper("impact") == name, value).otherwise(weight)
    score = weight * 10 + clinical_rank()
    rest = [c for c in df.columns if c != key]
    best = df.groupBy(key).agg(
        F.min_by(F.struct(*rest), F.struct((-score).alias("s"), (-weight).alias("w"), F.col(tie).alias("t"))).alias("_b"),
        F.max(score).alias("rank_score"),
    )
    return best.select(key, *[F.col(f"_b.{c}").alias(c) for c in rest], "rank_score")
