"""Why each variant was kept or dropped: master table, funnels, redundancy, influence."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from somaloom.functions.stats import log10_or_neg_inf
from somaloom.functions.variants import is_snv_equal_length


def _prefixed(df: DataFrame, prefix: str) -> DataFrame:
    return df.select("variant_id", *[F.col(c).alias(f"{prefix}_{c}") for c in df.columns if c != "variant_id"])


def master_table(bulk: DataFrame, binom: DataFrame, vep: DataFrame, pileup: DataFrame, second: DataFrame,
                 cascade: DataFrame | None = None) -> DataFrame:
    """One row per variant of any source; source columns carry the source's prefix.

    ``cascade`` (``variant_id, class, retained`` and one boolean per stage) adds the
    membership columns. All joins share the key, so each source is shuffled once.
    """
    out = _prefixed(bulk, "bulk")
    for df, prefix in ((binom, "binom"), (vep, "vep"), (pileup, "pileup"), (second, "second")):
        out = out.join(_prefixed(df, prefix), "variant_id", "full")
    if cascade is None:
        return out
    joined = out.join(cascade, "variant_id", "left")
    yes = lambda c: F.when(F.col(c), "Yes").otherwise("No").alias(f"split_{c}")
    return joined.select(
        *out.columns, F.coalesce("class", F.lit("none")).alias("split_class"),
        F.when(F.col("class") == "shared", F.when(F.col("retained"), "Yes").otherwise("No")).otherwise(".").alias("split_retained"),
        *[yes(c) for c in ("hqstat", "qc", "depth", "phylogeny")])


def annotation_table(master: DataFrame) -> DataFrame:
    """Variants that pass the population, bulk and statistical filters, or are priority ones.

    Adds log10 of the second-pass q-value; an exact zero stays -Infinity.
    """
    ok = lambda c, v: F.coalesce(F.col(c) == v, F.lit(False))
    passed = ok("vep_filter_status", "PASS") & ok("bulk_bulk_status", "Pass") & ok("binom_statistical_status", "Pass")
    out = master.filter(passed | ok("priority_variant", "Yes"))
    return out.withColumn("second_germline_q_log10", log10_or_neg_inf("second_germline_q"))


def upstream_counts(calls: DataFrame, master: DataFrame, nv: str = "ad_alt") -> DataFrame:
    """SNV / INDEL per sample before and after each upstream filter; zero rows kept."""
    carried = calls.filter(F.col(nv) > 0).join(
        master.select("variant_id", "vep_filter_status", "bulk_bulk_status", "binom_statistical_status"), "variant_id", "left")
    ok = lambda c, v: F.coalesce(F.col(c) == v, F.lit(False))
    stages = {"pre_bulk": F.lit(True), "post_vep": ok("vep_filter_status", "PASS"),
              "post_bulk": ok("bulk_bulk_status", "Pass"), "post_binom": ok("binom_statistical_status", "Pass")}
    snv = is_snv_equal_length()
    counts = carried.groupBy("sample_id").agg(*[
        F.struct(F.lit(name).alias("stage"), F.count_if(cond & snv).alias("n_snv"), F.count_if(cond & ~snv).alias("n_indel")).alias(name)
        for name, cond in stages.items()])
    return counts.select("sample_id", F.explode(F.array(*stages)).alias("s")).select("sample_id", "s.*")


def filter_funnel(master: DataFrame, n_total: DataFrame, membership: DataFrame) -> DataFrame:
    """Eight stages with input, passing, removed and percentages. ``n_total`` lists the merged variants."""
    pct = lambda a, b: F.round(100 * F.try_divide(a.cast("double"), b), 6)
    m = master.agg(
        F.count_if(F.col("vep_filter_status") == "PASS").alias("vep"), F.count_if(F.col("bulk_bulk_status") == "Pass").alias("bulk"),
        F.count("binom_statistical_status").alias("binom_in"), F.count_if(F.col("binom_statistical_status") == "Pass").alias("binom"))
    names = ("unfiltered", "hqstat", "qc", "depth", "phylogeny")
    s = membership.agg(*[F.coalesce(F.sum(f"scheme_{n}"), F.lit(0)).alias(n) for n in names])
    one = n_total.select("variant_id").distinct().agg(F.count(F.lit(1)).alias("total"))
    # three one-row aggregates side by side
    row = one.select("total", m.select(F.struct("*")).scalar().alias("m"), s.select(F.struct("*")).scalar().alias("s"))
    c = F.col
    stages = [
        ("merged", c("total"), c("total")), ("population_filter", c("total"), c("m.vep")),
        ("bulk_filter", c("m.vep"), c("m.bulk")), ("statistical_filter", c("m.binom_in"), c("m.binom")),
        ("split_hqstat", c("s.unfiltered"), c("s.hqstat")), ("split_qc", c("s.hqstat"), c("s.qc")),
        ("split_depth", c("s.qc"), c("s.depth")), ("split_phylogeny", c("s.depth"), c("s.phylogeny")),
    ]
    rows = F.array(*[F.struct(F.lit(n).alias("stage"), i.cast("bigint").alias("n_input"), p.cast("bigint").alias("n_passing")) for n, i, p in stages])
    return row.select("total", F.explode(rows).alias("r")).select(
        "r.*", (c("r.n_input") - c("r.n_passing")).alias("n_removed"),
        pct(c("r.n_passing"), c("r.n_input")).alias("pct_of_input"), pct(c("r.n_passing"), c("total")).alias("pct_of_total"))


def filter_redundancy(membership: DataFrame, qc_pass: DataFrame) -> DataFrame:
    """2 x 2 overlap of the statistical and the artifact filter, Jaccard, retained shares and a verdict."""
    ids = qc_pass.select("variant_id", F.lit(True).alias("_q")).distinct()
    df = membership.join(ids, "variant_id", "left")
    hq, qc = F.col("scheme_hqstat") >= 1, F.coalesce("_q", F.lit(False))
    t = df.agg(F.count(F.lit(1)).alias("n_variants"), F.count_if(hq & qc).alias("both_pass"), F.count_if(hq & ~qc).alias("stat_only"),
               F.count_if(~hq & qc).alias("qc_only"), F.count_if(~hq & ~qc).alias("both_fail"))
    a, b, cc = F.col("both_pass"), F.col("stat_only"), F.col("qc_only")
    share = lambda x, y: F.round(F.coalesce(F.try_divide(x.cast("double"), y), F.lit(0.0)), 4)
    return t.withColumns({
        "stat_pass": a + b, "qc_pass": a + cc, "jaccard": share(a, a + b + cc),
        "stat_kept_by_qc": share(a, a + b), "qc_kept_by_stat": share(a, a + cc),
        "verdict": F.when((b == 0) & (cc == 0), "Fully redundant").when(b == 0, "QC redundant after HQStat")
        .when(cc == 0, "HQStat redundant after QC").otherwise("Complementary"),
    })


def filter_influence(focal: DataFrame, membership: DataFrame) -> DataFrame:
    """Leave-one-out effect of each artifact filter as ``(section, key, value)`` rows.

    ``focal`` is the flagged pileup of the focal variants; only variants of the
    statistical set count. NULL flags are cells that cannot be judged.
    """
    rows = focal.join(membership.filter("scheme_hqstat = 1").select("variant_id"), "variant_id", "left_semi")
    a, c, b = (F.coalesce(F.col(f), F.lit(False)) for f in ("as_pass", "clip_pass", "bppos_pass"))
    per = rows.groupBy("variant_id").agg(
        F.bool_or(a & c & b).alias("full"), F.bool_or(c & b).alias("no_as"), F.bool_or(a & b).alias("no_clip"), F.bool_or(a & c).alias("no_bppos"))
    full = F.count_if("full")
    loo = per.agg(full.alias("candidate_full"), (F.count_if("no_as") - full).alias("AS_removes"),
                  (F.count_if("no_clip") - full).alias("PropClipped_removes"), (F.count_if("no_bppos") - full).alias("BPPos_removes"))
    judged = rows.filter(F.col("as_pass").isNotNull())
    gross = judged.agg(F.count_if(~a).alias("AS_fail"), F.count_if(~c).alias("PropClipped_fail"),
                       F.count_if(~b).alias("BPPos_fail"), F.count(F.lit(1)).alias("evaluable"))
    combo = F.concat_ws(",", F.when(~a, "AS"), F.when(~c, "Clip"), F.when(~b, "BPPos"))
    combos = judged.groupBy(F.when(combo == "", "pass_all_3").otherwise(combo).alias("key")).agg(F.count(F.lit(1)).alias("value"))
    long = lambda df, section: df.unpivot([], df.columns, "key", "value").select(F.lit(section).alias("section"), "key", "value")
    return long(loo, "variant_loo").unionByName(long(gross, "cellvariant_gross")).unionByName(
        combos.select(F.lit("cellvariant_combo").alias("section"), "key", "value"))


def pileup_fail_classes(filtered: DataFrame) -> DataFrame:
    """Eight-way fail label per (cell, variant) and whether the variant passes in any cell."""
    names = F.concat_ws(" + ", F.when(~F.col("as_pass"), "AS"), F.when(~F.col("clip_pass"), "Clipping"), F.when(~F.col("bppos_pass"), "BPPos"))
    three = ~F.col("as_pass") & ~F.col("clip_pass") & ~F.col("bppos_pass")
    label = F.when(three, "All three fail").when(names == "", "Pass").otherwise(names)
    return filtered.withColumn("fail_class", label)


def fail_class_summary(labelled: DataFrame) -> DataFrame:
    """Cells per fail class, split by variants that pass somewhere and variants that never do."""
    per = labelled.groupBy("variant_id", "fail_class").agg(F.count(F.lit(1)).alias("n"))
    any_pass = per.groupBy("variant_id").agg(F.bool_or(F.col("fail_class") == "Pass").alias("passes_somewhere"))
    return per.join(any_pass, "variant_id").groupBy("passes_somewhere", "fail_class").agg(F.sum("n").alias("n_cells"))


def cohort_metrics(funnel: DataFrame, schemes: DataFrame, redundancy: DataFrame, influence: DataFrame) -> DataFrame:
    """The report tables flattened to ``(section, key, value)`` strings."""
    text = lambda c: F.col(c).cast("string")
    def wide(df: DataFrame, section: str, name: str, columns: dict[str, str]) -> DataFrame:
        pairs = F.array(*[F.struct(F.concat(F.col(name), F.lit("_" + out)).alias("key"), text(c).alias("value")) for c, out in columns.items()])
        return df.select(F.lit(section).alias("section"), F.explode(pairs).alias("p")).select("section", "p.*")
    parts = [
        wide(funnel, "funnel", "stage", {"n_input": "n_input", "n_passing": "n_passing", "n_removed": "n_filtered"}),
        wide(schemes, "scheme", "stage", {"n_snv": "snv", "n_indel": "indel", "n_total": "total"}),
        redundancy.select([text(c).alias(c) for c in redundancy.columns]).unpivot([], redundancy.columns, "key", "value")
        .select(F.lit("redundancy").alias("section"), "key", "value"),
        influence.select(F.concat(F.lit("qc_"), "section").alias("section"), "key", text("value").alias("value")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def mandatory_status(mandatory: DataFrame, membership: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Pass / Fail / NA of each mandatory variant on the statistical and the artifact filter."""
    df = (mandatory.select("variant_id").distinct()
          .join(membership.select("variant_id", "scheme_hqstat", F.lit(True).alias("_in")), "variant_id", "left")
          .join(verdicts.select("variant_id", "pileup_verdict"), "variant_id", "left"))
    hq = F.when(F.col("scheme_hqstat").isNull(), "NA").when(F.col("scheme_hqstat") >= 1, "Pass").otherwise("Fail")
    qc = F.when(F.col("pileup_verdict").isNull(), "NA").when(F.col("pileup_verdict") == "Pass", "Pass").otherwise("Fail")
    return df.select("variant_id", F.when(F.col("_in"), "Yes").otherwise("No").alias("in_matrices"), hq.alias("hqstat"), qc.alias("qc"),
                     F.when((hq == "Pass") & (qc == "Pass"), "Yes").otherwise("No").alias("passes_both"))


def cohort_burden(per_sample: DataFrame, count: str = "n_total") -> DataFrame:
    """Cells, cells with a variant, and the spread of variants per cell (counts are whole numbers)."""
    n = F.col(count)
    return per_sample.agg(F.count(F.lit(1)).alias("n_cells"), F.count_if(n > 0).alias("n_cells_with_variant"), F.min(n).alias("min_variants"),
                          F.median(n).alias("median_variants"), F.round(F.avg(n), 6).alias("mean_variants"), F.max(n).alias("max_variants"))
