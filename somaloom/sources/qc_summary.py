"""The QC summary row of a biosample, from the text reports of the tools that ran on it.

Reports are rows ``(biosample, kind, text)``. All reports of a biosample (a dozen small texts) become one map, and the summary is a
projection of that map: one shuffle of the reports, no join between them.

Defined results: of several reports of one kind the last text in order counts; a field that a report leaves out or leaves
empty is 0, an unreadable one NULL; fields of a missing report are NULL, but for read counts and the complexity count, which are 0;
a biosample without reports has no row; kinds that are not known are ignored.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from somaloom.functions.quality import qc_score, qc_status
from somaloom.sources.reports import TRIM_SCHEMA, report_fields
from somaloom.sources.sinks import enforce_schema

# fixed values: fields of each report and the columns they fill. A plain name gives prefix + name in small letters.
ALIGNMENT_INTS = ("TOTAL_READS", "PF_READS", "PF_READS_ALIGNED", "PF_HQ_ALIGNED_READS", "PF_HQ_ALIGNED_BASES", "PF_HQ_ALIGNED_Q20_BASES", "READS_ALIGNED_IN_PAIRS", "BAD_CYCLES")
ALIGNMENT_RATES = ("PF_MISMATCH_RATE", "PF_HQ_ERROR_RATE", "PF_INDEL_RATE", "MEAN_READ_LENGTH", "PCT_READS_ALIGNED_IN_PAIRS", "STRAND_BALANCE", "PCT_CHIMERAS", "PCT_ADAPTER")
DEDUP_INTS = {"UNPAIRED_READS_EXAMINED": "unpaired_reads_examined", "READ_PAIRS_EXAMINED": "read_pairs_examined",
              "SECONDARY_OR_SUPPLEMENTARY_RDS": "secondary_or_supplementary_reads", "UNMAPPED_READS": "unmapped_reads",
              "UNPAIRED_READ_DUPLICATES": "unpaired_read_duplicates", "READ_PAIR_DUPLICATES": "read_pair_duplicates",
              "READ_PAIR_OPTICAL_DUPLICATES": "read_pair_optical_duplicates", "ESTIMATED_LIBRARY_SIZE": "estimated_library_size"}
INSERT = {"MEDIAN_INSERT_SIZE": "median", "MODE_INSERT_SIZE": "mode", "MEDIAN_ABSOLUTE_DEVIATION": "median_absolute_deviation", "MIN_INSERT_SIZE": "min",
          "MAX_INSERT_SIZE": "max", "MEAN_INSERT_SIZE": "mean", "STANDARD_DEVIATION": "std", "READ_PAIRS": "read_pairs"}
WIDTHS = (10, 20, 30, 40, 50, 60, 70, 80, 90, 95, 99)
GC_BINS = ("GC_NC_0_19", "GC_NC_20_39", "GC_NC_40_59", "GC_NC_60_79", "GC_NC_80_100")
COVERAGE_LEVELS = (1, 5, 10, 15, 20, 25, 30, 40, 50, 60, 70, 80, 90, 100)
EXCLUDED = ("MAPQ", "DUPE", "UNPAIRED", "BASEQ", "OVERLAP", "CAPPED", "TOTAL")
TARGET_LEVELS = (1, 2, 10, 20, 30, 40, 50, 100, 250, 500, 1000)
WHOLE = ("total_reads", "final_reads", "preseq_count", "insert_mode", "insert_read_pairs", "insert_width_of_95_pct", "gc_total_clusters", "gc_aligned_reads",
         "cov_total_bases", "cov_chrm_bases", "sentieon_total_bases")


def report_map(reports: DataFrame) -> DataFrame:
    """(biosample, _r): the texts of a biosample by kind."""
    last = reports.filter("biosample IS NOT NULL AND kind IS NOT NULL AND text IS NOT NULL").groupBy("biosample", "kind").agg(F.max("text").alias("text"))
    return last.groupBy("biosample").agg(F.map_from_entries(F.collect_list(F.struct("kind", "text"))).alias("_r"))


def _text(kind: str) -> Column:
    return F.try_element_at("_r", F.lit(kind))


def _number(fields: Column, name: str, kind: str = "double") -> Column:
    """A field as a number: 0 when absent or empty, NULL when unreadable or without the report."""
    value = F.try_element_at(fields, F.lit(name))
    return F.when(fields.isNotNull(), F.when(F.coalesce(F.trim(value), F.lit("")) == "", F.lit(0).cast(kind)).otherwise(F.trim(value).try_cast(kind)))


def _share(a: Column, b: Column) -> Column:
    return F.when(b > 0, a.cast("double") / b).when(b.isNotNull(), 0.0)


#: header token of each report, by kind
HEADERS = {"dedup": ("LIBRARY",), "insert_size": ("MEDIAN_INSERT_SIZE",), "gc_bias": ("ACCUMULATION",), "quality_yield": ("TOTAL_READS", "TOTAL_BASES"),
           "coverage_metrics": ("GENOME_TERRITORY", "MEAN_COVERAGE"), "target_metrics": ("BAIT_SET",)}


def _with_fields(rows: DataFrame, *kinds: str) -> DataFrame:
    """Parse each report once, into a column ``_<kind>`` of its fields."""
    fields = {f"_{k}": F.coalesce(*[report_fields(_text(k), token) for token in HEADERS[k]]) for k in kinds}
    return rows.withColumns(fields | {"_alignment": report_fields(_text("alignment"), "CATEGORY", ["PAIR", "UNPAIRED"])})


def _alignment(prefix: str) -> dict[str, Column]:
    fields = F.col("_alignment")
    return {f"{prefix}{n.lower()}": _number(fields, n, kind) for names, kind in ((ALIGNMENT_INTS, "bigint"), (ALIGNMENT_RATES, "double")) for n in names}


def _yield() -> dict[str, Column]:
    fields = F.col("_quality_yield")
    total = _number(fields, "TOTAL_BASES")
    return {"sentieon_total_bases": total.cast("bigint"), **{f"sentieon_q{q}_rate": _share(_number(fields, f"Q{q}_BASES"), total) for q in (20, 30)}}


def _coverage_lines() -> tuple[Column, Column]:
    """All bases and mitochondrial bases of an interval summary."""
    lines = F.filter(F.split(_text("coverage"), "\r?\n"), lambda s: ~s.startswith("#") & ~s.startswith("Target") & s.contains("\t"))
    bases = lambda s: F.coalesce(F.floor(F.get(F.split(s, "\t"), F.lit(1)).try_cast("double")), F.lit(0))
    chrom = lambda s: F.element_at(F.split(F.element_at(F.split(s, "\t"), 1), ":"), 1)
    add = lambda keep: F.aggregate(lines, F.lit(0).cast("bigint"), lambda acc, s: acc + F.when(keep(s), bases(s)).otherwise(0))
    return add(lambda s: F.lit(True)), add(lambda s: chrom(s).isin("chrM", "MT"))


def _constants(df: DataFrame, constants: Mapping[str, str]) -> DataFrame:
    return df.withColumns({k: F.lit(v) for k, v in constants.items()}) if constants else df


def dna_qc_summary(reports: DataFrame, cnv: DataFrame | None = None, cutoffs: dict[str, float] | None = None, **constants: str) -> DataFrame:
    """One typed row per biosample of a low-pass DNA run.

    Kinds: ``read_counts`` (all and kept reads, a line each), ``trim`` (JSON), ``alignment``, ``quality_yield``, ``dedup``, ``insert_size``,
    ``gc_bias``, ``coverage`` (interval summary), ``preseq``. ``cnv``: biosample, mapd, skew, ploidy, average_ploidy. ``constants`` are
    the run's own columns (dataset, pipeline, version, workspace ...).
    """
    rows = _with_fields(report_map(reports), "dedup", "insert_size", "gc_bias", "quality_yield").withColumn("_trim", F.from_json(_text("trim"), TRIM_SCHEMA))
    line = lambda k: F.get(F.split(_text("read_counts"), "\n"), F.lit(k))
    both = F.trim(line(0)).try_cast("bigint").isNotNull() & F.trim(line(1)).try_cast("bigint").isNotNull()
    reads = {n: F.when(both, F.trim(line(k)).try_cast("bigint")).otherwise(0) for k, n in enumerate(("total_reads", "final_reads"))}
    json = F.col("_trim")
    side = lambda s, n: json["summary"][s][n]
    trim = {f"fastp_{n}": side("before_filtering", n) for n in ("total_reads", "total_bases", "q20_rate", "q30_rate", "gc_content", "read1_mean_length", "read2_mean_length")}
    trim |= {"fastp_reads_after_filter": side("after_filtering", "total_reads"), "fastp_q30_rate_after": side("after_filtering", "q30_rate"),
             "fastp_adapter_trimmed_reads": json["adapter_cutting"]["adapter_trimmed_reads"], "fastp_adapter_trimmed_bases": json["adapter_cutting"]["adapter_trimmed_bases"],
             "fastp_duplication_rate": json["duplication"]["rate"]}
    trim = {n: F.when(_text("trim").isNotNull(), F.coalesce(c, F.lit(0))) for n, c in trim.items()}
    dedup, insert, gc = (F.col(f"_{k}") for k in ("dedup", "insert_size", "gc_bias"))
    total_bases, chrm_bases = _coverage_lines()
    rows = rows.withColumns({
        **reads, **trim, **_alignment("align_"), **_yield(),
        **{f"dedup_{n}": _number(dedup, f, "bigint") for f, n in DEDUP_INTS.items()}, "dedup_pct_duplication": _number(dedup, "PERCENT_DUPLICATION"),
        **{f"insert_{n}": _number(insert, f) for f, n in INSERT.items()}, **{f"insert_width_of_{w}_pct": _number(insert, f"WIDTH_OF_{w}_PERCENT") for w in WIDTHS},
        "insert_pair_orientation": F.when(insert.isNotNull(), F.coalesce(F.try_element_at(insert, F.lit("PAIR_ORIENTATION")), F.lit(""))),
        **{f"gc_{n.lower()}": _number(gc, n) for n in ("TOTAL_CLUSTERS", "ALIGNED_READS", "AT_DROPOUT", "GC_DROPOUT", *GC_BINS)},
        "cov_total_bases": total_bases, "cov_chrm_bases": chrm_bases,
        "preseq_count": F.coalesce(F.trim(_text("preseq")).try_cast("bigint"), F.lit(0)),
    }).drop("_r", "_trim", "_alignment", "_quality_yield", "_dedup", "_insert_size", "_gc_bias")
    pairs, optical = F.col("dedup_read_pairs_examined"), F.col("dedup_read_pair_optical_duplicates")
    rows = rows.withColumns({
        "subsampled": F.col("total_reads") != F.col("final_reads"),
        "fastp_q30_rate": F.when(F.coalesce(F.col("fastp_q30_rate"), F.lit(0.0)) == 0, F.coalesce("sentieon_q30_rate", "fastp_q30_rate")).otherwise(F.col("fastp_q30_rate")),
        "pct_aligned": _share(F.col("align_pf_reads_aligned"), F.col("align_total_reads")), "pct_pf": _share(F.col("align_pf_reads"), F.col("align_total_reads")),
        "pct_error": F.col("align_pf_mismatch_rate"), "pct_chimeras": F.col("align_pct_chimeras"), "pct_duplication": F.col("dedup_pct_duplication"),
        "pct_optical_duplicates": _share(optical, pairs), "pct_pcr_duplicates": _share(F.col("dedup_read_pair_duplicates") - optical, pairs),
        "insert_size": F.col("insert_median"), "pct_chrm": _share(F.col("cov_chrm_bases"), F.col("cov_total_bases"))})
    if cnv is None:
        rows = rows.withColumns({n: F.lit(None).cast("double") for n in ("_mapd", "_skew", "_ploidy", "ginkgo_average_ploidy")})
    else:
        rows = rows.join(cnv.select("biosample", F.col("mapd").alias("_mapd"), F.col("skew").alias("_skew"), F.col("ploidy").alias("_ploidy"),
                                    F.col("average_ploidy").alias("ginkgo_average_ploidy")), "biosample", "left")
    scored = rows.withColumns({"mapd_cnv_log2": F.col("_mapd").cast("double"), "skew_cnv": F.coalesce(F.col("_skew").try_cast("double"), F.lit(999.0))})
    scored = scored.withColumn("qc_score", qc_score("dna", cutoffs)).withColumns(qc_status("dna")).drop("mapd_cnv_log2", "skew_cnv")
    named = {"ginkgo_cnv_mapd": "_mapd", "ginkgo_cnv_skew": "_skew", "ginkgo_ploidy": "_ploidy"}
    out = _constants(scored.withColumns({n: F.col(c).cast("string") for n, c in named.items()}).drop("_mapd", "_skew", "_ploidy"), constants)
    return enforce_schema(out, bigints=[c for c in out.columns if c in WHOLE])


def wgs_qc_summary(reports: DataFrame, read_counts: DataFrame | None = None, mode: str = "wgs", cutoffs: dict[str, float] | None = None, **constants: str) -> DataFrame:
    """One typed row per biosample of a whole-genome (``wgs``) or capture (``wes``) run.

    Kinds: ``alignment``, ``quality_yield``, ``dedup``, ``flagstat`` (stands in for ``dedup``), ``insert_size``, ``gc_bias``, ``coverage_metrics``,
    ``target_metrics``. ``read_counts`` (biosample, total_reads) overrides the count of the alignment report, as after subsampling.
    """
    kinds = ("dedup", "insert_size", "gc_bias", "coverage_metrics", "target_metrics")
    rows = _with_fields(report_map(reports), "quality_yield", *kinds)
    dedup, insert, gc, depth, target = (F.col(f"_{k}") for k in kinds)
    found = lambda what: F.coalesce(F.regexp_extract(_text("flagstat"), rf"(?m)^\s*(\d+) \+ \d+ {what}", 1).try_cast("bigint"), F.lit(0))
    base = F.when(found("primary mapped") > 0, found("primary mapped")).otherwise(found("primary$"))
    aligned = {n.removeprefix("_"): c for n, c in _alignment("_").items() if n not in ("_pf_reads", "_reads_aligned_in_pairs", "_bad_cycles")}
    aligned["pf_aligned_bases"] = _number(F.col("_alignment"), "PF_ALIGNED_BASES", "bigint")
    fold = F.try_element_at(target, F.lit("FOLD_80_BASE_PENALTY"))
    rows = rows.withColumns({
        **aligned, **_yield(),
        "pct_duplication": F.coalesce(_number(dedup, "PERCENT_DUPLICATION"), F.when(_text("flagstat").isNotNull(), F.coalesce(_share(found("primary duplicates"), base), F.lit(0.0)))),
        **{n: _number(dedup, n.upper(), "bigint") for n in ("estimated_library_size", "read_pairs_examined", "read_pair_duplicates", "read_pair_optical_duplicates")},
        **{f"insert_{n}": _number(insert, f) for f, n in INSERT.items() if n not in ("mode", "median_absolute_deviation")}, "insert_mad": _number(insert, "MEDIAN_ABSOLUTE_DEVIATION"),
        **{n.lower(): _number(gc, n) for n in ("AT_DROPOUT", "GC_DROPOUT", *GC_BINS)},
        **{n.lower(): _number(depth, n) for n in ("MEAN_COVERAGE", "SD_COVERAGE", "MEDIAN_COVERAGE", "MAD_COVERAGE", "HET_SNP_SENSITIVITY",
                                                  *[f"PCT_{n}X" for n in COVERAGE_LEVELS], *[f"PCT_EXC_{n}" for n in EXCLUDED])},
        "het_snp_q": _number(depth, "HET_SNP_Q", "bigint"),
        **{n.lower(): _number(target, n) for n in ("MEAN_TARGET_COVERAGE", "FOLD_ENRICHMENT", "PCT_SELECTED_BASES", "ZERO_CVG_TARGETS_PCT", *[f"PCT_TARGET_BASES_{n}X" for n in TARGET_LEVELS])},
        **{n.lower(): _number(target, n, "bigint") for n in ("ON_BAIT_BASES", "NEAR_BAIT_BASES", "OFF_BAIT_BASES")},
        "fold_80_base_penalty": F.when(~fold.isin("", "?"), fold.try_cast("double")),
    }).drop("_r", "_alignment", "_quality_yield", *[f"_{k}" for k in kinds])
    if read_counts is not None:
        rows = rows.join(read_counts.select("biosample", F.col("total_reads").cast("bigint").alias("_n")), "biosample", "left").withColumn("total_reads", F.coalesce("_n", "total_reads")).drop("_n")
    scored = rows.withColumn("qc_score", qc_score(mode, cutoffs)).withColumns(qc_status(mode)).withColumn("mode", F.lit(mode))
    return enforce_schema(_constants(scored, constants), bigints=["sentieon_total_bases", "insert_read_pairs", "insert_min", "insert_max"])
