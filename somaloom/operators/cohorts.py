"""Counts of many cohorts in one table, stored sparsely.

A row is one variant of one cohort: ``cohort, variant_id, chrom, pos, ref, alt, n_cells`` and three arrays of equal
length, sorted by cell: ``cells`` (numbers 1 ... n_cells of the cohort's cells), ``nv``, ``nr``. Only cells with a read are
stored; every other cell of the cohort counts as 0 / 0, by ``n_cells`` alone. Totals, prevalence, overdispersion, carriers and
the cascade are read off the stored entries, so work follows the reads and not cells x variants, and the full grid appears at
a sink only (:func:`grid`). A variant's row holds at most one entry per cell of its cohort.

All adjustments and shares are within the cohort: q-values, prevalence, coverage and the funnel of one cohort do not
change with the others in the table.

Defined results: observations of samples that the sheet does not list are left out, listed samples without reads count as
empty cells; a variant that a cohort has only low-quality reads of is there with empty arrays; a null cohort is no cohort.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from somaloom.functions.ranks import bh_adjust
from somaloom.functions.stats import betabinom_rho_of, binomial_less_pvalue, log10_floored, log10_or_neg_inf
from somaloom.functions.variants import gt_flags, is_snv_strict, vaf
from somaloom.operators.cascade import PRESETS, STAGES, CascadePreset
from somaloom.operators.germline_stats import expected_fraction, _haploid

KEY = ("cohort", "variant_id")
SITE = ("chrom", "pos", "ref", "alt")
#: Cells and variants of a tile of a grid.
TILE_CELLS, TILE_ROWS = 256, 64


# ---- building ---------------------------------------------------------------------------------------


def number_cells(samples: DataFrame) -> DataFrame:
    """(cohort, sample_id, cell, n_cells) of a sample sheet: numbers from 1 in the order of names.

    The names of a cohort are one sorted array, which is no longer than the cohort has cells.
    """
    names = samples.filter("cohort IS NOT NULL AND sample_id IS NOT NULL").groupBy("cohort").agg(F.sort_array(F.collect_set("sample_id")).alias("_names"))
    return names.select("cohort", F.posexplode("_names").alias("_k", "sample_id"), F.size("_names").alias("n_cells")).select(
        "cohort", "sample_id", (F.col("_k") + 1).alias("cell"), "n_cells")


def cohort_sizes(cells: DataFrame) -> DataFrame:
    """(cohort, n_cells): a row per cohort."""
    return cells.groupBy("cohort").agg(F.max("n_cells").alias("n_cells"))


def entries_from_obs(obs: DataFrame, mq: int = 30, bq: int = 30) -> DataFrame:
    """HQ support and depth per (cohort, sample, variant), when every observation names its candidate variant."""
    hq = F.coalesce((F.col("mq") >= mq) & (F.col("bq") >= bq), F.lit(False))
    return obs.groupBy(*KEY, *SITE, "sample_id").agg(F.count_if(hq & F.col("is_alt")).alias("nv"), F.count_if(hq).alias("nr"))


def entries_from_metrics(metrics: DataFrame, variants: DataFrame | None = None) -> DataFrame:
    """The same from pileup metrics: support of each alternate allele, depth of its locus in every cell that covers it.

    ``metrics`` (one row per cohort, sample and allele) should be a written table; ``variants`` (cohort, variant_id) restricts
    the alternates. A site meets the rows of its locus once, which give both depth and support; nothing absent is made.
    """
    locus = ["cohort", "chrom", "pos"]
    alts = metrics.filter("alt <> 'REF'")
    if variants is not None:
        alts = alts.join(variants.select(*KEY).distinct(), list(KEY), "left_semi")
    sites = alts.select("cohort", "variant_id", *SITE).repartition(*locus).distinct()
    rows = metrics.select(*locus, "sample_id", "depth_hq", F.when((F.col("alt") != "REF") & F.col("sample_id").isNotNull(), F.col("variant_id")).alias("_seen"),
                          (F.col("n_hq_f") + F.col("n_hq_r")).alias("_n")).repartition(*locus)
    own = F.when(F.col("_seen") == F.col("variant_id"), F.col("_n"))
    return sites.join(rows, locus).groupBy("cohort", "variant_id", "sample_id", *SITE).agg(F.max("depth_hq").alias("nr"), F.coalesce(F.max(own), F.lit(0)).alias("nv"))


def deal(rows: DataFrame) -> DataFrame:
    """Rows dealt by variant to as many tasks as the session's shuffles have.

    For rows that unpack to all cells of their cohort: file splits and adaptive merging go by bytes, which say nothing of the
    rows they become, and make about one task a core or fewer; the few over run alone. Moves the sparse rows once.
    """
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *KEY)


def compress(entries: DataFrame, cells: DataFrame) -> DataFrame:
    """Sparse rows from long entries (cohort, variant, site, sample_id, nv, nr) and numbered cells."""
    numbered = entries.join(cells, ["cohort", "sample_id"])
    stored = F.when((F.col("nv") > 0) | (F.col("nr") > 0), F.struct("cell", F.col("nv").cast("int").alias("nv"), F.col("nr").cast("int").alias("nr")))
    packed = numbered.groupBy(*KEY, *SITE).agg(F.max("n_cells").alias("n_cells"), F.sort_array(F.collect_list(stored)).alias("_e"))
    return packed.select(*KEY, *SITE, "n_cells", F.col("_e.cell").alias("cells"), F.col("_e.nv").alias("nv"), F.col("_e.nr").alias("nr"))


def entries(sparse: DataFrame, *more: str) -> DataFrame:
    """Stored entries as rows: cohort, variant_id, cell and the array columns ``nv``, ``nr`` and ``more``, unpacked; no shuffle."""
    arrays = ["cells", "nv", "nr", *more]
    zipped = F.explode(F.arrays_zip(*arrays)).alias("_e")
    rest = [c for c in sparse.columns if c not in arrays]
    return sparse.select(*rest, zipped).select(*rest, F.col("_e.cells").alias("cell"), *[F.col(f"_e.{a}").alias(a) for a in arrays[1:]])


def _tile(batch: pa.RecordBatch, values: Sequence[str]) -> pa.RecordBatch:
    """Sparse rows of one cohort, with its number of blocks, as a row for each block: ``_block`` and ``_rows``, of entries in that block."""
    n, blocks = batch.num_rows, batch["_blocks"][0].as_py()
    cell = batch["cells"].flatten().to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(n), pc.fill_null(pc.list_value_length(batch["cells"]), 0).to_numpy())
    at = (cell - 1) // TILE_CELLS * n + row
    order = np.lexsort((cell, at))
    cell, at = cell[order], at[order]
    if ((cell[1:] == cell[:-1]) & (at[1:] == at[:-1])).any():
        raise ValueError("a cell stands twice in a row")
    ends = np.cumsum(np.bincount(at, minlength=blocks * n))[:blocks * n]  # cells that the sheet does not number come last
    held = pa.StructArray.from_arrays([batch[v].flatten().take(pa.array(order)) for v in values], names=list(values))
    part = pa.MapArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(cell, pa.int32()), held)
    rest = [c for c in batch.schema.names if c not in ("cohort", "_blocks", "cells", *values)]
    again = pa.array(np.tile(np.arange(n), blocks))
    rows = pa.StructArray.from_arrays([*[batch[c].take(again) for c in rest], part], names=[*rest, "_part"])
    return pa.RecordBatch.from_arrays([
        batch["cohort"].take(pa.array(np.zeros(blocks, dtype=np.int64))), pa.array(np.arange(blocks), pa.int32()),
        pa.ListArray.from_arrays(pa.array(np.arange(blocks + 1) * n, pa.int32()), rows)], names=["cohort", "_block", "_rows"])


def tiles(rows: DataFrame, cells: DataFrame, values: Sequence[str], sample: str) -> DataFrame:
    """Sparse rows (cohort, ``cells``, arrays ``values``, others) once for each block of cells, for :func:`unpack`.

    Some variants of a cohort meet a block of its cells, then the next block: names of cells come again after a few hundred rows.
    Written variant by variant, a name comes again only after all cells of the cohort, farther than a file's encoding looks back,
    and a column of names takes nearly its plain size.

    The sheet's names are broadcast, some 50 bytes a cell: a grid has a row of each for every variant. Spark takes the tiles for as
    small as the sparse rows they are made of, and would broadcast those where they are few.
    """
    block = F.floor((F.col("cell") - 1) / TILE_CELLS).cast("int")
    names = cells.groupBy("cohort", block.alias("_block")).agg(F.sort_array(F.collect_list(F.struct("cell", sample))).alias("_names"))
    shaped = deal(rows.join(F.broadcast(cells.groupBy("cohort").agg((F.max(block) + 1).alias("_blocks"))), "cohort"))
    rest = [f for f in shaped.schema if f.name not in ("cohort", "_blocks", "cells", *values)]
    held = T.StructType([T.StructField(v, shaped.schema[v].dataType.elementType) for v in values])
    one = T.StructType([*rest, T.StructField("_part", T.MapType(T.IntegerType(), held))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.take(pc.sort_indices(batch["cohort"]))
            cohort = batch["cohort"].dictionary_encode().indices.to_numpy()
            ends = np.append(np.flatnonzero(cohort[1:] != cohort[:-1]) + 1, len(cohort))
            for start, end in zip(np.append(0, ends[:-1]), ends):
                for k in range(start, end, TILE_ROWS):
                    yield _tile(batch.slice(k, min(TILE_ROWS, end - k)), values)

    kinds = T.StructType([shaped.schema["cohort"], T.StructField("_block", T.IntegerType()), T.StructField("_rows", T.ArrayType(one))])
    met = shaped.mapInArrow(run, kinds).join(F.broadcast(names), ["cohort", "_block"]).select("cohort", "_names", F.explode("_rows").alias("_r"))
    return met.select("cohort", *[F.col(f"_r.{f.name}").alias(f.name) for f in rest], "_r._part", "_names")


def unpack(tiled: DataFrame, sample: str) -> DataFrame:
    """A row for every cell of a tile's rows, with ``_e``, the cell's entry, NULL where none is stored; no shuffle."""
    rest = [c for c in tiled.columns if c not in ("_part", "_names")]
    one = tiled.select(*rest, "_part", F.explode("_names").alias("_n"))
    return one.select(*rest, F.col(f"_n.{sample}").alias(sample), F.try_element_at("_part", F.col("_n.cell")).alias("_e"))


def grid(sparse: DataFrame, cells: DataFrame, sample: str = "sample_id") -> DataFrame:
    """The full cell x variant table, zeros written out: for a sink. Rows come in tiles (:func:`tiles`), variants dealt to all tasks."""
    one = unpack(tiles(sparse.select(*KEY, *SITE, "cells", "nv", "nr"), cells, ["nv", "nr"], sample), sample)
    value = lambda name: F.coalesce(F.col(f"_e.{name}"), F.lit(0)).alias(name)
    return one.select(*KEY, sample, *SITE, value("nv"), value("nr"))


# ---- statistics -------------------------------------------------------------------------------------


def _total(values) -> Column:
    return F.aggregate(values, F.lit(0).cast("bigint"), lambda acc, x: acc + x)


def totals(sparse: DataFrame, min_depth: float = -1, max_depth: float = 9999999, sex: str = "male", raise_depth: bool = False) -> DataFrame:
    """Pooled counts, mean depth over all cells, carriers, depth filter and germline p-value of every variant, from its own row."""
    nr = F.zip_with("nr", "nv", lambda a, b: F.greatest(a, b)) if raise_depth else F.col("nr")
    half = F.when(_haploid(sex), 2.0).otherwise(1.0)
    summed = sparse.select(*KEY, *SITE, "n_cells", _total("nv").alias("nv_total"), _total(nr).alias("nr_total"), F.size(F.filter("nv", lambda x: x > 0)).alias("n_carriers"))
    return summed.withColumn("mean_depth", F.col("nr_total") / F.col("n_cells")).withColumns({
        "depth_filter": (F.col("mean_depth") > min_depth / half) & (F.col("mean_depth") < max_depth / half),
        "germline_p": binomial_less_pvalue("nv_total", "nr_total", expected_fraction(sex))})


def overdispersion(sparse: DataFrame, empty_as_one: bool = False, raise_depth: bool = False) -> Column:
    """Grid overdispersion of each row; empty cells weigh as one reference read with ``empty_as_one``, else not at all."""
    nr = F.zip_with("nr", "nv", lambda a, b: F.greatest(a, b)) if raise_depth else F.col("nr")
    ones = F.transform("cells", lambda c: F.lit(1))
    if not empty_as_one:
        return betabinom_rho_of(F.col("nv"), nr, ones)
    rest = F.col("n_cells") - F.size("cells")
    one = F.array(F.lit(1))
    return betabinom_rho_of(F.concat("nv", F.array(F.lit(0))), F.concat(F.transform(nr, lambda x: F.greatest(x, F.lit(1))), one), F.concat(ones, F.array(rest)))


def first_pass(sparse: DataFrame, min_depth: float = -1, max_depth: float = 9999999, sex: str = "male") -> DataFrame:
    """First statistical pass of every cohort.

    Overdispersion only for variants seen in several cells that pass depth and whose p-value, adjusted within the
    chromosome of the cohort, is below 0.05; NULL otherwise.
    """
    stats = totals(sparse, min_depth, max_depth, sex, raise_depth=True)
    adjusted = bh_adjust(stats, "germline_p", by=["cohort", "chrom"], out="_chrom_q")
    tested = adjusted.filter((F.col("_chrom_q") < 0.05) & F.col("depth_filter") & (F.col("n_carriers") > 1)).select(*KEY)
    rho = sparse.join(tested, list(KEY), "left_semi").select(*KEY, overdispersion(sparse, empty_as_one=True, raise_depth=True).alias("rho"))
    return stats.join(rho, list(KEY), "left").withColumns({"germline_p_log10": log10_or_neg_inf("germline_p"), "sex": F.lit(sex)})


def first_pass_verdict(stats: DataFrame, q_cut: float = -5, rho_cut: float = 0.1) -> DataFrame:
    """Adjustment over the whole cohort, germline and overdispersion filters and their combined verdict text."""
    q = bh_adjust(stats, "germline_p", by=["cohort"], out="germline_q")
    spell = lambda flag: F.upper(F.col(flag).cast("string"))
    return (
        q.withColumn("germline_q_log10", log10_or_neg_inf("germline_q"))
        .withColumns({"germline_filter": F.coalesce(F.col("germline_q_log10") < q_cut, F.lit(False)), "betabinom_filter": F.col("rho").isNull() | (F.col("rho") > rho_cut)})
        .withColumn("verdict", F.concat_ws("_", spell("depth_filter"), spell("germline_filter"), spell("betabinom_filter")))
        .withColumn("stat_pass", F.col("verdict") == "TRUE_TRUE_TRUE"))


def second_pass(sparse: DataFrame, q_cut: float = 2, rho_snv: float = 0, rho_indel: float = 0, min_depth: float = -1, max_depth: float = 9999999, sex: str = "male") -> DataFrame:
    """Second statistical pass: adjustment within cohort and chromosome, depth, overdispersion of every variant."""
    stats = totals(sparse, min_depth, max_depth, sex).select(*KEY, *SITE, "n_cells", "mean_depth", "depth_filter", "germline_p")
    rho = sparse.select(*KEY, overdispersion(sparse).alias("rho"))
    out = bh_adjust(stats, "germline_p", by=["cohort", "chrom"], out="germline_q").join(rho, list(KEY))
    indel = (F.length("ref") > 1) | (F.length("alt") > 1)
    out = out.withColumns({
        "germline_filter": F.coalesce(log10_or_neg_inf("germline_q") < q_cut, F.lit(False)),
        "betabinom_filter": F.coalesce(F.col("rho") > F.when(indel, float(rho_indel)).otherwise(float(rho_snv)), F.lit(False))})
    return out.withColumn("second_pass", F.when(F.col("depth_filter") & F.col("germline_filter") & F.col("betabinom_filter"), "Pass").otherwise("Fail"))


def prevalence(calls: DataFrame, cells: DataFrame, gt: str = "gt") -> DataFrame:
    """Het and non-reference cells per variant and cohort, as counts and as shares of all cells of the cohort."""
    flags = gt_flags(gt)
    per = calls.groupBy(*KEY).agg(F.count_if(flags["het"]).alias("n_het"), F.count_if(flags["non_ref"]).alias("n_non_ref"))
    return per.join(cohort_sizes(cells), "cohort").withColumns({
        "het_pct": F.col("n_het") / F.col("n_cells") * 100, "prevalence": F.col("n_non_ref") / F.col("n_cells")})


# ---- cascade ----------------------------------------------------------------------------------------


def cascade(sparse: DataFrame, stats: DataFrame, verdicts: DataFrame, preset: str | CascadePreset = "wgs") -> DataFrame:
    """Rows with evidence, with ``vaf`` and ``call`` arrays beside the counts and one flag per stage.

    ``stats``: cohort, variant_id, rho, germline_q of the second pass; ``verdicts``: cohort, variant_id, pileup_verdict. A cell
    without a read has call 0, so all rules hold on stored entries; the share of covered cells is taken of ``n_cells``.
    """
    k = PRESETS[preset] if isinstance(preset, str) else preset
    rows = sparse.withColumn("n_carriers", F.size(F.filter("nv", lambda x: x > 0))).filter("n_carriers > 0")
    rows = rows.join(stats.select(*KEY, "rho", "germline_q"), list(KEY), "left").join(verdicts.select(*KEY, "pileup_verdict"), list(KEY), "left")
    cells = F.transform(F.arrays_zip("nv", "nr"), lambda e: F.struct(e["nv"].alias("nv"), e["nr"].alias("nr"), vaf(e["nv"], e["nr"]).alias("vaf")))
    single = F.col("n_carriers") == 1
    deep = lambda e: e["nr"] >= k.depth
    strict = lambda e: deep(e) & (e["nv"] >= k.strict_reads)
    anchor = lambda e: strict(e) & (e["vaf"] >= k.anchor_vaf)
    relaxed = lambda e: deep(e) & (e["nv"] >= k.relaxed_reads) & (e["vaf"] >= k.relaxed_vaf)
    rows = rows.withColumn("_c", cells).withColumns({
        "class": F.when(single, "singleton").otherwise("shared"), "_anchored": F.exists("_c", anchor),
        "_covered": F.when(F.lit(k.depth > 0), F.size(F.filter("_c", deep))).otherwise(F.col("n_cells"))})
    call = F.transform("_c", lambda e: (
        F.when(single, strict(e) & (e["vaf"] >= k.singleton_vaf)).when(F.col("_anchored"), relaxed(e)).otherwise(anchor(e))).cast("int"))
    kept = F.coalesce((F.col("rho") >= k.min_rho) & (log10_floored("germline_q") <= k.max_log10_q), F.lit(False))
    rows = rows.withColumns({"vaf": F.col("_c.vaf"), "call": call, "hqstat": single | kept})
    rows = rows.withColumn("qc", F.col("hqstat") & F.coalesce(F.col("pileup_verdict") == "Pass", F.lit(False)))
    rows = rows.withColumn("depth", F.col("qc") & F.array_contains("call", 1))
    return rows.withColumn("phylogeny", F.col("depth") & (F.col("_covered") >= F.col("n_cells") * F.lit(k.covered_share))).drop("_c", "_anchored", "_covered")


def staged(flagged: DataFrame) -> DataFrame:
    """Stored entries of every stage a variant reaches: cohort, variant_id, cell, nv, nr, vaf, call, stage. Cells not listed have no read."""
    supported = F.transform("nv", lambda x: (x > 0).cast("int"))
    stage = lambda name, flag, calls: F.when(flag, F.struct(F.lit(name).alias("stage"), calls.alias("call")))
    reached = F.filter(F.array(
        stage("unfiltered", F.lit(True), supported), stage("hqstat", F.col("hqstat"), supported),
        *[stage(s, F.col(s), F.col("call")) for s in STAGES[2:]]), lambda e: e.isNotNull())
    rows = flagged.select(*KEY, "ref", "alt", "cells", "nv", "nr", "vaf", F.explode(reached).alias("_s")).select(
        *KEY, "ref", "alt", "cells", "nv", "nr", "vaf", F.col("_s.stage").alias("stage"), F.col("_s.call").alias("call"))
    return entries(rows, "vaf", "call")


def vaf_split(flagged: DataFrame, cells: DataFrame) -> DataFrame:
    """All stages on the full grid, for a sink: cohort, variant_id, sample_id, nr, nv, vaf, call, stage; in tiles, as :func:`grid`."""
    stage = [F.when(F.lit(True) if s == "unfiltered" else F.col(s), F.lit(s)) for s in STAGES]
    values = ["nv", "nr", "vaf", "call"]
    rows = flagged.select(*KEY, F.filter(F.array(*stage), lambda s: s.isNotNull()).alias("_stages"), "cells", *values)
    tiled = tiles(rows, cells, values, "sample_id").withColumn("stage", F.explode("_stages")).drop("_stages")
    tiled = tiled.withColumn("_supported", F.col("stage").isin("unfiltered", "hqstat"))
    value = lambda name: F.coalesce(F.col(f"_e.{name}"), F.lit(0))
    called = F.when(F.col("_supported"), (value("nv") > 0).cast("int")).otherwise(value("call"))
    return unpack(tiled, "sample_id").select(
        *KEY, "sample_id", value("nr").alias("nr"), value("nv").alias("nv"), F.coalesce("_e.vaf", F.lit(0.0)).alias("vaf"), called.alias("call"), "stage")


def cell_counts(flagged: DataFrame, cells: DataFrame) -> DataFrame:
    """SNV and INDEL calls per cohort, stage and cell; cells without a call keep a zero row."""
    called, snv = F.col("call") == 1, is_snv_strict()
    per = staged(flagged).groupBy("cohort", "stage", "cell").agg(F.count_if(called & snv).alias("n_snv"), F.count_if(called & ~snv).alias("n_indel"))
    every = cells.select("cohort", "cell", "sample_id", F.explode(F.array(*[F.lit(s) for s in STAGES])).alias("stage"))
    out = every.join(per, ["cohort", "stage", "cell"], "left")
    return out.select("cohort", "stage", "sample_id", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n_snv", "n_indel")])


def funnel(stats: DataFrame, flagged: DataFrame) -> DataFrame:
    """Variants that enter and pass each step, per cohort: stage, n_input, n_passing, n_removed, pct_of_input, pct_of_total.

    ``stats``: every variant with ``depth_filter``, ``germline_filter`` and ``betabinom_filter`` of the first pass; the steps
    after them are the cascade's. One aggregate a source.
    """
    first = ["depth_filter", "germline_filter", "betabinom_filter"]
    passing, flags = F.lit(True), []
    for name in first:
        passing = passing & F.col(name)
        flags.append(F.count_if(passing).alias(name))
    one = stats.groupBy("cohort").agg(F.count(F.lit(1)).alias("all"), *flags)
    two = flagged.groupBy("cohort").agg(F.count(F.lit(1)).alias("unfiltered"), *[F.count_if(F.col(s)).alias(s) for s in STAGES[1:]])
    both = one.join(two, "cohort", "left")
    steps = [("first_pass_depth", "all", "depth_filter"), ("first_pass_germline", "depth_filter", "germline_filter"), ("first_pass_betabinom", "germline_filter", "betabinom_filter"),
             ("evidence", "all", "unfiltered"), *[(f"split_{b}", a, b) for a, b in zip(STAGES, STAGES[1:])]]
    count = lambda name: F.coalesce(F.col(f"`{name}`"), F.lit(0)).cast("bigint")
    rows = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(name).alias("stage"), count(a).alias("n_input"), count(b).alias("n_passing"), count("all").alias("_all"))
                     for k, (name, a, b) in enumerate(steps)])
    share = lambda of: F.round(100 * F.try_divide(F.col("n_passing").cast("double"), F.col(of)), 2)
    return both.select("cohort", F.explode(rows).alias("_r")).select("cohort", "_r.*").select(
        "cohort", "stage", "n_input", "n_passing", (F.col("n_input") - F.col("n_passing")).alias("n_removed"), share("n_input").alias("pct_of_input"), share("_all").alias("pct_of_total"))


def membership(flagged: DataFrame, sparse: DataFrame) -> DataFrame:
    """One 0/1 flag per scheme for every variant of every cohort."""
    flags = flagged.select(*KEY, F.lit(1).alias("unfiltered"), *[F.col(s).cast("int").alias(s) for s in STAGES[1:]])
    return sparse.select(*KEY).join(flags, list(KEY), "left").select(*KEY, *[F.coalesce(s, F.lit(0)).alias(f"scheme_{s}") for s in STAGES])
