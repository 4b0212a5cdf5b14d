"""The 7 x 5 worked matrices: the anchor rule must give exactly the stated calls."""

from pyspark.sql import functions as F

from somaloom.functions.variants import vaf
from somaloom.operators import cascade as C
from somaloom.operators import lineage as L

CELLS = ("A01", "A02", "A03", "A04", "A06")
MATRIX = """chr22_37024431_C_T 144/0/0 244/0/0 235/105/1 111/5/0 190/0/0
chr22_37805760_C_G 189/0/0 89/0/0 157/65/1 166/76/1 170/0/0
chr22_37805787_C_G 203/0/0 110/0/0 188/79/1 185/82/1 183/0/0
chr22_37945173_C_T 103/61/1 71/16/1 139/0/0 172/0/0 136/0/0
chr22_45535214_G_A 116/0/0 135/0/0 200/97/1 111/68/1 137/0/0
chr22_19479987_C_G 156/64/1 189/88/1 151/45/1 110/63/1 178/85/1
chr22_31821566_CA_C 289/130/1 336/151/1 259/104/1 397/188/1 189/93/1"""


def rows():
    for line in MATRIX.splitlines():
        v, *cells = line.split()
        for name, cell in zip(CELLS, cells):
            nr, nv, call = map(int, cell.split("/"))
            yield v, name, nv, nr, call


def frame(spark):
    df = spark.createDataFrame(list(rows()), "variant_id string, sample_id string, nv bigint, nr bigint, want int")
    from somaloom.functions.variants import with_variant_parts

    return with_variant_parts(df)


def test_anchor_call_reproduces_the_binary_matrix(spark):
    called = C.anchor_call(C.with_evidence(frame(spark)).withColumn("vaf", vaf()))
    assert called.filter("call <> want").count() == 0 and called.count() == 35


def test_cascade_stages_are_nested(spark):
    df = frame(spark)
    ids = df.select("variant_id").distinct()
    stats = ids.select("variant_id", F.lit(0.5).alias("rho"), F.when(F.col("variant_id").contains("1947"), 0.9).otherwise(1e-20).alias("germline_q"))
    verdicts = ids.select("variant_id", F.when(F.col("variant_id").contains("4553"), "Fail").otherwise("Pass").alias("pileup_verdict"))
    out = C.vaf_split(df, stats, verdicts)
    n = {r.stage: r.n for r in out.groupBy("stage").agg(F.count_distinct("variant_id").alias("n")).collect()}
    assert n == {"unfiltered": 7, "hqstat": 6, "qc": 5, "depth": 5, "phylogeny": 5}
    mandatory = spark.createDataFrame([("chr22_45535214_G_A",), ("chr1_1_A_T",)], "variant_id string")
    extra = C.vaf_split(df, stats, verdicts, mandatory).filter("stage = 'depth_mandatory'")
    assert extra.select("variant_id").distinct().count() == 6
    assert extra.filter("variant_id = 'chr22_45535214_G_A' AND call = 1").count() == 2


def test_variant_without_support_never_enters(spark):
    df = frame(spark).unionByName(frame(spark).withColumns({"variant_id": F.concat("variant_id", F.lit("x")), "nv": F.lit(0).cast("bigint")}))
    assert C.with_evidence(df).select("variant_id").distinct().count() == 7


def test_alignment_and_placement_on_the_matrix(spark):
    from somaloom.operators.germline_stats import genotype_discretize

    df = frame(spark)
    rows_ = L.alignment_strings(genotype_discretize(df)).collect()
    assert {len(r.sequence) for r in rows_} == {7} and sorted(r.short_name for r in rows_)[0] == "SC1"
    assert [r.sequence for r in rows_ if r.sample_id == "Ancestral"] == ["A" * 7]
    edges = spark.createDataFrame([(i, c) for i, c in enumerate(CELLS)] + [(10, "A03"), (10, "A04"), (11, "A01"), (11, "A02")] + [(12, c) for c in CELLS], "edge_id int, sample_id string")
    placed = {r.variant_id: r for r in L.placed_table(L.place_variants(df, edges)).collect()}
    assert placed["chr22_37805760_C_G"].edge_id == 10 and placed["chr22_37945173_C_T"].edge_id == 11
    assert placed["chr22_19479987_C_G"].edge_id == 12 and placed["chr22_37024431_C_T"].edge_id == 2
    assert all(r.p_elsewhere < 0.01 for r in placed.values())
