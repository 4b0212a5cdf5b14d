"""Documents to training tokens: reject poor ones, keep one of each near-duplicate class, drop leaks of the
benchmark, mix the sources to their weights, write token shards.

Each stage takes (spark, docs, sf_dir), works on all that the stage before kept, and is written as Parquet
and read again. Stages hand on the columns of ``documents``; the mix hands on the order of the rows in its
files, which is the order the shards are written in; the last returns a row per document written.
Stages keep rows whose doc_id is null or repeated unless a rule of theirs rejects the text.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from somaloom.llm.common import fresh_folder, table
from somaloom.llm.decontaminate import without_leaks
from somaloom.llm.mixing import in_mixed_order
from somaloom.llm.near_dedup import keep_one_of_each
from somaloom.llm.quality import good_documents
from somaloom.llm.queries import END_ID, TOKENIZER
from somaloom.llm.tokens import token_output

ORACLE_SQL = None  # a trained classifier, components and a tokenizer: tested against brute force instead


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return good_documents(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return in_mixed_order(docs)


def in_file_order(docs: DataFrame) -> tuple[DataFrame, list[str]]:
    """(doc_id, text and order columns) by the place of the rows in their files; by doc_id if not read from files."""
    own = [F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")]
    try:
        return docs.select(*own, F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1).cast("long").alias("part"),
                           F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row")), ["part", "file", "row"]
    except AnalysisException:
        return docs.select(*own, F.xxhash64("text").alias("tie")), ["doc_id", "tie"]


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows, order = in_file_order(docs)
    return token_output(rows, TOKENIZER, END_ID, order)


STAGES = [("quality classifier", quality), ("MinHash near-dedup", near_duplicates), ("benchmark decontamination", decontamination),
          ("mixing sources to target weights", mixing), ("token-ID output", tokens)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = fresh_folder(spark, "pipeline")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return docs
