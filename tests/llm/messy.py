"""Small awkward inputs that every operator must take."""

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, n string, bucket string, label string, score string, size string, s string, ids string, tie string, f string, y string, p string"
LONG = "lorem ipsum dolor sit amet " * 20_000


def rows() -> list[tuple]:
    base = "the quick brown fox jumps over the lazy dog and runs away from here to there every single day of the year"
    texts = [
        (1, base), (2, base), (2, base), (3, base + " now"), (4, None), (5, ""), (6, "   \n\t "), (7, "one"), (8, "one"), (None, base), (None, None),
        (9, LONG), (10, LONG + "end"), (11, "Grüße aus Köln — naïve café \U0001f600 é İx don't stop, 12 34 <|endoftext|> <|ENDOFTEXT|> a<|EndOfText|>.b <|STARTOFTEXT|><|startoftext|> ½"), (12, "a\x00b\x1cc d e"), (13, "GNU General\npublic-license; MIT license")]
    return [(i, t, None if k % 3 == 0 else "en", None if k % 4 == 0 else f"src{k % 2}", None if k % 5 == 0 else len(t or ""), *["x"] * 12) for k, (i, t) in enumerate(texts)]


def messy(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(rows(), SCHEMA).repartition(3)


def empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)


def labels(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(1, 1, 0), (1, 0, 0), (7, 0, 1), (9, 1, None), (None, 1, 0), (3, None, 0), (8, 0, 0), (10, 1, 0), (5, 0, 0), (2, 1, 0)], "doc_id long, quality int, toxic int")
