import pytest
from pyspark.sql import functions as F

#: Names that the operators use inside; a table may have them too.
CLASHING = ["g", "k", "x", "b", "m", "h", "n", "node", "class", "cluster", "word", "size", "slot", "shard", "virtual_slot", "cell", "grp", "piece", "start", "_rank", "_row"]


@pytest.fixture(scope="session")
def documents(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


LONG = " ".join(f"lorem{i % 977} ipsum{i % 31}" for i in range(30_000))


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, white space of several kinds."""
    same = "one two three four five six seven eight nine ten " * 6
    rows = [
        (1, None, "en", "a"), (2, "", "en", "a"), (3, " \t\n\x0b\x0c\r ", None, None), (4, same, "en", None), (4, same, "en", None),
        (5, same, None, "a"), (None, same, "en", "a"), (None, None, None, None), (6, LONG, "en", "b"), (7, LONG + " end", "en", "b"),
        (8, "x", "de", "b"), (9, "x", "de", "b"), (10, "12 34 !!", "de", "b"), (11, "non breaking space é É J̌ <|endoftext|> 你好", "fr", "c"),
        (12, "a b", "fr", "c"), (13, "a b c", "fr", "c"), (14, "A B C", "fr", "c"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    df = df.withColumn("n_chars", F.length("text").cast("long"))
    return df.select("*", *[F.lit(-1).alias(c) for c in CLASHING])
