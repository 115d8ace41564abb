"""A training corpus from raw documents: quality, language, near-duplicates, repeated passages, packing.

Each stage works on all that the one before kept and is written as Parquet and read again. A row is known by its id and
a hash of all its columns, so rows that share an id are judged each on its own. Nulls, empty tables and repeated rows
are treated as the operators say; rows equal in every column are one document to the near-duplicate stage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from phenoloom.llm import language_id, odd_sketch, packing, quality, queries, substring_dedup
from phenoloom.llm.frames import small, stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Documents whose language has a lower mean probability go, and those without a letter.
LEAST_SCORE = 0.35


def row_key() -> Column:
    return F.struct(F.col("doc_id").alias("doc_id"), F.xxhash64(*COLUMNS).alias("h"))


def without(docs: DataFrame, rejected: DataFrame) -> DataFrame:
    """Rows of ``docs`` (with ``_row``) whose ``_row`` is not among ``rejected``."""
    gone = stored(rejected.select(F.col("_row").alias("_gone")).distinct())
    return docs.join(small(gone), F.col("_row").eqNullSafe(F.col("_gone")), "left_anti").select(*COLUMNS)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = docs.select(*COLUMNS, row_key().alias("_row"))
    return without(rows, quality.judge(rows, key="_row").where("not kept"))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = docs.select(*COLUMNS, row_key().alias("_row"))
    network = language_id.fit(docs.where(queries.learns_from()))
    judged = language_id.predict(rows, network, key="_row")
    return without(rows, judged.where((F.col("lang_pred") == language_id.NO_LANGUAGE) | (F.col("score") < LEAST_SCORE)))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = docs.select(*COLUMNS, row_key().alias("_row"))
    judged = stored(odd_sketch.near_duplicates(rows, key="_row"))
    kept = without(rows, judged.where("not kept"))
    twice = stored(judged.where("kept").groupBy("_row").agg(F.count("*").alias("n")).where("n > 1"))
    if twice.limit(1).count() == 0:
        return kept
    keyed = kept.select("*", row_key().alias("_row"))
    again = keyed.join(small(twice.select(F.col("_row").alias("_twice"))), F.col("_row").eqNullSafe(F.col("_twice")), "left_semi")
    return without(keyed, twice).unionByName(again.dropDuplicates(["_row"]).select(*COLUMNS))


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that lose nothing stay as they are; of the others, the kept words are joined by one space."""
    out = substring_dedup.remove_repeats(docs, carry=("lang", "source", "n_chars"))
    cut = F.col("n_removed") > 0
    text, chars = F.when(cut, F.col("kept_text")).otherwise(F.col("text")), F.when(cut, F.length("kept_text").cast("long")).otherwise(F.col("n_chars"))
    return out.select("doc_id", text.alias("text"), "lang", "source", chars.alias("n_chars"))


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(packing.pieces(docs, queries.tokenizer_json()))


STAGES = [
    ("quality_rules", quality_rules),
    ("language_id", language),
    ("near_dedup", near_dedup),
    ("substring_dedup", passages),
    ("packing", sequences),
]

#: The fitted estimates, the network, shared shingles and the tokenizer are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
