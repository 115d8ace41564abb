"""One thin query per operator over its whole table; the operators keep their own interfaces."""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from phenoloom.llm import (
    contamination, embed_dedup, language_id, lm_scoring, merkle, odd_sketch, packing, periodic_runs, piece_lattice, quality, sharding, sql, substring_dedup,
    url_templates,
)
from phenoloom.llm.frames import stored
from phenoloom.llm.registry import query
from phenoloom.session import shared_folder

SHARDS = 24
URL_RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_json() -> str:
    import public_tokenizers

    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        return f.read()


@query("op1_best_fit_packing")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(packing.pieces(table(spark, sf_dir, "documents"), tokenizer_json()))


@query("op2_sharding")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    import uuid

    text = F.coalesce("text", F.lit(""))
    docs = table(spark, sf_dir, "documents").select("doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    records = stored(docs.withColumn("virtual_slot", sharding.virtual_slot("doc_id", "text_crc32")))
    weights = stored(sharding.slot_bytes(records))
    path = f"{shared_folder(spark)}/slot-map-{uuid.uuid4().hex}"
    sharding.write_version(sharding.first_map(spark, SHARDS), path)
    sharding.write_version(sharding.rebalance(sharding.read_version(spark, path, 1), weights, SHARDS), path)
    out = sharding.placed(records, sharding.read_version(spark, path), weights, ["doc_id", "text_crc32", "size"])
    return out.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "virtual_slot"
    )


@query("op7_url_templates")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_templates.judge(table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES)


@query("op4_substring_dedup", sql.SUBSTRING_DEDUP)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    digest = F.sha2(F.coalesce("kept_text", F.lit("")), 256)
    return out.select("doc_id", "n_words", "n_removed", digest.alias("kept_sha256"))


@query("op5_quality_rules")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.judge(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance")


@query("op10_odd_sketch", sql.NEAR_DEDUP)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return odd_sketch.near_duplicates(table(spark, sf_dir, "documents"))


def learns_from(key: str = "doc_id"):
    """Rows that may be learned from; the others, where the remainder is 2, are held out."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 4 != 2, F.lit(False))


@query("op9_language_id")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    network = language_id.fit(docs.where(learns_from()))
    out = language_id.predict(docs, network)
    return out.select("doc_id", F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")


@query("op8_inverted_multi_index", sql.VECTORS)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


@query("op6_lm_scoring")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.train_and_score(table(spark, sf_dir, "documents"))


@query("op3_piece_lattice")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    model = piece_lattice.pieces(spark, public_tokenizers.path("piece_bpe_32k.model"))
    encoded = piece_lattice.encode_documents(table(spark, sf_dir, "documents"), model, merges=True)
    # the ids go along with their text, so that nothing is joined; documents without an id of their own have no place in a join either
    decoded = piece_lattice.decode(encoded.where("doc_id is not null"), model, ["doc_id", "ids"])
    out = decoded.select("doc_id", "ids", F.sha2(piece_lattice.unmarked(F.col("decoded")), 256).alias("sha"))
    out = out.unionByName(encoded.where("size(ids) = 0").withColumn("sha", F.sha2(F.lit(""), 256)))
    return out.select("doc_id", F.size("ids").alias("n_pieces"), "ids", F.col("sha").alias("decoded_sha256"))


def cycled(doc_id: int | None, n: int) -> tuple[int, int] | None:
    """One document in ten is cycled from a word on: where, and after how many words, follow from its id and length."""
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10:
        return None
    g = h // 10
    a = g % n
    return a, 1 + (n - a) // (3 + g % 8)


@query("op11_periodic_runs", sql.PERIODIC_RUNS)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = periodic_runs.find_runs(table(spark, sf_dir, "documents"), tail=cycled)
    # the greatest length, then the smallest start, then the smallest period
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    text = F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise("")
    return out.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.s")).alias("start"), F.col("best.length").alias("length"), (-F.col("best.p")).alias("period"),
        F.floor(1000 * F.col("best.length") / -F.col("best.p")).alias("exponent_milli"), F.sha2(text, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query("op12_suffix_automaton", sql.CONTAMINATION)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = contamination.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated")
    )


@query("op13_octopus_manifest", sql.MANIFEST)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    altered = F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, merkle.leaf_digest(*fields, lowered))
    out = merkle.manifest(table(spark, sf_dir, "documents"), "doc_id", "lang", merkle.leaf_digest(*fields, F.col("text")), altered)
    return out.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
