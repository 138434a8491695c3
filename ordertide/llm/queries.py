"""The registered queries of this package: each applies its operator to the whole of its tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, codes, decontaminate, hosts, interactions, language, lm, near, search, shards, sql, store, substrings, suffixes, toxicity


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _fold(of: int) -> Column:
    """crc32 of the id as text, modulo ``of``; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % of


def op1_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.matches(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))
    return found.drop("items", "spans")


def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    network = toxicity.learn(toxicity.labelled(docs, _table(spark, folder, "labels"), _fold(3) != 1))
    scored = toxicity.score(docs.withColumn("held_out", _fold(3) == 1), network, columns=("doc_id", "held_out"))
    return scored.withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


def op3_bpe(spark: SparkSession, folder: str) -> DataFrame:
    decoded = bpe.decode(bpe.encode(_table(spark, folder, "documents")))
    return decoded.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op4_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").withColumn("held_out", _fold(10) == 0)
    model, rare = lm.learn(docs, ~F.col("held_out"))
    return lm.score(docs, model, rare, columns=("doc_id", "held_out"))


def op5_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = substrings.deduplicate(_table(spark, folder, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op6_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = suffixes.deduplicate(_table(spark, folder, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op7_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").withColumn("held_out", _fold(4) == 2)
    model = language.learn(language.training_sample(docs, ~F.col("held_out")))
    return language.identify(docs, model, columns=("doc_id", "held_out")).drop("bits_per_byte")


def op8_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near.components_of(_table(spark, folder, "documents"))


#: Fixed values of the contract.
RULES = [
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
]


def op9_host_reputation(spark: SparkSession, folder: str) -> DataFrame:
    judged = hosts.judge(_table(spark, folder, "pages").select("page_id", "url"), RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op10_topk_search(spark: SparkSession, folder: str) -> DataFrame:
    return search.top_k(_table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


def op11_filter_interactions(spark: SparkSession, folder: str) -> DataFrame:
    return interactions.audit(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op12_sharding(spark: SparkSession, folder: str) -> DataFrame:
    assigned = shards.assign(_table(spark, folder, "documents"), 16)
    return assigned.withColumns({"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")})


def op13_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    encoded = codes.encode_values(_table(spark, folder, "embeddings"))
    codebooks = codes.learn(encoded)
    coded = codes.with_label_error(store.written(codes.assign(encoded, codebooks), "codes"))
    return coded.drop("label").withColumn("codebooks_sha256", F.lit(codebooks.digest))


def queries() -> dict:
    return {
        "op1_decontamination": op1_decontamination,
        "op2_toxicity": op2_toxicity,
        "op3_bpe": op3_bpe,
        "op4_lm_scoring": op4_lm_scoring,
        "op5_substring_dedup": op5_substring_dedup,
        "op6_suffix_dedup": op6_suffix_dedup,
        "op7_language_id": op7_language_id,
        "op8_minhash_near_dedup": op8_minhash_near_dedup,
        "op9_host_reputation": op9_host_reputation,
        "op10_topk_search": op10_topk_search,
        "op11_filter_interactions": op11_filter_interactions,
        "op12_sharding": op12_sharding,
        "op13_vector_codes": op13_vector_codes,
    }


def oracle_sql() -> dict[str, str]:
    """Models, merges and byte strings have none; their queries are tested against brute force."""
    return {
        "op1_decontamination": sql.DECONTAMINATION,
        "op5_substring_dedup": sql.SUBSTRINGS,
        "op8_minhash_near_dedup": sql.NEAR,
        "op9_host_reputation": sql.hosts(RULES, hosts.Z, hosts.THRESHOLD),
        "op10_topk_search": sql.TOP_K,
        "op11_filter_interactions": sql.INTERACTIONS,
        "op12_sharding": sql.SHARDS,
        "op13_vector_codes": sql.vector_codes(),
    }
