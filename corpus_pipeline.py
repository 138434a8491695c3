"""Corpus preparation: language, near duplicates, repeated passages, benchmark passages, tokens.

A stage is (spark, docs, sf_dir) -> DataFrame; its result is written as Parquet and read
again as the next one's documents. All but the last return the columns of documents and
decide by the documents that reach them. A document without an id is kept by every stage.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordertide.llm import bpe, decontaminate, language, near, store, substrings

#: No SQL: the first stage's model and the last one's merges cannot be expressed in it.
ORACLE_SQL = None


def _numbered(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The documents with columns c0, c1, ..., so that no extra column clashes with an operator's; and the names."""
    names = {name: f"c{i}" for i, name in enumerate(docs.columns)}
    return docs.toDF(*names.values()), names


#: Bits per byte at which a text is no better coded by any known language than its bytes are as they stand.
PLAIN_BITS = 8.0


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in no known language go: those without any letter, and those that the best
    language's contexts code in no fewer than eight bits a byte. All labelled rows may teach;
    where none does, only documents without letters go."""
    model = language.learn(language.training_sample(docs, F.lit(True)))
    if not model.languages:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    own, names = _numbered(docs)
    found = language.identify(own, model, text_column=names["text"], columns=tuple(own.columns))
    known = (F.col("lang_pred") != language.UNKNOWN) & (F.col("bits_per_byte") < PLAIN_BITS)
    return found.where(known).select(*own.columns).toDF(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near duplicates its smallest id stays; rows that repeat it go as well."""
    kept = near.components_of(docs).where("kept").select("doc_id").distinct()
    unnamed = docs.where(F.col("doc_id").isNull())
    named = docs.join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return named.select(*docs.columns).unionByName(unnamed)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more that an earlier document has are cut; other texts stay as they are.

    A cut text is its kept words joined by one space, and n_chars follows. A document of which
    nothing is left stays as an empty text.
    """
    own, names = _numbered(docs)
    found = substrings.deduplicate(own, tuple(own.columns), names["doc_id"], names["text"])
    cut = F.col("n_removed") > 0
    found = found.withColumn(names["text"], F.when(cut, F.col("kept")).otherwise(F.col(names["text"])))
    if "n_chars" in names:
        length = F.when(cut, F.length(names["text"])).otherwise(F.col(names["n_chars"]))
        found = found.withColumn(names["n_chars"], length.cast(docs.schema["n_chars"].dataType))
    return found.select(*own.columns).toDF(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold ten consecutive words of a benchmark item go."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.clean(docs, benchmark)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian unsigned 32 bits), and the digest of the bytes they decode to."""
    decoded = bpe.decode(bpe.encode(docs))
    return decoded.select("doc_id", "n_tokens", "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("decontamination", decontamination),
    ("tokens", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's result; every stage's is written to the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{store.shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
