"""A training-corpus pipeline: language ID, near-dedup, PII surrogates, mixing and byte-level BPE, one after another."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandweave.llm import language, minhash_forest, mixing, piece_bpe, surrogates
from strandweave.llm.queries import SURROGATE_KEY
from strandweave.session import shared_dir


def _aside(docs: DataFrame, names: list[str]) -> tuple[DataFrame, list[str]]:
    """``docs`` with columns of these names under ones that cannot clash, and the new names of all columns."""
    new = [f"{c}_{uuid.uuid4().hex}" if c in names else c for c in docs.columns]
    return docs.toDF(*new), new


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a language: no letters, or no language ahead of the others.

    The model learns from text and lang of the stage's own documents whose crc32(doc_id) mod 4 is not 2. A null text goes;
    repeated rows are judged each; an empty table, and one without any lang, gives an empty table.
    """
    model = language.train(docs.where(~language.held_out()).select("doc_id", "text", "lang"))
    rows, names = _aside(docs, ["lang_pred", "score"])
    judged = language.predict(rows, model).where((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= 0.5))
    return judged.select(*names).toDF(*docs.columns)


def minhash(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of least doc_id of each group of near duplicates.

    A doc_id is one document: its rows stay or go together, and a null one goes. Documents without words stay.
    """
    kept = minhash_forest.near_duplicates(docs).where("kept").select(F.col("doc_id").alias("kept_id"))
    return docs.join(kept, docs["doc_id"] == kept["kept_id"], "left_semi")


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data and secrets; n_chars follows the new text. Every row stays, null texts as they are."""
    rows, names = _aside(docs, ["n_entities"])
    new = surrogates.pseudonymise(rows, SURROGATE_KEY)
    size = F.length("text").cast(docs.schema["n_chars"].dataType)
    return new.select(*(size.alias(c) if c == "n_chars" else F.col(c) for c in names)).toDF(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats and drops rows as their rates say, each row by itself, whether its doc_id comes once or often."""
    return mixing.resampled(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per row the number of ids and the digests of the ids and of what they decode to; a null text has no ids."""
    return piece_bpe.digest_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [("language_id", language_id), ("minhash", minhash), ("pii", pii), ("mixing", mix), ("byte_bpe", byte_bpe)]

#: A trained model, MinHash and keyed surrogates have no SQL form; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of documents; each result is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = f"{shared_dir(spark)}/pipeline-{name}-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
