"""Registered queries of the tokenizer operators. SQL has no tokenizers: tests compare the library."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.llm import bpe, token_files
from carelake.llm.common import table
from carelake.session import fresh_path


def vocabulary(name: str) -> str:
    """A public vocabulary file; the same installed place on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def token_digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens and digests of the ids and of the decoded text."""
    done = bpe.round_trip(docs, path)
    return done.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


#: the id that ends a document
END_ID = 1


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "token-files")
    token_files.write(table(spark, sf_dir, "documents"), path, vocabulary("word_bpe_49k.json"), END_ID)
    return token_files.checksums(spark, path)


QUERIES = {"op5_bpe": op5_bpe, "op8_token_files": op8_token_files}
