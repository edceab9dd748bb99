"""Queries on tokens: encoding, decoding and token files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from irspark.llm import bpe, tokens
from irspark.llm.registry import query, table


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query()
def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode and decode every document; no SQL can, so tests compare with the library."""
    docs = table(spark, sf_dir, "documents")
    return bpe.encode_decode(docs, vocabulary_path(), keep=["doc_id"], values=())


@query()
def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the ids of every document and read them back; tests compare with the library."""
    path = tokens.token_path(spark)
    tokens.write_tokens(table(spark, sf_dir, "documents"), path, vocabulary_path(), end_id=1)
    return tokens.read_tokens(spark, path)
