"""The stages of the corpus pipeline; each takes (spark, docs, sf_dir).

All stages but the last return the columns of ``docs``, whatever else those are named. An empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyfold.llm import bpe, mixing, quality, secrets, simhash
from tallyfold.llm.common import Scratch
from tallyfold.llm.queries import SHARES, labelled_languages, spec, table


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject.

    Null and empty texts, missing doc_id and missing n_chars are scored like any other; equal rows stay or go together.
    """
    return quality.accepted(docs, table(spark, sf_dir, "labels"), learn_from=table(spark, sf_dir, "documents"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest doc_id of each SimHash component.

    Null and empty texts are copies of each other. Rows without doc_id stay; rows that share one are one document and stay
    or go together.
    """
    return simhash.one_of_each(docs)


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts masked. Null and empty texts, and texts without secrets, stay as they are."""
    return secrets.redacted(docs)


def mix_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document at least once, and repeated so that expected words by language match the target shares.

    Null and empty texts have no words and keep their one copy; equal rows get the same number of copies.
    """
    return mixing.mixed(docs, labelled_languages(spark, sf_dir), SHARES, least=1.0,
                        texts=table(spark, sf_dir, "documents"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts, digests of the ids and of the text that they decode to, one row per row.

    A null text counts as empty; repeated rows and rows without doc_id are encoded one by one.
    """
    return bpe.digests(docs, spec())


STAGES = [
    ("quality classifier", keep_good),
    ("simhash near-dedup", drop_near_copies),
    ("secret scans", hide_secrets),
    ("mixing to target weights", mix_languages),
    ("bpe encoding and decoding", tokenize),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = scratch.keep(stage(spark, docs, sf_dir), f"stage-{number}")
        if number:
            scratch.drop(f"stage-{number - 1}")
    return docs
