"""A training-data pipeline over `documents`: each stage works on all that the one before it kept.

Null texts are empty texts to every stage, null ids and null sources are values of their own, repeated rows are rows of
their own until the near-duplicates stage keeps one of them, whole texts count however long they are, and no documents
give no rows. Columns beside those of documents are carried along by all stages but the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quern.llm import mixing, packing, secrets, simhash, toxicity
from quern.llm.common import fold_of, table
from quern.llm.queries import tokenizer_path
from quern.session import stage


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model, learnt from labels of the whole table, doesn't take for toxic.

    Empty texts are judged like others; without labels of either kind nothing is rejected.
    """
    model = toxicity.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), fold_of("doc_id", 5) != 0)
    return toxicity.keep_clean(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, found with the settings of the operator's own query.

    The document with the smallest id stays, and one row of it; documents without words form one group. Of a group of null
    ids alone one row stays.
    """
    return simhash.keep_first(docs, words=4, errors=4, seed=42)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with its secrets replaced and `n_chars` as they are then; null texts stay null."""
    return secrets.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their sources' weights ask for: not at all, once or twice.

    A document without words adds nothing to a source; rows of one id are taken equally often.
    """
    return mixing.repeat(docs, mixing.mix(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in sequences of 4096 tokens; an empty text is its end id alone."""
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("near duplicates", drop_near_duplicates),
    ("secrets", redact_secrets),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: No SQL expresses the stages; tests hold them against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; what one returns is written as Parquet and read again for the next."""
    docs = table(spark, sf_dir, "documents")
    for name, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
