"""A corpus from raw documents to packed sequences, one operator per stage.

A stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and reread as the next one's docs. All but
the last return the columns of ``documents``. What each does with nulls, ties, repeated rows and empty tables is what its
operator's module states; columns beside doc_id, text, lang and source are carried along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shoplane.llm import mixing, packing, quality, secretscan, simhash
from shoplane.llm.common import stored, table
from shoplane.llm.queries import tokenizer_path


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_of_each(docs, size=4, distance=4)


def take_out_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secretscan.redact(docs, secretscan.fit(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs, weights=(1.0, 2.0, 3.0), share=1.0, most=3.0)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, tokenizer_path(), capacity=4096, end_id=1, cache_words=CACHE_WORDS)


#: Words an encoder keeps: its worker stays beside the stages of a run that follows, whose texts need the memory.
CACHE_WORDS = 200_000

STAGES = [
    ("quality rules", keep_good),
    ("simhash near-dedup", drop_near_copies),
    ("secret scan", take_out_secrets),
    ("source mixing", mix_sources),
    ("best-fit packing", pack_sequences),
]

#: Fingerprints, Markov models, the cube method and tokenizers are not expressible in SQL; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole pipeline over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
