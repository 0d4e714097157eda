"""The corpus pipeline: language ID, near-duplicates, decontamination, mixing, token files.

Each stage takes the documents its predecessor kept, written as Parquet and read again, and returns documents with
the same columns; the last one returns what it reads back from the token files.

Defined cases are those of the operators: null and empty texts have no language and go in the first stage, repeated
rows are near-duplicates of each other, empty tables stay empty, and further columns are carried along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cashtide.llm import langid
from cashtide.llm.common import table
from cashtide.llm.decontaminate import decontaminated
from cashtide.llm.mixing import mixed_documents
from cashtide.llm.queries import tokenizer_path
from cashtide.llm.simhash import one_of_each
from cashtide.llm.tokens import read_tokens, with_crc32, write_tokens
from cashtide.session import scratch_path

#: Texts without letters go, and those that no language claims: the languages share 1.
MIN_LANGUAGE_SCORE = 0.4
#: Near-duplicates differ in so many bits at most, of fingerprints over shingles of so many words.
SHINGLE_WORDS, MAX_BITS = 3, 3


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents in a language learned from the labelled ones among them."""
    net = langid.learn(docs.select("doc_id", "text", "lang"), F.lit(True))
    found = langid.predict(docs, net)
    return found.filter((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= MIN_LANGUAGE_SCORE)).select("row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document, that with the smallest id, of each group of near-duplicates."""
    return one_of_each(docs, shingle_words=SHINGLE_WORDS, max_bits=MAX_BITS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents without a copy of a benchmark item."""
    return decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps each document as often as the mix of its source takes it: not at all, or up to three times."""
    return mixed_documents(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Writes the token files and returns what they hold of each document."""
    path = scratch_path(spark, "tokens")
    write_tokens(docs, path, tokenizer_path())
    return with_crc32(read_tokens(spark, path))


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("mix", mix),
    ("token_ids", token_ids),
]

#: The stages use trained models and hashes that SQL does not have.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
