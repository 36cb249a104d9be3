"""From raw documents to packed training sequences, one stage after another.

Every stage is a function of (spark, docs, sf_dir) that returns a DataFrame; ``run``
writes each stage's rows as Parquet into the shared folder and reads them as the next
one's documents. All stages but the last return the columns of ``documents``. Null and
empty texts pass every filter (there is nothing to object to in them); rows without an
id are never taken for a copy; an empty table gives an empty result.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from segmint.llm.common import store, table
from segmint.llm.fm_index import cut_repeats
from segmint.llm.ngram_join import first_of_each, jaccard_components
from segmint.llm.packing import pack_documents
from segmint.llm.pii import find_personal, redact
from segmint.llm.toxicity import drop_toxic, train

#: near-copies share this much of their five-word shingles
SHINGLE, SIMILAR, FINER = 5, (80, 100), 0.25
TOKENIZER = "word_bpe_49k.json"


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the network, trained on the labelled ones, doesn't reject."""
    return drop_toxic(docs, train(docs, table(spark, sf_dir, "labels")))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near-copies."""
    return first_of_each(docs, jaccard_components(docs, SIMILAR, SHINGLE, finer=FINER))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of 20 words or more that start earlier; documents of nothing else go."""
    return cut_repeats(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with every personal span replaced by its kind."""
    return redact(docs, find_personal(docs))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of at most 2048, as pieces of documents with their ids and places."""
    return pack_documents(docs, public_tokenizers.path(TOKENIZER), with_ids=True)


STAGES = [("toxicity", toxicity), ("ngram_jaccard", near_copies), ("substring_dedup", repeated_passages), ("pii", personal_data), ("packing", packing)]

#: training a network and counting by it has no SQL twin; tests compare with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, applied to ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir))
    return docs
