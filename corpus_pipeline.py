"""From raw documents to tokens: each stage works on all rows that the one before has kept."""

from __future__ import annotations

from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from quillvault.llm.bpe import encode_documents
from quillvault.llm.decontaminate import without_benchmark
from quillvault.llm.pii import mask_personal_data
from quillvault.llm.quality import keep_good
from quillvault.llm.simhash import one_of_each
from quillvault.llm.tables import read, session_for_texts, staged


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return keep_good(docs, read(spark, sf_dir, "labels"))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-copies."""
    return one_of_each(docs)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage."""
    return without_benchmark(docs, read(spark, sf_dir, "benchmark"))


def masked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind."""
    return mask_personal_data(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the texts that are left (``doc_id, n_tokens, ids, decoded``)."""
    return encode_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


def _stage(function):
    """The stage in a session whose Arrow batches suit whole texts."""

    @wraps(function)
    def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        return function(session_for_texts(spark), docs, sf_dir)

    return stage


STAGES = [
    ("quality", _stage(good)),
    ("simhash", _stage(distinct)),
    ("decontamination", _stage(clean)),
    ("personal_data", _stage(masked)),
    ("bpe_encoding", _stage(encoded)),
]

#: Learned scores, hashes of shingles and token ids have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over ``documents``."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
