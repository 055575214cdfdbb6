"""Training-corpus pipeline over ``documents``: five stages, each written and read again as Parquet.

1. toxicity: documents that the classifier rejects go
2. near duplicates: one document of each class stays
3. secrets: found secrets are masked in the texts; no document goes
4. mixing: documents are repeated or left out so that sources meet their target weights
5. packing: where each token piece of the mixed corpus is placed in training sequences

Each stage works on all rows that the one before kept; all but the last return
the columns of ``documents``.  What a stage does with nulls, empty and very
long texts, repeated rows, empty tables and further columns is in the
docstring of its operator's module.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import binpack, mixing, omh, secrets, toxicity
from millrace.llm.common import importable_on_workers, materialize, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below one half; the classifier learns from the labels of those it is given."""
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels", "doc_id", "toxic"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class: the one with the smallest id."""
    return omh.keep_one(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mark in place of each secret."""
    return secrets.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; the copies are equal rows."""
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row for each piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    import public_tokenizers

    pieces = binpack.cut_pieces(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return binpack.pack(materialize(pieces, "pieces"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near duplicates", drop_near_duplicates),
    ("secrets", mask_secrets),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: A trained classifier and a tokenizer's ids are beyond SQL; the tests compare each stage with brute force.
ORACLE_SQL = None


@importable_on_workers
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the table ``documents`` below ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs
