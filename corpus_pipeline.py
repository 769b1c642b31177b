"""From raw documents to packed training sequences: five stages, each over all that the one before it kept.

Every stage is a function of (spark, docs, sf_dir). All but the last return the columns of ``documents``. Between
stages, documents are written to the shared folder and read again.

Rows: a null text is empty and stays null until packing, which reads it as empty; null ids are kept, and rows without an
id are told apart by their texts; rows that repeat id and text are one document from the second stage on; texts may be
of any length; an empty table gives no rows; further columns, of any name, are carried up to packing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from envgrade.llm.common import cut, table
from envgrade.llm.jaccard import first_of_group
from envgrade.llm.packing import pack
from envgrade.llm.pii import redact
from envgrade.llm.suffixes import remove_repeats
from envgrade.llm.toxicity import reject, train


def _counted(docs: DataFrame) -> DataFrame:
    """``n_chars`` of the text as it is now."""
    length = F.char_length("text").cast(docs.schema["n_chars"].dataType)
    return docs.select(*[length.alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Op 9: documents that score 0.5 or more go."""
    return reject(docs, train(docs, table(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Op 10: of each group of near copies, the document with the smallest id stays."""
    return first_of_group(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Op 4: passages of 100 bytes or more that also start earlier go."""
    return _counted(remove_repeats(docs))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Op 5: personal data is replaced by its kind in brackets."""
    return _counted(redact(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Op 8: pieces of documents with their place in sequences of at most 1024 tokens."""
    import public_tokenizers

    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("repeats", cut_repeats),
    ("personal_data", mask_personal_data),
    ("packing", pack_sequences),
]

# Learnt weights and byte-pair ids have no SQL; the tests compare every stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
