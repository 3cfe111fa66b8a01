"""From raw documents to token digests: five stages over the `documents` table.

Every stage works on all rows that the one before kept. Between stages the rows are a written table
in the shared work folder, so a lost executor never sends the job back further than one stage.

All stages take whole texts of any length, count a null text as empty, leave every further column as it is
whatever its name, and keep an empty table empty. What nulls, ties and repeated rows give stands with each.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tillwright.llm import bpe, exact_dedup, jaccard, mixing, quality
from tillwright.llm.common import table, written


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it learns from the labels outside its held-out fifth.

    Empty texts share the score of no evidence; repeated rows stay or go together. Without labels of both
    kinds every score is 0.5 and all rows stay.
    """
    return quality.good(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def keep_one_copy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the smallest doc_id.

    Null and empty texts are equal; a null doc_id counts as larger than any other; of rows that repeat
    doc_id and text one stays.
    """
    return exact_dedup.drop_copies(docs)


def keep_one_near_copy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group linked by a Jaccard similarity of 0.8 the row with the smallest doc_id.

    Texts without a word and rows without a doc_id stay; rows that share a doc_id that stays all stay.
    """
    return jaccard.one_of_each(docs)


def draw_mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose tokens meet the targets of source, language and topic.

    A null source or language is a value of its own; texts without a token go where their cell has none; rows
    that share a doc_id share the draw, rows without one draw by their text.
    """
    return mixing.sample_mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of what is left: one row for each row, an empty text has no token."""
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.encode_documents(docs, ranks, public_tokenizers.PATTERN, memo=REMEMBERED)


#: Strings that an encoding task remembers in each generation. Half of the operator's own number: workers of the
#: stages before still hold memory here, while there is time to encode more strings anew.
REMEMBERED = 300_000

STAGES = [
    ("quality classifier", keep_good),
    ("exact dedup", keep_one_copy),
    ("n-gram jaccard join", keep_one_near_copy),
    ("mixing to target weights", draw_mixture),
    ("byte-level bpe", encode),
]

#: A trained classifier and a sampled join of sets: SQL cannot express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
