"""A training-data pipeline of five stages over ``documents``.

Each stage takes (spark, docs, sf_dir), works on all that the stage before kept,
and returns the columns of ``documents``; the last returns token ids. Counts as
part of ``chatloom.llm``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from chatloom.llm.bpe import encode_with_digest
from chatloom.llm.common import read_table, stored
from chatloom.llm.decontaminate import without_contaminated
from chatloom.llm.ngram_join import one_of_each
from chatloom.llm.quality import kept_rows, learn_from
from chatloom.llm.queries import VOCABULARY
from chatloom.llm.secrets import redact


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that neither the base rule nor the learned decision list rejects."""
    return kept_rows(docs, learn_from(docs, read_table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the row with the least doc_id."""
    return one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without a passage of ``benchmark``."""
    return without_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, the secrets in their texts replaced by a mark."""
    return redact(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian u32) and digests of ids and decoded text."""
    return encode_with_digest(docs, public_tokenizers.path(VOCABULARY))


STAGES = [
    ("quality_rules", quality),
    ("ngram_jaccard_join", near_duplicates),
    ("benchmark_decontamination", decontamination),
    ("secret_scan", secrets),
    ("bpe_encoding", tokens),
]

#: No SQL: the rules are learned, and secrets and tokens are no SQL matters.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result written to the shared folder and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
