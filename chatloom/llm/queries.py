"""The registered queries of this package and, where SQL can express them, their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from .bpe import round_trip
from .common import read_table
from .decontaminate import ORACLE_SQL as OP9_SQL
from .decontaminate import contamination
from .html_text import extract
from .language import identify, train
from .licenses import license_report
from .ngram_join import ORACLE_SQL as OP1_SQL
from .ngram_join import join_components
from .quality import judged, learn_from
from .secrets import secret_report
from .separators import document_lengths
from .token_files import token_file_digests

VOCABULARY = "byte_bpe_50k.json"
END_OF_TEXT = 50256


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join_components(read_table(spark, sf_dir, "documents"))


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_report(read_table(spark, sf_dir, "documents"))


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_report(read_table(spark, sf_dir, "documents"))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_file_digests(read_table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return judged(docs, learn_from(docs, read_table(spark, sf_dir, "labels")))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_lengths(read_table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY), END_OF_TEXT)


def op7_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(read_table(spark, sf_dir, "pages"))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(read_table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return identify(docs, train(docs))


QUERIES = {
    f.__name__: f
    for f in (
        op1_ngram_jaccard, op2_licenses, op3_secrets, op4_token_files, op5_quality, op6_token_counts, op7_html, op8_bpe,
        op9_decontamination, op10_language,
    )
}
ORACLE_SQL: dict[str, str] = {"op1_ngram_jaccard": OP1_SQL, "op9_decontamination": OP9_SQL}
