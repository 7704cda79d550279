"""Logical tables built from the driver's tables, with the same views as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten chats of timed messages; a message quotes the latest of its sender with the same text."""
    e = table(spark, sf_dir, "events").select(
        (F.col("user_id") % 10).alias("chat_id"), F.col("event_id").alias("id"), "ts", F.col("user_id").alias("sender"),
        F.col("event_type").alias("content"), "value",
    )
    order = Window.partitionBy("chat_id").orderBy("ts", "id")
    return e.withColumn("idx", (F.row_number().over(order) - 1).cast("bigint"))


MSG = """msg AS (
  SELECT user_id % 10 AS chat_id, event_id AS id, ts, user_id AS sender, event_type AS content, value,
    row_number() OVER (PARTITION BY user_id % 10 ORDER BY ts, event_id) - 1 AS idx FROM events)"""


def conversation_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("thread_id"), F.col("turn").alias("idx"), F.col("role").alias("sender"), F.col("text").alias("content")
    )


CONV = "conv AS (SELECT conv_id AS thread_id, turn AS idx, role AS sender, text AS content FROM conversations)"


def claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as claims: language and source are topics, quality is the stance."""
    labels = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    return table(spark, sf_dir, "documents").join(labels, "doc_id", "left").select(
        F.col("doc_id").alias("claim_id"), F.col("text").alias("claim_text"), F.array("lang", "source").alias("topics"), "lang", "source",
        F.when(F.col("quality") == 1, "positive").when(F.col("quality") == 0, "negative").otherwise("neutral").alias("stance"),
        F.concat(F.lit("2024-"), F.lpad((F.col("doc_id") % 12 + 1).cast("string"), 2, "0")).alias("month"),
        (F.col("n_chars") % 7 + 1).alias("support_count"), (F.col("doc_id") % 50).alias("thread_id"),
    )


CLM = """q AS (SELECT doc_id, max(quality) AS quality FROM labels GROUP BY doc_id),
clm AS (
  SELECT d.doc_id AS claim_id, d.text AS claim_text, d.lang, d.source, CASE q.quality WHEN 1 THEN 'positive' WHEN 0 THEN 'negative' ELSE 'neutral' END AS stance,
    '2024-' || lpad(CAST(d.doc_id % 12 + 1 AS VARCHAR), 2, '0') AS month, d.n_chars % 7 + 1 AS support_count, d.doc_id % 50 AS thread_id
  FROM documents d LEFT JOIN q ON q.doc_id = d.doc_id)"""


def votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as votes of customers on a part in a year."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate", "l_linestatus", "l_returnflag")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("l_partkey").alias("part"), F.year("l_shipdate").cast("bigint").alias("yr"), F.col("o_custkey").alias("user"),
        F.when(F.col("l_linenumber") % 4 == 3, "opposing").when(F.col("l_linestatus") == "F", "statement").otherwise("reaction").alias("role"),
        F.when(F.col("l_returnflag") == "A", "positive").when(F.col("l_returnflag") == "R", "negative").otherwise("neutral").alias("sentiment"),
        F.date_format("l_shipdate", "yyyy-MM").alias("month"), F.col("l_orderkey").alias("claim"),
    )


SUP = """sup AS (
  SELECT l_partkey AS part, CAST(year(l_shipdate) AS BIGINT) AS yr, o_custkey AS usr, CASE WHEN l_linenumber % 4 = 3 THEN 'opposing' WHEN l_linestatus = 'F' THEN 'statement' ELSE 'reaction' END AS role,
    CASE l_returnflag WHEN 'A' THEN 'positive' WHEN 'R' THEN 'negative' ELSE 'neutral' END AS sentiment, strftime(l_shipdate, '%Y-%m') AS month, l_orderkey AS claim
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""
PEOPLE = """people AS (
  SELECT {k}, usr, bool_or(role = 'statement') AS author, bool_or(role = 'opposing') AS against, bool_or(role = 'reaction' AND sentiment = 'positive') AS likes,
    bool_or(role = 'reaction' AND sentiment = 'negative') AS dislikes FROM {t} GROUP BY {k}, usr),
sums AS (
  SELECT {k}, CAST(greatest(1, count(*) FILTER (author OR likes)) AS BIGINT) AS support_count, count(*) FILTER (against OR dislikes) AS opposer_count,
    count(*) FILTER (likes AND NOT author) AS reaction_only_count, count(*) FILTER (likes) AS reaction_endorser_count, count(*) FILTER (author) AS author_count
  FROM people GROUP BY {k})"""


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id"), F.col("label"), F.col("embedding"))


VEC = """unit AS (
  SELECT vec_id, label, list_transform(v, lambda x: x / n) AS u
  FROM (SELECT vec_id, label, v, sqrt(list_sum(list_transform(v, lambda x: x * x))) AS n FROM (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)))"""
