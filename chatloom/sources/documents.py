"""Readers of the documents that stages leave for one another, each as a table in the order of its entries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .artifacts import _fs, exists, read_envelope

REACTIONS = "array<struct<emoji:string,senders:array<string>>>"
REDACTIONS = "array<struct<type:string,value:string>>"
CLAIM = (
    "claim_id string, thread_id string, claim_text string, topic_tags array<string>, entities array<string>, stance string, date string, "
    f"support_count int, opposer_count int, _redactions {REDACTIONS}, _pii_review string"
)
THREAD = f"thread_id string, start_time string, last_time string, num_messages int, num_unique_senders int, message_ids array<bigint>, messages array<struct<sender:string,datetime:string,content:string,reactions:{REACTIONS}>>"
CLASS = "thread_id string, passed_heuristic boolean, is_knowledge_bearing boolean, topic_tags array<string>, emergent_tags array<string>, entities array<string>, reason string"
AUDIT = (
    "claim_id string, supporting_senders array<string>, opposing_senders array<string>, "
    f"message_reactions array<struct<local_message_id:int,reactions:{REACTIONS}>>, all_supporters array<string>, reaction_senders array<string>, reaction_opposers array<string>"
)
GROUP = "id string, representative string, claim_ids array<string>"
PAGE = "id string, title string, category string, source_tags array<string>, rationale string, search_focus string"
LINK = "`from` string, `to` string, reason string"
SEED = "id string, canonical string, aliases array<string>, topics array<string>, type string"


def read_threads(spark: SparkSession, path: str) -> DataFrame:
    return read_envelope(spark, path, "threads", THREAD)


def thread_messages(threads: DataFrame) -> DataFrame:
    """(thread_id, idx, message_id, sender, ts, content, reactions) of threads' messages."""
    rows = threads.select("thread_id", "message_ids", F.posexplode("messages").alias("idx", "m"))
    return rows.select(
        "thread_id", "idx", F.get("message_ids", F.col("idx")).alias("message_id"), "m.sender", F.try_to_timestamp("m.datetime").cast("timestamp_ntz").alias("ts"), "m.content",
        F.coalesce("m.reactions", F.array().cast(REACTIONS)).alias("reactions"),
    )


def read_classified(spark: SparkSession, path: str) -> DataFrame:
    return read_envelope(spark, path, "threads", CLASS)


def read_claims(spark: SparkSession, path: str) -> DataFrame:
    """Claims with topics and redactions under the names that the operators take."""
    rows = read_envelope(spark, path, "claims", CLAIM)
    return rows.withColumnsRenamed({"topic_tags": "topics", "_redactions": "redactions", "_pii_review": "pii_review"})


def claims_with_originals(spark: SparkSession, path: str, original: str) -> tuple[DataFrame, DataFrame | None]:
    """Claims, and those of the original document if ``path`` is another and it is there."""
    claims = read_claims(spark, path)
    return claims, read_claims(spark, original) if path != original and exists(spark, original) else None


def read_audit(spark: SparkSession, path: str) -> DataFrame:
    """Audit rows by claim, the last of each; none where there is no such document. A row without
    ``message_reactions`` is of the older kind; of others the reactions of all messages come in one list."""
    if not exists(spark, path):
        rows = spark.createDataFrame([], f"ord int, {AUDIT}")
    else:
        rows = read_envelope(spark, path, "audit", AUDIT)
    last = rows.groupBy("claim_id").agg(F.max_by(F.struct(*[c for c in rows.columns if c not in ("ord", "claim_id")]), "ord").alias("r")).select("claim_id", "r.*")
    flat = F.flatten(F.transform("message_reactions", lambda m: F.coalesce(m["reactions"], F.array().cast(REACTIONS))))
    return last.withColumn("message_reactions", F.when(F.col("message_reactions").isNotNull(), flat))


def _entries(spark: SparkSession, path: str, field: str, schema: str) -> DataFrame:
    """The entries of a document, none where it is not there."""
    return read_envelope(spark, path, field, schema) if exists(spark, path) else spark.createDataFrame([], f"ord int, {schema}")


def read_groups(spark: SparkSession, path: str) -> DataFrame:
    """Manual groups (group_id, representative, claim_ids)."""
    return _entries(spark, path, "aggregations", GROUP).withColumnRenamed("id", "group_id")


def read_deleted(spark: SparkSession, path: str) -> DataFrame:
    """(claim_id) of claims that reviewers deleted."""
    if not exists(spark, path):
        return spark.createDataFrame([], "claim_id string")
    return spark.read.schema("deleted_claims array<string>").json(path, multiLine=True).select(F.explode("deleted_claims").alias("claim_id")).distinct()


def read_seeds(spark: SparkSession, path: str) -> DataFrame:
    """Seed names (ord, seed_id, canonical, aliases, topics, type)."""
    return _entries(spark, path, "entities", SEED).withColumnRenamed("id", "seed_id")


def read_plan(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Pages (ord, page_id, ...) and links (ord, src, dst, reason) of a plan; empty where there is none."""
    pages = _entries(spark, path, "pages", PAGE).withColumnRenamed("id", "page_id")
    return pages, _entries(spark, path, "links", LINK).withColumnsRenamed({"from": "src", "to": "dst"})


def seed_pages(pages: DataFrame, catalog: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pages of a plan, or of the topic catalog (topic, ord, title, category) if the plan has none, and (tag, page_id), the first page of each tag."""
    # no rows or one
    empty = pages.agg(F.count(F.lit(1)).alias("_n")).where("_n = 0")
    made = catalog.join(F.broadcast(empty)).select(F.col("topic").alias("page_id"), "ord", "title", "category", F.array("topic").alias("source_tags"))
    rows = pages.select("page_id", "ord", "title", "category", "source_tags").unionByName(made)
    tags = rows.select("page_id", "ord", F.explode("source_tags").alias("tag"))
    return rows, tags.groupBy("tag").agg(F.min_by("page_id", "ord").alias("page_id"))


def write_json(df: DataFrame, path: str, field: str, order: str = "ord") -> None:
    """One JSON document that holds the rows in ``field``, in order: what the readers here take. For catalogs that fit a document."""
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns if c != order])
    rows = F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), row.alias("r")))), lambda x: x["r"])
    df.agg(rows.alias(field)).coalesce(1).write.mode("overwrite").json(path)


def copy_files(spark: SparkSession, source: str, target: str, suffix: str = ".md") -> int:
    """Copy the files of a folder that end in ``suffix`` and are not there yet; how many. Catalogs of pages only, on the driver."""
    fs, p = _fs(spark, source)
    to_fs, to = _fs(spark, target)
    to_fs.mkdirs(to)
    jvm, n = spark.sparkContext._jvm, 0
    for status in fs.listStatus(p):
        name = status.getPath().getName()
        there = jvm.org.apache.hadoop.fs.Path(to, name)
        if name.endswith(suffix) and not to_fs.exists(there):
            jvm.org.apache.hadoop.fs.FileUtil.copy(fs, status.getPath(), to_fs, there, False, spark.sparkContext._jsc.hadoopConfiguration())
            n += 1
    return n


# -- kept tables ---------------------------------------------------------------------
def signature(df: DataFrame, *columns: str) -> str:
    """The same for tables of the same rows in any order; repeated rows count."""
    names = columns or tuple(df.columns)
    row = df.select(F.xxhash64(*names).cast("decimal(38,0)").alias("h")).agg(F.count(F.lit(1)).alias("n"), F.sum("h").alias("s")).first()
    return f"{row.n}:{row.s}"


def ensure_table(spark: SparkSession, path: str, meta: dict[str, str], build: Callable[[], DataFrame]) -> DataFrame:
    """The table at ``path``, built anew unless it was made from the same ``meta``.

    The note of what it was made from is written last, so a table that was not finished is built again.
    """
    table, note = f"{path.rstrip('/')}/table", f"{path.rstrip('/')}/meta"
    want = sorted((k, str(v)) for k, v in meta.items())
    if exists(spark, note):
        if sorted((r.key, r.value) for r in spark.read.schema("key string, value string").json(note).collect()) == want:
            return spark.read.parquet(table)
        fs, p = _fs(spark, note)
        fs.delete(p, True)
    build().write.mode("overwrite").parquet(table)
    spark.createDataFrame(want, "key string, value string").coalesce(1).write.mode("overwrite").json(note)
    return spark.read.parquet(table)


