"""Readers of chat exports: text in two formats, and a phone's JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as T

_HEAD = f"^{T.MARKS}*\\[(\\d{{1,2}}/\\d{{1,2}}/\\d{{2,4}}),\\s+(\\d{{1,2}}:\\d{{2}}:\\d{{2}}[\\u202f\\s]+(?:AM|PM))\\]"
NEW_HEADER = f"(?i){_HEAD}\\s+(.*?):\\s*(.*)$"
NEW_TIME = f"(?i){_HEAD}"
OLD_HEADER = f"^{T.MARKS}*(\\d{{1,2}}/\\d{{1,2}}/\\d{{2,4}}), (\\d{{1,2}}:\\d{{2}}) - (.*)$"


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """file, line_no and text of every line.

    Files are read in blocks by all tasks; a block's place in its file and a line's place in its
    block number the lines, which are then put in order by file, as they depend on those before.
    """
    rows = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"), F.col("value").alias("text")
    )
    order = Window.partitionBy("file").orderBy("block", "at")
    return rows.select("file", (F.row_number().over(order) - 1).alias("line_no"), "text")


def parse_new_format(lines: DataFrame, correct_pm: bool = True) -> DataFrame:
    """Messages of the new format; see ``assemble``."""
    part = lambda i: F.regexp_extract("text", NEW_HEADER, i)
    rows = lines.withColumns({
        "is_head": F.col("text").rlike(NEW_HEADER), "ts": T.parse_new_time(part(1), part(2), correct_pm),
        "sender": T.clean_text(part(3)), "body": T.normalize_content(part(4)),
    })
    return assemble(rows.withColumn("is_kept", F.col("is_head") & ~T.is_system(F.col("body"))))


def parse_old_format(lines: DataFrame, cutoff: str | None = None) -> DataFrame:
    """Messages of the old format before ``cutoff``. Later ones, and lines that continue
    them, are left out."""
    rest = F.regexp_extract("text", OLD_HEADER, 3)
    at = F.locate(": ", rest)
    rows = lines.withColumns({
        "is_head": F.col("text").rlike(OLD_HEADER),
        "ts": T.parse_old_time(F.regexp_extract("text", OLD_HEADER, 1), F.regexp_extract("text", OLD_HEADER, 2)),
        "sender": T.clean_text(F.when(at > 0, F.substring(rest, F.lit(1), at - 1))),
        "body": T.normalize_content(F.when(at > 0, F.substring(rest, at + 2, F.length(rest))).otherwise("")),
    })
    late = F.col("ts") >= F.lit(cutoff).cast("timestamp_ntz") if cutoff else F.lit(False)
    rows = rows.withColumn("is_late", F.col("is_head") & F.coalesce(late, F.lit(False)))
    rows = rows.withColumn("is_kept", F.col("is_head") & ~F.col("is_late") & F.col("sender").isNotNull() & ~T.is_system(F.col("body"), True))
    return assemble(rows)


def assemble(rows: DataFrame) -> DataFrame:
    """Messages (file, idx, ts, sender, content) of marked lines.

    A line without a header goes to the kept line before. A kept line joins the one
    before if it has the same sender and comes less than two minutes after it.
    Lines between a late header and the next one are left out.
    """
    if "is_late" not in rows.columns:
        rows = rows.withColumn("is_late", F.lit(False))
    order = Window.partitionBy("file").orderBy("line_no")
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("after_late", F.coalesce(F.last(F.when(F.col("is_head"), F.col("is_late")), True).over(so_far), F.lit(False)))
    kept = rows.where("is_kept or (not is_head and not after_late)").withColumn("n_kept", F.sum(F.col("is_kept").cast("int")).over(so_far))
    kept = kept.where("n_kept > 0").withColumn("line", F.when(F.col("is_kept"), F.col("body")).otherwise(T.normalize_content(F.col("text"))))
    heads = kept.where("is_kept").withColumn("seconds", F.unix_micros(F.col("ts").cast("timestamp")) / 1e6)
    joins = (F.lag("sender").over(order) == F.col("sender")) & (F.col("seconds") - F.lag("seconds").over(order) < 120)
    heads = heads.withColumn("idx", F.sum((~F.coalesce(joins, F.lit(False))).cast("int")).over(so_far) - 1)
    owner = heads.select("file", "n_kept", "idx")
    lines = kept.join(owner, ["file", "n_kept"])
    first = lambda c: F.min_by(c, "line_no")
    return lines.groupBy("file", "idx").agg(
        first(F.when(F.col("is_kept"), F.col("ts"))).alias("ts"), first("sender").alias("sender"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "line"))), lambda x: x["line"]), "\n").alias("content"),
    )


def oldest_time(lines: DataFrame) -> DataFrame:
    """The least header time of the new format, by file."""
    heads = lines.where(F.col("text").rlike(NEW_TIME))
    return heads.groupBy("file").agg(
        F.min(T.parse_new_time(F.regexp_extract("text", NEW_TIME, 1), F.regexp_extract("text", NEW_TIME, 2))).alias("oldest")
    )


PHONE_SCHEMA = "date string, time string, sender string, text string, id string, quote struct<sender:string,text:string>, reactions array<struct<emoji:string,senders:array<string>>>"


def _name(raw: Column) -> Column:
    """A sender is a name or an object that holds one."""
    return F.coalesce(F.get_json_object(raw, "$.user_name"), raw)


def read_phone_export(spark: SparkSession, path: str) -> DataFrame:
    """Messages of a phone's JSON list; rows whose text is empty once normalised are dropped."""
    rows = spark.read.schema(PHONE_SCHEMA).json(path, multiLine=True)
    return phone_messages(rows)


def phone_messages(rows: DataFrame) -> DataFrame:
    return rows.select(
        "id", T.parse_phone_export_time(F.col("date"), F.col("time")).alias("ts"), _name(F.col("sender")).alias("sender"),
        T.normalize_content(F.coalesce("text", F.lit(""))).alias("content"), "quote",
        F.coalesce("reactions", F.array().cast("array<struct<emoji:string,senders:array<string>>>")).alias("reactions"),
    ).where("content <> ''")


def map_senders(messages: DataFrame, mapping: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Messages with senders replaced by ``mapping`` (old, new), and the senders without one, those who only reacted too."""
    m = mapping.select(F.col("old").alias("map_old"), F.col("new").alias("map_new"))
    joined = messages.join(m, messages["sender"] == m["map_old"], "left")
    out = joined.withColumn("sender", F.coalesce("map_new", "sender")).drop("map_old", "map_new")
    every = messages.select("sender")
    if "reactions" in messages.columns:
        reacted = messages.select(F.explode("reactions").alias("r")).select(F.explode("r.senders").alias("sender"))
        every = every.unionByName(reacted.where("trim(sender) <> ''"))
    return out, every.distinct().join(m, F.col("sender") == F.col("map_old"), "left_anti")
