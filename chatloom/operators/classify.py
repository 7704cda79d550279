"""Classification of threads and extraction of claims, before and after the model is asked.

The model itself is a seam (``sources.artifacts``): these operators decide which threads are
asked, parse what comes back, and join it to threads. Rows keep the order ``ord``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import json_block
from .views import keep_thread, reason

STATS = ("start_time", "last_time", "num_messages", "num_unique_senders")
CLASS = ("passed_heuristic", "is_knowledge_bearing", "topic_tags", "emergent_tags", "entities", "reason")
ANSWER = "is_knowledge_bearing string, topic_tags array<string>, entities array<string>, reason string"
CLAIM = (
    "claim_text string, topic_tags array<string>, entities array<string>, stance string, "
    "supporting_message_ids array<string>, opposing_message_ids array<string>"
)
NONE = "array<string>"


def thread_text(messages: DataFrame) -> DataFrame:
    """(thread_id, text): the messages of each thread in order, one a line."""
    lines = F.array_sort(F.collect_list(F.struct("idx", F.coalesce("content", F.lit("")).alias("c"))))
    return messages.groupBy("thread_id").agg(F.array_join(F.transform(lines, lambda x: x["c"]), "\n").alias("text"))


def candidates(threads: DataFrame, texts: DataFrame, topic: str | None = None, most: int | None = None, least_messages: int = 3, least_senders: int = 2) -> DataFrame:
    """Threads with ``passed_heuristic``, ``asked`` and the reason why one is not asked.

    The topic is a substring, without regard to case, of the whole thread; ``most`` threads
    are asked, the first in order of those left.
    """
    passed = keep_thread(F.coalesce("num_messages", F.lit(0)), F.coalesce("num_unique_senders", F.lit(0)), least_messages, least_senders)
    inside = F.lit(True) if not topic else F.contains(F.lower(F.coalesce("_text", F.lit(""))), F.lit(topic.lower()))
    rows = threads.join(texts.select(F.col("thread_id").alias("_of"), F.col("text").alias("_text")), F.col("thread_id") == F.col("_of"), "left")
    rows = rows.withColumns({"passed_heuristic": passed, "_in": inside}).drop("_of", "_text")
    rank = None
    if most is not None:
        # a rank among the candidates alone, which the budget cuts
        first = rows.where("passed_heuristic and _in").orderBy("ord", "thread_id").limit(most).select(F.col("thread_id").alias("_of"))
        rows = rows.join(first, F.col("thread_id") == F.col("_of"), "left")
        rank = F.col("_of").isNotNull()
    budget = F.lit(True) if rank is None else rank
    why = reason(F.col("passed_heuristic"), F.col("_in"), budget)
    return rows.withColumns({"reason": why, "asked": why.isNull()}).drop("_in", "_of")


def without_known(tags: Column, known: Column) -> Column:
    """Tags that are not known, repeated ones and all."""
    return F.filter(tags, lambda t: ~F.array_contains(known, t))


def parse_class(answers: DataFrame, known_tags: DataFrame) -> DataFrame:
    """(thread_id, is_knowledge_bearing, topic_tags, emergent_tags, entities, reason) of model answers (thread_id, answer).

    The outermost JSON object of the answer counts, inside a code fence or not. Without one the
    thread is no knowledge, with the reason ``classification_error``. ``known_tags`` (tag) is
    the catalog of topics; tags beyond it are emergent.
    """
    # one row
    known = known_tags.agg(F.collect_set("tag").alias("_known"))
    parsed = answers.select("thread_id", F.from_json(json_block("answer"), ANSWER, {"mode": "PERMISSIVE"}).alias("a"))
    a = lambda c: F.col(f"a.{c}")
    bad = F.col("a").isNull() | (a("is_knowledge_bearing").isNull() & a("topic_tags").isNull() & a("reason").isNull() & a("entities").isNull())
    # what Python takes as false
    truth = ~F.lower(F.coalesce(a("is_knowledge_bearing"), F.lit("false"))).isin("false", "0", "", "null", "0.0", "[]", "{}")
    tags = F.filter(F.coalesce(a("topic_tags"), F.array().cast(NONE)), lambda t: t.isNotNull())
    rows = parsed.join(F.broadcast(known)).withColumn("_tags", F.when(bad, F.array().cast(NONE)).otherwise(tags))
    return rows.select(
        "thread_id", F.when(bad, False).otherwise(truth).alias("is_knowledge_bearing"), F.col("_tags").alias("topic_tags"),
        without_known(F.col("_tags"), F.col("_known")).alias("emergent_tags"),
        F.when(bad, F.array().cast(NONE)).otherwise(F.coalesce(a("entities"), F.array().cast(NONE))).alias("entities"),
        F.when(bad, F.lit("classification_error")).otherwise(F.coalesce(a("reason"), F.lit(""))).alias("reason"),
    )


def with_classes(threads: DataFrame, classified: DataFrame) -> DataFrame:
    """Threads with their classification, and the default where there is none: heuristic passed, no
    knowledge (unset), reason ``missing_classification``. Counts and times are those of the thread."""
    own = [c for c in threads.columns if c not in CLASS]
    rows = threads.select(*own).join(classified.select("thread_id", *CLASS, F.lit(True).alias("_known")), "thread_id", "left")
    empty = lambda c: F.coalesce(c, F.array().cast(NONE)).alias(c)
    missing = F.col("_known").isNull()
    return rows.select(
        *own, F.coalesce("passed_heuristic", F.lit(True)).alias("passed_heuristic"), F.when(~missing, F.col("is_knowledge_bearing")).alias("is_knowledge_bearing"),
        empty("topic_tags"), empty("emergent_tags"), empty("entities"),
        F.when(missing, F.lit("missing_classification")).otherwise(F.coalesce("reason", F.lit(""))).alias("reason"),
    )


def merged_classes(asked: DataFrame, answers: DataFrame) -> DataFrame:
    """Rows of ``candidates`` with the parsed answers of those that were asked."""
    got = answers.select(F.col("thread_id").alias("_of"), *[F.col(c).alias(f"_{c}") for c in CLASS if c != "passed_heuristic"])
    rows = asked.join(got, asked["thread_id"] == got["_of"], "left")
    own = [c for c in asked.columns if c not in (*CLASS, "asked")]
    empty = lambda c: F.coalesce(f"_{c}", F.array().cast(NONE)).alias(c)
    return rows.select(
        *own, "asked", "passed_heuristic", F.coalesce("_is_knowledge_bearing", F.lit(False)).alias("is_knowledge_bearing"), empty("topic_tags"), empty("emergent_tags"),
        empty("entities"), F.coalesce("_reason", "reason", F.lit("classification_error")).alias("reason"),
    )


def to_reclassify(threads: DataFrame, classified: DataFrame, most: int | None = None) -> DataFrame:
    """Threads with their class as it is, and ``asked``: all but those set to no knowledge by hand; the first ``most``."""
    rows = with_classes(threads, classified)
    skipped = F.col("is_knowledge_bearing").eqNullSafe(F.lit(False))
    rows = rows.withColumn("skipped", skipped)
    if most is None:
        return rows.withColumn("asked", ~F.col("skipped"))
    first = rows.where("not skipped").orderBy("ord", "thread_id").limit(most).select(F.col("thread_id").alias("_of"))
    return rows.join(first, F.col("thread_id") == F.col("_of"), "left").withColumn("asked", F.col("_of").isNotNull()).drop("_of")


def class_counts(rows: DataFrame) -> DataFrame:
    """One row: threads, those of knowledge, asked, and left as no knowledge."""
    n = lambda c: F.coalesce(F.sum(F.coalesce(c, F.lit(False)).cast("bigint")), F.lit(0))
    skipped = F.col("skipped") if "skipped" in rows.columns else F.lit(False)
    return rows.agg(
        F.count(F.lit(1)).alias("thread_count"), n(F.col("is_knowledge_bearing")).alias("knowledge_bearing_count"), n(F.col("asked")).alias("asked_count"), n(skipped).alias("skipped_count")
    )


def knowledge_threads(classified: DataFrame, threads: DataFrame, tag: str | None = None, most: int | None = None) -> DataFrame:
    """Threads of knowledge, of those with exactly this tag if one is given, in order of their classification."""
    rows = classified.where("is_knowledge_bearing")
    if tag is not None:
        rows = rows.where(F.array_contains("topic_tags", tag))
    if most is not None:
        rows = rows.orderBy("ord", "thread_id").limit(most)
    kept = rows.select("thread_id", F.col("ord").alias("class_ord")).distinct()
    return threads.join(kept, "thread_id")


def rendered_lines(messages: DataFrame) -> DataFrame:
    """(thread_id, line, idx, sender, month): the lines that a thread shows, blank messages left out, numbered from 0."""
    shown = messages.where(F.trim(F.coalesce("content", F.lit(""))) != "")
    order = Window.partitionBy("thread_id").orderBy("idx")
    return shown.withColumn("line", F.row_number().over(order) - 1)


def claims_from_answers(answers: DataFrame, lines: DataFrame, known_tags: DataFrame) -> DataFrame:
    """Claims of model answers (thread_id, answer) over the lines of their threads (thread_id, line, idx, month).

    An entry without text is none, but keeps its number; message numbers that the thread does
    not have are left out. A claim's date is the first month of its messages, or of its
    thread where it names none. An answer that does not parse gives no claims.
    """
    known = known_tags.agg(F.collect_set("tag").alias("_known"))
    # an entry that is no object is none, and takes no other along
    parsed = answers.select("thread_id", F.from_json(json_block("answer"), "claims array<string>")["claims"].alias("claims"))
    entries = parsed.select("thread_id", F.posexplode("claims").alias("pos", "entry")).select("thread_id", "pos", F.from_json("entry", CLAIM).alias("c"))
    each = entries.where(F.trim(F.coalesce("c.claim_text", F.lit(""))) != "")
    span = lines.groupBy("thread_id").agg(F.count(F.lit(1)).alias("n_lines"), F.min("month").alias("first_month"))
    rows = each.join(span, "thread_id")
    # whole numbers only, as JSON has them
    ids = lambda c: F.transform(F.filter(F.coalesce(c, F.array().cast(NONE)), lambda i: i.rlike("^-?[0-9]+$")), lambda i: i.cast("bigint"))
    valid = lambda c: F.filter(ids(c), lambda i: (i >= 0) & (i < F.col("n_lines")))
    tags = F.filter(F.coalesce("c.topic_tags", F.array().cast(NONE)), lambda t: t.isNotNull())
    made = rows.join(F.broadcast(known)).select(
        F.concat("thread_id", F.lit("-c"), F.col("pos").cast("string")).alias("claim_id"), "thread_id", "pos", F.trim("c.claim_text").alias("claim_text"),
        tags.alias("topic_tags"), without_known(tags, F.col("_known")).alias("emergent_tags"), F.coalesce("c.entities", F.array().cast(NONE)).alias("entities"),
        F.coalesce("c.stance", F.lit("neutral")).alias("stance"), valid(F.col("c.supporting_message_ids")).alias("supporting"), valid(F.col("c.opposing_message_ids")).alias("opposing"), "first_month",
    )
    cited = made.select("claim_id", "thread_id", F.explode("supporting").alias("line")).distinct()
    months = cited.join(lines.select("thread_id", "line", "month"), ["thread_id", "line"]).groupBy("claim_id").agg(F.min("month").alias("own_month"))
    return made.join(months, "claim_id", "left").withColumn("date", F.coalesce("own_month", "first_month")).drop("own_month", "first_month")


def claim_votes(claims: DataFrame, lines: DataFrame) -> DataFrame:
    """Messages of claims in the form that ``support.votes_from_messages`` takes.

    ``lines`` has thread_id, line, sender and reactions. A message that a claim cites on both sides
    gives its author to both and its reactions once.
    """
    side = lambda c, role: claims.select("claim_id", "thread_id", F.explode(c).alias("line")).distinct().withColumn("role", F.lit(role))
    both = side("supporting", "statement").unionByName(side("opposing", "opposing"))
    rows = both.join(lines.select("thread_id", "line", "sender", "reactions"), ["thread_id", "line"])
    first = Window.partitionBy("claim_id", "line").orderBy("role")
    rows = rows.withColumn("_n", F.row_number().over(first))
    return rows.select(
        F.col("claim_id").alias("claim"), "sender", "role", F.when(F.col("_n") == 1, F.col("reactions")).alias("reactions"), "line"
    )
