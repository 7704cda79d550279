"""Operators over messages in order: bursts, gaps, quotes, sessions, neighbours.

All windows are partitioned by chat or thread, so work spreads over chats.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import gap_seconds


def burst_coalesce(messages: DataFrame, gap: float = 120.0) -> DataFrame:
    """Join runs of one sender whose messages follow within ``gap`` seconds.

    A gap below zero joins as well. Returns chat_id, idx (of the first), ts, sender,
    content and n (messages joined).
    """
    order = Window.partitionBy("chat_id").orderBy("idx")
    joins = (F.lag("sender").over(order) == F.col("sender")) & (gap_seconds(F.lag("ts").over(order), F.col("ts")) < gap)
    runs = messages.withColumn("run", F.sum(F.when(joins, 0).otherwise(1)).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return runs.groupBy("chat_id", "run").agg(
        F.min("idx").alias("idx"), F.min_by("ts", "idx").alias("ts"), F.first("sender").alias("sender"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("idx", "content"))), lambda x: x["content"]), "\n").alias("content"),
        F.count(F.lit(1)).alias("n"),
    ).drop("run")


def gap_features(messages: DataFrame, normalize: float = 360.0, tau: float = 180.0) -> DataFrame:
    """Minutes since the message before (not below 0), its share of ``normalize`` (1 without one) and time proximity."""
    order = Window.partitionBy("chat_id").orderBy("idx")
    minutes = F.greatest(F.lit(0.0), gap_seconds(F.lag("ts").over(order), F.col("ts")) / 60)
    gap = F.when(F.lag("idx").over(order).isNotNull(), minutes)
    return messages.withColumn("gap_minutes", gap).withColumns({
        "gap_norm": F.coalesce(F.least(F.lit(1.0), F.col("gap_minutes") / normalize), F.lit(1.0)),
        "proximity": F.exp(-F.col("gap_minutes") / tau),
    })


def quote_asof(messages: DataFrame, within: tuple[str, ...] = ("chat_id",)) -> DataFrame:
    """The latest earlier message that each message quotes.

    ``messages`` has idx, sender, content, quote_sender and quote_text. Rows that
    quote and rows that are quoted meet in one window by key; the frame ends before
    the quoting row, so the cost is that of a sort.
    """
    key = [*within, "key_sender", "key_text"]
    build = messages.select(*within, "idx", F.col("sender").alias("key_sender"), F.col("content").alias("key_text"), F.col("idx").alias("own"), F.lit(False).alias("probe"))
    probe = messages.where("quote_text is not null").select(
        *within, "idx", F.col("quote_sender").alias("key_sender"), F.col("quote_text").alias("key_text"),
        F.lit(None).cast(messages.schema["idx"].dataType).alias("own"), F.lit(True).alias("probe"),
    )
    earlier = Window.partitionBy(*key).orderBy("idx").rangeBetween(Window.unboundedPreceding, -1)
    met = build.unionByName(probe).withColumn("quoted_idx", F.last("own", ignorenulls=True).over(earlier))
    return met.where("probe and quoted_idx is not null").select(*within, "idx", "quoted_idx")


def quote_by_time(messages: DataFrame) -> DataFrame:
    """The quoted message for ordering: the latest by (ts, idx) not later in time, itself excluded.

    Quoting and quoted rows meet in one window by key, as in ``quote_asof``: a text said very
    often costs a sort, not its pairs. The frame holds all of the same time, the quoting row's own
    message too; where that is the latest, the one before it in its key is the answer.
    """
    key = ["chat_id", "key_sender", "key_text"]
    own = messages.select("chat_id", "idx", "ts", F.col("sender").alias("key_sender"), F.col("content").alias("key_text"))
    before = F.lag("idx").over(Window.partitionBy(*key).orderBy("ts", "idx"))
    build = own.select(*key, "idx", "ts", F.struct("ts", "idx", before.alias("before")).alias("own"), F.lit(False).alias("probe"))
    probe = messages.where("quote_text is not null").select(
        "chat_id", F.col("quote_sender").alias("key_sender"), F.col("quote_text").alias("key_text"), "idx", "ts",
        F.lit(None).cast(build.schema["own"].dataType).alias("own"), F.lit(True).alias("probe"),
    )
    until = Window.partitionBy(*key).orderBy("ts").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    met = build.unionByName(probe).withColumn("best", F.max("own").over(until)).where("probe")
    quoted = F.when(F.col("best.idx") == F.col("idx"), F.col("best.before")).otherwise(F.col("best.idx"))
    return met.select("chat_id", "idx", quoted.alias("quoted_idx")).where("quoted_idx is not null")


def quote_order(messages: DataFrame) -> DataFrame:
    """Messages in order of time, a quoted one before those that quote it.

    Only messages of the same time can change places, so the pass runs for each
    time alone. Adds ``pos`` within the chat.
    """
    quotes = quote_by_time(messages)
    joined = messages.join(quotes, ["chat_id", "idx"], "left")
    with_time = joined.join(
        messages.select("chat_id", F.col("idx").alias("quoted_idx"), F.col("ts").alias("quoted_ts")), ["chat_id", "quoted_idx"], "left"
    ).select("chat_id", "idx", "ts", F.when(F.col("quoted_ts") == F.col("ts"), F.col("quoted_idx")).alias("after"))

    def order(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("idx", kind="stable")
        after = {int(r.idx): (None if pd.isna(r.after) else int(r.after)) for r in group.itertuples()}
        done: dict[int, int] = {}
        for start in after:
            chain, node = [], start
            while node is not None and node in after and node not in done and node not in chain:
                chain.append(node)
                node = after[node]
            for n in reversed(chain):
                done[n] = len(done)
        return pd.DataFrame({"chat_id": group["chat_id"], "idx": group["idx"], "tie": [done[int(i)] for i in group["idx"]]})

    tied = with_time.groupBy("chat_id", "ts").agg(F.count("after").alias("n")).where("n > 0").drop("n")
    schema = f"chat_id {messages.schema['chat_id'].dataType.simpleString()}, idx {messages.schema['idx'].dataType.simpleString()}, tie int"
    moved = with_time.join(tied, ["chat_id", "ts"], "left_semi").groupBy("chat_id", "ts").applyInPandas(order, schema)
    final = messages.join(moved, ["chat_id", "idx"], "left")
    by = Window.partitionBy("chat_id").orderBy("ts", F.coalesce("tie", F.lit(0)), "idx")
    return final.withColumn("pos", F.row_number().over(by) - 1).drop("tie")


def sessions(messages: DataFrame, hours: float = 12.0) -> DataFrame:
    """Number of the session of each message: a new one after ``hours`` of silence or more."""
    order = Window.partitionBy("chat_id").orderBy("idx")
    breaks = gap_seconds(F.lag("ts").over(order), F.col("ts")) >= hours * 3600
    return messages.withColumn("session", F.sum(F.when(breaks, 1).otherwise(0)).over(order.rowsBetween(Window.unboundedPreceding, 0)))


def thread_summary(messages: DataFrame, reactors: bool = False) -> DataFrame:
    """First and last time, message count, participants and last sender of each thread.

    With ``reactors`` those who only reacted (reactions) are participants too; blank names are nobody.
    """
    base = messages.groupBy("thread_id").agg(
        F.min("ts").alias("start_time"), F.max("ts").alias("last_time"), F.count(F.lit(1)).alias("num_messages"), F.max_by("sender", "idx").alias("last_sender")
    )
    people = messages.select("thread_id", "sender")
    if reactors:
        reacted = messages.select("thread_id", F.explode("reactions").alias("r")).select("thread_id", F.explode("r.senders").alias("sender"))
        people = people.unionByName(reacted.where("trim(sender) <> ''"))
    names = people.distinct().groupBy("thread_id").agg(F.array_sort(F.collect_list("sender")).alias("participants"))
    return base.join(names, "thread_id", "left").withColumn("participants", F.coalesce("participants", F.array().cast("array<string>"))).withColumn(
        "num_unique_senders", F.size("participants").cast("bigint")
    )


def pseudonyms(messages: DataFrame) -> DataFrame:
    """Participant number by first appearance in the thread, from 1."""
    whole = Window.partitionBy("thread_id", "sender")
    return messages.withColumn("first_idx", F.min("idx").over(whole)).withColumn(
        "participant", F.dense_rank().over(Window.partitionBy("thread_id").orderBy("first_idx"))
    ).drop("first_idx")


def rendered(messages: DataFrame) -> DataFrame:
    """One text a thread: numbered non-blank messages under pseudonyms."""
    named = pseudonyms(messages.where(F.trim("content") != ""))
    order = Window.partitionBy("thread_id").orderBy("idx")
    lines = named.withColumn("line_no", F.row_number().over(order) - 1)
    text = F.format_string("[m%d] (P%d) %s", "line_no", "participant", "content")
    return lines.groupBy("thread_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", text.alias("t")))), lambda x: x["t"]), "\n").alias("rendered")
    )


# The name of a participant and the mark of reactions in a rendered thread.
PARTICIPANT, REACTIONS = "משתתף", "תגובות"


def rendered_for_model(messages: DataFrame) -> DataFrame:
    """(thread_id, rendered): lines ``[m0] (2024-01, name 1) text [reactions: 👍×2]`` of the messages that are not blank.

    ``messages`` has thread_id, idx, ts, sender, content and reactions. Participants are numbered in
    order of their first line; reactions without a sender or an emoji are left out.
    """
    from ..functions.text import strip

    shown = messages.withColumn("content", strip(F.coalesce("content", F.lit("")))).where("content <> ''")
    named = pseudonyms(shown).withColumn("line_no", F.row_number().over(Window.partitionBy("thread_id").orderBy("idx")) - 1)
    people = lambda r: F.size(F.filter(F.coalesce(r["senders"], F.array().cast("array<string>")), lambda x: x != ""))
    some = F.filter(F.coalesce("reactions", F.array().cast(messages.schema["reactions"].dataType)), lambda r: (people(r) > 0) & (r["emoji"] != ""))
    detail = F.array_join(F.transform(some, lambda r: F.concat(r["emoji"], F.lit("×"), people(r).cast("string"))), ", ")
    suffix = F.when(F.size(some) > 0, F.concat(F.lit(f" [{REACTIONS}: "), detail, F.lit("]"))).otherwise("")
    line = F.concat(F.format_string(f"[m%d] (%s, {PARTICIPANT} %d) %s", "line_no", F.coalesce(F.date_format("ts", "yyyy-MM"), F.lit("")), "participant", "content"), suffix)
    return named.select("thread_id", F.struct("line_no", line.alias("t")).alias("l")).groupBy("thread_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("l")), lambda x: x["t"]), "\n").alias("rendered")
    )


def quote_in_thread(messages: DataFrame) -> DataFrame:
    """(thread_id, idx, quoted_idx): the earliest earlier message of the thread that a message quotes.

    Texts are equal or one holds the other, white space folded; the sender counts if the quote names
    one. Threads are cut at a bounded length, so the pairs of a thread are bounded.
    """
    from ..functions.text import collapse_spaces

    fold = lambda c: collapse_spaces(F.coalesce(c, F.lit("")))
    probe = messages.select("thread_id", F.col("idx").alias("at"), "quote_sender", fold("quote_text").alias("q")).where("q <> ''")
    said = messages.select(F.col("thread_id").alias("of"), "idx", "sender", fold("content").alias("c")).where("c <> ''")
    same = (F.coalesce("quote_sender", F.lit("")) == "") | (F.col("sender") == F.col("quote_sender"))
    cond = (F.col("thread_id") == F.col("of")) & (F.col("idx") < F.col("at")) & same & (F.contains("c", F.col("q")) | F.contains("q", F.col("c")))
    return probe.join(said, cond).groupBy("thread_id", F.col("at").alias("idx")).agg(F.min("idx").alias("quoted_idx"))


def neighbors(rows: DataFrame, key: str, order: list[Column], by: list[str] | None = None) -> DataFrame:
    """Key before and after each row in order, its position from 1 and the number of rows.

    ``by`` partitions; a queue without partitions is one filtered page of a review tool.
    """
    w = Window.partitionBy(*(by or [])).orderBy(*order)
    return rows.withColumns({
        "prev_key": F.lag(key).over(w), "next_key": F.lead(key).over(w), "position": F.row_number().over(w),
        "total": F.count(F.lit(1)).over(Window.partitionBy(*(by or []))),
    })


def batches(rows: DataFrame, by: str, order: list[str], size: int = 15) -> DataFrame:
    """Number of the batch of ``size`` rows that each row falls into."""
    at = F.row_number().over(Window.partitionBy(by).orderBy(*order))
    return rows.withColumn("batch", F.floor((at - 1) / size))


def split_boundaries(messages: DataFrame, min_part: int = 10, limit: int = 50) -> DataFrame:
    """Best place to split each thread of over ``limit`` messages: thread_id, pos, score.

    ``messages`` has pos, ts and similarity to the next message (next_sim). A boundary
    scores half the time gap and half the lack of similarity, less a half after a
    short gap; the first best one counts if it reaches 0.4. With a column ``component``
    (messages linked by quotes) a place that would cut a component is none.
    """
    order = Window.partitionBy("thread_id").orderBy("pos")
    gap = F.greatest(F.lit(0.0), gap_seconds(F.col("ts"), F.lead("ts").over(order)) / 60)
    n = F.count(F.lit(1)).over(Window.partitionBy("thread_id"))
    scored = messages.withColumns({"gap": gap, "n": n}).withColumn(
        "score", 0.5 * F.least(F.lit(1.0), F.col("gap") / 360) + 0.5 * (1 - F.col("next_sim")) - F.when(F.col("gap") <= 5, 0.5).otherwise(0.0)
    )
    inside = (F.col("n") > limit) & (F.col("pos") >= min_part - 1) & (F.col("pos") < F.col("n") - min_part)
    if "component" in messages.columns:
        end = F.max("pos").over(Window.partitionBy("thread_id", "component"))
        reach = F.max("_end").over(order.rowsBetween(Window.unboundedPreceding, 0))
        scored = scored.withColumn("_end", end).withColumn("_reach", reach)
        inside = inside & (F.col("_reach") <= F.col("pos"))
    best = scored.where(inside).groupBy("thread_id").agg(F.max_by(F.struct("pos", "score"), F.struct("score", -F.col("pos"))).alias("b"))
    return best.select("thread_id", "b.pos", "b.score").where("score >= 0.4")


def align_senders(old: DataFrame, new: DataFrame) -> DataFrame:
    """Pairs of senders of two recordings of one chat, aligned on content.

    Both have chat_id, idx, sender and content. Alignment is that of the standard
    library's sequence matcher and works on one chat at a time.
    """
    schema = "chat_id string, old_sender string, new_sender string, ord int"

    def align(key, a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        from difflib import SequenceMatcher

        a, b = a.sort_values("idx"), b.sort_values("idx")
        rows = []
        for block in SequenceMatcher(None, list(a["content"]), list(b["content"]), autojunk=False).get_matching_blocks():
            for k in range(block.size):
                rows.append((str(key[0]), a["sender"].iloc[block.a + k], b["sender"].iloc[block.b + k], len(rows)))
        return pd.DataFrame(rows, columns=["chat_id", "old_sender", "new_sender", "ord"])

    # both sides may come from one table: fresh columns keep them apart
    fresh = lambda df: df.select(*[F.col(c).alias(c) for c in ("chat_id", "idx", "sender", "content")])
    return fresh(old).groupBy("chat_id").cogroup(fresh(new).groupBy("chat_id")).applyInPandas(align, schema)


def sender_votes(pairs: DataFrame, outgoing: bool = False) -> DataFrame:
    """Aligned pairs counted, with ``outgoing`` of messages that the phone's owner sent (is_outgoing) only."""
    if outgoing:
        pairs = pairs.where("is_outgoing")
    return pairs.groupBy("old_sender", "new_sender").agg(F.count(F.lit(1)).alias("n"), F.min("ord").alias("first_ord"))


def sender_mapping(votes: DataFrame, keep_phones: bool = True) -> DataFrame:
    """The new name of each old sender: names before phone numbers, then most votes, then first seen.

    With ``keep_phones=False`` most votes decide alone and a phone number is no answer.
    """
    from ..functions.text import is_phone_sender

    phone = is_phone_sender(F.col("new_sender"))
    order = [phone.cast("int"), F.desc("n"), "first_ord"] if keep_phones else [F.desc("n"), "first_ord"]
    ranked = votes.withColumn("rank", F.row_number().over(Window.partitionBy("old_sender").orderBy(*order))).where("rank = 1")
    ranked = ranked if keep_phones else ranked.where(~phone)
    return ranked.select(F.col("old_sender").alias("old"), F.col("new_sender").alias("new"))


def owner_mapping(votes: DataFrame, outgoing: DataFrame, you: str = "You", suffix: str = "@c.us") -> DataFrame:
    """The new name (old, new) of each provider id (senders that end in ``suffix``) and of the phone's owner.

    The owner, whom the phone calls ``you``, takes the most frequent partner of sent messages (``outgoing``
    votes) if there are any, else of all; others as in ``sender_mapping``.
    """
    most = lambda v: v.withColumn("_n", F.row_number().over(Window.partitionBy("old_sender").orderBy(F.desc("n"), "first_ord"))).where("_n = 1")
    own = most(outgoing.where(F.col("old_sender") == you)).select(F.col("old_sender").alias("old"), F.col("new_sender").alias("sent"))
    every = most(votes.where(F.col("old_sender") == you)).select(F.col("old_sender").alias("old"), F.col("new_sender").alias("any"))
    owner = every.join(own, "old", "left").select("old", F.coalesce("sent", "any").alias("new"))
    return sender_mapping(votes).where((F.col("old") != you) & F.endswith("old", F.lit(suffix))).unionByName(owner)


def overlap_mapping(old: DataFrame, new: DataFrame) -> DataFrame:
    """(old, new) names of senders from the time that two exports of a chat (chat_id, idx, ts, sender, content) share.

    Messages of the old export from the first of the new one on are aligned with it by content;
    names that stay phone numbers are left out.
    """
    first = new.groupBy(F.col("chat_id").alias("_chat")).agg(F.min("ts").alias("_since"))
    late = old.join(first, old["chat_id"] == first["_chat"]).where("ts >= _since").drop("_chat", "_since")
    return sender_mapping(sender_votes(align_senders(late, new)), keep_phones=False)
