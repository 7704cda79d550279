"""Who supports and who opposes a claim: counts of distinct people, never their names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Emoji that agree or disagree; all others are neutral.
POSITIVE = (
    "☝️ ☝🏻 ☝🏽 ☺️ ✅ ✌️ ✌🏻 ✔️ ✨ ➕ ⬆️ ⭐ 🌠 🌷 🎉 🎖️ 🎤 🎯 🏆 🏳️‍🌈 🐣 👆 👆🏻 👆🏽 👌 👌🏻 👍 👍🏻 👍🏼 👍🏽 👍🏾 👍🏿 👏 👏🏻 👏🏼 👏🏽 👏🏾 👏🏿 👑 👸 "
    "👸🏻 💪 💪🏻 💪🏼 💪🏽 💯 🔥 🕺🏻 😇 😍 😘 🙋‍♂ 🙋‍♂️ 🙋🏻‍♂ 🙋🏻‍♂️ 🙋🏼‍♂ 🙋🏾‍♂️ 🙌🏽 🤗 🤘 🤘🏻 🤞 🤞🏻 🤞🏼 🤞🏿 🤟 🤩 🤯 🤴 🤴🏼 🥂 🥇 🥰 🥳 🥹 🦾 🧠 🧡 🩷 🪬 🪻 🫂 🫡 🫶 "
    "🫶🏻 🫶🏼"
).split()
NEGATIVE = "☹️ ⛔️ ✖️ ❌ 👎 👎🏻 👎🏼 👎🏽 👎🏾 👎🏿 💔 💩 🖕 😒 😓 😔 😞 😡 😢 😥 😭 🙁 🛑 🤢 🤬 🤮".split()


def sentiment(emoji: Column | str) -> Column:
    """positive, negative or neutral."""
    e = F.col(emoji) if isinstance(emoji, str) else emoji
    return F.when(e.isin(*POSITIVE), "positive").when(e.isin(*NEGATIVE), "negative").otherwise("neutral")


def votes_from_messages(messages: DataFrame) -> DataFrame:
    """(claim, user, role, sentiment) of a claim's messages: authors and reactors.

    ``messages`` has claim, sender, role (statement or opposing) and reactions.
    Blank senders are left out; reactions count alike on either role.
    """
    authors = messages.select("claim", F.col("sender").alias("user"), "role", F.lit("neutral").alias("sentiment"))
    reactions = messages.select("claim", F.explode("reactions").alias("r")).select(
        "claim", F.explode("r.senders").alias("user"), F.lit("reaction").alias("role"), sentiment(F.col("r.emoji")).alias("sentiment")
    )
    return authors.unionByName(reactions).where(F.trim("user") != "")


def support_counts(votes: DataFrame, keys: tuple[str, ...] = ("claim",)) -> DataFrame:
    """Distinct supporters (at least 1) and opposers, and reactors who are no authors.

    One row a person first, so a claim with very many votes is summed in parts.
    """
    role, mood = F.col("role"), F.col("sentiment")
    flag = lambda c: F.max(c.cast("int"))
    people = votes.groupBy(*keys, "user").agg(
        flag(role == "statement").alias("author"), flag(role == "opposing").alias("against"),
        flag((role == "reaction") & (mood == "positive")).alias("likes"), flag((role == "reaction") & (mood == "negative")).alias("dislikes"),
    )
    count = lambda c: F.sum(c.cast("bigint"))
    yes = lambda c: F.col(c) == 1
    return people.groupBy(*keys).agg(
        F.greatest(F.lit(1).cast("bigint"), count(yes("author") | yes("likes"))).alias("support_count"),
        count(yes("against") | yes("dislikes")).alias("opposer_count"),
        count(yes("likes") & ~yes("author")).alias("reaction_only_count"),
        count(yes("likes")).alias("reaction_endorser_count"), count(yes("author")).alias("author_count"),
    )


def message_reactions(reactions: Column | str) -> Column:
    """(emoji, count, sentiment) of each reaction of one message that somebody made, in order; no names."""
    r = F.col(reactions) if isinstance(reactions, str) else reactions
    made = F.transform(r, lambda x: F.struct(x["emoji"].alias("emoji"), F.size(F.filter(x["senders"], lambda p: p != "")).alias("count"), sentiment(x["emoji"]).alias("sentiment")))
    return F.filter(made, lambda x: x["count"] > 0)


def reaction_summary(messages: DataFrame, keys: tuple[str, ...] = ("claim",)) -> DataFrame:
    """Reactions by emoji, in the order in which they are first seen."""
    each = messages.select(*keys, "idx", F.posexplode("reactions").alias("pos", "r")).select(
        *keys, "idx", "pos", "r.emoji", F.size(F.filter("r.senders", lambda s: F.trim(s) != "")).cast("bigint").alias("n")
    ).where("n > 0")
    return each.groupBy(*keys, "emoji").agg(F.sum("n").alias("n"), F.min(F.struct("idx", "pos")).alias("seen"))


def engagement(citations: DataFrame, people: DataFrame, key: str) -> DataFrame:
    """Distinct supporters of several claims together.

    ``citations`` (key, claim) may name a claim twice; ``people`` has claim and user.
    Without any person the count is 1 if a claim is cited.
    """
    cited = citations.select(key, "claim").distinct()
    persons = cited.join(people.select("claim", "user").distinct(), "claim").select(key, "user").distinct()
    n = persons.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    ids = cited.groupBy(key).agg(F.count("claim").alias("claim_count"))
    return ids.join(n, key, "left").select(
        key, "claim_count", F.when(F.col("claim_count") > 0, F.greatest(F.lit(1).cast("bigint"), F.coalesce("n", F.lit(0)))).otherwise(0).alias("support_count")
    )


def emoji_coverage(reactions: DataFrame) -> DataFrame:
    """Uses of each emoji that no list names, the most used first."""
    known = [*POSITIVE, *NEGATIVE]
    return reactions.groupBy("emoji").agg(F.sum("n").alias("n")).where(~F.col("emoji").isin(*known))
