"""Claims merged by topic, stance and cluster, with the people behind them.

Audit rows (claim_id, supporting_senders, opposing_senders, message_reactions,
all_supporters, reaction_senders, reaction_opposers) name people; merged rows only count
them. People are folded to one row a person and cluster before they are counted, so
a claim that very many people back is counted in parts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.artifacts import saved
from .aggregate import cluster_groups
from .support import sentiment

OVERVIEW = "overview"
EMERGENT = "emergent"
#: What ``merge_records`` reads of a claim beside the keys.
CLAIM = ("claim_id", "ord", "is_medoid", "claim_text", "stance", "thread_id", "date", "entities", "support_count", "redactions")
AUDIT = (
    "claim_id bigint, supporting_senders array<string>, opposing_senders array<string>, "
    "message_reactions array<struct<emoji:string,senders:array<string>>>, all_supporters array<string>, "
    "reaction_senders array<string>, reaction_opposers array<string>"
)


def _reactions(audit: DataFrame) -> DataFrame:
    """(claim_id, pos, emoji, senders, sentiment) of the reactions that audit rows hold, in order."""
    each = audit.select("claim_id", F.posexplode("message_reactions").alias("pos", "r"))
    return each.select("claim_id", "pos", "r.emoji", F.coalesce("r.senders", F.array().cast("array<string>")).alias("senders"), sentiment("r.emoji").alias("sentiment"))


def participants(audit: DataFrame) -> DataFrame:
    """(claim_id, user, side, stated, reacted): the people of each side of a claim, one row each.

    Authors take their side; reactors that of their emoji. Rows without reactions
    (``message_reactions`` null) are of an older kind: supporters are ``all_supporters``
    if it is there and no ``reaction_senders`` are, opposers also ``reaction_opposers``.
    Blank reactors count for nobody.
    """
    some = lambda c: F.size(F.coalesce(c, F.array())) > 0
    old = F.col("message_reactions").isNull()
    whole = old & some("all_supporters") & ~some("reaction_senders")
    part = lambda users, name, stated: F.struct(users.alias("users"), F.lit(name).alias("side"), F.lit(stated).alias("stated"))
    # one read of the audit for all of them
    parts = F.array(
        part(F.when(~whole, F.col("supporting_senders")), "supporter", True),
        part(F.when(whole, F.col("all_supporters")), "supporter", False),
        part(F.col("opposing_senders"), "opposer", True),
        part(F.when(old, F.col("reaction_opposers")), "opposer", False),
    )
    named = audit.select("claim_id", F.explode(parts).alias("p")).select("claim_id", F.explode("p.users").alias("user"), "p.side", "p.stated", F.lit(False).alias("reacted"))
    reacted = _reactions(audit).where("sentiment <> 'neutral'").select(
        "claim_id", F.explode("senders").alias("user"), F.when(F.col("sentiment") == "positive", "supporter").otherwise("opposer").alias("side"),
        F.lit(False).alias("stated"), F.lit(True).alias("reacted"),
    ).where("user <> ''")
    both = named.unionByName(reacted).where("user is not null")
    return both.groupBy("claim_id", "user", "side").agg(F.max("stated").alias("stated"), F.max("reacted").alias("reacted"))


def engagement_of_claims(claims: DataFrame, audit: DataFrame) -> DataFrame:
    """(claim_id, supporter_count, opposer_count) of each claim; supporters are at least 1, known or not."""
    n = lambda s: F.sum((F.col("side") == s).cast("bigint"))
    people = participants(audit).groupBy("claim_id").agg(n("supporter").alias("s"), n("opposer").alias("o"))
    return claims.select("claim_id").join(people, "claim_id", "left").select(
        "claim_id", F.greatest(F.lit(1).cast("bigint"), F.coalesce("s", F.lit(1))).alias("supporter_count"), F.coalesce("o", F.lit(0).cast("bigint")).alias("opposer_count")
    )


def engagement_of_groups(citations: DataFrame, audit: DataFrame, key: str, floor: str = "each") -> DataFrame:
    """(key, supporter_count, opposer_count): distinct people over the claims that a key cites.

    With ``floor="each"`` a key has at least one supporter as soon as it cites a claim, known or
    not; with ``floor="none"`` the count of known people stands, and 1 only where none are known.
    The two differ in nothing else; a key that cites no claim (null) has 0 either way.
    """
    cited = citations.select(key, "claim_id").distinct()
    people = cited.join(participants(audit), "claim_id").groupBy(key, "side", "user").agg(F.lit(1).alias("one")).groupBy(key)
    n = lambda s: F.sum((F.col("side") == s).cast("bigint"))
    known = people.agg(n("supporter").alias("s"), n("opposer").alias("o"))
    ids = cited.groupBy(key).agg(F.count("claim_id").alias("cited"))
    s = F.coalesce("s", F.lit(0).cast("bigint"))
    count = F.greatest(F.lit(1).cast("bigint"), s) if floor == "each" else F.when(s > 0, s).otherwise(1)
    return ids.join(known, key, "left").select(
        key, F.when(F.col("cited") > 0, count).otherwise(0).alias("supporter_count"), F.coalesce("o", F.lit(0).cast("bigint")).alias("opposer_count")
    )


def reaction_summaries(rows: DataFrame, audit: DataFrame, keys: list[str]) -> DataFrame:
    """Reactions by emoji over the claims of each key (keys, claim_id, ord), in the order first seen: an array of
    (emoji, count, sentiment). Senders are counted as often as they reacted; a reaction without an emoji is left out."""
    seen = rows.select(*keys, "claim_id", "ord").join(_reactions(audit).where("emoji <> ''"), "claim_id")
    by = seen.groupBy(*keys, "emoji", "sentiment").agg(F.sum(F.size("senders")).alias("count"), F.min(F.struct("ord", "pos")).alias("seen"))
    return by.groupBy(*keys).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("seen", "emoji", "count", "sentiment"))), lambda x: F.struct(x["emoji"].alias("emoji"), x["count"].alias("count"), x["sentiment"].alias("sentiment"))).alias("reaction_summary")
    )


def fold_members(claims: DataFrame, groups: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Claims without the folded members of manual groups, and (claim_id, member, pos): all members of each representative.

    ``groups`` has group_id, representative and claim_ids. Members that are no claims do not count; a
    group of fewer than two does nothing, and one whose representative is no member takes its first.
    Later groups of a representative replace earlier ones.
    """
    each = groups.select("group_id", "representative", F.posexplode("claim_ids").alias("pos", "member"))
    known = each.join(claims.select(F.col("claim_id").alias("member")).distinct(), "member", "left_semi")
    one = known.groupBy("group_id", "representative").agg(F.array_sort(F.collect_list(F.struct("pos", "member"))).alias("m")).where("size(m) > 1")
    rep = F.when(F.exists("m", lambda x: x["member"] == F.col("representative")), F.col("representative")).otherwise(F.element_at("m", 1)["member"])
    kept = one.select("group_id", rep.alias("claim_id"), F.explode("m").alias("x")).select("group_id", "claim_id", "x.member", "x.pos")
    gone = kept.where("member <> claim_id").select(F.col("member").alias("claim_id")).distinct()
    last = kept.groupBy("claim_id").agg(F.max("group_id").alias("group_id"))
    return claims.join(gone, "claim_id", "left_anti"), kept.join(last, ["claim_id", "group_id"], "left_semi").select("claim_id", "member", "pos")


def expanded(clustered: DataFrame, claims: DataFrame, members: DataFrame) -> DataFrame:
    """Rows of clusters (keys, claim_id, ord, is_medoid) with the folded members beside their representative.

    A claim is once in a cluster, at its first place. Columns: those of ``clustered`` and of ``claims``.
    """
    keys = [c for c in clustered.columns if c not in ("claim_id", "ord", "is_medoid")]
    m = members.select(F.col("claim_id").alias("of"), "member", "pos")
    rows = clustered.join(m, clustered["claim_id"] == m["of"], "left").select(
        *keys, F.coalesce("member", "claim_id").alias("claim_id"), F.struct("ord", F.coalesce("pos", F.lit(-1)).alias("pos")).alias("ord"), (F.col("is_medoid") & (F.coalesce("member", "claim_id") == F.col("claim_id"))).alias("is_medoid")
    )
    first = rows.groupBy(*keys, "claim_id").agg(F.min("ord").alias("ord"), F.max("is_medoid").alias("is_medoid"))
    own = [c for c in claims.columns if c not in (*keys, "ord", "is_medoid", "claim_id")]
    return first.join(claims.select("claim_id", *own), "claim_id")


def merge_records(rows: DataFrame, audit: DataFrame, keys: list[str]) -> DataFrame:
    """One record a cluster. ``rows`` has the keys, claim_id, ord (of any type), is_medoid, claim_text, stance,
    thread_id, date, entities, support_count and redactions; a claim is once in a cluster.

    Measures: claim_text (the medoid's), variants and source_claim_ids (in order), stance (the
    most frequent, of equals the first seen) and stance_breakdown, support_count (distinct
    people, or the sum of the claims' own counts where nobody is known), statement_count,
    reaction_endorser_count, reaction_only_count, reaction_summary, endorsement_count (claims),
    thread_count, date_range, entities, pii_redactions and pii_needs_review.
    """
    stance = F.coalesce("stance", F.lit("neutral"))
    ordered = lambda c: F.transform(F.array_sort(F.collect_list(F.struct("ord", "claim_id", F.col(c).alias("v")))), lambda x: x["v"])
    base = rows.groupBy(*keys).agg(
        F.min_by("claim_text", F.struct(~F.col("is_medoid"), F.col("ord"), F.col("claim_id"))).alias("claim_text"),
        ordered("claim_text").alias("variants"), ordered("claim_id").alias("source_claim_ids"),
        F.count(F.lit(1)).alias("endorsement_count"), F.sum(F.coalesce("support_count", F.lit(1))).alias("own_support"),
        F.count_distinct("thread_id").alias("thread_count"), F.array(F.min("date"), F.max("date")).alias("date_range"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.coalesce("entities", F.array().cast("array<string>")))))).alias("entities"),
        F.flatten(ordered("redactions")).alias("pii_redactions"),
    )
    moods = rows.groupBy(*keys, stance.alias("stance")).agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("ord", "claim_id")).alias("first"))
    # the least is the one with most claims, of equals the first seen
    mood = moods.groupBy(*keys).agg(
        F.min_by("stance", F.struct(-F.col("n"), F.col("first"))).alias("main_stance"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("stance", "n")))).alias("stance_breakdown")
    )
    people = rows.select(*keys, "claim_id").join(participants(audit).where("side = 'supporter'"), "claim_id").groupBy(*keys, "user").agg(F.max("stated").alias("stated"), F.max("reacted").alias("reacted"))
    n = lambda c: F.sum(c.cast("bigint"))
    known = people.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("known"), n(F.col("stated")).alias("statement_count"), n(F.col("reacted")).alias("reaction_endorser_count"),
        n(F.col("reacted") & ~F.col("stated")).alias("reaction_only_count"),
    )
    zero = lambda c: F.coalesce(c, F.lit(0).cast("bigint")).alias(c)
    none = F.array().cast("array<struct<emoji:string,count:bigint,sentiment:string>>")
    whole = base.join(mood, keys).join(known, keys, "left").join(reaction_summaries(rows, audit, keys), keys, "left")
    return whole.select(
        *keys, "claim_text", "variants", F.col("main_stance").alias("dominant_stance"), "stance_breakdown", F.coalesce("known", "own_support").alias("support_count"),
        zero("statement_count"), zero("reaction_endorser_count"), zero("reaction_only_count"), F.coalesce("reaction_summary", none).alias("reaction_summary"),
        "endorsement_count", "thread_count", "date_range", "entities", "source_claim_ids", F.coalesce("pii_redactions", F.array()).alias("pii_redactions"),
        (F.size(F.coalesce("pii_redactions", F.array())) > 0).alias("pii_needs_review"),
    )


def by_topic(claims: DataFrame) -> DataFrame:
    """A row for each topic that a claim names, as often as it names it; without topics the overview."""
    topics = F.when(F.size(F.coalesce("topics", F.array())) > 0, F.col("topics")).otherwise(F.array(F.lit(OVERVIEW)))
    return claims.withColumn("topic", F.explode(topics))


def merge_claims(
    claims: DataFrame, audit: DataFrame, vector: str, groups: DataFrame | None = None, threshold: float = 0.86, most: int = 8, together: float = 0.97
) -> DataFrame:
    """Near copies of a topic and stance clustered and merged: the records of ``merge_records`` by topic, stance and cluster.

    Claims of opposite stances never merge. ``groups`` are folded into their representatives
    beforehand, so a group lands where its representative does, and counted with all members.
    The clustered claims are stored, without vectors: each measure reads them, and none clusters again.
    """
    rest, members = fold_members(claims, groups) if groups is not None else (claims, None)
    rows = by_topic(rest).dropDuplicates(["topic", "claim_id"]).withColumn("stance", F.coalesce("stance", F.lit("neutral")))
    found = cluster_groups(rows, ["topic", "stance"], "claim_id", vector, 1 - threshold, most, 1 - together)
    found = found.join(claims.select("claim_id", "ord"), "claim_id").select("topic", "stance", "cluster", "claim_id", "ord", "is_medoid")
    if members is None:
        members = found.select("claim_id", F.col("claim_id").alias("member"), F.lit(0).alias("pos")).where("false")
    # the stance of a member counts for itself within its cluster
    keys = ["topic", "cluster_stance", "cluster"]
    whole = saved(expanded(found.withColumnRenamed("stance", "cluster_stance"), claims, members).select(*keys, *CLAIM))
    return merge_records(whole, audit, keys).withColumnRenamed("cluster_stance", "stance")


# -- reviews of merged groups (topic, key, claim_text, stance, support_count, endorsement_count, entities, date_range, source_claim_ids) --
def group_key(ids: Column, text: Column) -> Column:
    """A group's first claim, or a key of its text where it has none; the same in every run."""
    return F.coalesce(F.get(ids, F.lit(0)).cast("string"), F.concat(F.lit("anon:"), F.sha1(F.substring(F.coalesce(text, F.lit("")), 1, 48))))


def topic_stats(groups: DataFrame) -> DataFrame:
    """Counts of each topic from its groups as they stand after an edit: a group without claims counts as
    one, and both ends of its range count on the timeline."""
    n = F.when(F.size(F.coalesce("source_claim_ids", F.array())) > 0, F.size("source_claim_ids")).otherwise(1).cast("bigint")
    base = groups.groupBy("topic").agg(F.count(F.lit(1)).alias("merged_claim_count"), F.sum(n).alias("claim_count"))
    ends = groups.select("topic", F.explode("date_range").alias("date")).where("date is not null and date <> ''")
    months = ends.groupBy("topic", F.substring("date", 1, 7).alias("month")).agg(F.count(F.lit(1)).alias("n"))
    line = months.groupBy("topic").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("month", "n")))).alias("timeline"))
    span = ends.groupBy("topic").agg(F.min("date").alias("first_date"), F.max("date").alias("last_date"))
    return base.join(line, "topic", "left").join(span, "topic", "left")


def filter_sizes(groups: DataFrame, low: int | None = None, high: int | None = None) -> DataFrame:
    """Groups of a number of claims within limits; null counts as one."""
    size = F.coalesce("endorsement_count", F.lit(1))
    if low is not None:
        groups = groups.where(size >= low)
    return groups.where(size <= high) if high is not None else groups


def topics_with_groups(topics: DataFrame, groups: DataFrame, low: int | None = None, high: int | None = None) -> DataFrame:
    """Topics with the number of their groups within limits; those without are left out if there are limits."""
    n = filter_sizes(groups, low, high).groupBy(F.col("topic").alias("of")).agg(F.count(F.lit(1)).alias("group_count"))
    kind = "left" if low is None and high is None else "inner"
    return topics.join(n, topics["topic"] == n["of"], kind).drop("of").withColumn("group_count", F.coalesce("group_count", F.lit(0)))


def size_stats(groups: DataFrame) -> DataFrame:
    """Groups, claims, single claims and the largest group of each topic and of all (topic null)."""
    size = F.coalesce("endorsement_count", F.lit(1))
    return groups.withColumn("size", size).groupingSets([[F.col("topic")], []], "topic").agg(
        F.count(F.lit(1)).alias("group_count"), F.sum("size").cast("bigint").alias("source_claim_count"), F.sum((F.col("size") == 1).cast("bigint")).alias("singleton_count"), F.max("size").alias("max_cluster_size")
    )


def move_member(members: DataFrame, topic: str, claim_id, source: str, target: str) -> DataFrame:
    """(topic, key, claim_id, pos) with a claim at the end of another group of its topic; an emptied group is gone."""
    hit = (F.col("topic") == topic) & (F.col("key") == source) & (F.col("claim_id") == claim_id)
    last = F.max(F.when((F.col("topic") == topic) & (F.col("key") == target), F.col("pos"))).over(Window.partitionBy("topic"))
    return members.withColumn("_last", last).select(
        "topic", F.when(hit, F.lit(target)).otherwise(F.col("key")).alias("key"), "claim_id", F.when(hit, F.col("_last") + 1).otherwise(F.col("pos")).alias("pos")
    )


def split_group(members: DataFrame, topic: str, key: str, claim_ids: list, new_key: str) -> DataFrame:
    """Some claims of a group as a group of their own, in the order given; at least one has to stay."""
    inside = members.where((F.col("topic") == topic) & (F.col("key") == key))
    found = inside.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("claim_id").isin(*claim_ids).cast("int")).alias("hit")).first()
    if not claim_ids or (found.hit or 0) != len(set(claim_ids)):
        raise ValueError("the claims are no part of the group")
    if found.hit == found.n:
        raise ValueError("a group has to keep a claim")
    hit = (F.col("topic") == topic) & (F.col("key") == key) & F.col("claim_id").isin(*claim_ids)
    place = F.array_position(F.array(*map(F.lit, claim_ids)), F.col("claim_id")) - 1
    return members.select("topic", F.when(hit, F.lit(new_key)).otherwise(F.col("key")).alias("key"), "claim_id", F.when(hit, place).otherwise(F.col("pos")).cast("bigint").alias("pos"))


def representatives(members: DataFrame, claims: DataFrame, chosen: DataFrame) -> DataFrame:
    """(topic, key, claim_text): the chosen text of each group if a member still has it, else its first member's.

    ``chosen`` has topic, key and claim_text.
    """
    rows = members.join(claims.select("claim_id", "claim_text"), "claim_id")
    want = chosen.select("topic", "key", F.col("claim_text").alias("wanted"))
    return rows.join(want, ["topic", "key"], "left").groupBy("topic", "key").agg(
        F.min_by("claim_text", F.struct(~F.coalesce(F.col("claim_text") == F.col("wanted"), F.lit(False)), "pos")).alias("claim_text")
    )


GROUP_SORTS = {"support": "support_count", "size": "endorsement_count"}


def member_rows(groups: DataFrame, claims: DataFrame) -> DataFrame:
    """(topic, key, pos, claim_id, claim_text, is_representative): the claims of each group; those with the group's text represent it."""
    each = groups.select("topic", "key", F.col("claim_text").alias("shown"), F.posexplode("source_claim_ids").alias("pos", "claim_id"))
    rows = each.join(claims.select("claim_id", "claim_text"), "claim_id")
    return rows.select("topic", "key", "pos", "claim_id", "claim_text", (F.col("claim_text") == F.col("shown")).alias("is_representative"))
