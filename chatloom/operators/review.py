"""Reads and edits of the review tools: threads, redactions, entities and manual groups.

Rows keep the order ``ord`` where the order of equals matters. Edits give new tables and
raise ValueError for what the tools refuse; each check reads no more than a count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import REDACTION_MARK, duration_seconds, restore
from .contacts import CONTACT, KINDS

NONE = "array<string>"
SPLIT_ID = r"^(.*)-split-\d+$"


# -- threads -------------------------------------------------------------------
def enrich_threads(threads: DataFrame, classified: DataFrame) -> DataFrame:
    """Threads with duration and class. Without a class they are neither knowledge nor useless."""
    known = classified.select("thread_id", F.coalesce("is_knowledge_bearing", F.lit(False)).alias("is_knowledge_bearing"), "topic_tags", "reason", F.lit(True).alias("has_classification"))
    rows = threads.select("thread_id", "ord", "start_time", "last_time", "num_messages", "num_unique_senders").join(known, "thread_id", "left")
    has = F.coalesce("has_classification", F.lit(False))
    return rows.withColumns({
        "duration_sec": duration_seconds(F.col("start_time"), F.col("last_time")), "has_classification": has, "is_useless": has & ~F.coalesce("is_knowledge_bearing", F.lit(False)),
        "topic_tags": F.coalesce("topic_tags", F.array().cast(NONE)), "reason": F.coalesce("reason", F.lit("")),
    })


SORTS = {"num_messages": "num_messages", "participants": "num_unique_senders", "start_time": "start_time", "duration": "duration_sec"}


def sort_order(sort: str, descending: bool = True, sorts: dict[str, str] = SORTS) -> list[Column]:
    """Sort columns; equals keep their own order in both directions."""
    c = F.col(sorts[sort])
    return [c.desc() if descending else c.asc(), F.col("ord")]


def in_month(rows: DataFrame, month: str, ts: str = "start_time") -> DataFrame:
    """Rows of a month, or of all that begin as ``month`` does (a year)."""
    return rows.where(F.startswith(F.date_format(ts, "yyyy-MM-dd"), F.lit(month)))


def family(ids: Column) -> Column:
    """The id that all parts of a split thread share."""
    base = F.regexp_extract(ids, SPLIT_ID, 1)
    return F.when(base != "", base).otherwise(ids)


def split_families(threads: DataFrame) -> DataFrame:
    """(family, thread_id, position): the parts of each thread in order of time, a thread that was never split alone."""
    rows = threads.withColumn("family", family(F.col("thread_id")))
    order = Window.partitionBy("family").orderBy("start_time", "last_time", "thread_id")
    return rows.select("family", "thread_id", F.row_number().over(order).alias("position"))


def message_context(threads: DataFrame) -> DataFrame:
    """(thread_id, prev_id, next_id): the neighbours in time of each thread of a chat (chat_id).

    A neighbour of the same split family is null, and none further off takes its place. Neighbours
    are sought within a chat, so a very long archive is cut into its chats.
    """
    order = Window.partitionBy("chat_id").orderBy("start_time", "thread_id")
    own = family(F.col("thread_id"))
    rows = threads.select("chat_id", "thread_id", F.lag("thread_id").over(order).alias("prev_id"), F.lead("thread_id").over(order).alias("next_id"))
    other = lambda c: F.when(family(F.col(c)) != own, F.col(c)).alias(c)
    return rows.select("thread_id", other("prev_id"), other("next_id"))


def checked_ranges(cuts: DataFrame, sizes: DataFrame) -> DataFrame:
    """Ranges (thread_id, low, high) of threads that do not cut them into parts without a gap or an
    overlap, with what is wrong. ``sizes`` has thread_id and n; positions count from 0, both ends are inside."""
    order = Window.partitionBy("thread_id").orderBy("low", "high")
    rows = cuts.join(sizes, "thread_id", "left").select(
        "thread_id", "low", "high", "n", F.coalesce(F.lag("high").over(order) + 1, F.lit(0)).alias("due"), F.lead("low").over(order).alias("after")
    )
    wrong = (
        F.when(F.col("n").isNull(), "unknown thread").when(F.col("low") > F.col("high"), "empty range").when(F.col("low") < F.col("due"), "overlap")
        .when(F.col("low") > F.col("due"), "gap").when(F.col("after").isNull() & (F.col("high") != F.col("n") - 1), "end")
    )
    return rows.select("thread_id", "low", "high", wrong.alias("wrong")).where("wrong is not null")


def inherited_class(classified: DataFrame, moves: DataFrame) -> DataFrame:
    """Classes after threads were merged or split: ``moves`` (old_id, new_id, ord) names each new thread's
    sources. It takes the class of the survivor (its own id) if that is a source, else of the first that has one."""
    rows = moves.join(classified.withColumnRenamed("thread_id", "old_id"), "old_id")
    order = Window.partitionBy("new_id").orderBy((F.col("old_id") != F.col("new_id")).cast("int"), "ord", "old_id")
    first = rows.withColumn("_n", F.row_number().over(order)).where("_n = 1")
    kept = classified.join(moves.select(F.col("old_id").alias("thread_id")).distinct(), "thread_id", "left_anti")
    own = [c for c in classified.columns if c != "thread_id"]
    return kept.unionByName(first.select(F.col("new_id").alias("thread_id"), *own))


def thread_meta(threads: DataFrame, classified: DataFrame) -> DataFrame:
    """One row: threads, messages, classes, knowledge, and classes of threads that are no more."""
    t = threads.agg(F.count(F.lit(1)).alias("threads"), F.coalesce(F.sum("num_messages"), F.lit(0)).cast("bigint").alias("messages"))
    c = classified.agg(F.count(F.lit(1)).alias("classes"), F.coalesce(F.sum(F.coalesce("is_knowledge_bearing", F.lit(False)).cast("bigint")), F.lit(0)).alias("knowledge"))
    stale = classified.join(threads.select("thread_id"), "thread_id", "left_anti").agg(F.count(F.lit(1)).alias("stale"))
    # one row each
    return t.join(F.broadcast(c)).join(F.broadcast(stale))


def restructured(messages: DataFrame, classified: DataFrame, moves: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Threads and classes after messages (thread_id, idx, ts, sender, reactions) were given new threads.

    Threads are summed up again, those who only reacted among the participants, and numbered in order of
    time; classes follow ``moves`` as in ``inherited_class``, those of threads that are no more are left out.
    """
    from .sequences import thread_summary

    threads = thread_summary(messages, reactors=True)
    # a row a thread
    threads = threads.withColumn("ord", F.row_number().over(Window.orderBy("start_time", "thread_id")) - 1)
    classes = inherited_class(classified, moves).join(threads.select("thread_id", F.col("ord").alias("thread_ord")), "thread_id")
    return threads, classes


def shown_threads(context: DataFrame, families: DataFrame) -> DataFrame:
    """(thread_id, shown_id, position): what is shown beside a thread: the one before, its split family in order of time, the one after, each once."""
    side = lambda c, at: context.select("thread_id", F.col(c).alias("shown_id"), F.lit(at).alias("part"), F.lit(0).alias("place")).where("shown_id is not null")
    own = families.select("family", F.col("thread_id").alias("shown_id"), F.col("position").alias("place"))
    kin = families.select("family", "thread_id").join(own, "family").select("thread_id", "shown_id", F.lit(1).alias("part"), "place")
    rows = side("prev_id", 0).unionByName(kin).unionByName(side("next_id", 2))
    first = rows.groupBy("thread_id", "shown_id").agg(F.min(F.struct("part", "place")).alias("at"))
    return first.select("thread_id", "shown_id", F.row_number().over(Window.partitionBy("thread_id").orderBy("at", "shown_id")).alias("position"))


# -- redactions (claim_id, claim_text, redactions, pii_review) --------------------
def _pending() -> Column:
    return F.size(F.coalesce("redactions", F.array())) > 0


def review_status() -> Column:
    """pending while there are redactions, else what was decided, else empty."""
    return F.when(_pending(), "pending").otherwise(F.coalesce("pii_review", F.lit("")))


def redaction_note(redactions: Column) -> Column:
    """Counts by kind in the order of kinds, as ``email: 2, phone: 1``."""
    kinds = F.array_sort(F.array_distinct(F.transform(redactions, lambda r: r["type"])))
    return F.array_join(F.transform(kinds, lambda k: F.concat(k, F.lit(": "), F.size(F.filter(redactions, lambda r: r["type"] == k)).cast("string"))), ", ")


def review_items(claims: DataFrame, kind: str = "pending") -> DataFrame:
    """Claims with redactions or a decision, of one status (``pending``, ``reviewed``) or ``all``, with the text as it was."""
    rows = claims.withColumn("review_status", review_status()).where("review_status <> ''")
    if kind == "pending":
        rows = rows.where("review_status = 'pending'")
    elif kind == "reviewed":
        rows = rows.where("review_status in ('accepted', 'restored')")
    redactions = F.coalesce("redactions", F.array().cast("array<struct<type:string,value:string>>"))
    return rows.withColumns({
        "original_text": F.when(_pending(), restore(F.col("claim_text"), redactions)).otherwise(F.col("claim_text")), "redaction_summary": redaction_note(redactions),
        "n_redactions": F.size(redactions), "has_redaction_mark": F.contains("claim_text", F.lit(REDACTION_MARK)),
    })


REVIEW_SORTS = {"claim_id": "claim_id", "thread_id": "thread_id", "date": "date", "redactions": "n_redactions"}


def settle_redactions(claims: DataFrame, decisions: DataFrame) -> DataFrame:
    """Claims after decisions (claim_id, decision ``accept`` or ``restore``): accepted ones keep their marks, restored ones
    get their text back; the list of redactions goes. Claims without redactions stay as they are."""
    want = decisions.select(F.col("claim_id").alias("_of"), "decision").dropDuplicates(["_of"])
    rows = claims.join(want, claims["claim_id"] == want["_of"], "left")
    due = _pending() & F.col("decision").isNotNull()
    back = due & (F.col("decision") == "restore")
    return rows.withColumn("_due", due).withColumns({
        "claim_text": F.when(back, restore(F.col("claim_text"), F.col("redactions"))).otherwise(F.col("claim_text")),
        "pii_review": F.when(back, "restored").when(F.col("_due"), "accepted").otherwise(F.col("pii_review")),
    }).withColumn("redactions", F.when(~F.col("_due"), F.col("redactions"))).drop("_of", "decision", "_due")


def review_counts(claims: DataFrame) -> DataFrame:
    """One row: claims by status, all that were ever flagged, and pending redactions by kind."""
    status = review_status()
    n = lambda s: F.coalesce(F.sum((status == s).cast("bigint")), F.lit(0)).alias(s)
    sums = claims.agg(n("pending"), n("accepted"), n("restored"))
    kinds = claims.select(F.explode("redactions").alias("r")).groupBy(F.col("r.type").alias("type")).agg(F.count(F.lit(1)).alias("n"))
    by = kinds.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("type", "n")))).alias("pending_by_type"))
    # one row
    return sums.withColumn("total_flagged", F.col("pending") + F.col("accepted") + F.col("restored")).join(F.broadcast(by))


# -- entities (entity_id, canonical_name, status, contacts_manual, contacts, ...; members: entity_id, name, claim_ids, ...) --
def entity_counts(entities: DataFrame, members: DataFrame) -> DataFrame:
    """(what, value, n): entities by status and by number of members, all of them, and those of several members."""
    size = members.groupBy("entity_id").agg(F.count(F.lit(1)).alias("size"))
    rows = entities.join(size, "entity_id", "left").select(F.coalesce("status", F.lit("suggested")).alias("status"), F.coalesce("size", F.lit(0)).alias("size"))
    # one pass: each entity gives a row a measure
    each = F.array(
        F.struct(F.lit("status").alias("what"), F.col("status").alias("value")), F.struct(F.lit("size").alias("what"), F.col("size").cast("string").alias("value")),
        F.struct(F.lit("all").alias("what"), F.lit("").alias("value")), F.struct(F.when(F.col("size") > 1, "multi_member").alias("what"), F.lit("").alias("value")),
    )
    return rows.select(F.explode(each).alias("e")).where("e.what is not null").groupBy("e.what", "e.value").agg(F.count(F.lit(1)).alias("n"))


def recomputed(entities: DataFrame, members: DataFrame) -> DataFrame:
    """Entities after an edit of their members (entity_id, ord, name, count, topics, contacts, contacts_uncertain).

    Aliases are the members, the most frequent first; contacts are theirs unless set by hand;
    unsure ones that are sure are left out; a canonical name that is no member's gives way to the first.
    """
    none = F.array().cast(CONTACT)
    union = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.coalesce(c, none)))))
    sums = members.groupBy(F.col("entity_id").alias("_of")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct((-F.coalesce("count", F.lit(0))).alias("c"), "ord", "name"))), lambda x: x["name"]).alias("_names"),
        union("contacts").alias("_sure"), union("contacts_uncertain").alias("_unsure"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("topics")))).alias("_topics"),
        F.sum(F.coalesce("count", F.lit(0))).alias("_total"),
    )
    rows = entities.join(sums, entities["entity_id"] == sums["_of"], "left")
    names = F.coalesce("_names", F.array().cast(NONE))
    sure = F.when(F.coalesce("contacts_manual", F.lit(False)), F.col("contacts")).otherwise(F.coalesce("_sure", none))
    own = F.when((F.size(names) > 0) & ~F.array_contains(names, F.col("canonical_name")), F.element_at(names, 1)).otherwise(F.col("canonical_name"))
    keep = [c for c in entities.columns if c not in ("canonical_name", "aliases", "contacts", "contacts_uncertain", "topics", "member_total")]
    return rows.select(
        *keep, own.alias("canonical_name"), names.alias("aliases"), sure.alias("contacts"), F.array_except(F.coalesce("_unsure", none), F.coalesce(sure, none)).alias("contacts_uncertain"),
        F.coalesce("_topics", F.array().cast(NONE)).alias("topics"), F.coalesce("_total", F.lit(0)).alias("member_total"),
    )


def member_claims(members: DataFrame, tagged: DataFrame, mentioned: DataFrame, deleted: DataFrame) -> DataFrame:
    """(entity_id, name, claim_id): the claims of each member (entity_id, name, claim_ids, excluded_claim_ids).

    A list of its own counts; without one the claims that list the name (name, claim_id) or whose text has it;
    less those excluded for the member and those deleted.
    """
    listed = F.size(F.coalesce("claim_ids", F.array())) > 0
    own = members.where(listed).select("entity_id", "name", F.explode("claim_ids").alias("claim_id"))
    free = members.where(~listed).select("entity_id", "name")
    found = tagged.select("name", "claim_id").unionByName(mentioned.select("name", "claim_id")).distinct()
    every = own.unionByName(free.join(found, "name").select("entity_id", "name", "claim_id")).distinct()
    out = members.select("entity_id", "name", F.explode("excluded_claim_ids").alias("claim_id"))
    return every.join(out, ["entity_id", "name", "claim_id"], "left_anti").join(deleted.select("claim_id").distinct(), "claim_id", "left_anti")


def members_from_claims(member_claims_: DataFrame, claims: DataFrame, contacts: DataFrame, samples: int = 12) -> DataFrame:
    """Members made of their claims: count, the first claims, topics and contacts, which all count as sure."""
    rows = member_claims_.select("entity_id", "name", "claim_id")
    keys = ["entity_id", "name"]
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"), F.array_sort(F.collect_list("claim_id")).alias("claim_ids"))
    topics = rows.join(claims.select("claim_id", F.explode("topics").alias("t")), "claim_id").groupBy(*keys).agg(F.array_sort(F.collect_set("t")).alias("topics"))
    found = rows.join(contacts.select("claim_id", F.explode("contacts").alias("c")), "claim_id").groupBy(*keys).agg(F.array_sort(F.collect_set("c")).alias("contacts"))
    return counts.join(topics, keys, "left").join(found, keys, "left").select(
        *keys, "count", "claim_ids", F.slice("claim_ids", 1, samples).alias("sample_claim_ids"), F.coalesce("topics", F.array().cast(NONE)).alias("topics"), F.coalesce("contacts", F.array().cast(CONTACT)).alias("contacts")
    )


def merge_entities(entities: DataFrame, members: DataFrame, source, target) -> tuple[DataFrame, DataFrame]:
    """Entities and members with the source's members at the end of the target's; the source is gone."""
    if source == target:
        raise ValueError("source and target entity are the same")
    last = F.max(F.when(F.col("entity_id") == target, F.col("ord"))).over(Window.partitionBy((F.col("entity_id").isin(source, target)).cast("int")))
    moved = F.col("entity_id") == source
    rows = members.withColumn("_last", F.coalesce(last, F.lit(-1))).withColumns(
        {"ord": F.when(moved, F.col("_last") + 1 + F.col("ord")).otherwise(F.col("ord")), "entity_id": F.when(moved, F.lit(target)).otherwise(F.col("entity_id"))}
    )
    return entities.where(F.col("entity_id") != source), rows.drop("_last")


def split_entity(entities: DataFrame, members: DataFrame, tagged: DataFrame, entity_id) -> tuple[DataFrame, DataFrame]:
    """Entities and members after a suggested merge was turned down: each member has only the claims that list its
    name, and an entity of several members becomes one for each, numbered after the last (``e`` and four digits)."""
    own = tagged.groupBy(F.col("name").alias("_name")).agg(F.array_sort(F.collect_set("claim_id")).alias("_claims"))
    hit = F.col("entity_id") == entity_id
    rows = members.join(own, members["name"] == own["_name"], "left")
    kind = members.schema["claim_ids"].dataType
    rows = rows.withColumns({
        "claim_ids": F.when(hit, F.coalesce("_claims", F.array().cast(kind))).otherwise(F.col("claim_ids")),
        "excluded_claim_ids": F.when(hit, F.array().cast(kind)).otherwise(F.col("excluded_claim_ids")),
    }).drop("_name", "_claims")
    if members.where(hit).limit(2).count() < 2:
        return entities.withColumn("status", F.when(hit, "suggested").otherwise(F.col("status"))), rows
    number = F.regexp_extract("entity_id", r"^e(\d+)$", 1)
    last = entities.agg(F.coalesce(F.max(F.when(number != "", number.cast("int"))), F.lit(-1))).first()[0]
    # members of one entity
    at = F.row_number().over(Window.partitionBy(hit.cast("int")).orderBy(F.when(hit, F.col("ord")), "name"))
    rows = rows.withColumn("_at", F.when(hit, at))
    new_id = F.format_string("e%04d", F.col("_at") + last)
    fresh = rows.where("_at is not null").select(
        new_id.alias("entity_id"), F.col("name").alias("canonical_name"), F.lit("suggested").alias("status"), F.lit(False).alias("contacts_manual")
    )
    left = entities.where(~hit).unionByName(fresh, allowMissingColumns=True)
    moved = rows.withColumns({"entity_id": F.when(F.col("_at").isNotNull(), new_id).otherwise(F.col("entity_id")), "ord": F.when(F.col("_at").isNotNull(), 0).otherwise(F.col("ord"))})
    return left, moved.drop("_at")


ENTITY_SORTS = {"count": "member_total", "size": "n_members", "score": "score"}


def registry(entities: DataFrame, members: DataFrame) -> DataFrame:
    """Names and what they stand for, in the form that ``entities.resolve`` takes: ord, name, canonical, claim_id, topics.

    A member with claims of its own binds its name in these claims alone; of one name the
    last entity counts where nothing else decides.
    """
    rows = members.join(entities.select("entity_id", "canonical_name", F.col("ord").alias("entity_ord")), "entity_id")
    kind = members.schema["claim_ids"].dataType.elementType
    bound = rows.select(F.col("entity_ord").alias("ord"), "name", F.col("canonical_name").alias("canonical"), F.explode("claim_ids").alias("claim_id"), "topics")
    free = rows.select(F.col("entity_ord").alias("ord"), "name", F.col("canonical_name").alias("canonical"), F.lit(None).cast(kind).alias("claim_id"), "topics")
    return free.unionByName(bound)


def entity_highlights(own: DataFrame, others: DataFrame) -> DataFrame:
    """(claim_id, spans): what to mark in each claim: mentions (claim_id, name, start, end) of the entity itself before those of others."""
    from .entities import highlights

    pick = lambda df, mine: df.select("claim_id", "name", "start", "end", F.lit(mine).alias("own"))
    return highlights(pick(own, True).unionByName(pick(others, False)))


def by_category(rows: DataFrame, category: str = "category", locale: str = "he") -> DataFrame:
    """Rows with the place of their category in the order that readers of ``locale`` expect."""
    names = rows.select(category).distinct()
    place = F.row_number().over(Window.orderBy(F.collate(F.col(category), locale), category))
    # a row a category
    return rows.join(names.withColumn("category_place", place), category)


def rename_entity(entities: DataFrame, entity_id, name: str) -> DataFrame:
    if not name.strip():
        raise ValueError("a name must not be empty")
    return entities.withColumn("canonical_name", F.when(F.col("entity_id") == entity_id, F.lit(name.strip())).otherwise(F.col("canonical_name")))


def set_canonical(entities: DataFrame, members: DataFrame, entity_id, name: str) -> DataFrame:
    """An entity with the name of one of its members."""
    if not members.where((F.col("entity_id") == entity_id) & (F.col("name") == name)).limit(1).count():
        raise ValueError(f"name not a member of this entity: {name}")
    return rename_entity(entities, entity_id, name)


def set_contacts(entities: DataFrame, entity_id, contacts: dict[str, list[str]]) -> DataFrame:
    """An entity with contacts set by hand, which no later edit of its members changes; trimmed, blank ones left out, each once."""
    if set(contacts) - set(KINDS):
        raise ValueError(f"unknown kinds: {sorted(set(contacts) - set(KINDS))}")
    rows = [(k, v.strip()) for k in KINDS for v in dict.fromkeys(contacts.get(k, [])) if v.strip()]
    rows = list(dict.fromkeys(rows))
    value = F.array(*[F.struct(F.lit(k).alias("kind"), F.lit(v).alias("value")) for k, v in rows]).cast(CONTACT)
    hit = F.col("entity_id") == entity_id
    return entities.withColumns({"contacts": F.when(hit, value).otherwise(F.col("contacts")), "contacts_manual": F.when(hit, True).otherwise(F.col("contacts_manual"))})


# -- manual groups (group_id, representative, claim_ids) -----------------------------
def create_group(groups: DataFrame, claims: DataFrame, claim_ids: list, representative) -> DataFrame:
    """Groups and a new one, numbered after the last (``agg`` and four digits). It has at least two
    known claims, none of another group, and its representative is one of them."""
    ids = list(dict.fromkeys(claim_ids))
    if len(ids) < 2:
        raise ValueError("a group needs at least two claims")
    if representative not in ids:
        raise ValueError("the representative must be one of the claims")
    if claims.where(F.col("claim_id").isin(*ids)).select("claim_id").distinct().count() < len(ids):
        raise ValueError("unknown claims")
    if groups.where(F.arrays_overlap("claim_ids", F.array(*map(F.lit, ids)))).limit(1).count():
        raise ValueError("claims are of another group")
    number = F.regexp_extract("group_id", r"^agg(\d+)$", 1)
    last = groups.agg(F.coalesce(F.max(F.when(number != "", number.cast("int"))), F.lit(-1))).first()[0]
    new = groups.sparkSession.createDataFrame([(f"agg{last + 1:04d}", representative, ids)], groups.select("group_id", "representative", "claim_ids").schema)
    return groups.select("group_id", "representative", "claim_ids").unionByName(new)


def set_representative(groups: DataFrame, group_id: str, claim_id) -> DataFrame:
    hit = F.col("group_id") == group_id
    if not groups.where(hit & F.array_contains("claim_ids", claim_id)).limit(1).count():
        raise ValueError("the representative must be one of the claims")
    return groups.withColumn("representative", F.when(hit, F.lit(claim_id)).otherwise(F.col("representative")))


def without_claims(groups: DataFrame, gone: DataFrame) -> DataFrame:
    """Groups without deleted claims (claim_id); one of fewer than two is gone, and one that lost its representative takes its first."""
    each = groups.select("group_id", "representative", F.posexplode("claim_ids").alias("pos", "claim_id"))
    left = each.join(gone.select("claim_id").distinct(), "claim_id", "left_anti").groupBy("group_id", "representative").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "claim_id"))), lambda x: x["claim_id"]).alias("claim_ids")
    )
    return left.where("size(claim_ids) > 1").select(
        "group_id", F.when(F.array_contains("claim_ids", F.col("representative")), F.col("representative")).otherwise(F.element_at("claim_ids", 1)).alias("representative"), "claim_ids"
    )
