"""Registered queries of classification, merging, contacts, plans and reviews, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import classify, contacts, merge, plan, review, sequences
from . import adapters as A
from .catalog import query


def text(c: str):
    """An array as one string."""
    return F.array_join(F.transform(c, lambda x: x.cast("string")), ",").alias(c)


# -- the people behind claims ----------------------------------------------
# documents are claims; their authors are eleven users, and events are reactions to them
_EMOJI = (("purchase", "👍"), ("click", "👍🏻"), ("error", "👎"), ("view", "🤔"), ("signup", ""))
_EMOJI_SQL = "CASE event_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in _EMOJI) + " END"
_AUDIT = f"""au AS (
  SELECT doc_id AS claim_id, ['u' || (doc_id % 11), 'u' || (doc_id % 5)] AS sup, CASE WHEN doc_id % 4 = 0 THEN ['u' || (doc_id % 7)] ELSE [] END AS opp,
    doc_id % 6 = 5 AS old, CASE WHEN doc_id % 12 = 5 THEN ['u1', 'u99'] ELSE [] END AS every, CASE WHEN doc_id % 12 = 11 THEN ['u98'] ELSE [] END AS against FROM documents),
rx AS (
  SELECT event_id % (SELECT count(*) FROM documents) AS claim_id, event_id AS pos, {_EMOJI_SQL} AS emoji, 'u' || user_id AS usr,
    CASE event_type WHEN 'purchase' THEN 'positive' WHEN 'click' THEN 'positive' WHEN 'error' THEN 'negative' ELSE 'neutral' END AS mood FROM events),
rxn AS (SELECT rx.* FROM rx JOIN au USING (claim_id) WHERE NOT old),
ppl AS (
  SELECT claim_id, usr, side, bool_or(stated) AS stated, bool_or(reacted) AS reacted FROM (
    SELECT claim_id, unnest(sup) AS usr, 'supporter' AS side, true AS stated, false AS reacted FROM au WHERE len(every) = 0
    UNION ALL SELECT claim_id, unnest(every), 'supporter', false, false FROM au
    UNION ALL SELECT claim_id, unnest(opp), 'opposer', true, false FROM au UNION ALL SELECT claim_id, unnest(against), 'opposer', false, false FROM au
    UNION ALL SELECT claim_id, usr, CASE mood WHEN 'positive' THEN 'supporter' ELSE 'opposer' END, false, true FROM rxn WHERE mood <> 'neutral') GROUP BY ALL)"""


def _audit(spark, sf_dir):
    d = A.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("claim_id"))
    n = d.count()
    e = A.table(spark, sf_dir, "events")
    emoji = F.create_map(*[F.lit(x) for pair in _EMOJI for x in pair])[F.col("event_type")]
    rx = e.select(F.pmod("event_id", F.lit(n)).alias("claim_id"), "event_id", F.struct(emoji.alias("emoji"), F.array(F.concat(F.lit("u"), "user_id"), F.lit("")).alias("senders")).alias("r"))
    rx = rx.groupBy("claim_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("event_id", "r"))), lambda x: x["r"]).alias("reactions"))
    user = lambda k: F.concat(F.lit("u"), (F.col("claim_id") % k).cast("string"))
    none = F.array().cast("array<string>")
    old = F.col("claim_id") % 6 == 5
    kinds = rx.schema["reactions"].dataType
    return d.join(rx, "claim_id", "left").select(
        "claim_id", F.array(user(11), user(5)).alias("supporting_senders"), F.when(F.col("claim_id") % 4 == 0, F.array(user(7))).otherwise(none).alias("opposing_senders"),
        F.when(~old, F.coalesce("reactions", F.array().cast(kinds))).alias("message_reactions"),
        F.when(F.col("claim_id") % 12 == 5, F.array(F.lit("u1"), F.lit("u99"))).otherwise(none).alias("all_supporters"), none.alias("reaction_senders"),
        F.when(F.col("claim_id") % 12 == 11, F.array(F.lit("u98"))).otherwise(none).alias("reaction_opposers"),
    )


@query(f"WITH {_AUDIT} SELECT * FROM ppl")
def participants(spark, sf_dir):
    return merge.participants(_audit(spark, sf_dir)).withColumnRenamed("user", "usr")


@query(f"""WITH {_AUDIT}, s AS (SELECT claim_id, count(*) FILTER (side = 'supporter') AS s, count(*) FILTER (side = 'opposer') AS o FROM ppl GROUP BY claim_id)
SELECT au.claim_id, CAST(greatest(1, coalesce(s, 1)) AS BIGINT) AS supporter_count, coalesce(o, 0) AS opposer_count FROM au LEFT JOIN s USING (claim_id)""")
def claim_engagement(spark, sf_dir):
    audit = _audit(spark, sf_dir)
    return merge.engagement_of_claims(audit, audit)


_GROUPS = """, s AS (SELECT claim_id // 50 AS grp, count(DISTINCT usr) FILTER (side = 'supporter' AND claim_id % 50 < 25) AS s, count(DISTINCT usr) FILTER (side = 'opposer' AND claim_id % 50 < 25) AS o
  FROM ppl WHERE claim_id % 6 <> 5 GROUP BY ALL) SELECT grp, CAST({} AS BIGINT) AS supporter_count, o AS opposer_count FROM s"""


def _cited(spark, sf_dir):
    """Groups of fifty claims cite their first half; those of the older kind have no known people here."""
    audit = _audit(spark, sf_dir).where("claim_id % 6 <> 5")
    cited = audit.select(F.floor(F.col("claim_id") / 50).alias("grp"), F.when(F.col("claim_id") % 50 < 25, F.col("claim_id")).alias("claim_id"))
    return cited, audit


@query(f"WITH {_AUDIT}{_GROUPS.format('greatest(1, s)')}")
def group_engagement(spark, sf_dir):
    return merge.engagement_of_groups(*_cited(spark, sf_dir), "grp")


@query(f"WITH {_AUDIT}{_GROUPS.format('CASE WHEN s > 0 THEN s ELSE 1 END')}")
def group_engagement_known(spark, sf_dir):
    return merge.engagement_of_groups(*_cited(spark, sf_dir), "grp", "none")


# -- merged claims -----------------------------------------------------------
_MERGED = f"""WITH {A.CLM}, {_AUDIT},
k AS (SELECT *, source AS topic, min(claim_id) OVER (PARTITION BY source, claim_text) AS cluster FROM clm),
b AS (
  SELECT topic, cluster, md5(arg_min(claim_text, claim_id)) AS text_md5, count(*) AS endorsement_count, CAST(sum(support_count) AS BIGINT) AS own, count(DISTINCT thread_id) AS thread_count,
    min(month) || ',' || max(month) AS date_range, array_to_string(list_sort(list(DISTINCT lang)), ',') AS entities, string_agg(claim_id, ',' ORDER BY claim_id) AS source_claim_ids,
    string_agg(md5(claim_text), ',' ORDER BY claim_id) AS variants, count(*) FILTER (claim_id % 3 = 0) AS n_redactions FROM k GROUP BY ALL),
st AS (SELECT topic, cluster, stance, count(*) AS n, min(claim_id) AS f FROM k GROUP BY ALL),
sx AS (SELECT topic, cluster, arg_min(stance, (-n, f)) AS dominant_stance, string_agg(stance || ':' || n, ',' ORDER BY stance) AS stance_breakdown FROM st GROUP BY ALL),
pu AS (SELECT topic, cluster, usr, bool_or(stated) AS stated, bool_or(reacted) AS reacted FROM k JOIN ppl USING (claim_id) WHERE side = 'supporter' GROUP BY ALL),
pc AS (SELECT topic, cluster, count(*) AS known, count(*) FILTER (stated) AS sc, count(*) FILTER (reacted) AS re, count(*) FILTER (reacted AND NOT stated) AS ro FROM pu GROUP BY ALL),
ry AS (SELECT topic, cluster, emoji, any_value(mood) AS mood, 2 * count(*) AS n, min((k.claim_id, pos)) AS seen FROM k JOIN rxn ON rxn.claim_id = k.claim_id WHERE emoji <> '' GROUP BY ALL),
rs AS (SELECT topic, cluster, string_agg(emoji || ':' || n || ':' || mood, ',' ORDER BY seen) AS reaction_summary FROM ry GROUP BY ALL)
SELECT b.topic, b.cluster, text_md5, variants, dominant_stance, stance_breakdown, coalesce(known, own) AS support_count, coalesce(sc, 0) AS statement_count, coalesce(re, 0) AS reaction_endorser_count,
  coalesce(ro, 0) AS reaction_only_count, coalesce(reaction_summary, '') AS reaction_summary, endorsement_count, thread_count, date_range, entities, source_claim_ids,
  CAST(n_redactions AS INTEGER) AS n_redactions, n_redactions > 0 AS pii_needs_review
FROM b JOIN sx USING (topic, cluster) LEFT JOIN pc USING (topic, cluster) LEFT JOIN rs USING (topic, cluster)"""


def _merged(spark, sf_dir):
    c = A.claims(spark, sf_dir).withColumn("topic", F.col("source"))
    first = c.groupBy("topic", "claim_text").agg(F.min("claim_id").alias("cluster"))
    redactions = F.when(F.col("claim_id") % 3 == 0, F.array(F.struct(F.lit("email").alias("type"), F.lit("a@b.org").alias("value"))))
    rows = c.join(first, ["topic", "claim_text"]).select(
        "topic", "cluster", "claim_id", F.col("claim_id").alias("ord"), (F.col("claim_id") == F.col("cluster")).alias("is_medoid"), "claim_text", "stance", "thread_id",
        F.col("month").alias("date"), F.array("lang").alias("entities"), "support_count", F.coalesce(redactions, F.array().cast("array<struct<type:string,value:string>>")).alias("redactions"),
    )
    return merge.merge_records(rows, _audit(spark, sf_dir), ["topic", "cluster"])


@query(_MERGED)
def merged_records(spark, sf_dir):
    join = lambda c, f: F.array_join(F.transform(c, f), ",").alias(c)
    return _merged(spark, sf_dir).select(
        "topic", "cluster", F.md5(F.col("claim_text").cast("binary")).alias("text_md5"), join("variants", lambda x: F.md5(x.cast("binary"))), "dominant_stance",
        F.array_join(F.transform(F.map_entries("stance_breakdown"), lambda x: F.concat_ws(":", x["key"], x["value"].cast("string"))), ",").alias("stance_breakdown"), "support_count", "statement_count",
        "reaction_endorser_count", "reaction_only_count", join("reaction_summary", lambda x: F.concat_ws(":", x["emoji"], x["count"].cast("string"), x["sentiment"])), "endorsement_count",
        "thread_count", text("date_range"), text("entities"), text("source_claim_ids"), F.size("pii_redactions").alias("n_redactions"), "pii_needs_review",
    )


@query()
def stance_clusters(spark, sf_dir):
    """Vectors as claims of two topics and two stances, with a manual group; clustered, merged and counted at once."""
    v = A.vectors(spark, sf_dir)
    key = F.col("vec_id")
    c = v.select(
        key.alias("claim_id"), key.alias("ord"), F.concat(F.lit("claim "), key.cast("string")).alias("claim_text"), F.array(F.concat(F.lit("t"), F.col("label").cast("string"))).alias("topics"),
        F.when(key % 2 == 0, "positive").otherwise("negative").alias("stance"), (key % 9).alias("thread_id"), F.lit("2024-01").alias("date"), F.array(F.lit("x")).alias("entities"),
        F.lit(1).alias("support_count"), F.array().cast("array<struct<type:string,value:string>>").alias("redactions"), "embedding",
    )
    groups = c.agg(F.min("claim_id").alias("representative"), F.array(F.min("claim_id"), F.max("claim_id")).alias("claim_ids")).select(F.lit("agg0000").alias("group_id"), "representative", "claim_ids")
    return merge.merge_claims(c, _audit(spark, sf_dir), "embedding", groups, 0.3)


_GRP = f"""WITH {A.CLM}, g AS (SELECT source AS topic, min(claim_id) AS ord, array_agg(claim_id ORDER BY claim_id) AS ids, count(*) AS size, CAST(sum(support_count) AS BIGINT) AS support,
  min(month) AS lo, max(month) AS hi, array_sort(list(DISTINCT lang)) AS langs FROM clm GROUP BY source, claim_text)"""


def _groups(spark, sf_dir):
    """Equal claims of a source as its merged groups."""
    c = A.claims(spark, sf_dir)
    return c.groupBy(F.col("source").alias("topic"), "claim_text").agg(
        F.min("claim_id").alias("ord"), F.array_sort(F.collect_list("claim_id")).alias("source_claim_ids"), F.count(F.lit(1)).alias("endorsement_count"), F.sum("support_count").alias("support_count"),
        F.array(F.min("month"), F.max("month")).alias("date_range"), F.array_sort(F.collect_set("lang")).alias("entities"),
    )


@query(f"""{_GRP}, e AS (SELECT topic, unnest([lo, hi]) AS month FROM g), m AS (SELECT topic, month, count(*) AS n FROM e GROUP BY ALL),
t AS (SELECT topic, string_agg(month || ':' || n, ',' ORDER BY month) AS timeline, min(month) AS first_date, max(month) AS last_date FROM m GROUP BY topic)
SELECT topic, count(*) AS merged_claim_count, CAST(sum(size) AS BIGINT) AS claim_count, any_value(timeline) AS timeline, any_value(first_date) AS first_date, any_value(last_date) AS last_date FROM g JOIN t USING (topic) GROUP BY topic""")
def topic_stats(spark, sf_dir):
    line = F.array_join(F.transform(F.map_entries("timeline"), lambda x: F.concat_ws(":", x["key"], x["value"].cast("string"))), ",").alias("timeline")
    return merge.topic_stats(_groups(spark, sf_dir)).select("topic", "merged_claim_count", "claim_count", line, "first_date", "last_date")


@query(f"""{_GRP} SELECT topic, count(*) AS group_count, CAST(sum(size) AS BIGINT) AS source_claim_count, CAST(count(*) FILTER (size = 1) AS BIGINT) AS singleton_count, max(size) AS max_cluster_size
FROM g GROUP BY GROUPING SETS ((topic), ())""")
def group_sizes(spark, sf_dir):
    return merge.size_stats(_groups(spark, sf_dir))


@query(f"{_GRP} SELECT topic, count(*) AS group_count FROM g WHERE size BETWEEN 2 AND 5 GROUP BY topic")
def topics_of_size(spark, sf_dir):
    g = _groups(spark, sf_dir)
    return merge.topics_with_groups(g.select("topic").distinct(), g, 2, 5)


@query(f"{_GRP} SELECT DISTINCT topic, CAST(ids[1] AS VARCHAR) AS key FROM g")
def group_keys(spark, sf_dir):
    return _groups(spark, sf_dir).select("topic", merge.group_key(F.col("source_claim_ids"), F.col("claim_text")).alias("key"))


# -- classification ------------------------------------------------------------
_THREADS = """th AS (
  SELECT 't' || user_id AS thread_id, user_id AS ord, min(ts) AS start_time, max(ts) AS last_time, count(*) AS num_messages, count(DISTINCT event_type) AS num_unique_senders,
    string_agg(event_type, chr(10) ORDER BY ts, event_id) AS text FROM events GROUP BY user_id),
cl AS (SELECT thread_id, ord, true AS passed_heuristic, CASE ord % 3 WHEN 0 THEN true WHEN 1 THEN false END AS is_knowledge_bearing, 'tag' || (ord % 4) AS tag, 'r' || (ord % 2) AS reason FROM th WHERE ord % 7 <> 0)"""


def _threads(spark, sf_dir):
    e = A.table(spark, sf_dir, "events")
    return e.groupBy("user_id").agg(
        F.min("ts").alias("start_time"), F.max("ts").alias("last_time"), F.count(F.lit(1)).alias("num_messages"), F.count_distinct("event_type").alias("num_unique_senders")
    ).select(F.concat(F.lit("t"), "user_id").alias("thread_id"), F.col("user_id").alias("ord"), "start_time", "last_time", "num_messages", "num_unique_senders")


def _classes(spark, sf_dir):
    ord_ = F.col("ord")
    return _threads(spark, sf_dir).where("ord % 7 <> 0").select(
        "thread_id", "ord", F.lit(True).alias("passed_heuristic"), F.when(ord_ % 3 == 0, True).when(ord_ % 3 == 1, False).alias("is_knowledge_bearing"),
        F.array(F.concat(F.lit("tag"), (ord_ % 4).cast("string"))).alias("topic_tags"), F.array().cast("array<string>").alias("emergent_tags"), F.array().cast("array<string>").alias("entities"),
        F.concat(F.lit("r"), (ord_ % 2).cast("string")).alias("reason"),
    )


@query(f"""WITH {_THREADS}, p AS (SELECT *, num_messages >= 60 AND num_unique_senders >= 2 AS passed, contains(lower(text), 'error' || chr(10) || 'click') AS hit FROM th),
r AS (SELECT *, row_number() OVER (PARTITION BY passed AND hit ORDER BY ord) AS n FROM p)
SELECT thread_id, passed AS passed_heuristic, passed AND hit AND n <= 40 AS asked,
  CASE WHEN NOT passed THEN 'filtered_by_heuristic' WHEN NOT hit THEN 'outside_topic_filter' WHEN n > 40 THEN 'skipped_max_threads' END AS reason FROM r""")
def class_candidates(spark, sf_dir):
    order = F.row_number().over(A.Window.partitionBy("user_id").orderBy("ts", "event_id"))
    messages = A.table(spark, sf_dir, "events").select(F.concat(F.lit("t"), "user_id").alias("thread_id"), order.alias("idx"), F.col("event_type").alias("content"))
    found = classify.candidates(_threads(spark, sf_dir), classify.thread_text(messages), "ERROR\nclick", 40, 60)
    return found.select("thread_id", "passed_heuristic", "asked", "reason")


@query(f"""WITH {_THREADS} SELECT th.thread_id, num_messages, CASE WHEN cl.thread_id IS NOT NULL THEN is_knowledge_bearing END AS is_knowledge_bearing, coalesce(tag, '') AS topic_tags,
  coalesce(cl.reason, 'missing_classification') AS reason, coalesce(passed_heuristic, true) AS passed_heuristic FROM th LEFT JOIN cl ON cl.thread_id = th.thread_id""")
def threads_with_classes(spark, sf_dir):
    return classify.with_classes(_threads(spark, sf_dir), _classes(spark, sf_dir)).select("thread_id", "num_messages", "is_knowledge_bearing", text("topic_tags"), "reason", "passed_heuristic")


@query(f"""WITH {_THREADS}, r AS (SELECT th.thread_id, th.ord, is_knowledge_bearing IS NOT DISTINCT FROM false AS skipped FROM th LEFT JOIN cl ON cl.thread_id = th.thread_id),
n AS (SELECT *, row_number() OVER (PARTITION BY skipped ORDER BY ord) AS n FROM r) SELECT thread_id, skipped, NOT skipped AND n <= 20 AS asked FROM n""")
def threads_to_reclassify(spark, sf_dir):
    return classify.to_reclassify(_threads(spark, sf_dir), _classes(spark, sf_dir), 20).select("thread_id", "skipped", "asked")


@query(f"""WITH {_THREADS}, r AS (SELECT th.thread_id, is_knowledge_bearing AS k FROM th LEFT JOIN cl ON cl.thread_id = th.thread_id)
SELECT count(*) AS thread_count, count(*) FILTER (k) AS knowledge_bearing_count, count(*) FILTER (k IS DISTINCT FROM false) AS asked_count, count(*) FILTER (NOT k) AS skipped_count FROM r""")
def class_counts(spark, sf_dir):
    return classify.class_counts(classify.to_reclassify(_threads(spark, sf_dir), _classes(spark, sf_dir)))


@query(f"WITH {_THREADS} SELECT th.thread_id, num_messages FROM th JOIN cl ON cl.thread_id = th.thread_id WHERE is_knowledge_bearing AND tag = 'tag2'")
def knowledge_threads(spark, sf_dir):
    return classify.knowledge_threads(_classes(spark, sf_dir), _threads(spark, sf_dir), "tag2").select("thread_id", "num_messages")


def _quoted(*parts):
    """A JSON list of strings."""
    return F.concat(F.lit("["), F.concat_ws(",", *[F.concat(F.lit('"'), p, F.lit('"')) for p in parts]), F.lit("]"))


@query("""SELECT 'd' || doc_id AS thread_id, doc_id % 10 <> 9 AND doc_id % 2 = 0 AS is_knowledge_bearing, CASE WHEN doc_id % 10 = 9 THEN '' ELSE lang || ',' || source || ',' || source END AS topic_tags,
  CASE WHEN doc_id % 10 = 9 THEN '' ELSE source || ',' || source END AS emergent_tags, CASE WHEN doc_id % 10 = 9 THEN 'classification_error' ELSE 'as {said}' END AS reason FROM documents""")
def parsed_classes(spark, sf_dir):
    d = A.table(spark, sf_dir, "documents")
    body = F.concat(
        F.lit('Here:\n```json\n{"is_knowledge_bearing": '), F.when(F.col("doc_id") % 2 == 0, "true").otherwise("false"), F.lit(', "topic_tags": '), _quoted("lang", "source", "source"),
        F.lit(', "reason": "as {said}"}\n```'),
    )
    answers = d.select(F.concat(F.lit("d"), "doc_id").alias("thread_id"), F.when(F.col("doc_id") % 10 == 9, "no answer").otherwise(body).alias("answer"))
    found = classify.parse_class(answers, d.select(F.col("lang").alias("tag")).distinct())
    return found.select("thread_id", "is_knowledge_bearing", text("topic_tags"), text("emergent_tags"), "reason")


@query("""WITH n AS (SELECT conv_id, count(*) AS n, '2024-' || lpad(CAST(conv_id % 12 + 1 AS VARCHAR), 2, '0') AS month FROM conversations GROUP BY conv_id)
SELECT 'c' || conv_id || '-c1' AS claim_id, 'c' || conv_id AS thread_id, 'a claim' AS claim_text, CASE WHEN n > 1 THEN '0,1' ELSE '0' END AS supporting, CASE WHEN n > 2 THEN '2' ELSE '' END AS opposing, 'neutral' AS stance, month AS date FROM n""")
def parsed_claims(spark, sf_dir):
    m = A.conversation_messages(spark, sf_dir).withColumn("conv", F.col("thread_id")).withColumn("thread_id", F.concat(F.lit("c"), F.col("thread_id").cast("string")))
    month = F.concat(F.lit("2024-"), F.lpad((F.col("conv") % 12 + 1).cast("string"), 2, "0"))
    lines = classify.rendered_lines(m.withColumn("content", F.lit("shown"))).select("thread_id", "line", month.alias("month"))
    answer = '{"claims": [{"claim_text": "  "}, {"claim_text": " a claim ", "supporting_message_ids": [0, 1, 999, -3], "opposing_message_ids": [2]}]}'
    answers = m.select("thread_id").distinct().withColumn("answer", F.lit(answer))
    found = classify.claims_from_answers(answers, lines, A.table(spark, sf_dir, "documents").select(F.col("lang").alias("tag")).distinct())
    return found.select("claim_id", "thread_id", "claim_text", text("supporting"), text("opposing"), "stance", "date")


# -- contacts and names ------------------------------------------------------
_MAIL = r"[A-Za-z0-9._%+\-]+@[A-Za-z0-9.\-]+\.[A-Za-z]{2,}"
_NAMES = f"""WITH nm AS (SELECT doc_id AS claim_id, CASE WHEN doc_id % 3 = 0 THEN [lang] ELSE list_distinct([lang, source]) END AS names, lang, source,
  list_distinct(regexp_extract_all(text, '{_MAIL}')) AS mails FROM documents),
rw AS (SELECT claim_id, unnest(names) AS name, len(names) = 1 AS sure, lang, source, mails FROM nm),
cn AS (SELECT name, count(*) AS claim_count, list_sort(list(claim_id))[1:12] AS samples FROM rw GROUP BY name),
tp AS (SELECT name, string_agg(DISTINCT t, ',' ORDER BY t) AS topics FROM (SELECT name, unnest([lang, source]) AS t FROM rw) GROUP BY name),
em AS (SELECT name, m, bool_or(sure) AS sure FROM (SELECT name, sure, unnest(mails) AS m FROM rw) GROUP BY ALL),
ct AS (SELECT name, string_agg(m, ',' ORDER BY m) FILTER (sure) AS sure, string_agg(m, ',' ORDER BY m) FILTER (NOT sure) AS unsure FROM em GROUP BY name)
SELECT cn.name, claim_count, array_to_string(samples, ',') AS sample_claim_ids, topics, coalesce(ct.sure, '') AS contacts, coalesce(ct.unsure, '') AS contacts_uncertain
FROM cn JOIN tp USING (name) LEFT JOIN ct ON ct.name = cn.name"""


def _named(spark, sf_dir):
    d = A.table(spark, sf_dir, "documents")
    names = F.when(F.col("doc_id") % 3 == 0, F.array("lang")).otherwise(F.array("lang", "source"))
    return d.select(
        F.col("doc_id").alias("claim_id"), F.col("doc_id").alias("ord"), F.col("text").alias("claim_text"), names.alias("entities"), F.array("lang", "source").alias("topics"),
        F.array().cast(contacts.REDACTIONS).alias("redactions"),
    )


@query(_NAMES)
def name_records(spark, sf_dir):
    c = _named(spark, sf_dir)
    none = c.select("claim_id", F.lit("x").alias("name")).where("false")
    found = contacts.name_records(c, contacts.claim_contacts(c), none)
    mails = lambda c: F.array_join(contacts.of_kind(F.col(c), "email"), ",").alias(c)
    return found.select("name", "claim_count", text("sample_claim_ids"), text("topics"), mails("contacts"), mails("contacts_uncertain"))


@query(f"""WITH m AS (SELECT doc_id, unnest(regexp_extract_all(text, '{_MAIL}')) AS value FROM documents), d AS (SELECT DISTINCT * FROM m)
SELECT doc_id AS claim_id, string_agg(value, ',' ORDER BY value) AS mails FROM d GROUP BY doc_id""")
def claim_contacts(spark, sf_dir):
    """Of each claim its text is edited away; the original's redactions keep what stood there."""
    c = _named(spark, sf_dir)
    from ..functions import text as T

    old = c.select("claim_id", T.redact(F.col("claim_text")).alias("r")).select("claim_id", F.col("r.text").alias("claim_text"), F.col("r.redactions").alias("redactions"))
    found = contacts.claim_contacts(c.withColumn("claim_text", F.lit("")), old)
    return found.select("claim_id", contacts.of_kind(F.col("contacts"), "email").alias("m")).where("size(m) > 0").select("claim_id", F.array_join("m", ",").alias("mails"))


@query("""WITH s AS (SELECT n_nationkey AS ord, lower(n_name) AS a, lower(n_name) || ' state' AS b, lower(substr(n_name, 1, 1)) AS c FROM nation),
r AS (SELECT ord, unnest([a, b, c]) AS norm, unnest([0, 1, 2]) AS pos FROM s) SELECT norm, arg_min('seed' || lpad(CAST(ord AS VARCHAR), 3, '0'), (ord, pos)) AS seed_id FROM r GROUP BY norm""")
def seed_index(spark, sf_dir):
    n = A.table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("int").alias("ord"), F.lit(None).cast("string").alias("seed_id"), F.lower("n_name").alias("canonical_norm"),
        F.array(F.concat(F.lower("n_name"), F.lit(" state")), F.lower(F.substring("n_name", 1, 1))).alias("alias_norms"),
    )
    return contacts.seed_index(n)


_WORDS = "wd AS (SELECT DISTINCT doc_id AS claim_id, unnest(regexp_split_to_array(lower(text), '[^a-z]+')) AS name FROM documents WHERE lang = 'en')"
_ALIAS = """al AS (SELECT alias, min(entity_id) AS entity_id FROM (
  SELECT 'e' || lpad(CAST(ord AS VARCHAR), 4, '0') AS entity_id, unnest(al) AS alias FROM (VALUES (0, ['the', 'on']), (1, ['and', 'the']), (2, ['in', 'of', 'there'])) t(ord, al)) GROUP BY alias)"""


def _aliases(spark):
    rows = [(0, "e0000", "the", ["on"]), (1, "e0001", "and", ["the"]), (2, "e0002", "in", ["of", "there"])]
    return contacts.alias_index(spark.createDataFrame(rows, "ord int, entity_id string, canonical_name string, aliases array<string>"))


def _told(spark, sf_dir):
    d = A.table(spark, sf_dir, "documents").where("lang = 'en'")
    return d.select(F.col("doc_id").alias("claim_id"), F.explode(F.split(F.lower("text"), "[^a-z]+")).alias("name"))


@query(f"""WITH {_WORDS}, {_ALIAS}, m AS (SELECT claim_id, entity_id, alias FROM wd JOIN al ON al.alias = wd.name)
SELECT claim_id, entity_id, arg_min(alias, (-length(alias), alias)) AS name FROM m WHERE entity_id <> 'e0001' GROUP BY ALL""")
def other_entities(spark, sf_dir):
    return contacts.other_entities(contacts.claim_entities(_told(spark, sf_dir), _aliases(spark)), "e0001")


@query(f"""WITH {_WORDS}, {_ALIAS}, m AS (SELECT DISTINCT claim_id, entity_id FROM wd JOIN al ON al.alias = wd.name),
l AS (SELECT doc_id AS claim_id, unnest(['there', 'and', 'of']) AS alias, unnest([0, 1, 2]) AS pos FROM documents WHERE lang = 'en'),
f AS (SELECT claim_id, entity_id, arg_min(alias, pos) AS name FROM l JOIN al USING (alias) GROUP BY ALL) SELECT f.* FROM f ANTI JOIN m USING (claim_id, entity_id)""")
def tagged_only(spark, sf_dir):
    d = A.table(spark, sf_dir, "documents").where("lang = 'en'").select(F.col("doc_id").alias("claim_id"), F.array(F.lit("there"), F.lit("and"), F.lit("of")).alias("entities"))
    index = _aliases(spark)
    return contacts.tagged_only(d, contacts.claim_entities(_told(spark, sf_dir), index), index)


# -- plans -----------------------------------------------------------------------
_TOPICS = """tp AS (SELECT source AS topic, min(doc_id) AS ord, count(*) AS claim_count, count(DISTINCT text) AS merged_claim_count FROM documents GROUP BY source),
ct AS (SELECT 'src' || r_regionkey AS topic, r_name AS title, 'cat' || (r_regionkey % 2) AS category, CASE WHEN r_regionkey < 3 THEN 'find ' || r_name ELSE '' END AS focus FROM region),
tc AS (SELECT tp.*, coalesce(ct.title, tp.topic) AS title, coalesce(ct.category, 'emergent') AS category, ct.topic IS NULL AS is_emergent FROM tp LEFT JOIN ct USING (topic))"""


def _catalog(spark, sf_dir):
    key = F.col("r_regionkey").cast("string")
    return A.table(spark, sf_dir, "region").select(
        F.concat(F.lit("src"), key).alias("topic"), F.col("r_name").alias("title"), F.concat(F.lit("cat"), (F.col("r_regionkey") % 2).cast("string")).alias("category"),
        F.when(F.col("r_regionkey") < 3, F.concat(F.lit("find "), "r_name")).otherwise("").alias("focus"),
    )


def _categories(spark):
    return spark.createDataFrame([("cat0", "Even"), ("cat1", "Odd"), ("emergent", "New")], "category string, title string")


def _topics(spark, sf_dir):
    t = A.table(spark, sf_dir, "documents").groupBy(F.col("source").alias("topic")).agg(
        F.min("doc_id").alias("ord"), F.count(F.lit(1)).alias("claim_count"), F.count_distinct("text").alias("merged_claim_count")
    )
    return plan.with_catalog(t, _catalog(spark, sf_dir), _categories(spark))


@query(f"WITH {_TOPICS} SELECT topic, title, category, is_emergent, CASE category WHEN 'cat0' THEN 'Even' WHEN 'cat1' THEN 'Odd' ELSE 'New' END AS category_title, claim_count FROM tc")
def topics_with_titles(spark, sf_dir):
    return _topics(spark, sf_dir).select("topic", "title", "category", "is_emergent", "category_title", "claim_count")


@query(f"""WITH {_TOPICS} SELECT tc.topic AS page_id, tc.title, tc.category, tc.topic AS source_tags, coalesce(ct.focus, '') AS search_focus FROM tc LEFT JOIN ct USING (topic)
WHERE claim_count >= (SELECT avg(claim_count) FROM tc) - 1""")
def identity_plan(spark, sf_dir):
    t = _topics(spark, sf_dir)
    least = t.agg(F.avg("claim_count")).first()[0] - 1
    return plan.identity_plan(t, _catalog(spark, sf_dir), least).select("page_id", "title", "category", text("source_tags"), "search_focus")


_RAW = """rp AS (SELECT n_nationkey AS ord, CASE WHEN n_nationkey % 6 = 5 THEN ' ' ELSE ' p' || (n_nationkey % 9) END AS page_id, CASE WHEN n_nationkey % 2 = 0 THEN n_name ELSE '' END AS title,
  CASE n_nationkey % 3 WHEN 0 THEN 'cat1' WHEN 1 THEN 'bad' ELSE '' END AS category, ['none', 'src' || (n_nationkey % 12), 'src' || (n_nationkey % 4)] AS tags, 'own' AS own FROM nation),
ex AS (SELECT ord, trim(page_id) AS page_id, title, category, unnest(tags) AS tag, unnest([0, 1, 2]) AS pos FROM rp WHERE trim(page_id) <> ''),
kt AS (SELECT ex.ord, page_id, any_value(ex.title) AS title, any_value(category) AS category, list(tag ORDER BY pos) AS k FROM ex JOIN tp ON tp.topic = tag GROUP BY ex.ord, page_id),
fp AS (SELECT * FROM kt WHERE len(k) > 0 QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY ord) = 1),
np AS (SELECT page_id, fp.ord, CASE WHEN fp.title = '' THEN t.title ELSE fp.title END AS title, CASE WHEN fp.category = 'cat1' THEN 'cat1' ELSE t.category END AS category, k FROM fp JOIN tc t ON t.topic = k[1]),
fo AS (SELECT page_id, coalesce((SELECT focus FROM ct WHERE ct.topic = k[1] AND focus <> ''), (SELECT focus FROM ct WHERE ct.topic = k[2] AND focus <> ''), 'own') AS search_focus FROM np)"""


def _raw_pages(spark, sf_dir):
    k = F.col("n_nationkey")
    src = lambda m: F.concat(F.lit("src"), (k % m).cast("string"))
    return A.table(spark, sf_dir, "nation").select(
        k.alias("ord"), F.when(k % 6 == 5, " ").otherwise(F.concat(F.lit(" p"), (k % 9).cast("string"))).alias("page_id"), F.when(k % 2 == 0, F.col("n_name")).otherwise("").alias("title"),
        F.when(k % 3 == 0, "cat1").when(k % 3 == 1, "bad").otherwise("").alias("category"), F.array(F.lit("none"), src(12), src(4)).alias("source_tags"), F.lit("why").alias("rationale"),
        F.lit(" own ").alias("search_focus"),
    )


def _plan(spark, sf_dir):
    return plan.normal_plan(_raw_pages(spark, sf_dir), _topics(spark, sf_dir), _categories(spark), _catalog(spark, sf_dir))


@query(f"WITH {_TOPICS}, {_RAW} SELECT np.page_id, ord, title, category, array_to_string(k, ',') AS source_tags, search_focus FROM np JOIN fo USING (page_id)")
def normal_plan(spark, sf_dir):
    return _plan(spark, sf_dir).select("page_id", "ord", "title", "category", text("source_tags"), "search_focus")


@query(f"""WITH {_TOPICS}, {_RAW}, x AS (SELECT page_id, unnest(k) AS topic FROM np)
SELECT page_id, CAST(sum(claim_count) AS BIGINT) AS claim_count, CAST(sum(merged_claim_count) AS BIGINT) AS merged_claim_count FROM x JOIN tp USING (topic) GROUP BY page_id""")
def page_counts(spark, sf_dir):
    return plan.page_counts(_plan(spark, sf_dir), _topics(spark, sf_dir)).select("page_id", "claim_count", "merged_claim_count")


@query(f"""WITH {_TOPICS}, {_RAW}, g AS (SELECT source AS topic, text, min(doc_id) AS ord FROM documents GROUP BY ALL),
x AS (SELECT page_id, unnest(k) AS topic, unnest(range(len(k))) AS tag_pos FROM np)
SELECT page_id, x.topic, g.ord AS claim_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY tag_pos, g.ord) AS INTEGER) AS position FROM x JOIN g USING (topic)""")
def page_claims(spark, sf_dir):
    g = _groups(spark, sf_dir).select("topic", "ord", F.col("ord").alias("claim_id"))
    return plan.page_claims(_plan(spark, sf_dir), g).select("page_id", "topic", "claim_id", "position")


@query(f"""WITH {_TOPICS}, g AS (SELECT source AS topic, text, min(doc_id) AS ord, list(DISTINCT lang) AS langs FROM documents GROUP BY source, text),
r AS (SELECT *, row_number() OVER (PARTITION BY topic ORDER BY ord) AS n FROM g),
e AS (SELECT topic, array_to_string(list_sort(list_distinct(flatten(list(langs)))), ',') AS entities, string_agg(md5(substr(text, 1, 120)), ',' ORDER BY n) FILTER (n <= 3) AS samples FROM r WHERE n <= 5 GROUP BY topic)
SELECT topic, title, claim_count, entities, samples, CAST(row_number() OVER (ORDER BY claim_count DESC, ord, topic) AS INTEGER) AS position FROM tc JOIN e USING (topic)""")
def topic_summaries(spark, sf_dir):
    rows = plan.topic_summaries(_topics(spark, sf_dir), _groups(spark, sf_dir))
    return rows.select("topic", "title", "claim_count", text("entities"), F.array_join(F.transform("samples", lambda x: F.md5(x.cast("binary"))), ",").alias("samples"), "position")


_OUT = "lk AS (SELECT 'p' || (l_partkey % 30) AS src, 'p' || (l_suppkey % 30) AS dst, l_orderkey * 10 + l_linenumber AS ord FROM lineitem)"


@query(f"""WITH {_OUT}, f AS (SELECT src, dst, min(ord) AS ord FROM lk WHERE src <> dst GROUP BY ALL)
SELECT src AS page_id, dst, CAST(row_number() OVER (PARTITION BY src ORDER BY ord, dst) AS INTEGER) AS position FROM f""")
def outgoing_links(spark, sf_dir):
    p = lambda c: F.concat(F.lit("p"), (F.col(c) % 30).cast("string"))
    lines = A.table(spark, sf_dir, "lineitem").select(p("l_partkey").alias("src"), p("l_suppkey").alias("dst"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ord"))
    return plan.outgoing(lines)


@query(f"""WITH {_TOPICS}, {_RAW} SELECT category, min(ord) AS ord, '## ' || CASE category WHEN 'cat0' THEN 'Even' WHEN 'cat1' THEN 'Odd' ELSE 'New' END || chr(10) || chr(10) ||
  string_agg('- [' || title || '](' || page_id || '.md)', chr(10) ORDER BY ord) || chr(10) AS text FROM np GROUP BY category""")
def index_pages(spark, sf_dir):
    return plan.index_pages(_plan(spark, sf_dir), _categories(spark))


@query(f"""WITH {A.CLM}, s AS (SELECT DISTINCT source AS page_id, claim_id, month FROM clm WHERE claim_id % 2 = 0), x AS (SELECT page_id, count(*) AS n, min(month) AS a, max(month) AS b FROM s GROUP BY page_id)
SELECT page_id, n AS n_claims, a AS first_date, b AS last_date, replace(replace('{plan.FOOTER}', '%d', CAST(n AS VARCHAR)), '%s', CASE WHEN a = b THEN a ELSE a || '–' || b END) AS footer FROM x""")
def page_footers(spark, sf_dir):
    c = A.claims(spark, sf_dir)
    cited = c.where("claim_id % 2 = 0").select(F.col("source").alias("page_id"), F.array("claim_id", "claim_id").alias("claim_ids"))
    return plan.page_footers(cited, c.withColumn("date", F.col("month")))


@query(f"""WITH f AS (SELECT page_id % 7 AS page_id, url, min(page_id) AS o FROM pages WHERE url <> '' GROUP BY page_id % 7, url)
SELECT page_id, '{plan.SOURCES}' || chr(10) || chr(10) || string_agg('- [a title](' || url || ') — {plan.SEEN_ON}2024-01-02', chr(10) ORDER BY o, url) || chr(10) AS sources FROM f GROUP BY page_id""")
def source_lists(spark, sf_dir):
    p = A.table(spark, sf_dir, "pages").select((F.col("page_id") % 7).alias("page_id"), F.col("page_id").alias("ord"), F.lit("a title").alias("title"), "url")
    return plan.source_lists(p, "2024-01-02")


# -- reviews of threads ------------------------------------------------------------
_SPLIT = """sp AS (SELECT 't' || (user_id // 3) || CASE WHEN user_id % 3 = 0 THEN '' ELSE '-split-' || (user_id % 3) END AS thread_id, user_id % 4 AS chat_id, min(ts) AS start_time, max(ts) AS last_time, count(*) AS num_messages
FROM events GROUP BY user_id)"""


def _split_threads(spark, sf_dir):
    u = F.col("user_id")
    part = F.when(u % 3 == 0, "").otherwise(F.concat(F.lit("-split-"), (u % 3).cast("string")))
    return A.table(spark, sf_dir, "events").groupBy("user_id").agg(F.min("ts").alias("start_time"), F.max("ts").alias("last_time"), F.count(F.lit(1)).alias("num_messages")).select(
        F.concat(F.lit("t"), F.floor(u / 3).cast("string"), part).alias("thread_id"), (u % 4).alias("chat_id"), "start_time", "last_time", "num_messages"
    )


@query(f"""WITH {_SPLIT} SELECT split_part(thread_id, '-', 1) AS family, thread_id, CAST(row_number() OVER (PARTITION BY split_part(thread_id, '-', 1) ORDER BY start_time, last_time, thread_id) AS INTEGER) AS position FROM sp""")
def split_families(spark, sf_dir):
    return review.split_families(_split_threads(spark, sf_dir))


@query(f"""WITH {_SPLIT}, n AS (SELECT thread_id, lag(thread_id) OVER w AS p, lead(thread_id) OVER w AS x FROM sp WINDOW w AS (PARTITION BY chat_id ORDER BY start_time, thread_id))
SELECT thread_id, CASE WHEN split_part(p, '-', 1) <> split_part(thread_id, '-', 1) THEN p END AS prev_id, CASE WHEN split_part(x, '-', 1) <> split_part(thread_id, '-', 1) THEN x END AS next_id FROM n""")
def message_context(spark, sf_dir):
    return review.message_context(_split_threads(spark, sf_dir))


@query(f"""WITH {_THREADS} SELECT th.thread_id, epoch(last_time - start_time) AS duration_sec, cl.thread_id IS NOT NULL AS has_classification, cl.thread_id IS NOT NULL AND NOT coalesce(is_knowledge_bearing, false) AS is_useless,
  CAST(row_number() OVER (ORDER BY num_messages DESC, th.ord) AS INTEGER) AS position FROM th LEFT JOIN cl ON cl.thread_id = th.thread_id""")
def enriched_threads(spark, sf_dir):
    rows = review.enrich_threads(_threads(spark, sf_dir), _classes(spark, sf_dir))
    place = F.row_number().over(A.Window.orderBy(*review.sort_order("num_messages")))
    return rows.select("thread_id", F.col("duration_sec").cast("double").alias("duration_sec"), "has_classification", "is_useless", place.alias("position"))


@query("SELECT o_orderkey FROM orders WHERE strftime(o_orderdate, '%Y-%m') = '1995-03'")
def orders_of_month(spark, sf_dir):
    return review.in_month(A.table(spark, sf_dir, "orders"), "1995-03", "o_orderdate").select("o_orderkey")


@query(f"""WITH {_THREADS}, c AS (SELECT * FROM cl UNION ALL SELECT 'gone', -1, true, true, 'x', 'r')
SELECT (SELECT count(*) FROM th) AS threads, (SELECT CAST(sum(num_messages) AS BIGINT) FROM th) AS messages, (SELECT count(*) FROM c) AS classes, (SELECT count(*) FILTER (is_knowledge_bearing) FROM c) AS knowledge, CAST(1 AS BIGINT) AS stale""")
def thread_meta(spark, sf_dir):
    c = _classes(spark, sf_dir).select("thread_id", "is_knowledge_bearing")
    return review.thread_meta(_threads(spark, sf_dir), c.unionByName(spark.createDataFrame([("gone", True)], c.schema)))


@query(f"""WITH {_THREADS}, mv AS (SELECT thread_id AS old_id, 't' || (ord // 5 * 5) AS new_id, ord FROM th),
r AS (SELECT new_id, cl.*, row_number() OVER (PARTITION BY new_id ORDER BY mv.old_id <> new_id, mv.ord, old_id) AS n FROM mv JOIN cl ON cl.thread_id = mv.old_id)
SELECT new_id AS thread_id, is_knowledge_bearing, reason FROM r WHERE n = 1""")
def inherited_classes(spark, sf_dir):
    moves = _threads(spark, sf_dir).select(F.col("thread_id").alias("old_id"), F.concat(F.lit("t"), (F.floor(F.col("ord") / 5) * 5).cast("string")).alias("new_id"), "ord")
    return review.inherited_class(_classes(spark, sf_dir).select("thread_id", "is_knowledge_bearing", "reason"), moves)


@query("""WITH c AS (SELECT user_id AS thread_id, min(event_id) % 5 AS lo, max(event_id) % 9 AS hi, count(*) AS n FROM events GROUP BY user_id)
SELECT thread_id, CASE WHEN lo > hi THEN 'empty range' WHEN lo > 0 THEN 'gap' WHEN hi <> n - 1 THEN 'end' END AS wrong FROM c WHERE lo > hi OR lo > 0 OR hi <> n - 1""")
def wrong_ranges(spark, sf_dir):
    e = A.table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("thread_id")).agg((F.min("event_id") % 5).alias("low"), (F.max("event_id") % 9).alias("high"), F.count(F.lit(1)).alias("n"))
    return review.checked_ranges(e.select("thread_id", "low", "high"), e.select("thread_id", "n")).select("thread_id", "wrong")


@query(r"""WITH c AS (SELECT conv_id, turn, role, trim(regexp_replace(text, '\s+', ' ', 'g')) AS t FROM conversations),
q AS (SELECT conv_id, turn AS spot, CASE WHEN turn % 2 = 1 THEN role END AS who, trim(substr(t, 1, 3)) AS q FROM c WHERE trim(substr(t, 1, 3)) <> '')
SELECT q.conv_id AS thread_id, spot AS idx, min(c.turn) AS quoted_idx FROM q JOIN c ON c.conv_id = q.conv_id AND c.turn < spot AND c.t <> '' AND (who IS NULL OR who = c.role) AND (contains(c.t, q.q) OR contains(q.q, c.t)) GROUP BY ALL""")
def quote_in_thread(spark, sf_dir):
    m = A.conversation_messages(spark, sf_dir)
    from ..functions import text as T

    start = F.substring(T.collapse_spaces(F.coalesce("content", F.lit(""))), 1, 3)
    return sequences.quote_in_thread(m.withColumns({"quote_sender": F.when(F.col("idx") % 2 == 1, F.col("sender")), "quote_text": start}))


@query(r"""WITH c AS (SELECT conv_id AS thread_id, turn, role, text, trim(text, chr(10) || chr(13) || chr(9) || ' ') AS t FROM conversations WHERE trim(text, chr(10) || chr(13) || chr(9) || ' ') <> ''),
n AS (SELECT *, row_number() OVER (PARTITION BY thread_id ORDER BY turn) - 1 AS line, min(turn) OVER (PARTITION BY thread_id, role) AS f FROM c),
p AS (SELECT *, dense_rank() OVER (PARTITION BY thread_id ORDER BY f) AS who FROM n)
SELECT thread_id, md5(string_agg('[m' || line || '] (2024-01, {P} ' || who || ') ' || t || CASE WHEN turn % 2 = 0 THEN ' [{R}: 👍×2, 🎉×1]' ELSE '' END, chr(10) ORDER BY line)) AS rendered FROM p GROUP BY thread_id""".replace("{P}", sequences.PARTICIPANT).replace("{R}", sequences.REACTIONS))
def threads_for_model(spark, sf_dir):
    made = lambda e, *who: F.struct(F.lit(e).alias("emoji"), F.array(*map(F.lit, who)).alias("senders"))
    some = F.array(made("👍", "a", "b"), made("x", ""), made("", "a"), made("🎉", "c", ""))
    m = A.conversation_messages(spark, sf_dir).withColumns({"ts": F.lit("2024-01-05 00:00:00").cast("timestamp_ntz"), "reactions": F.when(F.col("idx") % 2 == 0, some).otherwise(F.array().cast("array<struct<emoji:string,senders:array<string>>>"))})
    return sequences.rendered_for_model(m).select("thread_id", F.md5(F.col("rendered").cast("binary")).alias("rendered"))


# -- reviews of redactions -----------------------------------------------------------
_RED = f"""rd AS (SELECT doc_id AS claim_id, list_transform(regexp_extract_all(text, '{_MAIL}'), lambda x: x) AS mails, CASE doc_id % 5 WHEN 1 THEN 'accepted' WHEN 2 THEN 'restored' END AS pii_review, text FROM documents),
ps AS (SELECT *, CASE WHEN len(mails) > 0 THEN 'pending' ELSE coalesce(pii_review, '') END AS status FROM rd)"""


def _redacted(spark, sf_dir):
    from ..functions import text as T

    d = A.table(spark, sf_dir, "documents")
    mails = T.find_emails(F.col("text"))
    taken = F.transform(mails, lambda v: F.struct(F.lit("email").alias("type"), v.alias("value")))
    return d.select(
        F.col("doc_id").alias("claim_id"), F.regexp_replace("text", T.EMAIL, T.REDACTION_MARK).alias("claim_text"), F.when(F.size(taken) > 0, taken).alias("redactions"),
        F.when(F.col("doc_id") % 5 == 1, "accepted").when(F.col("doc_id") % 5 == 2, "restored").alias("pii_review"),
    )


@query(f"""WITH {_RED} SELECT claim_id, status AS review_status, CASE WHEN len(mails) > 0 THEN 'email: ' || len(mails) ELSE '' END AS redaction_summary, CAST(len(mails) AS INTEGER) AS n_redactions, md5(text) AS original
FROM ps WHERE status <> ''""")
def review_items(spark, sf_dir):
    rows = review.review_items(_redacted(spark, sf_dir), "all")
    return rows.select("claim_id", "review_status", "redaction_summary", "n_redactions", F.md5(F.col("original_text").cast("binary")).alias("original"))


@query(f"WITH {_RED} SELECT claim_id FROM ps WHERE status IN ('accepted', 'restored')")
def reviewed_items(spark, sf_dir):
    return review.review_items(_redacted(spark, sf_dir), "reviewed").select("claim_id")


@query(f"""WITH {_RED} SELECT count(*) FILTER (status = 'pending') AS pending, count(*) FILTER (status = 'accepted') AS accepted, count(*) FILTER (status = 'restored') AS restored, count(*) FILTER (status <> '') AS total_flagged,
  CAST(sum(len(mails)) AS BIGINT) AS emails FROM ps""")
def review_counts(spark, sf_dir):
    return review.review_counts(_redacted(spark, sf_dir)).withColumn("emails", F.col("pending_by_type")["email"]).drop("pending_by_type")


@query(f"""WITH {_RED} SELECT claim_id, CASE WHEN len(mails) > 0 THEN CASE WHEN claim_id % 2 = 0 THEN 'restored' ELSE 'accepted' END ELSE pii_review END AS pii_review,
  CASE WHEN len(mails) > 0 AND claim_id % 2 = 0 THEN md5(text) END AS restored FROM ps""")
def settled_redactions(spark, sf_dir):
    c = _redacted(spark, sf_dir)
    decisions = c.select("claim_id", F.when(F.col("claim_id") % 2 == 0, "restore").otherwise("accept").alias("decision"))
    due = c.where("redactions is not null and claim_id % 2 = 0").select(F.col("claim_id").alias("due"))
    rows = review.settle_redactions(c, decisions).join(due, F.col("claim_id") == F.col("due"), "left")
    return rows.select("claim_id", "pii_review", F.when(F.col("due").isNotNull(), F.md5(F.col("claim_text").cast("binary"))).alias("restored"))


# -- reviews of entities -------------------------------------------------------------
# customers are members of entities, one for each nation and segment
_ENT = """mb AS (SELECT 'e' || (c_nationkey % 9) AS entity_id, c_custkey AS ord, c_name AS name, c_custkey % 17 AS count, [c_mktsegment] AS topics, CASE WHEN c_custkey % 3 = 0 THEN ['p' || (c_custkey % 50)] ELSE [] END AS sure,
  CASE WHEN c_custkey % 2 = 0 THEN ['p' || (c_custkey % 50)] ELSE [] END AS unsure FROM customer),
en AS (SELECT DISTINCT entity_id, CASE entity_id WHEN 'e1' THEN 'ambiguous' ELSE 'suggested' END AS status FROM mb)"""


def _members(spark, sf_dir):
    phone = F.array(F.struct(F.lit("phone").alias("kind"), F.concat(F.lit("p"), (F.col("c_custkey") % 50).cast("string")).alias("value")))
    none = F.array().cast(contacts.CONTACT)
    k = F.col("c_custkey")
    return A.table(spark, sf_dir, "customer").select(
        F.concat(F.lit("e"), (F.col("c_nationkey") % 9).cast("string")).alias("entity_id"), k.alias("ord"), F.col("c_name").alias("name"), (k % 17).alias("count"), F.array("c_mktsegment").alias("topics"),
        F.when(k % 3 == 0, phone).otherwise(none).alias("contacts"), F.when(k % 2 == 0, phone).otherwise(none).alias("contacts_uncertain"),
    )


def _entities(spark, sf_dir):
    m = _members(spark, sf_dir)
    return m.select("entity_id").distinct().select(
        "entity_id", F.lit("nobody").alias("canonical_name"), F.when(F.col("entity_id") == "e1", "ambiguous").otherwise("suggested").alias("status"), (F.col("entity_id") == "e2").alias("contacts_manual"),
        F.array().cast(contacts.CONTACT).alias("contacts"),
    )


@query(f"""WITH {_ENT}, s AS (SELECT entity_id, status, (SELECT count(*) FROM mb WHERE mb.entity_id = en.entity_id) AS size FROM en)
SELECT 'status' AS what, status AS value, count(*) AS n FROM s GROUP BY status UNION ALL SELECT 'size', CAST(size AS VARCHAR), count(*) FROM s GROUP BY size UNION ALL SELECT 'all', '', count(*) FROM s
UNION ALL SELECT 'multi_member', '', count(*) FROM s WHERE size > 1 HAVING count(*) > 0""")
def entity_counts(spark, sf_dir):
    return review.entity_counts(_entities(spark, sf_dir), _members(spark, sf_dir))


@query(f"""WITH {_ENT}, r AS (SELECT entity_id, arg_min(name, (-count, ord, name)) AS canonical_name, md5(string_agg(name, ',' ORDER BY -count, ord, name)) AS aliases, string_agg(DISTINCT topics[1], ',' ORDER BY topics[1]) AS topics,
  CAST(sum(count) AS BIGINT) AS member_total FROM mb GROUP BY entity_id),
s AS (SELECT entity_id, unnest(sure) AS v FROM mb WHERE entity_id <> 'e2'), u AS (SELECT DISTINCT entity_id, unnest(unsure) AS v FROM mb),
n AS (SELECT entity_id, count(*) AS n FROM u ANTI JOIN s USING (entity_id, v) GROUP BY entity_id), sn AS (SELECT entity_id, count(DISTINCT v) AS n FROM s GROUP BY entity_id)
SELECT r.*, CAST(coalesce(sn.n, 0) AS INTEGER) AS n_sure, CAST(coalesce(n.n, 0) AS INTEGER) AS n_unsure FROM r LEFT JOIN n USING (entity_id) LEFT JOIN sn ON sn.entity_id = r.entity_id""")
def recomputed_entities(spark, sf_dir):
    rows = review.recomputed(_entities(spark, sf_dir), _members(spark, sf_dir))
    return rows.select(
        "entity_id", "canonical_name", F.md5(F.array_join("aliases", ",").cast("binary")).alias("aliases"), text("topics"), "member_total", F.size("contacts").alias("n_sure"), F.size("contacts_uncertain").alias("n_unsure")
    )


@query("""WITH m AS (SELECT n_nationkey AS k, 'e' || (n_nationkey % 5) AS entity_id, n_name AS name FROM nation), t AS (SELECT c_nationkey AS k, c_custkey AS claim_id FROM customer),
s AS (SELECT s_nationkey AS k, s_suppkey AS claim_id FROM supplier),
a AS (SELECT entity_id, name, unnest([1, 2, 3]) AS claim_id FROM m WHERE k % 4 = 0 UNION SELECT entity_id, name, claim_id FROM m JOIN t USING (k) WHERE k % 4 <> 0 UNION SELECT entity_id, name, claim_id FROM m JOIN s USING (k) WHERE k % 4 <> 0)
SELECT * FROM a WHERE claim_id NOT IN (2, 40) AND NOT (claim_id = 3 AND name IN (SELECT n_name FROM nation WHERE n_nationkey % 8 = 0))""")
def member_claims(spark, sf_dir):
    n = A.table(spark, sf_dir, "nation")
    k = F.col("n_nationkey")
    m = n.select(
        k.alias("k"), F.concat(F.lit("e"), (k % 5).cast("string")).alias("entity_id"), F.col("n_name").alias("name"),
        F.when(k % 4 == 0, F.array(*[F.lit(i).cast("bigint") for i in (1, 2, 3)])).alias("claim_ids"), F.when(k % 8 == 0, F.array(F.lit(3).cast("bigint"))).alias("excluded_claim_ids"),
    )
    of = lambda t, key, claim: A.table(spark, sf_dir, t).select(F.col(key).alias("k"), F.col(claim).cast("bigint").alias("claim_id")).join(m.select("k", "name"), "k").select("name", "claim_id")
    gone = spark.createDataFrame([(2,), (40,)], "claim_id bigint")
    return review.member_claims(m, of("customer", "c_nationkey", "c_custkey"), of("supplier", "s_nationkey", "s_suppkey"), gone)


@query("""WITH g AS (SELECT o_custkey, list(o_orderkey ORDER BY o_orderkey) AS ids FROM orders GROUP BY o_custkey), l AS (SELECT o_custkey, ids[1] AS rep, list_filter(ids, lambda x: x % 4 <> 0) AS ids FROM g WHERE len(ids) > 1)
SELECT 'g' || o_custkey AS group_id, CASE WHEN list_contains(ids, rep) THEN rep ELSE ids[1] END AS representative, array_to_string(ids, ',') AS claim_ids FROM l WHERE len(ids) > 1""")
def groups_without_claims(spark, sf_dir):
    o = A.table(spark, sf_dir, "orders")
    g = o.groupBy("o_custkey").agg(F.array_sort(F.collect_list("o_orderkey")).alias("claim_ids")).where("size(claim_ids) > 1")
    g = g.select(F.concat(F.lit("g"), "o_custkey").alias("group_id"), F.element_at("claim_ids", 1).alias("representative"), "claim_ids")
    return review.without_claims(g, o.where("o_orderkey % 4 = 0").select(F.col("o_orderkey").alias("claim_id"))).select("group_id", "representative", text("claim_ids"))
