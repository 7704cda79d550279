"""The registered queries: each applies operators to the logical tables, with its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import aggregate, edits, entities, graph, pages, sequences, similarity, support, text_search, views
from ..sources import exports
from ..sources.artifacts import saved
from ..streaming import threads
from . import adapters as A

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


# -- support -------------------------------------------------------------
@query(f"""WITH {A.SUP}, {A.PEOPLE.format(k='part, yr', t='sup')}
SELECT part, yr, p_name, support_count AS supporters, opposer_count AS opposers FROM sums JOIN part ON p_partkey = part
WHERE author_count + reaction_endorser_count > 0 AND opposer_count > 0""")
def contested_parts(spark, sf_dir):
    names = A.table(spark, sf_dir, "part").select("p_partkey", "p_name")
    found = aggregate.contested(A.votes(spark, sf_dir), ["part", "yr"])
    return found.join(names, found["part"] == names["p_partkey"]).select("part", "yr", "p_name", "supporters", "opposers")


@query(f"WITH {A.SUP}, {A.PEOPLE.format(k='part', t='sup')} SELECT * FROM sums")
def support_counts(spark, sf_dir):
    return support.support_counts(A.votes(spark, sf_dir), ("part",))


@query(f"""WITH {A.SUP} SELECT month, count(DISTINCT claim) AS claim_count, greatest(1, count(DISTINCT usr)) AS support_count FROM sup GROUP BY month""")
def engagement_by_month(spark, sf_dir):
    v = A.votes(spark, sf_dir)
    people = A.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("claim"), F.col("o_custkey").alias("user"))
    return support.engagement(v.select("month", "claim"), people, "month")


@query("""SELECT user_id % 20 AS claim, event_type AS emoji, count(*) AS n FROM events GROUP BY ALL""")
def reaction_totals(spark, sf_dir):
    e = A.table(spark, sf_dir, "events")
    m = e.select((F.col("user_id") % 20).alias("claim"), F.col("event_id").alias("idx"), F.array(F.struct(F.col("event_type").alias("emoji"), F.array(F.col("user_id").cast("string"), F.lit(" ")).alias("senders"))).alias("reactions"))
    return support.reaction_summary(m).select("claim", "emoji", "n")


_USED = "CASE event_type WHEN 'purchase' THEN '👍' WHEN 'error' THEN '👎' WHEN 'click' THEN '🤔' ELSE event_type END"


@query(f"""SELECT {_USED} AS emoji, CAST(count(*) AS BIGINT) AS n FROM events WHERE event_type NOT IN ('purchase', 'error') GROUP BY ALL""")
def emoji_gaps(spark, sf_dir):
    e = F.when(F.col("event_type") == "purchase", "👍").when(F.col("event_type") == "error", "👎").when(F.col("event_type") == "click", "🤔").otherwise(F.col("event_type"))
    return support.emoji_coverage(A.table(spark, sf_dir, "events").select(e.alias("emoji"), F.lit(1).alias("n")))


@query(f"""SELECT event_id, {_USED} || ':2:' || CASE event_type WHEN 'purchase' THEN 'positive' WHEN 'error' THEN 'negative' ELSE 'neutral' END AS reactions FROM events""")
def message_reactions(spark, sf_dir):
    e = F.when(F.col("event_type") == "purchase", "👍").when(F.col("event_type") == "error", "👎").when(F.col("event_type") == "click", "🤔").otherwise(F.col("event_type"))
    made = F.array(F.struct(e.alias("emoji"), F.array(F.lit("a"), F.lit(""), F.lit("b")).alias("senders")), F.struct(F.lit("x").alias("emoji"), F.array(F.lit("")).alias("senders")))
    rows = A.table(spark, sf_dir, "events").select("event_id", support.message_reactions(made).alias("r"))
    return rows.select("event_id", F.array_join(F.transform("r", lambda x: F.concat_ws(":", x["emoji"], x["count"].cast("string"), x["sentiment"])), ",").alias("reactions"))


# -- aggregates ----------------------------------------------------------
@query(f"""WITH {A.CLM}, c AS (SELECT source, stance, count(*) AS n, min(claim_id) AS o FROM clm GROUP BY ALL)
SELECT source, arg_max(stance, (n, -o)) AS stance FROM c GROUP BY source""")
def dominant_stance(spark, sf_dir):
    return aggregate.dominant(A.claims(spark, sf_dir), ["source"], "stance", "claim_id")


@query(f"WITH {A.CLM} SELECT source, stance, count(*) AS n FROM clm GROUP BY ALL")
def stance_breakdown(spark, sf_dir):
    return aggregate.breakdown(A.claims(spark, sf_dir), ["source"], "stance")


_STANCES = f"""WITH {A.CLM}, s AS (SELECT source AS topic, lang AS entity, stance, CAST(sum(support_count) AS BIGINT) AS support FROM clm GROUP BY ALL)"""


def _stances(spark, sf_dir):
    c = A.claims(spark, sf_dir).select(F.col("source").alias("topic"), F.array("lang").alias("entities"), "stance", "support_count")
    return aggregate.entity_stances(c)


@query(f"{_STANCES} SELECT * FROM s")
def entity_stances(spark, sf_dir):
    return _stances(spark, sf_dir)


@query(f"""{_STANCES}, b AS (SELECT topic, entity, CAST(sum(CASE WHEN stance = 'positive' THEN support ELSE 0 END) AS BIGINT) AS positive,
  CAST(sum(CASE WHEN stance = 'negative' THEN support ELSE 0 END) AS BIGINT) AS negative FROM s GROUP BY ALL)
SELECT topic, entity, positive, negative, CAST(row_number() OVER (PARTITION BY topic ORDER BY positive + negative DESC, entity) AS INTEGER) AS rank
FROM b WHERE positive > 0 AND negative > 0""")
def contradictions(spark, sf_dir):
    return aggregate.contradictions(_stances(spark, sf_dir))


@query("SELECT o_orderstatus, strftime(o_orderdate, '%Y-%m') AS month, count(*) AS n FROM orders GROUP BY ALL")
def timeline(spark, sf_dir):
    o = A.table(spark, sf_dir, "orders").select("o_orderstatus", F.date_format("o_orderdate", "yyyy-MM").alias("month"))
    return aggregate.timeline(o, ["o_orderstatus"])


@query(f"""WITH {A.CLM}, t AS (SELECT claim_id, month, support_count, unnest([lang, source]) AS topic FROM clm)
SELECT topic, count(*) AS claim_count, count(DISTINCT claim_id) AS distinct_claims, CAST(sum(support_count) AS BIGINT) AS support, min(month) AS first_month,
  max(month) AS last_month FROM t GROUP BY topic""")
def topic_rollup(spark, sf_dir):
    return aggregate.topic_rollup(A.claims(spark, sf_dir))


@query(f"""WITH {A.CLM}, k AS (SELECT *, min(claim_id) OVER (PARTITION BY claim_text) AS cluster, source AS topic FROM clm),
v AS (SELECT topic, stance, cluster, count(DISTINCT source) AS n FROM k GROUP BY ALL)
SELECT k.topic, k.stance, k.cluster, count(*) AS statement_count, count(DISTINCT thread_id) AS thread_count, min(month) AS first_month, max(month) AS last_month,
  md5(any_value(claim_text)) AS text_md5, array_to_string(list_sort(list(DISTINCT claim_id)), ',') AS ids, max(v.n) AS support_count
FROM k JOIN v ON k.topic = v.topic AND k.stance = v.stance AND k.cluster = v.cluster GROUP BY ALL""")
def merged_claims(spark, sf_dir):
    c = A.claims(spark, sf_dir).withColumn("topic", F.col("source"))
    first = c.groupBy("claim_text").agg(F.min("claim_id").alias("cluster"))
    c = c.join(first, "claim_text").withColumn("is_medoid", F.col("claim_id") == F.col("cluster"))
    v = c.select(F.col("claim_id").alias("claim"), F.col("source").alias("user"), F.lit("statement").alias("role"), F.lit("neutral").alias("sentiment"))
    m = aggregate.merged_claims(c, v)
    return m.select(
        "topic", "stance", "cluster", "statement_count", "thread_count", "first_month", "last_month", F.md5(F.col("claim_text").cast("binary")).alias("text_md5"),
        F.array_join(F.transform("source_claim_ids", lambda x: x.cast("string")), ",").alias("ids"), "support_count",
    )


@query(f"""WITH {A.VEC}, p AS (SELECT a.label, a.vec_id AS i, b.vec_id AS j, 1 - list_sum(list_transform(list_zip(a.u, b.u), lambda z: z[1] * z[2])) AS d
  FROM unit a JOIN unit b ON a.label = b.label AND a.vec_id < b.vec_id),
s AS (SELECT label, item, round(sum(d), 6) AS total FROM (SELECT label, i AS item, d FROM p UNION ALL SELECT label, j, d FROM p) GROUP BY ALL)
SELECT label, arg_min(item, (total, item)) AS medoid, round(min(total), 4) AS total FROM s GROUP BY label""")
def medoids(spark, sf_dir):
    found = aggregate.vector_medoids(A.vectors(spark, sf_dir), ["label"], "vec_id", "embedding")
    return found.withColumn("total", F.round("total", 4))


@query(f"""WITH {A.VEC} SELECT a.label, a.vec_id AS i, b.vec_id AS j, round(list_sum(list_transform(list_zip(a.u, b.u), lambda z: z[1] * z[2])), 6) AS cosine
FROM unit a JOIN unit b ON a.label = b.label AND a.vec_id < b.vec_id WHERE list_sum(list_transform(list_zip(a.u, b.u), lambda z: z[1] * z[2])) >= 0.3""")
def cosine_pairs(spark, sf_dir):
    p = similarity.pairs_within(A.vectors(spark, sf_dir), "label", "vec_id", "embedding")
    return p.where("cosine >= 0.3").withColumn("cosine", F.round("cosine", 6))


@query(f"""WITH {A.VEC}, r AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY vec_id) AS rn FROM unit),
p AS (SELECT a.label, a.vec_id, max(list_sum(list_transform(list_zip(a.u, b.u), lambda z: z[1] * z[2])) * pow(0.95, a.vec_id - b.vec_id)) AS s
  FROM r a JOIN r b ON a.label = b.label AND b.rn BETWEEN a.rn - 20 AND a.rn - 1 GROUP BY ALL)
SELECT r.label AS thread_id, r.vec_id AS idx, round(greatest(0, coalesce(s, 0)), 6) AS similarity FROM r LEFT JOIN p ON r.vec_id = p.vec_id""")
def decayed_similarity(spark, sf_dir):
    v = A.vectors(spark, sf_dir).select(F.col("label").alias("thread_id"), F.col("vec_id").alias("idx"), "embedding")
    return similarity.decayed_similarity(v, "embedding").withColumn("similarity", F.round("similarity", 6))


@query(f"""WITH {A.VEC}, r AS (SELECT unit.*, CAST(e.embedding AS DOUBLE[]) AS v, row_number() OVER (PARTITION BY unit.label ORDER BY unit.vec_id) AS rn FROM unit JOIN embeddings e USING (vec_id)),
p AS (SELECT a.vec_id, max(list_sum(list_transform(list_zip(a.u, b.u), lambda z: z[1] * z[2])) * pow(0.95, a.vec_id - b.vec_id)) AS s
  FROM r a JOIN r b ON a.label = b.label AND b.rn BETWEEN a.rn - 20 AND a.rn - 1 GROUP BY ALL),
x AS (SELECT a.vec_id, unnest(b.v) AS val, unnest(range(len(b.v))) AS dim FROM r a JOIN r b ON a.label = b.label AND b.rn BETWEEN a.rn - 20 AND a.rn - 1),
m AS (SELECT vec_id, dim, avg(val) AS val FROM x GROUP BY ALL), l AS (SELECT vec_id, list(val ORDER BY dim) AS mean, sqrt(sum(val * val)) AS n FROM m GROUP BY vec_id),
w AS (SELECT l.vec_id, list_sum(list_transform(list_zip(r.u, l.mean), lambda z: z[1] * z[2])) / n AS c FROM l JOIN r ON r.vec_id = l.vec_id)
SELECT r.label AS thread_id, r.vec_id AS idx, round(greatest(0, coalesce(s, 0), coalesce(c, 0)), 6) AS similarity FROM r LEFT JOIN p ON r.vec_id = p.vec_id LEFT JOIN w ON r.vec_id = w.vec_id""")
def thread_similarity(spark, sf_dir):
    v = A.vectors(spark, sf_dir).select(F.col("label").alias("thread_id"), F.col("vec_id").alias("idx"), "embedding")
    return similarity.thread_similarity(v, "embedding").withColumn("similarity", F.round("similarity", 6))


@query()
def claim_clusters(spark, sf_dir):
    return aggregate.cluster_groups(A.vectors(spark, sf_dir), ["label"], "vec_id", "embedding", 0.7)


# -- terms ---------------------------------------------------------------
_TERMS = r"""t AS (SELECT doc_id, unnest(list_filter(regexp_split_to_array(lower(text), '[^a-z0-9]+'), lambda x: x <> '')) AS term FROM documents),
c AS (SELECT doc_id, term, count(*) AS n FROM t GROUP BY ALL), d AS (SELECT count(DISTINCT doc_id) AS n_docs FROM c),
s AS (SELECT term, CAST(sum(n) AS BIGINT) AS tf, count(*) AS df, ln((1 + any_value(n_docs)) / (1 + count(*))) + 1 AS idf FROM c, d GROUP BY term)"""


def _counts(spark, sf_dir):
    return similarity.term_counts(A.table(spark, sf_dir, "documents"), "doc_id", "text")


@query(f"WITH {_TERMS} SELECT term, tf, df, round(idf, 9) AS idf FROM s")
def term_stats(spark, sf_dir):
    return similarity.term_stats(_counts(spark, sf_dir)).select("term", "tf", "df", F.round("idf", 9).alias("idf"))


@query(f"""WITH {_TERMS}, w AS (SELECT doc_id, c.term, n / sum(n) OVER (PARTITION BY doc_id) * idf AS weight FROM c JOIN s ON c.term = s.term)
SELECT doc_id, count(*) AS terms, round(sum(weight), 6) AS total, round(max(weight), 9) AS top FROM w GROUP BY doc_id""")
def tfidf_weights(spark, sf_dir):
    c = saved(_counts(spark, sf_dir))
    w = similarity.tfidf(c, similarity.term_stats(c))
    return w.groupBy("doc_id").agg(F.count(F.lit(1)).alias("terms"), F.round(F.sum("weight"), 6).alias("total"), F.round(F.max("weight"), 9).alias("top"))


@query(f"""WITH {_TERMS}, w AS (SELECT doc_id, c.term, n / sum(n) OVER (PARTITION BY doc_id) * idf AS weight FROM c JOIN s ON c.term = s.term),
nm AS (SELECT doc_id, sqrt(sum(weight * weight)) AS norm FROM w GROUP BY doc_id),
p AS (SELECT a.doc_id AS query, b.doc_id, sum(a.weight * b.weight) AS dot FROM w a JOIN w b ON a.term = b.term AND a.doc_id <> b.doc_id GROUP BY ALL),
k AS (SELECT query, p.doc_id, round(dot / (x.norm * y.norm), 6) AS cosine FROM p JOIN nm x ON x.doc_id = p.doc_id JOIN nm y ON y.doc_id = query)
SELECT query, doc_id, cosine, CAST(row_number() OVER (PARTITION BY query ORDER BY cosine DESC, doc_id) AS INTEGER) AS rank FROM k QUALIFY rank <= 5""")
def tfidf_neighbors(spark, sf_dir):
    return text_search.nearest_texts(A.table(spark, sf_dir, "documents"), "doc_id", "text")


# -- messages in order ---------------------------------------------------
@query(f"""WITH {A.MSG}, f AS (SELECT *, CASE WHEN lag(sender) OVER w = sender AND epoch_us(ts) - epoch_us(lag(ts) OVER w) < 7200000000 THEN 0 ELSE 1 END AS new
  FROM msg WINDOW w AS (PARTITION BY chat_id ORDER BY idx)),
r AS (SELECT *, sum(new) OVER (PARTITION BY chat_id ORDER BY idx) AS run FROM f)
SELECT chat_id, min(idx) AS idx, arg_min(ts, idx) AS ts, any_value(sender) AS sender, string_agg(content, chr(10) ORDER BY idx) AS content, count(*) AS n
FROM r GROUP BY chat_id, run""")
def burst_coalesce(spark, sf_dir):
    return sequences.burst_coalesce(A.event_messages(spark, sf_dir), 7200.0)


@query(f"""WITH {A.MSG}, g AS (SELECT chat_id, idx, greatest(0, (epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY chat_id ORDER BY idx))) / 60000000.0) AS m,
  lag(idx) OVER (PARTITION BY chat_id ORDER BY idx) AS p FROM msg)
SELECT chat_id, idx, round(CASE WHEN p IS NOT NULL THEN m END, 4) AS gap_minutes, round(CASE WHEN p IS NULL THEN 1 ELSE least(1, m / 360) END, 4) AS gap_norm,
  round(CASE WHEN p IS NOT NULL THEN exp(-m / 180) END, 4) AS proximity FROM g""")
def gap_features(spark, sf_dir):
    g = sequences.gap_features(A.event_messages(spark, sf_dir))
    return g.select("chat_id", "idx", *[F.round(c, 4).alias(c) for c in ("gap_minutes", "gap_norm", "proximity")])


def _quoting(spark, sf_dir):
    return A.event_messages(spark, sf_dir).withColumns({"quote_sender": F.col("sender"), "quote_text": F.col("content")})


@query(f"""WITH {A.MSG}, j AS (SELECT chat_id, idx, lag(idx) OVER (PARTITION BY chat_id, sender, content ORDER BY idx) AS quoted_idx FROM msg)
SELECT * FROM j WHERE quoted_idx IS NOT NULL""")
def quote_asof(spark, sf_dir):
    return sequences.quote_asof(_quoting(spark, sf_dir))


@query(f"""WITH {A.MSG} SELECT a.chat_id, a.idx, arg_max(b.idx, (b.ts, b.idx)) AS quoted_idx FROM msg a JOIN msg b ON a.chat_id = b.chat_id AND a.sender = b.sender
AND a.content = b.content AND b.ts <= a.ts AND a.idx <> b.idx GROUP BY ALL""")
def quote_by_time(spark, sf_dir):
    return sequences.quote_by_time(_quoting(spark, sf_dir))


@query(f"WITH {A.MSG} SELECT chat_id, idx, CAST(idx AS INTEGER) AS pos FROM msg")
def quote_order(spark, sf_dir):
    return sequences.quote_order(_quoting(spark, sf_dir)).select("chat_id", "idx", "pos")


_SESSIONS = f"""{A.MSG}, b AS (SELECT *, CASE WHEN epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY chat_id ORDER BY idx)) >= 7200000000 THEN 1 ELSE 0 END AS new FROM msg),
ses AS (SELECT *, CAST(sum(new) OVER (PARTITION BY chat_id ORDER BY idx) AS BIGINT) AS session FROM b)"""


@query(f"WITH {_SESSIONS} SELECT chat_id, idx, session FROM ses")
def session_threads(spark, sf_dir):
    return sequences.sessions(A.event_messages(spark, sf_dir), 2.0).select("chat_id", "idx", "session")


@query(f"""WITH {_SESSIONS} SELECT chat_id || '-' || session AS thread_id, min(ts) AS start_time, max(ts) AS last_time, count(*) AS num_messages,
  array_to_string(list_sort(list(DISTINCT sender)), ',') AS participants, arg_max(sender, idx) AS last_sender, count(DISTINCT sender) AS num_unique_senders
FROM ses GROUP BY chat_id, session""")
def thread_summary(spark, sf_dir):
    m = sequences.sessions(A.event_messages(spark, sf_dir), 2.0).withColumn("thread_id", F.concat_ws("-", "chat_id", "session"))
    return sequences.thread_summary(m).withColumn("participants", F.array_join(F.transform("participants", lambda x: x.cast("string")), ","))


@query(f"""WITH {A.CONV}, f AS (SELECT *, min(idx) OVER (PARTITION BY thread_id, sender) AS o FROM conv)
SELECT thread_id, idx, sender, CAST(dense_rank() OVER (PARTITION BY thread_id ORDER BY o) AS INTEGER) AS participant FROM f""")
def pseudonyms(spark, sf_dir):
    return sequences.pseudonyms(A.conversation_messages(spark, sf_dir)).select("thread_id", "idx", "sender", "participant")


@query(f"""WITH {A.CONV}, f AS (SELECT *, min(idx) OVER (PARTITION BY thread_id, sender) AS o FROM conv WHERE trim(content) <> ''),
l AS (SELECT *, row_number() OVER (PARTITION BY thread_id ORDER BY idx) - 1 AS n, dense_rank() OVER (PARTITION BY thread_id ORDER BY o) AS p FROM f)
SELECT thread_id, string_agg('[m' || n || '] (P' || p || ') ' || content, chr(10) ORDER BY n) AS rendered FROM l GROUP BY thread_id""")
def rendered_threads(spark, sf_dir):
    return sequences.rendered(A.conversation_messages(spark, sf_dir))


@query("""SELECT o_orderkey, lag(o_orderkey) OVER w AS prev_key, lead(o_orderkey) OVER w AS next_key, CAST(row_number() OVER w AS INTEGER) AS position,
  count(*) OVER (PARTITION BY o_custkey) AS total FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)""")
def queue_neighbors(spark, sf_dir):
    o = A.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return sequences.neighbors(o, "o_orderkey", [F.col("o_orderdate"), F.col("o_orderkey")], ["o_custkey"]).drop("o_custkey", "o_orderdate")


@query("""SELECT o_orderkey, CAST(floor((row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1) / 15) AS BIGINT) AS batch FROM orders""")
def mini_batches(spark, sf_dir):
    return sequences.batches(A.table(spark, sf_dir, "orders"), "o_custkey", ["o_orderkey"]).select("o_orderkey", "batch")


@query(f"""WITH {A.MSG}, g AS (SELECT chat_id AS thread_id, idx AS pos, greatest(0, (epoch_us(lead(ts) OVER w) - epoch_us(ts)) / 60000000.0) AS gap, value / 1000 AS sim,
  count(*) OVER (PARTITION BY chat_id) AS n FROM msg WINDOW w AS (PARTITION BY chat_id ORDER BY idx)),
s AS (SELECT *, 0.5 * least(1, gap / 360) + 0.5 * (1 - sim) - CASE WHEN gap <= 5 THEN 0.5 ELSE 0 END AS score FROM g WHERE n > 50 AND pos >= 9 AND pos < n - 10)
SELECT thread_id, arg_max(pos, (score, -pos)) AS pos, round(max(score), 6) AS score FROM s GROUP BY thread_id HAVING max(score) >= 0.4""")
def split_boundaries(spark, sf_dir):
    m = A.event_messages(spark, sf_dir).select(F.col("chat_id").alias("thread_id"), F.col("idx").alias("pos"), "ts", (F.col("value") / 1000).alias("next_sim"))
    return sequences.split_boundaries(m).withColumn("score", F.round("score", 6))


@query()
def aligned_senders(spark, sf_dir):
    m = A.event_messages(spark, sf_dir).select("chat_id", "idx", F.col("sender").cast("string").alias("sender"), F.concat_ws(":", "content", F.round("value", 1)).alias("content"))
    renamed = m.where("idx % 7 <> 3").withColumn("sender", F.concat(F.lit("user "), "sender"))
    return sequences.sender_mapping(sequences.sender_votes(sequences.align_senders(m, renamed)))


# -- views ---------------------------------------------------------------
@query("""WITH e AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders),
b AS (SELECT least(19, floor((o_totalprice - lo) / ((hi - lo) / 20))) AS bucket, count(*) AS n FROM orders, e GROUP BY 1)
SELECT CAST(r.i AS INTEGER) AS bucket, round(lo + r.i * ((hi - lo) / 20), 6) AS low, coalesce(n, 0) AS n FROM range(20) r(i), e LEFT JOIN b ON b.bucket = r.i""")
def price_histogram(spark, sf_dir):
    return views.histogram(A.table(spark, sf_dir, "orders"), "o_totalprice").withColumn("low", F.round("low", 6))


@query("SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS n FROM orders GROUP BY 1")
def month_histogram(spark, sf_dir):
    return views.month_histogram(A.table(spark, sf_dir, "orders"), "o_orderdate")


@query("""WITH t AS (SELECT unnest([lang, source]) AS value FROM documents) SELECT value, count(*) AS n FROM t GROUP BY value ORDER BY n DESC, value LIMIT 15""")
def top_tags(spark, sf_dir):
    return views.top_values(A.table(spark, sf_dir, "documents").select(F.array("lang", "source").alias("tags")), "tags")


@query("""WITH s AS (SELECT lang, text, count(*) AS size FROM documents GROUP BY ALL)
SELECT lang, size, count(*) AS n FROM s GROUP BY GROUPING SETS ((lang, size), (size))""")
def cluster_sizes(spark, sf_dir):
    return views.size_histogram(A.table(spark, sf_dir, "documents").select("lang", F.md5(F.col("text").cast("binary")).alias("c")), "lang", "c")


@query("""SELECT o_orderkey, o_totalprice, (SELECT count(*) FROM orders WHERE o_totalprice BETWEEN 1000 AND 200000 AND o_orderstatus = 'F') AS total FROM orders
WHERE o_totalprice BETWEEN 1000 AND 200000 AND o_orderstatus = 'F' ORDER BY o_totalprice DESC, o_orderkey LIMIT 50 OFFSET 100""")
def order_page(spark, sf_dir):
    rows = views.in_buckets(A.table(spark, sf_dir, "orders").where("o_orderstatus = 'F'"), o_totalprice=(1000, 200000)).select("o_orderkey", "o_totalprice")
    return views.page(rows, [F.desc("o_totalprice"), F.col("o_orderkey")], 100, 50)


@query(f"""WITH {A.CONV}, t AS (SELECT thread_id, count(*) AS m, count(DISTINCT sender) AS s, bool_or(contains(lower(content), 'the')) AS hit FROM conv GROUP BY thread_id),
r AS (SELECT *, m >= 3 AND s >= 2 AS passed FROM t)
SELECT thread_id, passed, CASE WHEN NOT passed THEN 'filtered_by_heuristic' WHEN NOT hit THEN 'outside_topic_filter' END AS reason FROM r""")
def heuristic_keep(spark, sf_dir):
    t = A.conversation_messages(spark, sf_dir).groupBy("thread_id").agg(
        F.count(F.lit(1)).alias("m"), F.count_distinct("sender").alias("s"), F.max(views.matches(F.col("content"), "the")).alias("hit")
    )
    t = t.withColumn("passed", views.keep_thread(F.col("m"), F.col("s")))
    return t.select("thread_id", "passed", views.reason(F.col("passed"), F.col("hit"), F.lit(True)).alias("reason"))


@query("""WITH r AS (SELECT *, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) AS n FROM orders) SELECT o_orderstatus, o_orderkey FROM r WHERE n <= 25""")
def budget_first(spark, sf_dir):
    return views.first_n(A.table(spark, sf_dir, "orders").select("o_orderstatus", "o_orderkey"), "o_orderkey", 25, ["o_orderstatus"])


@query("""SELECT CAST(doc_id AS BIGINT) AS doc_id FROM documents LEFT JOIN labels USING (doc_id) WHERE quality = 0""")
def useless_list(spark, sf_dir):
    d = A.table(spark, sf_dir, "documents").join(A.table(spark, sf_dir, "labels"), "doc_id", "left").withColumn("is_knowledge_bearing", F.col("quality") == 1)
    return views.filter_threads(d).select("doc_id")


# -- text ----------------------------------------------------------------
@query(r"""SELECT doc_id, md5(trim(regexp_replace(text, '\s+', ' ', 'g'))) AS folded FROM documents""")
def whitespace_collapse(spark, sf_dir):
    return A.table(spark, sf_dir, "documents").select("doc_id", F.md5(T.collapse_spaces(F.col("text")).cast("binary")).alias("folded"))


@query(r"""SELECT doc_id, array_to_string(regexp_extract_all(text, '[A-Za-z0-9._%+\-]+@[A-Za-z0-9.\-]+\.[A-Za-z]{2,}'), ',') AS emails FROM documents
WHERE regexp_matches(text, '[A-Za-z0-9._%+\-]+@[A-Za-z0-9.\-]+\.[A-Za-z]{2,}')""")
def emails(spark, sf_dir):
    d = A.table(spark, sf_dir, "documents").select("doc_id", T.find_emails(F.col("text")).alias("e")).where("size(e) > 0")
    return d.select("doc_id", F.array_join("e", ",").alias("emails"))


@query()
def redactions(spark, sf_dir):
    d = A.table(spark, sf_dir, "documents").select("doc_id", T.redact(F.col("text")).alias("r"))
    return d.select("doc_id", F.explode("r.redactions").alias("x")).groupBy("doc_id", "x.type").agg(F.count(F.lit(1)).alias("n"))


@query()
def redaction_restored(spark, sf_dir):
    d = A.table(spark, sf_dir, "documents").select("doc_id", "text", T.redact(F.col("text")).alias("r")).where("size(r.redactions) > 0")
    return d.select("doc_id", F.size("r.redactions").alias("n"), T.restore(F.col("r.text"), F.col("r.redactions")).alias("text"))


@query(r"""SELECT page_id, regexp_replace(u, '\.+$', '') AS site FROM (SELECT page_id, unnest(regexp_extract_all(url, '(?:https?://|www\.)[^\s<>"'')\]]+')) AS u FROM pages)""")
def websites(spark, sf_dir):
    return A.table(spark, sf_dir, "pages").select("page_id", F.explode(T.find_websites(F.col("url"))).alias("site"))


_LINES = ("hello there", "Dan was added", "Dan was added by Eve", "Eve added Dan", "added by hand: Eve added Dan", "image omitted", "Dan left", "you added Eve", "left over", "", "I removed it")
_FLAGS = (0, 1, 0, 1, 0, 1, 1, 1, 0, 1, 1)
_CASES = ", ".join(f"({i}, '{x}', {str(bool(f)).lower()})" for i, (x, f) in enumerate(zip(_LINES, _FLAGS, strict=True)))


@query(f"""WITH c AS (SELECT * FROM (VALUES {_CASES}) t(k, line, flag)) SELECT event_id, flag AS is_system FROM events JOIN c ON k = event_id % {len(_LINES)}""")
def system_flag(spark, sf_dir):
    """Every event says one of the lines, with marks of direction and spaces around it."""
    said = F.array(*map(F.lit, _LINES))[(F.col("event_id") % len(_LINES)).cast("int")]
    rows = A.table(spark, sf_dir, "events").select("event_id", F.concat(F.lit("\u200e "), said, F.lit(" \u200f")).alias("line"))
    return rows.select("event_id", T.is_system(T.normalize_content(F.col("line"))).alias("is_system"))


# -- entities ------------------------------------------------------------
@query("""WITH reg AS (SELECT p_name AS name, arg_max(p_brand, p_partkey) AS last, count(*) AS n FROM part GROUP BY 1),
men AS (SELECT l_orderkey AS claim_id, l_linenumber AS pos, p_name AS name, p_type AS wanted FROM lineitem JOIN part ON p_partkey = l_partkey),
top AS (SELECT p_name AS name, p_type AS wanted, count(*) AS hits, any_value(p_brand) AS brand FROM part GROUP BY ALL)
SELECT claim_id, pos, name, CASE WHEN n > 1 AND hits = 1 THEN brand ELSE last END AS canonical FROM men JOIN reg USING (name) LEFT JOIN top USING (name, wanted)""")
def resolve_entities(spark, sf_dir):
    part = A.table(spark, sf_dir, "part")
    reg = part.select(F.col("p_partkey").alias("ord"), F.col("p_name").alias("name"), F.col("p_brand").alias("canonical"), F.lit(None).cast("bigint").alias("claim_id"), F.array("p_type").alias("topics"))
    lines = A.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    men = lines.join(part.select("p_partkey", "p_name", "p_type"), F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_orderkey").alias("claim_id"), F.col("l_linenumber").alias("pos"), F.col("p_name").alias("name"), F.array("p_type").alias("topics")
    )
    return entities.resolve(men, reg)


@query(f"""WITH {A.CLM}, n AS (SELECT claim_id, unnest(list_distinct([lang, source])) AS name, lang, source FROM clm),
f AS (SELECT name, claim_id, row_number() OVER (PARTITION BY name ORDER BY claim_id) AS k FROM n),
t AS (SELECT DISTINCT name, unnest([lang, source]) AS topic FROM n)
SELECT n.name, count(DISTINCT n.claim_id) AS claim_count, (SELECT string_agg(CAST(claim_id AS VARCHAR), ',' ORDER BY claim_id) FROM f WHERE f.name = n.name AND k <= 12) AS samples,
  (SELECT string_agg(topic, ',' ORDER BY topic) FROM t WHERE t.name = n.name) AS topics FROM n GROUP BY n.name""")
def entity_strings(spark, sf_dir):
    c = A.claims(spark, sf_dir).withColumn("entities", F.col("topics"))
    e = entities.collect_strings(c)
    return e.select("name", "claim_count", F.array_join(F.transform("sample_claim_ids", lambda x: x.cast("string")), ",").alias("samples"), F.array_join("topics", ",").alias("topics"))


@query(r"""WITH d AS (SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN [source] ELSE [source, lang] END AS names,
  regexp_extract_all(text, '[A-Za-z0-9._%+\-]+@[A-Za-z0-9.\-]+\.[A-Za-z]{2,}') AS found FROM documents),
e AS (SELECT names, len(names) = 1 AS sure, unnest(found) AS contact FROM d), o AS (SELECT name, contact, bool_or(sure) AS sure FROM (SELECT unnest(names) AS name, contact, sure FROM e) GROUP BY ALL)
SELECT name, coalesce(string_agg(contact, ',' ORDER BY contact) FILTER (sure), '') AS contacts, coalesce(string_agg(contact, ',' ORDER BY contact) FILTER (NOT sure), '') AS unsure
FROM o GROUP BY name""")
def contacts_confident(spark, sf_dir):
    d = A.table(spark, sf_dir, "documents").select("text", F.when(F.col("doc_id") % 2 == 0, F.array("source")).otherwise(F.array("source", "lang")).alias("entities"))
    c = entities.contacts(d, T.find_emails(F.col("text")))
    return c.select("name", F.array_join("contacts", ",").alias("contacts"), F.array_join("contacts_uncertain", ",").alias("unsure"))


def _names(spark, sf_dir):
    p = A.table(spark, sf_dir, "part").groupBy(F.col("p_name").alias("name")).agg(
        F.min("p_partkey").alias("ord"), F.count(F.lit(1)).alias("claim_count"), F.array_sort(F.collect_set("p_type")).alias("topics"),
        F.slice(F.array_sort(F.collect_set("p_partkey")), 1, 12).alias("claim_ids"),
    )
    none = F.array().cast("array<string>")
    return entities.with_forms(p.withColumns({"contacts": none, "seed": F.lit(None).cast("string")}))


@query()
def pair_signals(spark, sf_dir):
    n = _names(spark, sf_dir)
    return entities.pair_signals(entities.candidate_pairs(n), n)


@query()
def entity_clusters(spark, sf_dir):
    n = _names(spark, sf_dir).persist()
    c = entities.clusters(entities.pair_signals(entities.candidate_pairs(n), n), n)
    return entities.canonical(n.join(c, "ord").select("cluster", "name", "claim_count", "ord", "topics"))


@query(f"""WITH {A.CLM} SELECT claim_id FROM clm WHERE claim_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)""")
def deleted_claims(spark, sf_dir):
    gone = A.table(spark, sf_dir, "labels").where("toxic = 1").select(F.col("doc_id").alias("claim_id"))
    return edits.delete(A.claims(spark, sf_dir).select("claim_id"), gone, "claim_id")


@query(f"""WITH {A.CLM}, g AS (SELECT min(claim_id) OVER (PARTITION BY claim_text) AS rep, claim_id AS member FROM clm)
SELECT rep AS claim_id, coalesce(string_agg(CAST(member AS VARCHAR), ',' ORDER BY member) FILTER (member <> rep), '') AS folded FROM g GROUP BY rep""")
def manual_groups(spark, sf_dir):
    c = A.claims(spark, sf_dir).select("claim_id", "claim_text")
    g = c.join(c.groupBy("claim_text").agg(F.min("claim_id").alias("representative")), "claim_text").select("representative", F.col("claim_id").alias("member"))
    out = edits.fold_groups(c.select("claim_id"), g)
    return out.select("claim_id", F.array_join(F.transform("folded", lambda x: x.cast("string")), ",").alias("folded"))


@query()
def name_mentions(spark, sf_dir):
    t = A.table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("claim_id"), "text")
    w = F.split("text", " ")
    n = t.select(F.explode(F.array(F.slice(w, 1, 1), F.slice(w, 2, 2))).alias("w")).select(F.array_join("w", " ").alias("name")).where("name <> ''").distinct()
    return entities.mentions(t, n)


# -- pages ---------------------------------------------------------------
def _pages(spark, sf_dir):
    n, r = A.table(spark, sf_dir, "nation"), A.table(spark, sf_dir, "region")
    return n.join(r, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.concat(F.lit("p"), (F.col("n_nationkey") % 20).cast("string")).alias("page_id"), F.col("n_nationkey").alias("ord"), F.col("n_name").alias("title"),
        F.when(F.col("n_nationkey") % 6 == 0, "").otherwise(F.col("r_name")).alias("category"),
        F.array(F.concat(F.lit("src"), (F.col("n_nationkey") % 20).cast("string")), F.lit("other")).alias("source_tags"),
    )


_PAGES = """raw AS (SELECT 'p' || (n_nationkey % 20) AS page_id, n_nationkey AS ord, n_name AS title, CASE WHEN n_nationkey % 6 = 0 THEN '' ELSE r_name END AS category,
  'src' || (n_nationkey % 20) AS tag FROM nation JOIN region ON n_regionkey = r_regionkey),
one AS (SELECT * FROM raw QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY ord) = 1),
pg AS (SELECT page_id, ord, title, CASE WHEN category = '' THEN 'general' ELSE category END AS category, CASE WHEN tag IN (SELECT source FROM documents) THEN tag ELSE '' END AS tags FROM one)"""


def _valid(spark, sf_dir):
    return pages.valid_pages(_pages(spark, sf_dir), A.table(spark, sf_dir, "documents").select(F.col("source").alias("tag")))


@query(f"WITH {_PAGES} SELECT * FROM pg")
def plan_pages(spark, sf_dir):
    return _valid(spark, sf_dir).select("page_id", "ord", "title", "category", F.array_join("source_tags", ",").alias("tags"))


_LINK = "lk AS (SELECT 'p' || (n_nationkey % 20) AS src, 'p' || ((n_nationkey * 7) % 23) AS dst, n_nationkey AS ord FROM nation)"


def _links(spark, sf_dir):
    key = F.col("n_nationkey")
    return A.table(spark, sf_dir, "nation").select(
        F.concat(F.lit("p"), (key % 20).cast("string")).alias("src"), F.concat(F.lit("p"), (key * 7 % 23).cast("string")).alias("dst"), key.alias("ord")
    )


@query(f"WITH {_PAGES}, {_LINK} SELECT src, dst, ord FROM lk WHERE src <> dst AND src IN (SELECT page_id FROM pg) AND dst IN (SELECT page_id FROM pg)")
def plan_links(spark, sf_dir):
    return pages.valid_links(_links(spark, sf_dir), _valid(spark, sf_dir))


@query(f"""WITH {_PAGES}, {_LINK}, b AS (SELECT src AS page_id, dst AS other, 0 AS kind, ord FROM lk UNION ALL SELECT dst, src, 1, ord FROM lk),
f AS (SELECT page_id, other, min((kind, ord)) AS place FROM b WHERE other IN (SELECT page_id FROM pg) GROUP BY ALL)
SELECT page_id, other, CAST(row_number() OVER (PARTITION BY page_id ORDER BY place) AS INTEGER) AS position FROM f""")
def related_pages(spark, sf_dir):
    k = _links(spark, sf_dir)
    return pages.related_pages(k, k.select(F.col("dst").alias("page_id"), F.col("src").alias("related"), "ord"), _valid(spark, sf_dir))


@query(f"""WITH {A.CLM}, {_PAGES}, t AS (SELECT claim_id, unnest([lang, source]) AS tag FROM clm),
i AS (SELECT tags AS tag, arg_min(page_id, ord) AS page_id FROM pg WHERE tags <> '' GROUP BY 1)
SELECT DISTINCT claim_id, coalesce(page_id, tag) AS page_id FROM t LEFT JOIN i USING (tag)""")
def route_pages(spark, sf_dir):
    return pages.route_claims(A.claims(spark, sf_dir), _valid(spark, sf_dir))


@query(f"""WITH {_PAGES}, h AS (SELECT * FROM pg WHERE tags <> ''), c AS (SELECT category, min(ord) AS category_ord FROM h GROUP BY 1)
SELECT page_id, category, category_ord, CAST(row_number() OVER (PARTITION BY category ORDER BY ord) AS INTEGER) AS page_ord FROM h JOIN c USING (category)""")
def navigation(spark, sf_dir):
    v = _valid(spark, sf_dir)
    return pages.navigation(v, v.where("size(source_tags) > 0")).select("page_id", "category", "category_ord", "page_ord")


_KEYS = (("one", 0, "the"), ("one", 0, "les"), ("two", 1, "und"), ("three", 2, "tion"), ("four", 3, "xyzzy"))


@query("""SELECT doc_id, CASE WHEN len(t) > 0 THEN array_to_string(t, ',') ELSE 'overview' END AS tags FROM (SELECT doc_id, list_filter([
  CASE WHEN contains(lower(text), 'the') OR contains(lower(text), 'les') THEN 'one' END, CASE WHEN contains(lower(text), 'und') THEN 'two' END,
  CASE WHEN contains(lower(text), 'tion') THEN 'three' END, CASE WHEN contains(lower(text), 'xyzzy') THEN 'four' END], lambda x: x IS NOT NULL)[1:2] AS t FROM documents)""")
def keyword_tags(spark, sf_dir):
    k = spark.createDataFrame(list(_KEYS), "tag string, ord int, keyword string")
    return pages.keyword_tags(A.table(spark, sf_dir, "documents"), "doc_id", "text", k, 2).select("doc_id", F.array_join("tags", ",").alias("tags"))


@query("SELECT DISTINCT item_id AS needle_id, doc_id AS hay_id FROM benchmark b JOIN documents d ON contains(d.text, b.text)")
def quote_containment(spark, sf_dir):
    n = A.table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("needle_id"), F.col("text").alias("needle"))
    return pages.contained(n, A.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("hay_id"), F.col("text").alias("hay")))


# -- graph ---------------------------------------------------------------
def _twins(spark, sf_dir):
    d = A.table(spark, sf_dir, "documents").select("doc_id", F.md5(F.col("text").cast("binary")).alias("h"))
    prev = F.lag("doc_id").over(Window.partitionBy("h").orderBy("doc_id"))
    return d.select(prev.alias("a"), F.col("doc_id").alias("b")).where("a is not null"), d


@query("SELECT doc_id AS node, min(doc_id) OVER (PARTITION BY text) AS component FROM documents")
def quote_components(spark, sf_dir):
    edges, d = _twins(spark, sf_dir)
    return graph.components(d.select(F.col("doc_id").alias("node")), edges)


@query("SELECT a.doc_id AS seed, b.doc_id AS node FROM documents a JOIN documents b ON a.text = b.text WHERE a.doc_id % 100 = 0")
def quote_closure(spark, sf_dir):
    edges, d = _twins(spark, sf_dir)
    return graph.closure(d.where("doc_id % 100 = 0").select(F.col("doc_id").alias("node")), edges)


# -- edits ---------------------------------------------------------------
@query(f"WITH {A.CONV} SELECT CASE WHEN thread_id IN (1, 2, 3) THEN 1 ELSE thread_id END AS thread_id, count(*) AS n FROM conv GROUP BY 1")
def merged_threads(spark, sf_dir):
    return edits.merge(A.conversation_messages(spark, sf_dir), "thread_id", [1, 2, 3]).groupBy("thread_id").agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH {A.CONV}, p AS (SELECT thread_id, idx, row_number() OVER (PARTITION BY thread_id ORDER BY idx) - 1 AS pos FROM conv)
SELECT thread_id, idx, CAST(pos AS INTEGER) AS pos, CAST(CASE WHEN thread_id % 2 = 0 AND pos >= 4 THEN 2 WHEN thread_id % 2 = 0 AND pos >= 2 THEN 1 ELSE 0 END AS INTEGER) AS part FROM p""")
def range_split(spark, sf_dir):
    m = A.conversation_messages(spark, sf_dir).select("thread_id", "idx")
    cuts = m.where("thread_id % 2 = 0").select("thread_id").distinct().select("thread_id", F.explode(F.array(F.lit(2), F.lit(4))).alias("start")).withColumn("part", (F.col("start") / 2).cast("int"))
    return edits.split_ranges(m, "thread_id", cuts, "idx")


@query(f"""WITH {A.CONV}, p AS (SELECT thread_id, idx, row_number() OVER (PARTITION BY thread_id ORDER BY idx) - 1 AS pos FROM conv)
SELECT CASE WHEN thread_id = 5 AND pos BETWEEN 0 AND 1 THEN 6 ELSE thread_id END AS thread_id, count(*) AS n FROM p GROUP BY 1""")
def moved_messages(spark, sf_dir):
    m = edits.move(A.conversation_messages(spark, sf_dir), "thread_id", 5, 6, 0, 1, "idx")
    return m.groupBy("thread_id").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT c_custkey, CASE WHEN c_custkey % 10 = 0 THEN 'changed' ELSE c_mktsegment END AS c_mktsegment FROM customer UNION ALL SELECT -1, 'new'""")
def upserted(spark, sf_dir):
    c = A.table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    ch = c.where("c_custkey % 10 = 0").select("c_custkey", F.lit("changed").alias("c_mktsegment"))
    return edits.upsert(c, ch.unionByName(spark.createDataFrame([(-1, "new")], "c_custkey bigint, c_mktsegment string")), "c_custkey")


@query(f"""WITH {_LINK}, m AS (SELECT CASE WHEN src IN ('p1', 'p2') THEN 'p1' ELSE src END AS src, CASE WHEN dst IN ('p1', 'p2') THEN 'p1' ELSE dst END AS dst FROM lk)
SELECT DISTINCT src, dst FROM m WHERE src <> dst""")
def merged_pages(spark, sf_dir):
    return edits.merge_pages(_links(spark, sf_dir), ["p1", "p2"], "p1")


# -- threads and sources -------------------------------------------------
@query()
def thread_assign(spark, sf_dir):
    """Events as messages with a vector each; every seventh quotes its sender, every fifth has a reactor."""
    m = _quoting(spark, sf_dir)
    v = A.vectors(spark, sf_dir)
    n = v.count()
    quotes = F.col("id") % 7 == 0
    rows = m.withColumn("k", F.col("id") % n).join(v.select(F.col("vec_id").alias("k"), F.col("embedding").alias("vector")), "k", "left").withColumns({
        "quote_sender": F.when(quotes, F.col("quote_sender")), "quote_text": F.when(quotes, F.col("quote_text")),
        "reactors": F.when(F.col("id") % 5 == 0, F.array((F.col("sender") + 10).cast("string"))).otherwise(F.array().cast("array<string>")),
    })
    return threads.assign(threads.with_term_weights(rows))


@query(f"""WITH {A.MSG}, s AS (SELECT chat_id, idx, date_trunc('second', ts) AS ts, 'S' || sender AS sender, content || CASE WHEN idx % 3 = 0 THEN chr(10) || 'and more' ELSE '' END AS content FROM msg),
f AS (SELECT *, CASE WHEN lag(sender) OVER w = sender AND epoch(ts) - epoch(lag(ts) OVER w) < 120 THEN 0 ELSE 1 END AS new FROM s WINDOW w AS (PARTITION BY chat_id ORDER BY idx)),
r AS (SELECT *, sum(new) OVER (PARTITION BY chat_id ORDER BY idx) AS run FROM f)
SELECT 'f' || chat_id AS file, CAST(run - 1 AS BIGINT) AS idx, arg_min(ts, idx) AS ts, any_value(sender) AS sender, string_agg(content, chr(10) ORDER BY idx) AS content FROM r GROUP BY chat_id, run""")
def parsed_export(spark, sf_dir):
    """The events of each chat written as an export of the new format, system lines between them, and parsed."""
    m = A.event_messages(spark, sf_dir)
    head = F.concat(F.lit("\u200e["), F.date_format("ts", "M/d/yy, h:mm:ss a"), F.lit("] "))
    line = F.concat(head, F.lit("S"), "sender", F.lit(": "), "content")
    text = F.array(line, F.when(F.col("idx") % 3 == 0, F.lit("and more")), F.when(F.col("idx") % 5 == 0, F.concat(head, F.lit("X: X left"))))
    rows = m.select(F.concat(F.lit("f"), "chat_id").alias("file"), "idx", F.posexplode(F.array_compact(text)).alias("part", "text"))
    return exports.parse_new_format(rows.select("file", (F.col("idx") * 3 + F.col("part")).alias("line_no"), "text"))
