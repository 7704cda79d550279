"""Operators on small tables with results worked out by hand."""

from __future__ import annotations

import datetime as dt
import math
import re
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from chatloom.functions import text as T
from chatloom.operators import aggregate, edits, entities, graph, pages, sequences, similarity, store, support, text_search, views
from chatloom.plans.queries import QUERIES
from chatloom.sources import artifacts, exports
from chatloom.streaming import threads

AT = dt.datetime(2024, 1, 1, 12, 0)


def minutes(n: float) -> dt.datetime:
    return AT + dt.timedelta(minutes=n)


# -- sources ---------------------------------------------------------------
def parse(spark, lines, old=False, **kw):
    df = spark.createDataFrame([("f", i, x) for i, x in enumerate(lines)], "file string, line_no int, text string")
    out = exports.parse_old_format(df, **kw) if old else exports.parse_new_format(df, **kw)
    return [(r.ts, r.sender, r.content) for r in out.orderBy("idx").collect()]


def test_new_format_joins_bursts_and_drops_system_lines(spark):
    got = parse(spark, [
        "[1/2/24, 9:00:00 AM] Dan: one", "more", "[1/2/24, 9:01:59 AM] Dan: two", "[1/2/24, 9:02:30 AM] Eve: Eve left",
        "goes to Dan", "[1/2/24, 9:10:00 PM] Dan: three", "[1/2/2024, 9:20:00 PM] Eve: <This message was edited>x",
    ])
    assert got == [
        (dt.datetime(2024, 1, 2, 9), "Dan", "one\nmore\ntwo\ngoes to Dan"), (dt.datetime(2024, 1, 2, 21, 10), "Dan", "three"),
        (dt.datetime(2024, 1, 2, 21, 20), "Eve", "x"),
    ]


def test_new_format_can_ignore_am_and_pm(spark):
    assert parse(spark, ["[1/2/24, 9:00:00 PM] Dan: one"], correct_pm=False)[0][0] == dt.datetime(2024, 1, 2, 9)


def test_old_format_stops_at_the_cutoff(spark):
    lines = ["1/2/24, 9:00 - Dan: a: b", "tail", "1/2/24, 9:30 - no sender here", "1/3/24, 9:00 - Dan: late", "late tail"]
    assert parse(spark, lines, old=True, cutoff="2024-01-03") == [(dt.datetime(2024, 1, 2, 9), "Dan", "a: b\ntail")]


def test_phone_export(spark):
    rows = spark.createDataFrame(
        [("02/01/2024", "10:05", '{"user_name":"Dan"}', "hi", "1", None, None), ("02/01/2024", "10:06", "Eve", "image omitted", "2", None, None)],
        exports.PHONE_SCHEMA,
    )
    (row,) = exports.phone_messages(rows).collect()
    assert (row.ts, row.sender, row.content, row.reactions) == (dt.datetime(2024, 1, 2, 10, 5), "Dan", "hi", [])


def test_overlay_backup_and_cache(spark, tmp_path):
    a, b = f"file://{tmp_path}/a", f"file://{tmp_path}/b"
    spark.range(3).write.parquet(a)
    assert artifacts.resolve(spark, a, b) == a
    artifacts.ensure_edited(spark, a, b)
    assert artifacts.resolve(spark, a, b) == b
    assert spark.read.parquet(artifacts.backup(spark, b, "s1")).count() == 3
    asked = []

    def model(df):
        asked.append(df.count())
        return df.withColumn("answer", F.upper("prompt"))

    requests = spark.createDataFrame([("k1", "a"), ("k2", "b"), ("k2", "b")], "key string, prompt string")
    answers, cache = artifacts.cached_answers(requests, spark.createDataFrame([("k1", "old")], "key string, answer string"), model)
    assert asked == [1] and cache.count() == 2
    assert sorted((r.key, r.answer) for r in answers.collect()) == [("k1", "old"), ("k2", "B"), ("k2", "B")]


# -- text --------------------------------------------------------------------
@pytest.mark.parametrize("text, kept, n", [
    ("mail a.b@c.org now", f"mail {T.REDACTION_MARK} now", 1), ("call 050-123-4567, or *5400", f"call {T.REDACTION_MARK}, or {T.REDACTION_MARK}", 2),
    ("year 2024 only", "year 2024 only", 0), (None, "", 0), ("", "", 0),
])
def test_redaction_and_back(spark, text, kept, n):
    df = spark.createDataFrame([(text,)], "t string").select("t", T.redact(F.col("t")).alias("r"))
    row = df.select("t", "r", T.restore(F.col("r.text"), F.col("r.redactions")).alias("back")).first()
    assert (row.r.text, len(row.r.redactions), row.back) == (kept, n, text or "")


# -- support -----------------------------------------------------------------
def test_support_counts_people_once(spark):
    v = spark.createDataFrame([
        ("c", "a", "statement", "neutral"), ("c", "a", "reaction", "positive"), ("c", "b", "reaction", "positive"), ("c", "d", "reaction", "negative"),
        ("c", "e", "opposing", "neutral"), ("c", "f", "reaction", "neutral"), ("x", "d", "reaction", "negative"),
    ], "claim string, user string, role string, sentiment string")
    got = {r.claim: (r.support_count, r.opposer_count, r.reaction_only_count) for r in support.support_counts(v).collect()}
    assert got == {"c": (2, 2, 1), "x": (1, 1, 0)}


def test_votes_ignore_blank_reactors_and_neutral_hearts(spark):
    m = spark.createDataFrame([("c", "a", "statement", [("👍", ["b", " "]), ("❤️", ["d"])])], "claim string, sender string, role string, reactions array<struct<emoji:string,senders:array<string>>>")
    got = sorted((r.user, r.role, r.sentiment) for r in support.votes_from_messages(m).collect())
    assert got == [("a", "statement", "neutral"), ("b", "reaction", "positive"), ("d", "reaction", "neutral")]


def test_engagement_is_a_union(spark):
    c = spark.createDataFrame([("p", 1), ("p", 1), ("p", 2), ("q", 3)], "page string, claim int")
    u = spark.createDataFrame([(1, "a"), (1, "b"), (2, "b"), (2, "c")], "claim int, user string")
    assert {r.page: r.support_count for r in support.engagement(c, u, "page").collect()} == {"p": 3, "q": 1}


def test_nearest_texts_are_those_of_all_pairs(spark, monkeypatch):
    """Copies beyond ``k``, repeated and unknown keys, texts without words; many blocks, many batches of queries."""
    rng = np.random.default_rng(5)
    rows = [(i, " ".join(f"w{int(x)}" for x in rng.zipf(1.4, int(rng.integers(1, 60))) % 500)) for i in range(120)]
    rows += [(200 + i, "a copy of Words") for i in range(9)] + [(300, None), (301, " -- "), (302, "alone"), (None, "w1 w2"), (None, "w3"), (10, "w1 more words"), (10, "w1"), (-10, "w2 a")]
    monkeypatch.setattr(text_search, "BATCH_BYTES", 500)
    docs = spark.createDataFrame(rows, "id bigint, body string").repartition(5)
    got = {(r.query, r["rank"]): (r.id, r.cosine) for r in text_search.nearest_texts(docs, "id", "body", F.col("id") % 10 == 0).collect()}
    counts = {}
    for i, body in rows:
        for w in re.findall("[a-z0-9]+", (body or "").lower()):
            counts.setdefault(i, Counter())[w] += 1
    df = Counter(w for c in counts.values() for w in c)
    n = len(counts) - 1
    weights = {i: {w: x * (math.log((1 + n) / (1 + df[w])) + 1) for w, x in c.items()} for i, c in counts.items() if i is not None}
    norm = {i: math.sqrt(sum(x * x for x in c.values())) for i, c in weights.items()}
    want = {}
    for q in weights:
        if q % 10 == 0:
            each = [(-round(sum(x * weights[q][w] for w, x in c.items() if w in weights[q]) / norm[i] / norm[q], 6), i) for i, c in weights.items() if i != q and c.keys() & weights[q].keys()]
            want |= {(q, r + 1): (i, -c) for r, (c, i) in enumerate(sorted(each)[:5])}
    assert got.keys() == want.keys()
    assert all(got[x][0] == want[x][0] and abs(got[x][1] - want[x][1]) < 1e-9 for x in want)


def test_every_text_asks_for_its_neighbors(spark):
    """The query answers for all documents with a word, not for a part of their ids."""
    texts = {r.doc_id: set(re.findall("[a-z0-9]+", (r.text or "").lower())) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    shared = {w for w, n in Counter(w for x in texts.values() for w in x).items() if n > 1}
    asked = Counter(r.query for r in QUERIES["tfidf_neighbors"](spark, "/root/testdata/sf0.001").collect())
    assert asked.keys() == {i for i, x in texts.items() if x & shared} and len(asked) > 100 and max(asked.values()) == 5


@pytest.mark.parametrize("dense", [1, 3, 1000])
def test_blocks_give_what_one_product_gives(monkeypatch, dense):
    """Steps of a few queries, terms all thin or all dense, more than ``k`` copies, a block of fewer than ``k`` texts."""
    rng = np.random.default_rng(8)
    bags = [rng.zipf(1.3, int(rng.integers(1, 60))) % 300 for _ in range(90)] + [np.array([7, 7, 9])] * 6
    for name, value in {"STEP_QUERIES": 3, "STEP_TERMS": 7, "DENSE": dense}.items():
        monkeypatch.setattr(text_search, name, value)
    keys = rng.permutation(len(bags))
    m = np.array([np.bincount(x, minlength=300) for x in bags], float)
    df = (m > 0).sum(axis=0)
    blocks = []
    for number, part in enumerate([slice(0, 40), slice(40, 42), slice(42, 96)]):
        some = bags[part]
        flags = np.ones(len(some), bool)
        row = text_search._packed(number, [(keys[part], flags, flags, np.array([len(x) for x in some]), np.concatenate(some).astype(np.int64))])
        here = np.frombuffer(row["hashes"], np.int64)
        blocks.append(text_search._opened(row | {"shared": here.tobytes(), "df": df[here].tobytes()}, len(bags)))
    m *= np.log((1 + len(bags)) / (1 + df)) + 1
    m /= np.linalg.norm(m, axis=1)[:, None]
    places = np.rint((m @ m.T) * 1e6).astype(int)
    want = {(keys[a], *x[1:], -x[0]) for a in range(len(bags)) for x in sorted((-places[a, b], keys[b]) for b in range(len(bags)) if a != b and m[a] @ m[b] > 0)[:4]}
    got = set()
    for block in blocks:
        best = text_search._Best(text_search._asked(block), 4)
        for other in blocks:
            best.see(other, *text_search._lines(other))
        got |= {(r["query"], r["key"], r["places"]) for r in best.rows().to_pylist()}
    assert got == want


def test_neighbors_make_no_rows_of_pairs(spark):
    """A query and a text that share terms meet within a block, not by a join."""
    found = QUERIES["tfidf_neighbors"](spark, "/root/testdata/sf0.001")
    assert "Join" not in found._jdf.queryExecution().toString()


# -- clustering --------------------------------------------------------------
def brute_linkage(d, threshold):
    groups = [[i] for i in range(len(d))]
    while True:
        best = None
        for x in range(len(groups)):
            for y in range(x + 1, len(groups)):
                far = max(d[i][j] for i in groups[x] for j in groups[y])
                if best is None or far < best[0]:
                    best = (far, x, y)
        if best is None or not best[0] < np.float32(threshold):
            return {i: min(g) for g in groups for i in g}
        groups[best[1]] += groups.pop(best[2])


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 12), st.integers(0, 10**6))
def test_linkage_is_that_of_brute_force(n, seed):
    rng = np.random.default_rng(seed)
    d = np.triu(rng.permutation(n * n).reshape(n, n) / (n * n + 1), 1).astype(np.float32) if n else np.zeros((0, 0))
    d = d + d.T
    assert dict(enumerate(aggregate.complete_linkage(d, 0.6))) == brute_linkage(d, 0.6)


def test_linkage_does_not_chain_and_large_clusters_are_halved():
    d = np.array([[0, 0.1, 0.5], [0.1, 0, 0.1], [0.5, 0.1, 0]])
    assert len(set(aggregate.complete_linkage(d, 0.3))) == 2
    flat = np.full((10, 10), 0.1, np.float32)
    np.fill_diagonal(flat, 0)
    assert max(np.bincount(aggregate.bisected(flat, np.zeros(10, int)))) <= 8
    assert set(aggregate.bisected(np.zeros((10, 10)), np.zeros(10, int))) == {0}


def test_group_limit_is_an_error_not_a_cut(spark):
    df = spark.createDataFrame([(1, i, [1.0, float(i)]) for i in range(6)], "g int, i int, v array<double>")
    with pytest.raises(Exception, match="over the limit"):
        aggregate.cluster_groups(df, ["g"], "i", "v", 0.3, cap=5).collect()
    assert aggregate.cluster_groups(df, ["g"], "i", "v", 0.3).count() == 6


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 40), st.integers(0, 10**6), st.sampled_from([0.05, 0.3, 0.7, 2.5]), st.sampled_from([0.0, 0.03]), st.sampled_from([40, 10**6]))
def test_tree_of_vectors_gives_the_clusters_of_the_matrix(n, seed, threshold, tight, cells):
    """With equal distances, copies and vectors without length, whole and in small steps."""
    x = np.random.default_rng(seed).integers(-2, 3, (n, 3)).astype(float)
    d = aggregate.cosine_distance(x)
    want = aggregate.bisected(d, aggregate.complete_linkage(d, threshold), 8, tight)
    with pytest.MonkeyPatch.context() as m:
        m.setattr(aggregate, "CELLS", cells)
        found = aggregate.split_tree(aggregate.complete_tree(x, threshold), 8, tight)
    got = {int(i): int(part[0]) for part in found for i in part}
    assert got == dict(enumerate(want))


def test_group_of_any_size_is_clustered(spark):
    n = 1_700
    angle = np.repeat(np.arange(n) * 2 * np.pi / n, 3) + np.tile([1e-4, 0, 2e-4], n)
    df = spark.createDataFrame([(1, i, [float(np.cos(a)), float(np.sin(a))]) for i, a in enumerate(angle)], "g int, i int, v array<double>")
    got = {(r.i, r.cluster, r.is_medoid) for r in aggregate.cluster_groups(df, ["g"], "i", "v", 1e-6).collect()}
    assert got == {(i, i - i % 3, i % 3 == 0) for i in range(3 * n)}


# -- names -------------------------------------------------------------------
def test_names():
    assert entities.normal_name("Dr. Éva  Cohen-Levi") == "eva cohen levi"
    assert entities.normal_name("050-123 4567") == "0501234567"
    assert entities.skeleton("הראל") == entities.skeleton("Harel") == "hrl"


def test_resolution_order(spark):
    reg = spark.createDataFrame([
        (1, "n", "first", None, ["t1"]), (2, "n", "second", None, ["t2"]), (3, "n", "bound", 7, ["t1"]),
    ], "ord int, name string, canonical string, claim_id int, topics array<string>")
    men = spark.createDataFrame([(7, 0, "n", ["t1"]), (8, 0, "n", ["t1"]), (9, 0, "n", ["x"]), (9, 1, "m", ["x"])], "claim_id int, pos int, name string, topics array<string>")
    got = {(r.claim_id, r.pos): r.canonical for r in entities.resolve(men, reg).collect()}
    assert got == {(7, 0): "bound", (8, 0): "first", (9, 0): "second", (9, 1): "m"}


def test_highlights_do_not_overlap(spark):
    s = spark.createDataFrame([(1, 0, 4, False, "a"), (1, 2, 9, False, "b"), (1, 3, 5, True, "c"), (1, 6, 7, False, "d")], "claim_id int, start int, end int, own boolean, name string")
    assert [x.name for x in entities.highlights(s).first().spans] == ["c", "d"]


# -- graph, views, edits, pages -----------------------------------------------
def test_components_of_a_long_chain(spark):
    n = 40
    nodes = spark.createDataFrame([(i,) for i in range(n + 1)], "node int")
    edges = spark.createDataFrame([(i, i + 1) for i in range(n - 1)], "a int, b int")
    got = {r.node: r.component for r in graph.components(nodes, edges).collect()}
    assert got == {**{i: 0 for i in range(n)}, n: n}
    assert graph.closure(nodes.where("node = 5"), edges).count() == n


def test_closure_reaches_the_ends_of_a_chain_of_any_length(spark):
    n = 300
    nodes = spark.createDataFrame([(i,) for i in range(n + 1)], "node int")
    edges = spark.createDataFrame([(i, i + 1) for i in range(n - 1)], "a int, b int")
    got = sorted(map(tuple, graph.closure(nodes.where(f"node in (5, 250, {n})"), edges).collect()))
    assert got == [(s, i) for s in (5, 250) for i in range(n)] + [(n, n)]


def test_histogram_of_equal_and_no_values(spark):
    one = spark.createDataFrame([(3.0,), (3.0,), (None,)], "v double")
    assert [(r.bucket, r.n) for r in views.histogram(one, "v").collect()] == [(0, 2)]
    assert views.histogram(one.where("v > 9"), "v").count() == 0


def test_upsert_and_fold(spark):
    a = spark.createDataFrame([(1, "x", "y"), (2, None, "z")], "k int, p string, q string")
    b = spark.createDataFrame([(2, "new"), (3, "add")], "k int, p string")
    assert sorted(map(tuple, edits.upsert(a, b, "k").collect())) == [(1, "x", "y"), (2, "new", "z"), (3, "add", None)]
    g = spark.createDataFrame([(1, 2), (1, 1)], "representative int, member int")
    c = spark.createDataFrame([(1,), (2,), (3,)], "claim_id int")
    assert {r.claim_id: r.folded for r in edits.fold_groups(c, g).collect()} == {1: [2], 3: []}


def test_contained_needs_the_whole_needle(spark):
    n = spark.createDataFrame([(1, "a b c d e f"), (2, "a b c d x y")], "needle_id int, needle string")
    h = spark.createDataFrame([(1, "z a b c d e f g"), (2, None), (3, "a b c d")], "hay_id int, hay string")
    assert [tuple(r) for r in pages.contained(n, h).collect()] == [(1, 1)]


def test_contained_finds_needles_of_every_length(spark):
    texts = ["the quick brown fox jumps over the lazy dog", "quickly  the\nfox", "öß the quick", "a", "", "fox jumps", "  x  y", None]
    quotes = [
        "fox", "ick", "k", "quick brown", "ck bro", "the quick brown", "he quick brow", "x jumps over t", "ick brown fox jumps over th", "own fox jumps over the lazy dog",
        "  the", "the\nfox", "ly  the", "the fox", "", " ", "öß", "ß the q", "jumpsover", "quick quick", "a b c d e", None,
    ]
    n = spark.createDataFrame(list(enumerate(quotes)), "needle_id int, needle string")
    h = spark.createDataFrame(list(enumerate(texts)), "hay_id int, hay string")
    want = sorted((i, j) for i, q in enumerate(quotes) for j, t in enumerate(texts) if q is not None and t is not None and q in t)
    assert sorted(map(tuple, pages.contained(n, h).collect())) == want


def test_similarity_of_empty_vectors_is_zero(spark):
    df = spark.createDataFrame([([1.0, 0.0], [1.0, 0.0]), ([0.0, 0.0], [1.0, 0.0]), ([], [])], "a array<double>, b array<double>")
    assert [r[0] for r in df.select(similarity.cosine(F.col("a"), F.col("b"))).collect()] == [1.0, 0.0, 0.0]


def test_sender_mapping_rules(spark):
    v = spark.createDataFrame([("o", "0501234567", 5, 0), ("o", "Dan", 2, 1), ("p", "Eve", 1, 2)], "old_sender string, new_sender string, n int, first_ord int")
    assert {r.old: r.new for r in sequences.sender_mapping(v).collect()} == {"o": "Dan", "p": "Eve"}
    assert {r.old: r.new for r in sequences.sender_mapping(v, False).collect()} == {"p": "Eve"}


def test_quote_order_moves_a_quoted_message_first(spark):
    m = spark.createDataFrame([
        (1, 0, minutes(0), "b", "reply", "a", "said"), (1, 1, minutes(0), "a", "said", None, None), (1, 2, minutes(1), "c", "x", None, None),
    ], "chat_id int, idx int, ts timestamp_ntz, sender string, content string, quote_sender string, quote_text string")
    assert [r.idx for r in sequences.quote_order(m).orderBy("pos").collect()] == [1, 0, 2]


# -- threads -----------------------------------------------------------------
def message(i, minute, sender="s", vector=(1.0, 0.0), text=None, quote=None):
    return threads.Message(i, minute * 60.0, sender, text or f"m{i}", np.array(vector), quote, (), {})


def test_quote_reopens_a_closed_thread():
    a = threads.Assigner()
    a.add(message(0, 0, "a", (1, 0), "hello"))
    a.add(message(1, 60 * 24 * 30, "b", (0, 1)))
    a.add(message(2, 60 * 24 * 30 + 1, "c", (0, 1), quote=("a", "hello")))
    assert [t for _, t, _ in a.rows()] == [1, 2, 1] and a.rows()[2][2] == "quote"


def test_monologue_and_reopening():
    a = threads.Assigner()
    a.add(message(0, 0, "a"))
    a.add(message(1, 5, "a"))
    a.add(message(2, 60 * 20, "b"))
    assert [how for _, _, how in a.rows()] == ["new_thread", "monologue", "reopen_closed"]


def test_long_thread_is_split_where_the_topic_changes():
    c = threads.Config(monologue_floor=-1.0, monologue_gap=10**9, close_hours=10**6)
    a = threads.Assigner(c)
    for i in range(30):
        a.add(message(i, i))
    for i in range(25):
        a.add(message(30 + i, 1000 + i, "s", (0.0, 1.0)))
    numbers = [t for _, t, _ in a.rows()]
    assert numbers == [1] * 30 + [2] * 25


def test_no_more_than_five_threads_are_open():
    a = threads.Assigner(threads.Config(reopen=2.0, attach=2.0))
    for i in range(8):
        a.add(message(i, i, f"s{i}", np.eye(8)[i]))
    assert len(a.open) == 5 and len(a.closed) == 3


def test_stream_gives_what_a_batch_gives(spark, tmp_path):
    rng = np.random.default_rng(1)
    rows = [(c, i, minutes(i * 17 + c), f"s{rng.integers(3)}", f"t{rng.integers(9)}", rng.normal(size=4).round(3).tolist(), None, None) for c in (1, 2) for i in range(40)]
    schema = "chat_id int, idx bigint, ts timestamp_ntz, sender string, content string, vector array<double>, quote_sender string, quote_text string"
    df = spark.createDataFrame(rows, schema)
    for k in range(2):
        df.where(f"floor(idx / 20) = {k}").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    q = threads.assign_stream(stream).writeStream.outputMode("update").option("checkpointLocation", f"{tmp_path}/cp").foreachBatch(
        lambda b, i: b.withColumn("batch", F.lit(i)).write.mode("append").parquet(f"{tmp_path}/out")
    ).trigger(availableNow=True).start()
    q.awaitTermination(120)
    out = spark.read.parquet(f"{tmp_path}/out").toPandas().sort_values("batch").drop_duplicates(["chat_id", "idx"], keep="last")
    want = threads.assign(df).toPandas()
    key = ["chat_id", "idx"]
    pd.testing.assert_frame_equal(
        out.sort_values(key)[[*key, "thread_no"]].reset_index(drop=True), want.sort_values(key)[[*key, "thread_no"]].reset_index(drop=True)
    )


# -- page store and member edits ------------------------------------------------
def test_actions_fold_in_order(spark):
    claims = spark.createDataFrame([("c1", "positive"), ("c2", None), ("c3", "negative")], "claim_id string, stance string")
    actions = spark.createDataFrame([
        ("p", 1, "S", None, "one", ["c1", " c2 ", "c1"]), ("p", 2, "S", None, "", ["c1"]), ("p", 3, None, "p-s1", "new text", ["c3", "gone"]),
        ("p", 4, "T", "p-s9", "two", ["c2"]), ("p", 5, "T", None, "none", ["gone"]), ("q", 6, None, None, "other", ["c1"]),
    ], "page_id string, ord int, section string, statement_id string, text string, claim_ids array<string>")
    got = store.fold_statements(actions, claims)
    assert sorted((r.statement_id, r.section, r.text, r.claim_ids) for r in got.collect()) == [
        ("p-s1", "S", "new text", ["c1", "c2", "c3"]), ("p-s2", "T", "two", ["c2"]), ("q-s1", "", "other", ["c1"]),
    ]
    people = spark.createDataFrame([("c1", "a"), ("c1", "b"), ("c2", "b"), ("c3", "c")], "claim string, user string")
    m = {r.statement_id: (r.support_count, r.stance_breakdown) for r in store.statement_measures(got, claims, people).collect()}
    assert m["p-s1"] == (3, {"positive": 1, "neutral": 1, "negative": 1}) and m["p-s2"] == (1, {"neutral": 1})
    pages_ = spark.createDataFrame([("p", "Page")], "page_id string, title string")
    text = store.page_markdown(pages_, got, store.statement_measures(got, claims, people)).first().markdown
    assert text == "# Page\n\n## S\n\n- new text (3)\n\n## T\n\n- two (1)\n"


def test_member_edits(spark):
    m = spark.createDataFrame([("e1", "a", [1, 2]), ("e2", "b", [3])], "entity_id string, name string, claim_ids array<int>")
    rows = lambda df: sorted((r.entity_id, r.name, r.claim_ids) for r in df.collect())
    assert rows(edits.reject_entity(m, "e1"))[0] == ("e1/a", "a", [1, 2])
    assert rows(edits.move_claims(m, "a", "e1", "e2", [2, 9])) == [("e1", "a", [1]), ("e2", "a", [2]), ("e2", "b", [3])]
    assert rows(edits.move_claims(m, "a", "e1", "e2", [2], copy=True))[0] == ("e1", "a", [1, 2])
    gone = spark.createDataFrame([("e1", 1)], "entity_id string, claim_id int")
    assert rows(edits.exclude_claims(m, gone)) == [("e1", "a", [2]), ("e2", "b", [3])]
    g = spark.createDataFrame([("g", 1, 1), ("g", 1, 2), ("g", 1, 3), ("h", 4, 4), ("h", 4, 5)], "group_id string, representative int, member int")
    assert sorted((r.group_id, r.representative, r.member) for r in edits.decouple(edits.decouple(g, "g", 1), "h", 5).collect()) == [("g", 2, 2), ("g", 2, 3)]


@pytest.mark.parametrize("text, want", [
    ("לאם הפונדקאית", "לפונדקאית"), ("האמא הפונדקאית", "הפונדקאית"), ("אמהות פונדקאיות", "פונדקאיות"), ("אם הפונדקאית חתמה", "אם הפונדקאית חתמה"),
    ("מהאמא הפונדקאית", "מהפונדקאית"),
])
def test_term_correction(spark, text, want):
    assert spark.createDataFrame([(text,)], "t string").select(T.correct_term(F.col("t"))).first()[0] == want
