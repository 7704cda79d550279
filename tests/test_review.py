"""Merging, classification, contacts, plans and reviews on worked examples and against plain Python."""

from __future__ import annotations

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from chatloom.operators import aggregate, classify, contacts, merge, plan, review
from chatloom.plans.queries import QUERIES

RX = "array<struct<emoji:string,senders:array<string>>>"
RED = "array<struct<type:string,value:string>>"
CLAIMS = f"claim_id bigint, ord bigint, claim_text string, topics array<string>, stance string, thread_id string, date string, entities array<string>, support_count int, redactions {RED}, v array<double>"
DATA = "/root/testdata/sf0.001"


def claims(spark, rows):
    return spark.createDataFrame(rows, CLAIMS)


def claim(i, text, stance="positive", topics=("a",), v=(1.0, 0.0), thread="t1", date="2024-01", entities=(), n=1, red=()):
    return (i, i, text, list(topics) if topics is not None else None, stance, thread, date, list(entities), n, [tuple(r) for r in red], [float(x) for x in v])


def audit(spark, rows):
    """(claim_id, authors, opposing, reactions or None, all_supporters, reaction_senders, reaction_opposers)"""
    return spark.createDataFrame(rows, merge.AUDIT)


# -- people ------------------------------------------------------------------
def test_participants_of_new_and_old_rows(spark):
    a = audit(spark, [
        (1, ["ann", "bob"], ["cy"], [("👍", ["dee", "ann", ""]), ("👎", ["eve"]), ("🤔", ["fay"])], ["zed"], [], []),
        (2, ["ann"], [], None, ["ann", "gus"], [], ["hal"]),
        (3, ["ann"], [], None, ["ann", "gus"], ["gus"], []),
        (4, [], [], [], None, None, None),
    ])
    got = {(r.claim_id, r.user, r.side): (r.stated, r.reacted) for r in merge.participants(a).collect()}
    assert got == {
        (1, "ann", "supporter"): (True, True), (1, "bob", "supporter"): (True, False), (1, "dee", "supporter"): (False, True), (1, "cy", "opposer"): (True, False),
        (1, "eve", "opposer"): (False, True), (2, "ann", "supporter"): (False, False), (2, "gus", "supporter"): (False, False), (2, "hal", "opposer"): (False, False), (3, "ann", "supporter"): (True, False),
    }
    ids = spark.createDataFrame([(i,) for i in (1, 2, 3, 4, 9)], "claim_id bigint")
    each = {r.claim_id: (r.supporter_count, r.opposer_count) for r in merge.engagement_of_claims(ids, a).collect()}
    assert each == {1: (3, 2), 2: (2, 1), 3: (1, 0), 4: (1, 0), 9: (1, 0)}
    cited = spark.createDataFrame([("x", 1), ("x", 2), ("x", 2), ("y", 4), ("z", None)], "grp string, claim_id bigint")
    for floor in ("each", "none"):
        both = {r.grp: (r.supporter_count, r.opposer_count) for r in merge.engagement_of_groups(cited, a, "grp", floor).collect()}
        assert both == {"x": (4, 3), "y": (1, 0), "z": (0, 0)}


# -- merging -----------------------------------------------------------------
def test_merged_record_has_every_measure(spark):
    rows = claims(spark, [
        claim(1, "no", "negative", date="2024-03", entities=["B", "A"], n=5, thread="t1"), claim(2, "yes", date="2024-01", entities=["C"], n=2, thread="t2", red=[("email", "x@y.org")]),
        claim(3, "yes!", date=None, thread="t2", n=1),
    ]).withColumns({"topic": F.lit("a"), "cluster": F.lit(1), "is_medoid": F.col("claim_id") == 2})
    a = audit(spark, [(1, ["ann"], [], [("👍", ["bob", "cy"]), ("🎉", ["bob"])], [], [], []), (2, ["bob"], [], [("👍", ["dee"]), ("👎", ["eve"]), ("", ["fay"])], [], [], [])])
    (r,) = merge.merge_records(rows, a, ["topic", "cluster"]).collect()
    assert (r.claim_text, r.variants, r.source_claim_ids) == ("yes", ["no", "yes", "yes!"], [1, 2, 3])
    assert (r.dominant_stance, r.stance_breakdown) == ("positive", {"negative": 1, "positive": 2})
    assert (r.support_count, r.statement_count, r.reaction_endorser_count, r.reaction_only_count) == (4, 2, 3, 2)
    assert [tuple(x) for x in r.reaction_summary] == [("👍", 3, "positive"), ("🎉", 1, "positive"), ("👎", 1, "negative")]
    assert (r.endorsement_count, r.thread_count, r.date_range, r.entities) == (3, 2, ["2024-01", "2024-03"], ["A", "B", "C"])
    assert [tuple(x) for x in r.pii_redactions] == [("email", "x@y.org")] and r.pii_needs_review
    (r,) = merge.merge_records(rows, a.where("false"), ["topic", "cluster"]).collect()
    assert (r.support_count, r.statement_count, r.reaction_summary) == (8, 0, [])


def test_merge_follows_stance_topic_and_groups(spark):
    rows = claims(spark, [
        claim(1, "a"), claim(2, "a2", v=(1.0, 0.02)), claim(3, "a3", "negative"), claim(4, "far", v=(0.0, 1.0)), claim(5, "both", topics=["a", "b"], v=(0.0, 1.0)), claim(6, "none", topics=None, v=(0.6, 0.8)),
        claim(7, "folded", "negative", topics=["b"], v=(-1.0, 0.0)),
    ])
    a = audit(spark, [(1, ["ann"], [], [], [], [], []), (2, ["bob"], [], [], [], [], []), (7, ["gus"], [], [], [], [], [])])
    groups = spark.createDataFrame([("g0", 1, [1, 7]), ("g1", 99, [99, 4])], "group_id string, representative bigint, claim_ids array<bigint>")
    got = {(r.topic, r.stance, tuple(r.source_claim_ids)): (r.claim_text, r.support_count) for r in merge.merge_claims(rows, a, "v", groups).collect()}
    assert got == {
        ("a", "positive", (1, 7, 2)): ("a", 3), ("a", "negative", (3,)): ("a3", 1), ("a", "positive", (4, 5)): ("far", 2), ("b", "positive", (5,)): ("both", 1), ("overview", "positive", (6,)): ("none", 1),
    }


def test_stance_clusters_are_those_of_plain_python(spark):
    """The registered query against linkage, medoid and member lists worked out one by one."""
    got = {(r.topic, r.stance, tuple(sorted(r.source_claim_ids))) for r in QUERIES["stance_clusters"](spark, DATA).collect()}
    rows = {r.vec_id: (r.label, np.array(r.embedding, float)) for r in spark.read.parquet(f"{DATA}/embeddings.parquet").collect()}
    low, high = min(rows), max(rows)
    want = set()
    for label, stance in {(rows[i][0], i % 2) for i in rows}:
        ids = sorted(i for i in rows if rows[i][0] == label and i % 2 == stance and i != high)
        if not ids:
            continue
        x = np.stack([rows[i][1] / np.linalg.norm(rows[i][1]) for i in ids])
        d = (1 - x @ x.T).astype(np.float32)
        labels = aggregate.bisected(d, aggregate.complete_linkage(d, 0.7), 8, 0.03)
        for k in set(labels.tolist()):
            members = [ids[m] for m in np.flatnonzero(labels == k)]
            want.add((f"t{label}", "negative" if stance else "positive", tuple(sorted(members + ([high] if low in members else [])))))
    assert got == want


def test_topic_and_stance_of_any_size_are_merged(spark):
    """More claims of one topic and stance than a matrix of distances was made for; copies at each of 1,700 angles."""
    n = 1_700
    at = F.floor(F.col("id") / 3) * F.lit(2 * np.pi / n)
    rows = spark.range(3 * n).select(
        F.col("id").alias("claim_id"), F.col("id").alias("ord"), F.concat(F.lit("c"), F.col("id").cast("string")).alias("claim_text"), F.array(F.lit("a")).alias("topics"), F.lit("positive").alias("stance"),
        F.lit("t").alias("thread_id"), F.lit("2024-01").alias("date"), F.array(F.lit("x")).alias("entities"), F.lit(1).alias("support_count"), F.array().cast(RED).alias("redactions"), F.array(F.cos(at), F.sin(at)).alias("v"),
    )
    got = {tuple(r.source_claim_ids) for r in merge.merge_claims(rows, audit(spark, []), "v", None, 1 - 1e-6).collect()}
    assert got == {(i, i + 1, i + 2) for i in range(0, 3 * n, 3)}


def test_claims_are_clustered_once_for_all_measures(spark, monkeypatch, tmp_path):
    """Each group once, whatever reads the merged claims, and the plan of the measures holds no clustering."""
    seen = tmp_path / "seen"

    def noted(rows, keys, item, *rest):
        found = aggregate.cluster_groups(rows, keys, item, *rest)

        def note(batches):
            for batch in batches:
                with seen.open("a") as f:
                    f.writelines(f"{x}\n" for x in batch.column(item).to_pylist())
                yield batch

        return found.mapInArrow(note, found.schema)

    monkeypatch.setattr(merge, "cluster_groups", noted)
    rows = claims(spark, [claim(1, "a"), claim(2, "a2", v=(1.0, 0.02)), claim(3, "b", "negative"), claim(4, "far", v=(0.0, 1.0))])
    a = audit(spark, [(1, ["ann"], [], [("👍", ["bob"])], [], [], []), (3, ["cy"], [], None, [], [], ["dee"])])
    out = merge.merge_claims(rows, a, "v")
    assert {(tuple(r.source_claim_ids), r.support_count) for r in out.collect()} == {((1, 2), 2), ((3,), 1), ((4,), 1)}
    assert sorted(seen.read_text().split()) == ["1", "2", "3", "4"]
    assert "Pandas" not in out._jdf.queryExecution().toString()


def test_edits_of_merged_groups(spark):
    m = spark.createDataFrame([("a", "1", 1, 0), ("a", "1", 2, 1), ("a", "1", 3, 2), ("a", "4", 4, 0), ("b", "1", 9, 0)], "topic string, key string, claim_id bigint, pos bigint")
    rows = lambda df: sorted((r.topic, r.key, r.claim_id, r.pos) for r in df.collect())
    assert rows(merge.move_member(m, "a", 2, "1", "4")) == [("a", "1", 1, 0), ("a", "1", 3, 2), ("a", "4", 2, 1), ("a", "4", 4, 0), ("b", "1", 9, 0)]
    assert rows(merge.split_group(m, "a", "1", [3, 1], "new")) == [("a", "1", 2, 1), ("a", "4", 4, 0), ("a", "new", 1, 1), ("a", "new", 3, 0), ("b", "1", 9, 0)]
    for ids in ([], [1, 2, 3], [1, 4]):
        with pytest.raises(ValueError):
            merge.split_group(m, "a", "1", ids, "new")
    texts = spark.createDataFrame([(i, f"c{i}") for i in (1, 2, 3, 4, 9)], "claim_id bigint, claim_text string")
    chosen = spark.createDataFrame([("a", "1", "c3"), ("a", "4", "gone")], "topic string, key string, claim_text string")
    got = {(r.topic, r.key): r.claim_text for r in merge.representatives(m, texts, chosen).collect()}
    assert got == {("a", "1"): "c3", ("a", "4"): "c4", ("b", "1"): "c9"}


# -- classification ----------------------------------------------------------
def test_answers_parse_or_say_why_not(spark):
    answers = [
        ("a", '```json\n{"is_knowledge_bearing": true, "topic_tags": ["x", "new", "new"], "entities": ["E"], "reason": "r"}\n```'), ("b", "no JSON"), ("c", ""), ("d", None),
        ("e", '{"is_knowledge_bearing": 0, "reason": "none"}'), ("f", '{"topic_tags": ["x"]}'),
    ]
    known = spark.createDataFrame([("x",), ("y",)], "tag string")
    got = {r.thread_id: tuple(r)[1:] for r in classify.parse_class(spark.createDataFrame(answers, "thread_id string, answer string"), known).collect()}
    bad = (False, [], [], [], "classification_error")
    assert got == {"a": (True, ["x", "new", "new"], ["new", "new"], ["E"], "r"), "b": bad, "c": bad, "d": bad, "e": (False, [], [], [], "none"), "f": (False, ["x"], [], [], "")}
    asked = spark.createDataFrame([("a", 0, True, None, True), ("b", 1, False, "filtered_by_heuristic", False)], "thread_id string, ord int, passed_heuristic boolean, reason string, asked boolean")
    both = classify.merged_classes(asked, classify.parse_class(spark.createDataFrame(answers[:1], "thread_id string, answer string"), known))
    assert {r.thread_id: (r.is_knowledge_bearing, r.reason, r.topic_tags) for r in both.collect()} == {"a": (True, "r", ["x", "new", "new"]), "b": (False, "filtered_by_heuristic", [])}


def test_extracted_claims_and_their_votes(spark):
    answer = json.dumps({"claims": [
        {"claim_text": " one ", "topic_tags": ["x", "z"], "stance": "positive", "supporting_message_ids": [1, 2, 7], "opposing_message_ids": [2]}, "junk", {"claim_text": ""}, {"claim_text": "two", "supporting_message_ids": [True]},
    ]})
    messages = spark.createDataFrame([("t", 0, "ann", "hi"), ("t", 1, "bob", " "), ("t", 2, "bob", "yes"), ("t", 5, "cy", "no")], "thread_id string, idx int, sender string, content string")
    lines = classify.rendered_lines(messages).withColumns({"month": F.concat(F.lit("2024-0"), (F.col("line") + 1).cast("string")), "reactions": F.array(F.struct(F.lit("👍").alias("emoji"), F.array(F.lit("dee")).alias("senders")))})
    assert sorted((r.line, r.idx) for r in lines.collect()) == [(0, 0), (1, 2), (2, 5)]
    known = spark.createDataFrame([("x",)], "tag string")
    found = classify.claims_from_answers(spark.createDataFrame([("t", answer), ("u", "bad")], "thread_id string, answer string"), lines, known)
    rows = {r.claim_id: r for r in found.collect()}
    assert sorted(rows) == ["t-c0", "t-c3"]
    one, two = rows["t-c0"], rows["t-c3"]
    assert (one.claim_text, one.supporting, one.opposing, one.emergent_tags, one.date, one.stance) == ("one", [1, 2], [2], ["z"], "2024-02", "positive")
    assert (two.supporting, two.date, two.stance) == ([], "2024-01", "neutral")
    votes = classify.claim_votes(found, lines)
    assert sorted((r.sender, r.role, r.reactions is not None) for r in votes.collect()) == [("bob", "statement", True), ("cy", "opposing", True), ("cy", "statement", False)]


# -- contacts ------------------------------------------------------------------
def test_contacts_keep_those_of_the_original(spark):
    now = spark.createDataFrame([(1, "see www.site.org or write", []), (2, None, None)], f"claim_id int, claim_text string, redactions {RED}")
    old = spark.createDataFrame([(1, "write to [x]", [("email", "a@b.org"), ("other", "z")]), (1, "again", [])], f"claim_id int, claim_text string, redactions {RED}").limit(1)
    got = {r.claim_id: [tuple(c) for c in r.contacts] for r in contacts.claim_contacts(now, old).collect()}
    assert got[2] == [] and ("email", "a@b.org") in got[1] and any(k == "website" for k, _ in got[1]) and not any(v == "z" for _, v in got[1])
    (row,) = spark.createDataFrame([([" a ", "", "b", "a", None],)], "x array<string>").select(contacts.clean_contacts(F.col("x")).alias("x")).collect()
    assert row.x == ["a", "b"]
    (row,) = spark.createDataFrame([([("email", "a@b.org")],)], f"c {contacts.CONTACT}").select(contacts.contact_keys(F.col("c")).alias("k")).collect()
    assert row.k == ["email:a@b.org"]


def test_name_records_count_mentions_and_rank_contacts(spark):
    c = spark.createDataFrame([(1, 0, ["Ann"], ["t1"]), (2, 1, ["Ann", "Bob", " "], ["t2"]), (3, 2, [], ["t3"]), (4, 3, None, ["t4"])], "claim_id int, ord int, entities array<string>, topics array<string>")
    k = spark.createDataFrame([(1, [("email", "a@x.org")]), (2, [("email", "a@x.org"), ("phone", "1")]), (3, [("email", "m@x.org")])], f"claim_id int, contacts {contacts.CONTACT}")
    told = spark.createDataFrame([(3, "Ann"), (1, "Ann"), (4, "Nobody")], "claim_id int, name string")
    got = {r.name: r for r in contacts.name_records(c, k, told, 2).collect()}
    assert sorted(got) == ["Ann", "Bob"]
    ann = got["Ann"]
    assert (ann.claim_count, ann.sample_claim_ids, ann.topics) == (3, [1, 2], ["t1", "t2", "t3"])
    assert [tuple(x) for x in ann.contacts] == [("email", "a@x.org")]
    assert [tuple(x) for x in ann.contacts_uncertain] == [("email", "m@x.org"), ("phone", "1")]
    assert [tuple(x) for x in got["Bob"].contacts] == []


def test_signals_and_conflicts_of_clusters(spark):
    pairs = spark.createDataFrame([(0, 1, 0.95, ["string"], False), (0, 2, 0.5, ["prefix"], True), (1, 2, 0.2, [], False)], "i int, j int, similarity double, signals array<string>, guarded boolean")
    own = spark.createDataFrame([(0, 0), (1, 0), (2, 2), (3, 3)], "ord int, cluster int")
    names = spark.createDataFrame([(0, "Ann", 2), (1, "Anne", 5), (2, "Anna", 1), (3, "Bob", 1)], "ord int, name string, claim_count int")
    got = {r.cluster: (r.merge_signals, r.conflict_with, r.status) for r in contacts.cluster_signals(pairs, own, names, 0.88).collect()}
    assert got == {0: (["string"], ["Anna"], "ambiguous"), 2: ([], ["Anne"], "ambiguous"), 3: ([], [], "suggested")}


# -- plans -----------------------------------------------------------------------
def test_edits_of_plans(spark):
    pages = spark.createDataFrame([("p", 0, "P", "c", ["a", "b"]), ("q", 1, "Q", "c", ["b", "d"]), ("r", 2, "R", "c", [])], "page_id string, ord int, title string, category string, source_tags array<string>")
    links = spark.createDataFrame([("q", "p", 0), ("q", "r", 1), ("r", "q", 2), ("r", "gone", 3)], "src string, dst string, ord int")
    merged, kept = plan.merge_pages(pages, links, "q", "p")
    assert {r.page_id: r.source_tags for r in merged.collect()} == {"p": ["a", "b", "d"], "r": []}
    assert sorted((r.src, r.dst) for r in kept.collect()) == [("p", "r"), ("r", "p")]
    assert {r.page_id: r.source_tags for r in plan.merge_pages(pages, links, "r", "q")[0].collect()}["q"] == ["b", "d", "r"]
    with pytest.raises(ValueError):
        plan.merge_pages(pages, links, "p", "p")
    new = {r.page_id: (r.title, r.category) for r in plan.update_page(pages, "q", ["c", "d"], title=" New ", category="d").collect()}
    assert new == {"p": ("P", "c"), "q": ("New", "d"), "r": ("R", "c")}
    with pytest.raises(ValueError):
        plan.update_page(pages, "q", ["c"], category="zzz")
    g = spark.createDataFrame([("a", "k1", 0), ("a", "k2", 1), ("a", "k2", 2), ("b", "k3", 4)], "topic string, key string, ord int")
    assert sorted(map(tuple, plan.move_claim(g, "a", "k2", "b").collect())) == [("a", "k1", 0), ("a", "k2", 2), ("b", "k2", 5), ("b", "k3", 4)]


def test_plan_falls_back_to_topics(spark):
    topics = spark.createDataFrame([("a", 0, "A", "c", 3), ("b", 1, "B", "c", 0)], "topic string, ord int, title string, category string, claim_count int")
    focus = spark.createDataFrame([("a", "find a")], "topic string, focus string")
    none = spark.createDataFrame([], "page_id string, ord int, title string, category string, source_tags array<string>, rationale string, search_focus string")
    assert [(r.page_id, r.search_focus) for r in plan.plan_or_identity(none, topics, focus).collect()] == [("a", "find a")]
    one = spark.createDataFrame([("p", 0, "P", "c", ["b"], "", "own")], none.schema)
    assert [r.page_id for r in plan.plan_or_identity(one, topics, focus).collect()] == ["p"]


def test_text_around_pages(spark):
    n = F.lit
    row = spark.range(1).select(
        plan.rtl(n("\n# x\n\n")).alias("rtl"), plan.support_note(n(1), n(2), n(0)).alias("one"), plan.support_note(n(3), n(2), n(1)).alias("more"), plan.stance_label(n("positive")).alias("s"), plan.stance_label(n("odd")).alias("o")
    ).first()
    assert row.rtl == '<div dir="rtl" markdown="1">\n\n# x\n\n</div>\n'
    assert (row.one, row.more) == (f"(1 {plan.SUPPORTERS})", f"(3 {plan.SUPPORTERS} · {plan.FOR}: 2 · {plan.AGAINST}: 1)") and (row.s, row.o) == (plan.STANCES["positive"], "odd")
    pages = spark.createDataFrame([("p", "P"), ("q", "Q")], "page_id string, title string")
    text = lambda rows, c: spark.createDataFrame(rows, f"page_id string, {c} string")
    links = plan.link_lists(spark.createDataFrame([("p", "q", 1)], "page_id string, other string, position int"), pages)
    cited = spark.createDataFrame([("p", [1, 2, 2]), ("p", [9])], "page_id string, claim_ids array<int>")
    feet = plan.page_footers(cited, spark.createDataFrame([(1, "2024-01"), (2, "2024-03")], "claim_id int, date string"))
    whole = {r.page_id: r.markdown for r in plan.page_texts(pages, text([("p", " said ")], "text"), text([("q", "known")], "text"), text([("p", "SRC\n")], "sources"), links, feet).collect()}
    assert whole["p"] == f'<div dir="rtl" markdown="1">\n\n# P\n\n{plan.COMMUNITY}\n\nsaid\n\nSRC\n\n{plan.RELATED}\n\n- [Q](q.md)\n' + (plan.FOOTER % (3, "2024-01–2024-03")).rstrip() + "\n\n</div>\n"
    assert plan.NO_COMMUNITY in whole["q"] and plan.BACKGROUND + "known" in whole["q"] and plan.RELATED not in whole["q"]
    t = spark.createDataFrame([("a", "A", "c", 2, ["X"], []), ("b", "B", "c", 1, [], ["s1", "s2"])], "topic string, title string, category string, claim_count int, entities array<string>, samples array<string>")
    assert [r.l for r in t.select(plan.summary_line().alias("l")).collect()][1] == "- id: b | title: B | claims: 1 | category: c | entities: (none) | samples: s1 / s2"


# -- reviews --------------------------------------------------------------------
def test_families_ranges_and_classes(spark):
    ids = spark.createDataFrame([("t",), ("t-split-2",), ("t-split-2-split-1",), ("x-split-y",)], "thread_id string")
    assert [r.f for r in ids.select(review.family(F.col("thread_id")).alias("f")).collect()] == ["t", "t", "t-split-2", "x-split-y"]
    sizes = spark.createDataFrame([("a", 10), ("b", 4), ("c", 3)], "thread_id string, n int")
    cuts = spark.createDataFrame([("a", 0, 4), ("a", 5, 9), ("b", 0, 1), ("b", 3, 3), ("c", 0, 2), ("c", 2, 2), ("z", 0, 1)], "thread_id string, low int, high int")
    assert sorted((r.thread_id, r.wrong) for r in review.checked_ranges(cuts, sizes).collect()) == [("b", "gap"), ("c", "overlap"), ("z", "unknown thread")]
    known = spark.createDataFrame([("a", "ra"), ("b", "rb"), ("k", "rk")], "thread_id string, reason string")
    moves = spark.createDataFrame([("b", "a", 0), ("a", "a", 1), ("z", "n", 0), ("b", "m", 1), ("z", "m", 0)], "old_id string, new_id string, ord int")
    assert sorted(map(tuple, review.inherited_class(known, moves).collect())) == [("a", "ra"), ("k", "rk"), ("m", "rb")]


def test_edits_of_entities(spark):
    e = spark.createDataFrame([("e0000", "Ann", "suggested", False, []), ("e0004", "Bob", "accepted", True, [("email", "b@x.org")])], f"entity_id string, canonical_name string, status string, contacts_manual boolean, contacts {contacts.CONTACT}")
    kind = f"entity_id string, ord int, name string, count int, claim_ids array<int>, excluded_claim_ids array<int>, topics array<string>, contacts {contacts.CONTACT}, contacts_uncertain {contacts.CONTACT}"
    mail = [("email", "a@x.org")]
    m = spark.createDataFrame([("e0000", 0, "Ann", 1, [1], [9], ["t"], mail, []), ("e0000", 1, "Anna", 3, None, [], ["s"], [], mail), ("e0004", 0, "Bob", 2, [2], [], [], mail, [])], kind)
    tagged = spark.createDataFrame([("Ann", 1), ("Ann", 7), ("Bob", 2)], "name string, claim_id int")
    left, members = review.merge_entities(e, m, "e0000", "e0004")
    assert [r.entity_id for r in left.collect()] == ["e0004"] and sorted((r.entity_id, r.ord, r.name) for r in members.collect()) == [("e0004", 0, "Bob"), ("e0004", 1, "Ann"), ("e0004", 2, "Anna")]
    (r,) = review.recomputed(left, members).collect()
    assert (r.canonical_name, r.aliases, [tuple(c) for c in r.contacts], [tuple(c) for c in r.contacts_uncertain], r.topics, r.member_total) == ("Bob", ["Anna", "Bob", "Ann"], [("email", "b@x.org")], mail, ["s", "t"], 6)
    split, members = review.split_entity(e, m, tagged, "e0000")
    assert sorted((r.entity_id, r.canonical_name, r.status) for r in split.collect()) == [("e0004", "Bob", "accepted"), ("e0005", "Ann", "suggested"), ("e0006", "Anna", "suggested")]
    assert {r.name: (r.entity_id, r.claim_ids) for r in members.collect()} == {"Ann": ("e0005", [1, 7]), "Anna": ("e0006", []), "Bob": ("e0004", [2])}
    one, members = review.split_entity(e, m, tagged, "e0004")
    assert {r.entity_id: r.status for r in one.collect()} == {"e0000": "suggested", "e0004": "suggested"}
    named = review.set_contacts(review.set_canonical(e, m, "e0000", "Anna"), "e0000", {"phone": [" 1 ", "", "1"]})
    assert {r.entity_id: (r.canonical_name, [tuple(c) for c in r.contacts], r.contacts_manual) for r in named.collect()}["e0000"] == ("Anna", [("phone", "1")], True)
    for bad in (lambda: review.set_canonical(e, m, "e0000", "Bob"), lambda: review.rename_entity(e, "e0000", " "), lambda: review.set_contacts(e, "e0000", {"fax": []}), lambda: review.merge_entities(e, m, "e0000", "e0000")):
        with pytest.raises(ValueError):
            bad()


def test_manual_groups(spark):
    groups = spark.createDataFrame([("agg0003", 1, [1, 2, 3]), ("agg0001", 4, [4, 5])], "group_id string, representative bigint, claim_ids array<bigint>")
    known = spark.createDataFrame([(i,) for i in range(1, 10)], "claim_id bigint")
    made = review.create_group(groups, known, [7, 6, 7], 6)
    assert {r.group_id: (r.representative, r.claim_ids) for r in made.collect()}["agg0004"] == (6, [7, 6])
    for ids, rep in (([7], 7), ([7, 8], 9), ([7, 99], 7), ([3, 7], 7)):
        with pytest.raises(ValueError):
            review.create_group(groups, known, ids, rep)
    assert {r.group_id: r.representative for r in review.set_representative(groups, "agg0003", 2).collect()}["agg0003"] == 2
    with pytest.raises(ValueError):
        review.set_representative(groups, "agg0003", 9)
    gone = spark.createDataFrame([(1,), (5,)], "claim_id bigint")
    assert {r.group_id: (r.representative, r.claim_ids) for r in review.without_claims(groups, gone).collect()} == {"agg0003": (2, [2, 3])}


def test_redactions_of_a_claim_are_settled(spark):
    from chatloom.functions.text import REDACTION_MARK as M

    c = spark.createDataFrame([(1, f"at {M} and {M}", [("email", "a@b.org"), ("phone", "1")], None), (2, f"x {M}", [("email", "c@d.org")], None), (3, "plain", None, None)], f"claim_id int, claim_text string, redactions {RED}, pii_review string")
    wish = spark.createDataFrame([(1, "restore"), (2, "accept"), (3, "restore")], "claim_id int, decision string")
    got = {r.claim_id: (r.claim_text, r.redactions, r.pii_review) for r in review.settle_redactions(c, wish).collect()}
    assert got == {1: ("at a@b.org and 1", None, "restored"), 2: (f"x {M}", None, "accepted"), 3: ("plain", None, None)}
    notes = {r.claim_id: (r.redaction_summary, r.original_text, r.has_redaction_mark) for r in review.review_items(c).collect()}
    assert notes == {1: ("email: 1, phone: 1", "at a@b.org and 1", True), 2: ("email: 1", "x c@d.org", True)}
