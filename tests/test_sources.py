"""Readers, sinks, kept tables, model seams, and small functions on worked examples."""

from __future__ import annotations

import datetime as dt
import json
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from chatloom import models
from chatloom.functions import text as T
from chatloom.operators import aggregate, classify, edits, entities, sequences, similarity, store, views
from chatloom.sources import artifacts, documents, exports


def cols(spark, **values):
    """One row of the columns, as a tuple."""
    return tuple(spark.range(1).select(*[c.alias(k) for k, c in values.items()]).first())


# -- readers and sinks -----------------------------------------------------------
def test_lines_of_files(spark, tmp_path):
    (tmp_path / "a.txt").write_text("[1/2/24, 9:00:00 AM] Dan: one\r\ntwo\n[1/1/24, 9:00:00 AM] Eve: x\n", encoding="utf-8")
    (tmp_path / "b.txt").write_text("", encoding="utf-8")
    lines = exports.read_lines(spark, str(tmp_path))
    got = sorted((Path(r.file).name, r.line_no, r.text) for r in lines.collect())
    assert [x for x in got if x[0] == "a.txt"] == [("a.txt", 0, "[1/2/24, 9:00:00 AM] Dan: one"), ("a.txt", 1, "two"), ("a.txt", 2, "[1/1/24, 9:00:00 AM] Eve: x")]
    assert [(Path(r.file).name, r.oldest) for r in exports.oldest_time(lines).collect()] == [("a.txt", dt.datetime(2024, 1, 1, 9))]


def test_lines_of_a_file_in_many_blocks(spark, tmp_path):
    text = "".join(f"line {i}\n" for i in range(5000))
    (tmp_path / "big.txt").write_text(text)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        lines = exports.read_lines(spark, str(tmp_path / "big.txt"))
        assert [r.text for r in lines.orderBy("line_no").collect()] == text.splitlines()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_phone_export_file_and_senders(spark, tmp_path):
    rows = [
        {"date": "02/01/2024", "time": "10:05", "sender": "+972 50-123-4567", "text": "hi", "id": "1", "reactions": [{"emoji": "👍", "senders": ["Eve", " "]}]},
        {"date": "02/01/2024", "time": "10:06", "sender": "Dan", "text": "", "id": "2"},
    ]
    (tmp_path / "x.json").write_text(json.dumps(rows), encoding="utf-8")
    messages = exports.read_phone_export(spark, str(tmp_path / "x.json"))
    assert [(r.id, r.content) for r in messages.collect()] == [("1", "hi")]
    mapped, left = exports.map_senders(messages, spark.createDataFrame([("+972 50-123-4567", "Noa")], "old string, new string"))
    assert [r.sender for r in mapped.collect()] == ["Noa"] and [r.sender for r in left.collect()] == ["Eve"]


def test_documents_of_the_stages(spark, tmp_path):
    def put(name, data):
        (tmp_path / name).write_text(json.dumps(data, ensure_ascii=False), encoding="utf-8")
        return str(tmp_path / name)

    threads = documents.read_threads(spark, put("t.json", {"threads": [{"thread_id": "t", "num_messages": 2, "message_ids": [7, 8], "messages": [{"sender": "a", "datetime": "2024-01-02T03:04:05", "content": "x"}, {"sender": "b", "content": "y", "reactions": [{"emoji": "👍", "senders": ["a"]}]}]}], "metadata": {}}))
    got = documents.thread_messages(threads).orderBy("idx").collect()
    assert [(r.message_id, r.sender, r.ts, len(r.reactions)) for r in got] == [(7, "a", dt.datetime(2024, 1, 2, 3, 4, 5), 0), (8, "b", None, 1)]
    classified = documents.read_classified(spark, put("c.json", {"threads": [{"thread_id": "t", "is_knowledge_bearing": True, "topic_tags": ["x"], "passed_heuristic": True, "reason": "r"}]}))
    assert [(r.ord, r.is_knowledge_bearing, r.topic_tags) for r in classified.collect()] == [(0, True, ["x"])]
    claims = {"claims": [{"claim_id": "t-c0", "thread_id": "t", "claim_text": "now", "topic_tags": ["x"], "_redactions": [{"type": "email", "value": "a@b.org"}]}]}
    now, old = documents.claims_with_originals(spark, put("now.json", claims), put("old.json", claims))
    assert [(r.claim_id, r.topics, r.redactions[0].value) for r in now.collect()] == [("t-c0", ["x"], "a@b.org")] and old.count() == 1
    assert documents.claims_with_originals(spark, put("now.json", claims), put("now.json", claims))[1] is None
    audit = put("audit.json", {"audit": [{"claim_id": "a", "supporting_senders": ["old"]}, {"claim_id": "a", "supporting_senders": ["u"], "message_reactions": [{"reactions": [{"emoji": "👍", "senders": ["v"]}]}, {"reactions": None}]}, {"claim_id": "b", "all_supporters": ["w"]}]})
    by = {r.claim_id: r for r in documents.read_audit(spark, audit).collect()}
    assert by["a"].supporting_senders == ["u"] and [tuple(x) for x in by["a"].message_reactions] == [("👍", ["v"])] and by["b"].message_reactions is None
    gone = str(tmp_path / "none.json")
    assert documents.read_audit(spark, gone).count() == documents.read_groups(spark, gone).count() == documents.read_deleted(spark, gone).count() == documents.read_seeds(spark, gone).count() == 0
    assert [(r.group_id, r.claim_ids) for r in documents.read_groups(spark, put("g.json", {"aggregations": [{"id": "agg0000", "representative": "a", "claim_ids": ["a", "b"]}]})).collect()] == [("agg0000", ["a", "b"])]
    assert [r.claim_id for r in documents.read_deleted(spark, put("d.json", {"deleted_claims": ["a", "a"]})).collect()] == ["a"]
    assert [(r.ord, r.canonical, r.aliases) for r in documents.read_seeds(spark, put("s.json", {"entities": [{"canonical": "Ann", "aliases": ["A"]}]})).collect()] == [(0, "Ann", ["A"])]
    pages, links = documents.read_plan(spark, put("p.json", {"pages": [{"id": "p", "title": "P", "category": "c", "source_tags": ["x", "y"]}], "links": [{"from": "p", "to": "q"}]}))
    assert [(r.page_id, r.source_tags) for r in pages.collect()] == [("p", ["x", "y"])] and [(r.src, r.dst) for r in links.collect()] == [("p", "q")]
    catalog = spark.createDataFrame([("t1", 0, "T1", "c"), ("t2", 1, "T2", "c")], "topic string, ord int, title string, category string")
    rows, tags = documents.seed_pages(pages, catalog)
    assert [r.page_id for r in rows.collect()] == ["p"] and sorted((r.tag, r.page_id) for r in tags.collect()) == [("x", "p"), ("y", "p")]
    assert sorted(r.page_id for r in documents.seed_pages(pages.where("false"), catalog)[0].collect()) == ["t1", "t2"]
    documents.write_json(classified, str(tmp_path / "back"), "threads")
    assert [(r.ord, r.thread_id, r.topic_tags) for r in documents.read_classified(spark, str(tmp_path / "back")).collect()] == [(0, "t", ["x"])]


def test_pages_files_and_site(spark, tmp_path):
    pages = spark.createDataFrame([("p", "# P\n\nx"), ("q", "# Q")], "page_id string, markdown string")
    artifacts.write_pages(pages, str(tmp_path / "out"))
    assert sorted(p.name for p in (tmp_path / "out").iterdir() if p.is_dir()) == ["page_id=p", "page_id=q"]
    artifacts.write_json_lines(pages, str(tmp_path / "log"))
    assert spark.read.json(str(tmp_path / "log")).count() == 2
    nav = spark.createDataFrame([("A", 'a "b"', "a.md", 0, 1), ("A", "c", "c.md", 0, 2), ("ב", "d", "d.md", 1, 1)], "category string, title string, path string, category_ord int, page_ord int")
    assert artifacts.site_config(nav, "Site") == 'site_name: "Site"\nnav:\n  - "A":\n    - "a \\"b\\"": "a.md"\n    - "c": "c.md"\n  - "ב":\n    - "d": "d.md"\n'
    (tmp_path / "drafts").mkdir()
    for name in ("a.md", "b.md", "c.txt"):
        (tmp_path / "drafts" / name).write_text("new")
    (tmp_path / "docs").mkdir()
    (tmp_path / "docs" / "b.md").write_text("kept")
    assert documents.copy_files(spark, str(tmp_path / "drafts"), str(tmp_path / "docs")) == 1
    assert sorted(p.name for p in (tmp_path / "docs").glob("*.md")) == ["a.md", "b.md"] and (tmp_path / "docs" / "b.md").read_text() == "kept"


def test_a_kept_table_is_made_anew_when_its_source_changes(spark, tmp_path):
    built = []

    def build():
        built.append(1)
        return spark.range(len(built))

    one = spark.createDataFrame([(1, "a"), (2, "b")], "x int, y string")
    sign = documents.signature(one)
    assert sign == documents.signature(one.orderBy("y", ascending=False)) != documents.signature(one.limit(1)) and documents.signature(one.unionByName(one)) != sign
    path = str(tmp_path / "kept")
    assert [documents.ensure_table(spark, path, {"source": s}, build).count() for s in (sign, sign, "other", "other")] == [1, 1, 2, 2] and len(built) == 2
    assert artifacts.is_stale({"a": 1}, {"a": 2}) and not artifacts.is_stale({"a": 1}, {"a": 1})


# -- models ------------------------------------------------------------------------
KEYWORDS = [("law", 0, "court"), ("law", 0, "Judge"), ("money", 1, "price"), ("baby", 2, "twins")]


def test_answers_by_rule_pass_through_the_operators(spark):
    keywords = spark.createDataFrame(KEYWORDS, "tag string, ord int, keyword string")
    models.register("rules", models.offline(keywords, ["agency"]))
    block = F.lit("- law: court things")
    thread = F.lit("[m0] (2024-01, A) The JUDGE asked the price\n[m1] (2024-01, B) yes")
    requests = spark.range(1).select(F.explode(F.array(
        F.struct(F.lit("a").alias("id"), F.lit("classify").alias("task"), models.classify_prompt(block, thread).alias("prompt")), F.struct(F.lit("b").alias("id"), F.lit("extract").alias("task"), models.extract_prompt(block, thread).alias("prompt")),
        F.struct(F.lit("c").alias("id"), F.lit("classify").alias("task"), models.classify_prompt(block, F.lit("[m0] (x) an agency")).alias("prompt")), F.struct(F.lit("d").alias("id"), F.lit("classify").alias("task"), models.classify_prompt(block, F.lit("[m0] (x) hello")).alias("prompt")),
        F.struct(F.lit("e").alias("id"), F.lit("plan").alias("task"), models.plan_prompt(block, F.lit(""), F.lit("- id: law | title: Law | claims: 3 | category: c\n- id: none | title: N | claims: 0 | category: c")).alias("prompt")),
        F.struct(F.lit("f").alias("id"), F.lit("agent").alias("task"), models.batch_prompt(F.lit("law"), F.lit("- money.md — Money"), F.lit(""), F.lit("claim_id: x-c0\nclaim_id: x-c1")).alias("prompt")),
        F.struct(F.lit("g").alias("id"), F.lit("generate").alias("task"), models.batch_prompt(F.lit("law"), F.lit("- money.md — Money\n- baby.md — B\n- more.md — M"), F.lit(""), F.lit("")).alias("prompt")),
        F.struct(F.lit("h").alias("id"), F.lit("grounded").alias("task"), models.background_prompt(F.lit("Law"), F.lit("law")).alias("prompt")),
    )).alias("r")).select("r.*").withColumn("system", F.lit("s"))
    none = spark.createDataFrame([], "key string, answer string")
    answers, cache = models.ask(requests, none, models.Stage("all", "rules"))
    got = {r.id: r.answer for r in answers.collect()}
    assert json.loads(got["a"]) == {"is_knowledge_bearing": True, "topic_tags": ["law", "money"], "entities": [], "reason": "keyword match by rule"}
    assert json.loads(got["b"])["claims"] == [{"claim_text": "The JUDGE asked the price", "topic_tags": ["law", "money"], "entities": [], "stance": "factual", "supporting_message_ids": [0]}]
    assert [json.loads(got[k])["topic_tags"] for k in "cd"] == [["overview"], []] and [json.loads(got[k])["is_knowledge_bearing"] for k in "cd"] == [True, False]
    assert [(p["id"], p["title"], p["source_tags"]) for p in json.loads(got["e"])["pages"]] == [("law", "Law", ["law"])]
    assert [(a["page_id"], a["claim_ids"]) for a in json.loads(got["f"])["actions"]] == [("law", ["x-c0"]), ("law", ["x-c1"])]
    assert json.loads(got["g"])["related_pages"] == ["money", "baby"] and "(money.md)" in json.loads(got["g"])["body"] and got["h"]
    known = spark.createDataFrame([("law",)], "tag string")
    parsed = classify.parse_class(answers.where("task = 'classify'").withColumnRenamed("id", "thread_id"), known)
    assert {r.thread_id: (r.is_knowledge_bearing, r.emergent_tags) for r in parsed.collect()} == {"a": (True, ["money"]), "c": (True, ["overview"]), "d": (False, [])}
    # what the cache knows is not asked again
    models.register("never", lambda rows: rows.where("false").select("key", F.lit("asked").alias("answer")))
    kept = spark.createDataFrame(cache.collect(), cache.schema)
    again, _ = models.ask(requests, kept, models.Stage("all", "rules", batch=True))
    assert {r.id: r.answer for r in again.collect()} == got
    with pytest.raises(ValueError):
        models.ask(requests, none, models.Stage("all", "nobody"))


def test_vectors_and_words_behind_the_seams(spark):
    calls = []

    def encode(texts):
        return np.array([[len(t), t.startswith("query: ")] for t in texts], np.float32)

    rows = spark.createDataFrame([(0, "abc"), (1, " "), (2, None), (3, "x")], "i int, t string")
    got = {r.i: r.vector for r in models.with_vectors(rows, "t", encode, 2, query=True, batch=1).collect()}
    assert got == {0: [10.0, 1.0], 1: [0.0, 0.0], 2: [0.0, 0.0], 3: [8.0, 1.0]} and not calls
    words = models.with_words(rows, "t", lambda ts: [[{"token": w, "core": w, "kind": "NOUN"} for w in t.split()] for t in ts])
    assert {r.i: [(w.token, w.kind, w.ner) for w in r.words] for r in words.collect()} == {0: [("abc", "NOUN", None)], 1: [], 2: [], 3: [("x", "NOUN", None)]}
    assert cols(spark, v=models.valid_tokens(F.array(*map(F.lit, ("[CLS]", "a", "!", "א", "", "[SEP]", "7"))))) == (["a", "א", "7"],)
    block = models.catalog_block(spark.createDataFrame([("b", 1, "B", "a", ""), ("a", 0, "A", "", "find a")], "topic string, ord int, title string, parent string, focus string")).first().block
    assert block == "- a: A | search_focus: find a\n- b: B (part of a)"


# -- mentions by analyzed words ------------------------------------------------------
def test_words_have_places_and_pass_a_gate(spark):
    t = spark.createDataFrame([(1, "Dr. Ann  Lee met Ann."), (2, None)], "claim_id int, text string").withColumn("words", entities.simple_words(F.col("text")))
    assert [(w.token, w.start, w.end) for w in t.where("claim_id = 1").first().words] == [("Dr.", 0, 3), ("Ann", 4, 7), ("Lee", 9, 12), ("met", 13, 16), ("Ann.", 17, 21)]
    names = spark.createDataFrame([("Ann Lee",), ("ann",), ("",)], "name string")
    assert sorted((r.name, r.start, r.end) for r in entities.word_mentions(t, names).collect()) == [("Ann Lee", 4, 12), ("ann", 4, 7), ("ann", 17, 21)]
    word = lambda token, core=None, kind=None, ner=None: (token, core or token, kind, ner)
    raw = spark.createDataFrame([(1, "בדרך כלל כלל", [word("בדרך", kind="NOUN"), word("כלל", kind="ADV"), word("כלל", kind="PROPN")]), (2, "וכלל", [word("וכלל", "כלל", "NOUN")]), (3, "xx", [word("absent")])], "claim_id int, text string, words array<struct<token:string,core:string,kind:string,ner:string>>")
    placed = entities.with_offsets(raw, "text", "words")
    assert {r.claim_id: [(w.start, w.end) for w in r.words] for r in placed.collect()} == {1: [(0, 4), (5, 8), (9, 12)], 2: [(1, 4)], 3: [(None, None)]}
    hebrew = spark.createDataFrame([("כלל",), ("בדרך כלל",), ("absent",)], "name string")
    assert sorted((r.claim_id, r.name, r.start) for r in entities.word_mentions(placed, hebrew).collect()) == [(1, "בדרך כלל", 0), (1, "כלל", 9)]
    long = " ".join(f"w{i}" for i in range(9))
    found = entities.mentions(spark.createDataFrame([(1, f"a {long} b")], "claim_id int, text string"), spark.createDataFrame([(long,)], "name string"))
    assert [(r.name, r.pos) for r in found.collect()] == [(long, 1)]


# -- small functions -----------------------------------------------------------------
def test_text_functions(spark):
    n = F.lit
    assert cols(spark, a=T.bucket_label(n(1.0), n(2.5)), b=T.bucket_label(n(3.0), n(3.0)), c=T.number_label(n(1234.004))) == ("1–2.5", "3", "1234")
    assert cols(spark, a=T.batch_id(n("a b/ç" + "x" * 80)), b=T.batch_id(n(""))) == ("a_b__" + "x" * 59, "req")
    assert cols(spark, a=T.cited_urls(n("see https://a.org/x, (https://b.org) and https://a.org/x."))) == (["https://a.org/x", "https://b.org"],)
    assert cols(spark, a=T.json_block(n('x ```json\n{"a": {"b": 1}}\n``` y')), b=T.nickname(n("~ Dan ")), c=T.month_of(n("2024-03-05T01:02:03"))) == ('{"a": {"b": 1}}', "Dan", "2024-03")
    t = lambda x: F.lit(x).cast("timestamp_ntz")
    assert cols(spark, a=T.duration_seconds(t("2024-01-01 00:00:00"), t("2024-01-01 00:01:30")), b=T.duration_seconds(t("2024-01-02 00:00:00"), t("2024-01-01 00:00:00"))) == (90.0, 0.0)
    keys = cols(spark, a=T.cache_key(n("p"), n("x")), b=T.cache_key(n("p"), n("x")), c=T.cache_key(n("px"), n("")))
    assert keys[0] == keys[1] != keys[2] and len(keys[0]) == 64


def test_similarity_and_clusters(spark):
    v = lambda *x: F.array(*[F.lit(float(i)) for i in x])
    assert cols(spark, s=similarity.symmetric_similarity(v(1, 0), v(0, 1), v(1, 1), v(1, 0)))[0] == pytest.approx(0.5**0.5)
    rng = np.random.default_rng(1)
    x = rng.normal(size=(40, 5))
    rows = spark.createDataFrame([(i % 3, i, [float(y) for y in (x[i] if i != 7 else x[i] * 0)]) for i in range(40)], "g int, i int, v array<double>")
    pairs = similarity.pairs_within(rows, "g", "i", "v").withColumn("dist", 1 - F.col("cosine"))
    want = {r.g: (r.medoid, round(r.total, 5)) for r in aggregate.medoids(pairs, ["g"]).collect()}
    assert {r.g: (r.medoid, round(r.total, 5)) for r in aggregate.vector_medoids(rows, ["g"], "i", "v").collect()} == want
    split = {(r.i, r.j): r.cosine for r in similarity.pairs_within(rows, "g", "i", "v", 4).collect()}
    assert split == pytest.approx({(r.i, r.j): r.cosine for r in pairs.collect()}) and len(split) == 91 + 78 + 78
    members = spark.createDataFrame([(0, 0), (3, 0), (6, 0), (9, 9)], "item int, cluster int")
    far = {(r.i, r.j): r.dist for r in pairs.collect()}
    got = {r.cluster: r.score for r in aggregate.cohesion(pairs, members).collect()}
    assert got == {0: pytest.approx(round(1 - max(far[0, 3], far[0, 6], far[3, 6]), 4)), 9: 1.0}
    for n in (2, 3, 9):
        d = aggregate.cosine_distance(x[:n])
        halves = aggregate.halves(d)
        height = max(h for h in [*np.unique(d), 9] if len(np.unique(aggregate.complete_linkage(d, h))) >= 2)
        assert len(np.unique(halves)) == 2 and (n > 8 or (aggregate.complete_linkage(d, height) == halves).all() or len(np.unique(aggregate.complete_linkage(d, height))) > 2)
    row = spark.createDataFrame([("a", 2), ("b", 1), ("a", 0)], "x string, o int").agg(aggregate.distinct_ordered(F.col("x"), F.col("o")).alias("x")).first()
    assert row.x == ["a", "b"]


def test_quotes_by_time_are_those_of_brute_force(spark):
    rng = np.random.default_rng(2)
    at = dt.datetime(2024, 1, 1)
    rows = [("c", i, at + dt.timedelta(minutes=int(rng.integers(0, 6))), f"s{rng.integers(2)}", f"t{rng.integers(2)}", *((f"s{rng.integers(2)}", f"t{rng.integers(2)}") if rng.random() < 0.6 else (None, None))) for i in range(60)]
    df = spark.createDataFrame(rows, "chat_id string, idx bigint, ts timestamp_ntz, sender string, content string, quote_sender string, quote_text string")
    want = {}
    for r in rows:
        met = [(b[2], b[1]) for b in rows if r[6] is not None and (b[3], b[4]) == (r[5], r[6]) and b[2] <= r[2] and b[1] != r[1]]
        if met:
            want[r[1]] = max(met)[1]
    assert {r.idx: r.quoted_idx for r in sequences.quote_by_time(df).collect()} == want


RX = "array<struct<emoji:string,senders:array<string>>>"


def test_threads_are_rendered_and_summed_with_reactions(spark):
    at = dt.datetime(2024, 3, 1)
    rows = [("t", 0, at, "Dan", " hi ", []), ("t", 1, at, "Eve", " ", []), ("t", 2, at + dt.timedelta(days=40), "Noa", "yes", [("👍", ["Dan", "Zed", ""]), ("", ["x"]), ("🎉", [""])]), ("t", 3, at, "Dan", "ok", None)]
    df = spark.createDataFrame(rows, f"thread_id string, idx int, ts timestamp_ntz, sender string, content string, reactions {RX}")
    p = sequences.PARTICIPANT
    assert sequences.rendered_for_model(df).first().rendered == f"[m0] (2024-03, {p} 1) hi\n[m1] (2024-04, {p} 2) yes [{sequences.REACTIONS}: 👍×2]\n[m2] (2024-03, {p} 1) ok"
    assert sequences.thread_summary(df).first().participants == ["Dan", "Eve", "Noa"]
    r = sequences.thread_summary(df, True).first()
    assert (r.participants, r.num_unique_senders) == (["Dan", "Eve", "Noa", "Zed", "x"], 5)


def test_earliest_message_that_holds_a_quote(spark):
    rows = [("t", 0, "a", "one  two three", None, None), ("t", 1, "b", "one two", None, None), ("t", 2, "a", "x", None, "one two"), ("t", 3, "a", "x", "b", "say one two now"), ("t", 4, "a", "y", "c", "one two"), ("t", 5, "a", "z", None, " "), ("u", 0, "a", "q", None, "one")]
    df = spark.createDataFrame(rows, "thread_id string, idx int, sender string, content string, quote_sender string, quote_text string")
    assert sorted((r.idx, r.quoted_idx) for r in sequences.quote_in_thread(df).collect()) == [(2, 0), (3, 1)]


def test_a_split_does_not_cut_quotes(spark):
    at = dt.datetime(2024, 1, 1)
    rows = [("t", i, at + dt.timedelta(minutes=i + (600 if i > 29 else 0) + (500 if i > 39 else 0)), 0.0, 100 if i in (5, 35) else i) for i in range(60)]
    df = spark.createDataFrame(rows, "thread_id string, pos int, ts timestamp_ntz, next_sim double, component int")
    assert sequences.split_boundaries(df.drop("component")).first().pos == 29 and sequences.split_boundaries(df).first().pos == 39


def test_names_of_two_recordings_of_a_chat(spark):
    at = dt.datetime(2024, 1, 1)
    old = [("c", i, at + dt.timedelta(days=i), *x) for i, x in enumerate([("+1 555 123 4567", "early"), ("+1 555 123 4567", "hello"), ("+1 555 765 4321", "there"), ("+1 555 765 4321", "you"), ("+1 555 123 4567", "all")])]
    new = [("c", i, at + dt.timedelta(days=i + 1), *x) for i, x in enumerate([("Dan", "hello"), ("+1 555 765 4321", "there"), ("+1 555 765 4321", "you"), ("Dan", "all")])]
    kind = "chat_id string, idx int, ts timestamp_ntz, sender string, content string"
    a, b = spark.createDataFrame(old, kind), spark.createDataFrame(new, kind)
    pairs = sequences.align_senders(a, b)
    assert sorted((r.old_sender, r.new_sender, r.n) for r in sequences.sender_votes(pairs).collect()) == [("+1 555 123 4567", "Dan", 2), ("+1 555 765 4321", "+1 555 765 4321", 2)]
    assert [(r.old, r.new) for r in sequences.overlap_mapping(a, b).collect()] == [("+1 555 123 4567", "Dan")]
    kind = "old_sender string, new_sender string, n int, first_ord int"
    votes = spark.createDataFrame([("You", "Dan", 5, 0), ("You", "Eve", 6, 1), ("1@c.us", "+1 555 123 4567", 9, 2), ("1@c.us", "Noa", 1, 3), ("plain", "Zed", 1, 4)], kind)
    sent = spark.createDataFrame([("You", "Dan", 2, 0)], kind)
    assert sorted(map(tuple, sequences.owner_mapping(votes, sent).collect())) == [("1@c.us", "Noa"), ("You", "Dan")]
    assert sorted(map(tuple, sequences.owner_mapping(votes, sent.where("false")).collect())) == [("1@c.us", "Noa"), ("You", "Eve")]
    flagged = spark.createDataFrame([("a", "b", 0, True), ("a", "c", 1, False)], "old_sender string, new_sender string, ord int, is_outgoing boolean")
    assert [(r.new_sender, r.n) for r in sequences.sender_votes(flagged, True).collect()] == [("b", 1)]


def test_thread_assignment_takes_weights_and_reactors(spark):
    from chatloom.streaming import threads

    at = dt.datetime(2024, 1, 1)
    rows = [("c", i, at + dt.timedelta(hours=i), f"s{i}", x, [1.0, 0.0], None, None, ["s2"] if i == 0 else []) for i, x in enumerate(["alpha beta", "gamma", "alpha"])]
    df = spark.createDataFrame(rows, "chat_id string, idx bigint, ts timestamp_ntz, sender string, content string, vector array<double>, quote_sender string, quote_text string, reactors array<string>")
    weighted = threads.with_term_weights(df)
    terms = {r.idx: dict(r.terms) for r in weighted.collect()}
    assert terms[0]["beta"] > terms[0]["alpha"] > 0 and terms[1].keys() == {"gamma"}
    assert threads.assign(weighted).count() == 3
    state = threads.Assigner()
    for m in threads._messages(weighted.toPandas()):
        state.add(m)
    assert any("s2" in t.people for t in [*state.open, *state.closed]) and state.messages[0].terms == terms[0]


# -- edits ---------------------------------------------------------------------------
def test_small_edits(spark):
    t = spark.createDataFrame([("a", i, f"m{i}") for i in range(5)], "thread_id string, idx int, x string")
    assert sorted(r.idx for r in edits.extract(t, "thread_id", "a", "b", [1, 3], "idx").where("thread_id = 'b'").collect()) == [1, 3]
    assert edits.next_number(spark.createDataFrame([("e0007",), ("e0011",), ("x",)], "id string"), "id", "e").first().next == 12
    assert edits.next_number(spark.createDataFrame([], "id string"), "id", "e").first().next == 0
    m = spark.createDataFrame([(1, "Ann", [1]), (2, "Bob", [2])], "entity_id int, name string, claim_ids array<int>")
    assert sorted((r.entity_id, r.name) for r in edits.move_member(m, "Ann", 1, 2).collect()) == [(2, "Ann"), (2, "Bob")]
    assert {r.name: r.name == "Ann" for r in edits.set_status(m, "entity_id", [1], "name", "Ann").collect()}["Ann"]
    c = spark.createDataFrame([(1, ["a"], ["b", "c"])], "id int, contacts array<string>, contacts_uncertain array<string>")
    r = edits.settle_contact(c, "id", 1, "b", True, "B").first()
    assert (r.contacts, r.contacts_uncertain) == (["a", "B"], ["c"])
    r = edits.settle_contact(c, "id", 1, "b", False).first()
    assert (r.contacts, r.contacts_uncertain) == (["a"], ["c"])
    e = spark.createDataFrame([("Ann", ["Annie"], ["x", "y"], "accepted"), ("Bob", [], ["z"], "suggested")], "canonical_name string, aliases array<string>, members array<string>, status string")
    assert [r.canonical_name for r in views.entity_list(e, query="NNI").collect()] == ["Ann"] and [r.canonical_name for r in views.entity_list(e, "suggested", 1).collect()] == ["Bob"]
    resolved = spark.createDataFrame([(1, 1, "B"), (1, 0, "A"), (1, 2, "A")], "claim_id int, pos int, canonical string")
    assert entities.resolved_lists(resolved).first().entities == ["A", "B"]


def test_pages_and_links_are_ensured(spark):
    have = spark.createDataFrame([("p", "P", "c"), ("q", "Q", "c")], "page_id string, title string, category string")
    wanted = spark.createDataFrame([("q", None, 0), ("n", "N1", 1), ("n", "N2", 2), (" ", "x", 3), ("q", "Q2", 4)], "page_id string, title string, ord int")
    pages = store.ensure_pages(have, wanted)
    assert {r.page_id: (r.title, r.category) for r in pages.collect()} == {"p": ("P", "c"), "q": ("Q2", "c"), "n": ("N2", "emergent")}
    links = spark.createDataFrame([("p", "q", "first", 0)], "src string, dst string, reason string, ord int")
    more = spark.createDataFrame([("p", "q", "again", 1), ("q", "p", "back", 2), ("q", "q", "loop", 3), ("q", "gone", "x", 4)], links.schema)
    assert sorted(map(tuple, store.add_links(links, more, pages).collect())) == [("p", "q", "first"), ("q", "p", "back")]


# -- pairs of names ---------------------------------------------------------------------
def test_pair_signals_against_plain_rules(spark):
    """Signals of every pair by the rules, and what share of the linked pairs the keys bring together."""
    raw = [
        ("Dan Cohen", ["t"], [1], [], None), ("Dan Cohen Law", ["t"], [1, 2], [], None), ("Dana Kohen", ["u"], [3], ["a@b.org"], None), ("דן כהן", ["t"], [4], [], None), ("Clinic North", ["t"], [5], ["a@b.org"], None),
        ("Clinic Norht", ["t"], [6], [], None), ("Gal", ["t"], [7], [], None), ("Gall", ["z"], [8], [], None), ("Rachel", ["t"], [9], [], "s1"), ("Somebody Else", ["t"], [10], [], "s1"),
    ]
    rows = spark.createDataFrame([(i, *r) for i, r in enumerate(raw)], "ord int, name string, topics array<string>, claim_ids array<int>, contacts array<string>, seed string")
    names = entities.with_forms(rows)
    table = {r.ord: r for r in names.collect()}
    every = spark.createDataFrame([(i, j) for i in range(len(raw)) for j in range(i + 1, len(raw))], "i int, j int")
    got = {(r.i, r.j): r for r in entities.pair_signals(every, names).collect()}
    assert len(got) == len(raw) * (len(raw) - 1) // 2
    for (i, j), r in got.items():
        a, b = table[i], table[j]
        base, other = entities.ratio(a.norm, b.norm), False
        if a.is_hebrew != b.is_hebrew and min(len(a.skeleton), len(b.skeleton)) >= entities.LEAST_SKELETON and (t := entities.ratio(a.skeleton, b.skeleton)) > base:
            base, other = t, True
        short, long = sorted((a.norm, b.norm), key=len)
        prefix = len(short) >= 3 and long.startswith(short + " ")
        both = bool(set(a.claim_ids) & set(b.claim_ids))
        sim = 1.0 if prefix and both else max(base, entities.PREFIX) if prefix else base
        contact, seed = bool(set(a.contacts) & set(b.contacts)), a.seed is not None and a.seed == b.seed
        guard = sim >= entities.SIMILARITY and max(len(a.norm), len(b.norm)) <= entities.SHORT_NAME and not set(a.topics) & set(b.topics)
        want = 1.0 if contact or seed else min(sim, entities.GUARD_CAP) if guard else sim
        assert r.similarity == pytest.approx(want) and r.guarded == (guard and not contact and not seed), (a.name, b.name)
        close = base >= entities.SIMILARITY
        signals = {s for s, on in (("transliteration", close and other), ("string", close and not other), ("prefix", prefix), ("co_occur", prefix and both), ("confident_contact", contact), ("seed", seed and not contact)) if on}
        assert set(r.signals) == signals
    met = {(r.i, r.j) for r in entities.candidate_pairs(names).collect()}
    linked = {k for k, r in got.items() if r.similarity >= entities.SIMILARITY}
    assert linked and linked <= met


# -- review reads -------------------------------------------------------------------------
def test_threads_after_a_merge_and_what_is_shown(spark):
    from chatloom.operators import review

    at = dt.datetime(2024, 1, 1)
    rows = [("b", 0, at, "Dan", [("👍", ["Zed"])]), ("b", 1, at + dt.timedelta(hours=1), "Eve", []), ("a", 2, at - dt.timedelta(days=1), "Noa", [])]
    m = spark.createDataFrame(rows, f"thread_id string, idx int, ts timestamp_ntz, sender string, reactions {RX}")
    known = spark.createDataFrame([("b", "rb"), ("gone", "rg"), ("a", "ra")], "thread_id string, reason string")
    moves = spark.createDataFrame([("gone", "b", 0), ("b", "b", 1)], "old_id string, new_id string, ord int")
    threads, classes = review.restructured(m, known, moves)
    assert sorted((r.ord, r.thread_id, r.num_messages, r.participants) for r in threads.collect()) == [(0, "a", 1, ["Noa"]), (1, "b", 2, ["Dan", "Eve", "Zed"])]
    assert sorted((r.thread_ord, r.thread_id, r.reason) for r in classes.collect()) == [(0, "a", "ra"), (1, "b", "rb")]
    t = spark.createDataFrame([(1, "x", at, at), (1, "t", at + dt.timedelta(1), at), (1, "t-split-1", at + dt.timedelta(2), at), (1, "y", at + dt.timedelta(3), at)], "chat_id int, thread_id string, start_time timestamp_ntz, last_time timestamp_ntz")
    shown = review.shown_threads(review.message_context(t), review.split_families(t))
    got = {}
    for r in shown.orderBy("thread_id", "position").collect():
        got.setdefault(r.thread_id, []).append(r.shown_id)
    assert got == {"x": ["x", "t"], "t": ["x", "t", "t-split-1"], "t-split-1": ["t", "t-split-1", "y"], "y": ["t-split-1", "y"]}


def test_registry_and_groups(spark):
    from chatloom.operators import merge, review

    e = spark.createDataFrame([("e1", 0, "Ann"), ("e2", 1, "Bob")], "entity_id string, ord int, canonical_name string")
    m = spark.createDataFrame([("e1", "Annie", [1], ["t"]), ("e2", "Annie", [], ["u"]), ("e2", "Bobby", None, ["u"])], "entity_id string, name string, claim_ids array<int>, topics array<string>")
    said = spark.createDataFrame([(1, 0, "Annie", ["u"]), (2, 0, "Annie", ["t"]), (3, 0, "Annie", ["z"]), (4, 0, "Bobby", []), (5, 0, "Cy", [])], "claim_id int, pos int, name string, topics array<string>")
    assert {r.claim_id: r.canonical for r in entities.resolve(said, review.registry(e, m)).collect()} == {1: "Ann", 2: "Ann", 3: "Bob", 4: "Bob", 5: "Cy"}
    own = spark.createDataFrame([(1, "a", 0, 3)], "claim_id int, name string, start int, end int")
    other = spark.createDataFrame([(1, "b", 1, 9), (1, "c", 4, 6), (1, "d", 4, 8)], own.schema)
    assert [tuple(x) for x in review.entity_highlights(own, other).first().spans] == [(0, 3, "a"), (4, 8, "d")]
    g = spark.createDataFrame([("t", "1", "two", [1, 2])], "topic string, key string, claim_text string, source_claim_ids array<int>")
    texts = spark.createDataFrame([(1, "one"), (2, "two")], "claim_id int, claim_text string")
    assert sorted((r.pos, r.claim_id, r.is_representative) for r in merge.member_rows(g, texts).collect()) == [(0, 1, False), (1, 2, True)]
    c = spark.createDataFrame([("ב", 1), ("א", 2), ("ב", 3)], "category string, x int")
    assert sorted((r.category_place, r.x) for r in review.by_category(c).collect()) == [(1, 2), (2, 1), (2, 3)]


def test_page_store_reads(spark):
    pages = spark.createDataFrame([("p", "P"), ("q", "Q"), ("r", "R")], "page_id string, title string")
    st_ = spark.createDataFrame([("p", "p-s1", ["a", "b"]), ("p", "p-s12", ["b"]), ("q", "odd", ["c"])], "page_id string, statement_id string, claim_ids array<string>")
    links = spark.createDataFrame([("p", "q")], "src string, dst string")
    assert tuple(store.store_counts(pages, st_, links).first()) == (3, 2, 3, 3, 1)
    assert sorted(r.line for r in store.page_catalog(pages, st_).collect()) == ["- p.md — P (2)", "- q.md — Q (1)", "- r.md — R (0)"]
    assert {r.page_id: r.next for r in store.next_statement(st_).collect()} == {"p": 13, "q": 1}
    have = spark.createDataFrame([("p", "r", 0), ("q", "p", 0)], "page_id string, related string, ord int")
    wanted = spark.createDataFrame([("p", "q", 1), ("p", "q", 2), ("p", "p", 0), ("p", "none", 3), ("none", "p", 0)], have.schema)
    assert sorted(map(tuple, store.set_related(have, wanted, pages).collect())) == [("p", "q", 1), ("q", "p", 0)]


def test_vectors_are_kept_until_the_texts_change(spark, tmp_path):
    rows = spark.createDataFrame([(0, "abc"), (1, "")], "i int, t string")
    one = lambda ts: np.array([[float(len(t))] for t in ts])
    two = lambda ts: np.array([[-1.0] for _ in ts])
    path = str(tmp_path / "v")
    read = lambda r, f, model="m": {x.i: x.vector for x in models.ensure_vectors(r, path, "i", "t", model, f, 1, prefixed=False).collect()}
    assert read(rows, one) == {0: [3.0], 1: [0.0]} == read(rows, two)
    assert read(rows, two, "other") == {0: [-1.0], 1: [0.0]} and read(rows.unionByName(rows.where("i = 0").withColumn("i", F.lit(2))), one, "other") == {0: [3.0], 1: [0.0], 2: [3.0]}
