"""Seams to models: prompts, answers by rule for runs without a model, vectors and analyzed words.

A model is a function from requests (key, task, system, prompt) to answers (key, answer). The registry
holds them by provider; ``ask`` asks for what no cache knows. Providers are put in by the user with
``register``; ``offline`` makes one that answers by rule, as DataFrame expressions.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .functions.text import cache_key, strip
from .operators.pages import keyword_hits
from .sources.artifacts import cached_answers

Model = Callable[[DataFrame], DataFrame]
#: What stands before the thread in a prompt.
THREAD = "\nThread:\n"
OVERVIEW = "overview"
SNIPPET, TAGS = 200, 3


# -- registry ----------------------------------------------------------------------
@dataclass(frozen=True)
class Stage:
    """Which provider and model a stage asks, and whether as one batch."""

    name: str
    provider: str = "offline"
    model: str = "rules"
    batch: bool = False


@dataclass(frozen=True)
class Provider:
    ask: Model
    #: Answers many requests at once, if the provider can.
    batch: Model | None = None


PROVIDERS: dict[str, Provider] = {}


def register(name: str, ask: Model, batch: Model | None = None) -> None:
    PROVIDERS[name] = Provider(ask, batch)


def ask(requests: DataFrame, cache: DataFrame, stage: Stage) -> tuple[DataFrame, DataFrame]:
    """Answers of requests (id, task, system, prompt) and the cache (key, answer) with what is new.

    The key is a digest of provider, model, task, system and prompt, so equal requests are asked
    once. A stage that wants a batch gets one if its provider can, else single answers.
    """
    if stage.provider not in PROVIDERS:
        raise ValueError(f"unknown provider: {stage.provider}")
    provider = PROVIDERS[stage.provider]
    model = provider.batch if stage.batch and provider.batch else provider.ask
    keyed = requests.withColumn("key", cache_key(F.lit(stage.provider), F.lit(stage.model), F.col("task"), F.col("system"), F.col("prompt")))
    found, every = cached_answers(keyed.select("key", "task", "system", "prompt"), cache, model)
    answers = found.select("key", "answer").dropDuplicates(["key"])
    return keyed.join(answers, "key", "left").select("id", "task", "answer"), every


# -- prompts -------------------------------------------------------------------------
def catalog_block(catalog: DataFrame) -> DataFrame:
    """One row: the topic catalog (topic, ord, title, parent, focus) as lines of a prompt."""
    parent = F.when(F.coalesce("parent", F.lit("")) != "", F.concat(F.lit(" (part of "), "parent", F.lit(")"))).otherwise("")
    focus = F.when(F.coalesce("focus", F.lit("")) != "", F.concat(F.lit(" | search_focus: "), "focus")).otherwise("")
    line = F.concat(F.lit("- "), "topic", F.lit(": "), "title", parent, focus)
    return catalog.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", line.alias("l")))), lambda x: x["l"]), "\n").alias("block"))


def classify_prompt(block: Column, thread: Column) -> Column:
    return F.concat(
        F.lit("Suggested topics (others may be added):\n"), block,
        F.lit('\n\nClassify the thread. Answer with JSON: {"is_knowledge_bearing": true or false, "topic_tags": [], "entities": [], "reason": ""}.\n'), F.lit(THREAD), thread,
    )


def extract_prompt(block: Column, thread: Column) -> Column:
    return F.concat(
        F.lit("Suggested topics (others may be added):\n"), block,
        F.lit(
            '\n\nExtract the claims of the thread. Answer with JSON: {"claims": [{"claim_text": "", "topic_tags": [], "entities": [], "stance": "positive|negative|neutral|factual", '
            '"supporting_message_ids": [], "opposing_message_ids": []}]}. Numbers are those of the lines [m0], [m1] and so on.\n'
        ), F.lit(THREAD), thread,
    )


def plan_prompt(block: Column, categories: Column, topics: Column) -> Column:
    """``topics``: the lines of ``plan.summary_line``."""
    return F.concat(
        F.lit("Seed topics:\n"), block, F.lit("\n\nCategories:\n"), categories, F.lit("\n\nTopics with claims:\n"), topics,
        F.lit('\n\nAnswer with JSON: {"pages": [{"id": "", "title": "", "category": "", "source_tags": [], "rationale": "", "search_focus": ""}], "links": [{"from": "", "to": "", "reason": ""}]}.'),
    )


def batch_prompt(page: Column, catalog: Column, view: Column, claims: Column) -> Column:
    """``claims``: lines that begin with ``claim_id:`` and the id."""
    return F.concat(
        F.lit("Current page: "), page, F.lit("\n\nOther pages:\n"), catalog, F.lit("\n\nPage so far:\n"), view, F.lit("\n\nNew claims:\n"), claims,
        F.lit('\n\nAnswer with JSON: {"actions": [{"type": "upsert_statement", "page_id": "", "section": "", "statement_id": null, "text": "", "claim_ids": []}]}.'),
    )


def background_prompt(title: Column, focus: Column) -> Column:
    return F.concat(F.lit('Write a short, factual public background on "'), title, F.lit('". Search for: '), focus, F.lit("\nNo opinions of the group, no headings, no list of sources."))


# -- answers by rule -------------------------------------------------------------------
def segment(prompt: Column) -> Column:
    """The thread in a prompt, or all of it."""
    at = F.locate(THREAD, prompt)
    return F.when(at > 0, F.substring(prompt, at + len(THREAD), F.length(prompt))).otherwise(prompt)


def offline(keywords: DataFrame, terms: Sequence[str] = ()) -> Model:
    """A model that answers by rule: topics by keyword (tag, ord, keyword), one claim a thread, a page a topic,
    a statement a claim. ``terms`` make a thread one of knowledge even without a topic."""

    def answer(requests: DataFrame) -> DataFrame:
        said = segment(F.col("prompt"))
        hits = keyword_hits(keywords, said)
        some = F.lit(False)
        for t in terms:
            some = some | F.contains(F.lower(said), F.lit(t.lower()))
        known = (F.size(hits) > 0) | some
        none = F.array().cast("array<string>")
        tags = F.when(F.size(hits) > 0, F.slice(hits, 1, 5)).when(some, F.array(F.lit(OVERVIEW))).otherwise(none)
        classify = F.to_json(F.struct(known.alias("is_knowledge_bearing"), tags.alias("topic_tags"), none.alias("entities"), F.lit("keyword match by rule").alias("reason")))
        lines = F.filter(F.split(said, "\n"), lambda x: x.rlike(r"^\s*\[m\d+\]"))
        first = F.get(lines, F.lit(0))
        text = strip(F.regexp_replace(first, r"^\s*\[m\d+\]\s*\([^)]*\)\s*", ""))
        claim = F.struct(
            F.coalesce(F.nullif(F.substring(text, 1, SNIPPET), F.lit("")), F.lit("a message")).alias("claim_text"), F.when(F.size(hits) > 0, F.slice(hits, 1, TAGS)).otherwise(F.array(F.lit(OVERVIEW))).alias("topic_tags"),
            none.alias("entities"), F.lit("factual").alias("stance"), F.array(F.regexp_extract(first, r"\[m(\d+)\]", 1).cast("int")).alias("supporting_message_ids"),
        )
        extract = F.to_json(F.struct(F.when(F.size(lines) > 0, F.array(claim)).otherwise(F.array()).alias("claims")))
        topics = F.transform(F.filter(F.split(F.col("prompt"), "\n"), lambda x: F.startswith(x, F.lit("- id:")) & (F.regexp_extract(x, r"\| claims: (\d+)", 1).cast("int") > 0)), _page)
        plan = F.to_json(F.struct(topics.alias("pages"), F.array().cast("array<string>").alias("links")))
        page = F.coalesce(F.nullif(F.regexp_extract("prompt", r"Current page: (\S+)", 1), F.lit("")), F.lit(OVERVIEW))
        action = lambda c: F.struct(
            F.lit("upsert_statement").alias("type"), page.alias("page_id"), F.lit("").alias("section"), F.lit(None).cast("string").alias("statement_id"),
            F.lit("Members shared information on this topic.").alias("text"), F.array(c).alias("claim_ids"),
        )
        agent = F.to_json(F.struct(F.transform(F.regexp_extract_all("prompt", F.lit(r"claim_id:\s*(\S+)"), F.lit(1)), action).alias("actions")))
        other = F.slice(F.regexp_extract_all("prompt", F.lit(r"(?m)^- (\S+)\.md —"), F.lit(1)), 1, 2)
        link = F.when(F.size(other) > 0, F.concat(F.lit("(see ["), F.get(other, F.lit(0)), F.lit("]("), F.get(other, F.lit(0)), F.lit(".md)) "))).otherwise("")
        generate = F.to_json(F.struct(F.concat(F.lit("Members of the group shared information on this topic. "), link).alias("body"), other.alias("related_pages")))
        task = F.col("task")
        found = (
            F.when(task == "classify", classify).when(task == "extract", extract).when(task == "plan", plan).when(task == "agent", agent).when(task == "generate", generate)
            .when(task == "grounded", F.lit("_No search was made._"))
        )
        return requests.select("key", found.alias("answer"))

    return answer


def _page(line: Column) -> Column:
    """A page of a topic's line in a plan prompt."""
    topic = strip(F.regexp_extract(line, r"^- id:([^|]*)", 1))
    title = strip(F.regexp_extract(line, r"\| title:([^|]*)", 1))
    return F.struct(
        topic.alias("id"), F.coalesce(F.nullif(title, F.lit("")), topic).alias("title"), F.lit("emergent").alias("category"), F.array(topic).alias("source_tags"), F.lit("a page a topic").alias("rationale"), F.lit("").alias("search_focus")
    )


# -- vectors and words --------------------------------------------------------------------
def with_vectors(rows: DataFrame, text: str, encode: Callable[[list[str]], np.ndarray], size: int, query: bool = False, prefixed: bool = True, batch: int = 64) -> DataFrame:
    """``rows`` with ``vector``: texts encoded ``batch`` at a time; blank ones have the zero vector.

    With ``prefixed`` a text is marked as a passage or a query, as models of that family ask for.
    """

    @F.pandas_udf("array<float>")
    def vectors(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        lead = ("query: " if query else "passage: ") if prefixed else ""
        for part in parts:
            out = [np.zeros(size, np.float32)] * len(part)
            at = [i for i, t in enumerate(part) if isinstance(t, str) and t.strip()]
            for a in range(0, len(at), batch):
                some = at[a : a + batch]
                for i, v in zip(some, encode([lead + part.iloc[i].strip() for i in some]), strict=True):
                    out[i] = np.asarray(v, np.float32)
            yield pd.Series(out)

    return rows.withColumn("vector", vectors(text))


def ensure_vectors(rows: DataFrame, path: str, key: str, text: str, model: str, encode: Callable[[list[str]], np.ndarray], size: int, **how) -> DataFrame:
    """(key, vector) kept at ``path``, encoded anew when the model, its settings or the texts have changed."""
    from .sources.documents import ensure_table, signature

    asked = rows.select(key, text)
    meta = {"model": model, "size": size, "source": signature(asked)} | how
    return ensure_table(rows.sparkSession, path, meta, lambda: with_vectors(asked, text, encode, size, **how).select(key, "vector"))


def with_words(rows: DataFrame, text: str, analyze: Callable[[list[str]], list[list[dict]]], batch: int = 32) -> DataFrame:
    """``rows`` with ``words``: (token, core, kind, ner) of each text by an analyzer, ``batch`` texts at a time."""

    @F.pandas_udf("array<struct<token:string,core:string,kind:string,ner:string>>")
    def words(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            texts, out = [t if isinstance(t, str) else "" for t in part], []
            for a in range(0, len(texts), batch):
                for found in analyze(texts[a : a + batch]):
                    out.append([{k: w.get(k) for k in ("token", "core", "kind", "ner")} for w in found])
            yield pd.Series(out)

    return rows.withColumn("words", words(text))


def valid_tokens(tokens: Column) -> Column:
    """Tokens with a Hebrew or Latin letter or a digit that are no marks of the model."""
    return F.filter(tokens, lambda t: t.rlike("[\\u0590-\\u05FFA-Za-z0-9]") & ~t.isin("[CLS]", "[SEP]"))
