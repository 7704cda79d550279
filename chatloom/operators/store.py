"""The page store: actions of an agent folded into pages, statements and links."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

STATEMENTS = "page_id string, statement_id string, section string, text string, claim_ids array<string>, ord int"


def fold_statements(actions: DataFrame, claims: DataFrame) -> DataFrame:
    """Statements after all actions (page_id, ord, section, statement_id, text, claim_ids).

    An action without text or without a known claim does nothing. One that names a
    statement of its page replaces the text and adds claims; any other makes a new
    statement, numbered within its page. Pages are independent; the actions of a page
    apply in order, in one task.
    """
    known = claims.select(F.col("claim_id").alias("known")).distinct()
    each = actions.select("page_id", "ord", F.posexplode("claim_ids").alias("pos", "claim")).withColumn("claim", F.trim("claim"))
    valid = each.join(known, each["claim"] == known["known"], "left_semi").groupBy("page_id", "ord").agg(
        F.array_distinct(F.transform(F.array_sort(F.collect_list(F.struct("pos", "claim"))), lambda x: x["claim"])).alias("valid")
    )
    rows = actions.join(valid, ["page_id", "ord"]).where("trim(coalesce(text, '')) <> '' and trim(page_id) <> ''")
    rows = rows.select("page_id", "ord", F.trim(F.coalesce("section", F.lit(""))).alias("section"), "statement_id", F.trim("text").alias("text"), "valid")

    def fold(page: pd.DataFrame) -> pd.DataFrame:
        made: dict[str, list] = {}
        for r in page.sort_values("ord", kind="stable").itertuples():
            name = r.statement_id if isinstance(r.statement_id, str) and r.statement_id in made else f"{r.page_id}-s{len(made) + 1}"
            if name in made:
                made[name][3] = r.text
                made[name][4] += [c for c in r.valid if c not in made[name][4]]
            else:
                made[name] = [r.page_id, name, r.section, r.text, list(r.valid), len(made)]
        return pd.DataFrame(list(made.values()), columns=["page_id", "statement_id", "section", "text", "claim_ids", "ord"])

    return rows.groupBy("page_id").applyInPandas(fold, STATEMENTS)


def statement_measures(statements: DataFrame, claims: DataFrame, people: DataFrame) -> DataFrame:
    """Distinct supporters over a statement's claims and its claims by stance."""
    from .support import engagement

    cited = statements.select("statement_id", F.explode("claim_ids").alias("claim")).distinct()
    support = engagement(cited, people, "statement_id")
    stance = F.coalesce("stance", F.lit("neutral"))
    stances = cited.join(claims.select(F.col("claim_id").alias("claim"), "stance"), "claim").groupBy("statement_id", stance.alias("stance")).agg(F.count(F.lit(1)).alias("n"))
    split = stances.groupBy("statement_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("stance", "n")))).alias("stance_breakdown"))
    return support.join(split, "statement_id", "left")


def ensure_pages(pages: DataFrame, wanted: DataFrame) -> DataFrame:
    """Pages with those of ``wanted`` (page_id, title, ord) that were missing; the last title given counts."""
    asked = wanted.where("trim(page_id) <> ''").groupBy("page_id").agg(F.max_by("title", F.when(F.col("title").isNotNull(), F.col("ord"))).alias("new_title"))
    return pages.select("page_id", "title", "category").join(asked, "page_id", "full").select(
        "page_id", F.coalesce("new_title", "title", "page_id").alias("title"), F.coalesce("category", F.lit("emergent")).alias("category")
    )


def add_links(links: DataFrame, more: DataFrame, pages: DataFrame) -> DataFrame:
    """Links with new ones between known, different pages, each pair once; the first reason stays."""
    ids = pages.select("page_id").distinct()
    ok = more.where("src <> dst").join(ids, F.col("src") == F.col("page_id"), "left_semi").join(ids, F.col("dst") == F.col("page_id"), "left_semi")
    both = links.select("src", "dst", "reason", F.lit(0).alias("late"), "ord").unionByName(ok.select("src", "dst", "reason", F.lit(1).alias("late"), "ord"))
    order = Window.partitionBy("src", "dst").orderBy("late", "ord")
    return both.withColumn("_n", F.row_number().over(order)).where("_n = 1").select("src", "dst", "reason")


def page_markdown(pages: DataFrame, statements: DataFrame, measures: DataFrame) -> DataFrame:
    """(page_id, markdown): sections in order of their first statement, with counts and never names."""
    rows = statements.join(measures.select("statement_id", "support_count"), "statement_id", "left")
    line = F.format_string("- %s (%d)", "text", F.coalesce("support_count", F.lit(0)))
    sections = rows.groupBy("page_id", "section").agg(
        F.min("ord").alias("first"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", line.alias("l")))), lambda x: x["l"]), "\n").alias("body")
    )
    part = F.when(F.col("section") != "", F.concat(F.lit("## "), "section", F.lit("\n\n"), "body")).otherwise(F.col("body"))
    whole = sections.groupBy("page_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("first", part.alias("p")))), lambda x: x["p"]), "\n\n").alias("text"))
    return pages.join(whole, "page_id").select("page_id", F.concat(F.lit("# "), "title", F.lit("\n\n"), "text", F.lit("\n")).alias("markdown"))


def set_related(related: DataFrame, wanted: DataFrame, pages: DataFrame) -> DataFrame:
    """Related pages (page_id, related, ord) with those of ``wanted`` in place of what their pages had: existing others, each once, in order."""
    ids = pages.select("page_id").distinct()
    asked = wanted.join(ids, "page_id", "left_semi")
    known = asked.where("related <> page_id").join(ids.withColumnRenamed("page_id", "related"), "related", "left_semi")
    new = known.groupBy("page_id", "related").agg(F.min("ord").alias("ord"))
    left = related.join(asked.select("page_id").distinct(), "page_id", "left_anti")
    return left.select("page_id", "related", "ord").unionByName(new.select("page_id", "related", "ord"))


def store_counts(pages: DataFrame, statements: DataFrame, links: DataFrame) -> DataFrame:
    """One row: pages, those with statements, statements, claims that they cite, and links."""
    one = lambda df, c: df.agg(c)
    n = F.count(F.lit(1))
    cited = statements.select(F.explode("claim_ids").alias("claim")).agg(F.count_distinct("claim").alias("claims"))
    # one row each
    return one(pages, n.alias("pages")).join(F.broadcast(statements.agg(F.count_distinct("page_id").alias("pages_with_statements"), n.alias("statements")))).join(
        F.broadcast(cited)
    ).join(F.broadcast(one(links, n.alias("links"))))


def page_catalog(pages: DataFrame, statements: DataFrame) -> DataFrame:
    """(page_id, line): a line of a prompt for each page, ``- id.md — title (n)`` with the number of its statements."""
    n = statements.groupBy(F.col("page_id").alias("_of")).agg(F.count(F.lit(1)).alias("_n"))
    rows = pages.join(n, pages["page_id"] == n["_of"], "left")
    return rows.select("page_id", F.format_string("- %s.md — %s (%d)", "page_id", "title", F.coalesce("_n", F.lit(0))).alias("line"))


def next_statement(statements: DataFrame) -> DataFrame:
    """(page_id, next): the number that a page's next statement takes, after the greatest in use."""
    number = F.regexp_extract("statement_id", r"-s(\d+)$", 1)
    return statements.groupBy("page_id").agg((F.coalesce(F.max(F.when(number != "", number.cast("int"))), F.lit(0)) + 1).alias("next"))
