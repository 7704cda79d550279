"""Wiki plans: pages from topics, the topic catalog, and what reviewers change in them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import strip

NONE = "array<string>"
EMERGENT = "emergent"


def identity_plan(topics: DataFrame, focus: DataFrame, least: int = 1) -> DataFrame:
    """A page for each topic (topic, ord, title, category, claim_count) with enough claims."""
    pages = topics.where(F.col("claim_count") >= least).select(
        F.col("topic").alias("page_id"), "ord", "title", "category", F.array("topic").alias("source_tags"), F.lit("identity mapping (no plan agent)").alias("rationale"),
        F.lit(None).cast("string").alias("search_focus"),
    )
    return with_focus(pages, focus)


def plan_or_identity(pages: DataFrame, topics: DataFrame, focus: DataFrame, least: int = 1) -> DataFrame:
    """The pages of a plan, or one for each topic if it has none."""
    own = pages.select("page_id", "ord", "title", "category", "source_tags", "rationale", "search_focus")
    # no rows or one
    empty = own.agg(F.count(F.lit(1)).alias("_n")).where("_n = 0")
    return own.unionByName(identity_plan(topics, focus, least).join(F.broadcast(empty)).drop("_n"))


def normal_plan(raw: DataFrame, topics: DataFrame, categories: DataFrame, focus: DataFrame) -> DataFrame:
    """Pages of a model's plan (ord, page_id, title, category, source_tags, rationale, search_focus).

    Pages without an id or without a known topic go, and of one id the first such page stays. Title
    and category fall back to those of the first topic left, the category also if
    ``categories`` (category) does not list it.
    """
    base = raw.withColumn("page_id", F.trim(F.coalesce("page_id", F.lit("")))).where("page_id <> ''")
    tags = base.select("ord", F.posexplode(F.coalesce("source_tags", F.array().cast(NONE))).alias("pos", "tag")).withColumn("tag", F.trim("tag"))
    known = tags.join(topics.select(F.col("topic").alias("tag"), F.col("title").alias("t"), F.col("category").alias("c")), "tag")
    kept = known.groupBy("ord").agg(F.array_sort(F.collect_list(F.struct("pos", "tag", "t", "c"))).alias("k"))
    rows = base.drop("source_tags").join(kept, "ord").withColumn("_n", F.row_number().over(Window.partitionBy("page_id").orderBy("ord"))).where("_n = 1")
    listed = categories.select(F.col("category").alias("_known")).distinct()
    first = F.element_at("k", 1)
    rows = rows.withColumn("_cat", F.trim(F.coalesce(F.nullif("category", F.lit("")), first["c"]))).join(listed, F.col("_cat") == F.col("_known"), "left")
    pages = rows.select(
        "page_id", "ord", F.trim(F.coalesce(F.nullif("title", F.lit("")), first["t"])).alias("title"), F.when(F.col("_known").isNotNull(), F.col("_cat")).otherwise(first["c"]).alias("category"),
        F.transform("k", lambda x: x["tag"]).alias("source_tags"), F.coalesce("rationale", F.lit("")).alias("rationale"), "search_focus",
    )
    return with_focus(pages, focus)


def with_focus(pages: DataFrame, focus: DataFrame) -> DataFrame:
    """Pages with the search terms of the catalog (topic, focus): the page's own, then those of its topics in order, else its own value."""
    keys = pages.select("page_id", F.posexplode(F.concat(F.array("page_id"), F.coalesce("source_tags", F.array().cast(NONE)))).alias("pos", "topic"))
    best = keys.join(focus.where("focus <> ''"), "topic").groupBy("page_id").agg(F.min_by("focus", "pos").alias("_focus"))
    return pages.join(best, "page_id", "left").withColumn("search_focus", F.coalesce("_focus", F.trim("search_focus"), F.lit(""))).drop("_focus")


def with_catalog(topics: DataFrame, catalog: DataFrame, categories: DataFrame) -> DataFrame:
    """Topics with title and category of the catalog (topic, title, category); others are emergent and their own title."""
    known = catalog.select(F.col("topic").alias("_of"), F.col("title").alias("_title"), F.col("category").alias("_category"))
    names = categories.select(F.col("category").alias("_cat"), F.col("title").alias("_cat_title"))
    category = F.coalesce("_category", F.lit(EMERGENT))
    rows = topics.join(known, topics["topic"] == known["_of"], "left").withColumns(
        {"title": F.coalesce("_title", "topic"), "category": category, "is_emergent": F.col("_of").isNull()}
    )
    return rows.join(names, rows["category"] == names["_cat"], "left").withColumn("category_title", F.coalesce("_cat_title", "category")).drop("_of", "_title", "_category", "_cat", "_cat_title")


def page_counts(pages: DataFrame, topics: DataFrame) -> DataFrame:
    """Pages with the claims and merged claims of their topics summed; without topics a page counts its own id's."""
    tags = F.when(F.size(F.coalesce("source_tags", F.array().cast(NONE))) > 0, F.col("source_tags")).otherwise(F.array("page_id"))
    each = pages.select("page_id", F.explode(tags).alias("topic")).join(topics.select("topic", "claim_count", "merged_claim_count"), "topic")
    sums = each.groupBy("page_id").agg(F.sum("claim_count").cast("bigint").alias("claim_count"), F.sum("merged_claim_count").cast("bigint").alias("merged_claim_count"))
    zero = lambda c: F.coalesce(c, F.lit(0).cast("bigint"))
    return pages.join(sums, "page_id", "left").withColumns({"claim_count": zero("claim_count"), "merged_claim_count": zero("merged_claim_count"), "source_tags": tags})


def page_claims(pages: DataFrame, groups: DataFrame) -> DataFrame:
    """Merged claims of each page: its topics in order, their groups in order (topic, ord, ...)."""
    tags = F.when(F.size(F.coalesce("source_tags", F.array().cast(NONE))) > 0, F.col("source_tags")).otherwise(F.array("page_id"))
    each = pages.select("page_id", F.posexplode(tags).alias("tag_pos", "topic"))
    order = Window.partitionBy("page_id").orderBy("tag_pos", "ord")
    return each.join(groups, "topic").withColumn("position", F.row_number().over(order))


def topic_summaries(topics: DataFrame, groups: DataFrame, names: int = 6, samples: int = 3, letters: int = 120) -> DataFrame:
    """One row a topic, the largest first: the names in its first five groups, sorted, and its first groups' texts, cut to ``letters``."""
    first = groups.withColumn("_n", F.row_number().over(Window.partitionBy("topic").orderBy("ord"))).where("_n <= 5")
    listed = first.groupBy("topic").agg(
        F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("entities")))), 1, names).alias("entities"),
        F.transform(F.array_sort(F.collect_list(F.when(F.col("_n") <= samples, F.struct("_n", F.substring("claim_text", 1, letters).alias("t"))))), lambda x: x["t"]).alias("samples"),
    )
    empty = lambda c: F.coalesce(c, F.array().cast(NONE)).alias(c)
    rows = topics.join(listed, "topic", "left").select("topic", "ord", "title", "category", "claim_count", empty("entities"), empty("samples"))
    # a row a topic, which the catalog and the claims' tags bound
    return rows.withColumn("position", F.row_number().over(Window.orderBy(F.desc("claim_count"), "ord", "topic")))


def summary_line() -> Column:
    """A topic's row of ``topic_summaries`` as a line of a prompt."""
    none = lambda c, sep, text: F.when(F.size(c) > 0, F.array_join(c, sep)).otherwise(F.lit(text))
    return F.format_string("- id: %s | title: %s | claims: %d | category: %s | entities: %s | samples: %s", "topic", "title", "claim_count", "category", none("entities", ", ", "(none)"), none("samples", " / ", "(none)"))


def outgoing(links: DataFrame) -> DataFrame:
    """(page_id, dst, position): pages that each page links to, once each, in the order first named; never itself."""
    first = links.where("dst <> '' and src <> dst").groupBy("src", "dst").agg(F.min("ord").alias("ord"))
    return first.select(F.col("src").alias("page_id"), "dst", F.row_number().over(Window.partitionBy("src").orderBy("ord", "dst")).alias("position"))


# -- edits -------------------------------------------------------------------
def update_page(pages: DataFrame, page_id: str, categories: list[str], **values: str | None) -> DataFrame:
    """A page with new title, category, search_focus or rationale, trimmed; None leaves the old one."""
    if values.get("category") is not None and values["category"] not in categories:
        raise ValueError(f"unknown category: {values['category']}")
    new = {c: F.when(F.col("page_id") == page_id, F.lit(v.strip())).otherwise(F.col(c)) for c, v in values.items() if v is not None}
    return pages.withColumns(new) if new else pages


def merge_pages(pages: DataFrame, links: DataFrame, source: str, target: str) -> tuple[DataFrame, DataFrame]:
    """Pages and links with ``source`` merged into ``target``: its topics come after the target's, each once;
    its links are re-pointed, and loops and links without a page go."""
    if source == target:
        raise ValueError("a page cannot be merged with itself")
    tags = F.when(F.size(F.coalesce("source_tags", F.array().cast(NONE))) > 0, F.col("source_tags")).otherwise(F.array("page_id"))
    # at most one row
    taken = pages.where(F.col("page_id") == source).select(tags.alias("_more"))
    rows = pages.where(F.col("page_id") != source).join(F.broadcast(taken), F.col("page_id") == target, "left")
    merged = rows.withColumn("source_tags", F.when(F.col("page_id") == target, F.array_distinct(F.concat(tags, F.coalesce("_more", F.array().cast(NONE))))).otherwise(F.col("source_tags"))).drop("_more")
    to = lambda c: F.when(F.col(c) == source, F.lit(target)).otherwise(F.col(c))
    ids = merged.select(F.col("page_id").alias("_id")).distinct()
    kept = links.withColumns({"src": to("src"), "dst": to("dst")}).where("src <> dst")
    kept = kept.join(ids, F.col("src") == F.col("_id"), "left_semi").join(ids, F.col("dst") == F.col("_id"), "left_semi")
    return merged, kept


def move_claim(groups: DataFrame, source: str, key: str, target: str) -> DataFrame:
    """The first group of a topic that has the key goes to the end of another topic (topic, key, ord, ...)."""
    if source == target:
        raise ValueError("source and target topic are the same")
    order = Window.partitionBy("topic", "key").orderBy("ord")
    rows = groups.withColumn("_n", F.row_number().over(order))
    end = groups.where(F.col("topic") == target).agg(F.coalesce(F.max("ord"), F.lit(-1)).alias("_last"))
    hit = (F.col("topic") == source) & (F.col("key") == key) & (F.col("_n") == 1)
    # one row
    return rows.join(F.broadcast(end)).withColumns({"ord": F.when(hit, F.col("_last") + 1).otherwise(F.col("ord")), "topic": F.when(hit, F.lit(target)).otherwise(F.col("topic"))}).drop("_n", "_last")


# -- text around pages ---------------------------------------------------------
# The texts that pages show, in the language of their readers.
SUPPORTERS, FOR, AGAINST = "תומכים ייחודיים", "בעד", "נגד"
STANCES = {"positive": "חיובי", "negative": "שלילי", "neutral": "ניטרלי", "factual": "עובדתי"}
FOOTER = "\n---\n\n*מידע הקהילה מבוסס על %d טענות מתוך שיחות הקבוצה (%s). אינו ייעוץ מקצועי.*\n"
UNKNOWN = "לא ידוע"
COMMUNITY, NO_COMMUNITY = "## מידע מהקהילה", "_לא נמצא מידע קהילתי לנושא זה._"
BACKGROUND = '## רקע כללי\n\n!!! info "ממקורות חיצוניים"\n    המידע להלן נאסף ממקורות ציבוריים באינטרנט ואינו משקף דעות חברי הקבוצה.\n\n'
SOURCES, SEEN_ON, RELATED = "## מקורות", "נבדק ב-", "## עמודים קשורים"


def rtl(text: Column) -> Column:
    """Markdown in a block that is read from right to left."""
    return F.concat(F.lit('<div dir="rtl" markdown="1">\n\n'), strip(text), F.lit("\n\n</div>\n"))


def stance_label(stance: Column) -> Column:
    """A stance in the readers' language, others as they are."""
    return F.coalesce(F.create_map(*[F.lit(x) for pair in STANCES.items() for x in pair])[stance], stance)


def support_note(supporters: Column, positive: Column, negative: Column) -> Column:
    """How many people back a statement, and how its claims stand where they are of both minds; counts only."""
    both = F.concat(F.lit(f" · {FOR}: "), positive.cast("string"), F.lit(f" · {AGAINST}: "), negative.cast("string"))
    return F.concat(F.lit("("), supporters.cast("string"), F.lit(f" {SUPPORTERS}"), F.when((positive > 0) & (negative > 0), both).otherwise(""), F.lit(")"))


def page_footers(statements: DataFrame, claims: DataFrame) -> DataFrame:
    """(page_id, n_claims, first_date, last_date, footer): distinct claims that a page's statements cite, and the range of their dates."""
    cited = statements.select("page_id", F.explode("claim_ids").alias("claim_id")).distinct()
    rows = cited.join(claims.select("claim_id", "date").dropDuplicates(["claim_id"]), "claim_id", "left")
    date = F.nullif("date", F.lit(""))
    sums = rows.groupBy("page_id").agg(F.count(F.lit(1)).alias("n_claims"), F.min(date).alias("first_date"), F.max(date).alias("last_date"))
    span = (
        F.when(F.col("first_date").isNull(), UNKNOWN).when(F.col("first_date") == F.col("last_date"), F.col("first_date")).otherwise(F.concat("first_date", F.lit("–"), "last_date"))
    )
    return sums.withColumn("footer", F.format_string(FOOTER, "n_claims", span))


def _listed(rows: DataFrame, order: str, line: Column, head: str, name: str) -> DataFrame:
    """(page_id, name): a section of one line a row, in order."""
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), line.alias("l")))), lambda x: x["l"]), "\n")
    return rows.groupBy("page_id").agg(F.concat(F.lit(f"{head}\n\n"), body, F.lit("\n")).alias(name))


def source_lists(sources: DataFrame, day: str) -> DataFrame:
    """(page_id, sources): a list of links (page_id, ord, title, url), each address once, at its first place, seen on ``day``."""
    first = sources.where("url <> ''").groupBy("page_id", "url").agg(F.min(F.struct("ord", "title")).alias("f"))
    rows = first.select("page_id", "url", F.struct("f.ord", "url").alias("o"), F.coalesce(F.nullif("f.title", F.lit("")), "url").alias("title"))
    return _listed(rows, "o", F.format_string(f"- [%s](%s) — {SEEN_ON}{day}", "title", "url"), SOURCES, "sources")


def link_lists(related: DataFrame, pages: DataFrame) -> DataFrame:
    """(page_id, links): a list of related pages (page_id, other, position) by title."""
    titles = pages.select(F.col("page_id").alias("other"), F.coalesce("title", "page_id").alias("title"))
    return _listed(related.join(titles, "other"), "position", F.format_string("- [%s](%s.md)", "title", "other"), RELATED, "links")


def page_texts(pages: DataFrame, community: DataFrame, background: DataFrame, sources: DataFrame, links: DataFrame, footers: DataFrame) -> DataFrame:
    """(page_id, markdown): each page's title, background, community text, sources, related pages and footer, as far as it has them.

    The others are by page_id: community (text), background (text), sources, links and footer.
    """
    own = lambda df, c, name: df.select("page_id", F.col(c).alias(name))
    rows = pages.select("page_id", "title")
    for df, c, name in ((community, "text", "_c"), (background, "text", "_b"), (sources, "sources", "_s"), (links, "links", "_l"), (footers, "footer", "_f")):
        rows = rows.join(own(df, c, name), "page_id", "left")
    said = lambda c: strip(F.coalesce(c, F.lit("")))
    back = F.when(said("_b") != "", F.concat(F.lit(BACKGROUND), said("_b"), F.lit("\n")))
    heard = F.concat(F.lit(f"{COMMUNITY}\n\n"), F.when(said("_c") != "", said("_c")).otherwise(NO_COMMUNITY), F.lit("\n"))
    parts = F.array_compact(F.array(F.concat(F.lit("# "), "title", F.lit("\n")), back, heard, F.col("_s"), F.col("_l")))
    return rows.select("page_id", rtl(F.concat(F.array_join(parts, "\n"), F.coalesce("_f", F.lit("")))).alias("markdown"))


def index_pages(pages: DataFrame, categories: DataFrame) -> DataFrame:
    """(category, text): the index, a section for each category in the order of its first page, a link for each page."""
    names = categories.select(F.col("category").alias("_c"), F.col("title").alias("_t"))
    line = F.format_string("- [%s](%s.md)", "title", "page_id")
    parts = pages.groupBy("category").agg(F.min("ord").alias("ord"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", line.alias("l")))), lambda x: x["l"]), "\n").alias("body"))
    rows = parts.join(names, parts["category"] == names["_c"], "left")
    return rows.select("category", "ord", F.concat(F.lit("## "), F.coalesce("_t", "category"), F.lit("\n\n"), "body", F.lit("\n")).alias("text"))
