"""Page catalogs: validation, links, routes of claims, support of statements, navigation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.artifacts import saved


#: Bytes of met pairs with their needles that are broadcast at most.
BROADCAST_BYTES = 32 << 20
#: Keywords that one expression of a scan takes.
KEYWORDS = 20_000


def valid_pages(pages: DataFrame, known_tags: DataFrame, fallback: str = "general") -> DataFrame:
    """Pages with an id, the first of each id; tags not in ``known_tags`` (tag) are dropped."""
    order = Window.partitionBy("page_id").orderBy("ord")
    first = pages.where(F.trim("page_id") != "").withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n")
    tags = first.select("page_id", F.posexplode("source_tags").alias("pos", "tag")).join(known_tags.select("tag").distinct(), "tag", "left_semi")
    kept = tags.groupBy("page_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "tag"))), lambda x: x["tag"]).alias("tags"))
    return first.join(kept, "page_id", "left").select(
        "page_id", "ord", "title", F.coalesce(F.nullif(F.trim("category"), F.lit("")), F.lit(fallback)).alias("category"),
        F.coalesce("tags", F.array().cast("array<string>")).alias("source_tags"),
    )


def valid_links(links: DataFrame, pages: DataFrame) -> DataFrame:
    """Links whose ends both exist and differ; repeated links stay."""
    ids = pages.select("page_id").distinct()
    return links.where("src <> dst").join(ids, F.col("src") == F.col("page_id"), "left_semi").join(ids, F.col("dst") == F.col("page_id"), "left_semi")


def route_claims(claims: DataFrame, pages: DataFrame) -> DataFrame:
    """(claim_id, page_id): the first page that lists a claim's tag, else the tag itself; without tags the overview."""
    index = pages.select("ord", "page_id", F.explode("source_tags").alias("tag")).groupBy("tag").agg(F.min_by("page_id", "ord").alias("page_id"))
    tags = F.when(F.size("topics") > 0, F.col("topics")).otherwise(F.array(F.lit("overview")))
    rows = claims.select("claim_id", F.explode(tags).alias("tag"))
    return rows.join(index, "tag", "left").select("claim_id", F.coalesce("page_id", "tag").alias("page_id")).distinct()


def related_pages(links: DataFrame, related: DataFrame, pages: DataFrame) -> DataFrame:
    """Outgoing links, then named related pages, each once and existing."""
    both = links.select(F.col("src").alias("page_id"), F.col("dst").alias("other"), F.lit(0).alias("kind"), "ord").unionByName(
        related.select("page_id", F.col("related").alias("other"), F.lit(1).alias("kind"), "ord")
    )
    first = both.groupBy("page_id", "other").agg(F.min(F.struct("kind", "ord")).alias("at"))
    known = pages.select(F.col("page_id").alias("known")).distinct()
    return first.join(known, F.col("other") == F.col("known"), "left_semi").withColumn(
        "position", F.row_number().over(Window.partitionBy("page_id").orderBy("at"))
    ).select("page_id", "other", "position")


def navigation(pages: DataFrame, files: DataFrame) -> DataFrame:
    """Pages that have a file, categories in the order of their first page."""
    have = pages.join(files.select("page_id").distinct(), "page_id", "left_semi")
    firsts = have.groupBy("category").agg(F.min("ord").alias("category_ord"))
    order = Window.partitionBy("category").orderBy("ord")
    return have.join(firsts, "category").withColumn("page_ord", F.row_number().over(order))


def keyword_hits(keywords: DataFrame, text: Column) -> Column:
    """The tags of which a keyword is in the text, without regard to case, in order of ``ord``.

    ``keywords`` (tag, ord, keyword) is a catalog that people keep and becomes one expression
    of the scan; more than ``KEYWORDS`` rows are an error, not a cut.
    """
    if keywords.limit(KEYWORDS + 1).count() > KEYWORDS:
        raise ValueError(f"more than {KEYWORDS} keywords")
    found: dict[str, tuple[int, list[str]]] = {}
    for row in keywords.collect():
        found.setdefault(row.tag, (row.ord, []))[1].append(row.keyword.lower())
    lowered = F.lower(F.coalesce(text, F.lit("")))
    flags = []
    for tag, (_, words) in sorted(found.items(), key=lambda x: x[1][0]):
        hit = F.lit(False)
        for w in words:
            hit = hit | F.contains(lowered, F.lit(w))
        flags.append(F.when(hit, F.lit(tag)))
    return F.array_compact(F.array(*flags)) if flags else F.array().cast("array<string>")


def keyword_tags(texts: DataFrame, key: str, text: str, keywords: DataFrame, most: int = 5) -> DataFrame:
    """Tags with a keyword in the text, at most ``most`` in order of ``ord``; else the overview."""
    tags = F.slice(keyword_hits(keywords, F.col(text)), 1, most)
    return texts.select(key, F.when(F.size(tags) > 0, tags).otherwise(F.array(F.lit("overview"))).alias("tags"))


def contained(needles: DataFrame, hay: DataFrame, needle_words: int = 4, letters: int = 8) -> DataFrame:
    """(needle_id, hay_id): texts that contain a needle as a substring, wherever in a word it begins or ends.

    All words of a needle but its first and last are whole words of the text: the first
    ``needle_words`` of these are an equi-join key against the word sequences of that
    length. A needle of one or two words has none: the first ``letters`` characters of its
    longest word are a key against the parts of that length of the text's words. Only
    lengths that needles have are made. ``contains`` then decides. A needle without words
    (empty or white space) is tried on every text; a short one of common words meets many.
    """
    words = lambda c: F.filter(F.split(F.regexp_replace(c, "\\s+", " "), " "), lambda w: w != "")
    n = needles.where("needle is not null").select("needle_id", "needle", words(F.col("needle")).alias("w")).withColumn("size", F.size("w"))
    inner = F.slice("w", 2, F.least(F.size("w") - 2, F.lit(needle_words)))
    longest = F.array_max(F.transform("w", lambda x: F.struct(F.length(x).alias("n"), x.alias("x"))))["x"]
    keyed = n.where("size > 2").select("needle_id", "needle", F.lit("words").alias("kind"), F.least(F.col("size") - 2, F.lit(needle_words)).alias("n"), F.array_join(inner, " ").alias("key"))
    part = F.substring(longest, 1, letters)
    keyed = keyed.unionByName(
        n.where("size in (1, 2)").select("needle_id", "needle", F.lit("letters").alias("kind"), F.length(part).alias("n"), part.alias("key"))
    )
    # at most needle_words + letters rows
    lengths = {(r.kind, r.n) for r in keyed.select("kind", "n").distinct().collect()}
    h = hay.where("hay is not null").select("hay_id", words(F.col("hay")).alias("w"))
    windows = lambda size, m: F.when(size >= m, F.sequence(F.lit(1), size - m + 1)).otherwise(F.array().cast("array<int>"))

    def grams(m: int):
        return F.transform(windows(F.size("w"), m), lambda i: F.array_join(F.slice("w", i, m), " "))

    def parts(m: int):
        return F.flatten(F.transform(F.array_distinct("w"), lambda x: F.transform(windows(F.length(x), m), lambda i: F.substring(x, i, F.lit(m)))))

    met = n.where("size = 0").crossJoin(hay.select("hay_id")).select("needle_id", "needle", "hay_id")
    for kind, m in sorted(lengths):
        made = h.select("hay_id", F.explode(grams(m) if kind == "words" else parts(m)).alias("key"))
        own = keyed.where((F.col("kind") == kind) & (F.col("n") == m))
        met = met.unionByName(own.join(made, "key").select("needle_id", "needle", "hay_id"))
    # what met is little beside the texts, which then need not move
    met = saved(met.distinct())
    size = met.agg(F.sum(4 * F.length("needle") + 64)).first()[0] or 0
    met = F.broadcast(met) if size <= BROADCAST_BYTES else met
    texts = hay.where("hay is not null").select(F.col("hay_id").alias("_id"), "hay")
    return texts.join(met, F.col("_id") == F.col("hay_id")).where(F.contains("hay", F.col("needle"))).select("needle_id", "hay_id").distinct()
