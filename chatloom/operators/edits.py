"""Edits of the review tools, as new tables: relabel, split, move, merge, upsert."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def merge(rows: DataFrame, key: str, ids: list, survivor=None) -> DataFrame:
    """Give rows of ``ids`` the survivor's key, by default the least id."""
    target = min(ids) if survivor is None else survivor
    return rows.withColumn(key, F.when(F.col(key).isin(*ids), F.lit(target)).otherwise(F.col(key)))


def split_ranges(rows: DataFrame, key: str, cuts: DataFrame, order: str) -> DataFrame:
    """Split threads at positions. ``cuts`` (key, start, part) names each part's first
    position; positions before the first cut stay part 0. Adds ``part``."""
    at = F.row_number().over(Window.partitionBy(key).orderBy(order)) - 1
    placed = rows.withColumn("pos", at)
    marks = cuts.select(F.col(key).alias("cut_key"), F.col("start").alias("cut_start"), "part")
    joined = placed.join(marks, (F.col(key) == F.col("cut_key")) & (F.col("pos") >= F.col("cut_start")), "left")
    best = joined.groupBy(*rows.columns, "pos").agg(F.coalesce(F.max_by("part", "cut_start"), F.lit(0)).alias("part"))
    return best


def move(rows: DataFrame, key: str, source, target, low: int, high: int, order: str) -> DataFrame:
    """Rows ``low`` to ``high`` of ``source`` go to ``target``; an emptied source is gone."""
    at = F.row_number().over(Window.partitionBy(key).orderBy(order)) - 1
    placed = rows.withColumn("_pos", at)
    hit = (F.col(key) == source) & F.col("_pos").between(low, high)
    return placed.withColumn(key, F.when(hit, F.lit(target)).otherwise(F.col(key))).drop("_pos")


def extract(rows: DataFrame, key: str, source, target, positions: list[int], order: str) -> DataFrame:
    """Named positions of ``source`` become a thread of their own."""
    at = F.row_number().over(Window.partitionBy(key).orderBy(order)) - 1
    placed = rows.withColumn("_pos", at)
    hit = (F.col(key) == source) & F.col("_pos").isin(*positions)
    return placed.withColumn(key, F.when(hit, F.lit(target)).otherwise(F.col(key))).drop("_pos")


def upsert(rows: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """Rows with the non-null values of ``changes``; new keys are added."""
    names = [c for c in rows.columns if c != key]
    new = changes.select(key, *[F.col(c).alias(f"_new_{c}") for c in changes.columns if c != key])
    joined = rows.join(new, key, "full")
    have = set(new.columns)
    return joined.select(key, *[F.coalesce(f"_new_{c}", c).alias(c) if f"_new_{c}" in have else F.col(c) for c in names])


def delete(rows: DataFrame, gone: DataFrame, key: str) -> DataFrame:
    return rows.join(gone.select(key).distinct(), key, "left_anti")


def fold_groups(claims: DataFrame, groups: DataFrame) -> DataFrame:
    """Fold members of manual groups (representative, member) into their representative:
    members go, and the representative lists them."""
    pairs = groups.where("member <> representative").select("representative", "member").distinct()
    listed = pairs.groupBy(F.col("representative").alias("claim_id")).agg(F.array_sort(F.collect_set("member")).alias("folded"))
    rest = claims.join(pairs.select(F.col("member").alias("claim_id")).distinct(), "claim_id", "left_anti")
    return rest.join(listed, "claim_id", "left").withColumn("folded", F.coalesce("folded", F.array().cast(listed.schema["folded"].dataType)))


def merge_pages(links: DataFrame, ids: list, survivor) -> DataFrame:
    """Links re-pointed to the surviving page; repeated ones and loops go."""
    to = lambda c: F.when(F.col(c).isin(*ids), F.lit(survivor)).otherwise(F.col(c)).alias(c)
    return links.select(to("src"), to("dst")).where("src <> dst").distinct()


def next_number(rows: DataFrame, column: str, prefix: str) -> DataFrame:
    """The number after the greatest that follows ``prefix``."""
    n = F.regexp_extract(column, f"^{prefix}(\\d+)$", 1)
    return rows.agg((F.coalesce(F.max(F.when(n != "", n.cast("bigint"))), F.lit(-1)) + 1).alias("next"))


# -- members of entities (entity_id, name, claim_ids) -------------------------
def reject_entity(members: DataFrame, entity_id) -> DataFrame:
    """Each member of a rejected entity becomes an entity of its own, named by entity and member."""
    own = F.concat_ws("/", F.col("entity_id").cast("string"), "name")
    return members.withColumn("entity_id", F.when(F.col("entity_id") == entity_id, own).otherwise(F.col("entity_id").cast("string")))


def move_member(members: DataFrame, name: str, source, target) -> DataFrame:
    hit = (F.col("entity_id") == source) & (F.col("name") == name)
    return members.withColumn("entity_id", F.when(hit, F.lit(target)).otherwise(F.col("entity_id")))


def move_claims(members: DataFrame, name: str, source, target, claims: list, copy: bool = False) -> DataFrame:
    """Some claims of a member go, or with ``copy`` go as well, to the same name of another entity."""
    chosen = F.array(*map(F.lit, claims))
    hit = (F.col("entity_id") == source) & (F.col("name") == name)
    moved = members.where(hit).select(F.lit(target).alias("entity_id"), "name", F.array_intersect("claim_ids", chosen).alias("claim_ids"))
    rest = members if copy else members.withColumn("claim_ids", F.when(hit, F.array_except("claim_ids", chosen)).otherwise(F.col("claim_ids")))
    both = rest.select("entity_id", "name", "claim_ids").unionByName(moved)
    out = both.groupBy("entity_id", "name").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("claim_ids")))).alias("claim_ids"))
    return out.where("size(claim_ids) > 0")


def exclude_claims(members: DataFrame, excluded: DataFrame) -> DataFrame:
    """Members without the claims that ``excluded`` (entity_id, claim_id) names."""
    gone = excluded.groupBy(F.col("entity_id").alias("x")).agg(F.collect_set("claim_id").alias("gone"))
    joined = members.join(gone, members["entity_id"] == gone["x"], "left")
    return joined.withColumn("claim_ids", F.when(F.col("gone").isNull(), F.col("claim_ids")).otherwise(F.array_except("claim_ids", "gone"))).drop("x", "gone")


def set_status(rows: DataFrame, key: str, ids: list, column: str, value) -> DataFrame:
    return rows.withColumn(column, F.when(F.col(key).isin(*ids), F.lit(value)).otherwise(F.col(column)))


def decouple(groups: DataFrame, group_id, member) -> DataFrame:
    """Take a member out of a manual group (group_id, representative, member); a group of fewer than two goes."""
    left = groups.where(~((F.col("group_id") == group_id) & (F.col("member") == member)))
    size = F.count(F.lit(1)).over(Window.partitionBy("group_id"))
    low = F.min("member").over(Window.partitionBy("group_id"))
    lost = ~F.max((F.col("member") == F.col("representative")).cast("int")).over(Window.partitionBy("group_id")).cast("boolean")
    return left.withColumns({"_n": size, "representative": F.when(lost, low).otherwise(F.col("representative"))}).where("_n >= 2").drop("_n")


def settle_contact(rows: DataFrame, key: str, row_id, contact: str, accept: bool, edited: str | None = None) -> DataFrame:
    """An unsure contact is taken, perhaps edited, or turned down; either way it is not asked for again."""
    hit = F.col(key) == row_id
    sure = F.array_distinct(F.concat("contacts", F.array(F.lit(edited or contact)))) if accept else F.col("contacts")
    return rows.withColumns({
        "contacts": F.when(hit, sure).otherwise(F.col("contacts")),
        "contacts_uncertain": F.when(hit, F.array_remove("contacts_uncertain", contact)).otherwise(F.col("contacts_uncertain")),
    })
