"""Contacts of claims and names, seed names, and which names a claim mentions.

A contact is a struct (kind, value) of kind email, phone or website.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import find_emails, find_phones, find_websites, strip

KINDS = ("email", "phone", "website")
CONTACT = "array<struct<kind:string,value:string>>"
REDACTIONS = "array<struct<type:string,value:string>>"


def _typed(values: Column, kind: str) -> Column:
    return F.transform(values, lambda v: F.struct(F.lit(kind).alias("kind"), v.alias("value")))


def text_contacts(text: Column, redactions: Column) -> Column:
    """Contacts of a text and of what was taken out of it, in order of kind and value, each once."""
    text = F.coalesce(text, F.lit(""))
    taken = F.transform(
        F.filter(F.coalesce(redactions, F.array().cast(REDACTIONS)), lambda r: r["type"].isin("email", "phone")), lambda r: F.struct(r["type"].alias("kind"), r["value"].alias("value"))
    )
    found = F.concat(taken, _typed(find_emails(text), "email"), _typed(find_phones(text), "phone"), _typed(find_websites(text), "website"))
    return F.array_sort(F.array_distinct(found))


def claim_contacts(claims: DataFrame, originals: DataFrame | None = None) -> DataFrame:
    """(claim_id, contacts): contacts of each claim (claim_id, claim_text, redactions) and of its
    original, if there is one; an edit does not lose those that stood there."""
    own = claims.select("claim_id", text_contacts(F.col("claim_text"), F.col("redactions")).alias("own"))
    if originals is None:
        return own.select("claim_id", F.col("own").alias("contacts"))
    old = originals.select(F.col("claim_id").alias("_of"), text_contacts(F.col("claim_text"), F.col("redactions")).alias("old")).dropDuplicates(["_of"])
    both = F.array_sort(F.array_union("own", F.coalesce("old", F.array().cast(CONTACT))))
    return own.join(old, own["claim_id"] == old["_of"], "left").select("claim_id", both.alias("contacts"))


def name_records(claims: DataFrame, contacts: DataFrame, mentions: DataFrame, samples: int = 12) -> DataFrame:
    """One record a name that some claim lists: claim_count, sample_claim_ids, topics, contacts and contacts_uncertain.

    ``claims`` has claim_id, ord, entities and topics; ``mentions`` (claim_id, name) are claims whose text
    names it, which count as well. Samples are the first ``samples`` claims that list the name,
    then those that only mention it. A contact is sure where a claim lists that one
    name only; others are unsure unless they are sure elsewhere. Topics and contacts are folded
    by name first, so a very frequent name is counted in parts.
    """
    listed = F.array_distinct(F.filter(F.coalesce("entities", F.array().cast("array<string>")), lambda n: F.trim(n) != ""))
    base = claims.select("claim_id", "ord", listed.alias("listed"), "topics")
    tagged = base.select("claim_id", "ord", F.explode("listed").alias("name"), (F.size("listed") == 1).alias("sure"), F.lit(0).alias("late"))
    names = tagged.select("name").distinct()
    told = mentions.select("claim_id", "name").distinct().join(names, "name", "left_semi").join(base.select("claim_id", "ord"), "claim_id")
    both = tagged.unionByName(told.select("claim_id", "ord", "name", F.lit(False).alias("sure"), F.lit(1).alias("late")))
    # a claim that lists a name absorbs its mention
    rows = both.groupBy("name", "claim_id").agg(F.min("ord").alias("ord"), F.max("sure").alias("sure"), F.min("late").alias("late"))
    counts = rows.groupBy("name").agg(F.count(F.lit(1)).alias("claim_count"))
    order = Window.partitionBy("name").orderBy("late", "ord", "claim_id")
    first = rows.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= samples).groupBy("name").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("_n", "claim_id"))), lambda x: x["claim_id"]).alias("sample_claim_ids")
    )
    topics = rows.join(base.select("claim_id", F.explode("topics").alias("topic")), "claim_id").groupBy("name").agg(F.array_sort(F.collect_set("topic")).alias("topics"))
    each = rows.join(contacts.select("claim_id", F.explode("contacts").alias("c")), "claim_id").groupBy("name", "c").agg(F.max("sure").alias("sure"))
    pick = lambda yes: F.array_sort(F.collect_set(F.when(F.col("sure") == yes, F.col("c"))))
    found = each.groupBy("name").agg(pick(True).alias("contacts"), pick(False).alias("contacts_uncertain"))
    none = F.array().cast(CONTACT)
    return counts.join(first, "name").join(topics, "name", "left").join(found, "name", "left").select(
        "name", "claim_count", "sample_claim_ids", F.coalesce("topics", F.array().cast("array<string>")).alias("topics"),
        F.coalesce("contacts", none).alias("contacts"), F.coalesce("contacts_uncertain", none).alias("contacts_uncertain"),
    )


def contact_keys(contacts: Column) -> Column:
    """``kind:value`` of each contact."""
    return F.transform(contacts, lambda c: F.concat_ws(":", c["kind"], c["value"]))


def of_kind(contacts: Column, kind: str) -> Column:
    """The values of one kind."""
    return F.transform(F.filter(contacts, lambda c: c["kind"] == kind), lambda c: c["value"])


def clean_contacts(values: Column) -> Column:
    """Values as typed in by a reviewer: trimmed, blank ones left out, each once, in order."""
    trimmed = F.transform(F.coalesce(values, F.array().cast("array<string>")), lambda v: strip(v))
    return F.array_distinct(F.filter(trimmed, lambda v: v.isNotNull() & (v != "")))


def seed_index(seeds: DataFrame) -> DataFrame:
    """(norm, seed_id): the first seed that has a name. ``seeds`` has ord, seed_id (null: numbered by ord),
    canonical_norm and alias_norms, which are normal forms; blank ones name nothing."""
    own = F.coalesce("seed_id", F.format_string("seed%03d", F.col("ord")))
    names = F.concat(F.array("canonical_norm"), F.coalesce("alias_norms", F.array().cast("array<string>")))
    rows = seeds.select("ord", own.alias("seed_id"), F.posexplode(names).alias("pos", "norm")).where("norm <> ''")
    return rows.groupBy("norm").agg(F.min_by("seed_id", F.struct("ord", "pos")).alias("seed_id"))


def with_seed(names: DataFrame, index: DataFrame) -> DataFrame:
    """Names (with norm) and the seed that they belong to, null if none."""
    return names.join(index.select(F.col("norm").alias("_norm"), F.col("seed_id").alias("seed")), names["norm"] == F.col("_norm"), "left").drop("_norm")


def alias_index(entities: DataFrame) -> DataFrame:
    """(alias, entity_id): the first entity that has a name. ``entities`` has ord, entity_id, canonical_name and aliases."""
    names = F.concat(F.array("canonical_name"), F.coalesce("aliases", F.array().cast("array<string>")))
    rows = entities.select("ord", "entity_id", F.explode(names).alias("alias")).where("alias <> ''")
    return rows.groupBy("alias").agg(F.min_by("entity_id", "ord").alias("entity_id"))


def claim_entities(mentions: DataFrame, index: DataFrame) -> DataFrame:
    """(claim_id, entity_id, name): entities whose names a claim's text has, with the longest such name (of equals the first)."""
    rows = mentions.select("claim_id", F.col("name").alias("alias")).distinct().join(index, "alias")
    return rows.groupBy("claim_id", "entity_id").agg(F.min_by("alias", F.struct(-F.length("alias"), F.col("alias"))).alias("name"))


def other_entities(claim_entities_: DataFrame, entity_id) -> DataFrame:
    """Entities beside the given one in the claims' texts."""
    return claim_entities_.where(F.col("entity_id") != entity_id)


def tagged_only(claims: DataFrame, claim_entities_: DataFrame, index: DataFrame) -> DataFrame:
    """(claim_id, entity_id, name): entities that a claim lists but whose names its text does not have."""
    listed = claims.select("claim_id", F.posexplode(F.coalesce("entities", F.array().cast("array<string>"))).alias("pos", "alias")).join(index, "alias")
    first = listed.groupBy("claim_id", "entity_id").agg(F.min_by("alias", "pos").alias("name"))
    return first.join(claim_entities_.select("claim_id", "entity_id"), ["claim_id", "entity_id"], "left_anti")


def cluster_signals(pairs: DataFrame, clusters: DataFrame, names: DataFrame, least: float) -> DataFrame:
    """(cluster, merge_signals, conflict_with) of each cluster (ord, cluster).

    Signals of pairs within a cluster that are similar enough count; pairs that the topic
    guard holds apart name each other's clusters by their most frequent name
    (``names``: ord, name, claim_count). ``pairs`` has i, j, similarity, signals and guarded.
    """
    side = lambda c: clusters.select(F.col("ord").alias(c), F.col("cluster").alias(f"c{c}"))
    rows = pairs.join(side("i"), "i").join(side("j"), "j")
    inside = rows.where((F.col("ci") == F.col("cj")) & (F.col("similarity") >= least)).select(F.col("ci").alias("cluster"), F.explode("signals").alias("s"))
    signals = inside.groupBy("cluster").agg(F.array_sort(F.collect_set("s")).alias("merge_signals"))
    title = clusters.join(names, "ord").groupBy("cluster").agg(F.max_by("name", F.struct("claim_count", -F.col("ord"))).alias("title"))
    apart = rows.where("guarded and ci <> cj").select(F.explode(F.array(F.struct(F.col("ci").alias("cluster"), F.col("cj").alias("other")), F.struct(F.col("cj").alias("cluster"), F.col("ci").alias("other")))).alias("p")).select("p.*").distinct()
    conflicts = apart.join(title.toDF("other", "title"), "other").groupBy("cluster").agg(F.array_sort(F.collect_set("title")).alias("conflict_with"))
    none = F.array().cast("array<string>")
    return clusters.select("cluster").distinct().join(signals, "cluster", "left").join(conflicts, "cluster", "left").select(
        "cluster", F.coalesce("merge_signals", none).alias("merge_signals"), F.coalesce("conflict_with", none).alias("conflict_with"),
        F.when(F.col("conflict_with").isNotNull(), "ambiguous").otherwise("suggested").alias("status"),
    )
