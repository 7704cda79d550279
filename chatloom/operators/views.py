"""Read queries of the review tools: filters, sorts, pages, histograms and counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def page(rows: DataFrame, order: list[Column], offset: int = 0, limit: int = 50) -> DataFrame:
    """One page in order, with the number of all rows."""
    total = rows.agg(F.count(F.lit(1)).alias("total"))
    # one row
    return rows.orderBy(*order).offset(offset).limit(limit).join(F.broadcast(total))


def in_buckets(rows: DataFrame, **limits: tuple[float | None, float | None]) -> DataFrame:
    """Rows whose columns lie within limits, both ends included; None is open."""
    for column, (low, high) in limits.items():
        if low is not None:
            rows = rows.where(F.col(column) >= low)
        if high is not None:
            rows = rows.where(F.col(column) <= high)
    return rows


def filter_threads(rows: DataFrame, kind: str = "useless") -> DataFrame:
    """``useless``: classified as not worth keeping; ``knowledge``; or ``all``, unclassified ones too."""
    if kind == "all":
        return rows
    return rows.where(F.col("is_knowledge_bearing").eqNullSafe(F.lit(kind == "knowledge")))


def keep_thread(messages: Column, senders: Column, least_messages: int = 3, least_senders: int = 2) -> Column:
    return (messages >= least_messages) & (senders >= least_senders)


def reason(passed: Column, in_topic: Column, in_budget: Column) -> Column:
    """Why a thread was not classified, null if it was."""
    return (
        F.when(~passed, "filtered_by_heuristic").when(~in_topic, "outside_topic_filter").when(~in_budget, "skipped_max_threads")
    )


def first_n(rows: DataFrame, order: str, n: int, by: list[str] | None = None) -> DataFrame:
    """The first ``n`` rows in order, of all or of each group."""
    if not by:
        return rows.orderBy(order).limit(n)
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(*by).orderBy(order))).where(F.col("_n") <= n).drop("_n")


def histogram(rows: DataFrame, value: str, buckets: int = 20) -> DataFrame:
    """Counts in ``buckets`` of equal width, empty ones too; one bucket if all values are equal."""
    ends = rows.agg(F.min(value).cast("double").alias("lo"), F.max(value).cast("double").alias("hi"))
    width = (F.col("hi") - F.col("lo")) / buckets
    at = F.when(F.col("hi") == F.col("lo"), 0).otherwise(F.least(F.lit(buckets - 1), F.floor((F.col(value) - F.col("lo")) / width)))
    counts = rows.where(F.col(value).isNotNull()).join(F.broadcast(ends)).groupBy(at.cast("int").alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    last = F.when(F.col("hi") == F.col("lo"), 0).otherwise(buckets - 1)
    every = ends.where("lo is not null").select("lo", "hi", F.explode(F.sequence(F.lit(0), last)).alias("bucket"))
    return every.join(counts, "bucket", "left").select(
        "bucket", (F.col("lo") + F.col("bucket") * width).alias("low"), F.coalesce("n", F.lit(0)).alias("n")
    )


def month_histogram(rows: DataFrame, ts: str) -> DataFrame:
    return rows.groupBy(F.date_format(ts, "yyyy-MM").alias("month")).agg(F.count(F.lit(1)).alias("n"))


def top_values(rows: DataFrame, array: str, k: int = 15) -> DataFrame:
    """The ``k`` most frequent elements, equals in order."""
    return rows.select(F.explode(array).alias("value")).groupBy("value").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "value").limit(k)


def size_histogram(rows: DataFrame, group: str, cluster: str) -> DataFrame:
    """Number of clusters of each size, by group and over all (group null), in one pass."""
    sizes = rows.groupBy(group, cluster).agg(F.count(F.lit(1)).alias("size"))
    return sizes.groupingSets([[F.col(group), F.col("size")], [F.col("size")]], group, "size").agg(F.count(F.lit(1)).alias("n"))


def matches(c: Column, needle: str) -> Column:
    """Substring without regard to case."""
    return F.contains(F.lower(c), F.lit(needle.lower()))


def entity_list(entities: DataFrame, status: str | None = None, size_min: int = 0, query: str = "") -> DataFrame:
    """Entities by status, size and a needle in the name or any alias."""
    if status:
        entities = entities.where(F.col("status") == status)
    entities = entities.where(F.size("members") >= size_min)
    if query:
        entities = entities.where(matches(F.col("canonical_name"), query) | F.exists("aliases", lambda a: matches(a, query)))
    return entities
