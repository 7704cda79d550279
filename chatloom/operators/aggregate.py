"""Roll-ups of claims by topic, entity, stance and month, and clustering of near copies."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dominant(rows: DataFrame, keys: list[str], value: str, order: str) -> DataFrame:
    """The most frequent value of each group; of equals the one seen first."""
    counted = rows.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("first_ord"))
    return counted.groupBy(*keys).agg(F.max_by(value, F.struct("n", -F.col("first_ord"))).alias(value))


def breakdown(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    return rows.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"))


def entity_stances(claims: DataFrame) -> DataFrame:
    """Support by topic, entity and stance; ``claims`` has topic, entities, stance and support_count."""
    return claims.select("topic", F.explode("entities").alias("entity"), "stance", "support_count").groupBy("topic", "entity", "stance").agg(
        F.sum("support_count").alias("support")
    )


def contradictions(stances: DataFrame) -> DataFrame:
    """Entities with support for and against, the most disputed first within a topic."""
    part = lambda s: F.sum(F.when(F.col("stance") == s, F.col("support")).otherwise(0))
    both = stances.groupBy("topic", "entity").agg(part("positive").alias("positive"), part("negative").alias("negative"))
    order = Window.partitionBy("topic").orderBy(F.desc(F.col("positive") + F.col("negative")), "entity")
    return both.where("positive > 0 and negative > 0").withColumn("rank", F.row_number().over(order))


def contested(votes: DataFrame, keys: list[str]) -> DataFrame:
    """Groups with distinct supporters and opposers both: counts of each."""
    from .support import support_counts

    people = support_counts(votes, tuple(keys))
    return people.where("author_count + reaction_endorser_count > 0 and opposer_count > 0").select(
        *keys, F.col("support_count").alias("supporters"), F.col("opposer_count").alias("opposers")
    )


def timeline(claims: DataFrame, keys: list[str], month: str = "month") -> DataFrame:
    return claims.groupBy(*keys, month).agg(F.count(F.lit(1)).alias("n"))


def topic_rollup(claims: DataFrame) -> DataFrame:
    """Claims, distinct claims, support and range of months of each topic. A claim that
    names a topic twice counts twice; one without a topic is in the overview."""
    topics = F.when(F.size("topics") > 0, F.col("topics")).otherwise(F.array(F.lit("overview")))
    rows = claims.select("claim_id", "month", "support_count", F.explode(topics).alias("topic"))
    one = rows.groupBy("topic", "claim_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("support_count").alias("s"), F.min("month").alias("lo"), F.max("month").alias("hi")
    )
    return one.groupBy("topic").agg(
        F.sum("n").alias("claim_count"), F.count(F.lit(1)).alias("distinct_claims"), F.sum("s").alias("support"),
        F.min("lo").alias("first_month"), F.max("hi").alias("last_month"),
    )


def merged_claims(claims: DataFrame, votes: DataFrame) -> DataFrame:
    """One row a cluster (topic, stance, cluster): its medoid's text, its size, its range
    of months, its threads, and distinct supporters (or the sum of the claims' own
    counts where nobody is known)."""
    from .support import support_counts

    keys = ["topic", "stance", "cluster"]
    base = claims.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("statement_count"), F.count_distinct("thread_id").alias("thread_count"),
        F.sum("support_count").alias("sum_support"), F.min("month").alias("first_month"), F.max("month").alias("last_month"),
        F.min_by("claim_text", F.struct(~F.col("is_medoid"), "claim_id")).alias("claim_text"),
        F.array_sort(F.collect_set("claim_id")).alias("source_claim_ids"),
    )
    people = support_counts(claims.select(*keys, F.col("claim_id").alias("claim")).join(votes, "claim"), tuple(keys))
    return base.join(people.select(*keys, F.col("support_count").alias("known")), keys, "left").withColumn(
        "support_count", F.coalesce("known", "sum_support")
    ).drop("known", "sum_support")


# -- clustering ----------------------------------------------------------
def complete_linkage(distance: np.ndarray, threshold: float) -> np.ndarray:
    """Labels of complete-linkage clusters: those with the least greatest distance are
    joined while it is below ``threshold``; of equals the pair of least numbers. A
    cluster's label is its least member."""
    d = np.array(distance, np.float32)
    n = len(d)
    np.fill_diagonal(d, np.inf)
    labels = np.arange(n)
    nearest = d.argmin(axis=1) if n else np.zeros(0, int)
    alive = np.ones(n, bool)
    while alive.sum() > 1:
        rows = np.flatnonzero(alive)
        i = rows[np.argmin(d[rows, nearest[rows]])]
        j = int(nearest[i])
        if not d[i, j] < threshold:
            break
        i, j = min(i, j), max(i, j)
        merged = np.maximum(d[i], d[j])
        d[i], d[:, i] = merged, merged
        d[i, i] = np.inf
        d[j], d[:, j] = np.inf, np.inf
        alive[j] = False
        labels[labels == j] = i
        for k in np.flatnonzero(alive):
            if k == i or nearest[k] in (i, j):
                nearest[k] = d[k].argmin()
    return labels


def halves(distance: np.ndarray) -> np.ndarray:
    """Labels of the two clusters that complete linkage would join last."""
    d = np.array(distance, np.float32)
    np.fill_diagonal(d, np.inf)
    labels, left = np.arange(len(d)), len(d)
    while left > 2:
        i, j = sorted(divmod(int(d.argmin()), len(d)))
        merged = np.maximum(d[i], d[j])
        d[i], d[:, i] = merged, merged
        d[i, i] = np.inf
        d[j], d[:, j] = np.inf, np.inf
        labels[labels == j] = i
        left -= 1
    return labels


def bisected(distance: np.ndarray, labels: np.ndarray, most: int = 8, tight: float = 0.03) -> np.ndarray:
    """Halve clusters of more than ``most`` members until they fit or all lie within ``tight``."""
    out = labels.copy()
    todo = [np.flatnonzero(labels == k) for k in np.unique(labels)]
    while todo:
        members = todo.pop()
        part = distance[np.ix_(members, members)]
        if len(members) <= most or part.max() <= tight:
            out[members] = members.min()
            continue
        split = halves(part)
        parts = [members[split == k] for k in np.unique(split)]
        if len(parts) < 2:
            out[members] = members.min()
        else:
            todo += parts
    return out


def cosine_distance(vectors: np.ndarray, others: np.ndarray | None = None) -> np.ndarray:
    """Distances of the rows of ``vectors`` to those of ``others``, or to one another."""

    def unit(v: np.ndarray) -> np.ndarray:
        norm = np.linalg.norm(v, axis=1, keepdims=True)
        return np.divide(v, norm, out=np.zeros_like(v, float), where=norm > 0)

    u = unit(vectors)
    return (1 - u @ (u if others is None else unit(others)).T).astype(np.float32)


Distance = Callable[[np.ndarray, np.ndarray], np.ndarray]
#: Distances that are held at once.
CELLS = 2_000_000


class Joined(NamedTuple):
    """Two clusters that became one, and their greatest distance; a cluster of one item is its number."""

    height: np.float32
    size: int
    left: Joined | int
    right: Joined | int

    def items(self) -> list[int]:
        found, todo = [], [self]
        while todo:
            x = todo.pop()
            if isinstance(x, Joined):
                todo += (x.left, x.right)
            else:
                found.append(x)
        return found


def _nearest(vectors: np.ndarray, members: dict[int, np.ndarray], of: list[int], among: list[int], distance: Distance) -> tuple[np.ndarray, np.ndarray]:
    """The nearest other cluster of each of ``of``, by the greatest distance of members; of equals the least number."""
    names, sizes = np.array(among), np.array([len(members[k]) for k in among])
    order = np.argsort(-sizes, kind="stable")
    # first members of all clusters, then second ones of those that have one, and so on
    widths = [len(names), *(np.searchsorted(-sizes[order], -m, side="left") for m in range(1, sizes.max()))]
    table = vectors[np.concatenate([[members[names[k]][m] for k in order[:w]] for m, w in enumerate(widths)])]
    back = np.argsort(order)
    place = {k: i for i, k in enumerate(among)}
    most = max(1, CELLS // len(table))

    def farthest(rows: np.ndarray) -> np.ndarray:
        d = distance(vectors[rows], table)
        out, at = d[:, : widths[0]], widths[0]
        for w in widths[1:]:
            np.maximum(out[:, :w], d[:, at : at + w], out=out[:, :w])
            at += w
        return out

    near, far = np.zeros(len(of), np.int64), np.zeros(len(of), np.float32)
    lo = 0
    while lo < len(of):
        hi, rows = lo + 1, len(members[of[lo]])
        while hi < len(of) and rows + len(members[of[hi]]) <= most:
            rows += len(members[of[hi]])
            hi += 1
        if rows > most:
            whole = members[of[lo]]
            d = reduce(np.maximum, (farthest(whole[i : i + most]).max(axis=0, keepdims=True) for i in range(0, rows, most)))
        else:
            each = [members[k] for k in of[lo:hi]]
            starts = np.cumsum([0, *map(len, each[:-1])])
            d = farthest(np.concatenate(each))
            if rows > hi - lo:
                d = np.maximum.reduceat(d, starts, axis=0)
        d = d[:, back]
        d[np.arange(hi - lo), [place[k] for k in of[lo:hi]]] = np.inf
        best = d.argmin(axis=1)
        near[lo:hi], far[lo:hi] = names[best], d[np.arange(hi - lo), best]
        lo = hi
    return near, far


def complete_tree(vectors: np.ndarray, threshold: float, distance: Distance = cosine_distance) -> list[Joined | int]:
    """The clusters of ``complete_linkage`` with the joins that made them, from vectors.

    Joins of two clusters that are nearest to each other never hinder one another (a join brings
    no cluster nearer to a third, and equal distances are told apart by number), so all of a round are made
    at once. Distances are computed where they are asked for: the memory follows the items, the
    time their square. A cluster without a neighbour below ``threshold`` is done.
    """
    n = len(vectors)
    members, tree = {i: np.array([i]) for i in range(n)}, dict(enumerate(range(n)))
    near, far = np.full(n, -1), np.full(n, np.inf, np.float32)
    live = stale = list(range(n))
    while stale:
        near[stale], far[stale] = _nearest(vectors, members, stale, live, distance)
        done = {k for k in stale if not far[k] < threshold}
        live = [k for k in live if k not in done]
        if not live:
            break
        # by rounding alone one side may see a distance below the limit that the other does not
        stale = [k for k in live if near[k] in done]
        if stale:
            continue
        pairs = [(k, int(near[k])) for k in live if k < near[k] and near[near[k]] == k]
        if not pairs:
            k = min(live, key=lambda k: (far[k], min(k, near[k]), max(k, near[k])))
            pairs = [(min(k, int(near[k])), max(k, int(near[k])))]
        changed = {k for pair in pairs for k in pair}
        for i, j in pairs:
            members[i] = np.concatenate([members[i], members.pop(j)])
            tree[i] = Joined(far[i], len(members[i]), tree[i], tree.pop(j))
        live = [k for k in live if k in members]
        stale = [k for k in live if k in changed or near[k] in changed]
    return list(tree.values())


def split_tree(tree: list[Joined | int], most: int = 8, tight: float = 0.03) -> list[np.ndarray]:
    """The items of each cluster, after those of more than ``most`` were parted as in ``bisected``: the halves
    of a cluster are the two that were joined last, as the joins within a cluster follow from its own distances."""
    found, todo = [], list(tree)
    while todo:
        x = todo.pop()
        if not isinstance(x, Joined):
            found.append(np.array([x]))
        elif x.size <= most or x.height <= tight:
            found.append(np.sort(x.items()))
        else:
            todo += (x.left, x.right)
    return found


def medoid(vectors: np.ndarray, distance: Distance = cosine_distance) -> int:
    """The row of the least sum of distances, each to nine places; the first of equals."""
    if len(vectors) < 3:
        return 0
    step = max(1, CELLS // len(vectors))
    parts = (distance(vectors[i : i + step], vectors).astype(float) for i in range(0, len(vectors), step))
    return int(np.concatenate([np.rint(d * 1e9).astype(np.int64).sum(axis=1) for d in parts]).argmin())


def cluster_groups(
    rows: DataFrame, keys: list[str], item: str, vector: str, threshold: float, most: int = 8, tight: float = 0.03,
    cap: int | None = None, distance: Distance = cosine_distance,
) -> DataFrame:
    """Complete-linkage cluster and medoid flag of each item within its group.

    A group is clustered by one task: its memory follows the group's items, its time their square.
    Where a ``cap`` is given, a group of more items raises an error rather than giving part of an answer.
    The medoid has the least sum of distances, the first of equals.
    """
    kinds = {k: rows.schema[k].dataType.simpleString() for k in [*keys, item]}
    schema = ", ".join(f"`{k}` {v}" for k, v in kinds.items()) + f", cluster {kinds[item]}, is_medoid boolean"

    def run(group: pd.DataFrame) -> pd.DataFrame:
        if cap is not None and len(group) > cap:
            raise ValueError(f"a group of {len(group)} items is over the limit of {cap}")
        group = group.sort_values(item, kind="stable").reset_index(drop=True)
        x = np.array(group[vector].tolist(), float)
        labels, best = np.zeros(len(x), int), np.zeros(len(x), bool)
        for members in split_tree(complete_tree(x, threshold, distance), most, tight):
            labels[members] = members[0]
            best[members[medoid(x[members], distance)]] = True
        out = group[[*keys, item]].copy()
        out["cluster"] = group[item].to_numpy()[labels]
        out["is_medoid"] = best
        return out

    # by number, so groups are not put together by their few bytes
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.select(*keys, item, vector).repartition(parts, *keys).groupBy(*keys).applyInPandas(run, schema)


def medoids(pairs: DataFrame, keys: list[str]) -> DataFrame:
    """The item of least summed distance of each group, the first of equals; ``pairs`` has i < j and dist."""
    both = pairs.select(*keys, F.col("i").alias("item"), "dist").unionByName(pairs.select(*keys, F.col("j").alias("item"), "dist"))
    sums = both.groupBy(*keys, "item").agg(F.round(F.sum("dist"), 6).alias("total"))
    return sums.groupBy(*keys).agg(F.min_by("item", F.struct("total", "item")).alias("medoid"), F.min("total").alias("total"))


def vector_medoids(rows: DataFrame, keys: list[str], item: str, vector: str) -> DataFrame:
    """The item of least summed cosine distance of each group, the first of equals, and its sum.

    An item's cosines to all others of its group add up to one product with the sum of the
    group's unit vectors, so the cost is linear and no pairs are made. The vectors of a table
    have one dimension, read beforehand.
    """
    from .similarity import dot, unit_vectors

    unit = unit_vectors(rows.select(*keys, item, vector), vector)
    size = rows.agg(F.max(F.size(vector))).first()[0] or 0
    sums = unit.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.array(*[F.sum(F.get(vector, F.lit(i))) for i in range(size)]).alias("_sum"))
    away = F.col("_n") - 1 - (dot(F.col(vector), F.col("_sum")) - dot(F.col(vector), F.col(vector)))
    each = unit.join(sums, keys).select(*keys, F.col(item).alias("item"), F.round(away, 6).alias("total"))
    return each.groupBy(*keys).agg(F.min_by("item", F.struct("total", "item")).alias("medoid"), F.min("total").alias("total"))


def cohesion(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """1 less the greatest distance within each cluster, 1 for a single member."""
    m = members.select("item", "cluster")
    a, b = m.toDF("i", "ci"), m.toDF("j", "cj")
    far = pairs.join(a, "i").join(b, "j").where("ci = cj").groupBy(F.col("ci").alias("cluster")).agg(F.max("dist").alias("far"))
    return m.select("cluster").distinct().join(far, "cluster", "left").select("cluster", F.round(1 - F.coalesce("far", F.lit(0.0)), 4).alias("score"))


def distinct_ordered(values: Column, order: Column) -> Column:
    """Distinct values of an aggregation in the order of their first."""
    return F.array_distinct(F.transform(F.array_sort(F.collect_list(F.struct(order.alias("o"), values.alias("v")))), lambda x: x["v"]))
