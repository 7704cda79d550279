"""Benchmark decontamination with DataFrame operations only (operator 9).

A window is ten consecutive words of a benchmark text (all its words if it has
fewer). Every place of every document passes three bitmaps of the windows: their
first two words, their last two, and the whole window. The bitmaps' size follows the
number of windows, up to a bound, and they are literals of the plan, so the scan of
texts neither shuffles nor explodes; the few places left are exploded and joined with
the windows themselves, which are broadcast up to ``BROADCAST_BYTES`` and shuffled
beyond. Grouping by row then needs counts and places only, never texts.

The bitmaps compare words in lower case of all letters, which finds a superset;
the join compares words with A-Z alone in lower case, which is exact.

Defined results: null and empty texts have no words; a null item_id counts for
hits but is no item; repeated rows of documents each give a row, repeated items
count once; without benchmark windows nothing is hit; other columns, whatever
their names, are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

WINDOW = 10
#: Bits of a bitmap, at least and at most, and how many there are for each hash in between.
LEAST_BITS, MOST_BITS, SPARSE = 1 << 18, 1 << 22, 16
#: Bytes of the windows with their items, and rows of ids, that are broadcast at most.
BROADCAST_BYTES = 32 << 20
BROADCAST_IDS = 200_000

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LOWER = _UPPER.lower()
_BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same separators in text whose capitals still stand.
_RAW_BREAKS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _folded(text: Column) -> Column:
    """Words in lower case of all letters. The one letter whose lower case depends on
    its neighbours is replaced beforehand; no letter becomes a separator or the reverse."""
    lowered = F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit("Σ"), F.lit("σ")))
    return F.array_remove(F.split(lowered, _BREAKS), "")


def _exact(words: Column, at: Column, length: Column | int) -> Column:
    """A window of raw words with A-Z in lower case, joined by spaces."""
    return F.translate(F.array_join(F.slice(words, at + 1, length), " "), _UPPER, _LOWER)


def _raw(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), _RAW_BREAKS), "")


def _pair(words: Column, at: Column, single: bool) -> Column:
    return F.xxhash64(F.get(words, at)) if single else F.xxhash64(F.get(words, at), F.get(words, at + 1))


def _whole(words: Column, at: Column, length: Column | int) -> Column:
    return F.xxhash64(F.array_join(F.slice(words, at + 1, length), " "))


def benchmark_windows(benchmark: DataFrame) -> DataFrame:
    """Distinct (length, key, items) and the three hashes of each window."""
    words = benchmark.select(
        F.col("item_id").cast("string").alias("item"), _folded(F.col("text")).alias("w"), _raw(F.col("text")).alias("raw")
    ).where("size(w) > 0")
    places = words.select("item", "w", "raw", F.least(F.size("w"), F.lit(WINDOW)).alias("length")).select(
        "item", "w", "raw", "length", F.explode(F.sequence(F.lit(0), F.size("w") - F.col("length"))).alias("at")
    )
    w, at, length = F.col("w"), F.col("at"), F.col("length")
    first = F.when(length == 1, _pair(w, at, True)).otherwise(_pair(w, at, False))
    last = F.when(length == 1, _pair(w, at, True)).otherwise(_pair(w, at + length - 2, False))
    found = places.select(
        "item", "length", _exact(F.col("raw"), at, length).alias("key"),
        first.alias("first"), last.alias("last"), _whole(w, at, length).alias("whole"),
    )
    return found.groupBy("length", "key").agg(
        F.collect_set("item").alias("items"), *[F.collect_set(c).alias(c) for c in ("first", "last", "whole")]
    )


def _bits(n: int) -> int:
    """Bits of a bitmap of ``n`` hashes: a power of two, so that about one bit in ``SPARSE`` is set, within bounds."""
    return min(MOST_BITS, max(LEAST_BITS, 1 << (SPARSE * n - 1).bit_length()))


def _bitmaps(windows: DataFrame, sizes: dict[int, int]) -> dict[int, list[tuple[Column, int]]]:
    """The first, last and whole hashes of the windows of each length as literal arrays of longs, with their bits.

    All come of one job; no more than ``MOST_BITS`` / 64 rows a bitmap reach the driver.
    """
    if not sizes:
        return {}
    bits = F.create_map(*[F.lit(x) for n, count in sizes.items() for x in (n, _bits(count))])[F.col("length")]
    tagged = lambda c, kind: F.transform(c, lambda h: F.struct(F.lit(kind).alias("kind"), h.alias("h")))
    each = F.flatten(F.array(*[tagged(c, kind) for kind, c in enumerate(("first", "last", "whole"))]))
    rows = windows.select("length", bits.alias("bits"), F.explode(each).alias("x")).select("length", "x.kind", F.pmod(F.col("x.h"), F.col("bits")).alias("slot"))
    one = F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("slot") % 64).cast("int"))
    cells = rows.groupBy("length", "kind", (F.col("slot") / 64).cast("int").alias("cell")).agg(F.bit_or(one).alias("bits")).collect()
    filled: dict[tuple[int, int], dict[int, int]] = {}
    for r in cells:
        filled.setdefault((r.length, r.kind), {})[r.cell] = r.bits
    out = {}
    for n, count in sorted(sizes.items()):
        # the optimiser folds this into one array literal
        out[n] = [(F.expr("array(" + ",".join(f"{filled.get((n, k), {}).get(i, 0)}L" for i in range(_bits(count) // 64)) + ")"), _bits(count)) for k in range(3)]
    return out


def _has(bitmap: tuple[Column, int], hashed: Column) -> Column:
    cells, bits = bitmap
    slot = F.pmod(hashed, F.lit(bits))
    return F.getbit(F.get(cells, (slot / 64).cast("int")), (slot % 64).cast("int")) == 1


def occurrences(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row a document row and hit, and one for a row without hits.

    Columns: row_key, doc_id, n_words, at, length, items (the last three null without a hit).
    """
    windows = stored(benchmark_windows(benchmark), "benchmark-windows")
    items = F.aggregate("items", F.lit(0).cast("bigint"), lambda a, x: a + F.length(x) + 32)
    counted = windows.groupBy("length").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("key") + items + 128).alias("n_bytes")).collect()
    sizes = {r.length: r.n for r in counted}
    maps = _bitmaps(windows, sizes)
    # the text's words are made once a row: the columns that use them do so several times,
    # so the optimiser does not move the split into them
    split = docs.select(
        F.monotonically_increasing_id().alias("row_key"), "doc_id", "text", _folded(F.col("text")).alias("w")
    ).select("row_key", "doc_id", "text", "w", F.size("w").alias("n_words"))
    w, n = F.col("w"), F.col("n_words")

    def places(length: int) -> Column:
        first, last, whole = maps[length]
        single = length == 1

        def hit(i: Column) -> Column:
            ends = _has(first, _pair(w, i, single))
            if length > 2:
                ends = ends & _has(last, _pair(w, i + (length - 2), False))
            return ends & _has(whole, _whole(w, i, length))

        found = F.when(n >= length, F.filter(F.sequence(F.lit(0), n - length), hit)).otherwise(F.array().cast("array<int>"))
        return F.transform(found, lambda i: F.struct(i.alias("at"), F.lit(length).alias("length")))

    marked = split.select(
        "row_key", "doc_id", "text", n.cast("bigint").alias("n_words"),
        (F.concat(*map(places, maps)) if maps else F.lit(None).cast("array<struct<at:int,length:int>>")).alias("places"),
    )
    raw = marked.select(
        "row_key", "doc_id", "n_words", "places", F.when(F.size("places") > 0, _raw(F.col("text"))).alias("raw")
    )
    keyed = raw.select(
        "row_key", "doc_id", "n_words",
        F.when(
            F.size("raw") > 0,
            F.transform("places", lambda p: F.struct(p["at"].alias("at"), p["length"].alias("length"), _exact(F.col("raw"), p["at"], p["length"]).alias("key"))),
        ).alias("places"),
    )
    rows = keyed.select("row_key", "doc_id", "n_words", F.explode_outer("places").alias("p")).select(
        "row_key", "doc_id", "n_words", F.col("p.at").alias("at"), F.col("p.length").alias("length"), F.col("p.key").alias("key")
    )
    known = windows.select(F.col("length").alias("w_length"), F.col("key").alias("w_key"), "items")
    # letters may be of four bytes each
    known = F.broadcast(known) if 4 * sum(r.n_bytes for r in counted) <= BROADCAST_BYTES else known
    return rows.join(known, (rows.key == F.col("w_key")) & (rows.length == F.col("w_length")), "left").select(
        "row_key", "doc_id", "n_words", "at", "length", "items"
    )


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Hits of every document row, in the form of query op9."""
    hit = F.when(F.col("items").isNotNull(), F.struct("at", "length"))
    grouped = occurrences(docs, benchmark).groupBy("row_key", "doc_id", "n_words").agg(
        F.array_sort(F.collect_set(hit)).alias("hits"), F.array_distinct(F.flatten(F.collect_set("items"))).alias("items")
    )
    covered = F.aggregate(
        "hits",
        F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).alias("end")),
        lambda a, x: F.struct(
            (a["n"] + F.greatest(F.lit(0), x["at"] + x["length"] - F.greatest(a["end"], x["at"]))).alias("n"),
            F.greatest(a["end"], x["at"] + x["length"]).alias("end"),
        ),
        lambda a: a["n"],
    )
    return grouped.select(
        "doc_id", "n_words", covered.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ",").cast("binary"), 256).alias("items_sha256"), (F.size("hits") > 0).alias("contaminated"),
    )


def without_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not contaminated; columns stay as they are.

    A row's text decides, so rows are known by their doc_id and a digest of their text:
    clean rows with the doc_id of a contaminated one, or with none, stay.
    """
    digest = F.md5(F.col("text").cast("binary"))
    rows = docs.select(F.struct("doc_id", digest.alias("digest")).alias("doc_id"), "text")
    found = contamination(rows, benchmark).where("contaminated").select(F.col("doc_id.doc_id").alias("hit_id"), F.col("doc_id.digest").alias("hit_digest")).distinct()
    found = stored(found, "contaminated-ids")
    found = F.broadcast(found) if found.count() <= BROADCAST_IDS else found
    same = docs["doc_id"].eqNullSafe(found["hit_id"]) & (F.md5(docs["text"].cast("binary")) == found["hit_digest"])
    return docs.join(found, same, "left_anti")


def without_spans(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, text) of every row, the words that are hit left out and the others joined by spaces.

    Texts without a hit stay as they are, null included.
    """
    # rows of the same id and text are hit alike
    digest = F.md5(F.coalesce("text", F.lit("")).cast("binary"))
    keyed = docs.select(F.struct("doc_id", digest.alias("digest")).alias("doc_id"), "text")
    spans = occurrences(keyed, benchmark).where("items is not null").groupBy("doc_id").agg(
        F.array_distinct(F.flatten(F.collect_set(F.sequence("at", F.col("at") + F.col("length") - 1)))).alias("hit")
    )
    spans = spans.select(F.col("doc_id.doc_id").alias("hit_id"), F.col("doc_id.digest").alias("hit_digest"), "hit")
    own = docs.select("doc_id", "text", digest.alias("digest"))
    rows = own.join(spans, own["doc_id"].eqNullSafe(spans["hit_id"]) & (own["digest"] == spans["hit_digest"]), "left")
    raw = rows.select("doc_id", "text", "hit", F.when(F.size("hit") > 0, _raw(F.col("text"))).alias("raw"))
    rest = F.filter("raw", lambda x, i: ~F.array_contains("hit", i) & (F.size("raw") > 0))
    return raw.select("doc_id", F.when(F.size("raw") > 0, F.array_join(rest, " ")).otherwise(F.col("text")).alias("text"))


ORACLE_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rk, doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^0-9a-z\x{80}-\x{10FFFF}]+'), lambda x: x <> '') AS w
  FROM documents),
b AS (
  SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^0-9a-z\x{80}-\x{10FFFF}]+'), lambda x: x <> '') AS w
  FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, l, array_to_string(w[i + 1:i + l], ' ') AS k
  FROM (SELECT item_id, w, least(len(w), 10) AS l, unnest(range(0, greatest(len(w) - 9, 1))) AS i FROM b WHERE len(w) > 0)),
ls AS (SELECT DISTINCT l FROM bw),
dw AS (
  SELECT rk, i, l, array_to_string(w[i + 1:i + l], ' ') AS k
  FROM (SELECT rk, w, l, unnest(range(0, len(w) - l + 1)) AS i FROM d, ls WHERE len(w) >= l)),
h AS (SELECT dw.rk, dw.i, dw.l, bw.item_id FROM dw JOIN bw ON dw.k = bw.k AND dw.l = bw.l),
hw AS (SELECT rk, count(DISTINCT p) AS n_hit FROM (SELECT rk, unnest(range(i, i + l)) AS p FROM h) GROUP BY rk),
hi AS (
  SELECT rk, count(DISTINCT item_id) AS n_items, array_to_string(list_sort(list(DISTINCT CAST(item_id AS VARCHAR))), ',') AS ids
  FROM h GROUP BY rk)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hw ON d.rk = hw.rk LEFT JOIN hi ON d.rk = hi.rk
"""
