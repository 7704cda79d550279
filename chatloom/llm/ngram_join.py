"""Exact Jaccard join of word 5-gram sets by universe partitioning (operator 1).

Sets of equal content are first folded into one. For each band of set sizes the
universe of shingles is cut by hash into segments, more of them than two linked
sets of the band can differ in. By the pigeonhole principle two linked sets then
agree in a segment; where a set leaves segments empty, a one-deletion
neighbourhood of others makes up for them: a segment that may differ by one
element counts for two. A set's signatures are its non-empty segments, and for
some segments the segment less each one of its elements as well.

Signatures travel as compressed blocks, one for each run of texts and part, not as
rows. Sets that share a signature form a bucket. Small buckets give their pairs;
larger ones first only pairs with their least member. These are verified exactly, on
the words themselves, and joined to components. In buckets that still span components,
cost-based allocation decides which units of a set are kept: the fullest buckets go, as
far as its spare segments reach, and a segment with deletions counts for two. Sets in
what remains are searched again, over the universe without the shingles that unlinked
pairs were found to share (passages that many texts have); the pairs between components
that this gives are verified too. So no link between different components is left
out, and no pair within one is made. Sets of which too little is left meet on
prefixes of their shingles instead, and a parity bitmap tells most unlike ones apart.

Defined results: null and empty texts have no shingles and stand alone; fewer
than five words are one shingle; rows with a null doc_id stand alone with a null
component; rows that share a doc_id are one node of the graph, linked with what any of
them is linked with; ties have no bearing, as components are named by their least
doc_id; texts of any length are taken whole, one beyond a run's size as a run of its
own; an empty table gives no rows; only doc_id and text are read.
"""

from __future__ import annotations

import struct
from collections.abc import Iterable, Iterator
from functools import cache, reduce

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bound_batches, map_arrow, releasing, stored
from .words import mix, shingle_sets

WORDS = 5
#: Buckets of up to this many sets give all their pairs.
SMALL = 4
#: Bands of sets up to this size have twice the segments that they need, others an eighth more.
SMALL_SETS = 200
#: Members verified against one copy of their partner's text.
SALT_ROWS = 200
#: Shingles that this many unlinked pairs share are left out of the second search; at most so many.
COMMON_PAIRS = 8
COMMON_SHINGLES = 500_000
#: Signatures of one part, which a task holds at once, and those that a mapper gathers before it writes them.
PART_SHINGLES = 1_000_000
FLUSH_SIGNATURES, FLUSH_TEXTS = 800_000, 30_000
#: Words of 64 bits in the parity bitmap of a set.
BITMAP = 8


def shingles(text: str | None) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct word 5-grams of a whole text."""
    return next(shingle_sets(pa.array([text], pa.string()), WORDS))


def windows(text: str) -> set[tuple[bytes, ...]]:
    """The distinct word 5-grams of a whole text themselves."""
    words = text.encode().lower().split()
    return set(zip(*(words[k:] for k in range(WORDS)), strict=False)) if len(words) > WORDS else {tuple(words)}


def linked(a: set, b: set) -> bool:
    """Whether two sets of windows are at least 80 % alike."""
    both = len(a & b)
    return both > 0 and 100 * both >= 80 * (len(a) + len(b) - both)


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    if not len(a) or not len(b):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= 80 * (len(a) + len(b) - both)


# -- bands ---------------------------------------------------------------
@cache
def band_top(k: int) -> int:
    """Largest set size of band ``k``."""
    top = 1
    for _ in range(k):
        top = max(top + 1, top * 3 // 2)
    return top


@cache
def plan(k: int) -> tuple[int, int]:
    """Segments of band ``k``, and how many of them have deletion neighbourhoods."""
    top = band_top(k)
    most = needed(top * 5 // 4, k)
    # small sets may share a passage over most of their length: they get more to spare
    segments = 2 * most if top <= SMALL_SETS else most + 1 + most // 8
    return segments, segments if segments <= 16 else 2 + segments // 32


def needed(size: int, k: int) -> int:
    """Units that a set needs against partners of at most its size in band ``k``.

    Linked sets of l and s elements differ in at most (l + s) / 9 of them.
    """
    return (size + min(size, band_top(k))) // 9 + 1


def bands(size: int) -> list[int]:
    """The bands a set takes part in: its own, and the one below while partners may be there."""
    k = 0
    while band_top(k) < size:
        k += 1
    below = k > 0 and band_top(k - 1) * 5 // 4 >= size
    return [k, k - 1] if below else [k]


def signatures(s: np.ndarray, k: int, size: int | None = None) -> tuple[np.ndarray, np.ndarray, int]:
    """Signatures of (part of) a set of ``size`` elements in band ``k``, the number from 1 of their segment if that has deletions (else 0), and spare units."""
    segments, deletable = plan(k)
    if not len(s):
        return s, np.zeros(0, np.uint16), -needed(size or 0, k)
    where = (s >> np.uint64(32)) * np.uint64(segments) >> np.uint64(32)
    order = np.argsort(where, kind="stable")
    seg, own = where[order], s[order]
    first = np.flatnonzero(np.concatenate([[True], seg[1:] != seg[:-1]]))
    counts = np.diff(np.append(first, len(seg)))
    sums, ids = np.add.reduceat(own, first), seg[first]
    wide = (ids < deletable) & (counts > 1)
    # each segment's sum less one of its elements
    part = np.repeat(wide, counts)
    less = np.repeat(sums, counts)[part] - own[part]
    label = mix(np.concatenate([ids, seg[part]]) + np.uint64(k << 32) + np.uint64(1))
    sigs = mix(np.concatenate([sums, less]) ^ label)
    numbers = np.concatenate([np.where(wide, ids + np.uint64(1), 0), seg[part] + np.uint64(1)]).astype(np.uint16)
    return sigs, numbers, len(ids) + int(wide.sum()) - needed(size or len(s), k)


# -- blocks of signatures ------------------------------------------------
_HEAD = struct.Struct("<II")


def _pack(sigs: np.ndarray, who: np.ndarray, seg: np.ndarray, docs: np.ndarray, sizes: np.ndarray, spare: np.ndarray) -> bytes:
    """Sorted signatures as differences in byte planes, whose they are, and the documents named."""
    order = np.argsort(sigs, kind="stable")
    sigs, who, seg = sigs[order], who[order], seg[order]
    used, own = np.unique(who & np.uint16(0x7FFF), return_inverse=True)
    who = own.astype(np.uint16) | (who & np.uint16(0x8000))
    steps = np.diff(sigs, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T
    body = b"".join(np.ascontiguousarray(x).tobytes() for x in (steps, who, seg, docs[used], sizes[used], spare[:, used]))
    return _HEAD.pack(len(sigs), len(used)) + zstandard.ZstdCompressor(level=1).compress(body)


def _unpack(data: bytes) -> tuple[np.ndarray, ...]:
    n, d = _HEAD.unpack_from(data)
    raw = zstandard.ZstdDecompressor().decompress(data[_HEAD.size :])
    planes = np.frombuffer(raw, np.uint8, 8 * n).reshape(8, n)
    sigs = np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).reshape(-1), dtype=np.uint64)
    at = 8 * n
    who = np.frombuffer(raw, np.uint16, n, at)
    seg = np.frombuffer(raw, np.uint16, n, at + 2 * n)
    at += 4 * n
    docs = np.frombuffer(raw, np.int64, d, at)
    sizes = np.frombuffer(raw, np.uint32, d, at + 8 * d)
    spare = np.frombuffer(raw, np.int16, 2 * d, at + 12 * d).reshape(2, d)
    own = who & np.uint16(0x7FFF)
    below = (who >> np.uint16(15)).astype(np.int64)
    return sigs, docs[own], sizes[own], spare[below, own], seg, below


def _rare(s: np.ndarray, common: np.ndarray) -> np.ndarray:
    """A set without the elements of the sorted array ``common``."""
    if not len(common) or not len(s):
        return s
    at = np.minimum(np.searchsorted(common, s), len(common) - 1)
    return s[common[at] != s]


def _signature_blocks(docs: DataFrame, parts: int, common: np.ndarray | None = None) -> DataFrame:
    """(part, block): the signatures of a batch of documents that belong to a part.

    Shingles in ``common`` are left out of every set alike: linked sets differ in no
    more of the others, so the pigeonhole holds for these. Parts below 0 list documents
    whose units do not suffice. A mapper gathers many texts before it writes a block for
    each part, so blocks stay long where there are many parts.
    """
    common = np.zeros(0, np.uint64) if common is None else common

    def blocks(ids: list[int], sizes: list[int], spare: list[tuple[int, int]], found: list[tuple]) -> pa.RecordBatch:
        out_part, out_block = [], []
        short = sorted({i for i, units in zip(ids, spare, strict=True) if min(units) < 0})
        if found:
            sig, seg, owner = (np.concatenate(x) for x in zip(*found, strict=True))
            docs_, sizes_, spare_ = np.array(ids, np.int64), np.array(sizes, np.uint32), np.array(spare, np.int16).T.copy()
            part = (sig >> np.uint64(40)) % np.uint64(parts)
            order = np.argsort(part, kind="stable")
            sig, owner, seg, part = sig[order], owner[order], seg[order], part[order]
            edges = np.append(np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])), len(part))
            for x, y in zip(edges[:-1], edges[1:], strict=True):
                out_part.append(int(part[x]))
                out_block.append(_pack(sig[x:y], owner[x:y], seg[x:y], docs_, sizes_, spare_))
        if short:
            out_part.append(-1 - short[0] % parts)
            out_block.append(np.array(short, np.int64).tobytes())
        return pa.RecordBatch.from_pydict({"part": pa.array(out_part, pa.int64()), "block": pa.array(out_block, pa.binary())})

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, sizes, spare, found, held = [], [], [], [], 0
        for batch in batches:
            for key, s in zip(batch.column(0).to_pylist(), shingle_sets(batch.column(1), WORDS), strict=True):
                size, units = len(s), [0, 0]
                s = _rare(s, common)
                # up to three shingles, linked sets are equal; four lie within five at 80 %
                for side, k in enumerate(bands(size) if size > 3 else ()):
                    sigs, numbers, units[side] = signatures(s, k, size)
                    units[side] = min(units[side], 30_000)
                    found.append((sigs, numbers, np.full(len(sigs), len(ids) | side << 15, np.uint16)))
                    held += len(sigs)
                ids.append(key)
                sizes.append(size)
                spare.append(tuple(units))
                if held >= FLUSH_SIGNATURES or len(ids) >= FLUSH_TEXTS:
                    yield blocks(ids, sizes, spare, found)
                    ids, sizes, spare, found, held = [], [], [], [], 0
        yield blocks(ids, sizes, spare, found)

    return docs.select("doc_id", "text").mapInArrow(releasing(run), "part bigint, block binary")


BUCKETS = "kind int, a bigint, b bigint, size int, spare int, seg int, units int, n bigint"


def _buckets(blocks: DataFrame, parts: int) -> DataFrame:
    """Pairs (kind 0: a, b), members of large buckets (kind 1: bucket a, document b) and
    documents without enough units (kind 2)."""

    def close(held: list[bytes]) -> Iterator[pa.RecordBatch]:
        cols = [np.concatenate(c) for c in zip(*map(_unpack, held), strict=True)]
        order = np.lexsort((cols[1], cols[0]))
        sig, doc, size, spare, seg, below = (c[order] for c in cols)
        first = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]]))
        counts = np.diff(np.append(first, len(sig)))
        pairs = [np.zeros((0, 2), np.int64)]
        near = lambda x, y: (doc[x] != doc[y]) & (100 * np.minimum(size[x], size[y]).astype(np.int64) >= 80 * np.maximum(size[x], size[y]).astype(np.int64))
        for n in range(2, SMALL + 1):
            at = first[counts == n]
            for i in range(n):
                for j in range(i + 1, n):
                    ok = near(at + i, at + j)
                    pairs.append(np.stack([doc[at + i][ok], doc[at + j][ok]], 1))
        large = counts > SMALL
        # buckets of the same members in the same way are kept once, with the number of units they stand for
        of = np.repeat(np.arange(len(first)), counts)
        marks = mix(doc.view(np.uint64) * np.uint64(4) + below.view(np.uint64) * np.uint64(2) + np.uint64(1))
        print_ = np.add.reduceat(marks, first) if len(first) else marks
        numbered = np.add.reduceat((seg > 0).astype(np.int64), first) if len(first) else counts
        # those with a segment that has deletions stay, as all its rows go or stay together
        alone = np.where(numbered > 0, np.arange(len(first)) + 1, 0)
        keys = np.stack([print_.view(np.int64), counts, alone], 1)[large]
        _, chosen, units = np.unique(keys, axis=0, return_index=True, return_counts=True)
        keep = np.zeros(len(first), np.int64)
        keep[np.flatnonzero(large)[chosen]] = units
        in_large = np.flatnonzero(keep[of] > 0)
        pivot = first[of[in_large]]
        ok = near(pivot, in_large)
        pairs.append(np.stack([doc[pivot][ok], doc[in_large][ok]], 1))
        pair = np.unique(np.concatenate(pairs), axis=0)
        rows = {
            "kind": (np.zeros(len(pair), np.int32), np.ones(len(in_large), np.int32)),
            "a": (pair[:, 0], sig.view(np.int64)[in_large]), "b": (pair[:, 1], doc[in_large]),
            "size": (np.zeros(len(pair), np.int32), counts[of[in_large]].astype(np.int32)),
            "spare": (np.zeros(len(pair), np.int32), (spare[in_large].astype(np.int32) * 2 + below[in_large].astype(np.int32))),
            "seg": (np.zeros(len(pair), np.int32), seg[in_large].astype(np.int32)),
            "units": (np.zeros(len(pair), np.int32), keep[of[in_large]].astype(np.int32)),
            "n": (np.zeros(len(pair), np.int64), size[in_large].astype(np.int64)),
        }
        whole = pa.RecordBatch.from_pydict({k: pa.array(np.concatenate(v)) for k, v in rows.items()})
        for a in range(0, whole.num_rows, 100_000):
            yield whole.slice(a, 100_000)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []
        for batch in batches:
            for part, block in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if part < 0:
                    ids = np.frombuffer(block.as_py(), np.int64)
                    zero = np.zeros(len(ids), np.int32)
                    yield pa.RecordBatch.from_pydict(
                        {"kind": zero + 2, "a": ids, "b": ids, "size": zero, "spare": zero, "seg": zero, "units": zero, "n": ids * 0}
                    )
                    continue
                if part != at and held:
                    yield from close(held)
                    held = []
                at = part
                held.append(block.as_py())
        if held:
            yield from close(held)

    # a task closes its parts one after another, so more parts than tasks take no more memory
    tasks = min(parts, max(8, int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    dealt = blocks.repartitionById(tasks, F.pmod("part", F.lit(tasks)).cast("int"))
    return dealt.sortWithinPartitions("part").mapInArrow(releasing(run), BUCKETS)


# -- verification and components -----------------------------------------
def _verified(pairs: DataFrame, docs: DataFrame, label: str = "verified") -> tuple[DataFrame, DataFrame]:
    """The distinct pairs (a, b) whose sets are linked; and (shingle, n), how many of the
    other pairs have a shingle in common, counted by task.

    Members ``b`` bring their text to a copy of the text of ``a``; an ``a`` with
    many members has several copies, each for a share of them.
    """
    pairs = stored(pairs.select("a", "b").distinct(), "pairs")
    copies = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / SALT_ROWS).cast("int").alias("copies"))
    # null: one copy, which most have
    many = stored(copies.where("copies > 1").select(F.col("a").alias("many_a"), "copies"), "copies")
    text = docs.select(F.col("doc_id").alias("id"), "text")
    salted = pairs.join(many, pairs["a"] == many["many_a"], "left").select(
        "a", "b", F.coalesce(F.pmod(F.xxhash64("b"), F.col("copies")), F.lit(0)).cast("int").alias("salt")
    )
    members = salted.join(text, salted["b"] == text["id"]).select("a", "salt", "b", "text")
    pivots = copies.join(text, copies["a"] == text["id"]).select(
        "a", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("salt"), F.lit(None).cast("bigint").alias("b"), "text"
    )
    rows = pivots.unionByName(members).repartition("a", "salt").sortWithinPartitions("a", "salt", F.asc_nulls_first("b"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, pivot, pivot_text, pivot_words = None, np.zeros(0, np.uint64), "", None
        shared: list[np.ndarray] = []
        held = 0

        def counted() -> pa.RecordBatch:
            value, n = np.unique(np.concatenate([*shared, np.zeros(0, np.uint64)]), return_counts=True)
            value, n = value[n > 1], n[n > 1]
            return pa.RecordBatch.from_pydict({"kind": np.ones(len(n), np.int32), "a": value.view(np.int64), "b": n})

        for batch in batches:
            out_a, out_b = [], []
            for a, b, text, own in zip(*(batch.column(i).to_pylist() for i in range(3)), shingle_sets(batch.column(2), WORDS), strict=True):
                if b is None:
                    at, pivot, pivot_text, pivot_words = a, own, text, None
                elif a == at:
                    both = np.intersect1d(pivot, own, assume_unique=True)
                    if len(both) and 100 * len(both) >= 80 * (len(pivot) + len(own) - len(both)):
                        # hashes are linked: the words themselves decide
                        pivot_words = pivot_words or windows(pivot_text)
                        if linked(pivot_words, windows(text)):
                            out_a.append(a)
                            out_b.append(b)
                    else:
                        shared.append(both)
                        held += len(both)
            yield pa.RecordBatch.from_pydict({"kind": np.zeros(len(out_a), np.int32), "a": pa.array(out_a, pa.int64()), "b": pa.array(out_b, pa.int64())})
            if held > 1_000_000:
                yield counted()
                shared, held = [], 0
        yield counted()

    found = stored(rows.select("a", "b", "text").mapInArrow(releasing(run), "kind int, a bigint, b bigint"), label)
    return found.where("kind = 0").select("a", "b"), found.where("kind = 1").select(F.col("a").alias("shingle"), F.col("b").alias("n"))


def components(links: DataFrame) -> DataFrame:
    """(node, component): the least node that each node of a link reaches.

    Alternates large-star and small-star steps until nothing changes, however many
    that takes; only counts and sums reach the driver.
    """
    edges = stored(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct(), "links")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("low")).select(F.col("a").alias("node"), "low")
        large = both.where("b > a").join(low, F.col("a") == F.col("node")).select(F.col("low").alias("a"), "b").where("a < b").distinct()
        low = large.groupBy("b").agg(F.min("a").alias("low")).select(F.col("b").alias("node"), "low")
        small = large.join(low, F.col("b") == F.col("node"))
        edges = stored(
            small.select(F.col("low").alias("a"), F.explode(F.array("a", "b")).alias("b")).where("a < b").distinct(), "links"
        )
        row = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if before == (row.n, row.h):
            break
        before = (row.n, row.h)
    return edges.groupBy("b").agg(F.min("a").alias("component")).select(F.col("b").alias("node"), "component")


def _open_rows(members: DataFrame, found: DataFrame) -> DataFrame:
    """Members of large buckets that span components, and whether allocation keeps them."""
    label = F.coalesce("component", F.col("b"))
    labelled = members.join(found, members["b"] == found["node"], "left").select(
        F.col("a").alias("bucket"), "size", "spare", "seg", "units", "n", F.col("b").alias("doc"), label.alias("label")
    )
    spans = labelled.groupBy("bucket", "size").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high")
    spans = spans.select(F.col("bucket").alias("open"), F.col("size").alias("open_size"))
    rows = labelled.join(spans, (F.col("bucket") == F.col("open")) & (F.col("size") == F.col("open_size")))
    # the fullest buckets of a set in a band go first, as far as its spare units reach; the
    # buckets of a segment with deletions go together and cost two
    item = F.when(F.col("seg") > 0, F.col("seg").cast("bigint")).otherwise(F.xxhash64("bucket"))
    rows = rows.withColumns({"item": item, "cost": F.when(F.col("seg") > 0, 2).otherwise(F.col("units"))})
    whole = Window.partitionBy("doc", "spare", "item")
    order = Window.partitionBy("doc", "spare").orderBy(F.desc("most"), "item", "bucket").rowsBetween(Window.unboundedPreceding, 0)
    first = F.row_number().over(whole.orderBy("bucket")) == 1
    rows = rows.withColumns({"most": F.max("size").over(whole), "due": F.when(first, F.col("cost")).otherwise(0)})
    rows = rows.withColumn("spent", F.sum("due").over(order))
    rows = rows.withColumn("kept", F.max("spent").over(whole) > F.shiftright("spare", 1))
    return stored(rows.select("bucket", "size", "doc", "label", "n", "kept"), "open-buckets")


def _open_docs(rows: DataFrame) -> DataFrame:
    """Documents in an open bucket that some member keeps."""
    live = rows.where("kept").select("bucket", "size").distinct()
    return rows.join(live, ["bucket", "size"], "left_semi").select(F.col("doc").alias("open_id")).distinct()


def _open_pairs(rows: DataFrame) -> DataFrame:
    """Pairs between components in open buckets."""
    x, y = rows.alias("x"), rows.alias("y")
    # the larger set's allocation decides
    cond = (
        (F.col("x.bucket") == F.col("y.bucket")) & (F.col("x.size") == F.col("y.size")) & (F.col("x.label") != F.col("y.label"))
        & F.col("x.kept") & ((F.col("x.n") > F.col("y.n")) | ((F.col("x.n") == F.col("y.n")) & (F.col("x.doc") != F.col("y.doc"))))
        & (100 * F.col("y.n") >= 80 * F.col("x.n"))
    )
    return x.join(y, cond).select(F.least("x.doc", "y.doc").alias("a"), F.greatest("x.doc", "y.doc").alias("b")).distinct()


def _between(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """The pairs whose ends lie in different components."""
    left, right = found.toDF("na", "ca"), found.toDF("nb", "cb")
    rows = pairs.select("a", "b").distinct().join(left, F.col("a") == F.col("na"), "left").join(right, F.col("b") == F.col("nb"), "left")
    return rows.where(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b")


def parity(s: np.ndarray) -> np.ndarray:
    """The parity bitmap of a set: two bitmaps differ in no more bits than their sets in elements."""
    bits = np.bincount((s & np.uint64(64 * BITMAP - 1)).astype(np.int64), minlength=64 * BITMAP) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


def _short_pairs(docs: DataFrame, short: DataFrame, common: np.ndarray, found: DataFrame | None = None) -> DataFrame:
    """Partners in other components of sets without enough units, which are of a set's size
    or a neighbouring one.

    Two linked sets share at least four fifths of the larger one. What common shingles
    can't make up they share of the others, so the least one that they share
    lies in a prefix of these in both; or both are common shingles for four fifths, and the
    least shared one lies in a prefix of all. Of the sets that meet so, those whose parity
    bitmaps differ in more bits than linked sets have different elements are no pair.
    """
    band = lambda n: int(np.log(n) / np.log(1.25))
    bits = [f"bits{i}" for i in range(BITMAP)]

    def tokens(probe: bool):
        def step(ids: pa.Array, labels: pa.Array, texts: pa.Array) -> Iterator[dict[str, object]]:
            rows, own_tokens, maps = [], [], []
            for key, label, s in zip(ids.to_pylist(), labels.to_pylist(), shingle_sets(texts, WORDS), strict=True):
                if not len(s):
                    continue
                rare = _rare(s, common)
                need, at = -(-4 * len(s) // 5), band(len(s))
                mostly = len(s) - len(rare) >= need
                sides = [(0, rare[: len(rare) - max(need - len(s) + len(rare), 1) + 1])]
                if mostly:
                    sides.append((1, s[: len(s) - need + 1]))
                map_ = parity(s)
                for near in (at - 1, at, at + 1) if probe else (at,):
                    for kind, own in sides:
                        rows.append((key, label, len(s), len(s) - len(rare), near, kind))
                        own_tokens.append(own.view(np.int64))
                        maps.append(map_)
            if rows:
                times = [len(x) for x in own_tokens]
                out = dict(zip(("id", "label", "n", "shared", "band", "mostly"), np.repeat(np.array(rows, np.int64), times, 0).T, strict=True))
                yield out | {"token": np.concatenate(own_tokens)} | dict(zip(bits, np.repeat(np.stack(maps), times, 0).T, strict=True))

        return step

    if found is None:
        docs = docs.select("doc_id", "text", F.col("doc_id").alias("label"))
    else:
        docs = docs.join(found, docs["doc_id"] == found["node"], "left").select("doc_id", "text", F.coalesce("component", "doc_id").alias("label"))
    names = ["id", "label", "n", "shared", "band", "mostly", "token", *bits]
    schema = ", ".join(f"{x} bigint" for x in names)
    probes = docs.join(short, docs["doc_id"] == short["a"], "left_semi")
    probe = map_arrow(probes, ["doc_id", "label", "text"], schema, tokens(True)).toDF(*(f"p{x}" for x in names))
    every = map_arrow(docs, ["doc_id", "label", "text"], schema, tokens(False))
    # without an uncommon shingle in common, two sets share no more than their common ones
    total = F.col("pn") + F.col("n")
    enough = (F.col("mostly") == 0) | (9 * F.least("pshared", "shared") >= 4 * total)
    near = 9 * reduce(lambda x, y: x + y, [F.bit_count(F.col(b).bitwiseXOR(F.col(f"p{b}"))) for b in bits]) <= total
    same = (F.col("pband") == F.col("band")) & (F.col("pmostly") == F.col("mostly")) & (F.col("ptoken") == F.col("token"))
    met = probe.join(every, same & enough & near & (F.col("plabel") != F.col("label")))
    return met.select(F.least("pid", "id").alias("a"), F.greatest("pid", "id").alias("b")).distinct()


def _sets(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and two 64-bit sums over the shingles of every row, stored."""

    def step(ids: pa.Array, texts: pa.Array) -> Iterator[dict[str, object]]:
        sets = list(shingle_sets(texts, WORDS))
        total = lambda s: int(s.sum(dtype=np.uint64).view(np.int64)) if len(s) else 0
        yield {"doc_id": ids, "n_shingles": [len(s) for s in sets], "p": [total(s) for s in sets], "q": [total(mix(s)) for s in sets]}

    return stored(map_arrow(docs, ["doc_id", "text"], "doc_id bigint, n_shingles bigint, p bigint, q bigint", step), "sets")


def _keyed(docs: DataFrame) -> DataFrame:
    """(key, row): the rows of ``docs`` that have a doc_id, with a key of their own in order of
    doc_id and text; written, so that a row has the same key whenever it is read."""
    ordered = docs.where("doc_id is not null").select(F.struct(*docs.columns).alias("row")).orderBy("row.doc_id", "row.text")
    return stored(ordered.select(F.monotonically_increasing_id().alias("key"), "row"), "keyed-rows")


def _repeats(ids: DataFrame) -> bool:
    """Whether a doc_id is that of more than one row."""
    return bool(ids.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").limit(1).count())


def join_components(docs: DataFrame, parts: int | None = None) -> DataFrame:
    """doc_id, n_shingles and component_id of every row of ``docs``."""
    docs = docs.select("doc_id", "text")
    bound_batches(docs.sparkSession)
    sets = _sets(docs)
    if not _repeats(sets):
        return _components_of(docs, sets, parts)
    # rows that share a doc_id are nodes of their own, each linked with the first of them
    rows = _keyed(docs)
    keys = rows.select("key", F.col("row.doc_id").alias("doc_id"))
    firsts = keys.groupBy("doc_id").agg(F.min("key").alias("b"))
    same = stored(keys.join(firsts, "doc_id").where("key > b").select(F.col("key").alias("a"), "b"), "same-id")
    texts = rows.select(F.col("key").alias("doc_id"), "row.text")
    found = _components_of(texts, _sets(texts), parts, same).toDF("key", "n_shingles", "low")
    named = found.join(keys, "key").join(keys.toDF("low", "component_id"), "low")
    alone = sets.where("doc_id is null").select("doc_id", "n_shingles", F.lit(None).cast("bigint").alias("component_id"))
    return named.select("doc_id", "n_shingles", "component_id").unionByName(alone)


def _components_of(docs: DataFrame, sets: DataFrame, parts: int | None = None, given: DataFrame | None = None) -> DataFrame:
    """As ``join_components`` for rows whose doc_ids differ; ``given`` are links (a, b) that hold in any case."""
    spark = docs.sparkSession
    some = sets.where("n_shingles > 0 and doc_id is not null")
    folded = stored(some.groupBy("n_shingles", "p", "q").agg(F.min("doc_id").alias("least")), "folded")
    if parts is None:
        shingles_ = folded.agg(F.sum("n_shingles")).first()[0] or 0
        parts = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")), shingles_ // PART_SHINGLES)
    # texts are read again, one of each set; they move once, hashed on the side of the ids
    firsts = folded.where("n_shingles > 3").select("least")
    texts = docs.join(firsts.hint("shuffle_hash"), docs["doc_id"] == firsts["least"], "left_semi")
    found = stored(_buckets(_signature_blocks(texts, parts), parts), "buckets")
    short = found.where("kind = 2").select("a").distinct()
    pairs = found.where("kind = 0").select("a", "b")
    if short.limit(1).count():
        pairs = pairs.unionByName(_short_pairs(texts, short, np.zeros(0, np.uint64)))
    links, shared = _verified(pairs, docs)
    if given is not None:
        own = sets.join(folded, ["n_shingles", "p", "q"]).select(F.col("doc_id").alias("id"), "least")
        ends = [own.select(F.col("id").alias(f"id_{x}"), F.col("least").alias(f"least_{x}")) for x in "ab"]
        given = given.join(ends[0], F.col("a") == F.col("id_a"), "left").join(ends[1], F.col("b") == F.col("id_b"), "left")
        links = links.unionByName(given.select(F.coalesce("least_a", "a").alias("a"), F.coalesce("least_b", "b").alias("b")))
    reached = stored(components(links), "components")
    rows = _open_rows(found.where("kind = 1"), reached)
    opened = stored(_open_docs(rows), "open-documents")
    if opened.limit(1).count():
        # the sets left are searched again, without the shingles that unlinked sets share
        top = shared.groupBy("shingle").agg(F.sum("n").alias("n")).where(F.col("n") >= COMMON_PAIRS).orderBy(F.desc("n"), "shingle").limit(COMMON_SHINGLES)
        common = np.sort(np.array([r.shingle for r in top.collect()], np.int64).view(np.uint64))
        left = docs.join(opened.hint("shuffle_hash"), docs["doc_id"] == opened["open_id"], "left_semi")
        left = stored(left, "open-texts")
        again = stored(_buckets(_signature_blocks(left, parts, common), parts), "buckets")
        short = again.where("kind = 2").select("a").distinct()
        pairs = again.where("kind = 0").select("a", "b").unionByName(_open_pairs(_open_rows(again.where("kind = 1"), reached)))
        if short.limit(1).count():
            pairs = pairs.unionByName(_short_pairs(left, short, common, reached))
        more, _ = _verified(_between(pairs, reached), docs)
        reached = components(links.unionByName(more))
    reached = stored(reached, "components")
    keyed = sets.join(
        folded.select(F.col("n_shingles").alias("n2"), F.col("p").alias("p2"), F.col("q").alias("q2"), "least"),
        (F.col("n_shingles") == F.col("n2")) & (F.col("p") == F.col("p2")) & (F.col("q") == F.col("q2")) & F.col("doc_id").isNotNull(), "left",
    )
    own = F.coalesce("least", "doc_id")
    return keyed.withColumn("own", own).join(reached, F.col("own") == F.col("node"), "left").select(
        "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "own")).alias("component_id")
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stand for their component: those of its least doc_id.

    Rows with a null doc_id stay. Where a doc_id is repeated, rows are joined by a key of
    their own, in order of doc_id and text, so unlike rows that share a doc_id both stay.
    """
    if _repeats(docs.select("doc_id")):
        rows, id_ = _keyed(docs), "key"
        found = join_components(rows.select(F.col("key").alias("doc_id"), "row.text"))
    else:
        rows, id_ = docs, "doc_id"
        found = join_components(docs)
    first = stored(found.where("doc_id = component_id").select(F.col("doc_id").alias("first")), "firsts").hint("shuffle_hash")
    kept = rows.join(first, rows[id_] == first["first"], "left_semi")
    return (kept if id_ == "doc_id" else kept.select("row.*")).unionByName(docs.where("doc_id is null"))


ORACLE_SQL = r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS rk, doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (
  SELECT DISTINCT rk, doc_id, array_to_string(w[i + 1:i + 5], ' ') AS g
  FROM (SELECT rk, doc_id, w, unnest(range(0, greatest(len(w) - 4, 1))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT rk, doc_id, count(*) AS n FROM s GROUP BY ALL),
p AS (
  SELECT x.rk AS a, y.rk AS b, count(*) AS shared FROM s x JOIN s y ON x.g = y.g AND x.rk < y.rk GROUP BY ALL),
l AS (
  SELECT m.doc_id AS a, o.doc_id AS b FROM p JOIN n m ON m.rk = p.a JOIN n o ON o.rk = p.b
  WHERE 100 * shared >= 80 * (m.n + o.n - shared)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r(doc_id, c) AS (SELECT doc_id, doc_id FROM d UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.doc_id WHERE r.c < e.b),
c AS (SELECT doc_id, min(c) AS component_id FROM r GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, c.component_id
FROM d LEFT JOIN n ON n.rk = d.rk LEFT JOIN c ON c.doc_id = d.doc_id
"""
