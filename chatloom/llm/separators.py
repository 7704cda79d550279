"""Token counts by a separator scan over flat, unindexed token files (operator 6).

A flat file is nothing but little-endian ids of a fixed width, each document closed by
the end-of-document id. Files are cut into blocks of a fixed number of ids, which are
dealt over all tasks, many of one file too. A first pass finds each block's separators
with one vectorised comparison and keeps only a summary: how many, and where the last
one is. An exclusive prefix scan of the summaries (by a window within a file, and by one
over the files' sums) gives each block the documents and ids before it and the place
where its first document began; the second pass then finishes every block on its own.
Nothing but the files is asked, so files that others wrote are counted alike; a list of
doc_ids beside a file (``.keys``) only names its documents.

Defined results: ids after the last separator of a file belong to no document, and a
document does not go on from one file to the next; a file without ids adds none;
neighbouring separators are documents with just the end id; documents without a list
of keys have a null doc_id. In ``document_lengths`` null and empty texts are documents
with just the end id, repeated rows are documents of their own, texts of any length
are written whole, an empty table gives no rows, and only doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh_dir, open_store, stored
from .token_files import shard_name, write_shards

#: Ids in a block: 2 MB of a file of 16-bit ids.
BLOCK = 1 << 20


def _separators(folder: str, shard: int, block: int, size: int, end_id: int, kind: str) -> np.ndarray:
    """Places of the separators in one block, counted from the start of the file."""
    fs, path = open_store(shard_name(folder, shard))
    width = np.dtype(kind).itemsize
    with fs.open_input_file(path) as f:
        f.seek(width * block * size)
        ids = np.frombuffer(f.read(width * size), kind)
    return np.flatnonzero(ids == end_id) + block * size


def _keys(folder: str, shard: int, first: int, count: int) -> list[int | None]:
    """The doc_ids of documents ``first`` to ``first + count`` of a shard; nulls if there is no list of them."""
    fs, path = open_store(shard_name(folder, shard) + ".keys")
    info = fs.get_file_info(path)
    if info.type != pafs.FileType.File:
        return [None] * count
    # 8 bytes a key, then one whether it is known
    n_docs = info.size // 9
    with fs.open_input_file(path) as f:
        f.seek(8 * first)
        keys = np.frombuffer(f.read(8 * count), "<i8").tolist()
        f.seek(8 * n_docs + first)
        known = f.read(count)
    return [k if ok else None for k, ok in zip(keys, known, strict=True)]


def scan_flat(files: DataFrame, folder: str, end_id: int, size: int = BLOCK, kind: str = "<u4") -> DataFrame:
    """Documents of the flat shards numbered in ``files`` (column shard) in order of their numbers.

    Returns doc_no (its place among all documents), doc_id (from the list beside
    the shard), start (ids before it in all files) and n_tokens (its ids, the end
    id included).
    """

    def measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = np.dtype(kind).itemsize
        for batch in batches:
            found = []
            for shard in batch.column(0).to_pylist():
                fs, path = open_store(shard_name(folder, shard))
                found.append(fs.get_file_info(path).size // width)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.int64())], names=["shard", "n_ids"])

    def summarise(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_separators(folder, r["shard"], r["block"], size, end_id, kind) for r in batch.to_pylist()]
            more = {
                "n_seps": pa.array([len(p) for p in found], pa.int64()),
                "last": pa.array([int(p[-1]) if len(p) else -1 for p in found], pa.int64()),
            }
            yield pa.RecordBatch.from_arrays([*batch.columns, *more.values()], names=[*batch.schema.names, *more])

    def finish(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                ends = _separators(folder, r["shard"], r["block"], size, end_id, kind)
                firsts = np.concatenate([[r["begin"]], ends[:-1] + 1])
                keys = _keys(folder, r["shard"], r["seps_before"], len(ends))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(r["docs_before"] + r["seps_before"] + np.arange(len(ends))), pa.array(keys, pa.int64()),
                        pa.array(r["ids_before"] + firsts), pa.array(ends + 1 - firsts),
                    ],
                    names=["doc_no", "doc_id", "start", "n_tokens"],
                )

    sized = files.select(F.col("shard").cast("bigint").alias("shard")).mapInArrow(measure, "shard bigint, n_ids bigint")
    last_block = F.floor((F.col("n_ids") - 1) / size).cast("bigint")
    blocks = sized.where("n_ids > 0").select("shard", "n_ids", F.explode(F.sequence(F.lit(0).cast("bigint"), last_block)).alias("block"))
    dealt = blocks.repartition("shard", "block")
    summed = stored(dealt.mapInArrow(summarise, "shard bigint, n_ids bigint, block bigint, n_seps bigint, last bigint"), "block-summaries")
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sums = Window.partitionBy("shard")
    carried = summed.select(
        "*",
        F.coalesce(F.sum("n_seps").over(before), F.lit(0)).alias("seps_before"),
        (F.coalesce(F.max("last").over(before), F.lit(-1)) + 1).alias("begin"),
        F.sum("n_seps").over(sums).alias("shard_seps"),
    )
    # one row a file
    above = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    totals = carried.where("block = 0").select(
        F.col("shard").alias("of"),
        F.coalesce(F.sum("shard_seps").over(above), F.lit(0)).alias("docs_before"),
        F.coalesce(F.sum("n_ids").over(above), F.lit(0)).alias("ids_before"),
    )
    whole = carried.where("n_seps > 0").join(totals, F.col("shard") == F.col("of")).select(
        "shard", "block", "seps_before", "begin", "docs_before", "ids_before"
    )
    return whole.repartition("shard", "block").mapInArrow(finish, "doc_no bigint, doc_id bigint, start bigint, n_tokens bigint")


def document_lengths(docs: DataFrame, vocabulary: str, end_id: int, size: int = BLOCK, kind: str = "<u2") -> DataFrame:
    """Write ``docs`` as flat shards in the shared folder and count their tokens.

    Texts are encoded with added tokens as ordinary text, so ``end_id`` is found
    nowhere but at a document's end. Each shard ends with a separator. ``kind`` has
    to hold every id of the vocabulary.
    """
    spark = docs.sparkSession
    folder = fresh_dir(spark, "token-flat")
    shards = write_shards(docs, vocabulary, folder, end_id, specials=False, flat=kind, ordered=False)
    files = spark.createDataFrame([(s,) for s, _, _ in shards], "shard bigint")
    return scan_flat(files, folder, end_id, size, kind)
