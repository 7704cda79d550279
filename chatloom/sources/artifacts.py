"""Stored tables: overlays of edited over original, backups, caches and other sinks."""

from __future__ import annotations

import json
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def saved(df: DataFrame, file_rows: int = 0) -> DataFrame:
    """``df`` as a table in the shared checkpoint folder, which cuts its lineage; where the session
    names no such folder, as in tests, in one that Spark has or gets for it. Files have ``file_rows`` rows at most."""
    spark = df.sparkSession
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        own = spark.sparkContext._jsc.sc().getCheckpointDir()
        if not own.isDefined():
            spark.sparkContext.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="shared-"))
            own = spark.sparkContext._jsc.sc().getCheckpointDir()
        folder = own.get()
    path = f"{folder.rstrip('/')}/saved-{uuid.uuid4().hex}"
    df.write.option("maxRecordsPerFile", file_rows).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def resolve(spark: SparkSession, original: str, edited: str) -> str:
    """The edited table's path if there is one, else the original's."""
    return edited if exists(spark, edited) else original


def read_table(spark: SparkSession, original: str, edited: str) -> DataFrame:
    return spark.read.parquet(resolve(spark, original, edited))


def ensure_edited(spark: SparkSession, original: str, edited: str) -> None:
    """Copy the original on the first edit."""
    if not exists(spark, edited):
        spark.read.parquet(original).write.parquet(edited)


def backup(spark: SparkSession, path: str, stamp: str) -> str:
    """Copy a table beside itself before its first overwrite under this stamp."""
    target = f"{path.rstrip('/')}.bak-{stamp}"
    if exists(spark, path) and not exists(spark, target):
        spark.read.parquet(path).write.parquet(target)
    return target


def read_envelope(spark: SparkSession, path: str, field: str, schema: str) -> DataFrame:
    """Rows of a JSON document that holds them in ``field``."""
    doc = spark.read.schema(f"{field} array<struct<{schema}>>").json(path, multiLine=True)
    return doc.select(F.posexplode(field).alias("ord", "row")).select("ord", "row.*")


def write_json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_pages(pages: DataFrame, path: str) -> None:
    """Markdown texts (page_id, markdown), a folder for each page."""
    pages.select("page_id", F.col("markdown").alias("value")).write.mode("overwrite").partitionBy("page_id").text(path)


def site_config(pages: DataFrame, title: str) -> str:
    """YAML of a site's navigation, one document that a site generator reads whole. ``pages`` (category, title, path)
    come to the driver a partition at a time."""
    lines = [f"site_name: {json.dumps(title, ensure_ascii=False)}", "nav:"]
    last = None
    for row in pages.orderBy("category_ord", "page_ord").toLocalIterator():
        if row.category != last:
            lines.append(f"  - {json.dumps(row.category, ensure_ascii=False)}:")
            last = row.category
        lines.append(f"    - {json.dumps(row.title, ensure_ascii=False)}: {json.dumps(row.path, ensure_ascii=False)}")
    return "\n".join(lines) + "\n"


def cached_answers(requests: DataFrame, cache: DataFrame, model: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, DataFrame]:
    """Answers of ``requests`` (key, prompt), asking ``model`` for keys not in ``cache`` (key, answer) only.

    Returns the answers and the cache with what is new.
    """
    known = cache.select("key", "answer").dropDuplicates(["key"])
    asked = model(requests.dropDuplicates(["key"]).join(known, "key", "left_anti")).select("key", "answer")
    every = known.unionByName(asked)
    return requests.join(every, "key", "left"), every


def is_stale(stored: dict, current: dict) -> bool:
    """Whether a kept table was made from other inputs than these."""
    return stored != current
