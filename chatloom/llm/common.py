"""Shared plumbing: table access, the shared folder, and bounded Arrow batches."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession

#: Rows handed to one Python call. Small, as single texts may be very long.
ROWS_PER_BATCH = 2048
BYTES_PER_BATCH = 8 << 20
#: Characters of text handled together inside one Python call.
CHARS_PER_STEP = 5_000_000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The parquet table ``name`` of ``sf_dir``, read by Spark only."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bound_batches(spark: SparkSession) -> None:
    """Keep Arrow batches small, so a batch of long texts fits a worker's memory."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_PER_BATCH))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BYTES_PER_BATCH))


#: Arrays of at least so many bytes go back to the system as soon as they are freed.
LARGE_BYTES = 4 << 20
# Fixed value: the C library's number of that setting.
_MMAP_THRESHOLD = -3
Run = Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def releasing(run: Run) -> Run:
    """``run``, after which the worker gives free memory back: workers go on from stage to stage,
    and what one stage needed for a moment would stand beside what the next one needs."""

    def wrapped(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        libc = ctypes.CDLL(None)
        # by itself the C library would come to keep arrays of up to 32 MB after they are freed
        if hasattr(libc, "mallopt"):
            libc.mallopt(_MMAP_THRESHOLD, LARGE_BYTES)
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            if hasattr(libc, "malloc_trim"):
                libc.malloc_trim(0)

    return wrapped


def map_batches(
    df: DataFrame,
    columns: list[str],
    schema: str,
    step: Callable[[dict[str, list]], dict[str, list]],
) -> DataFrame:
    """Apply ``step`` (lists in, lists out) to the named columns of ``df`` batch by batch.

    Only ``columns`` reach Python, so other columns, whatever their names, stay
    out of the way. ``step`` may return more or fewer rows than it was given.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    bound_batches(df.sparkSession)
    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _steps(batch):
                out = step({c: part.column(i).to_pylist() for i, c in enumerate(columns)})
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[f.name], type=f.type) for f in arrow], schema=arrow
                )

    return df.select(*columns).mapInArrow(releasing(run), schema)


def map_arrow(
    df: DataFrame,
    columns: list[str],
    schema: str,
    step: Callable[..., Iterable[dict[str, object]]],
) -> DataFrame:
    """As ``map_batches``, but ``step`` takes the Arrow arrays of the columns and gives any number of column sets."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    bound_batches(df.sparkSession)
    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _steps(batch):
                for out in step(*part.columns):
                    yield pa.RecordBatch.from_arrays([pa.array(out[f.name], type=f.type) for f in arrow], schema=arrow)

    return df.select(*columns).mapInArrow(releasing(run), schema)


def _steps(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows holding about ``CHARS_PER_STEP`` bytes."""
    n = batch.num_rows
    if not n or batch.nbytes <= CHARS_PER_STEP:
        if n:
            yield batch
        return
    rows = max(1, n * CHARS_PER_STEP // batch.nbytes)
    for at in range(0, n, rows):
        yield batch.slice(at, rows)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, as the session names it.

    Only where the cluster names none (tests on one machine) is a folder made.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    own = spark.sparkContext._jsc.sc().getCheckpointDir()
    if not own.isDefined():
        spark.sparkContext.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="shared-"))
        own = spark.sparkContext._jsc.sc().getCheckpointDir()
    return own.get()


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new, not yet existing path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` into the shared folder and read it back, which cuts its lineage."""
    path = fresh_dir(df.sparkSession, label)
    df.write.parquet(path)
    release(df.sparkSession)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of what is done, which it does as the driver's
    garbage is collected; with a roomy heap that may be long after."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def open_store(uri: str) -> tuple[pafs.FileSystem, str]:
    """The pyarrow file system of ``uri`` and the path in it."""
    if "://" not in uri and not uri.startswith("file:"):
        return pafs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(uri)


def commit_file(uri: str, write: Callable[[pa.NativeFile], None]) -> None:
    """Write a file under a temporary name, then move it to ``uri``.

    A task that is run again, or twice at once, leaves one whole file.
    """
    fs, path = open_store(uri)
    fs.create_dir(path.rpartition("/")[0], recursive=True)
    part = f"{path}.{uuid.uuid4().hex}.tmp"
    with fs.open_output_stream(part) as out:
        write(out)
    fs.move(part, path)
