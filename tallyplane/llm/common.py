"""What the operators share: reading, staging in the shared folder, batches of bounded size."""

from __future__ import annotations

import contextlib
import ctypes
import functools
import gc
import os
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Texts of a batch are handed on in pieces of about so many characters, so that a worker's memory does not follow the batch.
FLUSH_CHARS = 4_000_000
#: Rows and bytes of an Arrow batch. Texts are long: Spark's default of 10,000 rows would put tens of megabytes, several times over, into each worker.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": ("10000", "1000"), "spark.sql.execution.arrow.maxBytesPerBatch": ("67108864b", "8388608b")}


def small_batches(spark: SparkSession) -> None:
    """Sets the session's Arrow batches to BATCH where they are at Spark's defaults; an own setting stays."""
    for key, (default, ours) in BATCH.items():
        if spark.conf.get(key, default) == default:
            spark.conf.set(key, ours)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir of the session.

    Only where the session names none and runs on one machine (tests) a local one is set; on a cluster that is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        known = spark.sparkContext.getCheckpointDir()
        if not known and not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = known or "/tmp/checkpoints/tallyplane"
        if not known:
            spark.sparkContext.setCheckpointDir(folder)
        return folder
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def staged(df: DataFrame, name: str) -> DataFrame:
    """Writes df as Parquet to the shared folder and reads it back: this cuts the lineage, and survives a lost executor."""
    spark = df.sparkSession
    path = os.path.join(shared_dir(spark), f"stage-{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Deletes staged tables that nothing reads any more."""
    for df in tables:
        spark = df.sparkSession
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            if "/stage-" in folder:
                path = spark._jvm.org.apache.hadoop.fs.Path(folder)
                path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def small_enough(df: DataFrame, rows: int) -> bool:
    """True if df has at most so many rows; reads no more than that and one."""
    return df.limit(rows + 1).count() <= rows


def with_size_check(df: DataFrame, rows: int) -> DataFrame:
    """df with a broadcast hint if it has at most so many rows; beyond, the join shuffles."""
    return F.broadcast(df) if small_enough(df, rows) else df


def tidied(run: Callable) -> Callable:
    """run, after whose end a reused worker gives its freed memory back: allocators keep it otherwise, beside the executor's heap."""

    @functools.wraps(run)
    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            with contextlib.suppress(OSError, AttributeError):
                ctypes.CDLL(None).malloc_trim(0)

    return wrapped


def map_texts(
    df: DataFrame,
    columns: list[str],
    text: str,
    make: Callable[[], Callable[[str | None], tuple]],
    schema: str,
    keep_text: bool = False,
) -> DataFrame:
    """One row out for each row in: ``columns`` as they are, then the tuple that make()(text) gives.

    Arrow batches go to Python; make() is called once a task and may keep caches. Output is
    flushed by size. Neither names nor types of other columns of df matter.
    """
    src = df.select(*[F.col(c) for c in columns], F.col(text).cast("string").alias("_text"))
    head = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[:-1])
    out = df.sparkSession.createDataFrame([], ", ".join(x for x in (head, "_text string" if keep_text else "", schema) if x)).schema
    arrow = arrow_schema(out)
    n_keep = len(columns) + int(keep_text)

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        each = make()
        for batch in batches:
            texts = batch.column(len(columns))
            at, size = 0, 0
            rows: list[tuple] = []
            for i in range(batch.num_rows):
                t = texts[i].as_py()
                rows.append(each(t))
                size += len(t) if t else 0
                if size >= FLUSH_CHARS:
                    yield _pack(batch, at, rows, n_keep, arrow)
                    at, size, rows = i + 1, 0, []
            if rows:
                yield _pack(batch, at, rows, n_keep, arrow)

    return src.mapInArrow(run, out)


def free_name(df: DataFrame, name: str) -> str:
    """name, with underscores in front until df has no such column."""
    while name.lower() in {c.lower() for c in df.columns}:
        name = "_" + name
    return name


def append_columns(df: DataFrame, text: str, make: Callable[[], Callable[[str | None], tuple]], schema: str, replace: bool = False) -> DataFrame:
    """df with the columns of schema appended, whose names must be free: the tuple that make()(text) gives.

    With replace, the tuple's first value takes the text's place. All columns travel with the row through one
    mapInArrow, so that batches are bounded and a worker's memory is given back, which a plain function column does not do.
    """
    src = df.withColumn(text, F.col(f"`{text}`").cast("string"))
    at = src.columns.index(text)
    more = df.sparkSession.createDataFrame([], schema).schema
    out = type(src.schema)([*src.schema.fields, *more.fields])
    arrow = arrow_schema(out)
    first = int(replace)

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        each = make()
        for batch in batches:
            lo, size, rows = 0, 0, []
            texts = batch.column(at)
            for i in range(batch.num_rows):
                t = texts[i].as_py()
                rows.append(each(t))
                size += len(t) if t else 0
                if size >= FLUSH_CHARS or i + 1 == batch.num_rows:
                    made = list(zip(*rows, strict=True))
                    cols = [batch.column(k).slice(lo, len(rows)).cast(arrow.field(k).type) for k in range(batch.num_columns)]
                    if replace:
                        cols[at] = pa.array(made[0], type=arrow.field(at).type)
                    cols += [pa.array(c, type=arrow.field(len(cols) + k).type) for k, c in enumerate(made[first:])]
                    yield pa.RecordBatch.from_arrays(cols, schema=arrow)
                    lo, size, rows = i + 1, 0, []

    return src.mapInArrow(run, out)


def _pack(batch: pa.RecordBatch, at: int, rows: list[tuple], n_keep: int, schema: pa.Schema) -> pa.RecordBatch:
    kept = [batch.column(k).slice(at, len(rows)).cast(schema.field(k).type) for k in range(n_keep)]
    made = [pa.array(c, type=schema.field(n_keep + k).type) for k, c in enumerate(zip(*rows, strict=True))]
    return pa.RecordBatch.from_arrays([*kept, *made], schema=schema)


def arrow_schema(schema) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)
