"""Tables in and out: CSV manifests as text, verified reads, staged promotion, run stamps, templates, captions in XML, rasters."""

from __future__ import annotations

import csv
import io
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class ManifestError(ValueError):
    """A manifest is absent or malformed."""


def text_schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def read_manifest(spark: SparkSession, path: str, columns: list[str] | None = None, optional: bool = False) -> DataFrame:
    """Every cell as text, blank for null. An optional file that is absent is an empty table; a required one is an error."""
    if not _exists(spark, path):
        if optional and columns:
            return spark.createDataFrame([], text_schema(columns))
        raise ManifestError(f"{path} is absent")
    df = spark.read.option("header", True).option("mode", "FAILFAST").option("multiLine", True).option("escape", '"').option("inferSchema", False).csv(path)
    if columns and (lack := [c for c in columns if c not in df.columns]):
        raise ManifestError(f"{path} lacks {', '.join(lack)}")
    return df.na.fill("")


def load_manifests(spark: SparkSession, folder: str, required: dict[str, list[str]], optional: dict[str, list[str]]) -> dict[str, DataFrame]:
    return {n: read_manifest(spark, f"{folder}/{n}.csv", c) for n, c in required.items()} | {n: read_manifest(spark, f"{folder}/{n}.csv", c, True) for n, c in optional.items()}


def verified(spark: SparkSession, path: str, sha256: str) -> DataFrame:
    """The physical lines of a file whose own bytes have the digest: one read serves both."""
    f = spark.read.format("binaryFile").load(path).select("path", F.sha2("content", 256).alias("digest"), F.decode("content", "utf-8").alias("text"))
    return f.where(F.col("digest") == sha256.lower()).select("path", F.posexplode(F.split("text", "\r?\n")).alias("line", "text"))


def verified_rows(spark: SparkSession, path: str, sha256: str, columns: list[str] | None = None) -> DataFrame:
    """The rows of a CSV file whose own bytes have the digest, every cell as text: the bytes that were hashed are those that are parsed.

    No row comes of a file with another digest. columns are the file's, in its order, and are read from its first line where they are not given.
    """
    f = spark.read.format("binaryFile").load(path).where(F.sha2("content", 256) == sha256.lower())
    if columns is None:
        head = f.select(F.decode("content", "utf-8").alias("t")).first()
        if head is None:
            return spark.createDataFrame([], "path string")
        columns = next(csv.reader(io.StringIO(head["t"].lstrip("\ufeff"), newline="")))

    def parse(files):
        for path_, content in zip(files[0], files[1], strict=True):
            rows = csv.reader(io.StringIO(bytes(content).decode("utf-8-sig"), newline=""))
            next(rows, None)
            for line, r in enumerate(rows):
                yield path_, line + 2, [*r, *[""] * (len(columns) - len(r))][: len(columns)]

    def run(batches):
        for b in batches:
            rows = list(parse((b.column(0).to_pylist(), b.column(1).to_pylist())))
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64()), *[pa.array([r[2][k] for r in rows], pa.string()) for k in range(len(columns))]], names=["path", "_line", *columns])

    return f.select("path", "content").mapInArrow(run, ", ".join(["path string", "_line long", *[f"`{c}` string" for c in columns]]))


def hashes(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """name and sha256 of a folder's files."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder).select(F.element_at(F.split("path", "/"), -1).alias("name"), F.sha2("content", 256).alias("sha256"))


def frame_digest(df: DataFrame) -> DataFrame:
    """One digest for a table's rows whatever their order: eight sums of 32-bit parts of the rows' hashes, so nothing is collected or sorted."""
    row = F.sha2(F.to_json(F.struct(*sorted(df.columns))), 256)
    parts = [F.sum(F.conv(F.substring(row, 1 + 8 * i, 8), 16, 10).cast("decimal(20,0)")).alias(f"p{i}") for i in range(8)]
    return df.agg(F.count("*").alias("n"), *parts).select(F.sha2(F.concat_ws("|", F.col("n").cast("string"), *[F.coalesce(F.col(f"p{i}"), F.lit(0)).cast("string") for i in range(8)]), 256).alias("digest"))


def source_kind(content: Column) -> Column:
    """What a document's first bytes say it is."""
    head = F.decode(F.substring(content, 1, 512), "iso-8859-1")
    return F.when(F.startswith(head, F.lit("%PDF-")), "PDF").when(head.rlike(r"(?is)<article[\s>]|<!DOCTYPE article"), "JATS_XML").when(head.rlike(r"^[\x09\x0A\x0D\x20-\x7E\x80-\xFF]+$"), "PLAIN_TEXT").otherwise("UNREADABLE")


def xml_captions(spark: SparkSession, path: str) -> DataFrame:
    """label and caption of each figure of a JATS document."""
    schema = T.StructType([T.StructField("label", T.StringType()), T.StructField("caption", T.StructType([T.StructField("p", T.ArrayType(T.StringType()))]))])
    return spark.read.format("xml").option("rowTag", "fig").schema(schema).load(path).select("label", F.array_join("caption.p", " ").alias("caption"))


def rasters(spark: SparkSession, path: str) -> DataFrame:
    """origin, height, width and pixels (BGR bytes) of images."""
    return spark.read.format("image").load(path).select("image.origin", "image.height", "image.width", "image.nChannels", "image.data")


def unknown_keys(plans: DataFrame, json: str, allowed: list[str], keep: list[str] = ()) -> DataFrame:
    """Keys of a JSON object that nobody declared, beside the columns to keep."""
    return plans.select(*keep, F.explode(F.array_except(F.json_object_keys(json), F.array(*[F.lit(k) for k in allowed]))).alias("key"))


def write_outputs(outputs: dict[str, DataFrame], folder: str, stamp: DataFrame, fmt: str = "parquet") -> None:
    """All tables to a staging folder, then renamed into place, the stamp last: a reader that sees the stamp sees all.

    What stood there is moved aside first and deleted at the end; where a move fails, it is put back.
    """
    spark = stamp.sparkSession
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path
    fs = path(folder).getFileSystem(conf)
    staging, aside = f"{folder}/.staging-{uuid.uuid4().hex}", f"{folder}/.before-{uuid.uuid4().hex}"
    names, kept, new = ["run_stamp", *outputs], [], []
    try:
        for name, df in [*outputs.items(), ("run_stamp", stamp)]:
            df.write.format(fmt).option("header", True).mode("overwrite").save(f"{staging}/{name}")
        fs.mkdirs(path(aside))
        try:
            for name in names:  # the stamp goes first and comes last
                if fs.exists(path(f"{folder}/{name}")):
                    _rename(fs, path, f"{folder}/{name}", f"{aside}/{name}")
                    kept.append(name)
            for name in reversed(names):
                _rename(fs, path, f"{staging}/{name}", f"{folder}/{name}")
                new.append(name)
        except Exception:
            for name in new:
                fs.delete(path(f"{folder}/{name}"), True)
            for name in reversed(kept):
                _rename(fs, path, f"{aside}/{name}", f"{folder}/{name}")
            raise
        fs.delete(path(aside), True)
    finally:
        fs.delete(path(staging), True)


def _rename(fs, path, old: str, new: str) -> None:
    if not fs.rename(path(old), path(new)):
        raise OSError(f"{old} could not be moved to {new}")


def withdraw(spark: SparkSession, folder: str) -> None:
    """Takes the stamp away: the run no longer counts as done."""
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/run_stamp")
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def write_templates(spark: SparkSession, tables: dict[str, list[str]], folder: str) -> None:
    for name, columns in tables.items():
        spark.createDataFrame([], text_schema(columns)).write.mode("overwrite").option("header", True).csv(f"{folder}/{name}")


def envelope(marks: DataFrame, by: str) -> DataFrame:
    """One JSON document of marks for each panel; a number that is not finite is refused (null document, finite = false)."""
    numbers = [F.col(f.name) for f in marks.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    odd = F.lit(False)
    for c in numbers:
        odd = odd | F.isnan(c) | (F.abs(c) == float("inf"))
    rows = marks.withColumn("_odd", F.coalesce(odd, F.lit(False)))
    body = F.to_json(F.array_sort(F.collect_list(F.struct(*sorted(c for c in marks.columns if c != by)))))
    return rows.groupBy(by).agg((~F.bool_or("_odd")).alias("finite"), body.alias("_j")).select(by, "finite", F.when(F.col("finite"), F.col("_j")).alias("document"))
