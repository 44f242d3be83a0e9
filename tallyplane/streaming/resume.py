"""Resumable batches: what was recorded is never done again, and late copies change nothing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def once(work: Callable[[DataFrame], DataFrame], key: str, ledger: str) -> Callable[[DataFrame, int], None]:
    """A foreachBatch sink: rows of keys that the ledger lacks are worked on and appended, tagged with their batch.

    A batch that is replayed after a failure first removes what it had written, as each batch has its own folder.
    """

    def sink(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        rows = batch.dropDuplicates([key])
        path = spark._jvm.org.apache.hadoop.fs.Path(ledger)
        if path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
            done = spark.read.parquet(ledger)
            if "batch" in done.columns:
                rows = rows.join(done.where(F.col("batch") != number).select(key).distinct(), key, "left_anti")
        work(rows).write.mode("overwrite").parquet(f"{ledger}/batch={number}")

    return sink


def gap_sessions(events: DataFrame, key: str, at: str, gap: str, late: str) -> DataFrame:
    """Sessions of a stream of events: a pause longer than gap ends one; events later than late are dropped by the watermark."""
    return events.withWatermark(at, late).groupBy(key, F.session_window(at, gap).alias("session")).agg(F.count("*").alias("n")).select(key, F.col("session.start").alias("start"), F.col("session.end").alias("end"), "n")
