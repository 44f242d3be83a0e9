"""The stages of the corpus pipeline: each an operator whose decisions take effect on documents.

Rows are told apart by doc_id and a hash of the text, so that null and repeated doc_ids are safe. Texts are never
shuffled where the keys of the rows to drop are few enough to broadcast; their number is checked first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, decontaminate as template, ngram_join, quality as rules, secret_scan
from .common import append_columns, discard, free_name, read_table, small_batches, staged, with_size_check

#: Keys that may be broadcast; beyond, an anti join shuffles.
KEYS = 1_000_000


def row_key(doc: str = "doc_id", text: str = "text") -> Column:
    return F.struct(F.col(doc).isNull().alias("no"), F.col(doc).alias("doc"), F.xxhash64(F.col(text)).alias("hash"))


def without(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """docs but for the rows whose row_key is among keys (a column "key")."""
    k = free_name(docs, "_key")
    side = with_size_check(staged(keys.select(F.col("key").alias(k + "2")).distinct(), "drop"), KEYS)
    return docs.withColumn(k, row_key()).join(side, F.col(k).eqNullSafe(F.col(k + "2")), "left_anti").drop(k)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score reaches the threshold. The rules are fitted on the labelled rows of docs."""
    small_batches(spark)
    model = rules.fit_quality(docs, read_table(spark, sf_dir, "labels"))
    names = [free_name(docs, f"_{x}") for x in rules.STATS]
    wide = append_columns(docs, "text", lambda: rules.stats, ", ".join(f"`{n}` double" for n in names))
    return wide.where(model.column(names) >= rules.THRESHOLD).select(*[F.col(f"`{c}`") for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest doc_id; texts without a word are no duplicates."""
    k = free_name(docs, "_key")
    small_batches(spark)
    found = ngram_join.jaccard_components(docs.select(row_key().alias(k), "text"), key=k)
    keys = staged(found.where("n_shingles > 0").groupBy(F.col(k).alias("key")).agg(F.min("component_id").alias("least"), F.count("*").alias("c")), "keys")
    kept = without(docs, keys.where(F.col("key") != F.col("least")).select("key"))
    again = keys.where((F.col("key") == F.col("least")) & (F.col("c") > 1)).select("key")
    if again.limit(1).count():  # the same document several times: one row of it
        few = staged(again, "again")
        many = kept.withColumn(k, row_key()).join(with_size_check(few.select(F.col("key").alias(k + "2")), KEYS), F.col(k).eqNullSafe(F.col(k + "2")), "left_semi")
        kept = without(kept, few).unionByName(many.dropDuplicates([k]).drop(k))
    return kept


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no benchmark item contaminates."""
    k = free_name(docs, "_key")
    found = template.contaminated(docs.select(row_key().alias(k), "text"), read_table(spark, sf_dir, "benchmark"), key=k)
    return without(docs, found.select(F.col(k).alias("key")))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, secrets replaced by their kinds; n_chars follows where the text changed."""
    small_batches(spark)
    changed = free_name(docs, "_changed")
    out = secret_scan.redact_secrets(docs, changed=changed)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col(changed), F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, token ids, their number, and whether they decode to the text."""
    small_batches(spark)
    return bpe.round_trip(docs.select("doc_id", "text")).select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"))
