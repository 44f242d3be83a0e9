"""From documents' text to caption candidates: labels that open a line, their confidence, running heads, what only another reader found."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.captions import caption_confidence, caption_text

#: A label at a line's start, its number, and the end of a label that names panels (such a line is no caption).
LABEL = r"^\s*(?i:fig(?:ure)?s?)[. ]*\s*([0-9]{1,3})([A-Za-z]?)\b[ .:|-]*(.*)$"


def lines(docs: DataFrame, key: str, text: str) -> DataFrame:
    """key, line (from 0) and its text."""
    return docs.select(key, F.posexplode(F.split(text, "\n")).alias("line", "text"))


def caption_candidates(docs: DataFrame, key: str, text: str) -> DataFrame:
    """key, line, number, body and confidence of lines that a figure label opens; a label with a panel letter is none."""
    found = lines(docs, key, text).withColumns({"number": F.regexp_extract("text", LABEL, 1), "_p": F.regexp_extract("text", LABEL, 2), "body": F.trim(F.regexp_extract("text", LABEL, 3))}).where("number <> '' and _p = ''")
    n = F.count("*").over(Window.partitionBy(key, "number"))
    score = caption_confidence(F.length("body"), n, F.col("body").rlike("^[a-z]"), F.col("line") == 0)
    return found.withColumn("confidence", F.round(F.greatest(score, F.lit(0.0)), 2)).select(key, "line", F.col("number").cast("int").alias("number"), "body", "confidence")


def furniture(rows: DataFrame, document: str, page: str, text: str, share: float = 0.5, pages: int = 3) -> DataFrame:
    """Flattened texts on at least two and a share of a document's pages; documents with fewer pages have none."""
    key = F.lower(F.regexp_replace(F.regexp_replace(caption_text(F.col(text)), r"[0-9]+", "#"), r"[^\p{L}#]+", " "))
    n = rows.groupBy(document).agg(F.countDistinct(page).alias("pages")).where(F.col("pages") >= pages)
    seen = rows.select(document, page, F.trim(key).alias("key")).where("key <> ''").groupBy(document, "key").agg(F.countDistinct(page).alias("seen"))
    return seen.join(n, document).where(F.col("seen") >= F.greatest(F.lit(2), F.ceil(F.col("pages") * share)))


def only_in_second(first: DataFrame, second: DataFrame, on: list[str]) -> DataFrame:
    """What the other reader found alone, each once."""
    return second.join(first.select(*on).distinct(), on, "left_anti").dropDuplicates(on)


def box_above(captions: DataFrame, blocks: DataFrame, furniture_keys: DataFrame | None = None) -> DataFrame:
    """Where a caption's figure may stand: from the lowest text block above it (running heads left out) down to the caption.

    captions: page, caption, x0, x1, top. blocks: page, block, x0, x1, bottom. Blocks that share no column with the caption do not count.
    """
    b = blocks.join(furniture_keys, ["page", "block"], "left_anti") if furniture_keys is not None else blocks
    b = b.select("page", F.col("x0").alias("_a"), F.col("x1").alias("_b"), "bottom")
    over = captions.join(b, "page", "left").where(F.col("bottom").isNull() | ((F.col("_a") < F.col("x1")) & (F.col("x0") < F.col("_b")) & (F.col("bottom") <= F.col("top"))))
    best = over.groupBy("page", "caption").agg(F.max("bottom").alias("floor"))
    return captions.join(best, ["page", "caption"], "left").select("page", "caption", "x0", "x1", F.coalesce("floor", F.lit(0)).alias("y0"), F.col("top").alias("y1"))


def sentence_kind(sentence: Column) -> Column:
    """LEGEND, TABLE, VALUE or BODY: where a sentence about spreads stands."""
    s = F.lower(sentence)
    return F.when(s.rlike(r"^\s*(fig|figure)\b"), "LEGEND").when(s.rlike(r"^\s*table\b"), "TABLE").when(s.rlike(r"\b(values|data|results) (are|were)\b"), "VALUE").otherwise("BODY")


def document_statement(docs: DataFrame, key: str, text: str) -> DataFrame:
    """The first sentence of a document that presents values and names a spread."""
    sentences = docs.select(key, F.posexplode(F.split(caption_text(F.col(text)), r"(?<=[.!?]) ")).alias("at", "sentence"))
    fit = sentences.where(F.col("sentence").rlike(r"(?i)\b(values|data|results|variables) (are|were)\b") & F.col("sentence").rlike(r"(?i)\b(s\.?e\.?m\.?|s\.?d\.?|s\.?e\.?|standard (errors?|deviations?)|confidence)\b"))
    return fit.groupBy(key).agg(F.min_by("sentence", "at").alias("sentence"))
