"""Language identification: word-first backoff.

A known word scores by its log frequency in each language. A word never seen backs off to
character n-grams: at each of its characters the longest known n-gram that ends there counts, from 4 letters
down to 1, with a penalty a step. A text's scores are the sums over its words; the best language wins
(ties: the lexically smaller) and score is its posterior.

The fit sees about ``sample`` texts, picked by a hash of the key among rows that are not held
out and have a language; word counts are summed in Spark, and at most ``words`` words of each language reach the driver.
Everything is predicted, whole and whatever its length; a repeated row gives a repeated result, an empty table an empty one,
and other columns do not matter. lang, source and doc_id are never inputs of a prediction.

``und`` with score 0 stands for a null text, a text without a letter, and everything when no
row could be learnt from. A letter is what str.isalpha says.
"""

from __future__ import annotations

import itertools
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_texts, read_table, tidied

#: Texts that the fit is to see: where more could be learnt from, a hash of the key picks each with a chance that gives about so many.
SAMPLE = 20_000
#: Most words of a language that the model keeps, and most languages; more languages are an error, not left out.
WORDS_KEPT, MOST_LANGUAGES = 60_000, 1000
#: Longest n-gram of the backoff, and what a step down costs.
LONGEST, STEP = 4, math.log(0.4)
#: Words whose rows a worker remembers, and words of a text that are summed at once.
CACHE, PART = 200_000, 50_000
WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def grams(word: str, n: int) -> list[str]:
    w = f"^{word}$"
    return [w[i : i + n] for i in range(len(w) - n + 1)]


class WordModel:
    """Rows of log frequencies by language, and the row of each word and n-gram."""

    def __init__(self, counts: dict[str, dict[str, int]]):
        """counts: by language, by word."""
        self.langs = sorted(counts)
        k = len(self.langs)
        self.words: dict[str, int] = {}
        self.grams: dict[str, int] = {}
        self.word_rows = self.gram_rows = np.zeros((0, max(k, 1)))
        if not k:
            return
        self.words, self.word_rows = self._rows([counts[x] for x in self.langs], None)
        of = [{x: Counter() for x in range(1, LONGEST + 1)} for _ in self.langs]
        for j, x in enumerate(self.langs):
            for w, c in counts[x].items():
                for n in range(1, LONGEST + 1):
                    for g in grams(w, n):
                        of[j][n][g] += c
        tables = []
        for n in range(1, LONGEST + 1):
            names, rows = self._rows([x[n] for x in of], 1000)
            self.grams |= {g: len(self.grams) + i for g, i in names.items()}
            tables.append(rows)
        self.gram_rows = np.vstack(tables)

    @staticmethod
    def _rows(counts: list[dict[str, int]], smoothing: int | None) -> tuple[dict[str, int], np.ndarray]:
        names = sorted(set(itertools.chain(*counts)))
        table = np.array([[c.get(x, 0) for c in counts] for x in names], float).reshape(-1, len(counts))
        total = np.array([sum(c.values()) for c in counts], float)
        return {x: i for i, x in enumerate(names)}, np.log((table + 0.1) / (total + 0.1 * (smoothing or max(len(names), 1))))

    def unseen(self, word: str) -> np.ndarray:
        """Mean over the characters, so that a long unseen word weighs no more than a known one."""
        w, rows, steps, get = f"^{word}$", [], 0, self.grams.get
        for end in range(2, len(w) + 1):
            for n in range(min(LONGEST, end), 0, -1):
                i = get(w[end - n : end])
                if i is not None:
                    rows.append(i)
                    steps += LONGEST - n
                    break
        return 3 * (self.gram_rows[rows].sum(axis=0) + STEP * steps) / max(len(w) - 1, 1)


class Predictor:
    """Predicts text by text; remembers the rows of words. What it has forgotten is worked out again, so results do not depend on it."""

    def __init__(self, model: WordModel):
        self.model = model
        self.row: dict[str, int] = {}
        self.table = np.zeros((1024, max(len(model.langs), 1)))

    def _add(self, word: str) -> int:
        i = len(self.row)
        if i >= len(self.table):
            self.table = np.vstack([self.table, np.zeros_like(self.table)])
        s = self.model.words.get(word)
        self.table[i] = self.model.unseen(word) if s is None else self.model.word_rows[s]
        self.row[word] = i
        return i

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.model.langs:
            return "und", 0.0
        seen = Counter(words_of(text))
        if not seen:
            return ("und", 0.0) if not any(map(str.isalpha, text)) else (self.model.langs[0], 1.0 / len(self.model.langs))
        total = sum((seen.pop(w) * self.model.unseen(w) for w in [w for w in seen if len(w) > 64]), np.zeros(len(self.model.langs)))
        each = iter(seen.items())
        while part := list(itertools.islice(each, PART)):  # never more new words than rows are free
            if len(self.row) + len(part) > CACHE:
                self.row.clear()
            get, add = self.row.get, self._add
            rows = [i if (i := get(w)) is not None else add(w) for w, _ in part]
            total = total + np.array([c for _, c in part], float) @ self.table[rows]
        p = np.exp(total - total.max())
        best = int(np.argmax(total))
        return self.model.langs[best], float(p[best] / p.sum())


def held_out(key: str):
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit_language(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", sample: int = SAMPLE, words: int = WORDS_KEPT) -> WordModel:
    """Texts are counted in the executors; what reaches the driver is bounded by ``words`` a language and MOST_LANGUAGES."""
    known = docs.select(F.col(key).alias("_k"), F.col(text).alias("_t"), F.col(lang).cast("string").alias("_l")).where(F.col("_l").isNotNull() & F.col("_t").isNotNull() & F.col("_k").isNotNull() & ~held_out("_k"))
    n = known.select("_k").count()
    if n > sample:
        known = known.where(F.pmod(F.xxhash64("_k"), F.lit(1 << 30)) < int(sample / n * (1 << 30)))

    @tidied
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, Counter] = {}
        for b in batches:
            for t, x in zip(b.column(0), b.column(1), strict=True):
                seen.setdefault(x.as_py(), Counter()).update(words_of(t.as_py()))
        rows = [(x, w, c) for x, s in seen.items() for w, c in s.items()]
        for i in range(0, len(rows), 100_000):
            a, b_, c = zip(*rows[i : i + 100_000], strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.string()), pa.array(b_, pa.string()), pa.array(c, pa.int64())], names=["l", "w", "c"])

    totals = known.select("_t", "_l").mapInArrow(count, "l string, w string, c long").groupBy("l", "w").agg(F.sum("c").alias("c"))
    langs = [r["_l"] for r in known.select("_l").distinct().orderBy("_l").limit(MOST_LANGUAGES + 1).collect()]
    if len(langs) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    counts: dict[str, dict[str, int]] = {}
    for x in langs:  # a bounded number of bounded lists
        counts[x] = {}
    if langs:
        totals = totals.where(F.col("l").isin(langs)).persist()
        try:
            for x in langs:
                for w, c in totals.where(F.col("l") == x).orderBy(F.desc("c"), "w").limit(words).select("w", "c").toLocalIterator():
                    counts[x][w] = c
        finally:
            totals.unpersist()
    return WordModel(counts)


def identify(docs: DataFrame, model: WordModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by WORDS_KEPT

    def make():
        p = Predictor(shared.value)
        return p.predict

    return map_texts(docs, [key], text, make, "lang_pred string, score double")


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return identify(docs, fit_language(docs)).select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")
