"""Quality classifier: a sparse rule ensemble.

Statistics of a text (characters, words, lines) are the only inputs. Boosted trees on a bounded
labelled sample give paths; each path is a conjunctive rule over the statistics. A lasso logistic regression over the
rules keeps few of them, and the kept rules are compiled into one Spark column
expression, so that scoring is a sum of CASE expressions inside code generation.

The fit sees at most ``sample`` labelled rows (a hash of the key decides which); everything is scored.
Rows whose held_out flag is true are never learnt from. Null and empty texts are scored as empty ones. With
no labelled row of both classes the score is the share of label 1 (0.5 with no row).
Repeated rows are scored alike, an empty table gives an empty one, other columns do not matter. labels, lang, source and doc_id are never inputs.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_texts, read_table
from .trees import fit_boosted, fit_lasso_logistic, holds, paths, simplified

STATS = (
    "log_chars", "log_words", "mean_word", "upper_share", "digit_share", "punct_share", "symbol_share", "distinct_share",
    "top_word_share", "repeated_line_share", "odd_end_share", "log_line", "short_share", "bar_share", "bang_share", "wide_share",
)
#: Most labelled rows that the fit sees.
SAMPLE = 20_000
#: From this score on a text is kept.
THRESHOLD = 0.3

_UPPER, _LOWER, _DIGIT, _SPACE = (np.zeros(256, bool) for _ in range(4))
_UPPER[65:91] = _LOWER[97:123] = _DIGIT[48:58] = True
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_PUNCT = np.zeros(256, bool)
_PUNCT[33:127] = True
_PUNCT &= ~(_UPPER | _LOWER | _DIGIT)
_SYMBOL = np.isin(np.arange(256), list(b"#$%&*<>{}[]=~^\\@_|+/"))


def stats(text: str | None) -> tuple[float, ...]:
    raw = (text or "").encode()
    n = max(len(raw), 1)
    c = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    words = (text or "").split()
    k = max(len(words), 1)
    seen = Counter(words)
    lines = [x for x in (text or "").split("\n") if x.strip()]
    up, low = int(c[_UPPER].sum()), int(c[_LOWER].sum())
    return (
        math.log1p(len(raw)),
        math.log1p(len(words)),
        sum(map(len, words)) / k,
        up / max(up + low, 1),
        int(c[_DIGIT].sum()) / n,
        int(c[_PUNCT].sum()) / n,
        int(c[_SYMBOL].sum()) / n,
        len(seen) / k,
        max(seen.values(), default=0) / k,
        1 - len(set(lines)) / max(len(lines), 1),
        sum(v for w, v in seen.items() if not w[-1].isalnum() and w[-1] not in ".,;:!?)'\"") / k,
        math.log1p(len(raw) / max(len(lines), 1)),
        sum(v for w, v in seen.items() if len(w) <= 3) / k,
        int(c[124]) / k,
        int(c[33]) / k,
        int(c[128:].sum()) / n,
    )


def with_stats(docs: DataFrame, key: str = "doc_id", text: str = "text", keep_text: bool = False) -> DataFrame:
    """key (or several) and one column for each statistic."""
    return map_texts(docs, [key] if isinstance(key, str) else list(key), text, lambda: stats, ", ".join(f"{s} double" for s in STATS), keep_text)


class RuleEnsemble:
    """Rules with weights; column() is the score as a Spark expression."""

    def __init__(self, rules, weights, bias: float):
        self.rules, self.weights, self.bias = rules, weights, bias

    def column(self, names=STATS) -> Column:
        """The score over columns that hold the statistics, in the order of STATS."""
        terms = [F.lit(float(self.bias))]
        for rule, w in zip(self.rules, self.weights, strict=True):
            cond = None
            for j, t, le in rule:
                one = F.col(names[j]) <= F.lit(t) if le else F.col(names[j]) > F.lit(t)
                cond = one if cond is None else cond & one
            terms.append(F.when(cond, F.lit(float(w))).otherwise(F.lit(0.0)))
        z = terms[0]
        for t in terms[1:]:
            z = z + t
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def fit_rules(x: np.ndarray, y: np.ndarray, trees: int = 40, depth: int = 3, l1: float = 0.002, seed: int = 0) -> RuleEnsemble:
    if not len(y) or y.min() == y.max():
        p = float(np.clip(y.mean() if len(y) else 0.5, 1e-3, 1 - 1e-3))
        return RuleEnsemble([], [], math.log(p / (1 - p)))
    boosted = fit_boosted(x, y, trees=trees, depth=depth, rate=0.15, min_leaf=max(5, len(y) // 400), seed=seed, sample=0.6, features=0.6)
    rules = list(dict.fromkeys(simplified(r) for t in boosted.trees for r in paths(t)))
    table, used, seen = [], [], set()
    for r in rules:
        h = holds(r, x)
        k = h.tobytes()
        if 0 < h.sum() < len(h) and k not in seen and (~h).tobytes() not in seen:
            seen.add(k)
            table.append(h)
            used.append(r)
    if not used:
        return RuleEnsemble([], [], boosted.start)
    w, b = fit_lasso_logistic(np.array(table, float).T, y, l1)
    kept = np.flatnonzero(np.abs(w) > 1e-6)
    return RuleEnsemble([used[i] for i in kept], w[kept].tolist(), b)


def held_out(key: str, parts: int, part: int) -> Column:
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % parts == part, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, key: str, label: str, sample: int) -> DataFrame:
    """Labels of rows that are not held out, thinned by a hash of the key to about ``sample`` rows and never more than that."""
    known = labels.select(F.col(key).alias("_k"), F.col(label).cast("double").alias("_y")).where(F.col("_y").isin(0.0, 1.0) & F.col("_k").isNotNull()).where(~held_out("_k", 5, 0))
    n = known.count()
    if n > sample:
        share = 0.95 * sample / n
        known = known.where(F.pmod(F.xxhash64("_k"), F.lit(1 << 20)) < int(share * (1 << 20)))
    return F.broadcast(known.limit(sample))  # at most ``sample`` rows of two numbers


def fit_quality(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", sample: int = SAMPLE) -> RuleEnsemble:
    picked = docs.select(F.col(key).alias("_k"), F.col(text).alias("_t")).join(labelled_sample(docs, labels, key, label, sample), "_k")
    rows = with_stats(picked, ("_k", "_y"), "_t").orderBy("_k", "_y", *STATS).limit(sample).toPandas()
    x, y = rows[list(STATS)].to_numpy(float), rows["_y"].to_numpy(float)
    return fit_rules(x, y)


def score_quality(docs: DataFrame, model: RuleEnsemble, key: str = "doc_id", text: str = "text") -> DataFrame:
    return with_stats(docs, key, text).withColumn("score", model.column()).select(key, held_out(key, 5, 0).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return score_quality(docs, fit_quality(docs, read_table(spark, sf_dir, "labels")))
