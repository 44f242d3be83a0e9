"""Exact top-k search by inner product over an impact-ordered, score-at-a-time index.

Vectors are whole numbers. The index of a block of rows holds posting segments: a component, a quantised impact and a sign, and the
rows whose component has that impact. Segments stand by falling impact. A batch of queries goes through them in that
order: the segment's impact times the query's component is added to the score of each row in the segment, for all
queries of the batch at once. What the segments passed so far leave of a row (components whose segment has not come, and what quantising
cut off) has a known norm, so its part of any score is at most that norm times the query's (Cauchy-Schwarz). After each impact, rows whose
upper bound is below the k-th best lower bound are out. A query stops only on this proof, once few rows are left;
those rows are scored exactly in whole numbers, and ties go to the smaller id. Nothing is approximate.

Memory. The scores of a batch take rows x batch x 8 bytes, and the batch is cut so that this stays below SCORE_BYTES; a block has at most
``BLOCK_ROWS[1]`` rows, whatever the table's size.

Scale. Rows are dealt to blocks by a hash of the id. Every block of queries meets every block of rows:
packed blocks, not rows, are copied, and a salt spreads a query block's meetings over tasks. The k best
of each meeting are merged by a window whose limit is applied before its shuffle. If the packed queries have at
most ``BROADCAST_BYTES`` they are broadcast instead.

Vectors that are null or hold a null or a component that is not finite take no part; queries meet only
vectors of their own length. Rows that share a query's id count as the query's own. Repeated rows of other ids each
count. An empty table gives an empty result. The scores must fit 64 bits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import read_table, tidied

#: Rows of a block of rows and of a block of queries.
BLOCK_ROWS, BLOCK_QUERIES = (2048, 16384), 4096
#: Impacts: multiples of a step that is this share of the block's largest component.
IMPACTS = 8
#: Rows left at which a query leaves the index.
FEW = 64
#: Scores of a batch of queries.
SCORE_BYTES = 4 << 20
BROADCAST_BYTES = 32 << 20
SALT = 16


def _rows(binary: bytes, width: int) -> np.ndarray:
    return np.frombuffer(binary, np.int64).reshape(-1, width)


class Block:
    """The index of some rows."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        order = np.argsort(ids, kind="stable")  # ties then go to the smaller id
        self.ids, self.rows = ids[order], rows[order]
        n, width = rows.shape
        top = int(np.abs(self.rows).max(initial=0))
        step = max(1, -(-top // IMPACTS))
        level = (np.abs(self.rows) + step // 2) // step
        #: By falling impact: the segments (component, signed impact, rows), and the norm of what is then left of each row.
        self.segments: list[tuple[list[tuple[int, int, np.ndarray]], np.ndarray]] = []
        left = (self.rows.astype(np.float64) ** 2).sum(axis=1)
        for impact in range(int(level.max(initial=0)), 0, -1):
            lists, at = [], level == impact
            for c in np.flatnonzero(at.any(axis=0)):
                here = np.flatnonzero(at[:, c])
                x = self.rows[here, c]
                for sign in (1, -1):
                    if len(part := here[x * sign > 0]):
                        lists.append((int(c), sign * impact * step, part))
            value = np.where(at, self.rows, 0).astype(np.float64)
            left = left - (value**2).sum(axis=1) + ((value - np.sign(value) * impact * step * at) ** 2).sum(axis=1)
            self.segments.append((lists, np.sqrt(np.maximum(left, 0))))

    def possible(self, queries: np.ndarray, query_ids: np.ndarray, k: int) -> list[np.ndarray]:
        """For each query the rows that may be among its k best, by proof."""
        n = len(self.ids)
        alive: list[np.ndarray] = [np.arange(n)] * len(queries)
        size = np.sqrt((queries.astype(np.float64) ** 2).sum(axis=1)) * (1 + 1e-9)
        # the query's own rows may be among the best: look as many places further
        own = np.searchsorted(self.ids, query_ids, "right") - np.searchsorted(self.ids, query_ids)
        kth = min(n, k + int(own.max(initial=0)))
        # the k-th best of the groups' best lower bounds: at least k rows reach it
        groups = np.arange(0, n, max(1, n // max(64 * kth, 1)))
        score, open_, maybe = np.zeros((n, len(queries)), np.int64), np.arange(len(queries)), None
        for lists, norm in self.segments:
            if not len(open_):
                break
            q = queries[open_]
            for c, impact, rows in lists:
                score[rows] += impact * q[:, c]
            slack = norm[:, None] * size[None, open_] + 1e-6
            limit = np.partition(np.maximum.reduceat(score - slack, groups, axis=0), len(groups) - kth, axis=0)[len(groups) - kth]
            slack += score
            maybe = slack >= limit[None, :]
            done = maybe.sum(axis=0) <= FEW
            if done.any():
                for j in np.flatnonzero(done):
                    alive[open_[j]] = np.flatnonzero(maybe[:, j])
                score, open_, maybe = score[:, ~done], open_[~done], maybe[:, ~done]
        if maybe is not None:
            for j, i in enumerate(open_):
                alive[i] = np.flatnonzero(maybe[:, j])
        return alive

    def search(self, queries: np.ndarray, query_ids: np.ndarray, k: int) -> list[tuple[int, np.ndarray, np.ndarray]]:
        """(query's place, ids, scores) of the k best of the block, best first."""
        n = len(self.ids)
        if n > FEW:
            batch = max(1, SCORE_BYTES // (8 * n))
            alive = [a for i in range(0, len(queries), batch) for a in self.possible(queries[i : i + batch], query_ids[i : i + batch], k)]
        else:
            alive = [np.arange(n)] * len(queries)
        out = []
        for i, rows in enumerate(alive):
            rows = rows[self.ids[rows] != query_ids[i]]
            if not len(rows):
                continue
            s = self.rows[rows] @ queries[i]
            if len(rows) > k:
                # ids are in order, so a stable sort by falling score leaves the smaller id first
                at = np.partition(s, len(s) - k)[len(s) - k]
                keep = s >= at
                rows, s = rows[keep], s[keep]
            best = np.argsort(-s, kind="stable")[:k]
            out.append((i, self.ids[rows[best]], s[best]))
        return out


def _packed(vectors: DataFrame, block: Column, group: str) -> DataFrame:
    """One row for each block and length of vectors: ids and components as bytes."""

    def pack(key, t):
        ids = t.column("id").to_numpy().astype(np.int64)
        flat = t.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        return pa.table({group: pa.array([key[0].as_py()], pa.int32()), "width": pa.array([key[1].as_py()], pa.int32()), "ids": pa.array([ids.tobytes()], pa.binary()), "rows": pa.array([flat.tobytes()], pa.binary())})

    return vectors.withColumn(group, block.cast("int")).withColumn("width", F.size("v")).groupBy(group, "width").applyInArrow(pack, f"{group} int, width int, ids binary, rows binary")


def top_k(vectors: DataFrame, is_query: Column, k: int = 5) -> DataFrame:
    """query_id, rank, vec_id, score. vectors: id long, v array<long>, without nulls; is_query is a predicate on id."""
    marked = vectors.select(F.col("id"), F.col("v"), is_query.alias("q"))
    n, nq, width = marked.agg(F.count("*"), F.count_if("q"), F.max(F.size("v"))).first()
    rows_of = int(min(max(n / 32, BLOCK_ROWS[0]), BLOCK_ROWS[1]))
    blocks, queries = max(1, -(-n // rows_of)), max(1, -(-nq // BLOCK_QUERIES))
    cand = _packed(marked.drop("q"), F.pmod(F.xxhash64("id"), F.lit(blocks)), "cb")
    ask = _packed(marked.where("q").drop("q"), F.pmod(F.xxhash64("id"), F.lit(queries)), "qb").select("qb", F.col("width").alias("qw"), F.col("ids").alias("qids"), F.col("rows").alias("qrows"))
    if nq * ((width or 0) + 1) * 8 <= BROADCAST_BYTES:
        met = cand.join(F.broadcast(ask), F.col("width") == F.col("qw"))
    else:
        cand = cand.withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(queries - 1)))).withColumn("salt", F.col("cb") % SALT)
        ask = ask.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
        met = cand.join(ask.withColumnRenamed("qb", "qb2").withColumnRenamed("salt", "salt2"), (F.col("qb") == F.col("qb2")) & (F.col("salt") == F.col("salt2")) & (F.col("width") == F.col("qw")))

    @tidied
    def search(batches):
        for b in batches:
            for r in b.to_pylist():
                block = Block(np.frombuffer(r["ids"], np.int64), _rows(r["rows"], r["width"]) if r["width"] else np.zeros((len(r["ids"]) // 8, 0), np.int64))
                qids = np.frombuffer(r["qids"], np.int64)
                order = np.argsort(qids, kind="stable")
                q = (_rows(r["qrows"], r["width"]) if r["width"] else np.zeros((len(qids), 0), np.int64))[order]
                qids = qids[order]
                found = block.search(q, qids, k)
                if found:
                    i, ids, s = zip(*found, strict=True)
                    lens = [len(x) for x in ids]
                    yield pa.RecordBatch.from_arrays([pa.array(np.repeat(qids[list(i)], lens)), pa.array(np.repeat(np.array(i, np.int64), lens)), pa.array(np.concatenate(ids)), pa.array(np.concatenate(s))], names=["query_id", "place", "vec_id", "score"])

    # "place" tells rows of a repeated query id apart within a block of queries
    found = met.select("width", "ids", "rows", "qids", "qrows").mapInArrow(search, "query_id long, place long, vec_id long, score long")
    w = Window.partitionBy("query_id", "place").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def quantised(table: DataFrame, key: str = "vec_id", vector: str = "embedding", scale: int = 256) -> DataFrame:
    """id and v = floor(scale * component) of the vectors that take part."""
    x = F.col(vector).cast("array<double>")
    fine = F.col(key).isNotNull() & x.isNotNull() & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    return table.where(fine).select(F.col(key).cast("long").alias("id"), F.transform(x, lambda c: F.floor(c * scale).cast("long")).alias("v"))


def op1_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(quantised(read_table(spark, sf_dir, "embeddings")), F.col("id") % 50 == 0)


OP1_SQL = """
WITH v AS (
  SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum([q.e[i] * c.e[i] for i in range(1, len(q.e) + 1)]) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(q.e) = len(c.e)
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
