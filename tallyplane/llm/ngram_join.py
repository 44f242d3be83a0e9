"""N-gram Jaccard join with token-combination prefixes.

The tokens of a document are its distinct word shingles, as 64-bit hashes. Documents with equal sets are one node.
Two nodes link when 100 * intersection >= PERCENT * union; the exact sets decide, the index only proposes.

Index. All tokens have one global order: rare before frequent, then by hash. A sketch of counts over all
documents says which are frequent; any rule would be correct, this one keeps buckets small. Of a set of n
tokens, at most t = n - ceil(n * PERCENT / 100) can be missing from a partner. A prefix with t + 1 rare tokens
therefore shares one of them with each partner, and each is indexed by itself. Where a document has fewer rare tokens,
the prefix is extended: frequent tokens fall into M classes, and the pairs of tokens within a class are indexed
(k = 2). To break every pair of a class with c tokens, c - 1 of them must be missing, so the prefix is long enough
once rare tokens + sum of (c - 1) exceeds t. M grows with the set's size; partners' sizes differ by a factor of
100 / PERCENT at most, so each document is indexed for its own size level and the next.

Bounds. An indexed rare token that no other document has indexed is missing from every partner whose prefix reaches as far; the
number of these caps the partner's size.

Links. In each bucket every member is first compared with one hub, the member with the smallest share of rare tokens
(in a group of near copies, the one nearest to the original): as many comparisons as members. Components of these
links leave, in each bucket, the pairs across components; those that the bounds do not exclude are compared, all of
them. One of the bounds is a bitmap of the parities of the tokens by hash: two sets differ in at least as many tokens
as their bitmaps in bits. So no link between different components is lost, no pair within a component is compared twice, and no
list of all pairs of a group is made.

Null and empty texts, or texts of separators alone, have no shingle and link with nothing. Repeated rows and repeated
keys are allowed: rows with equal sets share a component, whatever their keys. A null key is never a component's id
unless no member has another. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import FLUSH_CHARS, arrow_schema, discard, read_table, staged, tidied, with_size_check
from .components import components

#: Buckets of the sketch, and parts into which it is cut for summing.
SKETCH_BITS, SKETCH_PARTS = 22, 64
#: A token is frequent if its bucket counts so many more than the mean.
FREQUENT = 64
#: 64-bit words of a set's bitmap.
BITMAP = 8
#: Sets that a task remembers, to index copies once; forgetting only repeats work.
REMEMBERED = 200_000
#: Keys that may be broadcast (8 bytes each); beyond, the join shuffles.
BROADCAST_ROWS = 1_000_000

_U = np.uint64
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_SEP = np.zeros(256, bool)
_SEP[[32, 9, 10, 11, 12, 13]] = True
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)
_powers = [np.ones(1, _U), np.ones(1, _U)]


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = 1 << (n - 1).bit_length()
        for k, base in ((0, _BASE), (1, _BASE_INV)):
            x = np.full(size, base, _U)
            x[0] = 1
            _powers[k] = np.cumprod(x, dtype=_U)
    return _powers[0][:n], _powers[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def word_hashes(text: str) -> np.ndarray:
    """One hash for each word; words are runs of anything but ASCII white space, A-Z lower-cased."""
    raw = np.frombuffer(text.encode().translate(_LOWER), np.uint8)
    if not len(raw):
        return np.zeros(0, _U)
    sep = _SEP[raw]
    edge = np.flatnonzero(np.diff(np.concatenate(([True], sep, [True])).astype(np.int8)))
    start, end = edge[::2], edge[1::2]
    up, down = _power(len(raw) + 1)
    total = np.concatenate((np.zeros(1, _U), np.cumsum((raw.astype(_U) + _U(1)) * up[: len(raw)], dtype=_U)))
    return mix((total[end] - total[start]) * down[start] + (end - start).astype(_U) * _U(0xD6E8FEB86659FD93))


def shingles(text: str | None, words: int = 5) -> np.ndarray:
    """The sorted distinct hashes of the text's shingles."""
    w = word_hashes(text) if text else np.zeros(0, _U)
    if not len(w):
        return w
    k = min(words, len(w))
    total = np.full(len(w) - k + 1, k * 0xA24BAED4963EE407 & (1 << 64) - 1, _U)
    for j in range(k):
        total = mix(total + w[j : len(w) - k + 1 + j])
    return np.unique(total)


def node_of(tokens: np.ndarray, salt: int) -> tuple[int, int]:
    """128 bits of a set as two signed numbers; the first is the node's id."""
    d = hashlib.blake2b(tokens.tobytes(), digest_size=16, salt=salt.to_bytes(8, "little")).digest()
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


def bitmap(tokens: np.ndarray) -> np.ndarray:
    """The parity of the number of tokens that fall to each bit."""
    odd = np.bincount((tokens >> _U(17)).astype(np.int64) % (64 * BITMAP), minlength=64 * BITMAP) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def missing_allowed(n: int, percent: int) -> int:
    return n - -(-n * percent // 100)


def level_of(n: int, percent: int) -> int:
    """Partners' levels differ by one at most: a level spans a little more than the factor of their sizes."""
    return int(math.log(n) / math.log(100.0 / percent * 1.0001))


def classes_of(level: int, percent: int) -> int:
    return max(1, int((100.0 / percent) ** (level - 1) / 5))


def signatures(tokens: np.ndarray, frequent: np.ndarray, percent: int) -> tuple[np.ndarray, int, int, int]:
    """(signatures with pairs last, how many are single tokens, last rare token's place in 16 bits, share of rare tokens in 8 bits)."""
    n = len(tokens)
    t = missing_allowed(n, percent)
    rare = tokens[~frequent]
    share = min(255, int(256 * len(rare) / n))
    if len(rare) > t:
        return rare[: t + 1], t + 1, int(rare[t] >> _U(48)), share
    often, need, out = tokens[frequent], t + 1 - len(rare), [rare]
    level = level_of(n, percent)
    for lv in (level, level + 1):
        m = classes_of(lv, percent)
        cls = (mix(often ^ _U(0x5851F42D4C957F2D)) % _U(m)).astype(np.int64)
        first = np.zeros(len(often), bool)
        first[np.unique(cls, return_index=True)[1]] = True
        reach = np.cumsum(~first)
        k = int(np.searchsorted(reach, need)) + 1
        for c in np.unique(cls[:k]):
            x = often[:k][cls[:k] == c]
            i, j = np.triu_indices(len(x), 1)
            out.append(mix(mix(x[i] + _U(lv)) + x[j]))
    return np.concatenate(out), len(rare), 0xFFFF, share


def _pack_meta(n: int, last: int, singles: int, share: int) -> int:
    return n << 36 | last << 20 | min(singles, 2047) << 9 | share << 1


_META = {"n": (36, 28), "last": (20, 16), "singles": (9, 11), "share": (1, 8), "pair": (0, 1)}


def _field(meta: str, name: str):
    shift, bits = _META[name]
    return F.shiftrightunsigned(F.col(meta), shift).bitwiseAND(F.lit((1 << bits) - 1))


def _scan_sets(docs: DataFrame, key: str, text: str, words: int, salt: int) -> DataFrame:
    """A row for each document with its node; each task adds its part of the sketch as further rows."""
    src = docs.select(F.col(key).alias("doc"), F.col(text).cast("string").alias("t"))
    schema = docs.sparkSession.createDataFrame([], f"doc {src.schema[0].dataType.simpleString()}, n long, node long, more long, {', '.join(f'b{i} long' for i in range(BITMAP))}, part int, counts binary").schema
    arrow = arrow_schema(schema)

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << SKETCH_BITS, np.uint32)
        shift, seen = _U(64 - SKETCH_BITS), set()
        for b in batches:
            rows = []
            for t in b.column(1):
                s = shingles(t.as_py(), words)
                if not len(s):
                    rows.append((0, None, None, *[None] * BITMAP))
                    continue
                node, more = node_of(s, salt)
                rows.append((len(s), node, more, *bitmap(s).tolist()))
                if node not in seen:
                    if len(seen) >= REMEMBERED:
                        seen.clear()
                    seen.add(node)
                    np.add.at(counts, (s >> shift).astype(np.int64), 1)
            k = len(rows)
            cols = [pa.array([r[c] for r in rows], pa.int64()) for c in range(3 + BITMAP)]
            yield pa.RecordBatch.from_arrays([b.column(0).cast(arrow.field(0).type), *cols, pa.nulls(k, pa.int32()), pa.nulls(k, pa.binary())], schema=arrow)
        parts = [(i, zlib.compress(p.tobytes(), 1)) for i, p in enumerate(np.split(counts, SKETCH_PARTS)) if p.any()]
        if parts:
            k = len(parts)
            i, c = zip(*parts, strict=True)
            yield pa.RecordBatch.from_arrays([pa.nulls(k, arrow.field(0).type), *[pa.nulls(k, pa.int64())] * (3 + BITMAP), pa.array(i, pa.int32()), pa.array(c, pa.binary())], schema=arrow)

    return src.mapInArrow(run, schema)


def _frequent_bits(sketch: DataFrame, total: int) -> bytes:
    """One bit for each bucket of the sketch: 2 ** SKETCH_BITS bits in all, whatever the input's size."""
    mean = total / (1 << SKETCH_BITS)
    limit = mean + max(FREQUENT, 6 * math.sqrt(mean))

    def total_of(t):
        counts = np.zeros((1 << SKETCH_BITS) // SKETCH_PARTS, np.uint32)
        for x in t.column("counts"):
            counts += np.frombuffer(zlib.decompress(x.as_py()), np.uint32)
        return counts

    def add(key, t):
        return pa.table({"part": pa.array([key[0].as_py()], pa.int32()), "bits": pa.array([np.packbits(total_of(t) > limit).tobytes()], pa.binary())})

    # sums of a few parts by salt first, so that no task gets all tasks' rows of a part
    def presum(key, t):
        return pa.table({"part": pa.array([key[0].as_py()], pa.int32()), "counts": pa.array([zlib.compress(total_of(t).tobytes(), 1)], pa.binary())})

    some = sketch.withColumn("salt", F.pmod(F.xxhash64("counts"), F.lit(8))).groupBy("part", "salt").applyInArrow(presum, "part int, counts binary")
    size = (1 << SKETCH_BITS) // SKETCH_PARTS // 8
    out = bytearray(size * SKETCH_PARTS)
    for r in some.groupBy("part").applyInArrow(add, "part int, bits binary").collect():
        out[r["part"] * size : (r["part"] + 1) * size] = r["bits"]
    return bytes(out)


def _postings(docs: DataFrame, text: str, words: int, percent: int, salt: int, bits: bytes) -> DataFrame:
    """(sig, node, meta) of every set."""
    shared = docs.sparkSession.sparkContext.broadcast(bits)
    schema = docs.sparkSession.createDataFrame([], "sig long, node long, meta long").schema
    arrow = arrow_schema(schema)

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often = np.unpackbits(np.frombuffer(shared.value, np.uint8)).view(bool)
        shift, seen = _U(64 - SKETCH_BITS), set()
        sigs, nodes, metas, size = [], [], [], 0

        def packed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).view(np.int64)) for x in (sigs, nodes, metas)], schema=arrow)

        for b in batches:
            for t in b.column(0):
                s = shingles(t.as_py(), words)
                if not len(s):
                    continue
                node = node_of(s, salt)[0]
                if node in seen:
                    continue
                if len(seen) >= REMEMBERED:
                    seen.clear()
                seen.add(node)
                sig, singles, last, share = signatures(s, often[(s >> shift).astype(np.int64)], percent)
                meta = np.full(len(sig), _pack_meta(len(s), last, singles, share), _U)
                meta[singles:] |= _U(1)
                sigs.append(sig)
                nodes.append(np.full(len(sig), node, np.int64).view(_U))
                metas.append(meta)
                size += len(sig)
                if size >= 200_000:
                    yield packed()
                    sigs, nodes, metas, size = [], [], [], 0
        if size:
            yield packed()

    return docs.select(F.col(text).cast("string")).mapInArrow(run, schema)


def _sets(docs: DataFrame, text: str, words: int, salt: int) -> DataFrame:
    schema = docs.sparkSession.createDataFrame([], "node long, tokens array<long>").schema
    arrow = arrow_schema(schema)

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            nodes, sets, size = [], [], 0
            for t in b.column(0):
                s = shingles(t.as_py(), words)
                if len(s):
                    nodes.append(node_of(s, salt)[0])
                    sets.append(s.view(np.int64))
                    size += len(s)
                if size >= FLUSH_CHARS // 8:
                    yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(sets, pa.list_(pa.int64()))], schema=arrow)
                    nodes, sets, size = [], [], 0
            if nodes:
                yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(sets, pa.list_(pa.int64()))], schema=arrow)

    return docs.select(F.col(text).cast("string")).mapInArrow(run, schema)


def _verified(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, key: str, text: str, words: int, percent: int, salt: int, made: list[DataFrame]) -> DataFrame:
    """Of the pairs (u, v), those that link, by their exact sets. Only documents that stand for a node of a pair are read into sets. made takes the tables that the result reads."""
    named = pairs.select(F.col("u").alias("node")).union(pairs.select(F.col("v").alias("node"))).distinct()
    named = staged(named.join(nodes.select("node", "doc"), "node"), "named")
    few = with_size_check(named.select(F.col("doc").alias("_d")).distinct(), BROADCAST_ROWS)
    held = docs.join(few, F.col(key).eqNullSafe(F.col("_d")), "left_semi")
    sets = staged(_sets(held, text, words, salt).join(with_size_check(named.select("node"), BROADCAST_ROWS), "node", "left_semi").dropDuplicates(["node"]), "sets")
    made += [named, sets]
    a = sets.select(F.col("node").alias("u"), F.col("tokens").alias("a"))
    b = sets.select(F.col("node").alias("v"), F.col("tokens").alias("b"))
    both = pairs.select("u", "v").join(a, "u").join(b, "v").select("u", "v", F.size("a").alias("na"), F.size("b").alias("nb"), F.size(F.array_intersect("a", "b")).alias("both"))
    return both.where(F.lit(100) * F.col("both") >= F.lit(percent) * (F.col("na") + F.col("nb") - F.col("both"))).select("u", "v")


def _fits(x: str, y: str, percent: int):
    """Whether two members of a bucket can link by sizes, caps and bitmaps; columns n, last, cap and b0.. with the prefixes x and y."""
    nx, ny = F.col(f"{x}n"), F.col(f"{y}n")
    by_x, by_y = ny <= F.col(f"{x}cap"), nx <= F.col(f"{y}cap")
    lx, ly = F.col(f"{x}last"), F.col(f"{y}last")
    top = F.lit(0xFFFF)
    caps = F.when((lx == ly) & (lx == top), by_x & by_y).when(lx < ly, by_x).when(lx > ly, by_y).otherwise(by_x | by_y)
    # sets that link differ in at most so many tokens: both sizes less twice the least intersection
    least = F.ceil(percent * (nx + ny) / (100 + percent))
    differ = sum((F.bit_count(F.col(f"{x}b{i}").bitwiseXOR(F.col(f"{y}b{i}"))) for i in range(BITMAP)), F.lit(0))
    return (100 * nx >= percent * ny) & (100 * ny >= percent * nx) & caps & (differ <= nx + ny - 2 * least)


def jaccard_components(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """key, n_shingles and component_id (smallest key of the component) of every row of docs."""
    bits_of = [f"b{i}" for i in range(BITMAP)]
    for salt in range(8):
        scanned = staged(_scan_sets(docs, key, text, words, salt), "scan")
        rows = scanned.where(F.col("part").isNull())
        nodes = staged(rows.where("n > 0").groupBy("node", "more").agg(F.min("doc").alias("doc"), F.first("n").alias("n"), *[F.first(b).alias(b) for b in bits_of]), "nodes")
        sums = nodes.agg(F.sum("n"), F.count("*"), F.countDistinct("node")).first()
        if sums[1] == sums[2]:
            break
    else:
        raise RuntimeError("node ids clash under every salt")
    if not sums[1]:
        return rows.select(F.col("doc").alias(key), F.col("n").alias("n_shingles"), F.col("doc").alias("component_id"))
    bits = _frequent_bits(scanned.where(F.col("part").isNotNull()).select("part", "counts"), sums[0])

    found = _postings(docs, text, words, percent, salt, bits)
    w = Window.partitionBy("sig").orderBy(_field("meta", "share"), "node")
    once = found.withColumn("_prev", F.lag("node").over(w)).where(F.col("_prev").isNull() | (F.col("_prev") != F.col("node"))).drop("_prev")
    head = F.struct("node", "meta")
    members = once.withColumn("hub", F.first(head).over(w)).withColumn("_next", F.lead("node").over(w))
    members = members.where((F.col("hub.node") != F.col("node")) | F.col("_next").isNotNull())
    members = staged(members.select("sig", "node", "meta", F.col("hub.node").alias("hub")), "members")

    # of a node's single tokens, those that nobody else has indexed
    info = members.groupBy("node").agg(F.first("meta").alias("meta"), F.sum(1 - _field("meta", "pair")).alias("shared"))
    n, alone = _field("meta", "n"), F.greatest(_field("meta", "singles") - F.col("shared"), F.lit(0))
    # intersection >= percent / (100 + percent) * (both sizes), and intersection <= n - alone
    cap = F.floor((n - alone) * (100 + percent) / percent) - n
    info = info.select("node", n.alias("n"), _field("meta", "last").alias("last"), cap.alias("cap")).where(F.col("cap") * 100 >= F.col("n") * percent)
    info = staged(info.join(nodes.select("node", *bits_of), "node"), "info")
    facts = ["n", "last", "cap", *bits_of]

    def described(df: DataFrame, on: str, prefix: str) -> DataFrame:
        return df.join(info.select(F.col("node").alias(on), *[F.col(c).alias(prefix + c) for c in facts]), on)

    stars = members.where("node <> hub").select(F.col("node").alias("u"), F.col("hub").alias("v")).distinct()
    stars = staged(described(described(stars, "u", "a_"), "v", "b_").where(_fits("a_", "b_", percent)).select("u", "v"), "stars")
    made: list[DataFrame] = []
    verify = lambda pairs: _verified(pairs, docs, nodes, key, text, words, percent, salt, made)
    links = staged(verify(stars), "links")
    discard(*made)
    made.clear()
    roots = staged(components(links), "roots")

    # pairs across components: members outside their hub's component against all members of the bucket
    placed = members.select("sig", "node", "hub").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    placed = described(placed, "node", "").join(roots.select(F.col("node").alias("hub"), F.col("root").alias("hub_root")), "hub", "left")
    placed = staged(placed.withColumn("stray", F.col("root") != F.coalesce("hub_root", "hub")).select("sig", "node", "root", "stray", *facts), "placed")
    # buckets with the same members offer the same pairs: one of them is enough; those without strays offer none
    mark = F.xxhash64("node", F.lit(1)).cast("decimal(20,0)")
    same = placed.groupBy("sig").agg(F.count("*").alias("c"), F.sum(mark).alias("x"), F.bit_xor(F.xxhash64("node", F.lit(2))).alias("y"), F.max("stray").alias("any"))
    kept = same.where("any").groupBy("c", "x", "y").agg(F.min("sig").alias("sig")).select("sig")
    whole, placed = placed, staged(placed.join(kept, "sig", "left_semi"), "across")
    discard(whole)
    left = placed.where("stray").select("sig", *[F.col(c).alias("a_" + c) for c in ("node", "root", *facts)])
    right = placed.select("sig", *[F.col(c).alias("b_" + c) for c in ("node", "root", "stray", *facts)])
    across = left.join(right, (left["sig"] == right["sig"]) & (F.col("a_root") != F.col("b_root")) & (~F.col("b_stray") | (F.col("a_node") < F.col("b_node"))) & _fits("a_", "b_", percent))
    across = across.select(F.least("a_node", "b_node").alias("u"), F.greatest("a_node", "b_node").alias("v")).distinct()
    done = stars.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
    across = staged(across.join(done, ["u", "v"], "left_anti"), "across")
    every = links.union(verify(across))
    before, roots = roots, staged(components(every), "roots")
    discard(members, info, stars, links, placed, across, before, *made)

    linked = nodes.join(roots, "node", "left").select("node", "doc", F.coalesce("root", "node").alias("root"))
    least = linked.groupBy("root").agg(F.min("doc").alias("component_id"))
    of_node = linked.join(least, "root").select("node", "component_id")
    full = rows.where("n > 0").join(of_node, "node").select("doc", "n", "component_id")
    return full.union(rows.where("n = 0").select("doc", "n", F.col("doc").alias("component_id"))).select(F.col("doc").alias(key), F.col("n").alias("n_shingles"), "component_id")


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(read_table(spark, sf_dir, "documents"))


OP9_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE [array_to_string(w[i : i + 4], ' ') for i in range(1, len(w) - 3)] END) AS sh FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 80 * (a.n + b.n - c)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r AS (SELECT doc_id, doc_id AS root FROM documents UNION SELECT r.doc_id, e.y FROM r JOIN e ON e.x = r.root)
SELECT r.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(root) AS component_id FROM r LEFT JOIN n ON n.doc_id = r.doc_id GROUP BY r.doc_id
"""
