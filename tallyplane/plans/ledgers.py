"""Queries of axes, ledgers, captions and digests over the driver's tables, each with SQL of its own."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import captions as C
from ..functions import scalars as S
from ..operators import association as A
from ..operators import axes as X
from ..operators import ledger as L
from ..operators import matching as M
from ..operators import relate as R
from ..operators import review as V
from ..operators import rules as Q
from ..operators import tiers as T
from ..sources import manifests as N
from .catalog import query, t

# --- axes: brands stand for axes, sizes for labels' pixels

_TICKS = "SELECT p_brand AS axis, CAST(p_size AS DOUBLE) AS px, CASE WHEN p_size % 11 = 0 THEN 1000.0 ELSE 10.0 * min(p_size) END AS v FROM part GROUP BY p_brand, p_size"


def _ticks(spark, d):
    p = t(spark, d, "part")
    return p.select(F.col("p_brand").alias("axis"), F.col("p_size").alias("s")).distinct().select("axis", F.col("s").cast("double").alias("px"), F.when(F.col("s") % 11 == 0, 1000.0).otherwise(10.0 * F.col("s")).alias("v"))


@query(f"""WITH k AS ({_TICKS}), o AS (SELECT *, row_number() OVER (PARTITION BY axis ORDER BY px) AS i FROM k), r AS (SELECT a.axis, a.i AS lo, b.i AS hi, a.px AS p0, b.px AS p1 FROM o a JOIN o b ON a.axis = b.axis AND b.i >= a.i + 2),
s AS (SELECT x.axis, x.i, (x.v - y.v) / (x.px - y.px) AS rate, x.v - y.v AS dv FROM o x JOIN o y ON x.axis = y.axis AND x.i = y.i + 1),
g AS (SELECT r.axis, lo, hi, p0, p1, stddev_pop(rate) / abs(avg(rate)) AS cv, min(dv) AS least, max(dv) AS most FROM r JOIN s ON s.axis = r.axis AND s.i > lo AND s.i <= hi GROUP BY 1, 2, 3, 4, 5),
w AS (SELECT *, hi - lo + 1 AS labels FROM g WHERE cv <= 0.08 AND (least > 0 OR most < 0)), m AS (SELECT *, max(labels) OVER (PARTITION BY axis) AS top FROM w) SELECT axis, any_value(labels) AS labels, count(*) AS n_longest, min(p0) AS first_px, min(p1) AS last_px FROM m WHERE labels = top GROUP BY 1""")
def longest_ladder(spark, d):
    """Labels that step evenly but for those that were misread."""
    return X.longest_ladder(_ticks(spark, d), ["axis"], "px", "v")


@query("""WITH g AS (SELECT p_brand AS axis, p_size AS px, CAST(p_size * 2 + CASE WHEN ascii(right(p_brand, 1)) % 2 = 0 THEN 0 ELSE p_size % 5 END AS DOUBLE) AS v FROM part GROUP BY 1, 2), s AS (SELECT axis, v - lag(v) OVER w AS dv, px - lag(px) OVER w AS dp FROM g WINDOW w AS (PARTITION BY axis ORDER BY px))
SELECT axis, count(*) + 1 AS labels, round(stddev_pop(dv / dp) / abs(avg(dv / dp)), 5) AS cv, count(*) >= 2 AND min(dv) > 0 AND coalesce(stddev_pop(dv / dp) / abs(avg(dv / dp)) <= 0.08, false) AS is_ladder FROM s WHERE dp IS NOT NULL GROUP BY 1""")
def x_ladder(spark, d):
    p = t(spark, d, "part").select(F.col("p_brand").alias("axis"), F.col("p_size").alias("px")).distinct()
    v = F.col("px") * 2 + F.when(F.ascii(F.right("axis", F.lit(1))) % 2 == 0, 0).otherwise(F.col("px") % 5)
    return X.x_ladder(p.withColumn("v", v.cast("double")), ["axis"], "px", "v").withColumn("cv", F.round("cv", 5))


@query("""WITH k AS (SELECT s_suppkey AS axis, s_suppkey % 4 AS kind FROM supplier), i AS (SELECT unnest(range(6)) AS i), tk AS (SELECT axis, 100.0 + 40 * i + CASE WHEN kind = 3 AND i = 2 THEN 15 ELSE 0 END AS y FROM k, i),
lb AS (SELECT axis, kind, 100.0 + 40 * i + CASE WHEN kind = 2 AND i = 1 THEN 9 ELSE 2 END AS px, CASE WHEN kind = 1 AND i = 3 THEN 90.0 ELSE 100.0 - 10 * i END AS v FROM k, i WHERE i < 5)
SELECT axis, CASE kind WHEN 0 THEN 'CONSISTENT' WHEN 1 THEN 'CONTRADICTED' WHEN 2 THEN 'OFF_GRID' ELSE 'UNMEASURED' END AS verdict FROM k""")
def grid_verdict(spark, d):
    """Axes of four kinds: even, one label misread, one label off the grid, one tick off it."""
    k = t(spark, d, "supplier").select(F.col("s_suppkey").alias("axis"), (F.col("s_suppkey") % 4).alias("kind")).withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(5))))
    ticks = k.select("axis", (100.0 + 40 * F.col("i") + F.when((F.col("kind") == 3) & (F.col("i") == 2), 15).otherwise(0)).alias("y"))
    off = F.when((F.col("kind") == 2) & (F.col("i") == 1), 9).otherwise(2)
    labels = k.where("i < 5").select("axis", (100.0 + 40 * F.col("i") + off).alias("px"), F.when((F.col("kind") == 1) & (F.col("i") == 3), 90.0).otherwise(100.0 - 10 * F.col("i")).alias("v"))
    return X.grid_verdict(labels, ticks, ["axis"], "px", "v", "y")


@query("SELECT l_suppkey, l_linenumber AS v, max(l_quantity) AS confidence FROM lineitem GROUP BY 1, 2")
def best_per_value(spark, d):
    li = t(spark, d, "lineitem").select("l_suppkey", F.col("l_linenumber").alias("v"), F.col("l_quantity").alias("confidence"), "l_orderkey")
    return X.best_per_value(li, ["l_suppkey"], "v", "confidence", ["l_orderkey"]).select("l_suppkey", "v", "confidence")


@query("""SELECT s_suppkey AS axis, CAST(CASE s_suppkey % 3 WHEN 0 THEN 1 WHEN 1 THEN 0 ELSE 2 END AS BIGINT) AS n_ladders, CASE WHEN s_suppkey % 3 = 0 THEN '0.0:30.0,40.0:20.0,80.0:10.0' END AS pairs FROM supplier""")
def chosen_values(spark, d):
    """Readings of three ticks of which one, none or two combinations are ladders."""
    k = F.col("s_suppkey") % 3
    reads = F.when(k == 0, F.expr("array(struct(0d, 30d), struct(40d, 20d), struct(40d, 70d), struct(80d, 10d), struct(80d, 16d))")).when(k == 1, F.expr("array(struct(0d, 30d), struct(40d, 70d), struct(80d, 16d))")).otherwise(F.expr("array(struct(0d, 30d), struct(40d, 20d), struct(40d, 40d), struct(80d, 10d), struct(80d, 50d))"))
    rows = t(spark, d, "supplier").select(F.col("s_suppkey").alias("axis"), F.explode(reads).alias("r")).select("axis", F.col("r.col1").alias("px"), F.col("r.col2").alias("v"))
    pairs = F.array_join(F.transform("pairs", lambda x: F.concat_ws(":", x["px"].cast("string"), x["value"].cast("string"))), ",")
    return X.chosen_values(rows, ["axis"], "px", "v").select("axis", "n_ladders", pairs.alias("pairs"))


@query("""WITH c AS (SELECT DISTINCT p_brand AS panel, p_size - p_size % 5 AS x FROM part), g AS (SELECT *, x - lag(x) OVER (PARTITION BY panel ORDER BY x) AS gap FROM c) SELECT panel, count(*) AS n, round(stddev_pop(gap) / avg(gap), 6) AS cv, coalesce(count(*) = 11 AND min(gap) > 0 AND stddev_pop(gap) / avg(gap) <= 0.05, false) AS even FROM g GROUP BY 1""")
def category_spacing(spark, d):
    c = t(spark, d, "part").select(F.col("p_brand").alias("panel"), (F.col("p_size") - F.col("p_size") % 5).alias("x")).distinct()
    return X.category_spacing(c, ["panel"], "x", F.lit(11)).withColumn("cv", F.round("cv", 6))


@query("""WITH a AS (SELECT p_brand AS b, CAST(p_size AS DOUBLE) AS px, p_retailprice AS v FROM part WHERE p_partkey % 2 = 0), c AS (SELECT p_brand AS b, CAST(p_size AS DOUBLE) AS px, p_retailprice AS v FROM part WHERE p_partkey % 2 = 1),
f AS (SELECT b, regr_slope(v, px) AS ps, regr_intercept(v, px) AS pi FROM c GROUP BY 1), h AS (SELECT b, regr_slope(v, px) AS ts FROM a GROUP BY 1)
SELECT a.b AS panel, round(max(abs(ps * px + pi - v)), 4) AS max_abs, round(max(abs(ps * px + pi - v)) / nullif(max(v) - min(v), 0), 5) AS max_rel, round(any_value(abs(ps - ts) / abs(ts)), 4) AS slope_rel_err FROM a JOIN f USING (b) JOIN h USING (b) WHERE isfinite(ps) AND isfinite(ts) AND ps <> 0 AND ts <> 0 GROUP BY 1""")
def transfer_error(spark, d):
    p = t(spark, d, "part").select(F.col("p_brand").alias("panel"), F.col("p_size").cast("double").alias("px"), F.col("p_retailprice").alias("v"), "p_partkey")
    e = X.transfer_error(p.where("p_partkey % 2 = 0"), p.where("p_partkey % 2 = 1"), ["panel"], "px", "v")
    return e.select("panel", F.round("max_abs", 4).alias("max_abs"), F.round("max_rel", 5).alias("max_rel"), F.round("slope_rel_err", 4).alias("slope_rel_err"))


@query("""SELECT o_orderkey AS k, CASE WHEN o_orderpriority = '1-URGENT' OR o_orderstatus = 'P' THEN 'UNKNOWN' WHEN o_orderkey % 3 = 0 OR o_orderpriority IN ('2-HIGH', '3-MEDIUM') OR o_custkey % 5 = 0 THEN 'INELIGIBLE' ELSE 'ELIGIBLE' END AS eligibility FROM orders""")
def scale_eligibility(spark, d):
    geometry = F.when(F.col("o_orderpriority") == "1-URGENT", "").when(F.col("o_orderpriority") == "2-HIGH", "FALLBACK_LONGEST").otherwise("SPINE")
    whole = F.when(F.col("o_orderpriority") == "3-MEDIUM", "FRAGMENT").otherwise("WHOLE")
    broken = F.when(F.col("o_orderstatus") == "P", F.lit(None)).when(F.col("o_custkey") % 5 == 0, "BROKEN").otherwise("NONE")
    return t(spark, d, "orders").select(F.col("o_orderkey").alias("k"), X.scale_eligibility(F.col("o_orderkey") % 3 != 0, geometry, whole, broken).alias("eligibility"))


@query("""SELECT o_custkey AS panel, o_orderkey AS series, CASE WHEN r IS NULL THEN CAST(o_custkey % 200 AS VARCHAR) END AS axis, r AS refusal FROM (SELECT o_custkey, o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN 'SERIES_AXIS_NOT_DECLARED' WHEN c_custkey IS NULL THEN 'SERIES_AXIS_NOT_IN_MANIFEST' WHEN c_nationkey % 4 = 0 THEN 'SERIES_AXIS_WRONG_DIMENSION' WHEN c_custkey <> o_custkey THEN 'SERIES_AXIS_WRONG_PANEL' END AS r FROM orders LEFT JOIN customer ON c_custkey = o_custkey % 200)""")
def series_axis(spark, d):
    series = t(spark, d, "orders").select(F.col("o_custkey").alias("panel"), F.col("o_orderkey").alias("series"), F.when(F.col("o_orderkey") % 11 == 0, "").otherwise((F.col("o_custkey") % 200).cast("string")).alias("axis"))
    axes = t(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("axis"), F.when(F.col("c_nationkey") % 4 == 0, "x").otherwise("y").alias("dimension"), F.col("c_custkey").alias("panel"))
    return X.series_axis(series, axes)


@query("""WITH f AS (SELECT n_regionkey AS raster, n_nationkey AS k, n_nationkey * 100 AS x0, n_nationkey * 100 + 90 AS x1, CASE WHEN n_nationkey % 5 = 0 THEN 30 ELSE 10 END AS y0, 210 AS y1, n_nationkey % 3 = 0 AS read, n_nationkey % 4 AS ticks FROM nation)
SELECT a.raster, a.k, arg_max(b.k, b.x0) AS candidate FROM f a JOIN f b ON a.raster = b.raster AND NOT a.read AND b.ticks >= 2 AND a.k <> b.k AND b.x1 <= a.x0 + 9 AND greatest(abs(a.y0 - b.y0), abs(a.y1 - b.y1)) <= 0.02 * least(a.y1 - a.y0, b.y1 - b.y0) GROUP BY 1, 2""")
def shared_axis(spark, d):
    k = F.col("n_nationkey")
    f = t(spark, d, "nation").select(F.col("n_regionkey").alias("raster"), k.alias("k"), (k * 100).alias("x0"), (k * 100 + 90).alias("x1"), F.when(k % 5 == 0, 30).otherwise(10).alias("y0"), F.lit(210).alias("y1"), (k % 3 == 0).alias("read"), (k % 4).alias("ticks"))
    return X.shared_axis_candidates(f, ["raster"], "k").select("raster", "k", "candidate")


@query("""WITH a AS (SELECT DISTINCT p_brand AS g, p_size AS a FROM part WHERE p_partkey % 2 = 0), b AS (SELECT DISTINCT p_brand AS g, p_size AS b FROM part WHERE p_partkey % 3 = 0), p AS (SELECT g, a, b, abs(a - b) AS d, row_number() OVER (PARTITION BY g, a ORDER BY abs(a - b), b) AS ra, row_number() OVER (PARTITION BY g, b ORDER BY abs(a - b), a) AS rb FROM a JOIN b USING (g)),
m AS (SELECT g, count_if(ra = 1 AND rb = 1) AS matched, max(CASE WHEN ra = 1 AND rb = 1 THEN d END) AS matched_max, max(CASE WHEN ra = 1 OR rb = 1 THEN d END) AS symmetric_max FROM p GROUP BY 1), na AS (SELECT g, count(*) AS n FROM a GROUP BY 1), nb AS (SELECT g, count(*) AS n FROM b GROUP BY 1)
SELECT coalesce(na.g, nb.g) AS p_brand, coalesce(matched, 0) AS matched, coalesce(na.n, 0) - coalesce(matched, 0) AS left_unmatched, coalesce(nb.n, 0) - coalesce(matched, 0) AS right_unmatched, symmetric_max, matched_max FROM na FULL JOIN nb ON na.g = nb.g LEFT JOIN m ON m.g = coalesce(na.g, nb.g)""")
def match_summary(spark, d):
    p = t(spark, d, "part")
    return R.match_summary(p.where("p_partkey % 2 = 0").select("p_brand", F.col("p_size").alias("a")), p.where("p_partkey % 3 = 0").select("p_brand", F.col("p_size").alias("b")), ["p_brand"], "a", "b")


# --- associations of odd groups

_ODD = "SELECT o_custkey % 3 AS g, CAST(CASE o_custkey % 3 WHEN 0 THEN 5 ELSE o_orderkey % 97 END AS DOUBLE) AS x, CAST(CASE o_custkey % 3 WHEN 1 THEN 2 * (o_orderkey % 97) + 1 ELSE o_custkey % 13 END AS DOUBLE) AS y, o_orderkey AS k FROM orders"


@query(f"""WITH r AS ({_ODD}), c AS (SELECT g, x, y, count(*) AS n FROM r GROUP BY 1, 2, 3), p AS (SELECT a.g, sum(CASE WHEN (a.x - b.x) * (a.y - b.y) > 0 THEN a.n * b.n ELSE 0 END) / 2 AS con, sum(CASE WHEN (a.x - b.x) * (a.y - b.y) < 0 THEN a.n * b.n ELSE 0 END) / 2 AS dis, sum(CASE WHEN a.x = b.x AND a.y <> b.y THEN a.n * b.n ELSE 0 END) / 2 AS tx, sum(CASE WHEN a.x <> b.x AND a.y = b.y THEN a.n * b.n ELSE 0 END) / 2 AS ty FROM c a JOIN c b ON a.g = b.g GROUP BY 1)
SELECT g, CAST(con AS BIGINT) AS concordant, CAST(dis AS BIGINT) AS discordant, CAST(tx AS BIGINT) AS ties_x, CAST(ty AS BIGINT) AS ties_y, CASE WHEN g > 0 THEN round((con - dis) / sqrt((con + dis + tx) * (con + dis + ty)), 6) END AS tau_b, CASE WHEN g = 1 THEN 0.0 END AS slope_p FROM p""")
def association_odd_groups(spark, d):
    """One group with one side all tied, one on a line, one ordinary: no coefficient, p = 0, and an ordinary one."""
    r = spark.sql(_ODD.replace("FROM orders", "FROM {orders}"), orders=t(spark, d, "orders"))
    m = A.moments(r, ["g"], "x", "y")
    j = A.kendall(r, ["g"], "x", "y", "k").join(m.select("g", F.when(F.col("g") == 1, F.round(A.slope_p(F.col("slope"), F.round("slope_se", 9), F.col("n")), 6)).alias("slope_p")), "g")
    return j.withColumn("tau_b", F.round("tau_b", 6)).select("g", "concordant", "discordant", "ties_x", "ties_y", "tau_b", "slope_p")


# --- ledgers


@query("""WITH l AS (SELECT user_id, event_type, max(event_id) AS e FROM events GROUP BY 1, 2) SELECT o_orderkey, e AS last_event FROM orders LEFT JOIN l ON user_id = o_custkey AND event_type = CASE o_orderstatus WHEN 'F' THEN 'click' ELSE 'view' END""")
def last_trace_row(spark, d):
    probes = t(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("user_id"), F.when(F.col("o_orderstatus") == "F", "click").otherwise("view").alias("event_type"))
    return L.last_match(probes, t(spark, d, "events").withColumn("event", F.col("event_id")), ["user_id", "event_type"], "event_id", "event").select("o_orderkey", "last_event")


@query("SELECT event_type AS kind, CASE WHEN value > 50 THEN 'HIGH' ELSE '' END AS outcome, count(*) AS n FROM events GROUP BY 1, 2")
def trace_counts(spark, d):
    return L.counts(t(spark, d, "events").select(F.col("event_type").alias("kind"), F.when(F.col("value") > 50, "HIGH").alias("outcome")), "kind", "outcome")


@query("""WITH p AS (SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN 'EMAIL:n' || (s_suppkey % 4) || '@x.org' WHEN s_suppkey % 3 = 1 THEN 'ORCID:0000-0002-1825-009' || (CASE WHEN s_suppkey % 2 = 0 THEN '7' ELSE '1' END) END AS person FROM supplier) SELECT s_suppkey AS reviewer, person, coalesce(person = 'ORCID:0000-0002-1825-0097', false) AS provable FROM p""")
def person_keys(spark, d):
    k = F.col("s_suppkey")
    contact = F.when(k % 3 == 0, F.concat(F.lit("N"), (k % 4).cast("string"), F.lit("@X.org"))).when(k % 3 == 1, F.concat(F.lit("0000-0002-1825-009"), F.when(k % 2 == 0, "7").otherwise("1"))).otherwise("")
    return L.person_keys(t(spark, d, "supplier").select(k.alias("reviewer"), F.when(k % 3 == 0, "email").otherwise("orcid").alias("contact_type"), contact.alias("contact")))


@query("""WITH r AS (SELECT s_suppkey, CASE WHEN s_suppkey % 5 = 0 THEN '' ELSE 'a' || (s_suppkey % 3) || '@x' END AS c, FALSE AS ok FROM supplier), l AS (SELECT DISTINCT l_orderkey AS panel, l_suppkey AS s, l_linenumber AS n FROM lineitem),
j AS (SELECT a.panel, a.s AS x, b.s AS y, ra.c AS cx, rb.c AS cy FROM l a JOIN l b ON a.panel = b.panel AND a.n = 1 AND b.n = 2 LEFT JOIN r ra ON ra.s_suppkey = a.s LEFT JOIN r rb ON rb.s_suppkey = b.s)
SELECT DISTINCT panel, CASE WHEN x = y OR (cx = cy AND cx <> '') THEN 'RESOLVER_IS_APPROVER' ELSE 'REVIEWER_IDENTITY_UNPROVABLE' END AS code FROM j""")
def separation(spark, d):
    """First and second lines of an order stand for who resolved and who approved; an e-mail address proves nothing."""
    li = t(spark, d, "lineitem")
    side = lambda n: li.where(F.col("l_linenumber") == n).select(F.col("l_orderkey").alias("panel"), F.col("l_suppkey").alias("reviewer"))
    k = F.col("s_suppkey")
    people = t(spark, d, "supplier").select(k.alias("reviewer"), F.lit("EMAIL").alias("contact_type"), F.when(k % 5 == 0, "").otherwise(F.concat(F.lit("a"), (k % 3).cast("string"), F.lit("@x"))).alias("contact"))
    return L.separation_problems(side(1), side(2), people)


@query("SELECT 'DEMO_ONLY' AS run_mode, CASE WHEN count_if(o_orderstatus = 'F') > 0 AND count_if(o_orderstatus <> 'F') > 0 THEN 'PARTIAL' END AS bytes_bound FROM orders")
def run_mode(spark, d):
    o = t(spark, d, "orders")
    people = t(spark, d, "supplier").select(F.col("s_suppkey").cast("string").alias("reviewer"), F.when(F.col("s_suppkey") == 1, "demo_identity").otherwise("PERSON").alias("record_type"))
    used = t(spark, d, "lineitem").select(F.col("l_suppkey").cast("string").alias("reviewer"))
    docs = o.select(F.when(F.col("o_orderstatus") == "F", F.sha2(F.col("o_orderkey").cast("string"), 256)).otherwise("NOT_HELD").alias("sha"))
    return L.run_mode(people, used).join(L.bytes_bound(docs, "sha"), F.lit(True))


@query("""SELECT a.l_orderkey * 10 + a.l_linenumber AS k, arg_min(b.l_orderkey * 10 + b.l_linenumber, b.l_orderkey * 10 + b.l_linenumber) AS twin, arg_min(b.l_linenumber, b.l_orderkey * 10 + b.l_linenumber) AS twin_page FROM lineitem a JOIN lineitem b ON a.l_suppkey = b.l_suppkey AND a.l_partkey = b.l_partkey AND abs(a.l_linenumber - b.l_linenumber) = 1 GROUP BY 1""")
def adjacent_twins(spark, d):
    li = t(spark, d, "lineitem").select("l_suppkey", "l_partkey", F.col("l_linenumber").alias("page"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("k"))
    return L.adjacent_twins(li.withColumn("o", F.col("k")), ["l_suppkey", "l_partkey"], "page", "k", "o")


@query("""WITH r AS (SELECT doc_id, sha256(text) AS h FROM documents), n AS (SELECT h, count(*) AS n, min(doc_id) AS least FROM r GROUP BY 1), d AS (SELECT doc_id AS loser, least AS winner FROM r JOIN n USING (h) WHERE doc_id <> least AND doc_id % 2 = 0), x AS (SELECT unnest([loser, winner]) AS doc_id FROM d), k AS (SELECT doc_id, count(*) AS c FROM x GROUP BY 1)
SELECT doc_id, n - 1 - coalesce(c, 0) AS n_others FROM r JOIN n USING (h) LEFT JOIN k USING (doc_id) WHERE n - 1 - coalesce(c, 0) > 0""")
def shared_crops(spark, d):
    """Equal texts stand for equal crops; every other copy is a known duplicate of the first."""
    r = t(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("h"))
    least = r.groupBy("h").agg(F.min("doc_id").alias("winner"))
    dup = r.join(least, "h").where("doc_id <> winner and doc_id % 2 = 0").select(F.col("doc_id").alias("loser"), "winner")
    return L.shared_crops(r, dup, "doc_id", "h")


@query("SELECT o_orderkey, CASE WHEN c_nationkey < 5 THEN o_custkey + 1000000 ELSE o_custkey END AS panel FROM orders LEFT JOIN customer ON c_custkey = o_custkey")
def moved_panels(spark, d):
    moves = t(spark, d, "customer").where("c_nationkey < 5").select(F.col("c_custkey").alias("old"), (F.col("c_custkey") + 1_000_000).alias("new"))
    return L.moved(t(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("panel")), moves, ["panel"])


@query("""WITH m AS (SELECT o_orderkey AS old, CASE o_orderkey % 3 WHEN 0 THEN o_custkey ELSE -o_orderkey END AS new FROM orders), k AS (SELECT DISTINCT c_custkey AS old FROM customer)
SELECT old, 'MOVE_OF_UNKNOWN' AS code FROM m WHERE old NOT IN (SELECT old FROM k) UNION ALL SELECT old, 'MOVE_ONTO_EXISTING' FROM m WHERE new IN (SELECT old FROM k WHERE old NOT IN (SELECT old FROM m)) UNION ALL SELECT old, 'TWO_MOVES_ONTO_ONE' FROM (SELECT *, count(*) OVER (PARTITION BY new) AS n FROM m) WHERE n > 1""")
def move_problems(spark, d):
    moves = t(spark, d, "orders").select(F.col("o_orderkey").alias("old"), F.when(F.col("o_orderkey") % 3 == 0, F.col("o_custkey")).otherwise(-F.col("o_orderkey")).alias("new"))
    return L.move_problems(t(spark, d, "customer").select(F.col("c_custkey").alias("panel")), moves, "panel")


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 48)")
def all_or_nothing(spark, d):
    return L.all_or_nothing(t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity"), ["l_orderkey"], F.col("l_quantity") > 48).select("l_orderkey", "l_linenumber")


@query("""WITH a AS (SELECT DISTINCT l_partkey AS p, l_returnflag AS f FROM lineitem WHERE l_linenumber <= 2), b AS (SELECT DISTINCT l_partkey AS p, l_returnflag AS f FROM lineitem WHERE l_linenumber > 2), j AS (SELECT coalesce(a.p, b.p) AS p, coalesce(a.f, b.f) AS f, a.f IS NOT NULL AS ia, b.f IS NOT NULL AS ib FROM a FULL JOIN b ON a.p = b.p AND a.f = b.f)
SELECT p AS l_partkey, coalesce(string_agg(CASE WHEN ia AND ib THEN f END, ',' ORDER BY f), '') AS both, coalesce(string_agg(CASE WHEN ia AND NOT ib THEN f END, ',' ORDER BY f), '') AS only_declared, coalesce(string_agg(CASE WHEN ib AND NOT ia THEN f END, ',' ORDER BY f), '') AS only_detected FROM j GROUP BY 1""")
def declared_and_detected(spark, d):
    li = t(spark, d, "lineitem").select("l_partkey", "l_returnflag", "l_linenumber")
    s = L.declared_and_detected(li.where("l_linenumber <= 2"), li.where("l_linenumber > 2"), ["l_partkey"], "l_returnflag")
    return s.select("l_partkey", *[F.array_join(c, ",").alias(c) for c in ("both", "only_declared", "only_detected")])


@query("""SELECT o_custkey AS panel, count_if(o_orderpriority IN ('1-URGENT', '2-HIGH')) AS n_inferred, count_if(o_orderpriority = '1-URGENT') AS n_cells, count_if(o_orderpriority IN ('1-URGENT', '2-HIGH')) > 0 AS panel_needed, count_if(o_orderpriority = '1-URGENT') > 0 AS cell_needed FROM orders GROUP BY 1""")
def confirmations(spark, d):
    tier = F.when(F.col("o_orderpriority") == "1-URGENT", "R3").when(F.col("o_orderpriority") == "2-HIGH", "R2").otherwise("R0")
    return L.confirmations(t(spark, d, "orders").select(F.col("o_custkey").alias("panel"), tier.alias("tier")))


@query("""WITH r AS (SELECT CAST(l_partkey AS VARCHAR) AS part, l_returnflag AS flag FROM lineitem WHERE l_linenumber > 1), c AS (SELECT CAST(l_partkey AS VARCHAR) AS part, l_returnflag AS flag FROM lineitem WHERE l_linenumber <= 4) SELECT * FROM c EXCEPT ALL SELECT * FROM r""")
def candidates_not_raw(spark, d):
    li = t(spark, d, "lineitem").select(F.col("l_partkey").alias("part"), F.col("l_returnflag").alias("flag"), "l_linenumber")
    return L.candidates_not_raw(li.where("l_linenumber > 1"), li.where("l_linenumber <= 4"), ["part", "flag"])


@query("""WITH r AS (SELECT c_name AS name, c_nationkey AS s FROM customer WHERE c_custkey % 10 <> 0), a AS (SELECT c_name AS name, CASE WHEN c_custkey % 7 = 0 THEN -1 ELSE c_nationkey END AS s FROM customer WHERE c_custkey % 11 <> 0) SELECT coalesce(r.name, a.name) AS name, CASE WHEN r.s IS NULL OR a.s IS NULL THEN 'RUN_MANIFEST_SET_CHANGED' ELSE 'RUN_MANIFEST_MODIFIED' END AS code FROM r FULL JOIN a ON r.name = a.name WHERE r.s IS DISTINCT FROM a.s""")
def manifest_changes(spark, d):
    c = t(spark, d, "customer")
    text = lambda x: F.sha2(x.cast("string"), 256)
    return L.manifest_changes(c.where("c_custkey % 10 <> 0").select(F.col("c_name").alias("name"), text(F.col("c_nationkey")).alias("sha256")), c.where("c_custkey % 11 <> 0").select(F.col("c_name").alias("name"), F.upper(text(F.when(F.col("c_custkey") % 7 == 0, -1).otherwise(F.col("c_nationkey")))).alias("sha256")))


@query("""WITH v AS (SELECT l_orderkey * 10 + l_linenumber AS value, l_suppkey AS panel, CASE WHEN l_orderkey % 13 = 0 THEN 'none' WHEN l_orderkey % 17 = 0 THEN CAST(l_orderkey * 10 + 1 AS VARCHAR) ELSE CAST(l_orderkey * 10 + l_linenumber AS VARCHAR) END AS mark, l_quantity AS mean, l_returnflag AS cell, l_linestatus AS method FROM lineitem),
m AS (SELECT CAST(l_orderkey * 10 + l_linenumber AS VARCHAR) AS mark, l_suppkey AS panel, CASE WHEN l_orderkey % 5 = 0 THEN l_quantity + 1 ELSE l_quantity END AS mean, CASE WHEN l_orderkey % 7 = 0 THEN '?' ELSE l_returnflag END AS cell, CASE WHEN l_orderkey % 11 = 0 THEN '?' ELSE l_linestatus END AS method FROM lineitem),
n AS (SELECT mark, count(*) AS n FROM v GROUP BY 1) SELECT value, code FROM (SELECT value, CASE WHEN m.mark IS NULL OR m.panel <> v.panel THEN 'MARK_EVIDENCE_MISSING' WHEN n > 1 THEN 'MARK_EVIDENCE_SHARED' WHEN m.method <> v.method THEN 'METHOD_CONTRADICTS_MARK' WHEN m.mean <> v.mean THEN 'VALUE_CONTRADICTS_MARK' WHEN m.cell <> v.cell THEN 'CELL_CONTRADICTS_MARK' END AS code FROM v JOIN n ON n.mark = v.mark LEFT JOIN m ON m.mark = v.mark) WHERE code IS NOT NULL""")
def mark_evidence(spark, d):
    k, o = (F.col("l_orderkey") * 10 + F.col("l_linenumber")), F.col("l_orderkey")
    li = t(spark, d, "lineitem")
    named = F.when(o % 13 == 0, "none").when(o % 17 == 0, (o * 10 + 1).cast("string")).otherwise(k.cast("string"))
    v = li.select(k.alias("value"), F.col("l_suppkey").alias("panel"), named.alias("mark"), F.col("l_quantity").alias("mean"), F.col("l_returnflag").alias("cell"), F.col("l_linestatus").alias("method"))
    m = li.select(k.cast("string").alias("mark"), F.col("l_suppkey").alias("panel"), F.when(o % 5 == 0, F.col("l_quantity") + 1).otherwise(F.col("l_quantity")).alias("mean"), F.when(o % 7 == 0, "?").otherwise(F.col("l_returnflag")).alias("cell"), F.when(o % 11 == 0, "?").otherwise(F.col("l_linestatus")).alias("method"))
    return L.mark_evidence(v, m)


@query("""SELECT l_suppkey, l_orderkey * 10 + l_linenumber AS point, CASE WHEN l_suppkey % 4 = 0 THEN 'AXIS_MISSING' ELSE 'POINT_NOT_REDERIVED' END AS code FROM lineitem WHERE l_suppkey % 4 = 0 OR l_orderkey % 19 = 0""")
def rederived_points(spark, d):
    log = F.col("l_suppkey") % 2 == 1
    z = 0.01 * F.col("l_quantity") + 1.5
    p = t(spark, d, "lineitem").select("l_suppkey", (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("point"), F.col("l_quantity").alias("px"), (F.when(log, F.exp(z)).otherwise(z) + F.when(F.col("l_orderkey") % 19 == 0, 0.001).otherwise(0.0)).alias("value"))
    c = t(spark, d, "supplier").where("s_suppkey % 4 <> 0").select(F.col("s_suppkey").alias("l_suppkey"), F.lit(0.01).alias("slope"), F.lit(1.5).alias("intercept"), F.when(F.col("s_suppkey") % 2 == 1, "LOG").otherwise("LINEAR").alias("scale"))
    return L.point_problems(p, c, ["l_suppkey"])


@query("""WITH g AS (SELECT o_custkey AS c, count(*) AS n, count(DISTINCT o_orderstatus) AS m FROM orders GROUP BY 1) SELECT c_custkey AS association, CASE WHEN g.n IS NULL THEN 'CLOUD_MISSING' WHEN g.n < 3 THEN 'CLOUD_TOO_SMALL' WHEN g.n <> 10 THEN 'CLOUD_COUNT_DIFFERS' ELSE 'CLOUD_IDENTITY_MIXED' END AS code FROM customer LEFT JOIN g ON c = c_custkey WHERE g.n IS NULL OR g.n <> 10 OR m > 1""")
def association_clouds(spark, d):
    a = t(spark, d, "customer").select(F.col("c_custkey").alias("association"), F.col("c_custkey").alias("cloud"), F.lit(10).alias("n"))
    return L.cloud_problems(a, t(spark, d, "orders").select(F.col("o_custkey").alias("cloud"), F.col("o_orderstatus").alias("method")))


@query("""SELECT o_orderkey, CASE o_orderkey % 8 WHEN 0 THEN 'GEOMETRY_NOT_AUTHORED' WHEN 1 THEN 'GEOMETRY_NOT_AUTHORED' WHEN 2 THEN 'NOT_DATA' WHEN 3 THEN 'ASSOCIATION_EXTRACT' WHEN 4 THEN 'BINARY_EXTRACT' WHEN 5 THEN 'NON_TARGET_OUTCOME' ELSE 'UNRESOLVED' END AS disposition,
CASE o_orderkey % 8 WHEN 3 THEN 'ASSOCIATION' WHEN 4 THEN 'BINARY_EVENT' WHEN 0 THEN CASE o_custkey % 4 WHEN 0 THEN 'CONTINUOUS' WHEN 1 THEN 'QUANTILE_SUMMARY' ELSE '' END WHEN 1 THEN CASE o_custkey % 4 WHEN 0 THEN 'CONTINUOUS' WHEN 1 THEN 'QUANTILE_SUMMARY' ELSE '' END ELSE '' END AS statistic FROM orders""")
def panel_dispositions(spark, d):
    routes = F.array(*[F.lit(x) for x in ("DIGITIZE", "PARTIAL_PANEL_TARGET", "NOT_DATA", "ASSOCIATION_ONLY_NOT_TARGET", "BINARY_EVENT_NOT_MEAN", "NO_TARGET_OUTCOME", "MIXED_CAPTION_NOT_DECIDABLE", "NEW_ROUTE")])
    spread = F.when(F.col("o_custkey") % 4 == 0, "sd").when(F.col("o_custkey") % 4 == 1, "IQR").when(F.col("o_custkey") % 4 == 2, "AMBIGUOUS")
    o = t(spark, d, "orders").select("o_orderkey", L.disposition(F.get(routes, (F.col("o_orderkey") % 8).cast("int"))).alias("disposition"), spread.alias("s"))
    return o.select("o_orderkey", "disposition", L.statistic(F.col("disposition"), F.col("s")).alias("statistic"))


@query("""WITH a AS (SELECT o_orderkey, o_orderkey % 5 = 0 AS seen, CASE WHEN o_custkey % 3 = 0 THEN '' ELSE 'R' || (o_custkey % 4) END AS o, CASE WHEN o_custkey % 2 = 0 THEN 'ref' ELSE '' END AS r FROM orders) SELECT o_orderkey, CASE WHEN seen THEN '' WHEN o = '' AND r = '' THEN 'NOT_SEEN_BY_PERSON' ELSE concat_ws(',', CASE WHEN o = '' OR r = '' THEN 'APPROVAL_INCOMPLETE' END, CASE WHEN o = 'R1' THEN 'OBSERVER_IS_APPROVER' END) END AS problems FROM a""")
def answer_provenance(spark, d):
    k = F.col("o_custkey")
    p = L.answer_problems(F.col("o_orderkey") % 5 == 0, F.when(k % 3 == 0, " ").otherwise(F.concat(F.lit("r"), (k % 4).cast("string"))), F.when(k % 2 == 0, "ref"), F.lit("R1 "))
    return t(spark, d, "orders").select("o_orderkey", F.array_join(p, ",").alias("problems"))


@query("""SELECT l_orderkey, l_linenumber, greatest(l_quantity - 20, 0) AS x0, least(l_quantity + 10, 40) AS x1 FROM lineitem WHERE greatest(l_quantity - 20, 0) < least(l_quantity + 10, 40) AND l_partkey % 60 < 30""")
def clipped_frames(spark, d):
    q, y = F.col("l_quantity"), (F.col("l_partkey") % 60).cast("double")
    f = t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", L.clipped(q - 20, q + 10, y, y + 5, F.lit(40.0), F.lit(30.0)).alias("f"))
    return f.where("f is not null").select("l_orderkey", "l_linenumber", "f.x0", "f.x1")


@query("SELECT l_suppkey, l_orderkey, l_linenumber, CAST(row_number() OVER (PARTITION BY l_suppkey ORDER BY l_quantity, l_extendedprice, l_orderkey, l_linenumber) AS INTEGER) AS point FROM lineitem")
def numbered_points(spark, d):
    li = t(spark, d, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    return L.numbered(li, ["l_suppkey"], ["l_quantity", "l_extendedprice", "l_orderkey", "l_linenumber"], "point").select("l_suppkey", "l_orderkey", "l_linenumber", "point")


@query("SELECT event_id, value FROM events ORDER BY value, event_id LIMIT 25")
def lowest_confidence(spark, d):
    return L.lowest_first(t(spark, d, "events").select("event_id", "value"), "value", "event_id", 25)


@query("""SELECT o_orderkey, CASE WHEN c_custkey IS NULL THEN 'NO_DOCUMENT' WHEN o_orderstatus = 'P' THEN 'PHANTOM' WHEN c_acctbal < 0 THEN 'SCOPE_UNRESOLVED' WHEN o_totalprice > 200000 THEN 'CROP_TOO_LARGE' END AS reason FROM orders LEFT JOIN customer ON c_custkey = o_custkey AND c_nationkey <> 3""")
def block_reasons(spark, d):
    c = t(spark, d, "customer").where("c_nationkey <> 3").select(F.col("c_custkey").alias("o_custkey"), "c_acctbal", F.lit(True).alias("known"))
    o = t(spark, d, "orders").join(c, "o_custkey", "left")
    return o.select("o_orderkey", L.first_reason(("NO_DOCUMENT", F.col("known").isNull()), ("PHANTOM", F.col("o_orderstatus") == "P"), ("SCOPE_UNRESOLVED", F.col("c_acctbal") < 0), ("CROP_TOO_LARGE", F.col("o_totalprice") > 200000)).alias("reason"))


@query("""SELECT l_orderkey, l_linenumber, round(greatest(least(l_quantity + 20, 40) - greatest(l_quantity, 10), 0) / 30.0, 6) AS covered, round((20 - greatest(least(l_quantity + 20, 40) - greatest(l_quantity, 10), 0)) / 20.0, 6) AS outside FROM lineitem""")
def crop_scores(spark, d):
    q = F.col("l_quantity")
    c = t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", L.crop_score(q, q + 20, F.lit(0), F.lit(5), F.lit(10), F.lit(40), F.lit(0), F.lit(5)).alias("s"))
    return c.select("l_orderkey", "l_linenumber", F.round("s.covered", 6).alias("covered"), F.round("s.outside", 6).alias("outside"))


@query("SELECT c_custkey, CASE WHEN n IS NULL THEN c_name ELSE n END AS c_name FROM customer LEFT JOIN (SELECT o_custkey AS k, max(o_orderpriority) AS n FROM orders GROUP BY 1) ON k = c_custkey")
def rehashed(spark, d):
    new = t(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_orderpriority").alias("c_name"))
    return L.updated(t(spark, d, "customer").select("c_custkey", "c_name"), new, "c_custkey", "c_name")


@query("""WITH g AS (SELECT l_suppkey AS unit, l_linenumber AS cell, CASE WHEN l_linenumber = 1 THEN NULL ELSE avg(l_quantity) END AS mean, CASE l_linenumber WHEN 2 THEN NULL WHEN 3 THEN -1.0 WHEN 4 THEN avg(l_quantity) ELSE 0.001 END AS se, count(*) AS n FROM lineitem GROUP BY 1, 2), h AS (SELECT *, unit || '/' || cell AS row_id FROM g)
SELECT 'values' AS scope, row_id, unnest(list_filter([CASE WHEN mean IS NULL THEN 'MISSING_VALUE' END, CASE WHEN se IS NULL THEN 'MISSING_DISPERSION' END, CASE WHEN se < 0 THEN 'NEGATIVE_DISPERSION' END, CASE WHEN se * sqrt(n) > 1.5 * abs(mean) THEN 'SE_IMPLIES_IMPOSSIBLE_SD' END], lambda x: x IS NOT NULL)) AS code FROM h""")
def continuous_faults(spark, d):
    """Means and spreads of which each kind of fault was made."""
    g = t(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("unit"), F.col("l_linenumber").alias("cell")).agg(F.avg("l_quantity").alias("q"), F.count("*").alias("n"))
    k = F.col("cell")
    g = g.withColumn("mean", F.when(k != 1, F.col("q"))).withColumn("se", F.when(k == 3, -1.0).when(k == 4, F.col("q")).when(k != 2, 0.001)).withColumn("row", F.concat_ws("/", "unit", "cell"))
    rules = Q.continuous_rules(F.col("mean"), F.col("se"), F.col("n"), F.lit("SE"), F.lit("RATIO"), F.lit("SYMMETRIC"))
    return Q.apply(g, rules, "values", "row").select("scope", "row_id", "code")


@query("""WITH RECURSIVE p AS (SELECT DISTINCT l_suppkey, l_quantity AS x FROM lineitem), k AS (SELECT l_suppkey, min(x) AS x FROM p GROUP BY 1 UNION ALL SELECT l_suppkey, x FROM (SELECT k.l_suppkey, min(p.x) AS x FROM k JOIN p ON p.l_suppkey = k.l_suppkey AND p.x > k.x + 3 GROUP BY k.l_suppkey, k.x)) SELECT l_suppkey, x FROM k""")
def thinned_points(spark, d):
    """Positions more than three apart, kept from the left."""
    return M.thin(t(spark, d, "lineitem").select("l_suppkey", F.col("l_quantity").cast("double").alias("x")).distinct(), "l_suppkey", "x", 3.0)


@query("""SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'LINE_COLOR' WHEN 1 THEN 'BAR_COLOR' ELSE 'BOX_VIOLIN' END AS route, CASE event_id % 4 WHEN 0 THEN 'DIRECT_CONNECTED_CAP' WHEN 1 THEN 'UNSTEMMED_CAP' WHEN 2 THEN 'NO_DISPERSION' ELSE 'DIRECT_BOX_GEOMETRY' END AS dispersion_method FROM events
WHERE NOT ((event_id % 3 = 0 AND event_id % 4 IN (0, 1)) OR (event_id % 3 = 1 AND event_id % 4 IN (0, 2)) OR (event_id % 3 = 2 AND event_id % 4 = 3))""")
def spread_contract(spark, d):
    e = F.col("event_id")
    route = F.when(e % 3 == 0, "LINE_COLOR").when(e % 3 == 1, "BAR_COLOR").otherwise("BOX_VIOLIN")
    method = F.when(e % 4 == 0, "DIRECT_CONNECTED_CAP").when(e % 4 == 1, "UNSTEMMED_CAP").when(e % 4 == 2, "NO_DISPERSION").otherwise("DIRECT_BOX_GEOMETRY")
    return T.outside_spread_contract(t(spark, d, "events").select("event_id", route.alias("route"), method.alias("dispersion_method"))).select("event_id", "route", "dispersion_method")


@query("SELECT event_id, k AS key FROM (SELECT event_id, unnest(json_keys(props)) AS k FROM events) WHERE k <> 'page'")
def unknown_keys(spark, d):
    """Keys of the events' properties that nobody declared."""
    return N.unknown_keys(t(spark, d, "events"), "props", ["page"], keep=["event_id"])


# --- digests

_JSON = """'{"cell":"' || o_orderstatus || '","dispersion_method":null,"identity_method":"A|B","panel":"' || o_custkey || '","unit":"' || o_orderkey || '","value":"' || o_orderkey || '","value_method":""}'"""


@query(f"SELECT o_orderkey AS value, sha256({_JSON}) AS inference_id FROM orders WHERE o_orderpriority IN ('2-HIGH', '3-MEDIUM')")
def inference_ids_canonical(spark, d):
    tier = F.when(F.col("o_orderpriority") == "2-HIGH", "R3").when(F.col("o_orderpriority") == "3-MEDIUM", "R2").otherwise("R0")
    v = t(spark, d, "orders").select(F.col("o_custkey").alias("panel"), F.col("o_orderkey").alias("unit"), F.col("o_orderstatus").alias("cell"), F.lit("A|B").alias("identity_method"), F.lit("").alias("value_method"), F.lit(None).cast("string").alias("dispersion_method"), F.col("o_orderkey").alias("value"), tier.alias("tier"))
    return V.inference_ids(v).select("value", "inference_id")


_SUM = " || '|' || ".join(f"CAST(sum(CAST('0x' || substr(h, {1 + 15 * i}, 15) AS BIGINT)) AS VARCHAR)" for i in range(4))


@query(f"""WITH r AS (SELECT o_custkey, sha256('{{"key":"' || o_orderkey || '","status":"' || o_orderstatus || '"}}') AS h FROM orders) SELECT o_custkey, sha256(CAST(count(*) AS VARCHAR) || '|' || {_SUM}) AS digest FROM r GROUP BY 1""")
def subject_set_digest(spark, d):
    return Q.set_digest(t(spark, d, "orders"), ["o_custkey"], S.canonical_json({"status": F.col("o_orderstatus"), "key": F.col("o_orderkey")}))


# --- captions

_OPEN = ("Heart rate in men during tilt. ", "VI VT f HR in four panels, plasma protein PP. ", "Presyncopal women at baseline: CO and SV. ", "Cardiac output (CO) of subjects. ", "Means ± SD, except graphical representations, which use SE. Then ", "Box plots indicate minimum, 25th percentile, median, 75th percentile, and maximum values. ", "Box plots show medians. ", "Data besides anthropometric values are SD. ")
_OPEN_SQL = "[" + ", ".join(f"'{x}'" for x in _OPEN) + "][CAST(doc_id % 8 AS INTEGER) + 1]"


def _opened(spark, d):
    return t(spark, d, "documents").select("doc_id", F.get(F.array(*[F.lit(x) for x in _OPEN]), (F.col("doc_id") % 8).cast("int")).alias("c"))


@query("SELECT doc_id, CASE doc_id % 8 WHEN 1 THEN 'VI,VT,HR' WHEN 2 THEN 'SV' WHEN 3 THEN 'CO' ELSE '' END AS tokens FROM documents")
def caption_parameters(spark, d):
    return _opened(spark, d).select("doc_id", F.array_join(C.parameter_tokens(C.caption_text(F.col("c"))), ",").alias("tokens"))


@query("SELECT doc_id, CASE doc_id % 8 WHEN 0 THEN 'DIGITIZE' WHEN 1 THEN 'PARTIAL_PANEL_TARGET' WHEN 3 THEN 'NO_TARGET_OUTCOME' ELSE 'NO_TARGET_OUTCOME' END AS route FROM documents")
def caption_targets(spark, d):
    return _opened(spark, d).select("doc_id", C.route(F.col("c"), F.lit(False), (r"heart rate", r"presyncop")).alias("route"))


@query("SELECT doc_id, CASE doc_id % 8 WHEN 4 THEN 'SE' ELSE '' END AS exception, CASE doc_id % 8 WHEN 5 THEN 'CENTER=MEDIAN;BOX=P25_P75;WHISKER=MIN_MAX' WHEN 6 THEN 'CENTER=MEDIAN' END AS boxes FROM documents")
def caption_exceptions(spark, d):
    return _opened(spark, d).select("doc_id", C.figure_exception(F.col("c")).alias("exception"), C.box_elements(F.col("c")).alias("boxes"))


@query("SELECT doc_id, CASE doc_id % 4 WHEN 3 THEN (doc_id % 9) || 'B' ELSE CAST(doc_id % 9 AS VARCHAR) END AS number, 'stand' || 'ing - up fin' AS joined FROM documents")
def figure_numbers(spark, d):
    k = F.col("doc_id")
    n = (k % 9).cast("string")
    label = F.when(k % 4 == 0, F.concat(F.lit("Fig. "), n)).when(k % 4 == 1, F.concat(F.lit("图"), n)).when(k % 4 == 2, F.concat(F.lit("Ｆｉｇｕｒｅ "), n)).otherwise(F.concat(F.lit(" figure "), n, F.lit("b.")))
    lines = F.array(F.lit("stand-"), F.lit("ing -"), F.lit("up"), F.lit("ﬁn"))
    return t(spark, d, "documents").select("doc_id", C.figure_number(label).alias("number"), C.plain_text(C.joined_lines(lines)).alias("joined"))
