"""Named queries over the driver's tables, each with the SQL that it must agree with.

The tables hold no figures, so every operator is exercised by shape: orders, line items and events stand for
values in declared cells, customers for units, nations for grids, texts for captions.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import captions as C
from ..functions import scalars as S
from ..operators import association as A
from ..operators import bundle as B
from ..operators import grid as G
from ..operators import intake as I
from ..operators import matching as M
from ..operators import measure as E
from ..operators import relate as R
from ..operators import review as V
from ..operators import rules as Q
from ..operators import tiers as T
from . import run as P

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def t(spark, d, name):
    return spark.read.parquet(f"{d}/{name}.parquet")


def _levels(spark):
    """The declared levels of the order grid: priority by status."""
    rows = [("G1", "PRIORITY", x) for x in ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")] + [("G1", "STATUS", x) for x in ("F", "O", "P", "X")]
    return spark.createDataFrame(rows, "grid string, factor string, level string")


LEVELS_SQL = """declared AS (SELECT 'PRIORITY=' || p || ';STATUS=' || s AS cell FROM (VALUES ('1-URGENT'), ('2-HIGH'), ('3-MEDIUM'), ('4-NOT SPECIFIED'), ('5-LOW')) a(p), (VALUES ('F'), ('O'), ('P'), ('X')) b(s))"""


def _cells(spark, d):
    """Observed cells of each nation's customers: one unit a nation."""
    o = t(spark, d, "orders").join(t(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey"), "o_custkey")
    key = F.concat(F.lit("PRIORITY="), F.col("o_orderpriority"), F.lit(";STATUS="), F.col("o_orderstatus"))
    return o.groupBy(F.col("c_nationkey").alias("unit"), key.alias("cell")).agg(F.count("*").alias("n"), F.expr("sum(cast(round(o_totalprice * 100) as bigint)) div count(*)").alias("mean_cents"))


CELLS_SQL = """cells AS (SELECT c_nationkey AS unit, 'PRIORITY=' || o_orderpriority || ';STATUS=' || o_orderstatus AS cell, count(*) AS n, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) // count(*) AS BIGINT) AS mean_cents
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)"""


@query(f"WITH {LEVELS_SQL}, {CELLS_SQL}, u AS (SELECT DISTINCT unit FROM cells) SELECT u.unit, d.cell FROM u CROSS JOIN declared d WHERE NOT EXISTS (SELECT 1 FROM cells c WHERE c.unit = u.unit AND c.cell = d.cell)")
def grid_missing_cells(spark, d):
    cells = _cells(spark, d)
    # a unit's declaration: every unit uses the one small grid
    expected = cells.select("unit").distinct().withColumn("grid", F.lit("G1")).join(G.expected_cells(_levels(spark), "grid", "factor", "level"), "grid").select("unit", "cell")
    return G.missing(expected, cells, ["unit", "cell"])


@query(f"WITH {LEVELS_SQL}, {CELLS_SQL} SELECT DISTINCT unit, cell FROM cells WHERE cell NOT IN (SELECT cell FROM declared WHERE cell NOT LIKE '%STATUS=P')")
def grid_extra_cells(spark, d):
    declared = G.expected_cells(_levels(spark).where("level <> 'P'"), "grid", "factor", "level").select("cell")
    return G.extra(declared, _cells(spark, d), ["cell"]).join(_cells(spark, d).select("unit", "cell"), "cell").select("unit", "cell")


@query("SELECT 'B' AS grid, CAST((SELECT count(DISTINCT p_brand) FROM part) * (SELECT count(DISTINCT p_size) FROM part) * (SELECT count(DISTINCT p_type) FROM part) AS BIGINT) AS n_cells")
def grid_expected_count(spark, d):
    p = t(spark, d, "part").select(F.explode(F.array(*[F.struct(F.lit(c).alias("factor"), F.col(c).cast("string").alias("level")) for c in ("p_brand", "p_size", "p_type")])).alias("x")).select(F.lit("B").alias("grid"), "x.*").distinct()
    return G.expected_count(p, "grid", "factor", "level")


@query("SELECT user_id, event_type, CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY ALL HAVING count(*) > 1")
def grid_duplicate_cells(spark, d):
    return G.all_duplicates(t(spark, d, "events").withColumn("day", F.to_date("ts")), ["user_id", "event_type", "day"])


@query("SELECT event_id, user_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS k FROM events) WHERE k > 1")
def grid_later_duplicates(spark, d):
    return G.later_duplicates(t(spark, d, "events").select("event_id", "user_id", "event_type"), ["user_id", "event_type"], ["event_id"])


@query("SELECT l_orderkey, count(*) AS n, max(l_linenumber) - min(l_linenumber) + 1 = count(*) AND count(DISTINCT l_linenumber) = count(*) AS contiguous FROM lineitem GROUP BY 1")
def grid_level_order(spark, d):
    return G.level_order(t(spark, d, "lineitem"), ["l_orderkey"], "l_linenumber")


FLAG_SQL = f"""WITH {LEVELS_SQL}, {CELLS_SQL}, u AS (SELECT DISTINCT unit FROM cells), m AS (
SELECT u.unit, d.cell, coalesce(c.n, 0) AS n, c.mean_cents, CASE WHEN c.n IS NULL THEN 'MISSING_CELL' WHEN c.n < 3 THEN 'TOO_FEW' END AS code
FROM u CROSS JOIN declared d LEFT JOIN cells c ON c.unit = u.unit AND c.cell = d.cell WHERE d.cell NOT LIKE '%STATUS=X'), b AS (SELECT unit, bool_or(code IS NOT NULL) AS failed FROM m GROUP BY 1)
SELECT m.unit, m.cell, m.n, m.mean_cents, m.code, CASE WHEN code IS NOT NULL THEN 'QC_FAILED' WHEN failed THEN 'PANEL_NOT_PASSED' ELSE 'MACHINE_QC_PASSED' END AS value_status FROM m JOIN b USING (unit)"""


@query(FLAG_SQL)
def grid_status(spark, d):
    """Declared grid, observed cells, problems, blame and the status of every value."""
    cells = _cells(spark, d)
    declared = G.expected_cells(_levels(spark).where("level <> 'X'"), "grid", "factor", "level")
    expected = cells.select("unit").distinct().withColumn("grid", F.lit("G1")).join(declared, "grid").select("unit", "cell")
    code = F.when(F.col("mean_cents").isNull(), "MISSING_CELL").when(F.col("n") < 3, "TOO_FEW")
    m = expected.join(cells, ["unit", "cell"], "left").withColumn("code", code).withColumn("n", F.coalesce("n", F.lit(0).cast("long")))
    state = m.groupBy("unit").agg(F.when(F.bool_or(F.col("code").isNotNull()), "PROBLEMS").otherwise("AUTO_PASS").alias("state"))
    return m.join(state, "unit").select("unit", "cell", "n", "mean_cents", "code", Q.value_status(F.col("code").isNotNull(), F.col("state")).alias("value_status"))


flagship = grid_status


@query("""SELECT l_returnflag, count(*) AS n, round(corr(l_extendedprice, l_quantity), 6) AS pearson_r, round(corr(l_extendedprice, l_quantity) ** 2, 6) AS r_squared, round(regr_slope(l_extendedprice, l_quantity), 3) AS slope,
round(sqrt((regr_syy(l_extendedprice, l_quantity) - regr_slope(l_extendedprice, l_quantity) * regr_sxy(l_extendedprice, l_quantity)) / (count(*) - 2) / regr_sxx(l_extendedprice, l_quantity)), 4) AS slope_se FROM lineitem GROUP BY 1""")
def association_summary(spark, d):
    m = A.moments(t(spark, d, "lineitem"), ["l_returnflag"], "l_quantity", "l_extendedprice")
    return m.select("l_returnflag", "n", F.round("pearson_r", 6).alias("pearson_r"), F.round("r_squared", 6).alias("r_squared"), F.round("slope", 3).alias("slope"), F.round("slope_se", 4).alias("slope_se"))


@query("""WITH r AS (SELECT l_returnflag, rank() OVER (PARTITION BY l_returnflag ORDER BY l_quantity) + (count(*) OVER (PARTITION BY l_returnflag, l_quantity) - 1) / 2.0 AS x,
rank() OVER (PARTITION BY l_returnflag ORDER BY l_discount) + (count(*) OVER (PARTITION BY l_returnflag, l_discount) - 1) / 2.0 AS y FROM lineitem)
SELECT l_returnflag, count(*) AS n, round(corr(y, x), 6) AS spearman_rho FROM r GROUP BY 1""")
def association_spearman(spark, d):
    s = A.spearman(t(spark, d, "lineitem").select("l_returnflag", "l_quantity", "l_discount"), ["l_returnflag"], "l_quantity", "l_discount")
    return s.withColumn("spearman_rho", F.round("spearman_rho", 6))


KENDALL_SQL = """SELECT a.p_brand, count_if(sign(a.p_size - b.p_size) * sign(a.p_retailprice - b.p_retailprice) > 0) AS concordant, count_if(sign(a.p_size - b.p_size) * sign(a.p_retailprice - b.p_retailprice) < 0) AS discordant,
count_if(a.p_size = b.p_size AND a.p_retailprice <> b.p_retailprice) AS ties_x, count_if(a.p_size <> b.p_size AND a.p_retailprice = b.p_retailprice) AS ties_y FROM part a JOIN part b ON a.p_brand = b.p_brand AND a.p_partkey < b.p_partkey GROUP BY 1"""


@query(f"SELECT *, round((concordant - discordant) / sqrt(CAST(concordant + discordant + ties_x AS DOUBLE) * (concordant + discordant + ties_y)), 6) AS tau_b FROM ({KENDALL_SQL})")
def association_kendall(spark, d):
    k = A.kendall(t(spark, d, "part"), ["p_brand"], "p_size", "p_retailprice", "p_partkey")
    return k.withColumn("tau_b", F.round("tau_b", 6))


@query()
def association_p_values(spark, d):
    """Pearson, slope and Kendall p for each brand; beyond SQL, tested against known values."""
    p = t(spark, d, "part")
    m = A.moments(p, ["p_brand"], "p_size", "p_retailprice").join(A.kendall(p, ["p_brand"], "p_size", "p_retailprice", "p_partkey"), "p_brand")
    ties = F.col("ties_x") + F.col("ties_y")
    return m.select(
        "p_brand",
        "n",
        A.p_value("PEARSON")("pearson_r", "n").alias("pearson_p"),
        A.p_value("SLOPE")(F.col("slope") / F.col("slope_se"), F.col("n")).alias("slope_p"),
        A.p_value("KENDALL")("tau_b", "n", "discordant", ties).alias("kendall_p"),
        A.p_method(F.lit("KENDALL_TAU"), F.col("n"), ties > 0).alias("kendall_method"),
    )


@query("""WITH q AS (SELECT o_orderpriority AS unit, min(o_totalprice) AS low, quantile_cont(o_totalprice, 0.25) AS q1, quantile_cont(o_totalprice, 0.5) AS median, quantile_cont(o_totalprice, 0.75) AS q3, max(o_totalprice) AS high FROM orders GROUP BY 1)
SELECT unit, round(low, 4) AS low, round(q1, 4) AS q1, round(median, 4) AS median, round(q3, 4) AS q3, round(high, 4) AS high, CASE WHEN low > q1 OR q1 > median OR median > q3 OR q3 > high THEN 'QUANTILES_OUT_OF_ORDER' WHEN q1 = q3 THEN 'ZERO_SPREAD' ELSE 'OK' END AS verdict FROM q""")
def quantile_gate(spark, d):
    p = lambda q: F.percentile("o_totalprice", F.lit(q))
    s = t(spark, d, "orders").groupBy(F.col("o_orderpriority").alias("unit")).agg(F.min("o_totalprice").alias("low"), p(0.25).alias("q1"), p(0.5).alias("median"), p(0.75).alias("q3"), F.max("o_totalprice").alias("high"))
    rules = Q.quantile_rules(*[F.col(c) for c in ("low", "q1", "median", "q3", "high")])
    verdict = F.coalesce(*[F.when(r.when, r.code) for r in rules], F.lit("OK"))
    return s.select("unit", *[F.round(c, 4).alias(c) for c in ("low", "q1", "median", "q3", "high")], verdict.alias("verdict"))


@query("""WITH g AS (SELECT l_suppkey AS unit, avg(l_tax) AS mean, stddev_samp(l_tax) / sqrt(count(*)) AS se, count(*) AS n FROM lineitem GROUP BY 1)
SELECT 'values' AS scope, CAST(unit AS VARCHAR) AS row_id, code FROM (SELECT unit, unnest([CASE WHEN mean IS NULL THEN 'MISSING_VALUE' END, CASE WHEN se IS NULL THEN 'MISSING_DISPERSION' END, CASE WHEN se < 0 THEN 'NEGATIVE_DISPERSION' END, CASE WHEN se * sqrt(n) > 0.64 * abs(mean) THEN 'SE_IMPLIES_IMPOSSIBLE_SD' END]) AS code FROM g) WHERE code IS NOT NULL""")
def continuous_gate(spark, d):
    g = t(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("unit")).agg(F.avg("l_tax").alias("mean"), F.stddev_samp("l_tax").alias("sd"), F.count("*").alias("n"))
    g = g.withColumn("se", F.col("sd") / F.sqrt("n") * (1.5 / 0.64))
    rules = Q.continuous_rules(F.col("mean"), F.col("se"), F.col("n"), F.lit("SE"), F.lit("RATIO"), F.lit("SYMMETRIC"))
    return Q.apply(g, rules, "values", "unit").select("scope", "row_id", "code")


@query("""WITH g AS (SELECT lang AS unit, sum(1 - quality) AS events, sum(toxic) AS n FROM labels JOIN documents USING (doc_id) GROUP BY 1)
SELECT 'values' AS scope, unit AS row_id, code FROM (SELECT unit, unnest([CASE WHEN events > n THEN 'EVENTS_EXCEED_N' END, CASE WHEN events < 0 OR n < 0 THEN 'NEGATIVE_COUNT' END, CASE WHEN n <= 0 THEN 'N_INVALID' END]) AS code FROM g) WHERE code IS NOT NULL""")
def binary_event_gate(spark, d):
    g = t(spark, d, "labels").join(t(spark, d, "documents").select("doc_id", "lang"), "doc_id").groupBy(F.col("lang").alias("unit")).agg(F.sum(1 - F.col("quality")).alias("events"), F.sum("toxic").alias("n"))
    return Q.apply(g, Q.event_rules(F.col("events"), F.col("n")), "values", "unit").select("scope", "row_id", "code")


@query("""WITH g AS (SELECT l_partkey AS unit, avg(CASE WHEN l_orderkey % 2 = 0 THEN l_quantity END) AS r1, avg(CASE WHEN l_orderkey % 2 = 1 THEN l_quantity END) AS r2, avg(l_quantity) AS c FROM lineitem GROUP BY 1)
SELECT 'values' AS scope, CAST(unit AS VARCHAR) AS row_id, code FROM (SELECT unit, unnest([CASE WHEN r1 IS NULL OR r2 IS NULL THEN 'NO_INDEPENDENT_READINGS' END, CASE WHEN abs(r1 - r2) / greatest(abs(r1), abs(r2), 1e-9) * 100 > 5.0 THEN 'DUAL_READINGS_DISAGREE' END, CASE WHEN c < least(r1, r2) - 1e-9 OR c > greatest(r1, r2) + 1e-9 THEN 'CONSENSUS_OUTSIDE_READINGS' END]) AS code FROM g) WHERE code IS NOT NULL AND (code = 'NO_INDEPENDENT_READINGS' OR (r1 IS NOT NULL AND r2 IS NOT NULL))""".replace("SELECT unit, unnest", "SELECT unit, r1, r2, unnest"))
def dual_reading_gate(spark, d):
    half = lambda k: F.avg(F.when(F.col("l_orderkey") % 2 == k, F.col("l_quantity")))
    g = t(spark, d, "lineitem").groupBy(F.col("l_partkey").alias("unit")).agg(half(0).alias("r1"), half(1).alias("r2"), F.avg("l_quantity").alias("c"))
    both = F.col("r1").isNotNull() & F.col("r2").isNotNull()
    rules = [Q.Rule(r.code, r.when if r.code == "NO_INDEPENDENT_READINGS" else both & r.when) for r in Q.dual_rules(F.col("r1"), F.col("r2"), F.col("c"))]
    return Q.apply(g, rules, "values", "unit").select("scope", "row_id", "code")


@query("""WITH r(seg, lo, hi) AS (VALUES ('BUILDING', 0, 5000), ('MACHINERY', -500, 9000), ('AUTOMOBILE', 100, 9999))
SELECT c_custkey, CASE WHEN c_acctbal < lo OR c_acctbal > hi THEN 'IMPLAUSIBLE_VALUE' WHEN lo IS NULL AND hi IS NULL THEN 'NO_RANGE' END AS code FROM customer LEFT JOIN r ON seg = c_mktsegment WHERE c_acctbal < lo OR c_acctbal > hi OR (lo IS NULL AND hi IS NULL)""")
def plausibility_ranges(spark, d):
    ranges = spark.createDataFrame([("BUILDING", 0, 5000), ("MACHINERY", -500, 9000), ("AUTOMOBILE", 100, 9999)], "c_mktsegment string, lo int, hi int")
    c = t(spark, d, "customer").join(F.broadcast(ranges), "c_mktsegment", "left")
    code = F.coalesce(*[F.when(r.when, r.code) for r in Q.range_rules(F.col("c_acctbal"), F.col("lo"), F.col("hi"))])
    return c.select("c_custkey", code.alias("code")).where("code is not null")


PREFIXES = ("Fig. 1. Schematic of the protocol (A). ", "Fig. 2. Incidence of events; mean ± SD. ", "Fig. 3. Correlation of x and y (r = 0.5). ", "Fig. 4. Heart rate (A) and pressure (B), means ± SEM. ", "Fig. 5b. Panels a-c: values with standard deviations and standard errors. ", "Fig. 6. Plain values ± spread. ")
_PREFIX_SQL = "[" + ", ".join(f"'{p}'" for p in PREFIXES) + "]"


def _captions(spark, d):
    """Texts with a caption's opening, since the prose is invented."""
    return t(spark, d, "documents").select("doc_id", F.concat(F.element_at(F.array(*[F.lit(p) for p in PREFIXES]), (F.col("doc_id") % len(PREFIXES) + 1).cast("int")), "text").alias("caption"))


def _sql_any(patterns):
    return "regexp_matches(cap, '(?i)(?:" + "|".join(patterns).replace("'", "''") + ")')"


_CAP_SQL = f"WITH c AS (SELECT doc_id, {_PREFIX_SQL}[CAST(doc_id % {len(PREFIXES)} + 1 AS INTEGER)] || text AS raw FROM documents), k AS (SELECT doc_id, trim(regexp_replace(regexp_replace(raw, '([0-9A-Za-z_])[-­]\\s+([0-9A-Za-z_])', '\\1\\2', 'g'), '\\s+', ' ', 'g')) AS cap FROM c)"


@query(f"{_CAP_SQL} SELECT doc_id, CASE WHEN {_sql_any(C.NOT_DATA)} THEN CASE WHEN contains(cap, '±') THEN 'MIXED_CAPTION_NOT_DECIDABLE' ELSE 'NOT_DATA' END WHEN {_sql_any(C.BINARY)} THEN 'BINARY_EVENT_NOT_MEAN' WHEN {_sql_any(C.ASSOCIATION)} THEN 'ASSOCIATION_ONLY_NOT_TARGET' ELSE 'DIGITIZE' END AS route FROM k")
def caption_route(spark, d):
    c = _captions(spark, d)
    return c.select("doc_id", C.route(F.col("caption"), F.contains("caption", F.lit("±"))).alias("route"))


_SEM = C.SPREADS[0][1]
_REST = "regexp_replace(cap, '(?i)(?:" + _SEM + ")', ' ', 'g')"
_NAMED = "list_filter([CASE WHEN " + _sql_any((_SEM,)) + " THEN 'SEM' END, " + ", ".join(f"CASE WHEN {_sql_any((p,)).replace('cap,', _REST + ',')} THEN '{n}' END" for n, p in C.SPREADS[1:]) + "], lambda x: x IS NOT NULL)"


@query(f"{_CAP_SQL}, m AS (SELECT doc_id, cap, {_NAMED} AS named FROM k) SELECT doc_id, CASE WHEN len(named) = 1 THEN named[1] WHEN len(named) > 1 THEN 'AMBIGUOUS' WHEN contains(cap, '±') THEN 'PM_UNNAMED' ELSE 'UNSTATED' END AS definition FROM m")
def errorbar_definition(spark, d):
    return _captions(spark, d).select("doc_id", C.errorbar_definition(F.col("caption")).alias("definition"))


_LETTERS = " || ".join(f"list_transform(regexp_extract_all(cap, '{p}', 1), lambda x: upper(x))" for p in C.LETTER_PATTERNS)
_RANGES = f"flatten(list_transform(list_zip(regexp_extract_all(cap, '{C.LETTER_RANGE}', 1), regexp_extract_all(cap, '{C.LETTER_RANGE}', 2)), lambda p: [chr(CAST(i AS INTEGER)) for i in range(least(ascii(upper(p[1])), ascii(upper(p[2]))), greatest(ascii(upper(p[1])), ascii(upper(p[2]))) + 1)]))"


@query(f"WITH c AS (SELECT doc_id, {_PREFIX_SQL}[CAST(doc_id % {len(PREFIXES)} + 1 AS INTEGER)] || text AS cap FROM documents), p AS (SELECT doc_id, list_sort(list_distinct({_LETTERS} || {_RANGES})) AS l FROM c) SELECT doc_id, array_to_string(l, ',') AS letters, CASE WHEN len(l) >= 2 THEN 'CAPTION_ENUMERATES' WHEN len(l) = 1 THEN 'SINGLE_KEY_ONLY' ELSE 'NO_KEY' END AS confidence FROM p")
def caption_panels(spark, d):
    p = _captions(spark, d).select("doc_id", C.panel_letters(F.col("caption")).alias("l"))
    return p.select("doc_id", F.array_join("l", ",").alias("letters"), C.panel_confidence(F.size("l")).alias("confidence"))


@query(r"""WITH p AS (SELECT conv_id, count(DISTINCT turn) AS pages FROM conversations GROUP BY 1 HAVING count(DISTINCT turn) >= 3), k AS (SELECT conv_id, turn, trim(lower(regexp_replace(regexp_replace(role || ' ' || turn || '. ' || split_part(trim(text), ' ', 1), '[0-9]+', '#', 'g'), '[^\p{L}#]+', ' ', 'g'))) AS key FROM conversations UNION ALL SELECT conv_id, turn, role || ' #' FROM conversations),
s AS (SELECT conv_id, key, count(DISTINCT turn) AS seen FROM k WHERE key <> '' GROUP BY 1, 2) SELECT s.conv_id, key, seen, pages FROM s JOIN p USING (conv_id) WHERE seen >= greatest(2, ceil(0.5 * pages))""")
def page_furniture(spark, d):
    """Heads and feet (role and turn, with and without the first word) that recur on at least half of a conversation's turns, as on pages."""
    c = t(spark, d, "conversations").select("conv_id", "turn", F.concat(F.col("role"), F.lit(" "), F.col("turn").cast("string"), F.lit(". "), F.split_part(F.trim("text"), F.lit(" "), F.lit(1))).alias("head"), F.concat(F.col("role"), F.lit(" "), F.col("turn").cast("string")).alias("foot"))
    c = c.select("conv_id", "turn", F.explode(F.array("head", "foot")).alias("head"))
    return I.furniture(c, "conv_id", "turn", "head").select("conv_id", "key", "seen", "pages")


@query("""WITH g AS (SELECT user_id, event_id, ts, CASE WHEN epoch_us(ts) - lag(epoch_us(ts)) OVER w <= 86400000000 THEN 0 ELSE 1 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
r AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS run FROM g) SELECT user_id, CAST(run AS BIGINT) AS run, count(*) AS n FROM r GROUP BY 1, 2""")
def gap_runs(spark, d):
    e = t(spark, d, "events").withColumn("us", F.unix_micros(F.col("ts").cast("timestamp")))
    return R.gap_runs(e, ["user_id"], F.col("us"), ["ts", "event_id"], 86_400_000_000).groupBy("user_id", F.col("run").cast("long").alias("run")).agg(F.count("*").alias("n"))


@query("""WITH x AS (SELECT label, CAST(embedding[1] AS DOUBLE) - avg(CAST(embedding[1] AS DOUBLE)) OVER (PARTITION BY label) AS v, CAST(embedding[1] AS DOUBLE) AS raw FROM embeddings), y AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY raw) AS k, count(*) OVER (PARTITION BY label) AS n, sum(v) OVER w AS s, sum(v * v) OVER w AS q, sum(v) OVER (PARTITION BY label) AS ts, sum(v * v) OVER (PARTITION BY label) AS tq, lead(raw) OVER (PARTITION BY label ORDER BY raw) AS nx FROM x WINDOW w AS (PARTITION BY label ORDER BY raw ROWS UNBOUNDED PRECEDING)),
z AS (SELECT label, n, k, ((ts - s) / (n - k) - s / k) / greatest(sqrt(greatest(q / k - (s / k) ** 2, 0)) + sqrt(greatest((tq - q) / (n - k) - ((ts - s) / (n - k)) ** 2, 0)), 1e-12) AS sep FROM y WHERE k < n AND raw < nx), b AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY sep DESC, k) AS o FROM z)
SELECT label, n, k AS n_low, round(sep, 5) AS separation, sep >= 2 AND least(k, n - k) >= greatest(2, floor(n / 4)) AS splits FROM b WHERE o = 1""")
def two_cluster_split(spark, d):
    e = t(spark, d, "embeddings").select("label", F.col("embedding")[0].cast("double").alias("v"))
    return A.two_clusters(e, ["label"], "v").select("label", "n", F.col("n_low").cast("long").alias("n_low"), F.round("separation", 5).alias("separation"), "splits")


@query("""WITH m AS (SELECT o_orderpriority AS g, year(o_orderdate) AS px, CAST(count(*) AS DOUBLE) AS v FROM orders GROUP BY 1, 2), s AS (SELECT g, px - lag(px) OVER w AS dp, v - lag(v) OVER w AS dv FROM m WINDOW w AS (PARTITION BY g ORDER BY px))
SELECT g, count(*) + 1 AS labels, round(stddev_pop(dv / dp) / abs(avg(dv / dp)), 5) AS cv, count(*) + 1 >= 3 AND (min(dv) > 0 OR max(dv) < 0) AND stddev_pop(dv / dp) / abs(avg(dv / dp)) <= 0.08 AS is_ladder FROM s WHERE dp IS NOT NULL GROUP BY 1""")
def tick_ladder(spark, d):
    m = t(spark, d, "orders").groupBy(F.col("o_orderpriority").alias("g"), F.year("o_orderdate").alias("px")).agg(F.count("*").cast("double").alias("v"))
    return A.ladder(m, ["g"], "px", "v").withColumn("cv", F.round("cv", 5))


@query("""WITH f AS (SELECT c_mktsegment AS panel, regr_slope(c_acctbal, c_custkey) AS m, regr_intercept(c_acctbal, c_custkey) AS b, count(*) AS points FROM customer GROUP BY 1) SELECT panel, round(m, 6) AS slope, round(b, 3) AS intercept, points, round(max(abs(m * c_custkey + b - c_acctbal)), 3) AS max_residual FROM customer JOIN f ON panel = c_mktsegment GROUP BY panel, m, b, points""")
def axis_calibration(spark, d):
    c = t(spark, d, "customer").select(F.col("c_mktsegment").alias("panel"), "c_custkey", "c_acctbal")
    return A.calibration(c, ["panel"], "c_custkey", "c_acctbal").select("panel", F.round("slope", 6).alias("slope"), F.round("intercept", 3).alias("intercept"), "points", F.round("max_residual", 3).alias("max_residual"))


@query("""WITH a AS (SELECT p_brand, p_partkey, CAST(p_size AS DOUBLE) AS x FROM part), h AS (SELECT DISTINCT p_brand, CAST(p_size AS DOUBLE) AS anchor FROM part WHERE p_partkey % 7 = 0)
SELECT a.p_brand, p_partkey, arg_min(anchor, abs(x - anchor) * 1000 + anchor / 1000) AS anchor FROM a LEFT JOIN h ON a.p_brand = h.p_brand GROUP BY 1, 2""")
def nearest_anchor(spark, d):
    p = t(spark, d, "part").select("p_brand", "p_partkey", F.col("p_size").cast("double").alias("x"))
    anchors = p.where("p_partkey % 7 = 0").select("p_brand", F.col("x").alias("anchor")).distinct()
    return R.nearest_anchor(p, anchors, ["p_brand"], "x", "anchor", ["p_partkey"])


@query("""WITH l AS (SELECT DISTINCT p_brand, p_size AS a FROM part WHERE p_partkey % 2 = 0), r AS (SELECT DISTINCT p_brand, p_size AS b FROM part WHERE p_partkey % 3 = 0), p AS (SELECT p_brand, a, b, row_number() OVER (PARTITION BY p_brand, a ORDER BY abs(a - b), b) AS ra, row_number() OVER (PARTITION BY p_brand, b ORDER BY abs(a - b), a) AS rb FROM l JOIN r USING (p_brand))
SELECT p_brand, a, b, abs(a - b) AS distance FROM p WHERE ra = 1 AND rb = 1""")
def mutual_nearest(spark, d):
    p = t(spark, d, "part")
    return R.mutual_nearest(p.where("p_partkey % 2 = 0").select("p_brand", F.col("p_size").alias("a")).distinct(), p.where("p_partkey % 3 = 0").select("p_brand", F.col("p_size").alias("b")).distinct(), ["p_brand"], "a", "b")


@query("""WITH o AS (SELECT o_custkey, o_orderkey, epoch_us(o_orderdate) AS lo, epoch_us(o_orderdate) + 30 * 86400000000 AS hi FROM orders), w AS (SELECT *, max(hi) OVER (PARTITION BY o_custkey ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM o),
r AS (SELECT *, sum(CASE WHEN reach IS NULL OR lo > reach THEN 1 ELSE 0 END) OVER (PARTITION BY o_custkey ORDER BY lo, hi ROWS UNBOUNDED PRECEDING) AS run FROM w) SELECT o_custkey, CAST(run AS BIGINT) AS run, count(*) AS n FROM r GROUP BY 1, 2""")
def interval_overlap_runs(spark, d):
    lo = F.unix_micros(F.col("o_orderdate").cast("timestamp"))
    o = t(spark, d, "orders").select("o_custkey", lo.alias("lo"), (lo + F.lit(30 * 86_400_000_000)).alias("hi"))
    return R.overlap_runs(o, ["o_custkey"], "lo", "hi").groupBy("o_custkey", F.col("run").cast("long").alias("run")).agg(F.count("*").alias("n"))


@query("""WITH s AS (SELECT o_custkey AS p, bool_or(o_orderstatus = 'F') AS passed FROM orders GROUP BY 1) SELECT c_custkey AS source_panel, CASE WHEN c_mktsegment = 'BUILDING' THEN 'NOT_DATA' ELSE 'EXTRACT' END AS disposition, CASE WHEN c_mktsegment = 'BUILDING' THEN 'NOT_TARGET' WHEN passed IS NULL THEN 'NOT_RUN' WHEN passed THEN 'COVERED' ELSE 'QUEUED' END AS coverage FROM customer LEFT JOIN s ON p = c_custkey""")
def coverage_ledger(spark, d):
    """Customers stand for panels of the inventory, orders for panels that were run."""
    states = t(spark, d, "orders").select(F.col("o_custkey").alias("source_panel"), F.when(F.col("o_orderstatus") == "F", "AUTO_PASS").otherwise("MANUAL_POINT_READ").alias("state"))
    panels = t(spark, d, "customer").select(F.col("c_custkey").alias("source_panel"), F.when(F.col("c_mktsegment") == "BUILDING", "NOT_DATA").otherwise("EXTRACT").alias("disposition"))
    return P.coverage(panels, states)


@query("""SELECT coalesce(a.k, b.k) AS k, CASE WHEN a.k IS NULL THEN 'UNKNOWN_ANSWER' ELSE 'MISSING_ANSWER' END AS problem FROM (SELECT DISTINCT doc_id AS k FROM documents WHERE doc_id % 10 <> 0) a FULL JOIN (SELECT DISTINCT doc_id AS k FROM labels) b ON a.k = b.k WHERE a.k IS NULL OR b.k IS NULL""")
def inference_exact_set(spark, d):
    declared = t(spark, d, "documents").where("doc_id % 10 <> 0").select(F.col("doc_id").alias("k"))
    return R.exact_set(declared, t(spark, d, "labels").select(F.col("doc_id").alias("k")), "k")


@query("SELECT o_custkey, sha256(string_agg(o_orderkey || '|' || o_orderstatus || '|' || o_orderpriority, chr(10) ORDER BY o_orderkey || '|' || o_orderstatus || '|' || o_orderpriority)) AS digest FROM orders GROUP BY 1")
def subject_digest(spark, d):
    return Q.digest(t(spark, d, "orders"), ["o_custkey"], F.concat_ws("|", F.col("o_orderkey").cast("string"), "o_orderstatus", "o_orderpriority"))


@query("""WITH m AS (SELECT event_id, CASE event_type WHEN 'click' THEN 'R0' WHEN 'view' THEN 'R1' WHEN 'purchase' THEN 'R2' ELSE 'R4' END AS a, CASE WHEN value < 10 THEN 'R0' WHEN value < 50 THEN 'R3' ELSE 'R1' END AS b FROM events) SELECT greatest(a, b) AS tier, count(*) AS n, greatest(a, b) <> 'R4' AS finalizable FROM m GROUP BY ALL""")
def review_tiers(spark, d):
    a = F.when(F.col("event_type") == "click", "R0").when(F.col("event_type") == "view", "R1").when(F.col("event_type") == "purchase", "R2")
    b = F.when(F.col("value") < 10, "R0").when(F.col("value") < 50, "R3").otherwise("R1")
    return t(spark, d, "events").select(S.worst_tier(a, b).alias("tier")).groupBy("tier").agg(F.count("*").alias("n")).withColumn("finalizable", F.col("tier") != "R4")


@query("""WITH c AS (SELECT o_custkey AS k, max(o_orderpriority) AS v FROM orders WHERE o_orderkey % 2 = 0 GROUP BY 1), n AS (SELECT o_custkey AS k, min(o_orderpriority) AS v FROM orders WHERE o_orderkey % 2 = 1 GROUP BY 1)
SELECT coalesce(c.k, n.k) AS k, CASE WHEN n.v IS NOT NULL AND n.v <> '5-LOW' THEN n.v ELSE coalesce(c.v, n.v) END AS v, CASE WHEN n.v IS NOT NULL AND n.v <> '5-LOW' AND c.k IS NULL THEN 'NEW' WHEN n.v IS NOT NULL AND n.v <> '5-LOW' THEN 'REPLACED' WHEN c.k IS NOT NULL THEN 'CARRIED' ELSE 'UNANSWERED' END AS origin FROM c FULL JOIN n ON c.k = n.k""")
def merge_with_carry(spark, d):
    o = t(spark, d, "orders")
    c = o.where("o_orderkey % 2 = 0").groupBy(F.col("o_custkey").alias("k")).agg(F.max("o_orderpriority").alias("v"))
    n = o.where("o_orderkey % 2 = 1").groupBy(F.col("o_custkey").alias("k")).agg(F.min("o_orderpriority").alias("v"))
    return R.merge_with_carry(c, n, "k", "v", ["5-LOW"])


@query("""WITH a AS (SELECT o_orderpriority AS p, o_orderstatus AS s, count(*) AS c FROM orders WHERE o_orderkey % 2 = 0 GROUP BY 1, 2), b AS (SELECT o_orderpriority AS p, o_orderstatus AS s, count(*) AS c FROM orders WHERE o_orderkey % 2 = 1 GROUP BY 1, 2) SELECT coalesce(a.p, b.p) AS p, coalesce(a.s, b.s) AS s, a.c AS before, b.c AS after FROM a FULL JOIN b ON a.p = b.p AND a.s = b.s WHERE a.c IS DISTINCT FROM b.c""")
def census_diff(spark, d):
    o = t(spark, d, "orders").select(F.col("o_orderpriority").alias("p"), F.col("o_orderstatus").alias("s"), "o_orderkey")
    half = lambda k: o.where(f"o_orderkey % 2 = {k}").groupBy("p", "s").agg(F.count("*").alias("c"))
    return R.changed(half(0), half(1), ["p", "s"], "c")


@query("SELECT l_partkey, l_suppkey, count(DISTINCT l_returnflag) AS n_values, count(*) AS n_items FROM lineitem GROUP BY 1, 2 HAVING count(DISTINCT l_returnflag) > 1")
def answer_conflicts(spark, d):
    return R.conflicts(t(spark, d, "lineitem"), ["l_partkey", "l_suppkey"], "l_returnflag")


@query("""WITH u AS (SELECT c_custkey AS unit, c_nationkey AS figure, c_mktsegment AS grid FROM customer), p AS (SELECT 'figures' AS scope, CAST(n_nationkey AS VARCHAR) AS key, 'BAD_FIGURE' AS code FROM nation WHERE n_regionkey = 1 UNION ALL SELECT 'values', CAST(o_custkey AS VARCHAR), 'NEGATIVE' FROM orders WHERE o_totalprice < 1000 UNION ALL SELECT 'grids', 'BUILDING', 'LEVEL_NEVER_READ')
SELECT DISTINCT key AS unit, code FROM p WHERE scope = 'values' UNION SELECT CAST(unit AS VARCHAR), code FROM p JOIN u ON scope = 'figures' AND key = CAST(figure AS VARCHAR) UNION SELECT CAST(unit AS VARCHAR), code FROM p JOIN u ON scope = 'grids' AND key = grid UNION SELECT CAST(unit AS VARCHAR), 'UNATTRIBUTED_QC_SCOPE:stray' FROM u""")
def blame_inheritance(spark, d):
    u = t(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("unit"), F.col("c_nationkey").cast("string").alias("figure"), F.col("c_mktsegment").alias("grid"))
    p = t(spark, d, "nation").where("n_regionkey = 1").select(F.lit("figures").alias("scope"), F.col("n_nationkey").cast("string").alias("key"), F.lit("BAD_FIGURE").alias("code"))
    p = p.union(t(spark, d, "orders").where("o_totalprice < 1000").select(F.lit("values"), F.col("o_custkey").cast("string"), F.lit("NEGATIVE")))
    p = p.union(spark.createDataFrame([("grids", "BUILDING", "LEVEL_NEVER_READ"), ("stray", "?", "ODD")], "scope string, key string, code string"))
    return Q.blame(p, u)


@query("""SELECT panel, o_orderkey AS reviewer, reason IS NULL AS approved, reason FROM (SELECT o.*, CASE WHEN count(*) OVER (PARTITION BY panel) > 1 THEN 'DUPLICATE_DECISION' WHEN c_custkey IS NULL THEN 'UNKNOWN_PANEL' WHEN o_orderkey % 5 = 0 THEN 'UNREGISTERED_REVIEWER' WHEN o_orderkey % 3 = 0 THEN 'REVIEWER_NOT_HUMAN' WHEN o_orderpriority <> '1-URGENT' THEN 'STALE_SUBJECT' WHEN o_orderstatus <> 'F' THEN 'NOT_APPROVED' END AS reason FROM (SELECT *, CASE WHEN o_orderkey % 7 = 0 THEN o_custkey ELSE o_orderkey END AS panel FROM orders) o LEFT JOIN customer ON c_custkey = panel)""")
def approval(spark, d):
    o = t(spark, d, "orders")
    # a review of the order's own panel, or of its customer's, which several orders share
    panel = F.when(F.col("o_orderkey") % 7 == 0, F.col("o_custkey")).otherwise(F.col("o_orderkey"))
    reviews = o.select(panel.alias("panel"), F.col("o_orderkey").alias("reviewer"), F.when(F.col("o_orderstatus") == "F", "approve").otherwise("reject").alias("decision"), F.col("o_orderpriority").alias("digest"), F.lit("2020-01-01T00:00:00").alias("reviewed_at"))
    panels = t(spark, d, "customer").select(F.col("c_custkey").alias("panel"), F.lit("1-URGENT").alias("digest"))
    registry = o.where("o_orderkey % 5 <> 0").select(F.col("o_orderkey").alias("reviewer"), F.when(F.col("o_orderkey") % 3 == 0, "AGENT").otherwise("HUMAN").alias("kind"))
    return Q.approvals(reviews, panels, registry, "2030-01-01 00:00:00")


@query("""WITH v AS (SELECT event_id, event_type, value AS m, CASE WHEN event_id % 3 <> 0 THEN value + event_id % 7 END AS a, CASE WHEN event_id % 5 <> 0 THEN value - event_id % 4 END AS b FROM events) SELECT event_id, round(CASE WHEN a IS NOT NULL AND b IS NOT NULL THEN abs(a - b) / 2 ELSE abs(coalesce(a, b) - m) END, 6) AS spread FROM v""")
def supplied_spread(spark, d):
    """Readings of whisker ends become spreads; inverted axes make no difference."""
    e = t(spark, d, "events")
    a, b = F.when(F.col("event_id") % 3 != 0, F.col("value") + F.col("event_id") % 7), F.when(F.col("event_id") % 5 != 0, F.col("value") - F.col("event_id") % 4)
    return e.select("event_id", F.round(S.half_spread(F.col("value"), a, b), 6).alias("spread"))


@query()
def least_cost_matching(spark, d):
    """Ticks of two sizes of readings of a brand, every part on one of the sides, matched within 2."""
    p = t(spark, d, "part").select("p_brand", F.col("p_size").cast("double").alias("x"), "p_partkey")
    return M.match(p.where("p_partkey % 2 = 0").select("p_brand", F.col("x").alias("a")), p.where("p_partkey % 2 = 1").select("p_brand", F.col("x").alias("b")), "p_brand", "a", "b", 2.0)


@query()
def greedy_assignment(spark, d):
    """Suppliers stand for captions, parts for regions, of a page of a hundred orders."""
    s = t(spark, d, "lineitem").groupBy((F.col("l_orderkey") / 100).cast("long").alias("page"), "l_suppkey", "l_partkey").agg(F.sum("l_quantity").alias("score"))
    return M.assign_greedily(s, "page", "l_suppkey", "l_partkey", "score", 0.5)


_EVENT_METHODS = "CASE event_id % 4 WHEN 0 THEN 'MEASURED_COLOUR' WHEN 1 THEN 'HUMAN_RESOLUTION' WHEN 2 THEN 'DECLARED_SINGLE_SERIES' ELSE 'AI_ASSIGNED_SERIES' END AS identity_method, CASE event_id % 3 WHEN 0 THEN 'MARKER_CENTER' WHEN 1 THEN 'AI_PLACED_POINT' ELSE 'MANUAL_DIGITIZED' END AS value_method"


def _methods(spark, d):
    e = t(spark, d, "events")
    return e.select("event_id", F.when(F.col("event_id") % 2 == 0, "LINE_COLOR").otherwise("SUPPLIED").alias("route"), F.expr(_EVENT_METHODS.split(" AS identity_method, ")[0]).alias("identity_method"), F.expr(_EVENT_METHODS.split(" AS identity_method, ")[1].removesuffix(" AS value_method")).alias("value_method"))


@query(f"""WITH e AS (SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 'LINE_COLOR' ELSE 'SUPPLIED' END AS route, {_EVENT_METHODS} FROM events)
SELECT event_id, route, identity_method, value_method FROM e WHERE NOT ((route = 'LINE_COLOR' AND identity_method = 'MEASURED_COLOUR' AND value_method = 'MARKER_CENTER') OR (route = 'SUPPLIED' AND ((identity_method IN ('AI_ASSIGNED_SERIES', 'DECLARED_SINGLE_SERIES') AND value_method = 'AI_PLACED_POINT') OR (identity_method = 'DECLARED_SINGLE_SERIES' AND value_method = 'MANUAL_DIGITIZED'))))""")
def method_contract(spark, d):
    return T.outside_contract(_methods(spark, d))


@query(f"""WITH e AS (SELECT event_id, {_EVENT_METHODS} FROM events) SELECT event_id, greatest(CASE identity_method WHEN 'MEASURED_COLOUR' THEN 'R0' WHEN 'HUMAN_RESOLUTION' THEN 'R0' WHEN 'DECLARED_SINGLE_SERIES' THEN 'R1' ELSE 'R2' END, CASE value_method WHEN 'AI_PLACED_POINT' THEN 'R2' ELSE 'R0' END, CASE WHEN event_id % 7 = 0 THEN 'R3' ELSE 'R0' END) AS tier FROM e""")
def row_tiers(spark, d):
    m = _methods(spark, d)
    return m.select("event_id", T.row_tier(F.col("identity_method"), F.col("value_method"), F.when(F.col("event_id") % 7 == 0, "UNSTEMMED_CAP").otherwise("NO_DISPERSION"), F.col("event_id") % 7 == 0).alias("tier"))


@query("SELECT event_id, CASE WHEN value > greatest(event_id % 50, event_id % 30) THEN 'NONLOCAL_INTERPOLATION' WHEN event_type = 'click' THEN 'RESTORED_LINE_PATTERN_GAP' WHEN event_type = 'view' THEN 'LOCAL_BRACKETED_INTERPOLATION' ELSE 'RESTORED_MASKED_FURNITURE' END AS method FROM events")
def interpolation_methods(spark, d):
    e = t(spark, d, "events")
    cause = F.when(F.col("event_type") == "click", "NONE").when(F.col("event_type") == "view", "MIXED").otherwise("STEM")
    return e.select("event_id", T.interpolation_method(F.col("value"), (F.col("event_id") % 50).cast("double"), (F.col("event_id") % 30).cast("double"), cause).alias("method"))


@query("SELECT l_orderkey, l_linenumber, round(100 - l_quantity, 6) AS mean, round(CASE WHEN l_linenumber % 3 = 0 THEN abs(l_tax * 100 + l_discount * 100) / 2 WHEN l_linenumber % 3 = 1 THEN l_tax * 100 END, 6) AS dispersion FROM lineitem")
def supplied_values(spark, d):
    """Quantities stand for pixels on an axis that falls from 100 at 0 to 0 at 100; tax and discount for the ends of whiskers."""
    li = t(spark, d, "lineitem")
    k = F.col("l_linenumber") % 3
    r = li.select(F.lit("P").alias("panel"), F.col("l_orderkey").cast("string").alias("series"), F.col("l_linenumber").cast("string").alias("position"), F.col("l_quantity").alias("y_px"), F.when(k <= 1, F.col("l_quantity") - F.col("l_tax") * 100).alias("upper_px"), F.when(k == 0, F.col("l_quantity") + F.col("l_discount") * 100).alias("lower_px"))
    panels = spark.createDataFrame([("P", "100:0;50:50;0:100", "LINEAR")], "panel string, y_ticks string, y_scale string")
    v = E.supplied_values(r, panels)
    return v.select(F.col("series").cast("long").alias("l_orderkey"), F.col("position").cast("int").alias("l_linenumber"), F.round("mean", 6).alias("mean"), F.round("dispersion", 6).alias("dispersion"))


@query("SELECT p.b AS panel, s.t AS series, z.z AS position FROM (SELECT DISTINCT p_brand AS b FROM part) p LEFT JOIN (SELECT DISTINCT p_brand AS b, p_type AS t FROM part WHERE p_size > 20) s USING (b) LEFT JOIN (SELECT DISTINCT p_brand AS b, p_size AS z FROM part WHERE p_size <= 20) z USING (b) WHERE s.t IS NOT NULL OR z.z IS NOT NULL")
def declared_cells(spark, d):
    p = t(spark, d, "part").withColumnRenamed("p_brand", "panel")
    return E.declared_cells(p.where("p_size > 20").select("panel", F.col("p_type").alias("series")), p.where("p_size <= 20").select("panel", F.col("p_size").alias("position")))


@query("""WITH v AS (SELECT l_suppkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2) SELECT l_suppkey, l_linenumber, CASE WHEN l_linenumber = 1 AND l_suppkey % 2 = 0 THEN 7 WHEN l_suppkey % 3 = 0 THEN 5 ELSE n END AS n FROM v""")
def own_sample_sizes(spark, d):
    v = t(spark, d, "lineitem").groupBy(F.lit("P").alias("panel"), F.col("l_suppkey").alias("series"), F.col("l_linenumber").alias("position")).agg(F.count("*").alias("n"))
    s = t(spark, d, "supplier").select(F.lit("P").alias("panel"), F.col("s_suppkey").alias("series"))
    own = s.where("series % 2 = 0").select("panel", "series", F.lit(1).alias("position"), F.lit(7).cast("long").alias("n")).union(s.where("series % 3 = 0").select("panel", "series", F.lit(None).cast("int"), F.lit(5).cast("long")))
    return E.own_n(v, own).select(F.col("series").alias("l_suppkey"), F.col("position").alias("l_linenumber"), "n")


@query("""WITH p AS (SELECT CASE WHEN o_orderkey % 5 = 0 THEN o_custkey ELSE o_orderkey END AS unit, count(*) AS c FROM orders GROUP BY 1), u AS (SELECT c_custkey AS unit FROM customer)
SELECT coalesce(p.unit, u.unit) AS unit, CASE WHEN c IS NULL THEN 'UNIT_WITHOUT_PANEL' WHEN u.unit IS NULL THEN 'PANEL_NAMES_UNKNOWN_UNIT' ELSE 'UNIT_SHARED_BY_PANELS' END AS code FROM p FULL JOIN u ON p.unit = u.unit WHERE c IS NULL OR u.unit IS NULL OR c > 1""")
def panel_unit_bijection(spark, d):
    unit = F.when(F.col("o_orderkey") % 5 == 0, F.col("o_custkey")).otherwise(F.col("o_orderkey"))
    panels = t(spark, d, "orders").select(F.col("o_orderkey").alias("panel"), unit.alias("unit"))
    return E.bijection_problems(panels, t(spark, d, "customer").select(F.col("c_custkey").alias("unit")))


@query("""SELECT o_orderkey AS unit, CASE WHEN o_custkey % 11 = 0 THEN 'QC_FAILED' WHEN o_custkey % 2 = 1 OR c_custkey IS NULL THEN 'NOT_APPROVED' WHEN o_custkey % 14 = 0 THEN 'INFERENCE_SET_INCOMPLETE' WHEN o_orderpriority = '5-LOW' THEN 'MODEL_ESTIMATE_ONLY' WHEN o_orderpriority = '2-HIGH' AND o_orderkey % 3 = 0 THEN 'INFERENCE_REFUSED' END AS reason FROM orders LEFT JOIN customer ON c_custkey = o_custkey""")
def release(spark, d):
    """Orders stand for values, customers for panels."""
    o = t(spark, d, "orders")
    tier = F.when(F.col("o_orderpriority") == "5-LOW", "R4").when(F.col("o_orderpriority") == "2-HIGH", "R3").otherwise("R0")
    v = o.select(F.col("o_orderkey").alias("unit"), F.col("o_custkey").alias("panel"), tier.alias("tier"), F.col("o_orderkey").alias("inference_id"), F.col("o_orderpriority"))
    asked = v.where("tier = 'R3'").select("inference_id", "panel").union(v.where("panel % 14 = 0").select(-F.col("unit"), "panel"))
    answers = v.where("tier = 'R3'").select("inference_id", "panel", (F.col("unit") % 3 != 0).alias("confirmed"))
    blamed = v.where("panel % 11 = 0").select("unit")
    approved = t(spark, d, "customer").select(F.col("c_custkey").alias("panel"), (F.col("c_custkey") % 2 == 0).alias("approved"))
    return V.finalize(v, blamed, approved, answers, asked).select("unit", "reason")


@query("""WITH q AS (SELECT c_custkey AS panel, CASE c_custkey % 4 WHEN 0 THEN 'BAR_MONO_GEOMETRY_RESOLVED' WHEN 1 THEN 'BAR_MONO_GEOMETRY' WHEN 2 THEN 'OVERLAY' ELSE 'WPD_ONLY' END AS mode FROM customer),
n AS (SELECT panel, unnest(CASE mode WHEN 'BAR_MONO_GEOMETRY_RESOLVED' THEN ['OVERLAY', 'GEOMETRY', 'RESOLUTION'] WHEN 'BAR_MONO_GEOMETRY' THEN ['OVERLAY', 'GEOMETRY'] WHEN 'OVERLAY' THEN ['OVERLAY'] ELSE ['WPD_PROJECT'] END) AS ty FROM q),
a AS (SELECT DISTINCT o_custkey AS panel, CASE o_orderstatus WHEN 'F' THEN 'OVERLAY' WHEN 'O' THEN 'GEOMETRY' ELSE 'WPD_PROJECT' END AS ty FROM orders) SELECT panel, string_agg(ty, ',' ORDER BY ty) AS missing FROM n WHERE NOT EXISTS (SELECT 1 FROM a WHERE a.panel = n.panel AND a.ty = n.ty) GROUP BY 1""")
def missing_artifacts(spark, d):
    k = F.col("c_custkey") % 4
    q = t(spark, d, "customer").select(F.col("c_custkey").alias("panel"), V.review_mode(k <= 1, k == 0, k == 2).alias("mode"))
    a = t(spark, d, "orders").select(F.col("o_custkey").alias("panel"), F.when(F.col("o_orderstatus") == "F", "OVERLAY").when(F.col("o_orderstatus") == "O", "GEOMETRY").otherwise("WPD_PROJECT").alias("type"))
    return V.missing_artifacts(q, a).select("panel", F.array_join("missing", ",").alias("missing"))


@query("SELECT o_orderkey AS value, sha256(o_custkey || '|' || o_orderkey || '|' || o_orderstatus || '|A|B||' || o_orderkey) AS inference_id FROM orders WHERE o_orderpriority IN ('2-HIGH', '3-MEDIUM')")
def inference_manifest(spark, d):
    o = t(spark, d, "orders")
    tier = F.when(F.col("o_orderpriority") == "2-HIGH", "R3").when(F.col("o_orderpriority") == "3-MEDIUM", "R2").otherwise("R0")
    v = o.select(F.col("o_custkey").alias("panel"), F.col("o_orderkey").alias("unit"), F.col("o_orderstatus").alias("cell"), F.lit("A").alias("identity_method"), F.lit("B").alias("value_method"), F.lit("").alias("dispersion_method"), F.col("o_orderkey").alias("value"), tier.alias("tier"))
    return V.inference_ids(v, canonical=False).select("value", "inference_id")


@query("""WITH f AS (SELECT l_orderkey AS k, max(l_returnflag) AS d FROM lineitem WHERE l_linenumber % 2 = 1 GROUP BY 1), s AS (SELECT l_orderkey AS k, max(l_returnflag) AS d FROM lineitem WHERE l_linenumber % 2 = 0 GROUP BY 1) SELECT f.k, upper(trim(f.d)) AS first, upper(trim(s.d)) AS second FROM f JOIN s ON f.k = s.k WHERE f.d <> s.d""")
def reviewer_disagreement(spark, d):
    li = t(spark, d, "lineitem").withColumnRenamed("l_orderkey", "k")
    side = lambda odd: li.where(F.col("l_linenumber") % 2 == odd).groupBy("k").agg(F.max("l_returnflag").alias("l_returnflag"))
    return V.disagreements(side(1), side(0), "k", "l_returnflag")


@query(r"""WITH c AS (SELECT doc_id, 'Fig. ' || (doc_id % 9) || '. ' || text || chr(10) || 'Figure ' || (doc_id % 7) || ' tail' || chr(10) || 'Fig. 4A. panel' AS t FROM documents), l AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS text, unnest(range(len(string_split(t, chr(10))))) AS line FROM c),
m AS (SELECT doc_id, line, regexp_extract(text, '^\s*(?i:fig(?:ure)?s?)[. ]*\s*([0-9]{1,3})([A-Za-z]?)\b[ .:|-]*(.*)$', 1) AS n, regexp_extract(text, '^\s*(?i:fig(?:ure)?s?)[. ]*\s*([0-9]{1,3})([A-Za-z]?)\b[ .:|-]*(.*)$', 2) AS p, trim(regexp_extract(text, '^\s*(?i:fig(?:ure)?s?)[. ]*\s*([0-9]{1,3})([A-Za-z]?)\b[ .:|-]*(.*)$', 3)) AS body FROM l)
SELECT doc_id, CAST(line AS INTEGER) AS line, CAST(n AS INTEGER) AS number, round(greatest(1.0 - CASE WHEN length(body) < 25 THEN 0.4 ELSE 0 END - CASE WHEN count(*) OVER (PARTITION BY doc_id, n) > 1 THEN 0.3 ELSE 0 END - CASE WHEN regexp_matches(body, '^[a-z]') THEN 0.3 ELSE 0 END - CASE WHEN line = 0 THEN 0.1 ELSE 0 END, 0), 2) AS confidence FROM m WHERE n <> '' AND p = ''""")
def caption_candidates(spark, d):
    c = t(spark, d, "documents").select("doc_id", F.concat(F.lit("Fig. "), F.col("doc_id") % 9, F.lit(". "), "text", F.lit("\nFigure "), F.col("doc_id") % 7, F.lit(" tail\nFig. 4A. panel")).alias("t"))
    return I.caption_candidates(c, "doc_id", "t").drop("body")


@query("""WITH b AS (SELECT l_partkey AS page, l_orderkey * 10 + l_linenumber AS k, l_quantity AS claim, epoch_us(l_shipdate) AS lo, epoch_us(l_shipdate) + 20 * 86400000000 AS hi FROM lineitem), w AS (SELECT *, max(hi) OVER (PARTITION BY page ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM b),
r AS (SELECT *, sum(CASE WHEN reach IS NULL OR lo > reach THEN 1 ELSE 0 END) OVER (PARTITION BY page ORDER BY lo, hi ROWS UNBOUNDED PRECEDING) AS run FROM w) SELECT k, row_number() OVER (PARTITION BY page, run ORDER BY claim DESC, k) > 1 AS blocked FROM r""")
def duplicate_boxes(spark, d):
    """Overlapping intervals of a page are one box; the strongest claim stays."""
    lo = F.unix_micros(F.col("l_shipdate").cast("timestamp"))
    b = t(spark, d, "lineitem").select(F.col("l_partkey").alias("page"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("k"), F.col("l_quantity").alias("claim"), lo.alias("lo"), (lo + F.lit(20 * 86_400_000_000)).alias("hi"))
    return E.strongest_box(R.overlap_runs(b, ["page"], "lo", "hi"), ["page"], "claim", "k").select("k", "blocked")


@query(f"""WITH {LEVELS_SQL}, {CELLS_SQL}, u AS (SELECT n_nationkey AS unit FROM nation), m AS (SELECT u.unit, d.cell FROM u CROSS JOIN declared d WHERE NOT EXISTS (SELECT 1 FROM cells c WHERE c.unit = u.unit AND c.cell = d.cell)),
lv AS (SELECT unit, l FROM u CROSS JOIN (SELECT unnest(['PRIORITY=1-URGENT', 'PRIORITY=2-HIGH', 'PRIORITY=3-MEDIUM', 'PRIORITY=4-NOT SPECIFIED', 'PRIORITY=5-LOW', 'STATUS=F', 'STATUS=O', 'STATUS=P', 'STATUS=X']) AS l))
SELECT 'unit' AS scope, 'FACTORIAL_CELL_MISSING' AS code, count(DISTINCT unit) AS n FROM m HAVING count(*) > 0 UNION ALL SELECT 'unit', 'FACTOR_LEVEL_MISSING', count(*) FROM lv WHERE NOT EXISTS (SELECT 1 FROM cells c WHERE c.unit = lv.unit AND contains(';' || c.cell || ';', ';' || l || ';')) HAVING count(*) > 0
UNION ALL SELECT 'values', 'IMPLAUSIBLE_VALUE', count(*) FROM cells WHERE mean_cents NOT BETWEEN 10000000 AND 40000000 HAVING count(*) > 0 UNION ALL SELECT 'values', 'DISPERSION_NONPOSITIVE', count(*) FROM cells WHERE n = 1 HAVING count(*) > 0""")
def bundle_gate(spark, d):
    """Nations stand for units, their cells of orders for values; the whole four-table gate, problems counted by code."""
    cells = _cells(spark, d)
    text = lambda c: F.col(c).cast("string")
    figures = spark.createDataFrame([("2", "F1", "1", "a", "1", "1", "", "MATCHED", "1", "1", "")], ", ".join(f"{c} string" for c in ("_line", *B.FIGURE_COLUMNS)))
    grids = spark.createDataFrame([(str(i + 2), "G1", r["factor"], r["level"], str(i)) for i, r in enumerate(_levels(spark).collect())], "_line string, Grid_ID string, Factor_Name string, Factor_Level string, Level_Order string")
    fixed = {"Figure_ID": "F1", "Grid_ID": "G1", "Panel": "A", "Outcome_Variable": "Order total", "Unit": "cents", "Statistic_Type": "CONTINUOUS", "Extraction_Method": "TRANSCRIBED", "Grid_Rule": "FULL", "Dispersion_Type": "SD", "Errorbar_Definition_Source": "SD", "N_Outcome": "10", "Value_Scale": "RATIO", "Analysis_Transformation": "UNTRANSFORMED", "Distribution_Shape": "SYMMETRIC"}
    units = t(spark, d, "nation").select(text("n_nationkey").alias("_line"), text("n_nationkey").alias("Unit_ID"), *[F.lit(v).alias(k) for k, v in fixed.items()])
    values = cells.select(F.concat_ws("/", text("unit"), "cell").alias("_line"), text("unit").alias("Unit_ID"), F.col("cell").alias("Cell_Key"), text("mean_cents").alias("Mean"), (F.col("n") - 1).cast("string").alias("Dispersion_Value"))
    ranges = spark.createDataFrame([("Order total", 10_000_000, 40_000_000)], "outcome string, low int, high int")
    return B.check_bundle(figures, grids, units, values, ranges).groupBy("scope", "code").agg(F.count("*").alias("n"))


def _load():
    """The modules that add their queries here."""
    from . import gates, ledgers  # noqa: F401


def queries() -> dict:
    _load()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(SQL)
