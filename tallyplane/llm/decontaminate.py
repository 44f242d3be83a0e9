"""Benchmark decontamination by template canonicalisation. DataFrame functions only.

Numbers, names (capitalised words inside a sentence) and units become typed placeholders, everything else is
lower-cased words. Windows of WINDOW template words are hashed and joined with the benchmark's windows; the join
also compares the template itself, so a clash of hashes finds nothing. Placeholders' values (slots) of a document's window are laid
beside the benchmark's: along one alignment (difference of the two positions) each value of the benchmark must stand for one
and the same value, as in a question whose parameters were changed consistently; alignments that break this are
dropped. A document is contaminated by an item if the windows left cover SHARE of the item's.

Windows with fewer than LITERAL words that are no placeholders say little by their template: they match where the
values are equal too, and count beside the others; a pair is found if SHARE of all the item's windows is covered, or
SHARE of its telling ones. An item with fewer words than WINDOW has one window of all its words; documents have windows
of each such length that the benchmark has. Null and empty texts match nothing; a repeated document or item gives one
row a distinct pair of keys; rows with a null key take no part.

The benchmark is broadcast if it has at most BROADCAST_ROWS windows, otherwise windows meet by a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table, small_enough, staged

WINDOW = 6
LITERAL = 4
#: Share of an item's windows that must be covered, in percent, and the least number.
SHARE, LEAST = 25, 2
BROADCAST_ROWS = 200_000
NUM, NAME, UNIT = "\u0001", "\u0002", "\u0003"
#: Units that follow a number.
UNITS = ("km", "m", "cm", "mm", "miles", "mile", "feet", "ft", "inches", "inch", "kg", "g", "mg", "lb", "lbs", "pounds", "tons", "l", "ml", "litres", "liters", "gallons", "seconds", "second", "s", "minutes", "minute", "min", "hours", "hour", "h", "days", "day", "weeks", "years", "percent", "dollars", "euros", "cents", "mph", "kmh", "degrees", "watts", "volts", "joules", "newtons")


def raw_words(text: Column) -> Column:
    """Words parted by single spaces, capitals kept, names inside sentences marked."""
    t = F.regexp_replace(text, r"([0-9])[.,:/]([0-9])", "$1$2")
    t = F.regexp_replace(t, r"(\p{Lu}\p{Ll}+)", NAME + "$1")
    t = F.regexp_replace(t, r"(^|[.!?:][\"')]?\s+)" + NAME, "$1")
    return F.trim(F.regexp_replace(t, r"[^\p{L}\p{N}" + NAME + "]+", " "))


def template_words(raw: Column) -> Column:
    """As many words as raw, placeholders in place of slots."""
    t = F.regexp_replace(F.lower(raw), NAME + r"[^ ]+", NAME)
    t = F.regexp_replace(t, r"(^| )[0-9][^ ]*", "$1" + NUM)
    return F.regexp_replace(t, f"({NUM} )({'|'.join(UNITS)})( |$)", "$1" + UNIT + "$3")


def _windows(table: DataFrame, key: str, text: str, prefix: str, short: tuple[int, ...] = ()) -> DataFrame:
    """key, raw, words, pos (0-based) and len of every window: of WINDOW words, a shorter text as a whole; with short lengths, of each of these too."""
    raw = table.select(F.col(key).alias(prefix + "key"), raw_words(F.col(text).cast("string")).alias(prefix + "raw"))
    words = raw.withColumn(prefix + "words", F.split(template_words(F.col(prefix + "raw")), " "))
    n = F.size(prefix + "words")
    some = F.col(prefix + "raw") != ""  # no windows otherwise; a filter would be pushed below and repeat all replacements
    if not short:
        return words.select("*", F.explode(F.when(some, F.sequence(F.lit(0), F.greatest(n - WINDOW, F.lit(0))))).alias(prefix + "pos"), F.lit(WINDOW).alias(prefix + "len"))
    lengths = F.filter(F.array(*[F.lit(k) for k in (*short, WINDOW)]), lambda k: k <= n)
    places = F.flatten(F.transform(lengths, lambda k: F.transform(F.sequence(F.lit(0), n - k), lambda i: F.struct(i.alias("pos"), k.alias("len")))))
    return words.select("*", F.explode(F.when(some, places)).alias("_at")).select("*", F.col("_at.pos").alias(prefix + "pos"), F.col("_at.len").alias(prefix + "len")).drop("_at")


def _slots(prefix: str) -> Column:
    """The raw words that stand at the placeholders of the window."""
    p, words = prefix, F.slice(f"{prefix}words", F.col(f"{prefix}pos") + 1, F.col(f"{prefix}len"))
    raw = F.slice(F.split(f"{p}raw", " "), F.col(f"{p}pos") + 1, F.col(f"{p}len"))
    return F.transform(F.filter(F.arrays_zip(words.alias("t"), raw.alias("r")), lambda x: x["t"].isin(NUM, NAME, UNIT)), lambda x: F.lower(x["r"]))


def _word(prefix: str, k: int) -> Column:
    """The window's k-th word, null beyond its end. Single words, unlike slices, are read in place by generated code."""
    return F.when(F.lit(k) < F.col(prefix + "len"), F.get(F.col(prefix + "words"), F.col(prefix + "pos") + k))


def _hash(prefix: str) -> Column:
    return F.xxhash64(*[_word(prefix, k) for k in range(WINDOW)])


def _telling(prefix: str) -> Column:
    """Whether LITERAL words of the window, or all of a shorter one, are no placeholders."""
    plain = sum((F.when(_word(prefix, k).isin(NUM, NAME, UNIT), 0).when(_word(prefix, k).isNull(), 0).otherwise(1) for k in range(WINDOW)), F.lit(0))
    return plain >= F.least(F.lit(LITERAL), F.col(prefix + "len"), F.size(prefix + "words"))


def contaminated(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """key, item, n_windows (of the item, covered) and n_item (of the item) for every contaminated pair."""
    at = lambda p: F.slice(f"{p}words", F.col(f"{p}pos") + 1, F.col(f"{p}len"))
    b = _windows(benchmark, item, item_text, "b_").where(F.col("b_key").isNotNull()).withColumn("b_window", at("b_"))
    b = b.select("b_key", "b_pos", "b_window", _slots("b_").alias("b_slots"), _telling("b_").alias("b_telling"), _hash("b_").alias("b_hash"))
    b = b.withColumn("b_hash", F.when(F.col("b_telling"), F.col("b_hash")).otherwise(F.xxhash64("b_hash", "b_slots"))).distinct()
    # what the documents need beside telling windows of WINDOW words: a few lengths and a flag
    need = b.agg(F.collect_set(F.when(F.size("b_window") < WINDOW, F.size("b_window"))).alias("short"), F.max(~F.col("b_telling")).alias("dense")).first()
    sizes = b.groupBy("b_key").agg(F.countDistinct("b_pos").alias("n_item"), F.countDistinct(F.when(F.col("b_telling"), F.col("b_pos"))).alias("n_telling"))
    d = _windows(docs.where(F.col(key).isNotNull()), key, text, "d_", tuple(sorted(need["short"])))
    small = small_enough(b, BROADCAST_ROWS)
    own, window, values = _hash("d_"), at("d_"), _slots("d_")
    if need["dense"]:
        own = F.when(_telling("d_"), own).otherwise(F.xxhash64(own, values))
    d = d.withColumn("d_hash", own)
    if not small:  # a shuffled row carries its own words only, not the document's
        d = d.select("d_key", "d_pos", "d_hash", window.alias("d_window"), values.alias("d_slots"))
        window, values = F.col("d_window"), F.col("d_slots")
    # only the hash is a join key: as a key the window would be cut out for every row, and its text replaced twice (once to see if it is null)
    alike = lambda x, y: F.coalesce(x == y, F.lit(False))
    same = (F.col("d_hash") == F.col("b_hash")) & alike(window, F.col("b_window"))
    if need["dense"]:
        same = same & (F.col("b_telling") | alike(values, F.col("b_slots")))
    hits = d.join(F.broadcast(b) if small else b, same)
    slots = F.when(F.col("b_telling") & (F.size("b_slots") > 0), F.arrays_zip(F.col("b_slots").alias("b"), values.alias("d")))
    hits = staged(hits.select("d_key", "b_key", "b_pos", "b_telling", (F.col("d_pos") - F.col("b_pos")).alias("line"), slots.alias("slots")), "hits")
    # along one alignment each value of the benchmark stands for one value of the document
    told = hits.where(F.col("slots").isNotNull()).select("d_key", "b_key", "line", F.explode("slots").alias("s")).groupBy("d_key", "b_key", "line", F.col("s.b").alias("value")).agg((F.min(F.xxhash64("s.d")) != F.max(F.xxhash64("s.d"))).alias("broken"))
    broken = told.where("broken").select("d_key", "b_key", "line", F.lit(True).alias("b_telling")).distinct()
    # windows with equal values contradict nothing
    sound = hits.select("d_key", "b_key", "b_pos", "line", "b_telling").join(broken, ["d_key", "b_key", "line", "b_telling"], "left_anti")
    covered = sound.groupBy("d_key", "b_key", "b_pos").agg(F.max(F.col("b_telling").cast("int")).alias("one")).groupBy("d_key", "b_key").agg(F.count("*").alias("n_windows"), F.sum("one").alias("n_told"))
    enough = lambda n, of: (F.col(n) * 100 >= F.col(of) * SHARE) & (F.col(n) >= F.least(F.lit(LEAST), F.col(of))) & (F.col(n) > 0)
    found = covered.join(sizes, "b_key").where(enough("n_windows", "n_item") | enough("n_told", "n_telling"))
    return found.select(F.col("d_key").alias(key), F.col("b_key").alias(item), "n_windows", "n_item")


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def _sql_words(table: str, key: str) -> str:
    """raw_words and template_words in DuckDB's dialect."""
    name, num, unit = ("chr(2)", "chr(1)", "chr(3)")
    r = "regexp_replace(text, '([0-9])[.,:/]([0-9])', '\\1\\2', 'g')"
    r = f"regexp_replace({r}, '(\\p{{Lu}}\\p{{Ll}}+)', {name} || '\\1', 'g')"
    r = f"regexp_replace({r}, '(^|[.!?:][\"'')]?\\s+)' || {name}, '\\1', 'g')"
    r = f"trim(regexp_replace({r}, '[^\\p{{L}}\\p{{N}}' || {name} || ']+', ' ', 'g'))"
    t = f"regexp_replace(lower(raw), {name} || '[^ ]+', {name}, 'g')"
    t = f"regexp_replace({t}, '(^| )[0-9][^ ]*', '\\1' || {num}, 'g')"
    t = f"regexp_replace({t}, '(' || {num} || ' )({'|'.join(UNITS)})( |$)', '\\1' || {unit} || '\\3', 'g')"
    return f"(SELECT k, string_split({t}, ' ') AS words, string_split(raw, ' ') AS raws FROM (SELECT {key} AS k, {r} AS raw FROM {table} WHERE {key} IS NOT NULL) WHERE raw <> '')"


_SLOT = "(chr(1), chr(2), chr(3))"
OP5_SQL = f"""
WITH bw AS {_sql_words('benchmark', 'item_id')}, dw AS {_sql_words('documents', 'doc_id')},
b AS (SELECT DISTINCT k, pos, words[pos + 1 : pos + {WINDOW}] AS win, raws[pos + 1 : pos + {WINDOW}] AS raw FROM (SELECT *, unnest(range(0, greatest(len(words) - {WINDOW}, 0) + 1)) AS pos FROM bw)),
bt AS (SELECT * FROM b WHERE len([w for w in win if w NOT IN {_SLOT}]) >= least({LITERAL}, len(win))),
n AS (SELECT k, count(DISTINCT pos) AS n_item FROM bt GROUP BY 1),
d AS (SELECT k, pos, words[pos + 1 : pos + {WINDOW}] AS win, raws[pos + 1 : pos + {WINDOW}] AS raw FROM (SELECT *, unnest(range(0, greatest(len(words) - {WINDOW}, 0) + 1)) AS pos FROM dw)),
h AS (SELECT d.k AS dk, bt.k AS bk, bt.pos AS bpos, d.pos - bt.pos AS line, bt.win, bt.raw AS braw, d.raw AS draw FROM d JOIN bt ON d.win = bt.win),
s AS (SELECT dk, bk, line, lower(braw[i]) AS bv, lower(draw[i]) AS dv FROM (SELECT *, unnest(range(1, len(win) + 1)) AS i FROM h) WHERE win[i] IN {_SLOT}),
x AS (SELECT DISTINCT dk, bk, line FROM (SELECT dk, bk, line, bv FROM s GROUP BY ALL HAVING count(DISTINCT dv) > 1)),
c AS (SELECT dk, bk, count(DISTINCT bpos) AS n_windows FROM h WHERE NOT EXISTS (SELECT 1 FROM x WHERE x.dk = h.dk AND x.bk = h.bk AND x.line = h.line) GROUP BY 1, 2)
SELECT dk AS doc_id, bk AS item_id, n_windows, n_item FROM c JOIN n ON n.k = bk WHERE n_windows * 100 >= n_item * {SHARE} AND n_windows >= least({LEAST}, n_item)
"""
