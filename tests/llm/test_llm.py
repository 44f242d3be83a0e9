"""The operators against brute force, the public libraries, planted cases and odd inputs."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tallyplane.llm import bpe, decontaminate, language, license_scan, ngram_join, pii, quality, registry, secret_scan, stages, topk, unigram

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs_of(spark, texts, first=0):
    rows = [(first + i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


# --- op1


def brute_topk(vectors, k=5):
    want = set()
    for q, a in vectors:
        if q % 50 == 0:
            best = sorted(((-sum(x * y for x, y in zip(a, b)), c) for c, b in vectors if c != q and len(b) == len(a)))[:k]
            want |= {(q, i + 1, c, -s) for i, (s, c) in enumerate(best)}
    return want


def test_op1_ties_and_odd_vectors(spark):
    r = random.Random(1)
    base = [[r.uniform(-1, 1) for _ in range(8)] for _ in range(12)]
    rows = [(i, base[r.randrange(12)] if i % 3 else [r.gauss(0, 1) for _ in range(8)]) for i in range(400)]
    odd = [(1000, None), (1050, [float("nan")] * 8), (1100, [None] * 8), (1150, [float("inf")] * 8), (1200, [0.5] * 3), (None, [0.1] * 8)]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows + odd], "vec_id long, embedding array<double>, rank string")
    got = {tuple(x) for x in topk.top_k(topk.quantised(df), F.col("id") % 50 == 0).collect()}
    import math

    assert got == brute_topk([(i, [math.floor(256 * x) for x in v]) for i, v in rows])


def test_op1_by_shuffle_and_empty(spark, monkeypatch):
    r = random.Random(2)
    rows = [(i, [r.randint(-300, 300) for _ in range(6)]) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, v array<long>")
    monkeypatch.setattr(topk, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(topk, "BLOCK_ROWS", (40, 40))
    monkeypatch.setattr(topk, "BLOCK_QUERIES", 3)
    assert {tuple(x) for x in topk.top_k(df, F.col("id") % 50 == 0).collect()} == brute_topk(rows)
    assert topk.top_k(df.limit(0), F.col("id") % 50 == 0).count() == 0


def test_op1_agrees_with_sql(spark, sf):
    import duckdb

    c = duckdb.connect()
    c.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf}/embeddings.parquet'")
    assert {tuple(x) for x in topk.op1_topk_search(spark, sf).collect()} == set(c.execute(topk.OP1_SQL).fetchall())


# --- op2


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(bpe.vocabulary())


def test_op2_random_texts_in_chunks(library):
    m = bpe.merges_of(bpe.vocabulary())
    e, d, r = bpe.Encoder(m), bpe.Decoder(m), random.Random(3)
    letters = "abthe  \n\t'sdlrve1 2!?éü　😀<|endoftext|>͸\U000323b0"
    for _ in range(600):
        s = "".join(r.choice(letters) for _ in range(r.randint(0, 70))) + r.choice(("", "<|endoftext|>", "'re"))
        want = library.encode(s, add_special_tokens=False).ids
        cut = sorted(r.randint(0, len(s)) for _ in range(4))
        chunks = [s[a:b] for a, b in zip([0, *cut], [*cut, len(s)])]
        assert [int(i) for part in e.stream(chunks) for i in part] == want
        assert e.encode(s).tolist() == want
        assert d.whole(want) == library.decode(want, skip_special_tokens=False)


@pytest.mark.parametrize("alphabet", ["a", "ab", "abcdefghijklmnopqrstuvwxyz", "=-", "é", " ", "0123456789"])
def test_op2_long_words(library, alphabet):
    m, r = bpe.merges_of(bpe.vocabulary()), random.Random(4)
    s = "".join(r.choice(alphabet) for _ in range(12_000))
    want = library.encode(s, add_special_tokens=False).ids
    assert bpe.Encoder(m).encode(s).tolist() == want
    if alphabet[0] not in "= 0":
        w = bpe.WordStream(m, 128)
        assert [*w.feed(s.encode()), *w.finish()] == want


def test_op2_every_letter_and_broken_bytes(library):
    m = bpe.merges_of(bpe.vocabulary())
    e, d, r = bpe.Encoder(m), bpe.Decoder(m), random.Random(5)
    cps = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for i in range(0, len(cps), 20_000):
        s = "".join(f"a{c}1 {c}!" for c in cps[i : i + 20_000 : 7])
        assert e.encode(s).tolist() == library.encode(s, add_special_tokens=False).ids
    for _ in range(200):
        ids = [r.randrange(50257) for _ in range(20)]
        assert d.whole(ids) == library.decode(ids, skip_special_tokens=False)


def test_op2_query(spark, sf, library):
    got = {x["doc_id"]: x for x in bpe.op2_bpe(spark, sf).collect()}
    for x in spark.read.parquet(f"{sf}/documents.parquet").collect():
        ids = library.encode(x["text"] or "", add_special_tokens=False).ids
        g = got.pop(x["doc_id"])
        assert (g["n_tokens"], g["ids_sha256"], g["decoded_sha256"]) == (len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False)))
    assert not got


# --- op3, op4


def plain_secrets(t):
    out = []
    for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t, re.I | re.A):
        if len(m[2]) >= 12:
            out.append(("assign", *m.span()))
    out += [("access", *m.span()) for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 18]
    out += [("hex", *m.span()) for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 16]
    return sorted(out, key=lambda x: (x[1], ("assign", "access", "hex").index(x[0])))


def test_op3_base_spans():
    r = random.Random(6)
    parts = ["password", "PASSWD", "secret", "tokEn", "api_key", "apikey", "=", ":", " ", "'", '"', "AKIA", "ABCDEFGH12", "0123abcdef", "x" * 13, "é", "\n", "ſecret", "short"]
    for _ in range(3000):
        t = "".join(r.choice(parts) for _ in range(r.randint(0, 14)))
        assert secret_scan.find_secrets(t)[0] == plain_secrets(t), t


def test_op3_links_only_complements():
    lone = "see host: db.internal.example and nothing else"
    both = "client_id=abc12345\npwd: hunter22\nhost: db.internal.example"
    assert secret_scan.find_secrets(lone) == ([], [])
    assert [k for k, _, _ in secret_scan.find_secrets(both)[1]] == ["weak_access", "weak_secret", "endpoint"]
    assert secret_scan.find_secrets("client_id=abc12345" + " x" * 300 + " pwd: hunter22")[1] == []
    assert secret_scan.find_secrets("client_id=abc12345\n\npwd: hunter22")[1] == []
    assert secret_scan.redacted("a password=0123456789abcdef b") == "a [ASSIGN] b"


def test_op3_long_values():
    """A value of any length is one span to its end, and parts behind it are near."""
    rng = random.Random(3)
    key = lambda n: "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZghijklmnopqrstuvwxyz0123456789+") for _ in range(n))
    for label in ("private_key=", "pwd: ", "secret_access_key="):
        for n in (20, 129, 320, 50_000):
            t = f"host=db.example.org {label}{key(n)} end"
            assert ("weak_secret", 20, len(t) - 4) in secret_scan.find_secrets(t)[1], (label, n)
            assert secret_scan.redacted(t) == "host=db.example.org [WEAK_SECRET] end"
    token = key(200)
    assert secret_scan.redacted(f"AKIA{'A1' * 8} {token} x") == "[ACCESS] [WEAK_SECRET] x"
    t = "pwd=hunter22 client_id=" + "a1-" * 50 + " x"
    assert secret_scan.redacted(t) == "[WEAK_SECRET] [WEAK_ACCESS] x"
    assert secret_scan.redacted("private_key=" + key(320) + " client_id=abc12345") == "[WEAK_SECRET] [WEAK_ACCESS]"
    t = "host=db.example.org private_key=" + key(200) + "0123456789abcdef" + key(100) + " x"  # a base span inside
    assert secret_scan.redacted(t).endswith("[WEAK_SECRET] x")


def test_op3_query(spark, sf):
    got = {x["doc_id"]: x for x in secret_scan.op3_secret_scans(spark, sf).collect()}
    for x in spark.read.parquet(f"{sf}/documents.parquet").collect():
        want = plain_secrets(x["text"] or "")
        g, n = got[x["doc_id"]], Counter(k for k, _, _ in want)
        assert (g["n_assign"], g["n_access"], g["n_hex"]) == (n["assign"], n["access"], n["hex"])
        assert g["base_sha256"] == sha(",".join(f"{k}:{s}:{e}" for k, s, e in want))
        assert {f"{k}:{s}:{e}" for k, s, e in want} <= set(filter(None, g["spans"].split(",")))


def plain_pii(t):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[ -]", "", m[0])
        if 16 <= len(d) <= 19 and pii.luhn(d):
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 8 <= sum(c in "0123456789" for c in m[0]) <= 15]
    return sorted(out, key=lambda x: (pii.BASE_KINDS.index(x[0]), x[1]))


def test_op4_base_spans():
    r = random.Random(7)
    parts = ["a", "b.c", "@", ".", "com", "+", "-", "1", "255", "256", "4111 1111 1111 1111", "4111111111111111", " ", "(", ")", "42.7", "٣", "é", "00012", "x@y.z", "@@", "+1 (988) 555-2485"]
    for _ in range(4000):
        t = "".join(r.choice(parts) for _ in range(r.randint(0, 14)))
        assert pii.find_pii(t)[0] == plain_pii(t), t


def test_op4_long_runs_are_fast():
    for t in ("1" * 200_000, "a" * 200_000, "a." * 100_000 + "@", "1." * 100_000, "@" * 50_000, "a@" * 50_000):
        pii.find_pii(t, *pii.trained())


def test_op4_model_leaves_prose_alone(spark, sf):
    model, limits = pii.trained()
    assert [k for k, _, _ in pii.find_pii("please call phone: (212) 555-0199 now", model, limits)[1]] == ["phone_local"]
    assert pii.find_pii("order 2024-10-12 version 10.2.3 page 12 345 67", model, limits) == ([], [])
    for x in spark.read.parquet(f"{sf}/documents.parquet").collect():
        assert pii.find_pii(x["text"], model, limits)[0] == plain_pii(x["text"] or "")


# --- op5


def test_op5_planted(spark):
    bench = spark.createDataFrame([(1, "Anna walked 12 km from Paris to the old stone bridge before the evening bell rang twice"), (2, "The red fox jumps over a lazy dog while nine birds are watching the game from above"), (3, None), (4, "")], "item_id long, text string")
    texts = [
        "Some words first. The red fox jumps over a lazy dog while nine birds are watching the game from above and more follows",
        "Then Anna walked 30 km from Lyon to the old stone bridge before the evening bell rang twice yes",  # other parameters
        "A clean text about foxes and dogs that only shares the words and not their order at all",
        None,
        "",
        "!!! ...",
    ]
    df = docs_of(spark, texts).withColumn("item_id", F.lit(9))
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(df.drop("item_id"), bench).collect()}
    assert got == {(0, 2), (1, 1)}
    assert decontaminate.contaminated(df.drop("item_id").limit(0), bench).count() == 0
    assert decontaminate.contaminated(df.drop("item_id"), bench.limit(0)).count() == 0


def test_op5_inconsistent_slots(spark):
    bench = spark.createDataFrame([(1, "if 7 boxes hold 7 balls then the total of all the balls in the 7 boxes is what")], "item_id long, text string")
    good = "if 9 boxes hold 9 balls then the total of all the balls in the 9 boxes is what"
    bad = "if 9 boxes hold 4 balls then the total of all the balls in the 3 boxes is what"
    assert [r["doc_id"] for r in decontaminate.contaminated(docs_of(spark, [good, bad]), bench).collect()] == [0]


def test_op5_short_and_dense_items(spark):
    """Items shorter than a window, and items of little but numbers, names and units, are found in longer documents."""
    items = ["Name the largest known moon", "What is 12 plus 7 times 30 minus 4 divided by 2", "3 14 15 92 65 35 89 79", "why so", "Order 12 km 30 kg 7 miles 4 lbs"]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    texts = [f"Some prose that goes on for a while. {t} and then the prose goes on." for t in items] + ["2 71 82 81 82 84 59 04 and 52 35 36 02 87", "Some prose that is known for the largest of moons. " * 3]
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(docs_of(spark, texts), bench).collect()}
    assert got == {(i, i) for i in range(5)}


def test_op5_verbatim(spark, sf):
    docs, bench = (spark.read.parquet(f"{sf}/{t}.parquet").collect() for t in ("documents", "benchmark"))
    want = {d["doc_id"] for d in docs for b in bench if b["text"] in (d["text"] or "")}
    got = {r["doc_id"] for r in decontaminate.op5_decontamination(spark, sf).collect()}
    assert want <= got and len(got - want) <= 2


# --- op6, op7


def test_op6_held_out(spark):
    d = "/root/testdata/sf0.01"
    got = {r["doc_id"]: r for r in quality.op6_quality(spark, d).collect()}
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{d}/labels.parquet").collect()}
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for i, r in got.items())
    held = [(got[i]["predicted"], y) for i, y in labels.items() if got[i]["held_out"]]
    assert sum(p == y for p, y in held) >= 0.95 * len(held)


def test_op6_odd_inputs(spark):
    docs = docs_of(spark, [None, "", "word " * 50_000, "a\n\nb"])
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = quality.fit_quality(docs, labels)
    assert [r["score"] for r in quality.score_quality(docs, model).collect()] == [0.5] * 4


def test_op7_held_out(spark):
    d = "/root/testdata/sf0.01"
    got = {r["doc_id"]: r for r in language.op7_language(spark, d).collect()}
    docs = spark.read.parquet(f"{d}/documents.parquet").collect()
    assert all(got[x["doc_id"]]["held_out"] == (zlib.crc32(str(x["doc_id"]).encode()) % 4 == 2) for x in docs)
    held = [(got[x["doc_id"]]["lang_pred"], x["lang"]) for x in docs if got[x["doc_id"]]["held_out"]]
    assert sum(p == y for p, y in held) >= 0.95 * len(held)


def test_op7_odd_inputs(spark):
    docs = docs_of(spark, [None, "", "123 !!", "the of and the of and", "中文", "x" * 100_000])
    model = language.WordModel({"en": {"the": 5, "of": 3, "and": 2}, "fr": {"le": 5, "et": 4}})
    got = [(r["lang_pred"], r["score"]) for r in language.identify(docs, model).orderBy("doc_id").collect()]
    assert [x for x, _ in got[:4]] == ["und", "und", "und", "en"] and got[4][0] in ("en", "fr")
    assert language.identify(docs, language.WordModel({})).select("lang_pred").distinct().collect()[0][0] == "und"
    assert language.fit_language(docs.limit(0)).langs == []


def test_op7_long_runs_are_scored_whole():
    m = language.WordModel({"aa": {"abab": 5, "baba": 5}, "zz": {"zyzy": 5, "yzyz": 5}})
    assert language.Predictor(m).predict("ab" * 40 + "zy" * 400)[0] == "zz"


def test_op7_long_runs_are_fitted(spark):
    rows = [(i, x * 40, lang) for i in range(40) for x, lang in (("ab", "aa"), ("zy", "zz"))]
    m = language.fit_language(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert {"ab" * 40, "zy" * 40} <= set(m.words)


# --- op8, op10


def test_op8(spark):
    mit = next(t for n, f, t in license_scan.templates() if (n, f) == ("MIT", "text"))
    texts = ["prose before. Licensed under CC BY-NC 4.0. prose after", mit, mit.replace("free of charge", "free of any charge"), "the license of a driver", None, "", "x" * 50_000 + " Released under the MIT License.", "Released under the MIT License.\nLicensed under the Apache License, Version 2.0."]
    got = defaultdict(list)
    for r in license_scan.scan_licenses(docs_of(spark, texts).withColumn("start", F.lit(1))).collect():
        got[r["doc_id"]].append((r["license"], r["exact"], texts[r["doc_id"]][r["start"] : r["end"]][:8]))
    assert got[0] == [("CC-BY-NC-4.0", True, "Licensed")]
    assert got[1] == [("MIT", True, "Permissi")] and got[2] == [("MIT", False, "Permissi")]
    assert 3 not in got and 4 not in got and 5 not in got
    assert [x[0] for x in got[6]] == ["MIT"] and sorted(x[0] for x in got[7]) == ["Apache-2.0", "MIT"]


def test_op8_published_layout():
    """Blank lines between paragraphs and items, a notice and CC0 wrapped before the cue word."""
    text = lambda name: next(t for n, f, t in license_scan.templates() if (n, f) == (name, "text"))
    mit = text("MIT").replace(" of this software", "\nof this software").replace("conditions: The", "conditions:\n\nThe")
    bsd2, bsd3 = (re.sub(r" (?=[123]\. )", "\n\n", text(n)).replace(" notice, this", " notice,\n   this") for n in ("BSD-2-Clause", "BSD-3-Clause"))
    cc0 = text("CC0-1.0").replace(" the author", "\nthe author")
    gpl = "This work is\nlicensed under the GNU General Public License,\nversion 3"
    for name, t in (("MIT", mit), ("BSD-2-Clause", bsd2), ("BSD-3-Clause", bsd3), ("CC0-1.0", cc0), ("GPL-3.0", gpl)):
        whole = "Some prose first.\n\n" + t + "\n\nMore prose."
        got = license_scan.scan(whole)
        assert [(r[2], r[7]) for r in got] == [(name, True)], (name, got)
        assert whole[got[0][0] : got[0][1]] in (t, t.rstrip(".")), name
    long = ("a licence of a driver. " * 400 + "\n\n" + mit + "\n\n") * 2  # joined blocks at their longest
    assert [(r[2], r[7]) for r in license_scan.scan(long)] == [("MIT", True)] * 2


def test_op8_several_texts_in_a_block():
    text = lambda name: next(t for n, f, t in license_scan.templates() if (n, f) == (name, "text"))
    for names in (["MIT", "BSD-3-Clause"], ["MIT", "GPL-3.0"], ["MIT", "MIT"], ["BSD-2-Clause", "MIT", "BSD-3-Clause", "Apache-2.0", "MPL-2.0", "ISC"], ["GPL-3.0", "GPL-2.0", "GPL-3.0"], ["CC0-1.0"] * 4):
        for sep in (" ", "\n\n"):
            got = license_scan.scan("prose " + sep.join(map(text, names)) + " prose")
            assert [(r[2], r[7]) for r in got] == [(n, True) for n in names], (names, got)
    words = text("MIT").split(" ")
    edited = [" ".join(words[:k] + ["other"] + words[k + 1 :]) for k in (47, 20)]
    assert [(r[2], r[5]) for r in license_scan.scan(" ".join(edited))] == [("MIT", 1)] * 2


def test_op10_against_library(spark, sf):
    from tokenizers import Tokenizer, models, pre_tokenizers

    vocab = unigram.vocabulary()
    t = Tokenizer(models.Unigram(vocab, unk_id=0, byte_fallback=True))
    t.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    c, r = unigram.Counter(vocab), random.Random(8)
    for _ in range(2000):
        s = "".join(r.choice("abthe  \n▁'s😀é<0x0A>中\x00") for _ in range(r.randint(0, 40)))
        assert c.text(s) == len(t.encode(s, add_special_tokens=False).ids), s
    small = [("<unk>", 0.0), ("▁", -1.0), ("a", -1.0), ("aa", -2.0), ("b", -1.5), ("ab", -2.5), ("aab", -3.5)]
    t = Tokenizer(models.Unigram(small, unk_id=0, byte_fallback=False))
    t.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    c = unigram.Counter(small, byte_fallback=False)
    for _ in range(2000):
        s = "".join(r.choice("aabx yz") for _ in range(r.randint(1, 14)))
        assert c.text(s) == len(t.encode(s, add_special_tokens=False).ids), s
    got = {x["doc_id"]: x["n_tokens"] for x in unigram.op10_token_counts(spark, sf).collect()}
    big = Tokenizer(models.Unigram(vocab, unk_id=0, byte_fallback=True))
    big.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    for x in spark.read.parquet(f"{sf}/documents.parquet").collect():
        assert got[x["doc_id"]] == len(big.encode(x["text"], add_special_tokens=False).ids)


# --- op9


def brute_components(texts):
    lower = {i: i + 32 for i in range(65, 91)}
    sets = {}
    for i, t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(lower))
        sets[i] = frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()
    up = {i: i for i in sets}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    keys = list(sets)
    for a in range(len(keys)):
        for b in range(a):
            x, y = sets[keys[a]], sets[keys[b]]
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                p, q = sorted((root(keys[a]), root(keys[b])))
                up[q] = p
    return {i: (len(sets[i]), root(i)) for i in sets}


def near_copies(r, n, words=60):
    """Groups of edited copies, short texts, shared passages and boundary cases."""
    vocabulary = [f"w{i}" for i in range(500)]
    passage = [r.choice(vocabulary) for _ in range(40)]
    out = []
    while len(out) < n:
        kind = r.random()
        base = [r.choice(vocabulary) for _ in range(r.choice((1, 2, 3, 4, 5, 6, 8, 9, 10, words, 2 * words)))]
        if kind < 0.2:
            base = base[: len(base) // 3] + passage + base[len(base) // 3 :]
        for _ in range(r.choice((1, 1, 2, 6, 25))):
            w = list(base)
            for _ in range(r.choice((0, 0, 1, 1, 2, 3, 5))):
                w[r.randrange(len(w))] = r.choice(vocabulary)
            if r.random() < 0.3:
                w = w[: max(1, len(w) - r.randint(0, 6))]
            out.append(" ".join(x.upper() if r.random() < 0.05 else x for x in w) + r.choice(("", " ", "\n")))
    return out[:n]


@pytest.mark.parametrize("frequent", [64, 2])
def test_op9_brute_force(spark, monkeypatch, frequent):
    monkeypatch.setattr(ngram_join, "FREQUENT", frequent)  # 2: nearly every shared token is indexed in pairs
    texts = near_copies(random.Random(9 + frequent), 500) + [None, "", " \n ", "same", "same", " ", "a b c d", "a b c d e"]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.jaccard_components(docs_of(spark, texts).withColumn("node", F.lit("x"))).collect()}
    assert got == brute_components(list(enumerate(texts)))


def test_op9_signatures_find_every_partner():
    """Whatever is frequent, partners share a signature."""
    import numpy as np

    r = random.Random(10)
    for _ in range(400):
        n = r.choice((2, 3, 4, 5, 9, 10, 40, 150))
        pool = np.array(sorted(r.getrandbits(64) for _ in range(2 * n)), np.uint64)
        x = set(pool[:n].tolist())
        y = set(x)
        for _ in range(r.randint(0, max(1, n // 8))):
            y.discard(r.choice(sorted(y)))
            if r.random() < 0.7:
                y.add(int(r.choice(pool)))
        if 100 * len(x & y) < 80 * len(x | y) or x == y:
            continue
        share = r.choice((0, 0.3, 0.8, 1))
        often = {int(t) for t in pool if r.random() < share}
        sig = lambda s: set(ngram_join.signatures(a := np.array(sorted(s), np.uint64), np.array([int(t) in often for t in a]), 80)[0].tolist())
        assert sig(x) & sig(y)


def test_op9_empty_and_repeated(spark):
    assert ngram_join.jaccard_components(docs_of(spark, [])).count() == 0
    assert [tuple(r) for r in ngram_join.jaccard_components(docs_of(spark, ["", None])).orderBy("doc_id").collect()] == [(0, 0, 0), (1, 0, 1)]
    df = docs_of(spark, ["one two three four five six"] * 2).union(docs_of(spark, ["one two three four five six"])).withColumn("doc_id", F.when(F.col("doc_id") == 1, None).otherwise(F.col("doc_id")))
    assert [r["component_id"] for r in ngram_join.jaccard_components(df).collect()] == [0, 0, 0]


# --- pipeline


def test_pipeline(spark):
    import corpus_pipeline

    d = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    start = docs.withColumn("score", F.lit("clash")).withColumn("key", F.lit(1))
    kept = start
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, d)
        assert kept.columns == start.columns, name
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    good = {r["doc_id"] for r in stages.quality(spark, docs, d).collect()}
    want = brute_components([(i, texts[i]) for i in sorted(good)])
    alone = {i for i in good if want[i][1] == i}
    clean = alone - {r["doc_id"] for r in decontaminate.op5_decontamination(spark, d).collect()}
    got = {r["doc_id"]: r["text"] for r in kept.collect()}
    assert set(got) == clean
    assert all(got[i] == secret_scan.redacted(texts[i]) for i in got)
    last = {r["doc_id"]: r for r in corpus_pipeline.run(spark, d).collect()}
    assert set(last) == clean and all(r["round_trip"] and r["n_tokens"] == len(r["ids"]) for r in last.values())


def test_pipeline_odd_rows(spark):
    d = "/root/testdata/sf0.001"
    same = "one two three four five six seven"
    rows = docs_of(spark, [None, "", same, same, "x y z"]).union(docs_of(spark, [same], 2)).union(spark.createDataFrame([(None, "only words here", None, None, None)], DOCS))
    kept = stages.near_duplicates(spark, rows, d).collect()
    assert Counter((r["doc_id"], r["text"]) for r in kept) == Counter({(0, None): 1, (1, ""): 1, (2, same): 1, (4, "x y z"): 1, (None, "only words here"): 1})
    for f in (stages.decontaminate, stages.redact):
        assert f(spark, rows, d).count() == 7
    assert stages.tokenize(spark, rows, d).where("round_trip").count() == 7


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_agrees_with_sql(spark, sf, name):
    import duckdb

    c = duckdb.connect()
    for t in ("documents", "embeddings", "benchmark"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    df = registry.queries()[name](spark, sf)
    q = c.execute(registry.oracle_sql()[name])
    have = [x[0] for x in q.description]
    assert sorted(have) == sorted(df.columns)
    assert sorted(tuple(r[x] for x in have) for r in df.collect()) == sorted(q.fetchall())


def test_encode_and_decode_apart(spark):
    df = docs_of(spark, ["a b", None, "é<|endoftext|>"]).withColumn("decoded", F.lit(1))
    got = bpe.decode(bpe.encode(df)).orderBy("doc_id").collect()
    assert [r["decoded"] for r in got] == ["a b", "", "é<|endoftext|>"] and got[2]["ids"][-1] == 50256


def test_registry():
    assert [n.split("_")[0] for n in registry.queries()] == [f"op{i}" for i in range(1, 11)]
    assert set(registry.oracle_sql()) <= set(registry.queries())


def test_op3_long_endpoints():
    """Hosts and paths end where they end."""
    for url in ("https://" + "a1." * 300 + "example.org/" + "x/" * 400, "https://h.example:8080/" + "zq" * 5000):
        t = f"pwd: hunter22 client_id=abc12345 {url} end"
        assert ("endpoint", t.index("https"), len(t) - 4) in secret_scan.find_secrets(t)[1]


def test_op3_many_base_spans_in_a_value():
    """A weak value that base spans cover is theirs, however many there are."""
    t = "client_id=abc12345 token=" + "-".join(["0123456789abcdef"] * 7) + " x"
    assert [k for k, _, _ in secret_scan.find_secrets(t)[1]] == ["weak_access"]


@pytest.mark.parametrize("scan", [secret_scan.scan_secrets, pii.scan_pii])
def test_scans_of_odd_rows(spark, scan):
    """Null and empty texts have no spans, repeated rows repeat, an empty table is empty, clashing columns do not matter."""
    hit = "mail a.b@c.de password=0123456789abcdef"
    df = docs_of(spark, [None, "", hit, "x" * 300_000]).union(docs_of(spark, [hit], 2)).withColumn("base", F.lit(1)).withColumn("_text", F.lit("y"))
    got = scan(df).collect()
    assert sorted((r["doc_id"], len(r["base"])) for r in got)[:2] == [(0, 0), (1, 0)] and len(got) == 5
    assert len({str(r["base"]) for r in got if r["doc_id"] == 2}) == 1 and all(r["base"] for r in got if r["doc_id"] == 2)
    assert scan(df.limit(0)).count() == 0


def test_op2_runs_longer_than_what_is_held(library, monkeypatch):
    """Runs of each kind across chunks, with little held back: the same ids, and no buffer that follows the text."""
    monkeypatch.setattr(bpe, "HOLD", 20)
    m, r = bpe.merges_of(bpe.vocabulary()), random.Random(13)
    for k in range(400):
        s = "".join(r.choice(("a", "1", "!", " ", "\n", "é", "'s", "'", "\x1c", " b", "<|endoftext|>", "\U000323b0")) * r.choice((1, 1, 2, 30, 90)) for _ in range(r.randint(1, 8)))
        cut = sorted(r.randint(0, len(s)) for _ in range(6))
        chunks = [s[a:b] for a, b in zip([0, *cut], [*cut, len(s)])]
        want = library.encode(s, add_special_tokens=False).ids
        assert [int(i) for part in bpe.Encoder(m).stream(chunks) for i in part] == want, s
    most, e = 0, bpe.Encoder(m)
    machine = bpe.Splitter(e)
    for _ in range(200):
        for _ in machine.feed("ab" * 500):
            pass
        most = max(most, len(machine.hold) + len(machine.word.buffer if machine.run else b""))
    assert most < 8 * bpe.WINDOW


def test_op2_odd_rows(spark, library):
    df = docs_of(spark, [None, "", "a b", "é" * 300_000]).union(docs_of(spark, ["a b"], 2)).withColumn("n_tokens", F.lit("x"))
    got = sorted((r["doc_id"], r["n_tokens"]) for r in bpe.digests(df).collect())
    n = len(library.encode("é" * 300_000, add_special_tokens=False).ids)
    assert got == [(0, 0), (1, 0), (2, 2), (2, 2), (3, n)]
    assert bpe.digests(df.limit(0)).count() == 0 and bpe.round_trip(df.limit(0)).count() == 0


def test_op1_index_is_exact_and_bounded(monkeypatch):
    """A block against brute force, with repeated ids and batches of one query; the scores of a batch stay below their bound."""
    import numpy as np

    r = np.random.default_rng(5)
    for n, width, top in ((300, 16, 256), (500, 3, 4), (700, 40, 10**6)):
        rows = r.integers(-top, top + 1, (n, width))
        ids = r.integers(0, n, n)
        q = rows[:40]
        for size in (1, 1 << 22):
            monkeypatch.setattr(topk, "SCORE_BYTES", size)
            got = topk.Block(ids, rows).search(*(x[np.argsort(ids[:40], kind="stable")] for x in (q, ids[:40])), 5)
            order = np.argsort(ids[:40], kind="stable")
            for i, found, scores in got:
                me, x = ids[:40][order][i], q[order][i]
                want = sorted((-int(rows[j] @ x), int(ids[j])) for j in range(n) if ids[j] != me)[:5]
                assert [(-int(s), int(f)) for s, f in zip(scores, found)] == want


def test_op8_spellings_names_and_tags():
    for t, license, form in (
        ("Licensed under the MIT license.", "MIT", "notice"),
        ("Apache License v2.0", "Apache-2.0", "name"),
        ("it is licensed under GPLv3 now", "GPL-3.0", "notice"),
        ("GNU GPL version 2 or later", "GPL-2.0", "name"),
        ("// SPDX-License-Identifier: BSD-3-Clause\n", "BSD-3-Clause", "tag"),
        ("Distributed under the Boost Software License, Version 1.0.", "BSL-1.0", "notice"),
        ("GNU LESSER GENERAL PUBLIC LICENSE\n   Version 3, 29 June 2007\n\nCopyright (C) 2007 Free Software Foundation, Inc.\nEveryone is permitted to copy and distribute verbatim copies\nof this license document, but changing it is not allowed.", "LGPL-3.0", "text"),
    ):
        assert [(r[2], r[3], r[7]) for r in license_scan.scan(t)] == [(license, form, True)], t
    for t in ("the license of a driver", "GPL is a word; the new license of 3 drivers", "a modified license of the common apache helicopter"):
        assert license_scan.scan(t) == []


def test_op8_against_plain_search(spark, sf):
    """Wherever a wording stands word for word, a match of its license covers it, unless a longer wording of another does."""
    plain = [(n, re.compile(r"(?<![A-Za-z0-9])" + r"[^A-Za-z0-9]+".join(w for w, _, _ in license_scan.words_of(t)) + r"(?![A-Za-z0-9])", re.I | re.A)) for n, f, t in license_scan.templates() if f != "name"]
    got = defaultdict(list)
    for r in license_scan.op8_licenses(spark, sf).collect():
        got[r["doc_id"]].append((r["start"], r["end"], r["license"]))
    n = 0
    for x in spark.read.parquet(f"{sf}/documents.parquet").collect():
        if "icens" in (x["text"] or ""):
            for name, p in plain:
                for m in p.finditer(x["text"]):
                    n += 1
                    assert any(s <= m.start() and m.end() <= e and (name == k or e - s > len(m[0])) for s, e, k in got[x["doc_id"]])
    assert n


def test_op8_odd_rows(spark):
    t = "Released under the MIT License."
    df = docs_of(spark, [None, "", t]).union(docs_of(spark, [t], 2)).withColumn("license", F.lit("x"))
    assert [(r["doc_id"], r["license"]) for r in license_scan.scan_licenses(df).collect()] == [(2, "MIT")] * 2
    assert license_scan.scan_licenses(df.limit(0)).count() == 0


def plain_language(m, text):
    """The scores word by word, without any memory."""
    import math

    import numpy as np

    total = np.zeros(len(m.langs))
    for w in language.words_of(text):
        if w in m.words:
            total = total + m.word_rows[m.words[w]]
            continue
        s = f"^{w}$"
        own = np.zeros(len(m.langs))
        for end in range(2, len(s) + 1):
            n = next((n for n in range(min(4, end), 0, -1) if s[end - n : end] in m.grams), None)
            if n:
                own = own + m.gram_rows[m.grams[s[end - n : end]]] + (4 - n) * math.log(0.4)
        total = total + 3 * own / max(len(s) - 1, 1)
    p = np.exp(total - total.max())
    return m.langs[int(np.argmax(total))], float(p.max() / p.sum())


def test_op7_against_plain_version(monkeypatch):
    """Texts with more distinct words than are remembered, and long words, are predicted as word by word."""
    r = random.Random(14)
    word = lambda letters: "".join(r.choice(letters) for _ in range(r.choice((1, 2, 3, 5, 8, 100, 1000))))
    m = language.WordModel({x: Counter(word(letters) for _ in range(300)) for x, letters in (("aa", "abcde"), ("bb", "cdefg"), ("cc", "aeiou"))})
    monkeypatch.setattr(language, "CACHE", 12)
    monkeypatch.setattr(language, "PART", 5)
    p = language.Predictor(m)
    for _ in range(150):
        t = " ".join(word("abcdefgiou") for _ in range(r.randint(1, 60)))
        got, want = p.predict(t), plain_language(m, t)
        assert got[0] == want[0] and abs(got[1] - want[1]) < 1e-9


def test_op7_odd_rows(spark):
    m = language.WordModel({"en": {"the": 5}, "fr": {"le": 5}})
    df = docs_of(spark, [None, "le le"]).union(docs_of(spark, ["le le"], 1)).withColumn("lang_pred", F.lit(1))
    assert sorted((r["doc_id"], r["lang_pred"]) for r in language.identify(df, m).collect()) == [(0, "und"), (1, "fr"), (1, "fr")]
    assert language.identify(df.limit(0), m).count() == 0


REAL_PII = """You can phone me on (415) 555-0132 after six|phone_local
call her mobile 415-555-0178 instead|phone_local
tel 020 7946 0958 in London|phone_local
fax: 555 010 9934 please|phone_local
my IBAN is DE89 3704 0044 0532 0130 00 thanks|iban
transfer it to bank account GB29NWBK60161331926819 today|iban
her SSN is 123-45-6789 as filed|ssn
social security 219-09-9999 on the form|ssn
client address 2001:0db8:85a3:0000:0000:8a2e:0370:7334 logged in|ipv6
the device mac 3c:22:fb:9a:01:7e was seen|mac
hardware address 00-1B-44-11-3A-B7 of the laptop|mac
mail jane.doe [at] example [dot] org for details|email_words
contact peter(at)mailhost(dot)de tonight|email_words
reach me: bob at example dot com always|email_words
she lives at 221 Baker Street with friends|street
deliver to 1600 Amphitheatre Avenue today|street
home address 42 Maple Lane since then|street""".split("\n")
NO_PII = """version 10.2.31 was released|isbn 978-3-16-148410|invoice 2023-11-05 was paid|order 415-555-0178 shipped late|part no. 123-45-6789 is out of stock|score 21 19 25 23 in four sets|date 12.10.2024 and 13.10.2024|ratio 16:9 at 12:30:45 today|chapter 3 Park Way|serial 219-09-9999 on the box|page 212 to 218 and 220|we meet at noon dot dot dot""".split("|")


def test_op4_recall_and_precision_of_the_model():
    """Sentences that no example was composed from: at least 0.9 of the planted spans are found, and nothing in the others."""
    model, limits = pii.trained()
    hits = [k in [x for x, _, _ in pii.find_pii(t, model, limits)[1]] for t, k in (x.split("|") for x in REAL_PII)]
    assert sum(hits) >= 0.9 * len(hits), [t for t, h in zip(REAL_PII, hits) if not h]
    assert [t for t in NO_PII if pii.find_pii(t, model, limits) != ([], [])] == []


def test_op4_spans_do_not_overlap_what_is_taken():
    """Against a plain check of every pair, with many base spans inside a candidate's reach."""
    model, limits = pii.trained()
    r = random.Random(15)
    parts = ["phone 415-555-0178 ", "a@b.c ", "1.2.3.4 ", "4111 1111 1111 1111 ", "+1 (988) 555-2485 ", "ssn 123-45-6789 ", "x ", "call (212) 555-0199 "]
    for _ in range(300):
        t = "".join(r.choice(parts) for _ in range(r.randint(1, 12)))
        base, more = pii.find_pii(t, model, limits)
        every = [(s, e) for _, s, e in base + more]
        assert all(e <= s2 or e2 <= s for _, s, e in more for s2, e2 in every if (s, e) != (s2, e2))
        free = [c for c in pii.candidates(t) if not any(c[1] < e and s < c[2] for _, s, e in base)]
        q = model.probability(pii.np.array([pii.features(t, c) for c in free])) if free else []
        assert all(any(c[1] < e and s < c[2] for s, e in every) for p, c in zip(q, free) if p >= limits[c[0]])
    long = "x" * 100 + " at " + "host" * 100 + " dot com"
    assert [k for k, _, _ in pii.candidates("mail " + long)] == ["email_words"]


def test_op5_odd_rows(spark):
    """Rows without a key take no part, repeated rows give one row, very long texts are searched whole."""
    item = "the red fox jumps over a lazy dog while nine birds are watching the game from above"
    bench = spark.createDataFrame([(1, item), (1, item), (None, item)], "item_id long, text string")
    long = "some words that go on and on " * 20_000 + item
    df = docs_of(spark, [item, long]).union(docs_of(spark, [item])).union(spark.createDataFrame([(None, item, None, None, None)], DOCS))
    assert sorted((r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(df.withColumn("b_key", F.lit(1)), bench).collect()) == [(0, 1), (1, 1)]


def test_op6_rules_against_plain_version(spark, sf):
    """The compiled column gives what the rules give one by one; repeated rows and clashing columns are scored alike."""
    import math

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = quality.fit_quality(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    got = quality.score_quality(docs.union(docs).withColumn("log_chars", F.lit("x")).withColumn("score", F.lit(1)), model).collect()
    assert len(got) == 2 * len(texts) and len({tuple(r) for r in got}) == len(texts)
    for r in got:
        x = quality.stats(texts[r["doc_id"]])
        z = model.bias + sum(w for rule, w in zip(model.rules, model.weights) if all((x[j] <= t) == le for j, t, le in rule))
        assert abs(r["score"] - 1 / (1 + math.exp(-z))) < 1e-9 and r["predicted"] == int(r["score"] >= 0.3)
    assert quality.score_quality(docs.limit(0), model).count() == 0


def test_op10_odd_rows(spark):
    df = docs_of(spark, [None, "", "a b"]).union(docs_of(spark, ["a b"], 2)).withColumn("n_tokens", F.lit("x"))
    got = sorted((r["doc_id"], r["n_tokens"]) for r in unigram.count_tokens(df).collect())
    assert got[:2] == [(0, 0), (1, 0)] and got[2] == got[3] and got[2][1] > 0
    assert unigram.count_tokens(df.limit(0)).count() == 0


def test_op1_repeated_ids(spark):
    """Rows that share a query's id count as the query's own; repeated rows of other ids each count."""
    rows = [(0, [1, 0]), (0, [9, 9]), (1, [2, 0]), (1, [2, 0]), (2, [1, 1])]
    got = topk.top_k(spark.createDataFrame(rows, "id long, v array<long>"), F.col("id") == 0, 3).collect()
    assert sorted((r["rank"], r["vec_id"], r["score"]) for r in got) == [(1, 1, 2), (1, 1, 18), (2, 1, 2), (2, 1, 18), (3, 2, 1), (3, 2, 18)]


def test_pipeline_of_an_empty_table(spark):
    import corpus_pipeline

    docs = docs_of(spark, [])
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, "/root/testdata/sf0.001")
        assert docs.count() == 0 and docs.columns[0] == "doc_id"
    assert corpus_pipeline.STAGES[-1][1](spark, docs, "/root/testdata/sf0.001").count() == 0


def test_pipeline_quality_of_odd_rows(spark, sf):
    """The quality stage keeps or drops a row by its score alone, whatever its other columns."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").union(docs_of(spark, [None, "", "one two"], 10**6)).withColumn("_log_chars", F.lit(None).cast("string"))
    kept = stages.quality(spark, docs, sf)
    model = quality.fit_quality(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    want = {r["doc_id"] for r in quality.score_quality(docs, model).where("score >= 0.3").collect()}
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == want


def test_op5_by_shuffle(spark, sf, monkeypatch):
    want = sorted(map(tuple, decontaminate.op5_decontamination(spark, sf).collect()))
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", 0)
    assert want and sorted(map(tuple, decontaminate.op5_decontamination(spark, sf).collect())) == want
