"""Personal data: candidate gradient boosting.

Generators with high recall propose spans, which may overlap: the four base kinds, and looser
forms (local telephone numbers, IBANs, social security numbers, IPv6 and MAC addresses, written-out
e-mail addresses, street addresses). Boosted trees on format and context features score every candidate that no
base span covers; a threshold for each kind, calibrated on held-out examples to a stated precision,
selects, and the best of overlapping candidates wins. Base spans always stay.

The trees are trained on examples that this module composes from format rules (bounded: ``examples``),
never on the corpus, so results do not depend on the input's size.

Null and empty texts have no spans, a repeated row gives a repeated result, an empty table an empty one; columns other than key and
text do not matter. Positions are code points, ends exclusive.
"""

from __future__ import annotations

import bisect
import functools
import ipaddress
import random
import re

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_texts, read_table
from .trees import fit_boosted

#: Base kinds in the order in which they are listed.
BASE_KINDS = ("email", "ip", "card", "phone")
#: Kinds that the candidate model adds, listed after the base kinds.
MODEL_KINDS = ("phone_local", "iban", "ssn", "ipv6", "mac", "email_words", "street")
#: Precision on held-out examples that the threshold of a kind must reach.
PRECISION = 0.97
#: Code points of context on either side.
CONTEXT = 32

Span = tuple[str, int, int]

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL_RUN = re.compile(r"[A-Za-z0-9._%+-]+")
# The look-behinds change no result: a run of digits that fails at its start fails at every later start too; they keep long runs linear.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _emails(text: str) -> list[Span]:
    """Around each at sign: the run of local characters before it, not reaching into the match before, and the domain after it."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        s = at
        while s > free and text[s - 1] in _LOCAL:
            s -= 1
        m = _DOMAIN.match(text, at + 1) if s < at else None
        if m:
            out.append(("email", s, m.end()))
            free = m.end()
        else:
            free = max(free, s)  # what was passed over holds no other match, so no character is passed twice
        at = text.find("@", max(at + 1, free))
    return out


def base_spans(text: str) -> list[Span]:
    out = _emails(text)
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0")[:4] or 0) <= 255 for p in m.group().split(".")):
            out.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() < 16:
            continue
        digits = m.group().replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= sum("0" <= c <= "9" for c in m.group()) <= 15:
                out.append(("phone", m.start(), m.end()))
    return out


#: Generators of the model's candidates; each starts at a digit, a bracket or a literal, so that prose is passed quickly.
GENERATORS = {
    "phone_local": re.compile(r"(?<![0-9A-Za-z+.])(?:\([0-9]{2,4}\)[ -]?|[0-9]{2,4}[ .-])(?:[0-9]{2,4}[ .-]){1,3}[0-9]{2,4}(?![0-9A-Za-z])"),
    "iban": re.compile(r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![0-9A-Za-z])"),
    "ssn": re.compile(r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])"),
    "ipv6": re.compile(r"(?<![0-9A-Za-z:.])(?:[0-9a-fA-F]{1,4}:|:(?=:)){2,7}(?::?[0-9a-fA-F]{1,4})(?![0-9A-Za-z:])"),
    "mac": re.compile(r"(?<![0-9A-Za-z:-])[0-9a-fA-F]{2}([:-])[0-9a-fA-F]{2}(?:\1[0-9a-fA-F]{2}){4}(?![0-9A-Za-z:-])"),
    "email_words": re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]++ ?(?:\[at\]|\(at\)| at ) ?[A-Za-z0-9-]{2,}+(?: ?(?:\[dot\]|\(dot\)| dot ) ?[A-Za-z0-9-]{2,}+)+"),
    "street": re.compile(r"(?<![0-9A-Za-z.,-])[0-9]{1,5} (?:[A-Z][a-z]++ ){1,3}(?:Street|St|Avenue|Ave|Road|Rd|Lane|Ln|Drive|Dr|Boulevard|Blvd|Court|Ct|Way|Place|Pl)(?![A-Za-z])"),
}
_DIGIT = re.compile(r"[0-9]")
_WRITTEN = re.compile(r"\[at\]|\(at\)|\[dot\]|\(dot\)| dot ")
CUES = {
    "phone_local": ("phone", "tel", "call", "mobile", "fax", "contact", "cell", "whatsapp"),
    "iban": ("iban", "account", "bank", "transfer", "konto", "compte"),
    "ssn": ("ssn", "social security", "security number", "taxpayer", "tin"),
    "ipv6": ("ip", "address", "host", "client", "from", "addr"),
    "mac": ("mac", "ether", "device", "address", "hardware", "wlan"),
    "email_words": ("mail", "contact", "reach", "write", "address", "me"),
    "street": ("live", "address", "home", "resid", "located", "deliver", "at"),
}
ANTI = ("version", "isbn", "order", "invoice", "page", "ratio", "score", "date", "serial", "part", "no.", "item", "model", "chapter", "equation", "time", "stone", "hash")


def candidates(text: str) -> list[Span]:
    out: list[Span] = []
    digits = _DIGIT.search(text) is not None
    for kind, pattern in GENERATORS.items():
        if kind == "email_words":
            if not _WRITTEN.search(text):
                continue
        elif kind in ("ipv6", "mac"):
            if ":" not in text and not digits:
                continue
        elif not digits:
            continue
        out += [(kind, m.start(), m.end()) for m in pattern.finditer(text)]
    return out


def _mod97(s: str) -> bool:
    s = s.replace(" ", "")
    try:
        return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1
    except ValueError:
        return False


def _valid(kind: str, s: str) -> bool:
    if kind == "iban":
        return _mod97(s)
    if kind == "ssn":
        a, b, c = s.split("-")
        return a not in ("000", "666") and a < "900" and b != "00" and c != "0000"
    if kind == "ipv6":
        try:
            return ipaddress.IPv6Address(s) is not None
        except ValueError:
            return False
    if kind == "mac":
        return len(set(re.split("[:-]", s))) > 1
    if kind == "phone_local":
        return 9 <= sum(c.isdigit() for c in s) <= 11
    if kind == "email_words":
        return s.rsplit(None, 1)[-1].rstrip(")]").lower() in ("com", "org", "net", "edu", "de", "fr", "es", "uk", "io", "gov") or "[at]" in s or "(at)" in s
    return True


def features(text: str, span: Span) -> list[float]:
    kind, start, end = span
    s = text[start:end]
    left, right = text[max(0, start - CONTEXT) : start].lower(), text[end : end + CONTEXT].lower()
    groups = re.findall(r"[0-9]+", s)
    lens = [len(g) for g in groups] or [0]
    seps = re.findall(r"[^0-9A-Za-z]+", s)
    near = max((left.rfind(c) for c in CUES[kind]), default=-1)
    anti = max((left.rfind(c) for c in ANTI), default=-1)
    return [
        float(MODEL_KINDS.index(kind)),
        float(len(s)),
        float(sum(lens)),
        float(len(groups)),
        float(max(lens)),
        float(min(lens)),
        float(len(set(seps))),
        float(_valid(kind, s)),
        float(near >= 0),
        float(near) if near >= 0 else -20.0,
        float(any(c in right for c in CUES[kind])),
        float(anti >= 0),
        float(len(set(c for c in s if c.isalnum()))),
        float(bool(left) and left[-1:] in "$€£#=/_"),
        float(right[:1] in "%/_="),
        float(s[:1] == "("),
        float(re.match(r"(?:19|20)[0-9]{2}[ .-][01]?[0-9][ .-]", s) is not None or re.match(r"[0-3]?[0-9][ .-][01]?[0-9][ .-](?:19|20)[0-9]{2}", s) is not None),
    ]


def _iban(r: random.Random) -> str:
    body = "".join(r.choice("0123456789") for _ in range(18))
    country = r.choice(("DE", "FR", "ES", "GB"))
    check = 98 - int("".join(str(int(c, 36)) for c in body + country + "00")) % 97
    s = f"{country}{check:02d}{body}"
    return " ".join(s[i : i + 4] for i in range(0, len(s), 4)) if r.random() < 0.5 else s


def example(r: random.Random) -> tuple[str, Span, int]:
    """A short text with one candidate, and whether it is personal data."""
    d = lambda n: "".join(r.choice("0123456789") for _ in range(n))
    x = lambda n: "".join(r.choice("0123456789abcdef") for _ in range(n))
    word = lambda: "".join(r.choice("abcdefghijklmnoprstuvw") for _ in range(r.randint(2, 9)))
    kind, real = r.choice(MODEL_KINDS), r.random() < 0.5
    # half of what is no personal data has its very form, and only the words before it tell
    alike = not real and kind not in ("iban", "mac", "email_words") and r.random() < 0.5
    cue = r.choice(CUES[kind]) if real and r.random() < 0.75 else r.choice(ANTI) if not real and (alike or r.random() < 0.6) else word()
    y, real = int(real), real or alike
    if kind == "phone_local":
        s = r.choice((f"({d(3)}) {d(3)}-{d(4)}", f"{d(3)}-{d(3)}-{d(4)}", f"{d(3)} {d(3)} {d(4)}", f"{d(4)} {d(3)} {d(3)}")) if real else r.choice((f"{r.randint(1900, 2030)}-{r.randint(10, 12)}-{r.randint(10, 28)}", f"{d(2)}.{d(2)}.{d(2)}", f"{d(3)} {d(3)} {d(2)}", f"{d(4)}-{d(4)}-{d(4)}-{d(4)}", f"{d(2)} {d(3)} {d(2)} {d(2)} {d(4)}"))
    elif kind == "iban":
        s = _iban(r) if real else f"{r.choice(('AB', 'SN', 'XK', 'DE'))}{d(2)}{''.join(r.choice('ABCDEF0123456789') for _ in range(16))}"
    elif kind == "ssn":
        s = f"{r.randint(100, 665)}-{r.randint(10, 99)}-{r.randint(1000, 9999)}" if real else f"{r.choice(('000', '900', '978'))}-{d(2)}-{d(4)}"
    elif kind == "ipv6":
        s = ":".join(x(4) for _ in range(8)) if real else ":".join(d(2) for _ in range(3))
    elif kind == "mac":
        s = r.choice(":-").join(x(2) for _ in range(6)) if real else r.choice(":-").join(["00"] * 6)
    elif kind == "email_words":
        s = f"{word()}{r.choice((' at ', ' [at] ', '(at)'))}{word()}{r.choice((' dot ', ' [dot] '))}{r.choice(('com', 'org', 'net', 'de'))}" if real else f"{word()} at {word()} dot {word()}"
    else:
        s = f"{d(r.randint(1, 4))} {word().title()} {r.choice(('Street', 'Avenue', 'Road', 'Lane', 'Drive'))}" if real else f"{d(r.randint(1, 4))} {word().title()} {r.choice(('Way', 'Court', 'Place', 'Dr', 'Pl', 'St'))}"
    before = f"{word()} {word()} {cue}{r.choice((': ', ' ', ' is '))}"
    return before + s + f" {word()} {word()}.", (kind, len(before), len(before) + len(s)), y


@functools.lru_cache(maxsize=2)
def trained(examples: int = 4000, seed: int = 7):
    """The trees, and for each kind the lowest threshold that reaches PRECISION on the held-out quarter (above 1: never)."""
    r = random.Random(seed)
    rows = []
    while len(rows) < examples:
        text, span, y = example(r)
        if span in candidates(text):
            rows.append((features(text, span), y, span[0]))
    x, y, kinds = np.array([a for a, _, _ in rows]), np.array([b for _, b, _ in rows], float), np.array([k for _, _, k in rows])
    cut = len(x) * 3 // 4
    model = fit_boosted(x[:cut], y[:cut], trees=60, depth=4, rate=0.2, min_leaf=5, seed=seed)
    p, limits = model.probability(x[cut:]), {}
    for k in MODEL_KINDS:
        of = kinds[cut:] == k
        pk, yk = p[of], y[cut:][of]
        good = [t for t in np.unique(pk) if t >= 0.5 and yk[pk >= t].mean() >= PRECISION]
        limits[k] = float(good[0]) if good else 2.0
    return model, limits


def find_pii(text: str | None, model=None, limits=None) -> tuple[list[Span], list[Span]]:
    """(base spans, spans that the model adds), by kind as listed, then start."""
    if not text:
        return [], []
    order = {k: i for i, k in enumerate(BASE_KINDS + MODEL_KINDS)}
    key = lambda x: (order[x[0]], x[1])
    base, more = base_spans(text), []
    if model is not None and (found := candidates(text)):
        taken: list[tuple[int, int]] = []  # base spans, those that overlap as one
        for s, e in sorted((s, e) for _, s, e in base):
            if taken and s < taken[-1][1]:
                taken[-1] = (taken[-1][0], max(taken[-1][1], e))
            else:
                taken.append((s, e))
        found = [c for c in found if not _hits(taken, c)]
        if found:
            p = model.probability(np.array([features(text, c) for c in found]))
            for _, c in sorted(((q, c) for q, c in zip(p, found, strict=True) if q >= limits[c[0]]), key=lambda x: (-x[0], x[1][1])):
                if not _hits(taken, c):
                    more.append(c)
                    bisect.insort(taken, (c[1], c[2]))
    return sorted(base, key=key), sorted(more, key=key)


def _hits(spans: list[tuple[int, int]], c: Span) -> bool:
    """Whether the candidate overlaps one of the spans, which are in order and do not overlap each other."""
    i = bisect.bisect_left(spans, (c[2], 0))
    return i > 0 and spans[i - 1][1] > c[1]


SPANS = "array<struct<kind:string,start:int,end:int>>"


def scan_pii(docs: DataFrame, key: str = "doc_id", text: str = "text", examples: int = 4000) -> DataFrame:
    """key, base spans and spans that the model adds."""
    model, limits = trained(examples)

    def make():
        return lambda t: tuple([dict(zip(("kind", "start", "end"), x, strict=True)) for x in xs] for xs in find_pii(t, model, limits))

    return map_texts(docs, [key], text, make, f"base {SPANS}, added {SPANS}")


def joined_sql(spans) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_pii(read_table(spark, sf_dir, "documents"))
    n = lambda kind: F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *[n(k) for k in BASE_KINDS], F.sha2(joined_sql("base"), 256).alias("base_sha256"), joined_sql(F.concat("base", "added")).alias("spans"), (F.size("base") + F.size("added")).cast("long").alias("n_spans"))
