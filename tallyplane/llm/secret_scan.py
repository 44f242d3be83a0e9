"""Secret scans: multipart credential linking.

A credential often has parts: an access identifier, a secret, an endpoint. Strong patterns are
reported by themselves. Weak candidates (a short password, a bare high-entropy string, a client
id, a host) are common in clean text, so each is reported only if a complementary part stands
near it in the same scope: candidate intervals, widened by WINDOW code points, are joined with
the intervals of the other kinds by bisection in start order, so that a text with many candidates
costs n log n and no list of pairs is made. A value has no greatest length: its span, and the distance to its
complement, end and begin where the value does.

Null and empty texts have no spans. Positions are code points, ends exclusive. A repeated row gives
a repeated result, an empty table an empty one. Columns of the input other than the key and the text are not touched.
"""

from __future__ import annotations

import bisect
import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import append_columns, free_name, map_texts, read_table

#: Base kinds in the order in which they are listed.
BASE_KINDS = ("assign", "access", "hex")
#: Kinds that the linking adds, listed after the base kinds.
LINKED_KINDS = ("weak_access", "weak_secret", "endpoint")
#: Code points on either side of a candidate within which a complementary part counts.
WINDOW = 200
#: A blank line ends a scope.
SCOPE_END = re.compile(r"\n[ \t\r]*\n")
#: Bits per character that an unlabelled string must have to be a secret candidate.
MIN_ENTROPY = 3.6

# re.ASCII: "in either case" means A-Z and a-z, not the long s or the Kelvin sign.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
KEYWORD = re.compile(r"password|passwd|secret|token|api_?key", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
WEAK_ACCESS = re.compile(r"(?<![A-Za-z0-9_])(?:(?:ASIA|AGPA|AIDA|AROA)[A-Z0-9]{12,}+|(?:access_key(?:_id)?|client_id|account_id)[\"']?[ ]?[:=][ ]?[\"']?([A-Za-z0-9._-]{4,}+))", re.A)
WEAK_SECRET = re.compile(r"(?<![A-Za-z0-9_])(?:(?:pwd|pass|secret_?access_?key|client_?secret|private_?key)[\"']?[ ]?[:=][ ]?[\"']?([A-Za-z0-9+/_.=-]{4,}+))", re.I | re.A)
LONG_TOKEN = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{32,}+={0,2}(?![A-Za-z0-9+/_=-])", re.A)
ENDPOINT = re.compile(r"(?:https?|ftp|ssh|jdbc:[a-z]+|postgres(?:ql)?|mysql|mongodb|redis|amqp)://[A-Za-z0-9.-]{3,}+(?::[0-9]{1,5})?(?:/[A-Za-z0-9._~/-]*+)?|(?<![A-Za-z0-9_])(?:host|endpoint|server)[\"']?[ ]?[:=][ ]?[\"']?[A-Za-z0-9.-]{4,}+", re.A)
HINTS = re.compile(r"AKIA|://|host|endpoint|server|pwd|pass|[Ss]ecret|SECRET|[Pp]rivate|PRIVATE|[Tt]oken|TOKEN|_id|access_key|ASIA|AGPA|AIDA|AROA|[A-Za-z0-9+/_-]{32}")

Span = tuple[str, int, int]


def entropy(s: str) -> float:
    n = len(s)
    return -sum(c / n * math.log2(c / n) for c in Counter(s).values()) if n else 0.0


def base_spans(text: str) -> list[Span]:
    """The strong patterns; [0-9a-f]{16,} finds the same spans as [0-9a-f]+ followed by a length test."""
    out: list[Span] = []
    if KEYWORD.search(text):
        out += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    if "AKIA" in text:
        out += [("access", m.start(), m.end()) for m in ACCESS.finditer(text)]
    out += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return out


class _Intervals:
    """Intervals of one role in start order; asks if any of them comes within a window of another, in the same scope."""

    def __init__(self, spans: list[Span], ends: list[int]):
        self.spans = sorted((s, e) for _, s, e in spans)
        self.starts = [s for s, _ in self.spans]
        self.reach: list[int] = []
        for _, e in self.spans:
            self.reach.append(max(e, self.reach[-1] if self.reach else 0))
        self.ends = ends

    def near(self, start: int, end: int, window: int) -> bool:
        k = bisect.bisect_right(self.ends, start)
        lo = max(start - window, self.ends[k - 1] if k else 0)
        hi = min(end + window, self.ends[k] if k < len(self.ends) else 1 << 60)
        i = bisect.bisect_left(self.starts, hi)
        # the interval itself does not count: step over it
        while i > 0 and self.reach[i - 1] > lo:
            s, e = self.spans[i - 1]
            if e > lo and (e <= start or s >= end):
                return True
            i -= 1
        return False


def linked_spans(text: str, base: list[Span], window: int = WINDOW) -> list[Span]:
    if not HINTS.search(text):
        return []
    # base spans that overlap or touch, as one
    taken: list[list[int]] = []
    for s, e in sorted((s, e) for _, s, e in base):
        if taken and s <= taken[-1][1]:
            taken[-1][1] = max(taken[-1][1], e)
        else:
            taken.append([s, e])
    starts = [s for s, _ in taken]

    def reached(at: int) -> int:
        """Where the base spans end that hold the character at this place, or the place itself."""
        i = bisect.bisect_right(starts, at)
        return max(at, taken[i - 1][1]) if i else at

    # a value that base spans cover whole is theirs; one that goes on beyond them is not
    weak_access = [("weak_access", m.start(), m.end()) for m in WEAK_ACCESS.finditer(text) if reached(m.start(1) if m[1] else m.start()) < m.end()]
    weak_secret = [("weak_secret", m.start(), m.end()) for m in WEAK_SECRET.finditer(text) if reached(m.start(1)) < m.end()]
    for m in LONG_TOKEN.finditer(text):
        s = m.group()
        if reached(m.start()) < m.end() and any(c.isdigit() for c in s) and any(c.isupper() for c in s) and any(c.islower() for c in s) and entropy(s) >= MIN_ENTROPY:
            weak_secret.append(("weak_secret", m.start(), m.end()))
    endpoint = [("endpoint", m.start(), m.end()) for m in ENDPOINT.finditer(text)]
    if not (weak_access or weak_secret or endpoint):
        return []

    def free(x: Span) -> bool:
        i = bisect.bisect_left(starts, x[2])
        return not (i and taken[i - 1][1] > x[1])

    endpoint = [x for x in endpoint if free(x)]
    ends = [m.end() for m in SCOPE_END.finditer(text)]
    access = _Intervals([x for x in base if x[0] == "access"] + weak_access, ends)
    secret = _Intervals([x for x in base if x[0] != "access"] + weak_secret, ends)
    hosts = _Intervals(endpoint, ends)
    out = [x for x in weak_access if secret.near(x[1], x[2], window)]
    out += [x for x in weak_secret if access.near(x[1], x[2], window) or hosts.near(x[1], x[2], window)]
    out += [x for x in endpoint if access.near(x[1], x[2], window) and secret.near(x[1], x[2], window)]
    return out


def find_secrets(text: str | None) -> tuple[list[Span], list[Span]]:
    """(base spans, added spans), each by start and then kind as listed."""
    if not text:
        return [], []
    order = {k: i for i, k in enumerate(BASE_KINDS + LINKED_KINDS)}
    key = lambda x: (x[1], order[x[0]], x[2])
    base = base_spans(text)
    return sorted(base, key=key), sorted(set(linked_spans(text, base)), key=key)


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


SPANS = "array<struct<kind:string,start:int,end:int>>"


def scan_secrets(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, base and linked spans of each text."""

    def make():
        return lambda t: tuple([dict(zip(("kind", "start", "end"), x, strict=True)) for x in xs] for xs in find_secrets(t))

    return map_texts(docs, [key], text, make, f"base {SPANS}, linked {SPANS}")


def redacted(text: str | None) -> str | None:
    """The text with every reported span replaced by its kind in brackets; overlapping spans are replaced as one."""
    if not text:
        return text
    base, more = find_secrets(text)
    if not base and not more:
        return text
    out, at = [], 0
    for kind, s, e in sorted(base + more, key=lambda x: (x[1], -x[2])):
        if s >= at:
            out += [text[at:s], f"[{kind.upper()}]"]
        at = max(at, e)
    return "".join(out) + text[at:]


def redact_secrets(docs: DataFrame, text: str = "text", changed: str | None = None) -> DataFrame:
    """docs with secrets of the text replaced; the other columns, whatever they are named, stay. changed names a column that says whether the text did."""
    mark = changed or free_name(docs, "_changed")

    def make():
        def each(t):
            new = redacted(t)
            return new, new != t

        return each

    out = append_columns(docs, text, make, f"`{mark}` boolean", replace=True)
    return out if changed else out.drop(mark)


def joined_sql(spans) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def op3_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(read_table(spark, sf_dir, "documents"))
    n = lambda kind: F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long")
    both = F.array_sort(
        F.transform(F.concat("base", "linked"), lambda x: F.struct(x["start"].alias("start"), F.array_position(F.array(*[F.lit(k) for k in BASE_KINDS + LINKED_KINDS]), x["kind"]).alias("place"), x["end"].alias("end"), x["kind"].alias("kind")))
    )
    return found.select(
        "doc_id",
        n("assign").alias("n_assign"),
        n("access").alias("n_access"),
        n("hex").alias("n_hex"),
        F.sha2(joined_sql("base"), 256).alias("base_sha256"),
        joined_sql(both).alias("spans"),
    )
