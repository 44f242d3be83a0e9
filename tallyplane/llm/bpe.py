"""BPE encoding and decoding with bounded lookahead.

The encoder is a streaming transducer. Text comes in chunks of any size; two bounds say what may
be emitted:

* Splitting into words looks ahead two characters (the longest contraction has three).
* Within a word, a merge list has a *sufficient lookahead* K, computed once from the list: a token
  boundary of the merged buffer that lies more than K bytes before the buffer's end is a
  boundary whatever follows. The bound follows the way a difference on the right can travel to the left:
  it does so only by a merge (u, v) that applies in one case and not in the other, where v begins at the leftmost
  differing position, so that some left-hand part of v took part in an earlier merge of the same kind. Ranks rise
  along such a chain (a part is made before it is used, which is checked on loading), so the largest
  sum of len(u) over chains is a dynamic programme over the list.

So a word of any length needs a buffer of WINDOW + K bytes. Text before a stable boundary is never
looked at again, since no merge crosses it.

The decoder keeps a UTF-8 state machine between tokens: bytes go in, text comes out as soon as a code
point is complete, and each maximal invalid part becomes U+FFFD, as the library's does.

So what is held is bounded whatever a text's or a word's length; encode(), which returns all ids, feeds the same machine in
chunks. Null texts encode and decode as empty ones, a repeated row gives a repeated result, an empty table an empty one; other
columns stay.
"""

from __future__ import annotations

import codecs
import functools
import hashlib
import heapq
import itertools
import json
import re
import unicodedata
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import FLUSH_CHARS, arrow_schema, map_texts, read_table, tidied

#: The words that merges do not cross (the file's byte-level splitter).
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")


def newer_than_library() -> regex.Pattern:
    """Letters and numbers that Python's own Unicode tables, like the tokenizers library's, do not have yet: the library takes them as symbols."""
    every = "".join(map(chr, itertools.chain(range(0x80, 0xD800), range(0xE000, 0x110000))))
    new = "".join(c for c in regex.findall(r"[\p{L}\p{N}]", every) if unicodedata.category(c) == "Cn")
    return regex.compile("[" + "".join(regex.escape(c, special_only=False) for c in new) + "]") if new else regex.compile("(?!)")


NEWER = newer_than_library()


def for_splitting(text: str) -> str:
    """text with newer letters replaced by a symbol of the same length."""
    if text.isascii():
        return text
    try:
        text.encode("latin-1")
        return text
    except UnicodeEncodeError:
        return NEWER.sub("\ue000", text)


#: Kinds of characters of which a word consists, but for a space before them and for contractions.
LETTERS, NUMBERS, SPACES, SYMBOLS = KINDS = tuple(regex.compile(x) for x in (r"\p{L}+", r"\p{N}+", r"\s+", r"[^\s\p{L}\p{N}]+"))
#: White space (in the widest sense) that a space follows.
SPACE_RUN = re.compile(r"\s ")
#: Characters fed at a time, and characters held back without a boundary.
CHUNK, HOLD = 1 << 16, 4096
#: Characters that may follow a word and change it.
WORD_LOOKAHEAD = 2
#: A word that is longer goes through the windowed merge.
LONG_WORD = 64
#: Bytes merged at once in a long word, besides the lookahead.
WINDOW = 4096
#: Words kept; beyond, a task starts anew.
CACHE = 600_000
_RANK = 1 << 20
_NONE, _ID, _HIGH = _RANK << 20, _RANK - 1, [b << 8 for b in range(256)]


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in byte-level vocabularies: printable ones for themselves, the rest from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Merges:
    """A byte-level BPE vocabulary: its merges by pair, its tokens' bytes, and its sufficient lookahead."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, letters = spec["model"], byte_letters()
        vocab: dict[str, int] = model["vocab"]
        self.specials = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in spec.get("added_tokens", [])):
            raise ValueError("added tokens that strip, normalise or need word ends are not supported")
        self.token_bytes: dict[int, bytes] = {}
        for s, i in vocab.items():
            self.token_bytes[i] = bytes(letters[c] for c in s) if all(c in letters for c in s) else s.encode()
        for s, i in self.specials.items():
            self.token_bytes[i] = s.encode() if s not in vocab or not all(c in letters for c in s) else self.token_bytes[i]
        self.of_byte = [vocab[c] for c, _ in sorted(letters.items(), key=lambda x: x[1])]
        self.pairs: dict[int, int] = {}
        self.lookahead = 0
        made_at = {i: -1 for i in self.of_byte}
        spine = {i: (i,) for i in self.of_byte}  # tokens that a token's bytes go through at its left end
        best: dict[int, int] = {}  # by left part: the longest chain that ends in a merge with it
        for rank, pair in enumerate(model["merges"]):
            u, v = pair.split(" ") if isinstance(pair, str) else pair
            a, b, c = vocab[u], vocab[v], vocab[u + v]
            if made_at.get(a, _RANK) >= rank or made_at.get(b, _RANK) >= rank:
                raise ValueError(f"merge {rank} uses a token that is not made before it")
            made_at.setdefault(c, rank)
            spine.setdefault(c, (*spine[a], c))
            self.pairs.setdefault(a << 20 | b, rank << 20 | c)
            far = len(self.token_bytes[a]) + max((best.get(t, 0) for t in spine[b]), default=0)
            best[a] = max(best.get(a, 0), far)
            self.lookahead = max(self.lookahead, far)
        #: What pairs of bytes merge to, by first byte * 256 + second.
        self.of_bytes = [self.pairs.get(a << 20 | b, _NONE) for a in self.of_byte for b in self.of_byte]
        self.special_split = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(self.specials, key=len, reverse=True)) + ")") if self.specials else None

    def merged(self, word: bytes) -> list[int]:
        """The tokens of a short word: the lowest rank first, leftmost first."""
        ids = list(map(self.of_byte.__getitem__, word))
        get, none = self.pairs.get, _NONE
        ranks = list(map(self.of_bytes.__getitem__, map(int.__add__, map(_HIGH.__getitem__, word), word[1:])))
        while ranks:
            low = min(ranks)
            if low == none:
                break
            i = ranks.index(low)
            ids[i] = made = low & _ID
            del ids[i + 1], ranks[i]
            if i:
                ranks[i - 1] = get(ids[i - 1] << 20 | made, none)
            if i < len(ranks):
                ranks[i] = get(made << 20 | ids[i + 1], none)
        return ids

    def merged_long(self, word: bytes) -> list[int]:
        """As merged(), in n log n: a heap of pairs over a linked list."""
        n, get = len(word), self.pairs.get
        ids = [self.of_byte[b] for b in word]
        nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r >> 20, i, r & (_RANK - 1), ids[i], ids[i + 1]) for i in range(n - 1) if (r := get(ids[i] << 20 | ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, made, a, b = heapq.heappop(heap)
            j = nxt[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j], nxt[i] = made, -1, nxt[j]
            if nxt[j] < n:
                prv[nxt[j]] = i
            for x, y in ((prv[i], i), (i, nxt[i])):
                if x >= 0 and y < n and (r := get(ids[x] << 20 | ids[y])) is not None:
                    heapq.heappush(heap, (r >> 20, x, r & (_RANK - 1), ids[x], ids[y]))
        return [t for t in ids if t >= 0]


class WordStream:
    """The tokens of one word whose bytes come in pieces."""

    def __init__(self, merges: Merges, window: int = WINDOW):
        self.m, self.window, self.buffer = merges, window, bytearray()

    def feed(self, piece: bytes) -> Iterator[int]:
        at = 0
        while at < len(piece):
            take = self.window + self.m.lookahead - len(self.buffer)
            self.buffer += piece[at : at + max(take, 1)]
            at += max(take, 1)
            if len(self.buffer) >= self.window + self.m.lookahead:
                yield from self._emit()

    def _emit(self) -> Iterator[int]:
        done, safe = 0, len(self.buffer) - self.m.lookahead
        for t in self.m.merged_long(bytes(self.buffer)):
            n = len(self.m.token_bytes[t])
            if done + n > safe:
                break
            done += n
            yield t
        if not done:  # a token longer than the window: cannot be, as the window exceeds every token
            raise AssertionError("window shorter than a token")
        del self.buffer[:done]

    def finish(self) -> Iterator[int]:
        yield from self.m.merged_long(bytes(self.buffer))
        self.buffer.clear()


class _Cache(dict):
    """What make() gives by key, for short keys. When full, it becomes the old half, from which keys in use come back."""

    def __init__(self, make):
        super().__init__()
        self.make, self.old = make, {}

    def __missing__(self, key: str) -> bytes:
        out = self.old.get(key)
        if out is None:
            out = self.make(key)
        if len(key) <= LONG_WORD:
            if len(self) >= CACHE // 2:
                self.old = dict(self)
                self.clear()
            self[key] = out
        return out


class Splitter:
    """Ids of ordinary text (no special tokens) that comes in pieces; holds at most about HOLD characters, whatever a word's length.

    A space behind a character that is no white space always begins a word, so text before the last such space is
    final. Text without one is split into words, of which those that end WORD_LOOKAHEAD characters before the end are final. A word longer
    than HOLD becomes a run: its characters go to a WordStream until one of another kind comes (of white space, the last character may
    belong to the next word and stays).
    """

    def __init__(self, encoder: Encoder):
        self.e, self.hold, self.run = encoder, "", None

    def feed(self, text: str) -> Iterator[np.ndarray]:
        self.hold += text
        while self.hold:
            if self.run and not (yield from self._go_on()):
                return
            hold = self.hold
            p = hold.rfind(" ")
            while p > 0 and hold[p - 1].isspace():
                p = hold.rfind(" ", 0, p)
            if p > 0:
                yield self.e.pieces(hold[:p])
                hold = hold[p:]
            if len(hold) > HOLD:
                parts, end, limit = self.e.split(hold), len(hold), len(hold) - WORD_LOOKAHEAD
                last = ""
                while parts and end > limit:  # more text may change these
                    last = parts.pop()
                    end -= len(last)
                if parts:
                    yield self.e.segment(parts)
                    hold = hold[end:]
                if len(last) > HOLD:
                    self.run = next(k for k in KINDS if k.match(for_splitting(last[1])))  # the first may be the space of a word
                    self.word = WordStream(self.e.m)
                    if self.run is not SPACES and self.run.match(for_splitting(last[0])) is None:
                        yield self._ids(self.word.feed(last[0].encode()))
                        hold = hold[1:]
                    self.hold = hold
                    continue
            self.hold = hold
            return

    def _ids(self, ids: Iterable[int]) -> np.ndarray:
        return np.fromiter(ids, np.int32)

    def _go_on(self):
        """Feeds the run; True if it has ended and more text follows."""
        m = self.run.match(for_splitting(self.hold))
        end = m.end() if m else 0
        keep = int(self.run is SPACES)
        over = end < len(self.hold)
        if end > keep:
            yield self._ids(self.word.feed(self.hold[: end - keep].encode()))
            self.hold = self.hold[end - keep :]
        if over:
            yield self._ids(self.word.finish())
            self.run = None
        return over

    def finish(self) -> Iterator[np.ndarray]:
        if self.run:  # what is held is white space that nothing follows
            yield self._ids(self.word.feed(self.hold.encode()))
            yield self._ids(self.word.finish())
        else:
            yield self.e.pieces(self.hold)
        self.hold, self.run = "", None


class Encoder:
    """encode() for whole texts, stream() for chunks; both run the same machine."""

    def __init__(self, merges: Merges):
        self.m = merges
        self.words = _Cache(lambda w: array("i", self.word(w)).tobytes())
        #: What stands between spaces, with the space before it.
        self.spaced = _Cache(self._piece)

    def word(self, word: str) -> list[int]:
        raw = word.encode()
        if len(raw) <= LONG_WORD:
            return self.m.merged(raw)
        s = WordStream(self.m)
        return [*s.feed(raw), *s.finish()]

    def _piece(self, piece: str) -> bytes:
        """Ids of a space and what follows it; letters alone are one word, and so are letters before one last symbol."""
        if piece.isalpha():
            return array("i", self.word(" " + piece)).tobytes()
        last = piece[-1:]
        if last.isascii() and not last.isalnum() and not last.isspace() and piece[:-1].isalpha():
            return self.spaced[piece[:-1]] + self.words[last]
        return b"".join([self.words[w] for w in self.split(" " + piece)])

    def split(self, text: str) -> list[str]:
        seen = for_splitting(text)
        return WORDS.findall(text) if seen is text else [text[m.start() : m.end()] for m in WORDS.finditer(seen)]

    def segment(self, parts: list[str]) -> np.ndarray:
        words = self.words
        return np.frombuffer(b"".join([words[w] for w in parts]), np.int32)

    def pieces(self, text: str) -> np.ndarray:
        """Ids of a text that is split as a whole. Where no space follows white space, every space begins a word, and what is between spaces is looked up at once."""
        if SPACE_RUN.search(text):
            return self.segment(self.split(text))
        first, *more = text.split(" ")
        words = self.words
        return np.frombuffer(b"".join([*[words[w] for w in self.split(first)], *map(self.spaced.__getitem__, more)]), np.int32)

    def encode(self, text: str | None) -> np.ndarray:
        return np.concatenate([np.zeros(0, np.int32), *self.stream(chunks_of(text or ""))])

    def stream(self, chunks: Iterable[str]) -> Iterator[np.ndarray]:
        """Ids of the chunks' concatenation, emitted once stable."""
        specials, machine = self.m.special_split, Splitter(self)
        if not specials:
            for chunk in chunks:
                yield from machine.feed(chunk)
            yield from machine.finish()
            return
        ids, ahead, hold = self.m.specials, max(map(len, self.m.specials)) - 1, ""
        for chunk in chunks:
            hold += chunk
            *parts, hold = specials.split(hold) if any(s in hold for s in ids) else (hold,)
            for i, part in enumerate(parts):
                if i % 2:
                    yield np.array([ids[part]], np.int32)
                else:
                    yield from machine.feed(part)
                    yield from machine.finish()
            if len(hold) > ahead:  # its last characters may begin a special token
                yield from machine.feed(hold[: len(hold) - ahead])
                hold = hold[len(hold) - ahead :]
        yield from machine.feed(hold)
        yield from machine.finish()


def chunks_of(text: str) -> Iterator[str]:
    return (text[i : i + CHUNK] for i in range(0, len(text), CHUNK))


class Decoder:
    """Text of tokens that come one after the other."""

    def __init__(self, merges: Merges):
        self.bytes = [merges.token_bytes.get(i, b"") for i in range(max(merges.token_bytes) + 1)]
        self.state = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: Iterable[int]) -> str:
        return self.state.decode(b"".join(map(self.bytes.__getitem__, ids)))

    def finish(self) -> str:
        return self.state.decode(b"", final=True)

    def whole(self, ids: list[int], step: int = 65536) -> str:
        self.state.reset()
        return "".join([*(self.feed(ids[i : i + step]) for i in range(0, len(ids), step)), self.finish()])


@functools.lru_cache(maxsize=2)
def merges_of(path: str) -> Merges:
    return Merges(path)


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _mapped(df: DataFrame, column: str, each, out_field: str) -> DataFrame:
    """df with a column appended that each() gives task by task from column; output is flushed by size."""
    schema = df.sparkSession.createDataFrame([], f"x {out_field}").schema
    kept = df.select("*")
    full = type(kept.schema)([*kept.schema.fields, schema["x"].__class__(f"_made_{column}", schema["x"].dataType)])
    arrow = arrow_schema(full)
    at = kept.columns.index(column)

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = each()
        for batch in batches:
            lo, size, made = 0, 0, []
            values = batch.column(at)
            for i in range(batch.num_rows):
                made.append(f(values[i]))
                size += len(made[-1]) if made[-1] is not None else 0
                if size >= FLUSH_CHARS or i + 1 == batch.num_rows:
                    cols = [batch.column(k).slice(lo, len(made)).cast(arrow.field(k).type) for k in range(batch.num_columns)]
                    yield pa.RecordBatch.from_arrays([*cols, pa.array(made, type=arrow.field(len(cols)).type)], schema=arrow)
                    lo, size, made = i + 1, 0, []

    return kept.mapInArrow(run, full)


def encode(docs: DataFrame, text: str = "text", ids: str = "ids", path: str | None = None) -> DataFrame:
    """docs with the token ids of the text in a column; clashing names are replaced."""
    path = path or vocabulary()

    def each():
        encoder = Encoder(merges_of(path))
        return lambda t: encoder.encode(t.as_py())

    base = docs.drop(ids).withColumn(text, F.col(text).cast("string"))
    return _mapped(base, text, each, "array<int>").withColumnRenamed(f"_made_{text}", ids)


def decode(coded: DataFrame, ids: str = "ids", text: str = "decoded", path: str | None = None) -> DataFrame:
    """coded with the text of the ids in a column; null ids give an empty text."""
    path = path or vocabulary()

    def each():
        decoder = Decoder(merges_of(path))
        return lambda x: decoder.whole(x.values.to_numpy(zero_copy_only=False).tolist() if x.is_valid else [])

    return _mapped(coded.drop(text), ids, each, "string").withColumnRenamed(f"_made_{ids}", text)


def round_trip(docs: DataFrame, text: str = "text", ids: str = "ids", decoded: str = "decoded", path: str | None = None) -> DataFrame:
    """encode() and decode() in one pass: docs with ids and the text that they decode to; one worker a task holds both machines."""
    path = path or vocabulary()
    kept = docs.drop(ids, decoded)
    schema = kept.sparkSession.createDataFrame([], "_ids array<int>, _decoded string").schema
    full = type(kept.schema)([*kept.schema.fields, *schema.fields])
    arrow = arrow_schema(full)
    at = kept.columns.index(text)

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = Encoder(merges_of(path)), Decoder(merges_of(path))
        for batch in batches:
            lo, size, coded, plain = 0, 0, [], []
            texts = batch.column(at)
            for i in range(batch.num_rows):
                coded.append(encoder.encode(texts[i].as_py()))
                plain.append(decoder.whole(coded[-1].tolist()))
                size += len(plain[-1])
                if size >= FLUSH_CHARS or i + 1 == batch.num_rows:
                    ends = np.concatenate(([0], np.cumsum([len(x) for x in coded]))).astype(np.int32)
                    cols = [batch.column(k).slice(lo, len(coded)).cast(arrow.field(k).type) for k in range(batch.num_columns)]
                    lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(coded)), type=arrow.field(len(cols)).type)
                    yield pa.RecordBatch.from_arrays([*cols, lists, pa.array(plain, pa.string())], schema=arrow)
                    lo, size, coded, plain = i + 1, 0, [], []

    return kept.mapInArrow(run, full).withColumnRenamed("_ids", ids).withColumnRenamed("_decoded", decoded)


def digests(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """key, number of ids, and digests of the ids and of what they decode to. Chunks go in; stable ids go to the digest and to the decoder at once, so that a worker holds neither all ids nor all decoded text of a document."""
    path = path or vocabulary()

    def make():
        merges = merges_of(path)
        encoder, decoder = Encoder(merges), Decoder(merges)
        names = [str(i) for i in range(len(decoder.bytes))]

        def each(t: str | None) -> tuple:
            n, coded, plain = 0, hashlib.sha256(), hashlib.sha256()
            for part in encoder.stream(chunks_of(t or "")):
                if len(part):
                    ids = part.tolist()
                    coded.update(("," * (n > 0) + ",".join(map(names.__getitem__, ids))).encode())
                    plain.update(decoder.feed(ids).encode())
                    n += len(ids)
            plain.update(decoder.finish().encode())
            return n, coded.hexdigest(), plain.hexdigest()

        return each

    return map_texts(docs, [key], text, make, "n_tokens long, ids_sha256 string, decoded_sha256 string")


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(read_table(spark, sf_dir, "documents"))
