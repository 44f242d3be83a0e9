"""Token counts: count-only Viterbi over a unigram vocabulary.

An Aho-Corasick automaton over the vocabulary enumerates the pieces that end at each character;
the dynamic programme carries, for each position, only the best score and the number of pieces of the best path,
no back pointers. Tie rules are those of the tokenizers library's unigram model: of paths with equal scores to
a position, the one whose last piece starts first stays (the automaton gives the longest piece
first, and a later one must be strictly better); a character with no piece of its own gets an unknown edge of
the lowest score less 10, considered last; unknown characters become their bytes' pieces where the vocabulary has all of
them, otherwise runs of them are one token.

Pieces do not cross words (the library's metaspace splitter), so counts of words are kept, up to CACHE words.
The vocabulary is a parameter: pieces with scores, by default those of the public sentencepiece file.

Null and empty texts have no tokens. Very long words take linear time and memory.
"""

from __future__ import annotations

import functools

import ahocorasick
from pyspark.sql import DataFrame, SparkSession

from .common import map_texts, read_table

SPACE = "▁"
#: Fixed value: what an unknown character scores below the lowest piece.
UNKNOWN_PENALTY = 10.0
CACHE = 400_000


def vocabulary(name: str = "piece_bpe_32k.model") -> list[tuple[str, float]]:
    """Pieces and scores of a sentencepiece file."""
    import public_tokenizers
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(name))
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())]


class Counter:
    def __init__(self, pieces: list[tuple[str, float]], byte_fallback: bool = True):
        self.auto = ahocorasick.Automaton()
        scores: dict[str, float] = {}
        for p, s in pieces:
            scores[p] = s  # of repeated pieces the last counts
        for p, s in scores.items():
            if p:
                self.auto.add_word(p, (len(p), s))
        self.auto.make_automaton()
        self.single = {p for p in scores if len(p) == 1}
        self.unknown = min((s for _, s in pieces), default=0.0) - UNKNOWN_PENALTY
        self.bytes = byte_fallback and all(f"<0x{b:02X}>" in scores for b in range(256))
        self.cache: dict[str, int] = {}

    def word(self, word: str) -> int:
        n, low, single, unknown = len(word), float("-inf"), self.single, self.unknown
        best, count = [low] * (n + 1), [0] * (n + 1)
        best[0], done = 0.0, 0
        fused = None if self.bytes else [False] * (n + 1)
        for end, (size, score) in self.auto.iter(word):
            end += 1
            while done < end - 1:  # positions before this one get no more pieces: now their unknown edges
                done += 1
                if word[done - 1] not in single:
                    self._unknown(word, done, best, count, fused, unknown)
            s = best[end - size] + score
            if s > best[end]:
                best[end], count[end] = s, count[end - size] + 1
        while done < n:
            done += 1
            if word[done - 1] not in single:
                self._unknown(word, done, best, count, fused, unknown)
        return count[n]

    def _unknown(self, word, at, best, count, fused, unknown) -> None:
        s = best[at - 1] + unknown
        if s > best[at]:
            best[at] = s
            if fused is None:
                count[at] = count[at - 1] + len(word[at - 1].encode())
            else:
                count[at] = count[at - 1] + (not fused[at - 1])
                fused[at] = True

    def text(self, text: str | None) -> int:
        if not text:
            return 0
        s = text.replace(" ", SPACE)
        if s[0] != SPACE:
            s = SPACE + s
        total, cache = 0, self.cache
        for part in s.split(SPACE)[1:]:
            n = cache.get(part)
            if n is None:
                n = self.word(SPACE + part)
                if len(part) <= 64:
                    if len(cache) >= CACHE:
                        cache.clear()
                    cache[part] = n
            total += n
        return total


@functools.lru_cache(maxsize=2)
def counter_of(name: str) -> Counter:
    return Counter(vocabulary(name))


def count_tokens(docs: DataFrame, key: str = "doc_id", text: str = "text", name: str = "piece_bpe_32k.model") -> DataFrame:
    """key, n_tokens and n_chars (code points) of each text."""

    def make():
        c = counter_of(name)
        return lambda t: (c.text(t), len(t or ""))

    return map_texts(docs, [key], text, make, "n_tokens long, n_chars long")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(read_table(spark, sf_dir, "documents"))
