"""Token counts under a unigram vocabulary, by a Viterbi search that only counts."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import lru_cache
from math import inf

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.texts import text_function

# The mark for a blank, and how much less than the worst piece an unknown character scores.
BLANK = "▁"
UNKNOWN_PENALTY = 10.0
REMEMBERED_WORDS = 500_000


@dataclass(frozen=True)
class Vocabulary:
    """Pieces with their log probabilities, and whether unknown characters become the bytes of their UTF-8."""

    pieces: tuple[tuple[str, float], ...]
    unknown: int
    byte_fallback: bool = True


@lru_cache(maxsize=2)
def read_vocabulary(path: str) -> Vocabulary:
    """The pieces of a sentencepiece model file with the scores in it."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = tuple((model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size()))
    return Vocabulary(pieces, model.unk_id())


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Counter:
    """Counts the pieces of the best segmentation of texts, word by word.

    A text's blanks become marks, one is put before it unless it starts with one, and it is cut before each mark.
    Ties go as in the ``tokenizers`` unigram model: the segmentation whose last piece begins first wins; a character for
    which no piece of its own exists may be unknown, and neighbouring unknown characters are one piece, or each its
    UTF-8 bytes where the vocabulary holds all 256.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.trie = ahocorasick.Automaton()
        for piece, score in vocabulary.pieces:
            if piece:
                self.trie.add_word(piece, (len(piece), score))
        self.trie.make_automaton()
        self.unknown_score = min((score for _, score in vocabulary.pieces), default=0.0) - UNKNOWN_PENALTY
        names = {piece for piece, _ in vocabulary.pieces}
        self.single = {piece for piece in names if len(piece) == 1}
        self.bytes = vocabulary.byte_fallback and all(f"<0x{b:02X}>" in names for b in range(256))
        self.known: dict[str, int] = {}

    def word(self, word: str) -> int:
        """One pass over the matches by their ends; each end keeps its best score and that path's pieces."""
        if not self.single.issuperset(word):
            return self._word_with_unknown(word)
        n = len(word) + 1
        score, count = [-inf] * n, [0] * n
        score[0] = 0.0
        # Matches with one end come longest first, so a tie keeps the one that begins first.
        for last, (length, piece) in self.trie.iter(word):
            end = last + 1
            total = score[end - length] + piece
            if total > score[end]:
                score[end] = total
                count[end] = count[end - length] + 1
        return count[-1]

    def _word_with_unknown(self, word: str) -> int:
        n = len(word)
        score, count, loose = [0.0] * (n + 1), [0] * (n + 1), [False] * (n + 1)
        reached = 0  # ends up to here are settled
        matches = self.trie.iter(word) if len(self.trie) else iter(())
        pending = next(matches, None)
        while reached < n:
            end = reached + 1
            best = None
            while pending is not None and pending[0] + 1 == end:
                length, piece = pending[1]
                total = piece + score[end - length]
                if best is None or total > best[0]:
                    best = (total, end - length)
                pending = next(matches, None)
            here, fallback = word[end - 1], False
            if here not in self.single:
                total = self.unknown_score + score[end - 1]
                if best is None or total > best[0]:
                    best, fallback = (total, end - 1), True
            score[end] = best[0]
            if not fallback:
                count[end] = count[best[1]] + 1
            elif self.bytes:
                count[end] = count[end - 1] + len(here.encode("utf-8", "replace"))
            else:
                count[end] = count[end - 1] + (not loose[end - 1])
            loose[end] = fallback
            reached = end
        return count[n]

    def text(self, text: str | None) -> int:
        if not text:
            return 0
        words = text.replace(" ", BLANK).split(BLANK) if BLANK in text else text.split(" ")
        if not words[0]:
            del words[0]
        new = set(words).difference(self.known)
        own = {word: self.word(BLANK + word) for word in new}
        if len(self.known) + len(own) <= REMEMBERED_WORDS:
            self.known.update(own)
            return sum(map(self.known.__getitem__, words))
        return sum(own[word] if word in own else self.known[word] for word in words)


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    """One per worker process, so that what it remembers lasts over tasks."""
    return Counter(read_vocabulary(path))


def token_counts(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", vocabulary: str | None = None
) -> DataFrame:
    """``id, n_chars, n_tokens`` of every row of ``docs`` (bigint), over whole texts.

    NULL and empty texts have none of either. Repeated rows stay; other columns are not looked at; an empty table gives
    an empty result.
    """
    path = vocabulary or default_vocabulary()

    def make():
        def work(texts: Sequence[str | None]):
            count = counter(path).text
            return pa.array([count(text) for text in texts], pa.int64())

        return work

    n_tokens = text_function(docs.sparkSession, make, "bigint")(text_column)
    n_chars = F.coalesce(F.char_length(text_column), F.lit(0)).cast("bigint")
    return docs.select(F.col(id_column).alias("id"), n_chars.alias("n_chars"), n_tokens.alias("n_tokens"))
