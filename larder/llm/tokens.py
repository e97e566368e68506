"""Token ids of whole texts by a public byte-level BPE tokenizer."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

IDS = np.dtype("<u4")
# Words whose ids a worker remembers, at about 60 bytes each; those that were not met for longest go first.
REMEMBERED_WORDS = 1_000_000
TOGETHER = 1024
# Bytes of text that are encoded at a time; a longer text goes alone.
TEXT_BYTES = 8 << 20

# White space in Unicode, and what some libraries count as such.
SPACES = r"\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{1680}\x{180E}\x{2000}-\x{200B}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}"
# A blank before white space, or at the end, is no certain border between the tokenizer's pieces; the mark is used below.
UNSURE = rf" (?:[{SPACES}]|\z)|\x01"
# The first character of a line, if one line end alone is before it: a piece starts with it, without a blank.
LINE_START = rf"([^{SPACES}])\n([^{SPACES}])"
MARK = "\x01"
# A word of Latin letters, and what follows them: such letters end a piece before ASCII punctuation and line ends.
LETTERS_FIRST = r"(?s)\A(?P<head>\x01?[A-Za-zÀ-ÖØ-öø-ɏ]+)(?P<rest>[\n!-/:-@\[-`{-~].*)\z"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@dataclass
class Entries:
    """Words and their ids: ``ids`` one after the other, ``sizes`` how many each word has."""

    words: pa.Array
    ids: np.ndarray
    sizes: np.ndarray


def gathered(ids: np.ndarray, sizes: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of the ``chosen`` entries, one after the other, and the number of ids of each."""
    n = sizes[chosen]
    starts = np.cumsum(sizes) - sizes
    at = np.repeat(starts[chosen] - np.cumsum(n) + n, n)
    at += np.arange(len(at))
    return ids[at], n


class Memory:
    """The words that were met last, at most ``size``, as columns."""

    def __init__(self, size: int):
        self.size = size
        self.entries = Entries(pa.array([], pa.string()), np.zeros(0, IDS), np.zeros(0, np.int64))
        self.met = np.zeros(0, np.int64)
        self.now = 0

    def look_up(self, words: pa.Array, make: Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of different ``words``, one after the other, and how many each has; ``make`` gives those of new words."""
        self.now += 1
        known = self.entries
        at = pc.fill_null(pc.index_in(words, value_set=known.words), -1).to_numpy().astype(np.int64)
        new = np.flatnonzero(at < 0)
        self.met[at[at >= 0]] = self.now
        if len(new):
            own = words.take(pa.array(new))
            ids, sizes = make(own)
            at[new] = len(known.sizes) + np.arange(len(new))
            known = Entries(
                pa.concat_arrays([known.words, own]), np.concatenate((known.ids, ids)), np.concatenate((known.sizes, sizes))
            )
            self.met = np.concatenate((self.met, np.full(len(new), self.now)))
        found = gathered(known.ids, known.sizes, at)
        if len(known.sizes) > self.size:
            stay = np.sort(np.argsort(self.met, kind="stable")[len(known.sizes) - self.size * 3 // 4 :])
            known = Entries(known.words.take(pa.array(stay)), *gathered(known.ids, known.sizes, stay))
            self.met = self.met[stay]
        self.entries = known
        return found


class TextEncoder:
    """Encodes texts as ``tokenizers`` does, each different word once.

    The tokenizer cuts a text into pieces before any merge. A blank followed by another
    character than white space always starts a piece, as does what follows a single line end that has no white space beside it; and
    Latin letters always end one before ASCII punctuation. So the ids of a text are those of its first word, of the
    letters of each later word with the blank before them, and of what follows the letters, one after the other. The words of many texts
    are cut, numbered and looked up with Arrow; ids are made for those not met before and put together by number. Texts with
    a blank before white space or at the end are encoded whole, as are all texts under other settings. Special tokens in a text are ordinary text.
    """

    def __init__(self, path: str, remembered: int | None = None):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        said = json.loads(self.tokenizer.to_str())
        # Fixed value: the settings under which the borders below are certain. Others have their texts encoded whole.
        self.cuts = said["pre_tokenizer"] == {
            "type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True
        } and said["normalizer"] is None and all(token["special"] for token in said["added_tokens"])
        size = self.tokenizer.get_vocab_size()
        # Fixed value: how byte-level vocabularies write a blank.
        self.blank = np.array([(self.tokenizer.id_to_token(i) or "").startswith("Ġ") for i in range(size)])
        remembered = REMEMBERED_WORDS if remembered is None else remembered
        self.heads, self.rests = Memory(remembered), Memory(remembered // 4)

    def whole(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        encoded = [one.ids for one in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        ids = np.fromiter(chain.from_iterable(encoded), IDS)
        return ids, np.fromiter(map(len, encoded), np.int64, len(encoded))

    def _after_blanks(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words with a blank before them, many encoded as one text and cut before each blank."""
        parts, sizes = [], []
        for start in range(0, len(words), TOGETHER):
            some = words[start : start + TOGETHER]
            ids, _ = self.whole([" " + " ".join(some)])
            starts = np.flatnonzero(self.blank[ids])
            if len(starts) != len(some):
                raise ValueError("the tokenizer does not cut texts before blanks")
            parts.append(ids)
            sizes.append(np.diff(starts, append=len(ids)))
        return np.concatenate([np.zeros(0, IDS), *parts]), np.concatenate([np.zeros(0, np.int64), *sizes])

    def _heads(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words with a blank before them, or, where they bear the mark, without."""
        marked = pc.starts_with(words, MARK).to_numpy(zero_copy_only=False)
        names = words.to_pylist()
        ids, sizes = self._after_blanks([name for name, mark in zip(names, marked.tolist(), strict=True) if not mark])
        if not marked.any():
            return ids, sizes
        more, more_sizes = self.whole([name[1:] for name, mark in zip(names, marked.tolist(), strict=True) if mark])
        order = np.empty(len(names), np.int64)
        order[~marked] = np.arange(len(sizes))
        order[marked] = len(sizes) + np.arange(len(more_sizes))
        return gathered(np.concatenate((ids, more)), np.concatenate((sizes, more_sizes)), order)

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of different words: those of their letters and of what follows, where that is certain."""
        parts = pc.extract_regex(words, LETTERS_FIRST)
        head = pc.if_else(pc.is_valid(parts), pc.struct_field(parts, "head"), words).dictionary_encode()
        rest = pc.fill_null(pc.struct_field(parts, "rest"), "").dictionary_encode()
        ids, sizes = self.heads.look_up(head.dictionary, self._heads)
        after, after_sizes = self.rests.look_up(rest.dictionary, lambda new: self.whole(new.to_pylist()))
        both = np.empty(2 * len(words), np.int64)
        both[::2] = head.indices.to_numpy()
        both[1::2] = len(sizes) + rest.indices.to_numpy().astype(np.int64)
        ids, n = gathered(np.concatenate((ids, after)), np.concatenate((sizes, after_sizes)), both)
        return ids, n[::2] + n[1::2]

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and how many each text has; NULL is like empty."""
        if not len(texts):
            return np.zeros(0, IDS), np.zeros(0, np.int64)
        texts = pc.fill_null(texts.cast(pa.string()), "")
        if not self.cuts:
            return self.whole(texts.to_pylist())
        unsure = pc.match_substring_regex(texts, UNSURE)
        marked = pc.replace_substring_regex(pc.if_else(unsure, "", texts), LINE_START, f"\\1\n {MARK}\\2")
        words = pc.split_pattern(marked, " ")
        bounds = words.offsets.to_numpy().astype(np.int64) - words.offsets[0].as_py()
        flat = words.flatten()
        first = flat.take(pa.array(bounds[:-1])).to_pylist()
        for i in np.flatnonzero(unsure.to_numpy(zero_copy_only=False)).tolist():
            first[i] = texts[i].as_py()
        later = np.ones(len(flat), bool)
        later[bounds[:-1]] = False
        coded = flat.filter(pa.array(later)).dictionary_encode()
        ids, sizes = self._words(coded.dictionary)
        codes = np.empty(len(flat), np.int64)
        codes[later] = coded.indices.to_numpy()
        codes[bounds[:-1]] = len(sizes) + np.arange(len(first))
        own, own_sizes = self.whole(first)
        ids, n = gathered(np.concatenate((ids, own)), np.concatenate((sizes, own_sizes)), codes)
        return ids, np.diff(np.concatenate(([0], np.cumsum(n)))[bounds])

    def encode(self, texts: Sequence[str | None]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers; NULL is like empty."""
        ids, n = self.ids(pa.array(texts, pa.string()))
        raw, ends = ids.tobytes(), (IDS.itemsize * np.cumsum(n)).tolist()
        return [raw[a:b] for a, b in zip([0, *ends], ends, strict=False)]


def in_runs(texts: pa.Array, most_bytes: int = TEXT_BYTES) -> Iterator[tuple[int, int]]:
    """Where runs of texts of about ``most_bytes`` begin, and how many texts they hold; a longer text is alone."""
    start = held = 0
    for at, size in enumerate(pc.fill_null(pc.binary_length(texts), 0).to_pylist()):
        if at > start and held + size > most_bytes:
            yield start, at - start
            start, held = at, 0
        held += size
    if start < len(texts):
        yield start, len(texts) - start


def with_end(ids: np.ndarray, n: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """``ids`` with ``end_id`` after those of each text, and how many each text has then."""
    return np.insert(ids, np.cumsum(n), np.array(end_id, IDS)), n + 1


@lru_cache(maxsize=2)
def encoder(path: str, remembered: int | None = None) -> TextEncoder:
    """One per worker process, so that what it remembers lasts over tasks."""
    return TextEncoder(path, remembered)
