"""Secret scanning: fixed patterns, and values in credential contexts that are costly to guess."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.llm.texts import broadcast_if_light, let_workers_import, stored, text_function, text_key
from larder.sources.shared import broadcast_if_small

# The base patterns with the least length of what they match.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # a run is matched whole, so shorter ones need no match
ASSIGN_LEAST, ACCESS_LEAST = 6, 20
KINDS = ("assign", "access", "hex", "guess")

# Words one of which a text has to hold, in lower case, before the patterns are tried.
ASSIGN_NEAR = ("password", "passwd", "secret", "token", "apikey", "api_key")
CONTEXT_NEAR = (*ASSIGN_NEAR, "passphrase", "passcode", "pwd", "credential", "private", "access", "api-key", "auth")
# A credential context and its value: in quotes up to the same quote, else up to white space.
CONTEXT = re.compile(
    r"""(?:password|passwd|passphrase|passcode|pwd|credentials?|secret|token|private[_-]?key|access[_-]?key"""
    r"""|api[_-]?key|auth[_-]?(?:token|key))["']?\x20*(?:=>|:=|[:=])\x20*"""
    r"""(?:"([^"\n]+)"|'([^'\n]+)'|([^\s"']+))""",
    re.IGNORECASE | re.ASCII,
)
# Guesses that an attacker is taken to afford: a value that takes more (33.2 bits) counts as a secret. Its least length.
GUESS_BUDGET = 1e10
GUESS_BITS = math.log2(GUESS_BUDGET)
GUESS_LEAST = 8
# Bits for each word that a value of this many words or more, with blanks between, has to reach: sentences cost less.
PROSE_BITS, PROSE_WORDS = 11.5, 3

# The texts that have to hold a word of the corpus for it to have a rank.
WORD_TEXTS = 5
# Stretches of letters of a value that are passed on together.
WORDS_TOGETHER = 100_000
WORD_RUN = r"\p{L}+"
LETTERS = re.compile(r"[^\W\d_]+")
# Characters that lie between words, and what the first of a kind and the next ones cost.
BETWEEN, BETWEEN_BITS = " _-./,;:?!", (3.0, 1.0)

# Frequent parts of passwords, most frequent first; a rank is what a word costs to guess.
WORDS = (
    "password", "pass", "word", "admin", "user", "login", "welcome", "secret", "token", "master", "dragon", "monkey",
    "letmein", "iloveyou", "sunshine", "princess", "football", "baseball", "shadow", "summer", "winter", "spring",
    "autumn", "hello", "test", "guest", "root", "default", "change", "changeme", "example", "sample", "dummy", "your",
    "here", "none", "null", "true", "false", "value", "string", "key", "api", "private", "public", "server", "client",
    "database", "service", "access", "data", "the", "and", "for", "with", "this", "that", "love", "god", "money",
    "january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november",
    "december", "monday", "friday", "sunday", "company", "office", "home", "star", "blue", "red", "green", "black",
)
# The rows of a keyboard, for walks along them.
KEYBOARD = ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm")
# Characters that stand for letters.
SWAPS = str.maketrans({"@": "a", "4": "a", "3": "e", "1": "l", "0": "o", "$": "s", "5": "s", "7": "t", "!": "i"})
# Lengths of segments whose repeats are looked for.
UNITS = (2, 3, 4, 5, 6, 8, 10, 12)
DATE = re.compile(r"(?:19|20)\d\d[-/.]?[01]\d[-/.]?[0-3]\d|[0-3]?\d[-/.][01]?\d[-/.](?:19|20)?\d\d|(?:19|20)\d\d")


def _alphabet(value: str) -> int:
    """Characters that brute force has to try at each place: all of each class that ``value`` holds."""
    classes = set()
    for character in set(value):
        if not character.isascii():
            classes.add(("other", 100))
        elif character.isdigit():
            classes.add(("digit", 10))
        elif character.isalpha():
            classes.add(("upper" if character.isupper() else "lower", 26))
        else:
            classes.add(("symbol", 33))
    return sum(size for _, size in classes)


def folded(value: str) -> str:
    """``value`` in lower case, character by character, so that it keeps its length."""
    low = value.lower()
    return low if len(low) == len(value) else "".join(c if len(c.lower()) > 1 else c.lower() for c in value)


@lru_cache(maxsize=None)
def _ranks() -> dict[str, int]:
    return {word: rank for rank, word in enumerate(WORDS, 1)}


def _spelling_bits(written: str, word: str) -> int:
    """What the capitals of ``word`` cost: one bit if it is the first or all of them."""
    if written == word:
        return 0
    return 1 if written.isupper() or written[1:] == word[1:] else len(word)


@lru_cache(maxsize=None)
def _neighbours() -> frozenset[str]:
    pairs = {a + b for row in KEYBOARD for a, b in zip(row, row[1:], strict=False)}
    return frozenset(pairs | {pair[::-1] for pair in pairs})


def guess_bits(value: str, ranks: Mapping[str, int] | None = None) -> float:
    """Base-2 logarithm of the guesses that the cheapest segmentation of ``value`` takes.

    Dynamic programming over the ends of segments. A segment is a word of ``ranks`` or else ``WORDS`` (its rank, and
    its capitals and swapped characters; under three letters only if no letter is beside it), a character between
    words, a date, a repeat of the segmentation before it, a copy of three or more earlier characters, a walk along a
    keyboard row or the alphabet, or brute force (the classes of characters in ``value``). Each segment adds
    one bit for where it ends, but for brute force and for one that is the first character. An empty value costs 0.
    """
    n = len(value)
    low = folded(value)
    plain = low.translate(SWAPS)
    ranks = _ranks() if ranks is None else ranks
    lengths = sorted({len(word) for word in ranks}, reverse=True)
    near = _neighbours()
    each = math.log2(max(2, _alphabet(value)))
    best = [0.0] + [math.inf] * n
    dates: dict[int, list[int]] = {}
    for at in range(n):
        if value[at].isdigit() and (match := DATE.match(value, at)):
            dates.setdefault(match.end(), []).append(at)
    same = dict.fromkeys(UNITS, 0)  # characters up to here that equal the one a unit before them
    last: dict[str, int] = {}  # where three characters ended last
    source = length = 0  # where the earlier copy of the last ``length`` characters ends
    between: set[str] = set()
    run = walk = order = 0  # where the current run of one character, keyboard walk, and sequence begin
    for end in range(1, n + 1):
        here = value[end - 1]
        if end > 1:
            before = value[end - 2]
            run = run if here == before else end - 1
            walk = walk if low[end - 2 : end] in near else end - 1
            order = order if abs(ord(here) - ord(before)) == 1 and here.isalnum() else end - 1
        joint = 1.0 if end > 1 else 0.0
        cost = best[end - 1] + each
        for length_ in lengths:
            start = end - length_
            if start < 0:
                continue
            word = low[start:end]
            rank = ranks.get(word)
            swapped = 0
            if rank is None and plain[start:end] != word:
                rank = ranks.get(plain[start:end])
                swapped = sum(a != b for a, b in zip(word, plain[start:end], strict=True))
            if rank is None:
                continue
            if end - start >= 3 or not (low[start - 1 : start].isalpha() or low[end : end + 1].isalpha()):
                bits = math.log2(rank + 1) + swapped + _spelling_bits(value[start:end], word)
                cost = min(cost, best[start] + bits + joint)
        if end > 1 and here in BETWEEN and all(c.isalpha() or c in BETWEEN for c in (before, value[end : end + 1])):
            cost = min(cost, best[end - 1] + BETWEEN_BITS[here in between])
            between.add(here)
        for start in dates.get(end, ()):
            cost = min(cost, best[start] + math.log2(366 * 150 if end - start > 4 else 150) + joint)
        if end - run >= 3:
            cost = min(cost, best[run] + each + math.log2(end - run) + joint)
        for start in {walk, order}:
            if end - start >= 3:
                cost = min(cost, best[start] + math.log2(94) + math.log2(end - start) + joint)
        for unit in same:
            same[unit] = same[unit] + 1 if end > unit and here == value[end - 1 - unit] else 0
            times = same[unit] // unit + 1
            if times > 1:
                # The first copy as it was segmented, then how often it comes again.
                cost = min(cost, best[end - (times - 1) * unit] + math.log2(times) + joint)
        if end >= 3:
            ended = value[end - 3 : end]
            if source and value[source] == here:
                source, length = source + 1, length + 1
            else:
                source, length = last.get(ended, 0), 3
            last[ended] = end
            if source:
                cost = min(cost, best[end - length] + math.log2(end) + math.log2(length) + joint)
        best[end] = cost
    return best[n]


@dataclass(frozen=True)
class Span:
    kind: str
    start: int
    end: int

    def __str__(self) -> str:
        return f"{self.kind}:{self.start}:{self.end}"


def base_spans(text: str) -> list[Span]:
    """Matches of the three base patterns, by start and then kind."""
    found = [Span("hex", *match.span()) for match in HEX.finditer(text)]
    if "AKIA" in text:
        found += [Span("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    low = text.lower()
    if any(word in low for word in ASSIGN_NEAR):
        found += [Span("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    return in_order(found)


def context_values(text: str) -> list[tuple[int, int]]:
    """Where values in credential contexts begin and end that are long enough."""
    low = text.lower()
    if not any(word in low for word in CONTEXT_NEAR):
        return []
    found = (match.span(match.lastindex) for match in CONTEXT.finditer(text))
    return [(start, end) for start, end in found if end - start >= GUESS_LEAST]


def inside(start: int, end: int, base: Sequence[Span]) -> bool:
    return any(span.start <= start and end <= span.end for span in base)


def costly(value: str, bits: float, least_bits: float = GUESS_BITS) -> bool:
    """Whether ``bits`` make a value a secret.

    Values of ``PROSE_WORDS`` words or more also have to cost ``PROSE_BITS`` for each, or they are taken for a sentence.
    """
    n_words = len(value.split())
    return bits >= (max(least_bits, PROSE_BITS * n_words) if n_words >= PROSE_WORDS else least_bits)


def guess_spans(
    text: str, base: Sequence[Span], least_bits: float = GUESS_BITS, ranks: Mapping[str, int] | None = None
) -> list[Span]:
    """Values in credential contexts that are ``costly`` and not inside a base span."""
    values = (span for span in context_values(text) if not inside(*span, base))
    return [Span("guess", a, b) for a, b in values if costly(text[a:b], guess_bits(text[a:b], ranks), least_bits)]


def word_ranks(docs: DataFrame, text_column: str = "text", least_texts: int = WORD_TEXTS) -> DataFrame:
    """``word, rank``: the words of the corpus by rank, that is one more than how many words more texts hold.

    All texts count, without what follows credential contexts, so that a repeated secret does not become a word. A word in
    fewer than ``least_texts`` texts has no rank and is guessed as its parts. ``WORDS`` keep their rank where it is
    less. Nothing is collected: counts stay a table, and ranks come from the table of how many words have each count, which
    has no more rows than the root of twice the corpus's words.
    """
    spark = docs.sparkSession
    plain = F.col(text_column)
    for pattern in (CONTEXT, ASSIGN, ACCESS):
        plain = F.regexp_replace(plain, ("(?i)" if pattern.flags & re.IGNORECASE else "") + pattern.pattern, " ")
    words = docs.select(F.explode(F.array_distinct(F.regexp_extract_all(F.lower(plain), F.lit(WORD_RUN), F.lit(0)))).alias("word"))
    counts = stored(words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_texts), "words")
    more = Window.orderBy(F.desc("n")).rowsBetween(Window.unboundedPreceding, -1)
    rank_of = counts.groupBy("n").agg(F.count("*").alias("words")).select(
        "n", (1 + F.coalesce(F.sum("words").over(more), F.lit(0))).alias("rank")
    )
    fixed = spark.createDataFrame(list(_ranks().items()), "word string, rank bigint")
    ranked = counts.join(broadcast_if_small(rank_of), "n").select("word", "rank").unionByName(fixed)
    return ranked.groupBy("word").agg(F.min("rank").alias("rank"))


def candidate_words(value: str, longest: int) -> Iterator[str]:
    """Every stretch of up to ``longest`` letters of ``value``, in lower case, also with swapped characters read as letters."""
    low = folded(value)
    for text in {low, low.translate(SWAPS)}:
        for run in LETTERS.finditer(text):
            begin, stop = run.span()
            for start in range(begin, stop):
                for end in range(start + 1, min(stop, start + longest) + 1):
                    yield text[start:end]


def value_costs(values: DataFrame, ranks: DataFrame, least_bits: float = GUESS_BITS) -> DataFrame:
    """``value, bits, costly`` of every different ``value``, costed with all words of ``ranks`` that it holds.

    The stretches of letters of each value meet the words in a join, and each value gets the ranks of its own words back.
    A value's words are no more than its letters times the longest word's; no dictionary is broadcast or collected.
    """
    spark = values.sparkSession
    let_workers_import(spark)
    asked = stored(values.select("value").distinct().select(text_key("value").alias("key"), "value"), "values")
    longest = ranks.agg(F.max(F.char_length("word"))).first()[0] or 0

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(key: bytes, words: set[str]) -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"key": pa.array([key] * len(words), pa.binary()), "word": pa.array(list(words), pa.string())})

        for batch in batches:
            for key, value in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                words: set[str] = set()
                for word in candidate_words(value, longest):
                    words.add(word)
                    if len(words) >= WORDS_TOGETHER:
                        yield out(key, words)
                        words = set()
                if words:
                    yield out(key, words)

    # The words of a value go with its key, so that a long value is not repeated for each.
    held = asked.mapInArrow(pairs, "key binary, word string").join(ranks, "word")
    own = held.groupBy("key").agg(F.collect_set(F.struct("word", "rank")).alias("words"))
    kinds = [pa.field("bits", pa.float64()), pa.field("costly", pa.bool_())]

    def cost(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for batch, words in batches:
            bits = []
            for value, known in zip(batch.to_pylist(), words.to_pylist(), strict=True):
                ranks_ = _ranks() | {pair["word"]: pair["rank"] for pair in known or ()}
                bits.append((guess_bits(value, ranks_), value))
            dear = [costly(value, one, least_bits) for one, value in bits]
            yield pa.StructArray.from_arrays([pa.array([b for b, _ in bits], pa.float64()), pa.array(dear, pa.bool_())], fields=kinds)

    costs = F.arrow_udf(cost, "struct<bits:double,costly:boolean>").asNondeterministic()
    return asked.join(own, "key", "left").select("value", costs("value", "words").alias("c")).select("value", "c.*")


def in_order(spans: Sequence[Span]) -> list[Span]:
    return sorted(spans, key=lambda span: (span.start, KINDS.index(span.kind), span.end))


def redact(text: str, spans: Sequence[Span], mark: str = "[secret]") -> str:
    """``text`` with ``mark`` in place of each stretch of overlapping spans."""
    parts, at = [], 0
    for span in spans:  # by start
        if span.start >= at:
            parts += [text[at : span.start], mark]
        at = max(at, span.end)
    return "".join([*parts, text[at:]])


SPAN = "struct<start:int,kind:int,end:int>"
FOUND = f"struct<base:array<{SPAN}>,values:array<struct<start:int,end:int,inside:boolean,value:string>>>"


def _found(docs: DataFrame, text_column: str):
    """A column function: a text's base spans, and its values in credential contexts."""
    span = pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())])
    value = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("inside", pa.bool_()), ("value", pa.string())])
    fields = [pa.field("base", pa.list_(span)), pa.field("values", pa.list_(value))]

    def work(texts):
        base, values = [], []
        for text in texts:
            spans = base_spans(text or "")
            base.append([(s.start, KINDS.index(s.kind), s.end) for s in spans])
            values.append([(a, b, inside(a, b, spans), text[a:b]) for a, b in context_values(text or "")])
        return pa.StructArray.from_arrays([pa.array(base, fields[0].type), pa.array(values, fields[1].type)], fields=fields)

    return text_function(docs.sparkSession, lambda: work, FOUND)(text_column)


def _guesses(found: DataFrame, ranks: DataFrame, least_bits: float) -> DataFrame:
    """``row, guesses``: of every row of ``found`` with values, where they are, their bits, and whether they are secrets.

    A value that very many texts hold is costed once. Rows meet its cost in a join that Spark can split.
    """
    opened = found.where(F.size("values") > 0).select("row", F.inline("values"))
    costs = broadcast_if_light(value_costs(opened, ranks, least_bits))
    of_row = F.struct("start", "end", "inside", "bits", "costly")
    return opened.join(costs, "value").groupBy("row").agg(F.array_sort(F.collect_list(of_row)).alias("guesses"))


def _listed(spans: Column) -> Column:
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def _n_of_kind(spans: str, kind: int) -> Column:
    """How many spans are of a kind. The lambda takes one argument: a second one would be given the element's index."""
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")


def scan(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    least_bits: float = GUESS_BITS,
    ranks: DataFrame | None = None,
) -> DataFrame:
    """``id, n_assign, n_access, n_hex, n_guess, base, spans, value_bits`` of every row of ``docs``.

    ``base`` and ``spans`` list ``kind:start:end`` (code points, end exclusive) by start, then kind, joined by
    commas: the base patterns' spans, and all spans. ``value_bits`` lists ``start:end:bits`` of all values in credential
    contexts, those inside base spans too, which stay as they are whatever they cost. NULL and empty texts have none. Repeated rows stay;
    other columns are not looked at; an empty table gives an empty result. ``ranks`` (``word, rank``) are what words cost;
    without them, the ``word_ranks`` of ``docs``.
    """
    ranks = word_ranks(docs, text_column) if ranks is None else ranks
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_column).alias("id"), _found(docs, text_column).alias("f"))
    found = stored(rows.select("row", "id", "f.*"), "found")
    guessed = found.where(F.size("values") > 0).join(_guesses(found, ranks, least_bits), "row").select("id", "base", "guesses")
    none = F.array().cast("array<struct<start:int,end:int,inside:boolean,bits:double,costly:boolean>>")
    rest = found.where(F.size("values") == 0).select("id", "base", none.alias("guesses"))
    both = guessed.unionByName(rest)
    secret = F.filter("guesses", lambda g: g["costly"] & ~g["inside"])
    kind = F.lit(KINDS.index("guess"))
    more = F.transform(secret, lambda g: F.struct(g["start"].alias("start"), kind.alias("kind"), g["end"].alias("end")))
    counts = [_n_of_kind("base", k).alias(f"n_{KINDS[k]}") for k in range(3)]
    bits = F.transform("guesses", lambda g: F.concat_ws(":", g["start"].cast("string"), g["end"].cast("string"), F.round(g["bits"], 2).cast("string")))
    return both.select(
        "id",
        *counts,
        F.size(more).cast("bigint").alias("n_guess"),
        _listed(F.col("base")).alias("base"),
        _listed(F.array_sort(F.concat("base", more))).alias("spans"),
        F.array_join(bits, ",").alias("value_bits"),
    )


def without_secrets(
    docs: DataFrame,
    text_column: str = "text",
    least_bits: float = GUESS_BITS,
    mark: str = "[secret]",
    ranks: DataFrame | None = None,
) -> DataFrame:
    """``docs`` with every secret in its texts replaced by ``mark``; NULL and empty texts and other columns as they are.

    Repeated rows stay, and an empty table gives an empty one. ``ranks`` as in ``scan``. Texts with a costly value are few and
    known by key: they are broadcast after measuring them, and beyond that a shuffle brings them to the rows.
    """
    ranks = word_ranks(docs, text_column) if ranks is None else ranks
    rows = docs.select(F.monotonically_increasing_id().alias("row"), text_key(text_column).alias("key"), _found(docs, text_column).alias("f"))
    found = stored(rows.select("row", "key", "f.values").where(F.size("values") > 0), "found")
    secret = F.filter("guesses", lambda g: g["costly"] & ~g["inside"])
    of_row = _guesses(found, ranks, least_bits).select("row", F.transform(secret, lambda g: F.struct(g["start"].alias("start"), g["end"].alias("end"))).alias("spans"))
    of_key = found.select("row", "key").join(of_row.where(F.size("spans") > 0), "row").groupBy("key").agg(F.first("spans").alias("spans"))
    known = broadcast_if_light(of_key.select(F.struct("key", "spans").alias("f")))
    source = docs.select(F.struct(*(F.col(f"`{name}`") for name in docs.columns)).alias("d"))
    text = F.col("d")[text_column]
    joined = source.join(known, text_key(text) == F.col("f.key"), "left")

    def clean(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, guesses in batches:
            out = []
            for one, more in zip(texts.to_pylist(), guesses.to_pylist(), strict=True):
                spans = in_order([*base_spans(one or ""), *(Span("guess", g["start"], g["end"]) for g in more or ())])
                out.append(redact(one, spans, mark) if spans else one)
            yield pa.array(out, pa.string())

    let_workers_import(docs.sparkSession)
    cleaned = F.arrow_udf(clean, "string").asNondeterministic()(text, F.col("f.spans"))
    return joined.select("d", cleaned.alias("t")).withColumn("d", F.col("d").withField(f"`{text_column}`", F.col("t"))).select("d.*")
