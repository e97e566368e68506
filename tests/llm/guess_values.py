"""Recall of guess spans on random values and passphrases, and guess spans on words of texts without secrets.

Words are ranked by the even rows of the table; the odd ones give the clean texts.

python -m tests.llm.guess_values [documents.parquet]
"""

from __future__ import annotations

import random
import string
import sys

import pyarrow.parquet as pq
from pyspark.sql import SparkSession

from larder.llm import secrets

ALPHABETS = {
    "lower": string.ascii_lowercase,
    "lower+digits": string.ascii_lowercase + string.digits,
    "letters+digits": string.ascii_letters + string.digits,
    "printable": "".join(c for c in map(chr, range(33, 127)) if c not in "\"'"),
}
CONTEXTS = ("pwd: {}", "db_pwd={}", "passphrase = {}", "private_key: {}", "myCredentials: {}", "access_key = {}")
EACH = 500


def main(path: str) -> None:
    texts = pq.read_table(path, columns=["text"])["text"].to_pylist()
    spark = SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false").getOrCreate()
    ranked = secrets.word_ranks(spark.createDataFrame([(t,) for t in texts[::2]], "text string"))
    ranks = {row.word: row["rank"] for row in ranked.toLocalIterator()}
    print(f"{len(ranks)} ranked words")
    clean = [t for t in texts[1::2] if t and not secrets.base_spans(t)]
    listed = sorted(w for w in ranks if w.isascii() and 4 <= len(w) <= 8 and ranks[w] <= 7776)
    report(clean, listed, None)
    report(clean, listed, ranks)
    spark.stop()


def report(texts: list[str], listed: list[str], ranks: dict[str, int] | None) -> None:
    print("words by rank in the corpus" if ranks else "words of the fixed list")
    pick = random.Random(1)

    def found(value: str, context: str, quote: str = "") -> bool:
        text = context.format(quote + value + quote)
        return bool(secrets.guess_spans(text, secrets.base_spans(text), ranks=ranks))

    hits = total = 0
    for name, alphabet in ALPHABETS.items():
        for size in (8, 9, 10, 12):
            n = sum(found("".join(pick.choices(alphabet, k=size)), pick.choice(CONTEXTS)) for _ in range(EACH))
            hits, total = hits + n, total + EACH
            print(f"random {name} {size}: {n}/{EACH}")
    for size in (4, 6):
        n = sum(found(" ".join(pick.choices(listed, k=size)), pick.choice(CONTEXTS), '"') for _ in range(EACH))
        hits, total = hits + n, total + EACH
        print(f"passphrase of {size} of {len(listed)} words: {n}/{EACH}")
    false = asked = 0
    for words in (1, 2, 4, 6):
        n = tried = 0
        while tried < EACH:
            split = pick.choice(texts).replace('"', "").split()
            at = pick.randrange(max(1, len(split) - words))
            value = " ".join(split[at : at + words])
            if len(value) < secrets.GUESS_LEAST or not value.replace(" ", "").isascii():
                continue
            tried += 1
            n += found(value, pick.choice(CONTEXTS), '"' if words > 1 else pick.choice(('"', "")))
        false, asked = false + n, asked + tried
        print(f"{words} words of a text: {n}/{tried}")
    print(f"recall {hits / total:.3f}, precision {hits / max(1, hits + false):.3f}, false spans {false}/{asked}")


if __name__ == "__main__":
    main(*(sys.argv[1:] or ["/root/testdata/sf0.01/documents.parquet"]))
