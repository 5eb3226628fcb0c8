"""Tokens, n-grams and per-document term counts without a shuffle.

All tokens of a review sit in one row, so counting terms inside a review is a row-local job:
sort the tokens, find where each run of equal tokens starts, and subtract neighbouring starts.
"""

from __future__ import annotations

import sys
import unicodedata
from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill.functions.stopwords import ENGLISH
from reviewmill.functions.text import WORD

# --- fixed value: a token is a run of at least two word characters -------------------------
TOKEN = rf"[{WORD}]{{2,}}"


@cache
def _accent_tables() -> tuple[str, str, list[tuple[str, str]], str]:
    """From the compatibility forms of all code points, marks left out: letters that become one other letter, next to
    that letter, and the ones that vanish last, without a partner; then the letters that become several, the
    table of each of their places (letters whose form is that long come first), and a pattern that finds them."""
    single, gone, several = [], [], {}
    for code in range(0x80, sys.maxunicode + 1):
        char = chr(code)
        plain = "".join(c for c in unicodedata.normalize("NFKD", char) if not unicodedata.combining(c))
        if not plain:
            gone.append(char)
        elif len(plain) > 1:
            several[char] = plain
        elif plain != char:
            single.append((char, plain))
    letters = sorted(several, key=lambda c: -len(several[c]))
    places = [
        ("".join(letters), "".join(several[c][k] for c in letters if len(several[c]) > k))
        for k in range(max(map(len, several.values())))
    ]
    pattern = _class_by_blocks(_runs(sorted(map(ord, several))))
    return "".join([c for c, _ in single] + gone), "".join(p for _, p in single), places, pattern


def _runs(codes: list[int]) -> list[tuple[int, int]]:
    """First and last of each run of consecutive numbers."""
    starts = [c for i, c in enumerate(codes) if not i or codes[i - 1] != c - 1]
    ends = [c for i, c in enumerate(codes) if i + 1 == len(codes) or codes[i + 1] != c + 1]
    return list(zip(starts, ends))


def _class_by_blocks(runs: list[tuple[int, int]], size: int = 16) -> str:
    """A pattern for one letter out of the runs.  The engine asks the parts of a class one after the other, so each block
    of runs stands behind its own first and last letter, and all of them behind a check that leaves out ASCII."""
    def span(x: int, y: int) -> str:
        return rf"\x{{{x:X}}}-\x{{{y:X}}}"

    blocks = [runs[i : i + size] for i in range(0, len(runs), size)]
    parts = (f"[{span(block[0][0], block[-1][1])}&&[{''.join(span(x, y) for x, y in block)}]]" for block in blocks)
    return rf"[\x{{80}}-\x{{10FFFF}}&&[{''.join(parts)}]]"


def strip_accents(column: Column) -> Column:
    """The compatibility form without combining marks: é becomes e, a ligature its letters, a fraction its digits.
    ASCII texts stay as they are.  Letters that become several are rare; a text that holds some is cut at them."""
    accented, plain, places, pattern = _accent_tables()
    letters = F.transform(
        F.regexp_extract_all(column, F.lit(pattern), F.lit(0)), lambda c: F.concat(*[F.translate(c, *table) for table in places])
    )
    # One piece more than letters; the last has no partner.
    expanded = F.zip_with(F.split(column, pattern, -1), letters, lambda piece, letter: F.concat(piece, F.coalesce(letter, F.lit(""))))
    whole = F.when(column.rlike(pattern), F.array_join(expanded, "")).otherwise(column)
    return F.when(column.rlike(r"[^\x00-\x7F]"), F.translate(whole, accented, plain)).otherwise(column)


def tokens(column: Column, accents: bool = True) -> Column:
    text = F.lower(column)
    return F.regexp_extract_all(text if accents else strip_accents(text), F.lit(TOKEN), F.lit(0))


def without_stop_words(words: Column, stop_words: list[str] | None = None) -> Column:
    stop = ENGLISH if stop_words is None else stop_words
    return F.filter(words, lambda word: ~word.isin(*stop)) if stop else words


def bigrams(words: Column) -> Column:
    pairs = F.greatest(F.size(words) - 1, F.lit(0))
    return F.zip_with(
        F.slice(words, F.lit(1), pairs), F.slice(words, F.lit(2), pairs), lambda a, b: F.concat_ws(" ", a, b)
    )


def with_terms(
    df: DataFrame,
    text: str = "clean_text",
    target: str = "terms",
    ngrams: tuple[int, int] = (1, 2),
    stop_words: list[str] | None = None,
    accents: bool = True,
) -> DataFrame:
    """Add the array of unigrams, bigrams or both; stop words go before the n-grams are built."""
    df = df.withColumn(target, without_stop_words(tokens(F.col(text), accents), stop_words))
    words = F.col(target)
    if ngrams == (1, 1):
        return df
    if ngrams == (2, 2):
        return df.withColumn(target, bigrams(words))
    if ngrams == (1, 2):
        return df.withColumn(target, F.concat(words, bigrams(words)))
    raise ValueError(f"unsupported n-gram range {ngrams}")


def with_term_counts(df: DataFrame, terms: str = "terms", target: str = "counts") -> DataFrame:
    """Replace the array of terms by ``array<struct<term, tf>>``, one entry per distinct term."""
    ordered, starts = f"_{target}_ordered", f"_{target}_starts"
    df = df.withColumn(ordered, F.sort_array(F.col(terms))).drop(terms)
    run = F.col(ordered)
    first = F.filter(
        F.sequence(F.lit(1), F.size(run)), lambda i: (i == 1) | (F.get(run, i - 1) != F.get(run, i - 2))
    )
    df = df.withColumn(starts, F.when(F.size(run) > 0, first).otherwise(F.array().cast("array<int>")))
    begin = F.col(starts)
    following = F.concat(F.slice(begin, 2, F.greatest(F.size(begin) - 1, F.lit(0))), F.array(F.size(run) + 1))
    counts = F.zip_with(
        begin,
        F.when(F.size(begin) > 0, following).otherwise(begin),
        lambda a, b: F.struct(F.get(run, a - 1).alias("term"), (b - a).cast("long").alias("tf")),
    )
    return df.withColumn(target, counts).drop(ordered, starts)


def explode_counts(df: DataFrame, *keep: str, counts: str = "counts") -> DataFrame:
    """One row per (kept columns, term).  The outer form is deliberate: the plain one makes the
    optimiser infer a size filter and push it below, which would count every review twice."""
    entry = F.explode_outer(counts).alias("_entry")
    return (
        df.select(*keep, entry)
        .filter(F.col("_entry").isNotNull())
        .select(*keep, F.col("_entry.term").alias("term"), F.col("_entry.tf").alias("tf"))
    )
