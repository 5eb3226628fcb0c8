"""Host-level quality rules.

Rules count per document; the failures of each rule are summed by host (the ``source`` column), and a host's
failure rate is shrunk towards all hosts' by a beta prior whose parameters are the moments of the hosts'
rates.  A host whose shrunk rate for a rule is above ``WORST_RATE`` fails that rule, and the verdict goes
back to its documents: a document goes if it fails the base rules, or if it fails a soft rule that its host
fails too.  A lone failure on a sound host is tolerated, and a document without failures is always kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill.llm.shared import blank_words
from reviewmill.session import materialise

FEWEST_WORDS = 50
WORST_RATE = 0.3
# Documents that the prior counts for: at least and at most.
PRIOR_DOCUMENTS = (1.0, 1000.0)
# The soft rules; each is stated with whole numbers.
SOFT_RULES = {
    "many_symbols": "10 * n_symbols > n_words",
    "repeated_lines": "10 * n_dup_lines > 3 * n_lines",
    "odd_word_length": "word_chars < 3 * n_words or word_chars > 10 * n_words",
}


def with_counts(docs: DataFrame) -> DataFrame:
    """doc_id, source and the counts of each document, all from its own row.

    Repeated windows: each 3-word window becomes one long, the high bits of its hash above the bits of its
    place, so that sorting brings equal windows together.  Windows count as equal if the high bits agree
    (about 50 bits for a text of 10,000 words).  The words covered by the sorted places are summed as the
    distances to the next place, 3 at most.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike("[^\\x20\\x09-\\x0D]"))
    row = docs.select(
        "doc_id", "source", F.length(F.regexp_replace(text, "[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        lines.alias("lines"), blank_words(F.col("text")).alias("words"),
    ).select(
        "doc_id", "source", "n_symbols", "words",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
    )
    row = row.withColumn("low", F.expr("shiftleft(1L, length(bin(n_words))) - 1"))
    row = row.withColumn("windows", F.expr("""
        case when n_words >= 4 then sort_array(transform(sequence(0, size(words) - 3), i ->
            (xxhash64(words[i], words[i + 1], words[i + 2]) & ~low) | i)) end"""))
    row = row.withColumn("places", F.expr("""
        array_sort(transform(filter(windows, (x, i) ->
            (i > 0 and (x & ~low) = (windows[i - 1] & ~low))
            or (i + 1 < size(windows) and (x & ~low) = (windows[i + 1] & ~low))), x -> x & low))"""))
    covered = F.expr("""
        aggregate(places, named_struct('last', -3L, 'sum', 0L),
            (a, p) -> named_struct('last', p, 'sum', a.sum + least(3L, p - a.last)), a -> a.sum)""")
    return row.select(
        "doc_id", "source", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines",
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < FEWEST_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def host_verdicts(rows: DataFrame) -> DataFrame:
    """source and a true/false column per soft rule: whether the host fails it."""
    hosts = materialise(
        rows.groupBy("source").agg(
            F.count("*").alias("docs"), *[F.count_if(F.col(f"fails_{rule}")).alias(rule) for rule in SOFT_RULES]
        )
    )
    rate = {rule: F.col(rule) / F.col("docs") for rule in SOFT_RULES}
    moments = hosts.agg(
        *[F.avg(rate[rule]).alias(f"mean_{rule}") for rule in SOFT_RULES],
        *[F.var_pop(rate[rule]).alias(f"var_{rule}") for rule in SOFT_RULES],
    ).first()
    verdicts = []
    for rule in SOFT_RULES:
        mean, variance = moments[f"mean_{rule}"] or 0.0, moments[f"var_{rule}"] or 0.0
        fewest, most = PRIOR_DOCUMENTS
        prior = most if variance == 0 else min(most, max(fewest, mean * (1 - mean) / variance - 1))
        shrunk = (F.col(rule) + mean * prior) / (F.col("docs") + prior)
        verdicts.append((shrunk > WORST_RATE).alias(f"host_{rule}"))
    return hosts.select(F.col("source").alias("_source"), *verdicts)


def judge(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    host_failed (the host fails a soft rule that the document fails), kept.

    ``docs`` needs doc_id, source and text; other columns are ignored.  A null or blank text has no words and
    fails the base rules.  Null sources form one host.  Repeated rows are judged alike, each for itself; ids are
    only passed through.  The hosts' table is joined as the planner sees fit: broadcast where Spark measures it
    as small, otherwise by a shuffle whose hot hosts adaptive execution splits.
    """
    rows = materialise(
        with_counts(docs).select("*", *[F.expr(condition).alias(f"fails_{rule}") for rule, condition in SOFT_RULES.items()])
    )
    host_failed = F.lit(False)
    for rule in SOFT_RULES:
        host_failed = host_failed | (F.col(f"fails_{rule}") & F.col(f"host_{rule}"))
    return (
        rows.join(host_verdicts(rows), F.col("source").eqNullSafe(F.col("_source")), "left")
        .withColumn("base_failed", base_failed())
        .withColumn("host_failed", host_failed)
        .select(
            "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "host_failed",
            (~F.col("base_failed") & ~F.col("host_failed")).alias("kept"),
        )
    )
