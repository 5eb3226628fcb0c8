from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from reviewmill.llm import exact_dedup
from tests_llm import frame

NAMES = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]


def plain(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[(text or "").encode().lower()].append(doc_id)
    out = Counter()
    for norm, ids in groups.items():
        ids = sorted(ids, key=lambda i: (i is not None, i or 0), reverse=True)
        for place, doc_id in enumerate(ids):
            out[doc_id, ids[0], len(ids), place == 0, hashlib.sha256(norm).hexdigest()] += 1
    return out


def found(df, **more):
    return Counter(tuple(r) for r in exact_dedup.exact_duplicates(df, **more).select(*NAMES).collect())


def test_given_documents_in_blocks_of_any_size(documents, given):
    expected = plain([(r.doc_id, r.text) for r in given])
    assert found(documents) == expected
    assert found(documents, size=1000) == expected


def test_texts_that_differ_in_one_place(spark):
    """Long texts whose blocks agree but for one, shifted and reordered blocks, prefixes, and copies in other case."""
    base = "".join(f"{i:03d}" + "x" * 7 for i in range(37))
    texts = [base, base.upper(), base[:-1], base + "x", base[10:] + base[:10], base[:180] + "y" + base[181:], base[:360] + "É", base[:360] + "é"]
    texts += [base[10 * i :] for i in range(5)] + [base[: 10 * i] for i in range(5)] + [base] * 9 + ["İ", "i̇", "K", "k", "K", "ẞ", "ß", "A\x00", "a\x00", "a"]
    rows = list(enumerate(texts))
    df = frame(spark, [(i, text, "en", "a", 0) for i, text in rows])
    for size in (10, 7):
        assert found(df, size=size) == plain(rows)


def test_a_key_that_is_not_one_to_one_is_not_used(spark):
    def weak(block, seed):
        """The length alone, but for the third seed."""
        return exact_dedup.block_key(block, seed) if seed == 2 else F.struct(F.octet_length(block).cast("long").alias("x"), F.lit(0).cast("long").alias("y"))

    rows = [(1, "aa"), (2, "bb"), (3, "AA")]
    df = frame(spark, [(i, text, "en", "a", 0) for i, text in rows])
    assert exact_dedup.proven_seed(df.select(exact_dedup.normalised(F.col("text")).alias("norm")), weak) == 2
    assert found(df, key=weak) == plain(rows)


def test_frequent_keys(spark):
    rows = spark.createDataFrame([(i, 0 if i % 3 == 0 else i) for i in range(300)], "row long, x long")
    table = rows.groupBy("x").agg(F.count("*").alias("uses")).withColumn("name", F.col("x") * 10)
    for hot in (1, 4, 1000):
        got = exact_dedup.looked_up(rows, table, ["x"], hot)
        assert Counter(tuple(r) for r in got.collect()) == Counter((i, 0, 0) if i % 3 == 0 else (i, i, 10 * i) for i in range(300))


def test_names_rise_with_the_keys(spark):
    rows = spark.createDataFrame([(i % 50, -i % 7) for i in range(1000)], "x long, y long").repartition(5)
    names = exact_dedup.names_of(rows, ["x", "y"]).orderBy("x", "y").collect()
    assert len({r.name for r in names}) == len(names) and [r.name for r in names] == sorted(r.name for r in names)


def test_awkward_documents(awkward, awkward_rows, nothing):
    assert found(awkward) == plain([row[:2] for row in awkward_rows])
    assert exact_dedup.exact_duplicates(nothing).count() == 0
