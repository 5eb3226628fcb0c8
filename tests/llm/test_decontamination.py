from __future__ import annotations

import random
import re

import numpy as np
from conftest import prose

from reviewmill.llm import decontaminate
from tests_llm import frame


def plain_subsequence(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], before + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def test_common_subsequence():
    draw = random.Random(1)
    for _ in range(300):
        a, b = ([draw.randrange(6) for _ in range(draw.randrange(1, 90))] for _ in range(2))
        assert decontaminate.common_subsequence(np.array(a), np.array(b)) == plain_subsequence(a, b)


def whole_copies(docs, items):
    """(doc_id, item_id) of items whose words stand in a row in a text."""
    words = lambda text: " " + " ".join(re.findall(r"[^\W_]+", text.lower())) + " "
    return {(d.doc_id, i.item_id) for d in docs for i in items if words(i.text) in words(d.text)}


def test_given_documents(spark, sf_dir, documents, given):
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    got = {(r.doc_id, r.item_id) for r in decontaminate.leaks(documents, benchmark).collect()}
    assert got == whole_copies(given, benchmark.collect())
    clean = decontaminate.without_leaks(documents, benchmark)
    assert clean.columns == documents.columns
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in given} - {i for i, _ in got}


def test_copies_and_paraphrases_of_all_lengths(spark):
    """Whole items anywhere in a text, at any offset, and items with a fifth of the words replaced or left out; half
    an item, or its words in another order, is no leak."""
    draw = random.Random(4)
    items = [(n, prose(50 + n, n)) for n in (8, 15, 17, 31, 33, 64, 90, 200)]
    rows, expected = [], set()
    for n, text in items:
        words = text.split()
        changed = [w if draw.random() > 0.2 else draw.choice(["other", "", "kind"]) for w in words]
        shuffled = draw.sample(words, len(words))
        for kind, body in enumerate([words, [w.upper() for w in words], changed, shuffled, words[: len(words) // 2]]):
            doc_id = 10 * n + kind
            rows.append((doc_id, f"{prose(1000 + doc_id, draw.randrange(200))} {' '.join(body)} {prose(2000 + doc_id, draw.randrange(200))}", "en", "a", 0))
            if kind < 2 or (kind == 2 and n >= 15):
                expected.add((doc_id, n))
    rows += [(90000 + i, prose(7000 + i, 150), "en", "a", 0) for i in range(60)]
    got = {(r.doc_id, r.item_id) for r in decontaminate.leaks(frame(spark, rows), frame(spark, items, "item_id long, text string")).collect()}
    assert {pair for pair in got if pair[0] % 10 < 2 or pair[0] >= 90000} == {pair for pair in expected if pair[0] % 10 < 2}
    assert {pair for pair in expected if pair[0] % 10 == 2} <= got
    assert not {pair for pair in got if pair[0] % 10 > 2 and pair[0] < 90000}


def test_the_answer_must_be_there(spark):
    question, answer = prose(1, 40), prose(2, 6)
    items = frame(spark, [(1, question, answer)], "item_id long, text string, answer string")
    docs = frame(spark, [(1, f"{question} {answer}", "en", "a", 0), (2, f"{question} {prose(9, 20)}", "en", "a", 0)])
    assert [r.doc_id for r in decontaminate.leaks(docs, items).collect()] == [1]
    own = frame(spark, [(1, f"{question}. {answer}", answer)], "item_id long, text string, answer string")
    assert [r.doc_id for r in decontaminate.leaks(docs, own).collect()] == [1]


def test_awkward_documents(spark, awkward, nothing):
    schema = "item_id long, text string, size string"
    items = frame(spark, [(1, prose(7, 70), "x"), (1, prose(7, 70), "x"), (None, None, None), (2, "", ""), (3, "...", ""), (4, "one", "")], schema)
    got = decontaminate.leaks(awkward, items).collect()
    assert sorted((r.doc_id, r.item_id) for r in got) == [(6, 1)] * 2 + [(7, 1)] * 4 + [(8, 1)] * 2 + [(11, 4)]  # the long text has 50 of 70 words
    assert decontaminate.leaks(nothing, items).count() == 0
    assert decontaminate.leaks(awkward, items.filter("false")).count() == 0
    assert decontaminate.without_leaks(awkward, items.filter("false")).count() == awkward.count()
    assert decontaminate.without_leaks(awkward, items).count() == awkward.count() - 5


def test_blocks_of_items_give_what_one_block_gives(spark, sf_dir, documents, monkeypatch):
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    pairs = lambda: sorted((r.doc_id, r.item_id) for r in decontaminate.leaks(documents, benchmark).collect())
    one = pairs()
    monkeypatch.setattr(decontaminate, "BLOCK", 15)
    assert pairs() == one
