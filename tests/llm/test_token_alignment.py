from __future__ import annotations

import hashlib
from bisect import bisect_left, bisect_right
from collections import Counter

import numpy as np
import pytest

from reviewmill.llm import token_alignment
from reviewmill.llm.queries import ALIGNED
from tests_llm import frame, texts


@pytest.fixture(scope="module")
def tokenizers():
    """The public libraries as they are meant to be used, and the bytes of their tokens."""
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(ALIGNED[0])
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=ALIGNED[1])
    letters = token_alignment.byte_letters()

    def both(text):
        if not text:
            return [], []
        one = a.encode(" " + text, add_special_tokens=False)
        two = b.encode(text)
        in_a = [(i, bytes(letters[c] for c in a.id_to_token(i))) for i in one.ids]
        in_b = [(i, bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()) for i, p in zip(two, map(b.id_to_piece, two), strict=True)]
        whole = (" " + text).encode()
        same = all(b"".join(token for _, token in side) == whole for side in (in_a, in_b))
        return (in_a, in_b) if same else ([], [])

    return both


def spans(tokens):
    ends = np.cumsum([len(token) for _, token in tokens]).tolist()
    return [(i, start, end) for (i, _), start, end in zip(tokens, [0, *ends], ends, strict=False)]


def plain(rows, both):
    """Groups from sets of ends, links by comparing ranges, counts over all documents."""
    found, holders = [], Counter()
    for doc_id, text in rows:
        a, b = (spans(side) for side in both(text))
        common = sorted({end for *_, end in a} & {end for *_, end in b})
        groups = [[[], []] for _ in common]
        for side, tokens in enumerate((a, b)):
            for i, _, high in tokens:
                groups[bisect_left(common, high)][side].append(str(i))
        groups = [[",".join(side) for side in group] for group in groups]
        links = []
        for i, low, high in a:
            for j, start, _ in b[(at := bisect_right(b, low, key=lambda x: x[2])) : at + 1 + high - low]:
                if start >= high:
                    break
                links.append((i, j))
        holders.update(set(links))
        digest = hashlib.sha256(";".join("|".join(g) for g in groups).encode()).hexdigest() if a else ""
        found.append([doc_id, len(a), len(b), len(groups), links, digest])
    most = Counter()
    for (i, j), n in holders.items():
        most[i] = max(most[i], n)
    return [
        (doc_id, n_a, n_b, n_groups, len(links), sum(holders[x] == most[x[0]] for x in links), sum(holders[x] for x in links), digest)
        for doc_id, n_a, n_b, n_groups, links, digest in found
    ]


def aligned(df, **more):
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return Counter(tuple(r) for r in token_alignment.align(df, *ALIGNED, **more).select(*names).collect())


def test_given_documents(documents, given, tokenizers):
    expected = Counter(plain([(r.doc_id, r.text) for r in given], tokenizers))
    assert aligned(documents) == expected
    assert aligned(documents.repartition(3, "doc_id"), scope_bytes=50_000) == expected


# Blanks in a row, at the ends and of other kinds, special tokens, U+2581, letters of several bytes, one long word.
ODD = [
    None, "", " ", "  ", "a", " a", "a ", "a  b", "a   b c", "a\nb", "a \nb", "a\n b", "a\n  b", "\ta", "it's we'll 'S", "a b", "a  b", "a  b",
    "<|endoftext|> <s> </s> <unk> <0x41>", "a▁b", "a ▁ b", "▁", "日本語 の テスト", "é ß ñ 😀 😀😀", "é ́a", "x\x00y \x1c z \x85 q",
    "1234 5,678.90 -- ... !?", "word" * 3000, "the cat " * 2500, "Ünïcödé straße " * 40, "​zero ﻿width",
]


def test_odd_texts_and_long_documents(spark, tokenizers):
    rows = list(enumerate(ODD))
    assert aligned(texts(spark, *ODD)) == Counter(plain(rows, tokenizers))
    assert aligned(texts(spark, *ODD).repartition(1), scope_bytes=1) == Counter(plain(rows, tokenizers))


def test_lanes_do_not_change_the_result(documents, monkeypatch):
    expected = aligned(documents)
    monkeypatch.setattr(token_alignment, "LANE", 3)
    monkeypatch.setattr(token_alignment, "REMEMBERED", 10)
    assert aligned(documents) == expected


def test_lockstep():
    # Lanes 0..2 and 2..4 of A (ends 2 5 | 7 9), 0..2 and 2..3 of B (ends 3 5 | 9), and a lane without tokens.
    first_a, first_b, stops = np.array([0, 2, 4]), np.array([0, 2, 3]), np.array([2, 4, 4])
    link_a, link_b, cut_a, cut_b = token_alignment.lockstep(np.array([2, 5, 7, 9]), np.array([3, 5, 9]), first_a, first_b, stops)
    assert sorted(zip(link_a.tolist(), link_b.tolist(), strict=True)) == [(0, 0), (1, 0), (1, 1), (2, 2), (3, 2)]
    assert sorted(cut_a.tolist()) == [2, 4] and sorted(cut_b.tolist()) == [2, 3]


def test_awkward_documents(awkward, awkward_rows, nothing, tokenizers):
    assert aligned(awkward) == Counter(plain([row[:2] for row in awkward_rows], tokenizers))
    assert token_alignment.align(nothing, *ALIGNED).count() == 0


def test_bytes_that_are_no_text(spark):
    from pyspark.sql import functions as F

    broken = frame(spark, [(1, "ok", "en", "a", 0)]).withColumn("text", F.expr("cast(X'61FF62' as string)"))
    assert aligned(broken) == Counter([(1, 0, 0, 0, 0, 0, 0, "")])
