from __future__ import annotations

import re
from collections import Counter

import pytest

from reviewmill.llm import license_scan, quality_rules
from tests_llm import frame, texts


def plain_words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def plain_scan(text):
    words = plain_words(text)
    places = [(i, label) for label, phrase in license_scan.PHRASES.items() for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
    base = {label for _, label in places}
    met, share = set(), 0.0
    for start in range(0, max(len(words), 1), license_scan.STEP):
        block = set(words[start : start + 2 * license_scan.STEP])
        for label, each in license_scan.TEMPLATES.items():
            for template in each:
                wanted = set(template.split())
                if 10 * len(block & wanted) >= 9 * len(wanted):
                    met.add(label)
                    share = max(share, len(block & wanted) / len(wanted))
    starts = [i for i, _ in places]
    return (len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)), ",".join(sorted(base | met)), 1.0 if places else share)


def license_rows(df):
    return [(r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, pytest.approx(r.score)) for r in df.orderBy("doc_id").collect()]


def test_license_scan_of_given_documents(documents, given):
    assert license_rows(license_scan.scan(documents)) == [plain_scan(r.text) for r in given]


def test_license_scan_of_hard_texts(spark):
    filler = "lorem ipsum dolor " * 40
    hard = [
        "CC BY cc-by CC/BY 4.0", "cc by cc by", "ALL rights RESERVED all rights", "GNU General\nPublic: License",
        "Key all rightſ reserved", "İ cc by", filler + "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and its documentation files" + filler,
        "Released under the License", "released under the MIT license", "Licensed under CC BY-NC 4.0.", "c c by", "general public licenses", "by",
    ]
    assert license_rows(license_scan.scan(texts(spark, *hard))) == [plain_scan(text) for text in hard]


def test_awkward_documents_in_scan(awkward, awkward_rows, nothing):
    got = license_scan.scan(awkward).collect()
    assert Counter((r.doc_id, r.n_words) for r in got) == Counter((i, len(plain_words(text))) for i, text, *_ in awkward_rows)
    assert license_scan.scan(nothing).count() == 0


def plain_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    n, repeated = len(words), len(covered)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), repeated, n < 50 or 100 * repeated > 50 * n)


def quality_rows(df):
    return [(r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in df.orderBy("doc_id").collect()]


def test_quality_counts_of_given_documents(documents, given):
    assert quality_rows(quality_rules.judge(documents)) == [plain_counts(r.text) for r in given]


def test_quality_counts_of_hard_texts(spark):
    hard = ["a b c a b c", "a a a a", "a a a", "a b", "x y z\n\nx y z\n \nx y z\r", "#*$%&|<>", "a b c d a b c b c d", "   é", "w " * 3000]
    assert quality_rows(quality_rules.judge(texts(spark, *hard))) == [plain_counts(text) for text in hard]


def test_awkward_documents_in_rules(awkward, awkward_rows, nothing):
    got = quality_rules.judge(awkward).collect()
    assert Counter((r.doc_id, r.n_words) for r in got) == Counter((i, plain_counts(text)[0]) for i, text, *_ in awkward_rows)
    assert quality_rules.judge(nothing).count() == 0


def test_hosts_decide_on_lone_failures(spark):
    """A document with many symbols stays on a sound host and goes on a host where most have them; clean ones stay."""
    def text(i, junk):
        return " ".join(f"word{i}x{k}" + ("##" if junk else "") for k in range(60))

    rows = [(i, text(i, i % 50 == 0), "en", "sound", 0) for i in range(100)]
    rows += [(1000 + i, text(i, i % 5 != 0), "en", "bad", 0) for i in range(100)]
    rows += [(2000 + i, text(i, False), "en", f"h{i % 10}", 0) for i in range(100)]
    kept = {r.doc_id: r.kept for r in quality_rules.judge(frame(spark, rows)).collect()}
    assert kept[0] and kept[1005] and all(kept[2000 + i] for i in range(100))
    assert not kept[1001] and sum(kept[1000 + i] for i in range(100)) == 20
