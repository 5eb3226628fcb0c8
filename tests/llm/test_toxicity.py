from __future__ import annotations

import random
import time
import zlib
from collections import Counter

from reviewmill.llm import toxicity
from reviewmill.llm.toxicity import Automaton, Lexicon, Term
from tests_llm import frame


def distance(a, b):
    """Edits with swaps of neighbours (optimal string alignment)."""
    d = {(i, j): max(i, j) for i in range(len(a) + 1) for j in range(len(b) + 1) if not i or not j}
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
    return d[len(a), len(b)]


def test_automaton_agrees_with_the_edit_distance():
    terms = [Term("idiot$", 1.0), Term("moron$", 1.0), Term("worthless$", 1.0), Term("scum$", 1.0)]
    automaton, draw = Automaton(terms), random.Random(5)
    for _ in range(4000):
        word = list(draw.choice(["idiot", "moron", "worthless", "scum"]))
        for _ in range(draw.randrange(4)):
            place, kind = draw.randrange(len(word)), draw.randrange(4)
            if kind == 0:
                word[place] = draw.choice("abcdeilmnorstuwé1")
            elif kind == 1:
                word.insert(place, draw.choice("abcdeilmnorstuwé1"))
            elif kind == 2 and len(word) > 1:
                del word[place]
            elif place:
                word[place - 1], word[place] = word[place], word[place - 1]
        word = "".join(word)
        near = [(distance(word, t.text[:-1]), n) for n, t in enumerate(terms) if distance(word, t.text[:-1]) <= t.edits]
        assert automaton.match(word) == min(near, default=None), word


def test_stems_accept_any_ending_but_no_misspelling():
    automaton = Automaton([Term("lowei", 1.0), Term("chón", 1.0)])
    assert automaton.match("loweischaft") == (0, 0) and automaton.match("lowei") == (0, 0) and automaton.match("chónú") == (0, 1)
    assert automaton.match("lowe") is None and automaton.match("lewei") is None


def test_context_windows_tell_quotation_from_abuse():
    lexicon = Lexicon([Term("idiot$", 1.0)], frozenset({"idiom"}))
    plain, quoted, addressed = (lexicon.features(t)[0] for t in ("some idiot here", 'the so-called "idiot" here', "you idiot"))
    assert quoted[0] < plain[0] < addressed[0] and quoted[2] > 0 == plain[2]
    assert lexicon.features("he said idiot once")[0][0] < plain[0]
    assert lexicon.features("an idi0t")[1] == ["idi0t"] and lexicon.features("an idiom")[0] == [0.0] * 4


def labelled(n, held_out_label=None):
    """Half the rows hold a made-up word; the labels follow it, but for held-out ids if told otherwise."""
    rows, labels = [], []
    for i in range(n):
        toxic = int(i % 2 == 0)
        rows.append((i, f"plain text number {i} of many " + ("blorkish words" if toxic else "calm words"), "en", "a", 0))
        out = zlib.crc32(str(i).encode()) % 5 == 0
        labels.append((i, 1, toxic if not out or held_out_label is None else held_out_label))
    return rows, labels


def test_learned_words_score_held_out_rows(spark):
    rows, labels = labelled(120)
    got = toxicity.toxic_scores(frame(spark, rows), frame(spark, labels, "doc_id long, quality int, toxic int")).collect()
    assert all(r.predicted == int(r.doc_id % 2 == 0) and r.predicted == int(r.score >= 0.5) and 0 <= r.score <= 1 for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got) and len(got) == 120


def test_held_out_labels_are_never_read(spark):
    rows, labels = labelled(80)
    _, other = labelled(80, held_out_label=1)
    schema = "doc_id long, quality int, toxic int"
    one, two = (sorted(toxicity.toxic_scores(frame(spark, rows), frame(spark, each, schema)).collect()) for each in (labels, other))
    assert one == two


def test_accuracy_on_held_out_documents(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{name}.parquet") for name in ("documents", "labels"))
    scored = toxicity.toxic_scores(docs, labels).join(labels, "doc_id").filter("held_out").collect()
    wrong = Counter((r.toxic, r.predicted) for r in scored)
    assert wrong[0, 1] == 0 and wrong[1, 1] >= 0.6 * (wrong[1, 0] + wrong[1, 1])


def test_awkward_documents(spark, awkward, nothing):
    labels = frame(spark, [(1, 1, 1), (1, 1, 0), (None, 1, 1), (9, None, None), (77, 1, 1)], "doc_id long, quality int, toxic int")
    got = toxicity.toxic_scores(awkward, labels).collect()
    assert len(got) == awkward.count() and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id in (2, 3, 4)}) == 1
    none = labels.filter("false")
    assert toxicity.toxic_scores(nothing, none).count() == 0
    kept = toxicity.without_toxic(awkward, none)
    assert kept.columns == awkward.columns and sorted(kept.collect(), key=str) == sorted(awkward.collect(), key=str)
    bad = frame(spark, [(1, "you stupid worthless idiot", "en", "a", 0), (2, "a stuipd idea", "en", "a", 0), (3, "all fine", "en", "a", 0)])
    assert [r.doc_id for r in toxicity.without_toxic(bad, none).collect()] == [3]


def plain_quoted(text, start, end):
    before = text[text.rfind("\n", 0, start) + 1 : start]
    after = text[end:].split("\n")[0]
    pairs = any(before.rfind(a) > before.rfind(b) and b in after for a, b in ("“”", "«»", "„“"))
    return pairs or (before.count('"') % 2 == 1 and '"' in after)


def test_quotations_agree_with_a_plain_search():
    draw = random.Random(3)
    seen = set()
    for _ in range(300):
        text = "".join(draw.choice('ab “”«»„"\n') for _ in range(draw.randrange(1, 40)))
        quotations = toxicity.Quotations(text)
        for start in range(len(text)):
            end = draw.randrange(start, len(text)) + 1
            assert quotations.hold(start, end) == plain_quoted(text, start, end)
            seen.add(quotations.hold(start, end))
    assert seen == {True, False}


def test_one_long_line_takes_linear_time():
    lexicon = toxicity.Lexicon([toxicity.Term("idiot$", 1.0)])
    text = 'such an "idiot" here, ' * 100_000
    began = time.process_time()
    found, _ = lexicon.features(text)
    assert found[2] > 0 and time.process_time() - began < 20
