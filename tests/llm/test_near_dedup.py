from __future__ import annotations

import random
from collections import defaultdict

from conftest import prose
from pyspark.sql import functions as F

from reviewmill.llm import near_dedup
from tests_llm import frame


def shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())


def plain_components(rows):
    """id -> (shingles, smallest id reachable), comparing all sets that share a shingle."""
    sets = {i: shingles(text) for i, text in rows}
    holders, parent = defaultdict(list), {i: i for i in sets}
    for i, each in sets.items():
        for shingle in each:
            holders[shingle].append(i)

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    pairs = {(a, b) for ids in holders.values() for n, a in enumerate(ids) for b in ids[n + 1 :]}
    for a, b in pairs:
        shared = len(sets[a] & sets[b])
        if 100 * shared >= 75 * (len(sets[a]) + len(sets[b]) - shared):
            low, high = sorted((root(a), root(b)))
            parent[high] = low
    return {i: (len(sets[i]), root(i)) for i in sets}


def found(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_duplicates(df).collect()}


def test_given_documents(documents, given):
    rows = near_dedup.near_duplicates(documents).collect()
    expected = plain_components([(r.doc_id, r.text) for r in given])
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == expected
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)


def edited(words, edits, draw):
    words = list(words)
    for place in draw.sample(range(len(words)), edits):
        words[place] = f"new{draw.randrange(10**6)}"
    return " ".join(words)


def test_large_groups_chains_and_a_shared_passage(spark):
    """Copies of one text with more and more edits (lists far above SMALL_LIST, members inside and outside the
    component), a chain of small steps, and different texts around one passage."""
    draw = random.Random(11)
    base = prose(1, 150).split()
    rows = [(i, edited(base, i % 12, draw)) for i in range(90)]
    chain = prose(2, 120).split()
    for i in range(25):
        chain = edited(chain, 2, draw).split()
        rows.append((1000 + i, " ".join(chain)))
    passage = prose(3, 60)
    rows += [(2000 + i, f"{prose(100 + i, 15 + i)} {passage}") for i in range(40)]
    rows += [(3000 + i, text) for i, text in enumerate(["a b c d", "A  B\nC d", "a b c", "É a b c d", "é a b c d", "x " * 300, "x " * 7])]
    docs = frame(spark, [(i, text, "en", "a", 0) for i, text in rows])
    assert found(docs) == plain_components(rows)


def test_awkward_documents(awkward, nothing):
    got = near_dedup.near_duplicates(awkward).collect()
    assert len(got) == awkward.count()
    by_id = defaultdict(set)
    for r in got:
        by_id[r.doc_id].add((r.n_shingles, r.component_id, r.kept))
    assert by_id[2] == {(0, 2, True)} and by_id[3] == {(0, 3, True)} and by_id[4] == {(0, 4, True)}
    assert by_id[7] == {(66, 7, True)} and by_id[8] == {(66, 7, False)} and by_id[11] == {(1, 11, True)}
    assert by_id[None] == {(56, None, True), (0, None, True)}
    kept = near_dedup.deduplicated(awkward)
    assert kept.columns == awkward.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == [1, 2, 3, 4, 6, 7, 9, 11, 12] and ids.count(None) == 2
    assert near_dedup.near_duplicates(nothing).count() == 0 and near_dedup.deduplicated(nothing).count() == 0


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(64)] + [(100, 101), (7, 7)], "u long, v long")
    got = {r.node: r.comp for r in near_dedup.components(edges).collect()}
    assert got == {**dict.fromkeys(range(1, 65), 0), 101: 100}


def test_an_outsider_that_is_like_the_smallest_id_alone(spark):
    """Truncated copies share all their shingles, so the hash decides which is a list's centre; it is not the smallest
    id.  An edited copy is like that id's text only."""
    base = prose(5, 150).split()
    hashed = {r.id: r.hashed for r in spark.range(200).select("id", F.xxhash64("id").alias("hashed")).collect()}
    smallest = max(range(100), key=hashed.get)
    rows = [(smallest, " ".join(base))]
    rows += [(100 + cut, " ".join(base[cut:])) for cut in range(2, 30)] + [(150 + cut, " ".join(base[:-cut])) for cut in range(2, 30)]
    outsider = list(base)
    for place in (30, 60, 90, 120):
        outsider[place] = f"new{place}"
    rows.append((500, " ".join(outsider)))
    expected = plain_components(rows)
    assert set(expected.values()) == {(expected[i][0], smallest) for i in expected}
    assert plain_components(rows[1:])[500][1] == 500
    assert found(frame(spark, [(i, text, "en", "a", 0) for i, text in rows])) == expected


def test_a_large_group_with_rare_and_common_edits(spark):
    """1,200 copies of one text: edits of their own, edits that a few copies share and edits that hundreds share, so that
    links need common shingles, rare ones or both; every pair is compared on the other side."""
    draw = random.Random(23)
    base = prose(7, 140).split()
    few = [(draw.randrange(140), f"few{i}") for i in range(60)]
    many = [(draw.randrange(140), f"many{i}") for i in range(3)]
    rows = []
    for i in range(1200):
        words = list(base)
        for place, word in draw.sample(few, draw.randrange(6)) + draw.sample(many, draw.randrange(3)):
            words[place] = word
        rows.append((i, edited(words, draw.randrange(4), draw)))
    expected = plain_components(rows)
    groups = {component for _, component in expected.values()}
    assert 10 < len(groups) < 900
    assert found(frame(spark, [(i, text, "en", "a", 0) for i, text in rows])) == expected


def test_candidates_by_common_and_rare_shingles_hold_every_link(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "RARE", 3)
    draw = random.Random(5)
    base = prose(8, 60).split()
    texts = [(i, edited(base, draw.randrange(4), draw)) for i in range(40)]
    texts += [(100 + i, edited(texts[i][1].split(), 1, draw)) for i in range(20)]
    docs = frame(spark, [(i, text, "en", "a", 0) for i, text in texts])
    sets = {i: shingles(text) for i, text in texts}
    nodes = spark.createDataFrame([(i, len(each), len(each), i, True) for i, each in sets.items()], "node long, n long, core long, comp long, apart boolean")
    two = docs.select("doc_id", "text")
    rare = near_dedup.rare_shingles(two)
    bounds = near_dedup.common_sizes(nodes, rare, two)
    common = {r.node: r.common for r in bounds.collect()}
    pairs = {(r.a, r.b) for r in near_dedup.rare_pairs(bounds, rare).collect()}
    links = 0
    for a in sets:
        for b in sets:
            shared = len(sets[a] & sets[b])
            if a < b and 100 * shared >= 75 * (len(sets[a]) + len(sets[b]) - shared):
                links += 1
                assert (a, b) in pairs or 7 * min(common[a], common[b]) >= 3 * (len(sets[a]) + len(sets[b]))
    assert links > 20 and pairs
