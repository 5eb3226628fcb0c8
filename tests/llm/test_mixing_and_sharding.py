from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from reviewmill.llm import mixing, sharding
from reviewmill.llm.sharding import Tree
from tests_llm import frame


def plain_targets(sizes, weights=(5, 2, 1), most=3):
    """Shares the words again and again until no target is above its cap."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, open_, rest = dict.fromkeys(order, 0.0), set(order), float(sum(sizes.values()))
    while rest > 1e-9 and open_:
        total = sum(weight[s] for s in open_)
        for s in open_:
            target[s] += rest * weight[s] / total
        rest = sum(max(0.0, target[s] - most * sizes[s]) for s in order)
        for s in order:
            target[s] = min(target[s], most * sizes[s])
        open_ = {s for s in order if target[s] < most * sizes[s]}
    return target


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def check_mix(rows, got, tolerance):
    sizes = defaultdict(int)
    for _, text, _, source, _ in rows:
        sizes[source] += words(text)
    target = plain_targets(sizes)
    assert Counter((r.doc_id, r.size, r.source_size) for r in got) == Counter((i, words(t), sizes[s]) for i, t, _, s, _ in rows)
    source_of = {(i, words(t)): s for i, t, _, s, _ in rows}
    taken = defaultdict(int)
    for r in got:
        source = source_of[r.doc_id, r.size]
        assert r.target == pytest.approx(target[source]) and 0 <= r.taken <= 3 * r.size
        taken[source] += r.taken
    longest = max((words(t) for _, t, *_ in rows), default=0)
    for source, total in taken.items():
        assert abs(total - target[source]) <= max(tolerance * target[source], longest)


def test_mix_of_given_documents(documents, given):
    first, again = (mixing.copies(documents).collect() for _ in range(2))
    assert sorted(first) == sorted(again)
    check_mix([(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in given], first, 0.02)


def test_mix_with_caps_null_sources_and_a_hot_source(spark):
    draw = random.Random(3)
    rows = [(i, " ".join("w" * draw.randrange(1, 60)), "en", "big", 0) for i in range(600)]
    rows += [(1000 + i, "a b c d", "en", source, 0) for i, source in enumerate(["A", "tiny", None, "Z", "é"] * 8)]
    check_mix(rows, mixing.copies(frame(spark, rows)).collect(), 0.05)


def test_awkward_documents_in_mix(awkward, awkward_rows, nothing):
    got = mixing.copies(awkward).collect()
    assert Counter((r.doc_id, r.size) for r in got) == Counter((i, words(t)) for i, t, *_ in awkward_rows)
    mix = mixing.mixed(awkward)
    assert mix.columns == awkward.columns
    by_key = {(r.doc_id, r.size): r.copies for r in got}
    expected = Counter()
    for i, t, *_ in awkward_rows:
        expected[i, t] += by_key[i, words(t)] * (words(t) > 0)
    assert Counter((r.doc_id, r.text) for r in mix.collect()) == +expected
    assert mixing.copies(nothing).count() == 0 and mixing.mixed(nothing).count() == 0


def test_sampling_follows_the_inclusion_probabilities(spark):
    """Over many seeds, a document is taken about as often as its expected copies say."""
    rows = [(i, " ".join("w" * (1 + i % 40)), "en", "s" if i % 3 else "t", 0) for i in range(120)]
    docs = frame(spark, rows).cache()
    taken, expected = defaultdict(int), {}
    seeds = 12
    for seed in range(seeds):
        sized, per_source = mixing.plan(docs, (5, 1), 3, f"seed {seed}")
        for r in mixing.with_copies(sized, per_source, 3, f"seed {seed}").collect():
            taken[r.doc_id] += r.copies
            expected[r.doc_id] = min(3.0, r.rate * r.v)
    shares = {i: taken[i] / seeds for i in expected}
    for low in (0, 60):
        ids = [i for i in expected if low <= i < low + 60]
        assert sum(shares[i] for i in ids) == pytest.approx(sum(expected[i] for i in ids), rel=0.1)
    assert all(math.floor(expected[i] + 1e-9) <= shares[i] <= math.floor(expected[i] + 1e-9) + 1 for i in expected)


def plain_draw(key, name, weight):
    u = (int(hashlib.md5(f"{key}/{name}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
    return -math.log(u) / weight


def plain_shard(key, tree):
    number = {}
    for i, region in enumerate(tree.regions):
        for j, rack in enumerate(region):
            for k in range(len(rack)):
                number[i, j, k] = len(number)
    i = min((i for i, r in enumerate(tree.regions) if sum(map(sum, r))), key=lambda i: plain_draw(key, f"{i}", sum(map(sum, tree.regions[i]))) if len(tree.regions) > 1 else 0)
    region = tree.regions[i]
    j = min((j for j, r in enumerate(region) if sum(r)), key=lambda j: plain_draw(key, f"{i}/{j}", sum(region[j])))
    k = min((k for k, w in enumerate(region[j]) if w), key=lambda k: plain_draw(key, f"{i}/{j}/{k}", region[j][k]))
    return number[i, j, k]


EIGHT = Tree.even(2, 2, 2)


def test_shards_of_given_documents(documents, given):
    got = {r.doc_id: r for r in sharding.place(documents, EIGHT).collect()}
    assert len(got) == len(given)
    for r in given:
        one, raw = got[r.doc_id], (r.text or "").encode()
        assert (one.size, one.text_crc32, one.law) == (len(raw) + 1, zlib.crc32(raw), "key")
        assert one.shard == plain_shard(str(r.doc_id), EIGHT)
        assert one.grown_shard == plain_shard(str(r.doc_id), EIGHT.grown())
        assert one.grown_shard in (one.shard, 8)
    for shard in range(8):
        slots = sorted(r.slot for r in got.values() if r.shard == shard)
        assert slots == list(range(len(slots)))


def test_awkward_documents_in_shards(awkward, awkward_rows, nothing):
    got = sharding.place(awkward, EIGHT, ("text", "source")).collect()
    assert Counter((r.doc_id, r.text, r.source) for r in got) == Counter((i, t, s) for i, t, _, s, _ in awkward_rows)
    for shard in range(8):
        slots = sorted(r.slot for r in got if r.shard == shard)
        assert slots == list(range(len(slots)))
    assert len({r.shard for r in got if r.doc_id is None}) == 1
    assert sharding.place(nothing, EIGHT).count() == 0


def shards(spark, tree, n=4000):
    ids = spark.range(n).select(F.col("id"), sharding.shard_of(F.col("id").cast("string"), tree).alias("shard"))
    return {r.id: r.shard for r in ids.collect()}


def test_weights_decide_and_movement_stays_in_the_changed_subtree(spark):
    tree = Tree((((1.0, 2.0), (1.0,)), ((4.0, 0.0),)))
    before = shards(spark, tree)
    count = Counter(before.values())
    assert count[4] == 0 and count[3] == pytest.approx(2000, rel=0.1) and count[1] == pytest.approx(2 * count[0], rel=0.2)
    # Shard 1 of the first rack gains: documents only move into its region, rack or itself.
    after = shards(spark, Tree((((1.0, 4.0), (1.0,)), ((4.0, 0.0),))))
    moved = [(before[i], after[i]) for i in before if before[i] != after[i]]
    assert moved and all(a == 1 if b in (0, 1) else True for b, a in moved)
    assert not [x for x in moved if x[1] == 3] and all(a in (0, 1) for b, a in moved if b == 2)


def test_grown_trees_only_move_into_the_new_shard(spark):
    tree = EIGHT
    for _ in range(3):
        before, after = shards(spark, tree, 1500), shards(spark, tree.grown(), 1500)
        moved = {after[i] for i in before if before[i] != after[i]}
        assert moved == {tree.shards}
        tree = tree.grown()


def test_a_tree_without_weights_is_refused():
    with pytest.raises(ValueError, match="no shard"):
        sharding.shard_of(F.lit("1"), Tree((((0.0,),),)))
