from __future__ import annotations

import re
import zlib
from collections import Counter

import pytest
from test_decontamination import whole_copies
from test_mixing_and_sharding import check_mix, plain_shard
from test_near_dedup import plain_components

import corpus_pipeline
from reviewmill.llm import mixing
from reviewmill.session import materialise

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """The rows before and after each stage."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    tables = [docs]
    for _, stage in corpus_pipeline.STAGES:
        docs = materialise(stage(spark, docs, FOLDER))
        tables.append(docs)
    return [(table.columns, table.collect()) for table in tables]


def test_all_but_the_last_stage_return_documents(stages):
    assert all(columns == stages[0][0] for columns, _ in stages[:-1])
    assert set(stages[0][0]) | {"shard", "slot"} <= set(stages[-1][0])


def test_toxic_documents_go_and_clean_ones_stay(spark, stages):
    toxic = {r.doc_id: r.toxic for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    before, after = ({r.doc_id for r in stages[i][1]} for i in (0, 1))
    gone = before - after
    words = re.compile(r"\b(idiot|moron|loser|stupid|pathetic|worthless|clown)\b", re.I)
    assert {r.doc_id for r in stages[0][1] if words.search(r.text)} <= gone
    assert all(toxic.get(i, 1) for i in gone) and after <= before


def test_one_document_of_each_group_stays(stages):
    expected = plain_components([(r.doc_id, r.text) for r in stages[1][1]])
    assert sorted(r.doc_id for r in stages[2][1]) == sorted(i for i, (_, smallest) in expected.items() if i == smallest)


def test_documents_with_benchmark_items_go(spark, stages):
    items = spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()
    leaked = {i for i, _ in whole_copies(stages[2][1], items)}
    assert {r.doc_id for r in stages[3][1]} == {r.doc_id for r in stages[2][1]} - leaked


def test_the_mix_takes_effect(spark, stages):
    before = spark.createDataFrame(stages[3][1], spark.read.parquet(f"{FOLDER}/documents.parquet").schema)
    copies = mixing.copies(before).collect()
    check_mix([(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in stages[3][1]], copies, 0.05)
    assert Counter(r.doc_id for r in stages[4][1]) == +Counter({r.doc_id: r.copies * (r.size > 0) for r in copies})


def test_every_row_gets_its_shard_and_a_slot(stages):
    rows = stages[5][1]
    assert Counter((r.doc_id, r.text) for r in rows) == Counter((r.doc_id, r.text) for r in stages[4][1])
    assert all(r.shard == plain_shard(str(r.doc_id), corpus_pipeline.SHARDS) and r.text_crc32 == zlib.crc32(r.text.encode()) for r in rows)
    for shard in range(8):
        slots = sorted(r.slot for r in rows if r.shard == shard)
        assert slots == list(range(len(slots)))


def test_stages_take_awkward_and_empty_documents(spark, awkward, nothing):
    for docs in (awkward.select("doc_id", "text", "lang", "source", "n_chars"), nothing):
        for _, stage in corpus_pipeline.STAGES:
            docs = materialise(stage(spark, docs, FOLDER))
        assert "shard" in docs.columns
