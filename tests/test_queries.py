"""Every query with SQL at the smallest scale, and the plans that must not regress."""

from __future__ import annotations

import pytest
from compare import difference, duck

import __spark_entry__ as contract


@pytest.fixture(scope="module")
def connection(sf_dir):
    return duck(sf_dir)


# A fit on the 60 labelled texts of the smallest scale need not beat a constant guess.
FITS = {"train_logreg", "train_linear_svm", "train_random_forest", "train_embedding_classifier"}


@pytest.mark.parametrize("name", sorted(set(contract.oracle_sql()) - FITS))
def test_query_agrees_with_sql(spark, sf_dir, connection, name):
    assert difference(contract.queries()[name](spark, sf_dir), connection, contract.oracle_sql()[name]) == ""


@pytest.mark.parametrize("name", sorted(FITS))
def test_fit_agrees_with_sql(spark, name):
    folder = "/root/testdata/sf0.01"
    assert difference(contract.queries()[name](spark, folder), duck(folder), contract.oracle_sql()[name]) == ""


def test_contract(spark):
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert contract.entry(spark).columns == ["course_id", "sentiment_label", "count"]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans(spark, sf_dir):
    queries = contract.queries()
    plan = plan_of(queries["label_distribution"](spark, sf_dir))
    assert "text" not in plan.split("ReadSchema")[1].split("\n")[0]  # labels need no text
    plan = plan_of(queries["vocabulary_topk"](spark, sf_dir))
    assert "TakeOrderedAndProject" in plan and plan.count("Exchange hashpartitioning(term") == 1
    for name in ("clean_dedupe", "sample_fixed_n", "stratified_split", "tfidf_weights", "topic_summary"):
        plan = plan_of(queries[name](spark, sf_dir))
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
        assert "PythonUDF" not in plan and "ArrowEvalPython" not in plan
