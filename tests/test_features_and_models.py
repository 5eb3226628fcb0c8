"""Features against plain Python, vector form against relational form, properties of the fits."""

from __future__ import annotations

import math
import random
import re
import sys
import time
import unicodedata
from collections import Counter

import pytest
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from reviewmill import settings
from reviewmill.functions.stopwords import ENGLISH
from reviewmill.functions.tokens import strip_accents
from reviewmill.operators import classifiers, cleaning, features, labeling, metrics, multilabel, sampling
from reviewmill.plans import ablation
from reviewmill.session import materialise

DOCS = [
    (1, "a", "The quick brown fox, the quick dog."),
    (2, "a", "Élan vital: quick élan x 7_7"),
    (3, "b", "dog dog DOG bites fox"),
    (4, "b", ""),
    (5, "b", "the of and"),
]


def terms_of(text, ngrams=(1, 2)):
    words = [w for w in re.findall(r"(?u)\b\w\w+\b", text.lower()) if w not in ENGLISH]
    grams = words if ngrams[0] == 1 else []
    return grams + ([f"{a} {b}" for a, b in zip(words, words[1:])] if ngrams[1] == 2 else [])


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, "review_id long, sentiment_label string, clean_text string")


@pytest.fixture(scope="module")
def cleaned(reviews):
    return cleaning.preprocess(labeling.add_labels(reviews))


@pytest.fixture(scope="module")
def split(spark, cleaned):
    from reviewmill.session import materialise

    return materialise(sampling.split_rows(cleaned))


def test_stop_words_are_the_default_list(spark):
    from pyspark.ml.feature import StopWordsRemover

    assert ENGLISH == StopWordsRemover.loadDefaultStopWords("english")


@pytest.mark.parametrize("ngrams", [(1, 1), (2, 2), (1, 2)])
def test_document_terms(docs, ngrams):
    rows = features.document_terms(docs, features.TextFeatures(ngrams=ngrams)).collect()
    want = {(i, t, n) for i, _, text in DOCS for t, n in Counter(terms_of(text, ngrams)).items()}
    assert {(r.review_id, r.term, r.tf) for r in rows} == want and len(rows) == len(want)


def test_vocabulary_limits(docs):
    kept = features.vocabulary(docs, features.TextFeatures(ngrams=(1, 1), min_df=2, size=10)).collect()
    assert [(r.term, r.cf, r.df) for r in kept] == [("dog", 4, 2), ("quick", 3, 2), ("fox", 2, 2)]
    # A share of reviews, not a count: 2 of 5 is above 0.3.
    assert features.vocabulary(docs, features.TextFeatures(ngrams=(1, 1), min_df=2, max_df=0.3)).count() == 0


def test_vectors_equal_relational_weights(docs):
    spec = features.TextFeatures(min_df=1, max_df=1.0)
    vectorizer = features.Vectorizer.fit(docs, spec)
    vectors = {
        r.review_id: dict(zip(vectorizer.terms, r.v))
        for r in vectorizer.transform(docs).select("review_id", vector_to_array("features").alias("v")).collect()
    }
    n = features.row_count(docs)
    idf = features.idf_table(features.vocabulary(docs, spec), n)
    rows = features.tfidf_weights(features.document_terms(docs, spec), idf).collect()
    assert len(rows) == sum(1 for v in vectors.values() for x in v.values() if x > 0)
    for r in rows:
        assert vectors[r.review_id][r.term] == pytest.approx(r.weight)
    df = Counter(t for _, _, text in DOCS for t in set(terms_of(text)))
    raw = {t: c * (math.log(6 / (1 + df[t])) + 1) for t, c in Counter(terms_of(DOCS[2][2])).items()}
    norm = math.sqrt(sum(v * v for v in raw.values()))
    assert {r.term: round(r.weight, 9) for r in rows if r.review_id == 3} == {t: round(v / norm, 9) for t, v in raw.items()}
    assert not any(vectors[4].values()) and not any(vectors[5].values())


def without_marks(text):
    return "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))


def test_accents(spark):
    """Letters of every kind, and random strings over all code points (one form for each, surrogates left out)."""
    draw = random.Random(1)
    codes = [c for c in range(1, sys.maxunicode + 1) if not 0xD800 <= c < 0xE000]
    special = [c for c in codes if unicodedata.normalize("NFKD", chr(c)) != chr(c)]
    texts = ["éèêçàüöäñ ß ½ ﬁ", "é", "Ω ώ й", "plain", "", "ﷺ ㎏ Ⅷ ｶﾞ 한국어 각", "𝒜𝟗 𝔸 \u0344"]
    texts += ["".join(chr(draw.choice(codes)) for _ in range(60)) for _ in range(40)]
    texts += ["".join(chr(draw.choice(special)) for _ in range(60)) for _ in range(40)]
    texts += ["".join(map(chr, special[i : i + 500])) for i in range(0, len(special), 500)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r[0] for r in df.orderBy("i").select(strip_accents(F.col("t"))).collect()]
    # Marks go, so the order that normal forms give to marks doesn't matter.
    assert got == ["".join(map(without_marks, t)) for t in texts] == [without_marks(t) for t in texts]


def test_accents_of_long_texts_cost_no_more_than_a_few_translations(spark):
    """one class of hundreds of ranges was asked at every letter, eight times the price of the translation."""
    texts = materialise(spark.range(4_000).select(F.repeat(F.lit("plain words, déjà vu. "), 400).alias("t")))

    def seconds(column):
        best = []
        for _ in range(3):
            begun = time.perf_counter()
            texts.select(column.alias("x")).write.format("noop").mode("overwrite").save()
            best.append(time.perf_counter() - begun)
        return min(best)

    assert seconds(strip_accents(F.col("t"))) < 3 * seconds(F.translate("t", "é", "e"))


@pytest.mark.parametrize("ngrams", [(1, 1), (1, 2), (2, 2)])
@pytest.mark.parametrize("accents", [True, False])
def test_corpus_statistics_against_rows_per_review(spark, ngrams, accents, monkeypatch):
    """the same counts as a row per review and term, whatever the slices; null and empty texts have none."""
    draw = random.Random(2)
    known = ["the", "and", "été", "ete", "course", "Course", "x", "ǆ", "word_1", "ﬁne", "😀", "lecture"]
    rows = [(i, " ".join(draw.choices(known, k=draw.randrange(12)))) for i in range(300)] + [(300, None), (301, ""), (301, "course course")]
    df = spark.createDataFrame(rows, "review_id long, clean_text string")
    monkeypatch.setattr("reviewmill.operators.corpus_terms.TOKENS", 100)
    for stop in (None, [], ["course"]):
        spec = features.TextFeatures(ngrams=ngrams, accents=accents, stop_words=stop)
        got = sorted(map(tuple, features.corpus_statistics(df, spec).collect()))
        assert got == sorted(map(tuple, features.term_statistics(features.document_terms(df, spec, ())).collect()))


def test_vocabulary_has_no_row_per_review_and_term(spark):
    """what is summed over the cluster are the distinct terms of a slice."""
    df = spark.createDataFrame([(i, "good course") for i in range(1000)], "review_id long, clean_text string").coalesce(1)
    plan = features.vocabulary(df)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "Generate" not in plan


def test_class_weights(docs):
    weights = {r.sentiment_label: r.class_weight for r in features.class_weights(docs).collect()}
    assert weights == {"a": pytest.approx(5 / 4), "b": pytest.approx(5 / 6)}


def test_naive_bayes_against_plain_python(docs):
    spec = features.TextFeatures(min_df=1, max_df=1.0)
    model, idf = classifiers.bayes_fit(docs, features=spec)
    got = {r.review_id: (r.predicted_label, r.score) for r in classifiers.bayes_predict(model, idf, docs, spec).collect()}
    df = Counter(t for _, _, text in DOCS for t in set(terms_of(text)))
    vectors = {}
    for i, label, text in DOCS:
        raw = {t: c * (math.log(6 / (1 + df[t])) + 1) for t, c in Counter(terms_of(text)).items()}
        norm = math.sqrt(sum(v * v for v in raw.values())) or 1.0
        vectors[i] = (label, {t: v / norm for t, v in raw.items()})
    mass = {c: Counter() for c in "ab"}
    for label, vector in vectors.values():
        mass[label].update(vector)
    for i, (_, vector) in vectors.items():
        scores = {}
        for c in "ab":
            total = sum(mass[c].values()) + len(df)
            prior = math.log(sum(label == c for label, _ in vectors.values()) / 5)
            scores[c] = prior + sum(v * math.log((mass[c][t] + 1) / total) for t, v in vector.items())
        best = max(sorted(scores), key=scores.get)
        assert got[i][0] == best and got[i][1] == pytest.approx(scores[best])


def test_baselines_beat_the_majority_and_repeat(split):
    train, test = split.filter("split = 'train'"), split.filter("split = 'test'")
    scores, predictions = classifiers.train_sentiment_baselines(train, test, labeling.FROM_LABEL)
    accuracy = {r.model: r.accuracy for r in scores.collect()}
    assert set(accuracy) == set(settings.SENTIMENT_MODELS)
    assert all(a > 0.8 for a in accuracy.values()), accuracy
    counts = Counter(r.model for r in predictions.collect())
    assert set(counts.values()) == {test.count()}
    assert {r.predicted_label for r in predictions.collect()} <= set(settings.THREE_CLASSES)
    again, _ = classifiers.train_sentiment_baselines(train, test, labeling.FROM_LABEL, [settings.LOGISTIC_NAME])
    assert again.first().accuracy == accuracy[settings.LOGISTIC_NAME]


def test_baselines_that_cannot_run(split):
    train, test = split.filter("split = 'train'"), split.filter("split = 'test'")
    rows, none = classifiers.train_sentiment_baselines(train, test, labeling.NO_LABELS)
    assert none is None and {r.status for r in rows.collect()} == {"not_run"} and rows.first().notes == labeling.NO_LABELS.reason
    one = train.filter("sentiment_label = 'positive'")
    rows, none = classifiers.train_sentiment_baselines(one, test, labeling.FROM_LABEL)
    assert none is None and rows.count() == 4
    rows, none = classifiers.train_sentiment_baselines(train, test.limit(0), labeling.FROM_LABEL)
    assert none is None and {r.status for r in rows.collect()} == {"not_run"}


def test_multilabel(split):
    train, test = split.filter("split = 'train'"), split.filter("split = 'test'")
    flags = ["f_even", "f_good", "f_never", "f_absent"]
    result = multilabel.train_multilabel(train, test, flags)
    row = result.results.first()
    assert row.model == settings.OVR_NAME and row.status == "run"
    report = {r.label: r for r in result.label_report.collect()}
    assert set(report) == {"f_even", "f_good", "f_never"} and report["f_good"].f1_score > 0.9
    assert all(r["pred_f_never"] == 0 for r in result.predictions.collect())
    constant = multilabel.train_multilabel(train, test, ["f_never"])
    assert constant.results.first().model == settings.MAJORITY_NAME and constant.results.first().notes != ""
    assert multilabel.train_multilabel(train, test, ["absent"]).results.first().status == "not_run"
    variant = multilabel.train_multilabel_variant(split, "quick", flags).results.first()
    assert variant.labels_used == "f_even,f_good" and variant.train_rows == split.filter("split <> 'test'").count()


def test_flag_metrics_against_plain_python(spark):
    rows = [(1, 1, 0, 0), (1, 0, 0, 1), (0, 0, 1, 1), (0, 1, 0, 0)]
    df = spark.createDataFrame(
        [("m", *r) for r in rows], "model string, true_x int, pred_x int, true_y int, pred_y int"
    )
    m = metrics.multilabel_metrics(df, ["x", "y"]).first()
    # x: tp 1 fp 1 fn 1; y: tp 1 fp 1 fn 0
    assert (m.micro_f1, m.macro_f1) == (pytest.approx(4 / 7), pytest.approx((1 / 2 + 2 / 3) / 2))
    assert (m.hamming_loss, m.subset_accuracy) == (3 / 8, 2 / 4)


def test_sentiment_metrics_with_a_label_only_predicted(spark):
    pairs = [("a", "a"), ("a", "b"), ("b", "b"), ("b", "c")]
    df = spark.createDataFrame([("m", t, p) for t, p in pairs], "model string, true_label string, predicted_label string")
    m = metrics.sentiment_metrics(df).first()
    # a: p 1 r 1/2; b: p 1/2 r 1/2; c: p 0 r 0
    assert m.accuracy == 0.5
    assert m.precision_macro == pytest.approx(0.5) and m.recall_macro == pytest.approx(1 / 3)
    assert m.macro_f1 == pytest.approx((2 / 3 + 1 / 2) / 3) and m.weighted_f1 == pytest.approx((2 / 3 + 1 / 2) / 2)
    matrix = {r.true_label: (r.pred_a, r.pred_b, r.pred_z) for r in metrics.confusion_matrix(df, ["a", "b", "z"]).collect()}
    assert matrix == {"true_a": (1, 1, 0), "true_b": (0, 1, 0), "true_z": (0, 0, 0)}


def test_experiment_rows(spark, cleaned):
    row = dict(zip([f.split()[0] for f in ablation.ROW.split(", ")], ablation.run_experiment(cleaned, "sentiment_label", "e", holdout=True)))
    assert row["status"] == "run" and row["train_rows"] + row["test_rows"] == cleaned.count() and row["value"] > 0.8
    few = ablation.run_experiment(cleaned.limit(10), "sentiment_label", "few")
    assert few[1] == "not_run" and "Insufficient" in few[-1]
    grid = ablation.carried_over(False, None, cleaned).collect()
    assert [r.experiment for r in grid] == ["sentiment_ablation"]


def test_texts_are_dealt_evenly(spark, reviews, monkeypatch):
    """F8: before, a table in one file became vectors in one task, and the vocabulary was handed over once per table."""
    handed, original = [], CountVectorizerModel.from_vocabulary
    monkeypatch.setattr(CountVectorizerModel, "from_vocabulary", lambda *a, **k: handed.append(a) or original(*a, **k))
    stored = materialise(cleaning.preprocess(labeling.add_labels(reviews, "label_raw", "test")).coalesce(1))
    assert len(stored.inputFiles()) == 1
    data = classifiers.prepare(stored, stored)
    assert len(handed) == 1 and data.train.count() == data.test.count() == stored.count() == data.rows
    for table in (data.train, data.test):
        sizes = [r["count"] for r in table.groupBy(F.input_file_name()).count().collect()]
        assert len(sizes) > 8 and max(sizes) < stored.count() / 8
