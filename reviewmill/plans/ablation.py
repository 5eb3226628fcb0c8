"""The experiment grid: label set, n-gram range and kind of split, one result row each."""

from __future__ import annotations


from functools import partial

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmill import settings
from reviewmill.operators import lda
from reviewmill.operators.classifiers import TrainingSet, fit_predict, logistic, prepare
from reviewmill.operators.features import TOPICS, Vectorizer, ablation_features
from reviewmill.operators.metrics import sentiment_metrics
from reviewmill.operators.passes import as_rows, stored_rows
from reviewmill.operators.sampling import course_holdout, sample_rows, split_rows
from reviewmill.operators.topics import topic_count
from reviewmill.session import in_parallel, materialise

ROW = (
    "experiment string, status string, metric string, value double, accuracy double, precision_macro double, "
    "recall_macro double, macro_f1 double, weighted_f1 double, train_rows long, test_rows long, notes string"
)
RUN_NOTE = "Executed with TF-IDF + Logistic Regression; rating was not used as a feature."
NO_TOPIC_NOTE = (
    "Topic-feature classifier was documented but not run because topic assignments are generated after "
    "supervised splits."
)
NO_WEAK_NOTE = "Kaggle 1.45M weak-label dataset was not available."


def not_run(experiment: str, notes: str) -> tuple:
    return (experiment, "not_run", "macro_f1", None, None, None, None, None, None, 0, 0, notes)


def split_for(df: DataFrame, label: str, holdout: bool) -> DataFrame:
    """Random stratified 80/20, or whole courses held out when there are at least five."""
    if holdout and "course_id" in df.columns:
        held = course_holdout(df, min_courses=settings.ABLATION_MIN_COURSES)
        if held is not None:
            return held
    return split_rows(df, label, val_share=0.0)


def with_topic_shares(data: TrainingSet, train: DataFrame, test: DataFrame) -> TrainingSet:
    """Append the topic shares of an LDA fitted on the training rows only."""
    counts = Vectorizer.fit(train, TOPICS, weighting="counts")
    train_counts = stored_rows(counts.transform(train.select("review_id", "clean_text")), ("review_id",))
    k = topic_count(train_counts.count(), settings.TOPIC_COUNT["quick"], len(counts.terms))
    model = lda.fit(train_counts, max(k, 2), len(counts.terms), settings.TOPIC_ITERATIONS, settings.SEED)
    join = VectorAssembler(inputCols=["features", "shares"], outputCol="_both")

    def extend(vectors: DataFrame, counted: DataFrame) -> DataFrame:
        shares = model.assigned(counted).select("review_id", array_to_vector("topicDistribution").alias("shares"))
        both = join.transform(vectors.join(shares, "review_id"))
        return both.drop("features", "shares").withColumnRenamed("_both", "features")

    test_counts = as_rows(counts.transform(test.select("review_id", "clean_text")), ("review_id",))
    return TrainingSet(
        materialise(extend(data.train, train_counts)), materialise(extend(data.test, test_counts)),
        data.classes, data.rows, data.width + max(k, 2),
    )


def run_experiment(
    df: DataFrame,
    label: str,
    experiment: str,
    ngrams: tuple[int, int] = (1, 2),
    holdout: bool = False,
    topic_shares: bool = False,
    fit_rows: int | None = None,
) -> tuple:
    """One result row.  ``df`` should be a stored table: it is read for the split, the features and
    the scoring.  ``fit_rows`` bounds the training rows after the split (None: all); every test row is scored."""
    data = df.dropna(subset=["clean_text", label])
    size = data.agg(F.count("*").alias("rows"), F.count_distinct(label).alias("classes")).first()
    if size["classes"] < 2 or size["rows"] < settings.ABLATION_MIN_ROWS:
        return not_run(experiment, f"Insufficient rows/classes for {label}.")
    split = materialise(split_for(data, label, holdout))
    train, test = split.filter("split = 'train'"), split.filter("split = 'test'")
    if fit_rows is not None:
        train = materialise(sample_rows(train, fit_rows))
    train_rows, test_rows = train.count(), test.count()
    prepared = prepare(train, test, label, ablation_features(train_rows, ngrams), ["review_id"])
    if topic_shares:
        prepared = with_topic_shares(prepared, train, test)
    scored = fit_predict(prepared, logistic(prepared.rows)).withColumn("model", F.lit(experiment))
    m = sentiment_metrics(scored).first()
    return (
        experiment, "run", "macro_f1", m["macro_f1"], m["accuracy"], m["precision_macro"], m["recall_macro"],
        m["macro_f1"], m["weighted_f1"], train_rows, test_rows, RUN_NOTE,
    )


def run_main_ablation(
    main: DataFrame, weak: DataFrame | None, fit_rows: int | None = None, topic_features: bool = False
) -> DataFrame:
    """All experiments as one table, over all rows of ``main`` and ``weak`` (stored tables).  ``fit_rows`` bounds the
    rows a model is trained on.  With ``topic_features`` the topic experiment is run, with topics fitted on training
    rows; by default it is reported as not run."""
    spark = main.sparkSession
    one = partial(run_experiment, fit_rows=fit_rows)
    runs = {
        "three": partial(one, main, "sentiment_label", "3class_random_split_unigram_bigram"),
        "five": partial(one, main, "label_5class", "5class_random_split_unigram_bigram"),
        "unigram": partial(one, main, "sentiment_label", "3class_random_split_unigram", (1, 1)),
        "holdout": partial(one, main, "sentiment_label", "3class_course_holdout_split", holdout=True),
    }
    if topic_features:
        runs["topics"] = partial(one, main, "sentiment_label", "with_topic_features", topic_shares=True)
    has_weak = weak is not None and not weak.isEmpty()
    if has_weak:
        runs["weak"] = partial(one, weak, "sentiment_label", "kaggle_145m_weak_label_sample")
    done = dict(zip(runs, in_parallel(list(runs.values()))))

    rows = [done["three"], done["five"], done["unigram"], done["holdout"]]
    rows.append(done.get("topics") or not_run("with_topic_features", NO_TOPIC_NOTE))
    if has_weak:
        # Same data and settings as the first experiment, so its numbers are reported, not refitted.
        rows.append(("kaggle_100k_only", *done["three"][1:]))
        row = done["weak"]
        rows.append((*row[:-1], f"{row[-1]} Weak-label rows used: {row[-3] + row[-2]} of {weak.count()}."))
    else:
        rows.append(not_run("kaggle_145m_weak_label_sample", NO_WEAK_NOTE))
    return spark.createDataFrame(rows, ROW)


def carried_over(sentiment_available: bool, multilabel: DataFrame | None, like: DataFrame) -> DataFrame:
    """The short grid that only repeats the multi-label score."""
    name, note = (
        ("sentiment_tfidf_unigram_vs_bigram", "Ablation scaffold is present; skipped to keep runtime bounded.")
        if sentiment_available
        else ("sentiment_ablation", "No sentiment labels are available in the downloaded fallback dataset.")
    )
    schema = "experiment string, status string, metric string, value double, notes string"
    table = like.sparkSession.createDataFrame([(name, "not_run", "macro_f1", None, note)], schema)
    if multilabel is None:
        return table
    scores = multilabel.select(
        F.lit("multilabel_tfidf_one_vs_rest_baseline").alias("experiment"),
        "status",
        F.lit("macro_f1").alias("metric"),
        F.col("macro_f1").alias("value"),
        F.lit("Executed multi-label feedback-type baseline on available public fallback dataset.").alias("notes"),
    )
    return table.unionByName(scores)
