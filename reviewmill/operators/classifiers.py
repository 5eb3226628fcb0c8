"""Sentiment classifiers on text features and on dense vectors."""

from __future__ import annotations

import time
import warnings
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import partial

from pyspark.ml.classification import (
    LogisticRegressionModel,
    LogisticRegression,
    MultilayerPerceptronClassifier,
)
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill import settings
from reviewmill.functions.tokens import explode_counts
from reviewmill.operators import forest, linear, naive_bayes
from reviewmill.operators.features import (
    SENTIMENT,
    TextFeatures,
    Vectorizer,
    class_weights,
    counted_terms,
    idf_table,
    prune,
    row_count,
    term_statistics,
    tfidf_weights,
)
from reviewmill.operators.guards import FEW_CLASSES, sentiment_not_run
from reviewmill.operators.labeling import SentimentInfo
from reviewmill.operators.labeling import feature_columns
from reviewmill.operators.metrics import sentiment_metrics
from reviewmill.operators.passes import as_rows, tasks_of
from reviewmill.operators.sampling import balanced_sample
from reviewmill.session import in_parallel, materialise


@dataclass(frozen=True)
class TrainingSet:
    """What every estimator gets: vectors, class number, balanced weight, and the class names."""

    train: DataFrame
    test: DataFrame
    classes: list[str]
    rows: int
    width: int


def encode(df: DataFrame, label: str, classes: Sequence[str]) -> Column:
    names = F.array(*[F.lit(c) for c in classes])
    return (F.array_position(names, F.col(label)) - 1).cast("double")


def decode(number: Column, classes: Sequence[str]) -> Column:
    return F.get(F.array(*[F.lit(c) for c in classes]), number.cast("int"))


def with_class_weight(df: DataFrame, weights: dict[str, float], label: str) -> DataFrame:
    table = F.create_map(*[F.lit(x) for pair in weights.items() for x in pair])
    return df.withColumn("class_weight", F.element_at(table, F.col(label)))


def balanced_weights(train: DataFrame, label: str) -> tuple[dict[str, float], int]:
    rows = class_weights(train, label).orderBy(label).collect()  # one row per class
    return {r[label]: r["class_weight"] for r in rows}, sum(r["rows"] for r in rows)


#: Of a dense-vector classifier; its labels come to the driver.
MOST_CLASSES = 1000


#: Parts per core that texts are dealt into before they become vectors.
DEALT = 4


def dealt(df: DataFrame) -> DataFrame:
    """Rows in parts of equal size.  Stored tables have few files of uneven size, and a file's rows can't be shared among
    tasks; the work per text costs much more than moving it."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(max(DEALT * cores, tasks_of(df)))


def prepare(
    train: DataFrame,
    test: DataFrame,
    label: str = "sentiment_label",
    features: TextFeatures = SENTIMENT,
    keep: Sequence[str] = ("review_id",),
) -> TrainingSet:
    """Fit the features on ``train`` once and write both vector tables once, in even parts; every estimator below
    reads them."""
    train, test = dealt(train), dealt(test)
    # Only the text reaches the features, never the rating that a label may come from.
    vectorizer = Vectorizer.fit(train.select(*feature_columns(train)), features)
    weights, rows = balanced_weights(train, label)
    classes = list(weights)
    train_vectors = vectorizer.transform(with_class_weight(train, weights, label))
    train_vectors = train_vectors.select(*keep, encode(train, label, classes).alias("label"), "features", "class_weight")
    test_vectors = vectorizer.transform(test).select(*keep, "clean_text", F.col(label).alias("true_label"), "features")
    return TrainingSet(materialise(train_vectors), materialise(test_vectors), classes, rows, len(vectorizer.terms))


def logistic(rows: int, iterations: int = settings.ITERATIONS):
    """The penalty is given per summed loss elsewhere; Spark averages the loss, hence 1/rows."""
    return LogisticRegression(
        family="multinomial", weightCol="class_weight", standardization=False, regParam=1.0 / rows,
        maxIter=iterations, tol=1e-4,
    )


def svm_problem(data: TrainingSet) -> linear.Problem:
    """One squared hinge per class against the rest, all on the same rows; penalty half the squared norm of the weights,
    intercept included, losses summed with the balanced weights."""
    sides = [F.when(F.col("label") == i, 1.0).otherwise(-1.0).alias(f"side_{i}") for i in range(len(data.classes))]
    rows = as_rows(data.train, ("label", "class_weight")).select("*", *sides)
    sides = tuple(f"side_{i}" for i in range(len(data.classes)))
    return linear.Problem(rows, sides, ("class_weight",) * len(sides), data.width, free_intercept=False)


def svm_predictions(data: TrainingSet, model: linear.Linear) -> DataFrame:
    """Test rows with ``predicted_label``: the class with the largest margin."""
    if not model.converged:
        warnings.warn(f"stopped after {model.passes} passes without converging", stacklevel=2)
    rows = as_rows(data.test, [c for c in data.test.columns if c != "features"])
    scored = linear.scored(rows, model)
    return scored.withColumn("predicted_label", decode(linear.largest(F.col("margins")), data.classes)).drop("margins")


def fit_forest(data: TrainingSet, trees: int = 40, depth: int = 30) -> forest.Forest:
    return forest.fit(data.train, len(data.classes), data.width, trees, depth, settings.SEED)


def forest_predictions(data: TrainingSet, model: forest.Forest) -> DataFrame:
    """Test rows with ``predicted_label``: the class with most votes, the first on ties."""
    rows = materialise(data.test.withColumn("_row", F.monotonically_increasing_id()))
    found = rows.drop("features").join(forest.voted(rows, model, "_row"), "_row")
    return found.withColumn("predicted_label", decode(linear.largest(F.col("votes")), data.classes)).drop("_row", "votes")


def fitted(data: TrainingSet, estimator):
    """The model on the training vectors.  A fit that used all its iterations without converging is reported as a
    warning."""
    model = estimator.setFeaturesCol("features").setLabelCol("label").fit(data.train)
    if isinstance(model, LogisticRegressionModel) and model.hasSummary and model.summary.totalIterations >= estimator.getMaxIter():
        warnings.warn(f"stopped after {estimator.getMaxIter()} iterations without converging", stacklevel=2)
    return model


def predicted(data: TrainingSet, model) -> DataFrame:
    """Test rows with ``predicted_label``."""
    return model.transform(data.test).withColumn("predicted_label", decode(F.col("prediction"), data.classes)).drop(
        "features", "rawPrediction", "probability", "prediction"
    )


def fit_predict(data: TrainingSet, estimator) -> DataFrame:
    return predicted(data, fitted(data, estimator))


FITTED: dict[str, Callable[[TrainingSet], DataFrame]] = {
    settings.LOGISTIC_NAME: lambda data: fit_predict(data, logistic(data.rows)),
    settings.SVM_NAME: lambda data: svm_predictions(data, linear.fit_squared_hinge(svm_problem(data))),
    settings.FOREST_NAME: lambda data: forest_predictions(data, fit_forest(data)),
}


def _weights(counted: DataFrame, idf: DataFrame, keep: tuple[str, ...], id_column: str) -> DataFrame:
    """Shuffling the reviews by id first puts all terms of a review in one place; the scaling and any
    sum per review then need no shuffle, and arrays of counts are smaller than their exploded rows."""
    return tfidf_weights(explode_counts(counted.repartition(id_column), *keep), idf, id_column)


def bayes_fit(
    train: DataFrame, label: str = "sentiment_label", features: TextFeatures = SENTIMENT, id_column: str = "review_id"
) -> tuple[naive_bayes.NaiveBayes, DataFrame]:
    """The model and the idf table of its training set, whose texts are tokenised once."""
    documents = row_count(train)
    keep = (id_column, label)
    counted = materialise(counted_terms(train, features, keep))
    vocab = materialise(prune(term_statistics(explode_counts(counted)), documents, features))
    idf = idf_table(vocab, documents)
    return naive_bayes.fit(train, _weights(counted, idf, keep, id_column), vocab, label), idf


def bayes_predict(
    model: naive_bayes.NaiveBayes,
    idf: DataFrame,
    test: DataFrame,
    features: TextFeatures = SENTIMENT,
    id_column: str = "review_id",
) -> DataFrame:
    weights = _weights(counted_terms(test, features, (id_column,)), idf, (id_column,), id_column)
    return naive_bayes.predict(model, test, weights, id_column)


def train_sentiment_baselines(
    train: DataFrame,
    test: DataFrame,
    info: SentimentInfo,
    models: Sequence[str] = tuple(settings.SENTIMENT_MODELS),
    label: str = "sentiment_label",
    features: TextFeatures = SENTIMENT,
) -> tuple[DataFrame, DataFrame | None]:
    """Metric rows and predictions of the chosen models, or ``not_run`` rows with the reason."""
    spark = train.sparkSession
    if not info.available:
        return sentiment_not_run(spark, info.reason, models), None
    train = train.dropna(subset=["clean_text", label])
    test = test.dropna(subset=["clean_text", label])
    if train.select(label).distinct().limit(2).count() < 2 or test.isEmpty():
        return sentiment_not_run(spark, FEW_CLASSES, models), None
    keep = [c for c in ("review_id", "review_text", "course_id") if c in test.columns]
    on_vectors = [name for name in models if name in FITTED]
    data = prepare(train, test, label, features, keep) if on_vectors else None

    def predict(name: str) -> DataFrame:
        if name == settings.BAYES_NAME:
            model, idf = bayes_fit(train, label, features)
            predicted = bayes_predict(model, idf, test, features).withColumn("true_label", F.col(label))
        else:
            predicted = FITTED[name](data)
        return predicted.select(F.lit(name).alias("model"), *keep, "clean_text", "true_label", "predicted_label")

    parts = in_parallel([partial(predict, name) for name in models], at_once=2)
    predictions = parts[0]
    for part in parts[1:]:
        predictions = predictions.unionByName(part)
    predictions = materialise(predictions)
    return sentiment_metrics(predictions), predictions


def train_on_vectors(
    df: DataFrame,
    cap: int | None = None,
    vector: str = "embedding",
    label: str = "label",
    hidden: Sequence[int] = (32,),
    epochs: int = 100,
    seed: int = settings.SEED,
) -> tuple[DataFrame, DataFrame]:
    """A small neural classifier on vectors that are already in the table.

    ``df`` has a ``split`` column; all its test rows are scored.  ``cap`` bounds the training rows per class (None:
    all), drawn with ``balanced_sample``.  Returns the result row and the test predictions.
    """
    started = time.perf_counter()
    usable = df.filter(F.col(vector).isNotNull() & F.col(label).isNotNull())
    found = usable.select(F.col(label).cast("string").alias("c")).distinct().orderBy("c").limit(MOST_CLASSES + 1).collect()
    classes = [r[0] for r in found]
    if not 2 <= len(classes) <= MOST_CLASSES:
        raise ValueError(f"{len(classes)} classes found; a classifier takes 2 to {MOST_CLASSES}")
    widths = usable.agg(F.min(F.size(vector)).alias("least"), F.max(F.size(vector)).alias("most")).first()
    if widths["least"] != widths["most"]:
        raise ValueError(f"vectors have {widths['least']} to {widths['most']} numbers")
    width = widths["most"]
    if cap is not None:
        drawn = balanced_sample(usable.filter("split = 'train'"), cap, label, "vec_id", (vector,))
        usable = usable.filter("split != 'train'").unionByName(drawn)
    data = materialise(
        usable.withColumn("_class", F.col(label).cast("string"))
        .withColumn("features", array_to_vector(F.col(vector)))
        .withColumn("label_number", encode(usable, "_class", classes))
        .select("vec_id", "split", "_class", "features", "label_number")
    )
    model = MultilayerPerceptronClassifier(
        layers=[width, *hidden, len(classes)], maxIter=epochs, seed=seed, labelCol="label_number", featuresCol="features"
    ).fit(data.filter("split = 'train'"))
    scored = model.transform(data.filter("split = 'test'"))
    predictions = scored.select(
        F.lit("dense vectors + multilayer perceptron").alias("model"),
        "vec_id",
        F.col("_class").alias("true_label"),
        decode(F.col("prediction"), classes).alias("predicted_label"),
    )
    sizes = {r["split"]: r["count"] for r in data.groupBy("split").count().collect()}
    metrics = sentiment_metrics(predictions).drop("notes")
    for name in ("train", "val", "test"):
        metrics = metrics.withColumn(f"{name}_rows", F.lit(sizes.get(name, 0)).cast("long"))
    return (
        metrics.withColumn("epochs", F.lit(epochs))
        .withColumn("runtime_seconds", F.lit(time.perf_counter() - started))
        .withColumn("notes", F.lit(f"training rows per class: {cap or 'all'}")),
        predictions,
    )
