"""The registered queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmill import settings
from reviewmill.functions.numbers import to_flag, to_number
from reviewmill.functions.text import masked_text
from reviewmill.operators import (
    classifiers,
    cleaning,
    errors,
    features,
    guards,
    labeling,
    linear,
    metrics,
    multilabel,
    sampling,
    summaries,
    topics,
)
from reviewmill.plans import ablation
from reviewmill.queries import tables as t
from reviewmill.session import materialise
from reviewmill.sources import normalize, records

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
BALANCED_CAP = 120
UNIGRAMS = features.TextFeatures(ngrams=(1, 1))
BIGRAMS = features.TextFeatures(ngrams=(2, 2))


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


# --- sources ---------------------------------------------------------------------------------


@query
def normalize_reviews(spark, sf_dir):
    raw = t.reviews(spark, sf_dir).select(
        F.col("review_id").alias("row"),
        F.col("review_text").alias("Review"),
        F.col("course_id").alias("CourseId"),
        F.col("label_raw").alias("Label"),
        F.when(F.col("rating") == 1.5, "n/a").otherwise(F.col("rating").cast("string")).alias("Stars"),
        F.col("f_toxic").cast("string").alias("f_toxic"),
    )
    return normalize.normalize_reviews(raw, "documents", "given table", "documents.parquet", "row", t.FLAGS)


@query
def label_or_rating(spark, sf_dir):
    """Per course: would its label column be read as ratings?"""
    share = normalize.numeric_share(F.col("label_raw"))
    by_course = t.reviews(spark, sf_dir).groupBy("course_id").agg(share.alias("share"))
    kind = F.when(F.col("share") > settings.NUMERIC_LABEL_SHARE, "rating").otherwise("explicit_label")
    return by_course.select("course_id", F.round("share", 6).alias("numeric_share"), kind.alias("read_as"))


@query
def multilabel_coerce(spark, sf_dir):
    raw = t.reviews(spark, sf_dir)
    as_text = {
        "f_quality": F.when(F.col("rating") == 1.0, "x").otherwise(F.concat(F.col("f_quality").cast("string"), F.lit(".0"))),
        "f_toxic": F.when(F.col("rating") != 2.0, F.col("f_toxic").cast("string")),
        "f_long": F.concat(F.lit(" "), F.col("f_long").cast("string")),
    }
    return raw.select("review_id", *[to_flag(column).alias(name) for name, column in as_text.items()])


@query
def union_sources(spark, sf_dir):
    return normalize.union_reviews(t.all_sources(spark, sf_dir))


@query
def weak_label_reviews(spark, sf_dir):
    turn = F.col("turn")
    rating = (
        F.when(turn % 6 == 0, "bad").when(turn % 6 == 5, "3.5").when(turn % 2 == 0, F.concat((turn % 6).cast("string"), F.lit(".0")))
    ).otherwise((turn % 6).cast("string"))
    source = t.table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", F.col("text").alias("review_text"), rating.alias("label_raw"), to_number(rating).alias("rating"),
        F.col("conv_id").cast("string").alias("course_id"),
    )
    return labeling.add_labels(source, "label_raw", settings.WEAK_LABEL_SOURCE)


@query
def source_audit(spark, sf_dir):
    return records.audit_records(t.page_records(spark, sf_dir), t.document_files(spark, sf_dir))


# --- cleaning --------------------------------------------------------------------------------


def _contact_texts(spark, sf_dir):
    """Document texts, whole pages, and one sentence per page that introduces its reader and names its address."""
    documents = t.reviews(spark, sf_dir).select(
        F.lit("documents").alias("source_dataset"), F.col("review_id").alias("row_id"), "review_text"
    )
    sentence = F.concat(
        F.lit("my name is Reader Nr"), F.col("page_id").cast("string"), F.lit(", i am  Reader Two. See "), F.col("url"), F.lit(".")
    )
    pages = t.dealt(t.table(spark, sf_dir, "pages"))
    whole, introductions = (
        pages.select(F.lit(name).alias("source_dataset"), F.col("page_id").alias("row_id"), text.alias("review_text"))
        for name, text in (("pages", F.col("html")), ("page readers", sentence))
    )
    return documents.unionByName(whole).unionByName(introductions)


@query
def mask_pii(spark, sf_dir):
    return _contact_texts(spark, sf_dir).select(
        "source_dataset", "row_id", masked_text(F.col("review_text")).alias("masked_text")
    )


@query
def mask_counts(spark, sf_dir):
    return cleaning.mask_counts(_contact_texts(spark, sf_dir), ["source_dataset"])


@query
def clean_dedupe(spark, sf_dir):
    return cleaning.preprocess(t.reviews(spark, sf_dir)).select("review_id", "clean_text", "course_id", "label_raw")


@query
def removed_rows(spark, sf_dir):
    return cleaning.removed_rows(normalize.union_reviews(t.all_sources(spark, sf_dir)), ["source_dataset"])


# --- labels ----------------------------------------------------------------------------------


@query
def label_5class_3class(spark, sf_dir):
    return t.labelled(spark, sf_dir).select("review_id", "label_raw", "label_5class", "sentiment_label", "label_source")


@query
def rating_thresholds(spark, sf_dir):
    return labeling.label_by_rating(t.reviews(spark, sf_dir)).select("review_id", "rating", "sentiment_label")


@query
def label_precedence(spark, sf_dir):
    """The same table with labels, with ratings only, and with neither."""
    base = t.reviews(spark, sf_dir).select("review_id", F.col("label_raw").alias("explicit_label"), "rating")
    variants = {"both": base, "rating only": base.drop("explicit_label"), "neither": base.select("review_id")}
    result = None
    for name, variant in variants.items():
        table, info = labeling.construct_sentiment_labels(variant)
        label = F.col("sentiment_label") if info.available else F.lit(None).cast("string")
        part = table.select(
            F.lit(name).alias("variant"), "review_id", label.alias("sentiment_label"), F.lit(info.source).alias("sentiment_source")
        )
        result = part if result is None else result.unionByName(part)
    return result


@query
def label_distribution(spark, sf_dir):
    return summaries.label_distribution(t.labelled(spark, sf_dir), settings.MAIN_LABEL_SOURCE)


@query
def multilabel_distribution(spark, sf_dir):
    return summaries.flag_distribution(t.reviews(spark, sf_dir), t.FLAGS)


# --- sampling --------------------------------------------------------------------------------


@query
def sample_fixed_n(spark, sf_dir):
    rows = normalize.union_reviews(t.all_sources(spark, sf_dir)).select("row_key", "source_dataset", "course_id")
    return sampling.sample_rows(rows, settings.QUICK_SAMPLE_ROWS, "row_key")


@query
def stratified_split(spark, sf_dir):
    rows = t.labelled(spark, sf_dir).select("review_id", "sentiment_label")
    return sampling.split_rows(rows, "sentiment_label")


@query
def split_sizes(spark, sf_dir):
    rows = t.labelled(spark, sf_dir).select("review_id", "label_5class")
    return sampling.split_sizes(sampling.split_rows(rows, "label_5class"), "label_5class")


@query
def stratify_guard(spark, sf_dir):
    rows = t.reviews(spark, sf_dir)
    checks = None
    for column in ("label_raw", "course_id", "f_toxic", "review_id"):
        check = sampling.stratify_check(rows, column).select(F.lit(column).alias("column"), "classes", "smallest", "usable")
        checks = check if checks is None else checks.unionByName(check)
    return checks


@query
def course_holdout(spark, sf_dir):
    rows = t.reviews(spark, sf_dir).select("review_id", "course_id")
    return sampling.course_holdout(rows)


@query
def balanced_sample(spark, sf_dir):
    rows = t.labelled(spark, sf_dir).select("review_id", "sentiment_label", "review_text")
    return sampling.balanced_sample(rows, BALANCED_CAP, required=("review_text",)).select("review_id", "sentiment_label")


# --- features --------------------------------------------------------------------------------


@query
def token_counts(spark, sf_dir):
    return features.corpus_statistics(t.cleaned_texts(spark, sf_dir), UNIGRAMS)


@query
def bigram_counts(spark, sf_dir):
    return features.corpus_statistics(t.cleaned_texts(spark, sf_dir), BIGRAMS)


@query
def vocabulary_topk(spark, sf_dir):
    return features.vocabulary(t.cleaned_texts(spark, sf_dir), features.SENTIMENT)


@query
def doc_term_counts(spark, sf_dir):
    """Unigram counts restricted to the topic vocabulary."""
    texts = t.cleaned_texts(spark, sf_dir)
    vocab = features.vocabulary(texts, features.TOPICS).select("term")
    return features.document_terms(texts, features.TOPICS).join(vocab, "term", "left_semi").select(
        "review_id", "term", "tf"
    )


@query
def tfidf_weights(spark, sf_dir):
    texts = materialise(t.cleaned_texts(spark, sf_dir))
    documents = features.row_count(texts)
    # Tokenised once: the vocabulary and the weights read the stored counts.
    counts = materialise(features.document_terms(texts))
    vocab = features.prune(features.term_statistics(counts), documents, features.SENTIMENT)
    weights = features.tfidf_weights(counts, features.idf_table(vocab, documents))
    return rounded(weights.select("review_id", "term", "weight"), "weight")


@query
def strip_accents_terms(spark, sf_dir):
    plain = features.TextFeatures(ngrams=(1, 1), accents=False)
    return features.corpus_statistics(t.cleaned_texts(spark, sf_dir), plain)


@query
def class_weights(spark, sf_dir):
    return rounded(features.class_weights(t.labelled(spark, sf_dir)), "class_weight")


# --- models ----------------------------------------------------------------------------------


def _experiment_split(spark, sf_dir, stratify="sentiment_label"):
    return materialise(sampling.split_rows(t.experiment(spark, sf_dir), stratify))


def _flag_split(spark, sf_dir):
    """Every review has flags, with or without a label; each text once."""
    split = sampling.split_rows(materialise(cleaning.preprocess(t.reviews(spark, sf_dir))), "f_not_english")
    return materialise(split.select("review_id", "clean_text", *t.FLAGS, "split"))


def _train_test(spark, sf_dir):
    split = _experiment_split(spark, sf_dir)
    return split.filter("split = 'train'"), split.filter("split = 'test'")


@query
def naive_bayes_model(spark, sf_dir):
    train, _ = _train_test(spark, sf_dir)
    model, _ = classifiers.bayes_fit(train)
    prior = F.create_map(*[F.lit(x) for pair in zip(model.labels, model.log_prior) for x in pair])
    return rounded(model.terms.withColumn("log_prior", F.element_at(prior, F.col("label"))), "log_theta", "log_prior")


@query
def naive_bayes_predict(spark, sf_dir):
    train, test = _train_test(spark, sf_dir)
    model, idf = classifiers.bayes_fit(train)
    scored = classifiers.bayes_predict(model, idf, test)
    return rounded(scored.select("review_id", F.col("sentiment_label").alias("true_label"), "predicted_label", "score"), "score")


@query
def multilabel_majority(spark, sf_dir):
    split = materialise(sampling.split_rows(t.reviews(spark, sf_dir).select("review_id", *t.FLAGS), "f_not_english"))
    return multilabel.predict_majority(split.filter("split = 'train'"), split.filter("split = 'test'"), t.FLAGS).drop("split")


@query
def label_set_strings(spark, sf_dir):
    return t.flag_predictions(spark, sf_dir).select(
        "review_id",
        multilabel.label_set(t.FLAGS, "true_").alias("true_labels"),
        multilabel.label_set(t.FLAGS, "pred_").alias("predicted_labels"),
    )


@query
def run_guard(spark, sf_dir):
    split = sampling.split_rows(t.labelled(spark, sf_dir).select("review_id", "course_id", "lang", "sentiment_label", "review_text"))
    return guards.run_guard(split, ["course_id", "lang"], text="review_text")


def _facts(result, split, predictions, label):
    """What is exact about a fit, for the comparison: rows per split, classes, and whether its macro F1 beats a
    constant guess."""
    sizes = split.filter(F.col(label).isNotNull()).agg(
        F.count_if(F.col("split") == "train").alias("train_rows"),
        F.count_if(F.col("split") == "test").alias("test_rows"),
        F.count_distinct(label).alias("classes"),
    )
    found = predictions.groupBy("true_label").count().agg(F.max("count"), F.sum("count"), F.count("*")).first()
    most, scored, classes = found
    constant = 2 * most / (most + scored) / classes  # macro F1 of always guessing the most frequent class
    return sizes.select(
        F.lit(result["model"]).alias("model"), F.lit(result["status"]).alias("status"), "train_rows", "test_rows", "classes",
        F.lit(scored).cast("long").alias("scored_rows"), F.lit(result["macro_f1"] > constant).alias("beats_majority"),
    )


def _at_optimum(problem, model, slope):
    """Whether the fit is where its loss with its penalty is least, told from the stored weights and column expressions:
    along the weights, the slopes of the losses and the penalty cancel out, and so they do along the intercept.  ``slope``:
    derivative of the loss at y * margin.  A wrong penalty, loss or row weight fails this."""
    scored = linear.scored(problem.chosen(), model)
    sums = []
    for i, (target, weight) in enumerate(zip(problem.targets, problem.weights)):
        margin, y = F.get("margins", i), F.col(target)
        pull = F.col(weight) * slope(y * margin) * y
        sums += [F.sum(pull * (margin - float(model.weights[-1, i]))).alias(f"along_{i}"), F.sum(pull).alias(f"level_{i}")]
    found = scored.agg(*sums).first()
    gaps = []
    for i in range(len(problem.targets)):
        intercept = model.weights[-1, i]
        norm = float((model.weights[:-1, i] ** 2).sum())
        gaps += [abs(found[f"along_{i}"] + norm) / norm, abs(found[f"level_{i}"] + (0 if problem.free_intercept else intercept)) / norm]
    return max(gaps) < 0.02


def _softmax_at_optimum(data, model):
    """The same for one softmax over all classes."""
    scored = model.transform(data.train).select(
        "label", "class_weight", vector_to_array("rawPrediction").alias("z"), vector_to_array("probability").alias("p")
    )
    intercepts, norm = model.interceptVector.toArray(), float((model.coefficientMatrix.toArray() ** 2).sum())
    pulls = [F.col("class_weight") * (F.get("p", k) - (F.col("label") == k).cast("double")) for k in range(len(intercepts))]
    along = sum((pull * (F.get("z", k) - float(intercepts[k])) for k, pull in enumerate(pulls)), F.lit(0.0))
    found = scored.agg(F.sum(along).alias("along"), *[F.sum(pull).alias(f"level_{k}") for k, pull in enumerate(pulls)]).first()
    return max(abs(found["along"] + norm), *[abs(found[f"level_{k}"]) for k in range(len(pulls))]) / norm < 0.02


def _flag_facts(result, split, in_training):
    """Rows, and per flag its positives among the scored rows; whether any flag was found, and whether the fit is the
    optimum of its loss."""
    best = _at_optimum(result.problem, result.model, lambda z: -1 / (1 + F.exp(z)))
    sizes = split.agg(F.count_if(F.col("split").isin(in_training)).alias("train_rows"), F.count_if(F.col("split") == "test").alias("test_rows"))
    found = result.label_report.select("label", F.col("support").cast("long").alias("support"), F.lit(result.results.first()["micro_f1"] > 0).alias("any_found"))
    return found.join(sizes).withColumn("at_optimum", F.lit(best))


def _baseline(spark, sf_dir, model):
    train, test = _train_test(spark, sf_dir)
    scores, predictions = classifiers.train_sentiment_baselines(train, test, labeling.FROM_LABEL, [model])
    return _facts(scores.first(), train.unionByName(test), predictions, "sentiment_label")


@query
def train_logreg(spark, sf_dir):
    train, test = _train_test(spark, sf_dir)
    data = classifiers.prepare(train, test)
    model = classifiers.fitted(data, classifiers.logistic(data.rows))
    predictions = materialise(classifiers.predicted(data, model).withColumn("model", F.lit(settings.LOGISTIC_NAME)))
    facts = _facts(metrics.sentiment_metrics(predictions).first(), train.unionByName(test), predictions, "sentiment_label")
    return facts.withColumn("at_optimum", F.lit(_softmax_at_optimum(data, model)))


@query
def train_linear_svm(spark, sf_dir):
    train, test = _train_test(spark, sf_dir)
    data = classifiers.prepare(train, test)
    problem = classifiers.svm_problem(data)
    model = linear.fit_squared_hinge(problem)
    predictions = materialise(classifiers.svm_predictions(data, model).withColumn("model", F.lit(settings.SVM_NAME)))
    best = _at_optimum(problem, model, lambda z: -2 * F.greatest(1 - z, F.lit(0.0)))
    facts = _facts(metrics.sentiment_metrics(predictions).first(), train.unionByName(test), predictions, "sentiment_label")
    return facts.withColumn("at_optimum", F.lit(best))


@query
def train_random_forest(spark, sf_dir):
    return _baseline(spark, sf_dir, settings.FOREST_NAME)


@query
def train_multilabel_ovr(spark, sf_dir):
    split = _flag_split(spark, sf_dir)
    result = multilabel.train_multilabel(split.filter("split = 'train'"), split.filter("split = 'test'"), t.FLAGS)
    return _flag_facts(result, split, ["train"])


@query
def train_multilabel_variant(spark, sf_dir):
    split = _flag_split(spark, sf_dir)
    return _flag_facts(multilabel.train_multilabel_variant(split, "full", t.FLAGS), split, ["train", "val"])


@query
def train_embedding_classifier(spark, sf_dir):
    split = materialise(sampling.split_rows(t.table(spark, sf_dir, "embeddings"), "label", "vec_id"))
    result, predictions = classifiers.train_on_vectors(split)
    return _facts(result.first(), split, predictions, "label")


@query
def ablation_grid(spark, sf_dir):
    weak = materialise(cleaning.preprocess(weak_label_reviews(spark, sf_dir).withColumn("review_id", F.concat_ws("-", "conv_id", "turn"))))
    grid = ablation.run_main_ablation(t.experiment(spark, sf_dir), weak, topic_features=True)
    return grid.select("experiment", "status", "train_rows", "test_rows", F.col("macro_f1").between(0, 1).alias("scored"))


# --- metrics ---------------------------------------------------------------------------------


@query
def metrics_sentiment(spark, sf_dir):
    three = metrics.sentiment_metrics(t.predictions(spark, sf_dir)).withColumn("labels", F.lit("3class"))
    five = metrics.sentiment_metrics(t.predictions(spark, sf_dir, "label_5class")).withColumn("labels", F.lit("5class"))
    return rounded(three.unionByName(five), "accuracy", "precision_macro", "recall_macro", "macro_f1", "weighted_f1")


@query
def confusion_matrix(spark, sf_dir):
    return metrics.confusion_matrix(t.predictions(spark, sf_dir))


@query
def metrics_multilabel(spark, sf_dir):
    scores = metrics.multilabel_metrics(t.flag_predictions(spark, sf_dir), t.FLAGS)
    return rounded(scores, "micro_f1", "macro_f1", "hamming_loss", "subset_accuracy")


@query
def per_label_report(spark, sf_dir):
    report = metrics.per_label_report(t.flag_predictions(spark, sf_dir), t.FLAGS)
    return rounded(report, "precision", "recall", "f1_score")


@query
def best_model_confusion(spark, sf_dir):
    return metrics.best_model_confusion(t.predictions(spark, sf_dir))


@query
def model_comparison_long(spark, sf_dir):
    sentiment = metrics.sentiment_metrics(t.predictions(spark, sf_dir))
    flags = metrics.multilabel_metrics(t.flag_predictions(spark, sf_dir), t.FLAGS)
    return rounded(metrics.model_comparison(sentiment, flags), "value")


# --- topics ----------------------------------------------------------------------------------


def _topic_keywords(documents):
    counts = features.document_terms(documents, UNIGRAMS, ("topic_id",))
    weights = counts.groupBy("topic_id", "term").agg(F.sum("tf").alias("weight"))
    return topics.top_keywords(weights)


@query
def topic_keywords(spark, sf_dir):
    return _topic_keywords(t.topic_documents(spark, sf_dir))


@query
def topic_representative(spark, sf_dir):
    return topics.representatives(t.topic_documents(spark, sf_dir))


@query
def topic_summary(spark, sf_dir):
    documents = t.topic_documents(spark, sf_dir)
    # Nine topics are asked for and eight occur: the ninth row shows how an empty topic is kept.
    keywords = materialise(_topic_keywords(documents))
    return rounded(topics.topic_summary(documents, keywords, t.TOPICS + 1), "negative_ratio", "topic_diversity")


@query
def issue_action(spark, sf_dir):
    """The rules applied to every page and review text."""
    texts = t.reviews(spark, sf_dir).select(
        F.lit("documents").alias("source_dataset"), F.col("review_id").alias("row_id"), F.col("review_text").alias("text")
    ).unionByName(
        t.table(spark, sf_dir, "pages").select(
            F.lit("pages").alias("source_dataset"), F.col("page_id").alias("row_id"), F.col("html").alias("text")
        )
    )
    issue, action = topics.issue_action(F.col("text"))
    return texts.select("source_dataset", "row_id", issue.alias("issue"), action.alias("action"))


@query
def topic_diversity(spark, sf_dir):
    return rounded(topics.topic_diversity(_topic_keywords(t.topic_documents(spark, sf_dir))), "topic_diversity")


@query
def document_topics(spark, sf_dir):
    return topics.document_topics(t.topic_documents(spark, sf_dir))


@query
def topic_sentiment(spark, sf_dir):
    return topics.topic_sentiment(t.topic_documents(spark, sf_dir, text=False))


@query
def topic_sentiment_pivot(spark, sf_dir):
    return topics.topic_sentiment_pivot(t.topic_documents(spark, sf_dir, text=False))


@query
def improvement_matrix(spark, sf_dir):
    documents = t.topic_documents(spark, sf_dir)
    keywords = materialise(_topic_keywords(documents))
    return rounded(topics.improvement_matrix(documents, keywords, t.TOPICS), "negative_ratio")


@query
def lda_topics(spark, sf_dir):
    """All reviews, labelled or not.  Compared: topics, reviews, keywords, and every review in one topic."""
    texts = materialise(cleaning.preprocess(t.reviews(spark, sf_dir)))
    found = topics.fit_topics(texts)
    summary = topics.topic_summary(materialise(found.documents), found.keywords, found.count)
    return summary.agg(
        F.count("*").alias("topics"), F.sum("document_count").cast("long").alias("documents"),
        F.sum(F.size(F.split("keywords", ", "))).cast("long").alias("keywords"),
        F.bool_and((F.col("document_count") == 0) | (F.col("representative_comment") != "")).alias("all_represented"),
    )


# --- errors ----------------------------------------------------------------------------------


@query
def error_taxonomy(spark, sf_dir):
    five = t.predictions(spark, sf_dir, "label_5class").withColumnRenamed("review_text", "clean_text")
    three = t.predictions(spark, sf_dir).withColumnRenamed("review_text", "clean_text")
    return errors.sentiment_errors(three.unionByName(five)).select(
        "model", "review_id", "true_label", "predicted_label", "error_type"
    )


@query
def label_set_mismatch(spark, sf_dir):
    return errors.label_set_errors(label_set_strings(spark, sf_dir))


@query
def error_cases_topn(spark, sf_dir):
    sentiment = t.predictions(spark, sf_dir).withColumnRenamed("review_text", "clean_text")
    return errors.error_cases(sentiment, None)


@query
def error_type_counts(spark, sf_dir):
    five = t.predictions(spark, sf_dir, "label_5class").withColumnRenamed("review_text", "clean_text")
    return errors.error_type_counts(five)


# --- summaries -------------------------------------------------------------------------------


@query
def data_summary(spark, sf_dir):
    raw = normalize.union_reviews(t.all_sources(spark, sf_dir))
    # One pass over the raw rows gives the sources, their sizes and whether they have labels.
    found = materialise(summaries.rows_by_source(raw, (F.count("label_raw") > 0).alias("sentiment_available")))
    kept = summaries.rows_by_source(cleaning.preprocess(raw, ["row_key"]))
    stated = F.when(F.col("dataset_id") != "benchmark", F.concat(F.col("dataset_id"), F.lit(" licence")))
    records_table = found.select(
        "dataset_id", F.lit("given table").alias("source_platform"), stated.alias("license"), F.lit(None).cast("string").alias("license_status")
    )
    info = found.select("dataset_id", "sentiment_available").withColumn(
        "sentiment_source", F.when(F.col("sentiment_available"), "explicit_label").otherwise("none")
    )
    return summaries.data_summary(records_table, found, kept, info, "full")


@query
def course_sentiment_top40(spark, sf_dir):
    """Flagship: label, clean, deduplicate, then the largest course and sentiment groups."""
    return summaries.course_sentiment(cleaning.preprocess(t.labelled(spark, sf_dir)))
