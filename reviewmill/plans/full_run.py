"""The whole study: load, clean, split, train, mine topics, ablate, explain errors, write tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmill import settings
from reviewmill.operators import classifiers, cleaning, errors, guards, metrics, multilabel, sampling, summaries, topics
from reviewmill.operators.labeling import SentimentInfo
from reviewmill.plans.ablation import run_main_ablation
from reviewmill.session import materialise, stored_steps
from reviewmill.sources.files import read_table, write_table
from reviewmill.sources.loaders import DatasetIds, existing_files, load_experiment_datasets
from reviewmill.sources.normalize import union_reviews
from reviewmill.sources.records import audit_records

MAIN_INFO = SentimentInfo(
    True,
    "kaggle_100k_label",
    "Kaggle 100K Label field mapped to 5-class and 3-class sentiment targets.",
)


@dataclass(frozen=True)
class Study:
    """Where the sources are, where the tables go and how much is sampled."""

    manifest: str
    base: str
    output: str
    ids: DatasetIds
    mode: str = "full"  # "quick" works on a sample and must be asked for
    models: tuple[str, ...] = tuple(settings.SENTIMENT_MODELS)
    file_format: str = "parquet"
    in_ranges: bool = False  # large, well-formed delimited files: many tasks read each
    fit_rows: int | None = None  # bound on the rows the ablation fits are trained on; none by default

    def write(self, df: DataFrame, name: str, *partition_by: str) -> None:
        write_table(df, f"{self.output.rstrip('/')}/{name}", partition_by, self.file_format)

    def read(self, spark: SparkSession, name: str, like: DataFrame) -> DataFrame:
        return read_table(spark, f"{self.output.rstrip('/')}/{name}", like, self.file_format)


def _label_info(ids: DatasetIds, weak_present: bool) -> list[tuple]:
    return [
        (ids.main, MAIN_INFO.source, True),
        (ids.weak, "rating" if weak_present else "none", weak_present),
        (ids.auxiliary, "none", False),
    ]


def run(spark: SparkSession, study: Study) -> dict[str, DataFrame]:
    """Write every result table below ``study.output`` and return them as written.  The steps stored on the way are
    deleted when the run ends."""
    with stored_steps(spark):
        results = _run(spark, study)
        for name, table in results.items():
            study.write(table, name)
    return {name: study.read(spark, name, table) for name, table in results.items()}


def _run(spark: SparkSession, study: Study) -> dict[str, DataFrame]:
    datasets, records = load_experiment_datasets(spark, study.manifest, study.base, study.ids, study.in_ranges)
    audit = audit_records(records, existing_files(spark, study.base))
    failures = audit.filter("severity = 'failure'").limit(5).collect()
    if failures:
        raise ValueError(f"source records are incomplete, for example {[(f.dataset_id, f.problem, f.detail) for f in failures]}")

    # Delimited files are read once; everything goes on with the stored copy.
    main_raw, weak_raw, aux_raw = (materialise(datasets[k]) for k in ("main", "weak", "auxiliary"))
    if main_raw.isEmpty():
        raise ValueError("the main data set is not available")
    has_weak, has_aux = not weak_raw.isEmpty(), not aux_raw.isEmpty()

    in_file = ["source_file", "source_row_id"]
    main = materialise(cleaning.preprocess(sampling.sample_for_mode(main_raw, study.mode), in_file))
    weak = materialise(cleaning.preprocess(weak_raw, in_file)) if has_weak else None
    # Files are numbered one by one, so the order over all auxiliary files is (file, row).
    aux = materialise(cleaning.preprocess(aux_raw, ["source_file", "review_id"])) if has_aux else None
    study.write(main, "cleaned_feedback")

    results: dict[str, DataFrame] = {}
    raw_parts = [df.select("source_dataset") for df in (main_raw, weak_raw, aux_raw)]
    kept_parts = [df.select("source_dataset") for df in (main, weak, aux) if df is not None]
    info = spark.createDataFrame(
        _label_info(study.ids, has_weak), "dataset_id string, sentiment_source string, sentiment_available boolean"
    )
    results["data_summary"] = summaries.data_summary(
        records,
        summaries.rows_by_source(union_reviews(raw_parts)),
        summaries.rows_by_source(union_reviews(kept_parts)),
        info,
        study.mode,
    )
    results["label_distribution"] = summaries.label_distribution(main, MAIN_INFO.source)
    results["course_sentiment"] = summaries.course_sentiment(main)

    stratify = sampling.choose_stratify_column(main, MAIN_INFO.available)
    split = materialise(sampling.split_rows(main, stratify))
    study.write(split, "splits", "split")
    holdout = sampling.course_holdout(main)
    if holdout is not None:
        study.write(holdout, "course_holdout", "split")

    scores, predictions = classifiers.train_sentiment_baselines(
        split.filter("split = 'train'"), split.filter("split = 'test'"), MAIN_INFO, study.models
    )
    results["classical_baseline_results"] = scores
    if predictions is not None:
        results["sentiment_predictions"] = predictions
        results["best_model_confusion"] = metrics.best_model_confusion(predictions)

    # The main set rarely carries feedback flags; without them this is one row that says so.
    own_flags = multilabel.train_multilabel(split.filter("split = 'train'"), split.filter("split = 'test'"))
    results["multilabel_results"] = own_flags.results
    if own_flags.predictions is not None:
        results["multilabel_predictions"] = own_flags.predictions
        results["multilabel_label_report"] = own_flags.label_report

    found = topics.fit_topics(main, settings.TOPIC_COUNT[study.mode])
    if found is None:
        results["topic_summary"] = topics.too_few_documents(main, main.count())
    else:
        documents = materialise(found.documents)
        results["topic_summary"] = topics.topic_summary(documents, found.keywords, found.count)
        results["document_topics"] = topics.document_topics(documents)
        results["topic_sentiment_distribution"] = topics.topic_sentiment(documents)
        results["topic_sentiment_pivot"] = topics.topic_sentiment_pivot(documents)
        results["teaching_improvement_matrix"] = topics.improvement_matrix(documents, found.keywords, found.count)

    results["ablation_results"] = run_main_ablation(main, weak, study.fit_rows)

    flag_predictions = None
    if aux is None:
        results["auxiliary_multilabel_results"] = guards.multilabel_not_run(
            spark, "HF auxiliary dataset was not available."
        )
    else:
        keyed = aux.withColumn("review_id", F.concat_ws("#", "source_file", "review_id"))
        column = "not_praise" if "not_praise" in keyed.columns else None
        aux_split = materialise(sampling.split_rows(keyed, column))
        flags = multilabel.train_multilabel(aux_split.filter("split = 'train'"), aux_split.filter("split = 'test'"))
        results["auxiliary_multilabel_results"] = flags.results
        if flags.predictions is not None:
            flag_predictions = flags.predictions
            results["auxiliary_multilabel_predictions"] = flags.predictions
            results["auxiliary_multilabel_label_report"] = flags.label_report
            results["multilabel_label_distribution"] = summaries.flag_distribution(aux, settings.FEEDBACK_FLAGS)

    results["model_comparison"] = metrics.model_comparison(scores, results["multilabel_results"])
    results["error_cases"] = errors.error_cases(predictions, flag_predictions)
    return results
