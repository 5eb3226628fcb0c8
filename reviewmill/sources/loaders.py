"""The three review data sets: main (explicit labels), weak (ratings) and auxiliary (flags).

Data set ids are arguments: a caller names the records of the manifest.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmill import settings
from reviewmill.functions.numbers import to_number, whole_number_text
from reviewmill.operators.labeling import add_labels
from reviewmill.sources.files import listed_files, read_delimited
from reviewmill.sources.normalize import first_existing, flag_columns, normalize_reviews, union_reviews
from reviewmill.sources.records import preferred_file, read_records, record_by_id, record_files

EMPTY = (
    "review_text string, label_raw string, source_dataset string, source_platform string, "
    "source_file string, course_id string, review_id string, source_row_id long, label_5class string, sentiment_label string, "
    "label_source string"
)


@dataclass(frozen=True)
class DatasetIds:
    main: str
    weak: str
    auxiliary: str


def _lineage(dataset_id: str, platform: str, file: str) -> list[Column]:
    return [
        F.lit(dataset_id).alias("source_dataset"),
        F.lit(platform).alias("source_platform"),
        F.lit(file).alias("source_file"),
    ]


def _row_ids(raw: DataFrame, id_column: str | None = None) -> list[Column]:
    """The id as it is written; a row without one is known by its number in the file, which also keeps its order."""
    number = F.col("source_row_id").cast("long")
    by_number = F.concat(F.lit("row "), number.cast("string"))
    own = F.col(id_column).cast("string") if id_column in raw.columns else F.lit(None).cast("string")
    return [F.coalesce(own, by_number).alias("review_id"), number.alias("source_row_id")]


def shape_main(raw: DataFrame, dataset_id: str, file: str, platform: str = "Kaggle") -> DataFrame:
    text = first_existing(raw.columns, ["Review", "review"])
    label = first_existing(raw.columns, ["Label", "label"])
    if text is None or label is None:
        raise ValueError(f"{file} lacks a review or a label column")
    course = first_existing(raw.columns, ["CourseId", "course_id", "course"])
    columns = [
        F.col(f"`{text}`").alias("review_text"),
        whole_number_text(F.col(f"`{label}`")).alias("label_raw"),
        *_lineage(dataset_id, platform, file),
        (F.col(f"`{course}`") if course else F.lit(None)).cast("string").alias("course_id"),
        *_row_ids(raw, "Id"),
    ]
    return add_labels(raw.select(*columns), "label_raw", settings.MAIN_LABEL_SOURCE)


def shape_weak(raw: DataFrame, dataset_id: str, file: str, platform: str = "Kaggle") -> DataFrame:
    missing = sorted({"reviews", "rating", "course_id"} - set(raw.columns))
    if missing:
        raise ValueError(f"{file} lacks {missing}")
    columns = [
        F.col("reviews").alias("review_text"),
        whole_number_text(F.col("rating")).alias("label_raw"),
        to_number(F.col("rating")).alias("rating"),
        F.col("course_id").cast("string").alias("course_id"),
        (F.col("date_reviews") if "date_reviews" in raw.columns else F.lit(None)).cast("string").alias("review_date"),
        *_lineage(dataset_id, platform, file),
        *_row_ids(raw),
    ]
    return add_labels(raw.select(*columns), "label_raw", settings.WEAK_LABEL_SOURCE)


def shape_auxiliary(
    raw: DataFrame, dataset_id: str, file: str, platform: str = "Hugging Face", flags=tuple(settings.FEEDBACK_FLAGS)
) -> DataFrame | None:
    """None for a file without a review column."""
    if "review" not in raw.columns:
        return None
    return raw.select(
        F.col("review").alias("review_text"),
        *_lineage(dataset_id, platform, file),
        F.col("source_row_id").cast("long").alias("review_id"),
        *flag_columns(raw, flags),
    )


def existing_files(spark: SparkSession, base: str) -> DataFrame:
    """(file): files below ``base``, relative to it."""
    root = base.rstrip("/") + "/"
    return listed_files(spark, base).select(F.substring_index("path", root, -1).alias("file"))


def load_main(spark: SparkSession, records: DataFrame, base: str, dataset_id: str, in_ranges: bool = False) -> DataFrame:
    file = preferred_file(records, dataset_id, settings.MAIN_FILES, existing_files(spark, base))
    if file is None:
        return spark.createDataFrame([], EMPTY)
    return shape_main(read_delimited(spark, f"{base}/{file}", in_ranges=in_ranges), dataset_id, file)


def load_weak(spark: SparkSession, records: DataFrame, base: str, dataset_id: str, in_ranges: bool = False) -> DataFrame:
    file = preferred_file(records, dataset_id, [settings.WEAK_FILE], existing_files(spark, base))
    if file is None:
        return spark.createDataFrame([], EMPTY)
    return shape_weak(read_delimited(spark, f"{base}/{file}", in_ranges=in_ranges), dataset_id, file)


def load_auxiliary(spark: SparkSession, records: DataFrame, base: str, dataset_id: str, in_ranges: bool = False) -> DataFrame:
    files = (
        record_files(record_by_id(records, dataset_id))
        .filter(F.endswith("file_name", F.lit(".csv")))
        .join(existing_files(spark, base), "file", "left_semi")
        .orderBy("file")
        .collect()  # file names of one manifest record
    )
    shaped = [shape_auxiliary(read_delimited(spark, f"{base}/{r.file}", in_ranges=in_ranges), dataset_id, r.file) for r in files]
    tables = [t for t in shaped if t is not None]
    return union_reviews(tables) if tables else spark.createDataFrame([], EMPTY)


def load_experiment_datasets(
    spark: SparkSession, manifest: str, base: str, ids: DatasetIds, in_ranges: bool = False
) -> tuple[dict[str, DataFrame], DataFrame]:
    """``in_ranges``: see ``files.read_delimited``."""
    records = read_records(spark, manifest)
    return {
        "main": load_main(spark, records, base, ids.main, in_ranges),
        "weak": load_weak(spark, records, base, ids.weak, in_ranges),
        "auxiliary": load_auxiliary(spark, records, base, ids.auxiliary, in_ranges),
    }, records


def load_public_reviews(spark: SparkSession, manifest: str, base: str, in_ranges: bool = False) -> DataFrame:
    """Every registered CSV file, normalised and stacked."""
    files = (
        read_records(spark, manifest)
        .select("position", "dataset_id", "source_platform", F.posexplode("files_downloaded").alias("n", "file"))
        .filter(F.endswith(F.lower("file"), F.lit(".csv")))
        .orderBy("position", "n")
        .collect()  # file names of one manifest
    )
    if not files:
        raise ValueError("the manifest registers no CSV file")
    return union_reviews(
        [
            normalize_reviews(
                read_delimited(spark, f"{base}/{f.file}", in_ranges=in_ranges), f.dataset_id or "unknown", f.source_platform or "unknown", f.file
            )
            for f in files
        ]
    )
