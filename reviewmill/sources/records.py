"""Source records: the manifest, look-ups in it and its audit."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmill import settings

RECORD = (
    "name string, dataset_id string, source_platform string, source_url string, license string, "
    "license_status string, download_command string, download_datetime_utc string, local_dir string, "
    "files_downloaded array<string>, fields_used array<string>, known_limitations array<string>, status string"
)
_MANIFEST = f"created_at_utc string, records array<struct<{RECORD.replace(' string', ': string').replace(' array', ': array')}>>"


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the manifest, with its position."""
    try:
        manifest = spark.read.schema(_MANIFEST).json(path, multiLine=True)
    except AnalysisException as missing:
        raise FileNotFoundError(f"no source manifest at {path}") from missing
    return manifest.select(F.posexplode("records").alias("position", "r")).select("position", "r.*")


def record_by_id(records: DataFrame, dataset_id: str) -> DataFrame:
    return records.filter(F.col("dataset_id") == dataset_id)


def record_files(records: DataFrame) -> DataFrame:
    """(dataset_id, file, file_name): one row per registered file, name in lower case."""
    name = F.lower(F.element_at(F.split("file", "/"), -1))
    return records.select("dataset_id", F.explode("files_downloaded").alias("file")).withColumn("file_name", name)


def preferred_file(records: DataFrame, dataset_id: str, names: list[str], existing: DataFrame) -> str | None:
    """The registered and existing file that comes first in ``names``; None if there is none.
    ``existing`` has a ``file`` column."""
    rank = F.array_position(F.array(*[F.lit(n.lower()) for n in names]), F.col("file_name"))
    best = (
        record_files(record_by_id(records, dataset_id))
        .filter(rank > 0)
        .join(existing.select("file").distinct(), "file", "left_semi")
        .orderBy(rank, "file")
        .select("file")
        .first()
    )
    return best["file"] if best else None


def _is_missing(records: DataFrame, field: str) -> Column:
    value = F.col(field)
    if dict(records.dtypes)[field].startswith("array"):
        return value.isNull() | (F.size(value) == 0)
    return value.isNull() | (value == "")


def audit_records(records: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """(dataset_id, severity, problem, detail): required fields that are empty, registered files and folders
    (``local_dir``) that do not exist, licences that are not stated, a manifest without records.

    ``existing`` has a ``file`` column; the check is a shuffled anti-join, so neither the registered
    files nor the listing has to fit anywhere.
    """
    fields = F.array(
        *[F.when(_is_missing(records, f), F.lit(f)) for f in settings.REQUIRED_SOURCE_FIELDS]
    )
    missing = records.select("dataset_id", F.explode(F.array_compact(fields)).alias("detail")).select(
        "dataset_id", F.lit("failure").alias("severity"), F.lit("missing_field").alias("problem"), "detail"
    )
    unlicensed = records.filter(F.contains(F.lower(F.coalesce("license", F.lit(""))), F.lit("not specified"))).select(
        "dataset_id",
        F.lit("warning").alias("severity"),
        F.lit("license_not_specified").alias("problem"),
        F.col("license").alias("detail"),
    )
    found = missing.unionByName(unlicensed).unionByName(
        records.agg(F.count("*").alias("n")).filter("n = 0").select(
            F.lit(None).cast("string").alias("dataset_id"), F.lit("failure").alias("severity"),
            F.lit("empty_manifest").alias("problem"), F.lit("no record").alias("detail"),
        )
    )
    if existing is None:
        return found
    if "local_dir" in records.columns:
        parts = F.split("file", "/")
        above = F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda n: F.array_join(F.slice(parts, 1, n), "/"))
        folders = existing.filter(F.contains("file", F.lit("/"))).select(F.explode(above).alias("folder")).distinct()
        found = found.unionByName(
            records.filter(F.col("local_dir") != "")
            .withColumn("folder", F.regexp_replace("local_dir", "^(\\./)+|/+$", ""))
            .join(folders, "folder", "left_anti")
            .select("dataset_id", F.lit("failure").alias("severity"), F.lit("missing_folder").alias("problem"), F.col("local_dir").alias("detail"))
        )
    gone = (
        record_files(records)
        .join(existing.select("file"), "file", "left_anti")
        .select(
            "dataset_id",
            F.lit("failure").alias("severity"),
            F.lit("missing_file").alias("problem"),
            F.col("file").alias("detail"),
        )
    )
    return found.unionByName(gone)
