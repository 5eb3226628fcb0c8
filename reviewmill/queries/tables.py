"""The given tables in the shape of the review data sets.

``documents`` with ``labels`` stands for the main set (``source`` is the course),
``conversations`` for the weak set, ``benchmark`` for a set without courses and ``pages`` for
source records.  Predictions and topics that no model made are derived from a hash of the id:
they check the arithmetic of the operators and say nothing about model quality.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmill import settings
from reviewmill.functions.text import clean_text
from reviewmill.operators.cleaning import preprocess
from reviewmill.operators.labeling import add_labels
from reviewmill.session import materialise

FLAGS = ["f_quality", "f_toxic", "f_not_english", "f_has_digit", "f_long"]
MODELS = {"stub p": "p", "stub q": "q"}
TOPICS = 8


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Parts that the given tables are dealt into before the text work; None leaves their own splits.  For a table in one
# small file on a machine with several cores; a large table has splits enough.
PARTS: int | None = None


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    return df.repartition(PARTS, *keys) if PARTS else df


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = dealt(table(spark, sf_dir, "documents"), "doc_id")
    labels = table(spark, sf_dir, "labels")
    toxic, quality = F.col("toxic") == 1, F.col("quality")
    raw_label = (
        F.when(toxic & (quality == 0), "1")
        .when(toxic, "2.0")
        .when(quality == 0, " 3 ")
        .when(quality.isNotNull() & (F.col("n_chars") % 2 == 0), "Positive")
        .when(quality.isNotNull(), "5")
    )
    return documents.join(labels, "doc_id", "left").select(
        F.col("doc_id").alias("review_id"),
        F.col("text").alias("review_text"),
        F.col("source").alias("course_id"),
        "lang",
        raw_label.alias("label_raw"),
        ((2 + F.col("n_chars") % 7).cast("double") / 2.0).alias("rating"),
        F.coalesce("quality", F.lit(0)).cast("int").alias("f_quality"),
        F.coalesce("toxic", F.lit(0)).cast("int").alias("f_toxic"),
        (F.col("lang") != "en").cast("int").alias("f_not_english"),
        F.col("text").rlike("[0-9]").cast("int").alias("f_has_digit"),
        (F.col("n_chars") > 1000).cast("int").alias("f_long"),
    )


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews with a known label."""
    return add_labels(reviews(spark, sf_dir), "label_raw", settings.MAIN_LABEL_SOURCE)


def cleaned_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(review_id, clean_text) of every review, copies included."""
    return reviews(spark, sf_dir).select("review_id", clean_text(F.col("review_text")).alias("clean_text"))


def experiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled, cleaned, each text once; stored, because training reads it many times."""
    return materialise(preprocess(labelled(spark, sf_dir)))


def hash_number(text: Column) -> Column:
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def salted(id_column: str, salt: str) -> Column:
    return hash_number(F.concat(F.col(id_column).cast("string"), F.lit(f":{salt}")))


def predictions(spark: SparkSession, sf_dir: str, label: str = "sentiment_label") -> DataFrame:
    """Two made-up models: right for hash digits below 7, otherwise a class picked by the hash."""
    classes = settings.THREE_CLASSES if label == "sentiment_label" else settings.FIVE_CLASSES
    names = F.array(*[F.lit(c) for c in classes])
    rows = labelled(spark, sf_dir)
    models = F.explode(F.array(*[F.struct(F.lit(m).alias("model"), salted("review_id", s).alias("h")) for m, s in MODELS.items()]))
    guess = F.when(F.col("m.h") % 10 < 7, F.col(label)).otherwise(
        F.get(names, (F.col("m.h") % len(classes)).cast("int"))
    )
    return rows.withColumn("m", models).select(
        "m.model",
        "review_id",
        "course_id",
        "review_text",
        F.col(label).alias("true_label"),
        guess.alias("predicted_label"),
    )


def flag_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One made-up model that flips a flag for two hash digits out of ten."""
    rows = reviews(spark, sf_dir)
    columns = []
    for flag in FLAGS:
        flip = salted("review_id", flag) % 10 < 2
        columns.append(F.col(flag).alias(f"true_{flag}"))
        columns.append(F.when(flip, 1 - F.col(flag)).otherwise(F.col(flag)).alias(f"pred_{flag}"))
    return rows.select(F.lit("stub flags").alias("model"), "review_id", *columns)


def topic_documents(spark: SparkSession, sf_dir: str, text: bool = True) -> DataFrame:
    """Every review with a made-up topic; most have no label."""
    rows = reviews(spark, sf_dir)
    key = F.regexp_replace(F.trim(F.col("label_raw")), r"\.0$", "")
    sentiment = (
        F.when(key.isin("1", "2"), "negative").when(key == "3", "neutral").when(key.isin("Positive", "5"), "positive")
    )
    columns = [
        "review_id",
        "course_id",
        sentiment.alias("sentiment_label"),
        (salted("review_id", "p") % TOPICS).cast("int").alias("topic_id"),
        ((salted("review_id", "w") % 1000) / 1000.0).alias("topic_weight"),
    ]
    if text:
        columns.append(clean_text(F.col("review_text")).alias("clean_text"))
    return rows.select(*columns)


def all_sources(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Three sources with different columns, each with a row key of its own."""
    documents = reviews(spark, sf_dir).select(
        F.lit("documents").alias("source_dataset"),
        F.concat(F.lit("d"), F.col("review_id").cast("string")).alias("row_key"),
        "review_text", "course_id", "label_raw", "rating", *FLAGS[:2],
    )
    conversations = dealt(table(spark, sf_dir, "conversations")).select(
        F.lit("conversations").alias("source_dataset"),
        F.concat(F.lit("c"), F.col("conv_id").cast("string"), F.lit("-"), F.col("turn").cast("string")).alias("row_key"),
        F.col("text").alias("review_text"),
        F.concat(F.lit("conv"), F.col("conv_id").cast("string")).alias("course_id"),
    )
    benchmark = table(spark, sf_dir, "benchmark").select(
        F.lit("benchmark").alias("source_dataset"),
        F.concat(F.lit("b"), F.col("item_id").cast("string")).alias("row_key"),
        F.col("text").alias("review_text"),
    )
    return [documents, conversations, benchmark]


def page_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One source record per web page: what it states about itself, with gaps where it states nothing."""
    html = F.col("html")
    title = F.regexp_extract(html, "<title>([^<]*)</title>", 1)
    return dealt(table(spark, sf_dir, "pages")).select(
        F.col("page_id").cast("string").alias("dataset_id"),
        title.alias("name"),
        F.regexp_extract("url", "https?://([^/]+)/", 1).alias("source_platform"),
        F.col("url").alias("source_url"),
        F.when(F.contains(F.lower(html), F.lit("license")), "stated on page").otherwise("Not specified").alias("license"),
        F.when(F.contains(html, F.lit("<meta charset")), "read").otherwise("").alias("license_status"),
        F.lit("fetch").alias("download_command"),
        F.when(F.col("page_id") % 7 != 0, "2024-01-01T00:00:00Z").alias("download_datetime_utc"),
        F.array(F.concat(F.lit("doc/"), F.col("page_id").cast("string"))).alias("files_downloaded"),
        F.when(F.contains(html, F.lit("<article")), F.array(F.lit("article"))).otherwise(F.array().cast("array<string>")).alias("fields_used"),
        F.array(F.concat(F.lit("length "), F.length(html).cast("string"))).alias("known_limitations"),
    )


def document_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(F.concat(F.lit("doc/"), F.col("doc_id").cast("string")).alias("file"))
