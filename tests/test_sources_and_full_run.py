"""Files in, tables out: delimited scans, the manifest, normalisation and the whole study."""

from __future__ import annotations

import csv
import json
import pathlib
import random

import pytest
from pyspark.sql import functions as F

from reviewmill import session, settings
from reviewmill.plans.full_run import Study, run
from reviewmill.sources import files, loaders, normalize, records

IDS = loaders.DatasetIds("owner/main", "owner/weak", "owner/aux")
CUES = {5: "excellent", 4: "good", 3: "ordinary", 2: "poor", 1: "terrible"}


def write_csv(path, header, rows, delimiter=","):
    path.parent.mkdir(parents=True, exist_ok=True)
    with open(path, "w", newline="", encoding="utf-8") as handle:
        writer = csv.writer(handle, delimiter=delimiter)
        writer.writerow(header)
        writer.writerows(rows)


def record(dataset_id, names, **changes):
    base = {f: "stated" for f in settings.REQUIRED_SOURCE_FIELDS}
    base |= {"dataset_id": dataset_id, "files_downloaded": names, "fields_used": ["a"], "known_limitations": ["b"]}
    return base | changes


@pytest.fixture(scope="module")
def base(tmp_path_factory):
    root = tmp_path_factory.mktemp("base")
    rng = random.Random(3)
    main = []
    for i in range(400):
        label = rng.choice([5, 5, 5, 4, 4, 3, 2, 1])
        main.append([i, f"course-{i % 8}", f'Review {i}: a {CUES[label]} "course",\nwith quiz {i % 9} and video {i % 5}', label])
    main.append([400, "course-1", main[0][2], 5])  # copy of the first text
    main.append([401, "course-1", "NA", 5])
    main.append([402, "course-1", "unknown label", "x"])
    write_csv(root / "data/reviews_by_course.csv", ["Id", "CourseId", "Review", "Label"], main)
    weak = [[f"weak {i} {CUES[1 + i % 5]} text", 1 + i % 5, f"w{i % 6}", "2020-01-01"] for i in range(200)]
    weak.append(["half star", 3.5, "w1", ""])
    write_csv(root / "data/Coursera_reviews.csv", ["reviews", "rating", "course_id", "date_reviews"], weak)
    flags = settings.FEEDBACK_FLAGS[:2] + ["not_praise"]
    aux = [[f"aux {i} {'please improve' if i % 2 else 'loved it'} number {i}", i % 2, "x" if i == 3 else 0, int(i % 3 == 0)] for i in range(120)]
    write_csv(root / "data/train.csv", ["review", *flags], aux[:80])
    write_csv(root / "data/test.csv", ["review", *flags], aux[80:])
    write_csv(root / "data/other.csv", ["nothing"], [["x"]])
    manifest = {
        "records": [
            record(IDS.main, ["data/reviews_by_course.csv"]),
            record(IDS.weak, ["data/Coursera_reviews.csv"], license="Not specified here"),
            record(IDS.auxiliary, ["data/train.csv", "data/test.csv", "data/other.csv"]),
        ]
    }
    (root / "manifest.json").write_text(json.dumps(manifest, indent=1), encoding="utf-8")
    return root


def test_delimited_scan(spark, tmp_path):
    rows = [['say ""hi"", twice'.replace('""', '"'), "line one\nline two"], ["NA", ""], ["é", " x "]]
    for name, sep in (("a.csv", ","), ("a.tsv", "\t")):
        write_csv(tmp_path / name, ["first", "second"], rows, sep)
        got = files.read_delimited(spark, str(tmp_path / name)).orderBy("source_row_id").collect()
        assert [tuple(r) for r in got] == [
            ('say "hi", twice', "line one\nline two", 0), (None, None, 1), ("é", " x ", 2),
        ]
    landed = files.read_delimited(spark, str(tmp_path / "a.csv"))
    assert landed.count() == 3
    files.write_table(landed, str(tmp_path / "out_csv"), file_format="csv")
    back = spark.read.csv(str(tmp_path / "out_csv"), header=True, multiLine=True, escape='"')
    assert back.filter(F.col("second") == "line one\nline two").count() == 1
    files.write_table(landed, str(tmp_path / "parts"), ["source_row_id"])
    assert (tmp_path / "parts" / "source_row_id=1").is_dir()


def test_first_existing():
    assert normalize.first_existing(["REVIEW", "Text"], settings.TEXT_CANDIDATES) == "REVIEW"
    assert normalize.first_existing(["text", "Review"], settings.TEXT_CANDIDATES) == "Review"
    assert normalize.first_existing(["a"], settings.TEXT_CANDIDATES) is None


def test_normalize(spark):
    numeric = spark.createDataFrame([(0, "t", "5", "c", "1")], "row int, Comment string, Label string, course string, not_praise string")
    out = normalize.normalize_reviews(numeric, "d", "p", "f.csv", "row").first().asDict()
    assert out == {
        "review_text": "t", "source_dataset": "d", "source_platform": "p", "source_file": "f.csv", "source_row_id": 0,
        "rating": 5.0, "course_id": "c", "not_praise": 1,
    }
    both = numeric.withColumn("stars", F.lit("4"))
    out = normalize.normalize_reviews(both, "d", "p", "f.csv", "row").first()
    assert (out.rating, out.explicit_label) == (4.0, "5")
    mixed = spark.createDataFrame([(i, "t", "5" if i else "good") for i in range(10)], "row int, text string, label string")
    assert "explicit_label" in normalize.normalize_reviews(mixed, "d", "p", "f", "row").columns  # 90% is not above 90%
    with pytest.raises(ValueError):
        normalize.normalize_reviews(spark.createDataFrame([(1,)], "row int"), "d", "p", "f", "row")


def test_loaders(spark, base):
    data, _ = loaders.load_experiment_datasets(spark, str(base / "manifest.json"), str(base), IDS)
    assert data["main"].count() == 402
    first = data["main"].filter("source_row_id = 0").first()
    assert first.label_source == settings.MAIN_LABEL_SOURCE and "\n" in first.review_text
    ranged, _ = loaders.load_experiment_datasets(spark, str(base / "manifest.json"), str(base), IDS, in_ranges=True)
    assert all(sorted(map(str, ranged[name].collect())) == sorted(map(str, data[name].collect())) for name in data)
    assert data["weak"].count() == 200 and set(data["weak"].columns) >= {"rating", "review_date"}
    aux = data["auxiliary"]
    assert aux.count() == 120 and aux.agg(F.sum(f"`{settings.FEEDBACK_FLAGS[1]}`")).first()[0] == 0
    everything = loaders.load_public_reviews
    with pytest.raises(ValueError):  # one registered file has no text column
        everything(spark, str(base / "manifest.json"), str(base))
    with pytest.raises(FileNotFoundError):
        records.read_records(spark, str(base / "absent.json"))


def test_file_preference(spark, base):
    table = spark.createDataFrame([("d", ["x/Reviews.CSV", "x/reviews.tsv"])], "dataset_id string, files_downloaded array<string>")
    listing = spark.createDataFrame([("x/Reviews.CSV",), ("x/reviews.tsv",)], "file string")
    assert records.preferred_file(table, "d", settings.MAIN_FILES, listing) == "x/reviews.tsv"
    assert records.preferred_file(table, "d", settings.MAIN_FILES, listing.limit(1)) == "x/Reviews.CSV"
    assert records.preferred_file(table, "d", settings.MAIN_FILES, listing.limit(0)) is None
    assert records.preferred_file(table, "other", settings.MAIN_FILES, listing) is None
    empty = loaders.load_main(spark, records.read_records(spark, str(base / "manifest.json")), str(base), "absent/id")
    assert empty.isEmpty() and "review_text" in empty.columns


def test_audit(spark, base):
    table = records.read_records(spark, str(base / "manifest.json"))
    found = records.audit_records(table, loaders.existing_files(spark, str(base))).collect()
    assert [(r.dataset_id, r.severity, r.problem) for r in found] == [(IDS.weak, "warning", "license_not_specified")]
    broken = table.withColumn("name", F.lit("")).withColumn("fields_used", F.array().cast("array<string>"))
    listing = spark.createDataFrame([("data/train.csv",)], "file string")
    kinds = {(r.problem, r.detail) for r in records.audit_records(broken, listing).collect() if r.severity == "failure"}
    assert {("missing_field", "name"), ("missing_field", "fields_used"), ("missing_file", "data/test.csv")} <= kinds
    assert ("missing_file", "data/train.csv") not in kinds


def test_full_run(spark, base, tmp_path):
    models = (settings.LOGISTIC_NAME, settings.BAYES_NAME)
    study = Study(str(base / "manifest.json"), str(base), str(tmp_path / "out"), IDS, "quick", models)
    results = run(spark, study)
    summary = {r.dataset_id: r for r in results["data_summary"].collect()}
    assert (summary[IDS.main].raw_rows_loaded, summary[IDS.main].cleaned_rows_used) == (402, 400)
    assert summary[IDS.weak].sentiment_source == "rating" and not summary[IDS.auxiliary].sentiment_available
    scores = {r.model: r.accuracy for r in results["classical_baseline_results"].collect()}
    assert scores[settings.LOGISTIC_NAME] > 0.8 and set(scores) == set(models)
    grid = {r.experiment: r for r in results["ablation_results"].collect()}
    assert len(grid) == 7 and grid["with_topic_features"].status == "not_run"
    assert grid["kaggle_100k_only"].value == grid["3class_random_split_unigram_bigram"].value
    assert grid["kaggle_145m_weak_label_sample"].notes.endswith("Weak-label rows used: 200 of 200.")
    assert results["topic_summary"].count() == 5
    assert results["auxiliary_multilabel_results"].first().status == "run"
    stored = spark.read.parquet(str(tmp_path / "out" / "splits"))
    assert {r.split: r["count"] for r in stored.groupBy("split").count().collect()} == {"train": 280, "val": 40, "test": 80}
    for name in results:
        assert (tmp_path / "out" / name).is_dir()


def test_stored_steps_are_gone_after_a_run(spark):
    with session.stored_steps(spark) as folder:
        assert session.materialise(spark.range(3)).count() == 3
        path = pathlib.Path(folder.removeprefix("file:"))
        assert len(list(path.iterdir())) == 1
    assert not path.exists()


def test_ids_of_any_kind_and_whole_number_labels(spark):
    raw = spark.createDataFrame(
        [("a17", "good", "5.00", 0), (None, "bad", "1", 1), ("b2", "fine", "3.0", 2), (None, "okay", "4", 3)],
        "Id string, Review string, Label string, source_row_id long",
    )
    rows = loaders.shape_main(raw, "d", "f.csv").orderBy("source_row_id").collect()
    assert [r.review_id for r in rows] == ["a17", "row 1", "b2", "row 3"]
    assert [r.label_5class for r in rows] == ["Very Positive", "Very Negative", "Neutral", "Positive"]


def test_a_folder_of_files_has_unique_row_numbers(spark, tmp_path):
    folder = tmp_path / "many"
    folder.mkdir()
    for i in range(4):
        (folder / f"{i}.csv").write_text('Id,Review\n' + "".join(f'{i}{k},"line one\nline {k}"\n' for k in range(3)))
    rows = files.read_delimited(spark, str(folder)).collect()
    assert len(rows) == len({r.source_row_id for r in rows}) == 12


def test_audit_of_folders_and_of_an_empty_manifest(spark):
    schema = records.RECORD
    full = dict.fromkeys([f.split()[0] for f in schema.split(", ")], "x")
    full |= {"files_downloaded": ["raw/a/x.csv"], "fields_used": ["f"], "known_limitations": ["l"]}
    table = spark.createDataFrame([{**full, "dataset_id": "there", "local_dir": "./raw/a/"}, {**full, "dataset_id": "gone", "local_dir": "raw/b"}], schema)
    existing = spark.createDataFrame([("raw/a/x.csv",)], "file string")
    assert [(r.dataset_id, r.problem) for r in records.audit_records(table, existing).collect()] == [("gone", "missing_folder")]
    empty = records.audit_records(table.filter("false"), existing).collect()
    assert [(r.severity, r.problem) for r in empty] == [("failure", "empty_manifest")]
