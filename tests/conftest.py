from __future__ import annotations

import os
import sys
import tracemalloc

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from reviewmill.session import local_session  # noqa: E402


@pytest.fixture(autouse=True)
def own_trace():
    """What one test traces of memory must not count in the peak of the next."""
    yield
    tracemalloc.stop()


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "8g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def reviews(spark):
    """A separable set: 30 reviews per sentiment, three courses and more, one word gives it away."""
    words = {"Very Positive": "excellent superb", "Neutral": "ordinary average", "Negative": "terrible boring"}
    rows = []
    for c, (label, cue) in enumerate(words.items()):
        for i in range(30):
            rows.append(
                (
                    100 * c + i,
                    f"Lecture {i} was {cue} and the quiz number {i % 7} had video part {i % 5}",
                    label,
                    f"course{i % 6}",
                    i % 2,
                    int(c == 0),
                    0,
                )
            )
    schema = "review_id long, review_text string, label_raw string, course_id string, f_even int, f_good int, f_never int"
    return spark.createDataFrame(rows, schema)
