"""Fixed values the results depend on, stated once.

Everything in this module is plain data: label names, thresholds, seeds and
caps.  Operators take them as default arguments so a caller can override any.
"""

from __future__ import annotations

# --- fixed values: reproducibility and run modes -------------------------------------
SEED = 42
QUICK_SAMPLE_ROWS = 1500
TEST_SHARE = 0.2
VAL_SHARE = 0.1
HOLDOUT_SHARE = 0.2
ABLATION_MIN_COURSES = 5
ABLATION_MIN_ROWS = 20

# --- fixed values: labels -------------------------------------------------------------
FIVE_CLASSES = ["Very Negative", "Negative", "Neutral", "Positive", "Very Positive"]
THREE_CLASSES = ["negative", "neutral", "positive"]
FIVE_CLASS_BY_KEY = {
    "1": "Very Negative",
    "2": "Negative",
    "3": "Neutral",
    "4": "Positive",
    "5": "Very Positive",
    "very negative": "Very Negative",
    "negative": "Negative",
    "neutral": "Neutral",
    "positive": "Positive",
    "very positive": "Very Positive",
}
THREE_CLASS_BY_FIVE = {
    "Very Negative": "negative",
    "Negative": "negative",
    "Neutral": "neutral",
    "Positive": "positive",
    "Very Positive": "positive",
}
# Optional extra spellings; off by default because the default result drops them.
SHORT_SPELLINGS = {"pos": "Positive", "neg": "Negative"}

FEEDBACK_FLAGS = [
    "Improvement Suggestions",
    "Questions and Answers",
    "Experience Sharing",
    "Technical Feedback",
    "Support Request",
    "Community Interaction",
    "Course Comparison",
    "Related Course Suggestions",
    "not_praise",
]

# --- fixed values: column-name candidates, best first ---------------------------------
TEXT_CANDIDATES = ["review_text", "review", "Review", "reviews", "Reviews", "comment", "text", "feedback"]
RATING_CANDIDATES = ["rating", "Rating", "ratings", "star", "stars", "score"]
LABEL_CANDIDATES = ["sentiment", "Sentiment", "label", "Label", "polarity"]
COURSE_CANDIDATES = ["course_id", "CourseId", "course id", "course", "course_name", "Course Name", "CourseTitle"]
NUMERIC_LABEL_SHARE = 0.9

# --- fixed values: source records ------------------------------------------------------
REQUIRED_SOURCE_FIELDS = [
    "dataset_id",
    "download_command",
    "download_datetime_utc",
    "fields_used",
    "files_downloaded",
    "known_limitations",
    "license",
    "license_status",
    "name",
    "source_platform",
    "source_url",
]
MAIN_FILES = ["reviews_by_course.csv", "reviews.tsv", "reviews.csv"]
WEAK_FILE = "Coursera_reviews.csv"
MAIN_LABEL_SOURCE = "kaggle_100k_explicit_label"
WEAK_LABEL_SOURCE = "kaggle_145m_rating_weak_label"

# --- fixed values: features ------------------------------------------------------------
SENTIMENT_VOCABULARY = 20000
MULTILABEL_VOCABULARY = 25000
MULTILABEL_VARIANT_VOCABULARY = {"quick": 5000, "full": 20000}
ABLATION_VOCABULARY = 12000
TOPIC_VOCABULARY = 5000
MIN_DF = 2
ITERATIONS = 1000
MAX_DF = 0.95
TOPIC_MAX_DF = 0.9

# --- fixed values: topics --------------------------------------------------------------
MIN_TOPIC_DOCUMENTS = 20
TOPIC_COUNT = {"quick": 5, "full": 8}
TOPIC_ITERATIONS = 10
TOPIC_KEYWORDS = 10
MATRIX_KEYWORDS = 6
REPRESENTATIVE_CHARS = 500
NO_SENTIMENT = "sentiment_not_available"
TOPIC_NOTE = "LDA topic generated from cleaned public review text."
BERTOPIC_STATUS = "not_run_dependency_unavailable"
ISSUE_RULES = [
    ("assignment", "Assessment design or peer review clarity",
     "Review assignment instructions, rubrics, examples, and feedback timing."),
    ("quiz", "Quiz feedback or assessment difficulty",
     "Audit quiz wording and add targeted explanations for common incorrect answers."),
    ("video", "Lecture pacing or video clarity",
     "Revise short lecture segments, captions, and pacing where learners report confusion."),
    ("forum", "Discussion/community support",
     "Increase instructor or teaching-assistant presence in forums and seed discussion prompts."),
    ("technical", "Platform or tool friction",
     "Provide setup checks, troubleshooting notes, and alternative tool paths."),
    ("content", "Course content relevance or depth",
     "Align examples and readings with learner goals and add optional advanced material."),
]
GENERAL_ISSUE = (
    "General learning experience issue",
    "Review representative comments and prioritize revisions with frequent negative or "
    "improvement-oriented feedback.",
)

# --- fixed values: errors ----------------------------------------------------------------
MAX_ERROR_CASES = 30
SHORT_REVIEW_WORDS = 5
CONTRAST_WORDS = ["but", "however", "although", "except"]
SENTIMENT_ERROR_NOTE = "Review for ambiguous wording, mixed sentiment, or preprocessing loss."
LABEL_SET_ERROR_NOTE = "Review for overlapping feedback functions or sparse label evidence."

# --- fixed values: model names -----------------------------------------------------------
LOGISTIC_NAME = "TF-IDF + Logistic Regression"
SVM_NAME = "TF-IDF + Linear SVM"
FOREST_NAME = "TF-IDF + Random Forest"
BAYES_NAME = "TF-IDF + Multinomial Naive Bayes"
SENTIMENT_MODELS = [LOGISTIC_NAME, SVM_NAME, FOREST_NAME, BAYES_NAME]
OVR_NAME = "TF-IDF + One-vs-Rest Logistic Regression"
MAJORITY_NAME = "TF-IDF + Majority Multi-label Baseline"
COURSE_CHART_ROWS = 40

