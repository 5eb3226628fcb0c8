"""DuckDB SQL that each query must agree with, built from named common table expressions."""

from __future__ import annotations

from reviewmill import settings
from reviewmill.functions.stopwords import ENGLISH
from reviewmill.queries.tables import FLAGS, MODELS, TOPICS

SPACES = r"\s\x0b\x1c-\x1f\x{85}\p{Z}"
BALANCED_CAP = 120


def _quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def masked(column: str) -> str:
    steps = [
        (rf"\b(?:https?://|www\.)[^{SPACES}]+\b", "[URL]", "gi"),
        (r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\b", "[EMAIL]", "g"),
        (rf"\+?\p{{Nd}}[\p{{Nd}}{SPACES}().-]{{7,}}\p{{Nd}}", "[PHONE]", "g"),
        (
            rf"\b(my name is|i am|i'm)[{SPACES}]+[A-Z][A-Za-z]+(?:[{SPACES}]+[A-Z][A-Za-z]+)?\b",
            r"\1 [NAME]",
            "g",
        ),
    ]
    text = f"coalesce({column}, '')"
    for pattern, mark, flags in steps:
        text = f"regexp_replace({text}, {_quote(pattern)}, {_quote(mark)}, '{flags}')"
    return text


def cleaned(column: str) -> str:
    return f"trim(regexp_replace({masked(column)}, {_quote(f'[{SPACES}]+')}, ' ', 'g'))"


def h(expression: str) -> str:
    return f"cast(('0x' || substr(md5({expression}), 1, 8)) as bigint)"


def md5_order(column: str) -> str:
    return f"md5(cast({column} as varchar) || ':{settings.SEED}')"


REVIEWS = """reviews as (
  select d.doc_id as review_id, d.text as review_text, d.source as course_id, d.lang,
    case when l.doc_id is null then null
         when l.toxic = 1 and l.quality = 0 then '1'
         when l.toxic = 1 then '2.0'
         when l.quality = 0 then ' 3 '
         when d.n_chars % 2 = 0 then 'Positive'
         else '5' end as label_raw,
    cast(2 + (d.n_chars % 7) as double) / 2.0 as rating,
    cast(coalesce(l.quality, 0) as integer) as f_quality,
    cast(coalesce(l.toxic, 0) as integer) as f_toxic,
    case when d.lang <> 'en' then 1 else 0 end as f_not_english,
    case when regexp_matches(d.text, '[0-9]') then 1 else 0 end as f_has_digit,
    case when d.n_chars > 1000 then 1 else 0 end as f_long
  from documents d left join labels l on d.doc_id = l.doc_id)"""

LABELLED = """labelled as (
  select *, case label_5class when 'Very Negative' then 'negative' when 'Negative' then 'negative'
      when 'Neutral' then 'neutral' when 'Positive' then 'positive' when 'Very Positive' then 'positive' end
      as sentiment_label
  from (select *, case lower(regexp_replace(trim(label_raw), '\\.0$', ''))
      when '1' then 'Very Negative' when 'very negative' then 'Very Negative'
      when '2' then 'Negative' when 'negative' then 'Negative'
      when '3' then 'Neutral' when 'neutral' then 'Neutral'
      when '4' then 'Positive' when 'positive' then 'Positive'
      when '5' then 'Very Positive' when 'very positive' then 'Very Positive' end as label_5class
    from reviews)
  where label_5class is not null)"""

CLEANED = f"""cleaned as (select *, {cleaned('review_text')} as clean_text from reviews)"""

EXPERIMENT = f"""experiment as (
  select * exclude (copy) from (
    select *, row_number() over (partition by clean_text order by review_id) as copy
    from (select *, {cleaned('review_text')} as clean_text from labelled) where clean_text <> '')
  where copy = 1)"""

SOURCES = """sources as (
  select 'documents' as source_dataset, 'd' || review_id as row_key, review_text, course_id, label_raw, rating,
    f_quality, f_toxic from reviews
  union all select 'conversations', 'c' || conv_id || '-' || turn, text, 'conv' || conv_id, null, null, null, null
    from conversations
  union all select 'benchmark', 'b' || item_id, text, null, null, null, null, null from benchmark)"""

CONTACT = """contact as (
  select 'documents' as source_dataset, review_id as row_id, review_text from reviews
  union all select 'pages', page_id, html from pages
  union all select 'page readers', page_id, 'my name is Reader Nr' || page_id || ', i am  Reader Two. See ' || url || '.'
  from pages)"""

STOP = ", ".join(_quote(word) for word in ENGLISH)


def split(source: str, label: str) -> str:
    """Rows with ``split``: sizes by largest remainder, order by hash."""
    return f"""
  sizes as (select {label} as class, count(*) as c from {source} group by 1),
  tot as (select sum(c) as n, sum(c) - cast(ceil(cast(0.2 as double) * sum(c)) as bigint) as tv from sizes),
  tot2 as (select *, tv - cast(ceil(cast(0.125 as double) * tv) as bigint) as tr from tot),
  s1 as (select class, c, tv, tr, c * tv / n as exact, floor(c * tv / n) as whole from sizes, tot2),
  s2 as (select *, whole + case when row_number() over (order by round(exact - whole, 9) desc, class)
      <= tv - sum(whole) over () then 1 else 0 end as rest from s1),
  s3 as (select class, c, rest, tr, rest * tr / tv as exact, floor(rest * tr / tv) as whole from s2),
  s4 as (select class, c, rest, whole + case when row_number() over (order by round(exact - whole, 9) desc, class)
      <= tr - sum(whole) over () then 1 else 0 end as train from s3),
  ranked as (select *, row_number() over (partition by {label} order by {md5_order('review_id')}, review_id) as rk
    from {source}),
  split as (select ranked.*, case when rk <= c - rest then 'test' when rk <= c - train then 'val' else 'train' end
      as split
    from ranked join s4 on ranked.{label} = s4.class)"""


def words(source: str, keep: str, accents: bool = True, text: str = "clean_text") -> str:
    lower = f"lower({text})" if accents else f"strip_accents(lower({text}))"
    return f"""words as (
  select {keep}, list_filter(regexp_extract_all({lower}, '[\\p{{L}}\\p{{N}}_]{{2,}}'),
    lambda x: x not in ({STOP})) as w from {source})"""


BIGRAM = "list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])"


def doc_terms(keep: str, ngrams: tuple[int, int], source: str = "words", name: str = "doc_terms") -> str:
    terms = {(1, 1): "w", (2, 2): BIGRAM, (1, 2): f"list_concat(w, {BIGRAM})"}[ngrams]
    return f"""{name} as (
  select {keep}, term, count(*) as tf from (select {keep}, unnest({terms}) as term from {source}) group by {keep}, term)"""


STATS = "stats as (select term, cast(sum(tf) as bigint) as cf, count(*) as df from doc_terms group by term)"


def vocab(documents: str, size: int, max_df: float) -> str:
    return f"""vocab as (
  select term, cf, df from stats
  where df >= {settings.MIN_DF} and df <= cast({max_df} as double) * (select count(*) from {documents})
  order by cf desc, term limit {size})"""


def weights(documents: str, terms: str = "doc_terms", keep: str = "review_id", name: str = "weights") -> str:
    return f"""{name}_raw as (
  select {terms}.*, tf * (ln((1.0 + (select count(*) from {documents})) / (1.0 + df)) + 1.0) as v
  from {terms} join vocab using (term)),
{name} as (
  select {keep}, term, v / sqrt(sum(v * v) over (partition by review_id)) as weight from {name}_raw)"""


def with_(*parts: str) -> str:
    return "with " + ",\n".join(parts) + "\n"


BASE = (REVIEWS, LABELLED)

TRAINED = (
    REVIEWS,
    LABELLED,
    EXPERIMENT,
    split("experiment", "sentiment_label"),
    "train as (select * from split where split = 'train')",
    words("train", "review_id, sentiment_label"),
    doc_terms("review_id, sentiment_label", (1, 2)),
    STATS,
    vocab("train", settings.SENTIMENT_VOCABULARY, settings.MAX_DF),
    weights("train", keep="review_id, sentiment_label"),
    "totals as (select sentiment_label as label, sum(weight) as total from weights group by 1)",
    "prior as (select sentiment_label as label, ln(count(*) / (select count(*) from train)) as log_prior from train group by 1)",
    "size as (select count(*) as v from vocab)",
)


def predictions(label: str) -> str:
    classes = settings.THREE_CLASSES if label == "sentiment_label" else settings.FIVE_CLASSES
    names = "[" + ", ".join(_quote(c) for c in classes) + "]"
    parts = [
        f"select {_quote(model)} as model, *, {h(f'review_id || {_quote(':' + salt)}')} as h from labelled"
        for model, salt in MODELS.items()
    ]
    return f"""preds as (
  select model, review_id, course_id, review_text, {label} as true_label,
    case when h % 10 < 7 then {label} else {names}[1 + h % {len(classes)}] end as predicted_label
  from ({' union all '.join(parts)}))"""


SCORES = """scores as (
  select model, label, sum(tp) as tp, sum(support) as support, sum(predicted) as predicted from (
    select model, true_label as label, case when true_label = predicted_label then 1 else 0 end as tp, 1 as support,
      0 as predicted from preds
    union all select model, predicted_label, 0, 0, 1 from preds) group by 1, 2),
prf as (select *, case when predicted > 0 then tp / predicted else 0 end as p,
    case when support > 0 then tp / support else 0 end as r,
    case when predicted + support > 0 then 2 * tp / (predicted + support) else 0 end as f from scores)"""

SENTIMENT_ROW = """select model, 'run' as status, round(sum(tp) / sum(support), 6) as accuracy,
    round(avg(p), 6) as precision_macro, round(avg(r), 6) as recall_macro, round(avg(f), 6) as macro_f1,
    round(sum(f * support) / sum(support), 6) as weighted_f1, '' as notes"""


def metrics_part(label: str, tag: str) -> str:
    return f"({with_(*BASE, predictions(label), SCORES)} {SENTIMENT_ROW}, '{tag}' as labels from prf group by model)"


def matrix(where: str = "") -> str:
    cells = ", ".join(
        f"cast(count(*) filter (where p.predicted_label = {_quote(c)}) as bigint) as pred_{c}" for c in settings.THREE_CLASSES
    )
    labels = " union all ".join(
        f"select {i} as position, {_quote(c)} as label" for i, c in enumerate(settings.THREE_CLASSES)
    )
    return f"""select m.model, cast(l.position as integer) as position, 'true_' || l.label as true_label, {cells}
from (select distinct model from preds {where}) m cross join ({labels}) l
left join preds p on p.model = m.model and p.true_label = l.label
group by m.model, l.position, l.label"""


def flag_preds() -> str:
    columns = ", ".join(
        f"{f} as true_{f}, case when {h(f'review_id || {_quote(':' + f)}')} % 10 < 2 then 1 - {f} else {f} end as pred_{f}"
        for f in FLAGS
    )
    return f"flagged as (select review_id, {columns} from reviews)"


def flag_rows() -> str:
    parts = " union all ".join(f"select {_quote(f)} as label, true_{f} as t, pred_{f} as p from flagged" for f in FLAGS)
    return f"""flag_rows as ({parts}),
per_flag as (select label, sum(t * p) as tp, sum(p) as predicted, sum(t) as support, count(*) as n,
    case when sum(p) > 0 then sum(t * p) / sum(p) else 0 end as p,
    case when sum(t) > 0 then sum(t * p) / sum(t) else 0 end as r,
    case when sum(p) + sum(t) > 0 then 2 * sum(t * p) / (sum(p) + sum(t)) else 0 end as f
  from flag_rows group by label)"""


SAME_FLAGS = " and ".join(f"true_{f} = pred_{f}" for f in FLAGS)
FLAG_METRICS = f"""select 'stub flags' as model, 'run' as status,
  round(2 * sum(tp) / (sum(predicted) + sum(support)), 6) as micro_f1, round(avg(f), 6) as macro_f1,
  round((sum(predicted) + sum(support) - 2 * sum(tp)) / sum(n), 6) as hamming_loss,
  round((select avg(case when {SAME_FLAGS} then 1.0 else 0.0 end) from flagged), 6) as subset_accuracy, '' as notes
from per_flag"""


def label_set(prefix: str) -> str:
    return "concat_ws('; ', " + ", ".join(f"case when {prefix}{f} = 1 then '{f}' end" for f in FLAGS) + ")"


TOPIC_DOCS = f"""topic_docs as (
  select r.review_id, r.course_id, l.sentiment_label, cast({h("r.review_id || ':p'")} % {TOPICS} as integer) as topic_id,
    ({h("r.review_id || ':w'")} % 1000) / 1000.0 as topic_weight, {cleaned('r.review_text')} as clean_text
  from reviews r left join labelled l on r.review_id = l.review_id)"""

TOPIC_KEYWORDS = (
    words("topic_docs", "topic_id"),
    """keywords as (
  select topic_id, cast(row_number() over (partition by topic_id order by weight desc, term) as integer) as position, term, weight
  from (select topic_id, term, cast(count(*) as bigint) as weight
        from (select topic_id, unnest(w) as term from words) group by 1, 2)
  qualify row_number() over (partition by topic_id order by weight desc, term) <= 10)""",
)
TOPIC_BASE = (*BASE, TOPIC_DOCS)

REPRESENTATIVES = """reps as (
  select topic_id, substr(clean_text, 1, 500) as representative from topic_docs
  qualify row_number() over (partition by topic_id order by topic_weight desc, review_id) = 1)"""


def profile(k: int) -> str:
    return f"""profile as (
  select t.topic_id, count(d.review_id) as document_count,
    coalesce((select sentiment_label from topic_docs s where s.topic_id = t.topic_id and sentiment_label is not null
      group by 1 order by count(*) desc, sentiment_label limit 1), '{settings.NO_SENTIMENT}') as dominant_sentiment,
    round(count(*) filter (where d.sentiment_label = 'negative') / nullif(count(d.review_id), 0), 6) as negative_ratio
  from (select cast(range as integer) as topic_id from range({k})) t left join topic_docs d on d.topic_id = t.topic_id
  group by t.topic_id)"""


def joined_keywords(n: int, name: str) -> str:
    return f"""{name} as (select topic_id, string_agg(term, ', ' order by position) as keywords from keywords
  where position <= {n} group by topic_id)"""


def issue(column: str, part: int) -> str:
    cases = " ".join(f"when contains(lower({column}), '{r[0]}') then {_quote(r[part])}" for r in settings.ISSUE_RULES)
    return f"case {cases} else {_quote(settings.GENERAL_ISSUE[part - 1])} end"


def error_type(text: str) -> str:
    contrast = " or ".join(f"contains(lower({text}), '{w}')" for w in settings.CONTRAST_WORDS)
    return f"""case
    when true_label = 'positive' and predicted_label = 'negative' then 'positive_predicted_as_negative'
    when true_label = 'negative' and predicted_label = 'positive' then 'negative_predicted_as_positive'
    when true_label = 'neutral' or predicted_label = 'neutral' then 'neutral_confusion'
    when len(regexp_extract_all({text}, {_quote(f'[^{SPACES}]+')})) <= 5 then 'short_review'
    when {contrast} then 'mixed_sentiment'
    else 'other_sentiment_error' end"""


def added(mark: str, column: str = "masked_text") -> str:
    def times(text: str) -> str:
        return f"(length({text}) - length(replace({text}, '{mark}', ''))) // {len(mark)}"

    return f"({times(column)} - {times('review_text')})"


_MARKS = {"url": "[URL]", "email": "[EMAIL]", "phone": "[PHONE]", "name": "[NAME]"}
_CLASS_COUNTS = "cls as (select sentiment_label, count(*) as n from labelled group by 1)"

def fit_facts(model: str, source: str, label: str, more: str = "") -> str:
    return f"""{split(source, label)} select '{model}' as model, 'run' as status,
  count(*) filter (where split = 'train') as train_rows, count(*) filter (where split = 'test') as test_rows,
  count(distinct {label}) as classes, count(*) filter (where split = 'test') as scored_rows, true as beats_majority{more} from split"""


ONCE = f"""once as (
  select * exclude (copy) from (
    select *, row_number() over (partition by clean_text order by review_id) as copy
    from (select *, {cleaned('review_text')} as clean_text from reviews) where clean_text <> '')
  where copy = 1)"""


def flag_facts(in_training: str) -> str:
    parts = " union all ".join(
        f"""select '{flag}' as label, cast(sum({flag}) filter (where split = 'test') as bigint) as support, true as any_found, true as at_optimum,
  count(*) filter (where split in ({in_training})) as train_rows, count(*) filter (where split = 'test') as test_rows from split"""
        for flag in FLAGS
    )
    return with_(REVIEWS, ONCE, split("once", "f_not_english")) + parts


GRID = with_(
    REVIEWS,
    LABELLED,
    EXPERIMENT,
    f"""weak as (select count(distinct clean_text) as n from (
  select {cleaned('text')} as clean_text from conversations where turn % 6 between 1 and 4) where clean_text <> '')""",
    "main as (select count(*) as n from experiment)",
    f"""courses as (select course_id, row_number() over (order by {md5_order('course_id')}) as rk, count(*) over () as n
  from (select distinct course_id from experiment where course_id is not null))""",
    """held as (select count(*) filter (where c.rk <= greatest(1, round_even(c.n * 0.2, 0))) as test, count(*) as n
  from experiment e left join courses c on e.course_id = c.course_id)""",
) + """select experiment, 'run' as status, cast(n - ceil(cast(0.2 as double) * n) as bigint) as train_rows,
  cast(ceil(cast(0.2 as double) * n) as bigint) as test_rows, true as scored from main, (values
    ('3class_random_split_unigram_bigram'), ('5class_random_split_unigram_bigram'), ('3class_random_split_unigram'),
    ('with_topic_features'), ('kaggle_100k_only')) as t(experiment)
union all select 'kaggle_145m_weak_label_sample', 'run', cast(n - ceil(cast(0.2 as double) * n) as bigint),
  cast(ceil(cast(0.2 as double) * n) as bigint), true from weak
union all select '3class_course_holdout_split', 'run', n - test, test, true from held"""

ORACLES: dict[str, str] = {
    "train_logreg": with_(*BASE, EXPERIMENT, fit_facts("TF-IDF + Logistic Regression", "experiment", "sentiment_label", ", true as at_optimum")),
    "train_linear_svm": with_(*BASE, EXPERIMENT, fit_facts("TF-IDF + Linear SVM", "experiment", "sentiment_label", ", true as at_optimum")),
    "train_random_forest": with_(*BASE, EXPERIMENT, fit_facts("TF-IDF + Random Forest", "experiment", "sentiment_label")),
    "train_embedding_classifier": with_(
        "vectors as (select *, vec_id as review_id from embeddings)",
        fit_facts("dense vectors + multilayer perceptron", "vectors", "label"),
    ),
    "train_multilabel_ovr": flag_facts("'train'"),
    "train_multilabel_variant": flag_facts("'train', 'val'"),
    "ablation_grid": GRID,
    "lda_topics": with_(REVIEWS, ONCE, "n as (select count(*) as n from once)")
    + """select case when n < 100 then 2 else least(8, greatest(2, n // 50)) end as topics, n as documents,
  10 * case when n < 100 then 2 else least(8, greatest(2, n // 50)) end as keywords, true as all_represented from n""",
    "normalize_reviews": with_(REVIEWS)
    + """select review_text, 'documents' as source_dataset, 'given table' as source_platform,
  'documents.parquet' as source_file, review_id as source_row_id, case when rating <> 1.5 then rating end as rating,
  label_raw as explicit_label, course_id, f_toxic from reviews""",
    "label_or_rating": with_(*BASE)
    + """select course_id, round(avg(case when try_cast(label_raw as double) is not null then 1.0 else 0.0 end), 6) as numeric_share,
  case when avg(case when try_cast(label_raw as double) is not null then 1.0 else 0.0 end) > 0.9 then 'rating'
    else 'explicit_label' end as read_as from reviews group by course_id""",
    "multilabel_coerce": with_(REVIEWS)
    + """select review_id, case when rating = 1.0 then 0 else f_quality end as f_quality,
  case when rating <> 2.0 then f_toxic else 0 end as f_toxic, f_long from reviews""",
    "union_sources": with_(REVIEWS, SOURCES) + "select * from sources",
    "weak_label_reviews": """with raw as (
  select conv_id, turn, text as review_text, cast(conv_id as varchar) as course_id,
    case when turn % 6 = 0 then 'bad' when turn % 6 = 5 then '3.5' when turn % 2 = 0 then (turn % 6) || '.0'
      else cast(turn % 6 as varchar) end as label_raw from conversations)
select conv_id, turn, review_text, label_raw, try_cast(label_raw as double) as rating, course_id,
  ['Very Negative', 'Negative', 'Neutral', 'Positive'][turn % 6] as label_5class,
  ['negative', 'negative', 'neutral', 'positive'][turn % 6] as sentiment_label,
  'kaggle_145m_rating_weak_label' as label_source
from raw where turn % 6 between 1 and 4""",
    "source_audit": """with rec as (
  select cast(page_id as varchar) as dataset_id, regexp_extract(html, '<title>([^<]*)</title>', 1) as name,
    regexp_extract(url, 'https?://([^/]+)/', 1) as source_platform, url as source_url,
    case when contains(lower(html), 'license') then 'stated on page' else 'Not specified' end as license,
    case when contains(html, '<meta charset') then 'read' else '' end as license_status,
    case when page_id % 7 <> 0 then '2024-01-01T00:00:00Z' end as download_datetime_utc,
    contains(html, '<article') as has_article, 'doc/' || page_id as file from pages)
select dataset_id, 'failure' as severity, 'missing_field' as problem, detail from (
  select dataset_id, unnest([case when name = '' then 'name' end, case when source_platform = '' then 'source_platform' end,
    case when source_url is null or source_url = '' then 'source_url' end,
    case when license_status = '' then 'license_status' end,
    case when download_datetime_utc is null then 'download_datetime_utc' end,
    case when not has_article then 'fields_used' end]) as detail from rec) where detail is not null
union all select dataset_id, 'warning', 'license_not_specified', license from rec where license = 'Not specified'
union all select dataset_id, 'failure', 'missing_file', file from rec
  where file not in (select 'doc/' || doc_id from documents)""",
    "mask_pii": with_(REVIEWS, CONTACT)
    + f"select source_dataset, row_id, {masked('review_text')} as masked_text from contact",
    "mask_counts": with_(REVIEWS, CONTACT, f"m as (select *, {masked('review_text')} as masked_text from contact)")
    + " union all ".join(
        f"""select source_dataset, '{name}' as mask, cast(count(*) filter (where {added(mark)} > 0) as bigint) as rows_masked,
  cast(sum({added(mark)}) as bigint) as marks from m group by source_dataset"""
        for name, mark in _MARKS.items()
    ),
    "clean_dedupe": with_(REVIEWS, CLEANED)
    + """select review_id, clean_text, course_id, label_raw from cleaned where clean_text <> ''
qualify row_number() over (partition by clean_text order by review_id) = 1""",
    "removed_rows": with_(REVIEWS, SOURCES, f"c as (select source_dataset, {cleaned('review_text')} as t from sources)")
    + """select source_dataset, count(*) as rows_before, count(distinct nullif(t, '')) as rows_after,
  count(*) - count(distinct nullif(t, '')) as removed_rows from c group by source_dataset""",
    "label_5class_3class": with_(*BASE)
    + """select review_id, label_raw, label_5class, sentiment_label, 'kaggle_100k_explicit_label' as label_source
from labelled""",
    "rating_thresholds": with_(REVIEWS)
    + """select review_id, rating, case when rating >= 4 then 'positive' when rating = 3 then 'neutral' else 'negative' end
  as sentiment_label from reviews where rating >= 4 or rating = 3 or rating <= 2""",
    "label_precedence": with_(*BASE)
    + """select 'both' as variant, review_id, sentiment_label, 'explicit_label' as sentiment_source from labelled
union all select 'rating only', review_id,
  case when rating >= 4 then 'positive' when rating = 3 then 'neutral' else 'negative' end, 'rating'
  from reviews where rating >= 4 or rating = 3 or rating <= 2
union all select 'neither', review_id, null, 'none' from reviews""",
    "label_distribution": with_(*BASE)
    + """select '3class' as label_type, sentiment_label as label, count(*) as count,
  'kaggle_100k_explicit_label' as source, '' as notes from labelled group by sentiment_label
union all select '5class', label_5class, count(*), 'kaggle_100k_explicit_label', '' from labelled group by label_5class""",
    "multilabel_distribution": with_(REVIEWS)
    + " union all ".join(
        f"select '{f}' as label, cast(sum({f}) as bigint) as positive_count from reviews" for f in FLAGS
    ),
    "sample_fixed_n": with_(REVIEWS, SOURCES)
    + f"""select row_key, source_dataset, course_id from sources order by {md5_order('row_key')}, row_key
limit {settings.QUICK_SAMPLE_ROWS}""",
    "stratified_split": with_(*BASE, split("labelled", "sentiment_label"))
    + "select review_id, sentiment_label, split from split",
    "split_sizes": with_(*BASE, split("labelled", "label_5class"))
    + "select label_5class, split, count(*) as rows from split group by 1, 2",
    "stratify_guard": with_(REVIEWS)
    + " union all ".join(
        f"""select '{c}' as column, count(*) as classes, min(n) as smallest, count(*) >= 2 and min(n) >= 2 as usable
from (select {c}, count(*) as n from reviews group by {c})"""
        for c in ("label_raw", "course_id", "f_toxic", "review_id")
    ),
    "course_holdout": with_(
        REVIEWS,
        "courses as (select distinct course_id from reviews where course_id is not null)",
        f"""held as (select course_id from (select course_id, row_number() over (order by {md5_order('course_id')}) as rk,
  greatest(1, round_even(count(*) over () * cast(0.2 as double), 0)) as k from courses) where rk <= k)""",
    )
    + """select review_id, course_id, case when course_id in (select course_id from held) then 'test' else 'train' end
  as split from reviews""",
    "balanced_sample": with_(*BASE)
    + f"""select review_id, sentiment_label from labelled qualify row_number() over
  (partition by sentiment_label order by {md5_order('review_id')}, review_id) <= {BALANCED_CAP}""",
    "token_counts": with_(REVIEWS, CLEANED, words("cleaned", "review_id"), doc_terms("review_id", (1, 1)), STATS)
    + "select term, cf, df from stats",
    "bigram_counts": with_(REVIEWS, CLEANED, words("cleaned", "review_id"), doc_terms("review_id", (2, 2)), STATS)
    + "select term, cf, df from stats",
    "vocabulary_topk": with_(
        REVIEWS,
        CLEANED,
        words("cleaned", "review_id"),
        doc_terms("review_id", (1, 2)),
        STATS,
        vocab("cleaned", settings.SENTIMENT_VOCABULARY, settings.MAX_DF),
    )
    + "select term, cf, df from vocab",
    "doc_term_counts": with_(
        REVIEWS,
        CLEANED,
        words("cleaned", "review_id"),
        doc_terms("review_id", (1, 1)),
        STATS,
        vocab("cleaned", settings.TOPIC_VOCABULARY, settings.TOPIC_MAX_DF),
    )
    + "select review_id, term, tf from doc_terms where term in (select term from vocab)",
    "tfidf_weights": with_(
        REVIEWS,
        CLEANED,
        words("cleaned", "review_id"),
        doc_terms("review_id", (1, 2)),
        STATS,
        vocab("cleaned", 20000, 0.95),
        weights("cleaned"),
    )
    + "select review_id, term, round(weight, 6) as weight from weights",
    "strip_accents_terms": with_(
        REVIEWS, CLEANED, words("cleaned", "review_id", accents=False), doc_terms("review_id", (1, 1)), STATS
    )
    + "select term, cf, df from stats",
    "class_weights": with_(*BASE, _CLASS_COUNTS)
    + """select sentiment_label, n as rows, round(sum(n) over () / (count(*) over () * n), 6) as class_weight from cls""",
    "naive_bayes_model": with_(*TRAINED)
    + """select w.sentiment_label as label, w.term, round(ln((sum(w.weight) + 1.0) / (any_value(t.total) + any_value(s.v))), 6) as log_theta,
  round(any_value(p.log_prior), 6) as log_prior
from weights w join totals t on t.label = w.sentiment_label join prior p on p.label = w.sentiment_label, size s
group by 1, 2""",
    "naive_bayes_predict": with_(
        *TRAINED,
        "test as (select * from split where split = 'test')",
        words("test", "review_id").replace("words as", "test_words as"),
        doc_terms("review_id", (1, 2), "test_words", "test_terms"),
        weights("train", "test_terms", name="test_weights"),
        """theta as (
  select p.label, v.term, ln((coalesce(sum(w.weight), 0) + 1.0) / (any_value(t.total) + any_value(s.v))) as log_theta
  from prior p join totals t on t.label = p.label cross join size s cross join vocab v
  left join weights w on w.sentiment_label = p.label and w.term = v.term group by 1, 2)""",
        """joint as (
  select d.review_id, p.label, any_value(p.log_prior) + coalesce(sum(x.weight * th.log_theta), 0) as score
  from test d cross join prior p left join test_weights x on x.review_id = d.review_id
  left join theta th on th.label = p.label and th.term = x.term group by 1, 2)""",
    )
    + """select j.review_id, t.sentiment_label as true_label, j.label as predicted_label, round(j.score, 6) as score
from joint j join test t on t.review_id = j.review_id
qualify row_number() over (partition by j.review_id order by j.score desc, j.label) = 1""",
    "multilabel_majority": with_(REVIEWS, split("reviews", "f_not_english"))
    + "select review_id, "
    + ", ".join(FLAGS)
    + ", "
    + ", ".join(
        f"(select case when avg({f}) >= 0.5 then 1 else 0 end from split where split = 'train') as pred_{f}" for f in FLAGS
    )
    + " from split where split = 'test'",
    "label_set_strings": with_(REVIEWS, flag_preds())
    + f"select review_id, {label_set('true_')} as true_labels, {label_set('pred_')} as predicted_labels from flagged",
    "run_guard": with_(*BASE, split("labelled", "sentiment_label"), """g as (
  select course_id, lang, count(distinct sentiment_label) filter (where split = 'train') as train_classes,
    count(*) filter (where split = 'test') as test_rows, count(*) as documents from split group by 1, 2)""")
    + """select *, case when train_classes >= 2 and test_rows > 0 then 'run' else 'not_run' end as sentiment_status,
  case when train_classes >= 2 and test_rows > 0 then '' else 'Not enough labeled classes for sentiment classification.' end
    as sentiment_notes,
  case when documents >= 20 then 'run' else 'not_run' end as topic_status,
  case when documents >= 20 then '' else 'Not enough documents for topic modeling.' end as topic_notes from g""",
    "metrics_sentiment": f"{metrics_part('sentiment_label', '3class')} union all {metrics_part('label_5class', '5class')}",
    "confusion_matrix": with_(*BASE, predictions("sentiment_label")) + matrix(),
    "metrics_multilabel": with_(REVIEWS, flag_preds(), flag_rows()) + FLAG_METRICS,
    "per_label_report": with_(REVIEWS, flag_preds(), flag_rows())
    + """select 'stub flags' as model, label, round(p, 6) as precision, round(r, 6) as recall, round(f, 6) as f1_score,
  cast(support as bigint) as support from per_flag""",
    "best_model_confusion": with_(*BASE, predictions("sentiment_label"))
    + matrix(
        """where model = (select model from preds group by model
    order by avg(case when true_label = predicted_label then 1.0 else 0.0 end) desc, model limit 1)"""
    ),
    "model_comparison_long": with_(
        *BASE, predictions("sentiment_label"), SCORES, flag_preds(), flag_rows(), f"fm as ({FLAG_METRICS})"
    )
    + """select model, 'sentiment_macro_f1' as metric, round(avg(f), 6) as value from prf group by model
union all select model, 'multilabel_macro_f1', macro_f1 from fm
union all select model, 'multilabel_micro_f1', micro_f1 from fm""",
    "topic_keywords": with_(*TOPIC_BASE, *TOPIC_KEYWORDS) + "select * from keywords",
    "topic_representative": with_(*TOPIC_BASE, REPRESENTATIVES) + "select * from reps",
    "topic_summary": with_(*TOPIC_BASE, *TOPIC_KEYWORDS, REPRESENTATIVES, profile(TOPICS + 1), joined_keywords(10, "k"))
    + f"""select p.topic_id, coalesce(k.keywords, '') as keywords, p.document_count,
  coalesce(r.representative, '') as representative_comment, p.dominant_sentiment, p.negative_ratio,
  round((select count(distinct term) / count(*) from keywords), 6) as topic_diversity,
  '{settings.BERTOPIC_STATUS}' as bertopic_status, '{settings.TOPIC_NOTE}' as notes
from profile p left join k on k.topic_id = p.topic_id left join reps r on r.topic_id = p.topic_id""",
    "issue_action": with_(
        REVIEWS,
        """texts as (select 'documents' as source_dataset, review_id as row_id, review_text as text from reviews
  union all select 'pages', page_id, html from pages)""",
    )
    + f"select source_dataset, row_id, {issue('text', 1)} as issue, {issue('text', 2)} as action from texts",
    "topic_diversity": with_(*TOPIC_BASE, *TOPIC_KEYWORDS)
    + "select round(count(distinct term) / count(*), 6) as topic_diversity from keywords",
    "document_topics": with_(*TOPIC_BASE)
    + "select review_id, clean_text, topic_id, sentiment_label, course_id from topic_docs",
    "topic_sentiment": with_(*TOPIC_BASE)
    + "select topic_id, sentiment_label, count(*) as document_count from topic_docs group by 1, 2",
    "topic_sentiment_pivot": with_(*TOPIC_BASE)
    + "select topic_id, "
    + ", ".join(f"count(*) filter (where sentiment_label = '{c}') as {c}" for c in settings.THREE_CLASSES)
    + " from topic_docs group by topic_id",
    "improvement_matrix": with_(
        *TOPIC_BASE, *TOPIC_KEYWORDS, REPRESENTATIVES, profile(TOPICS), joined_keywords(6, "k6"), joined_keywords(10, "k10")
    )
    + f"""select p.topic_id, k6.keywords, p.dominant_sentiment, p.negative_ratio, r.representative as representative_comments,
  {issue('k10.keywords', 1)} as likely_teaching_issue, {issue('k10.keywords', 2)} as suggested_teaching_improvement_action
from profile p join k6 on k6.topic_id = p.topic_id join k10 on k10.topic_id = p.topic_id
join reps r on r.topic_id = p.topic_id""",
    "error_taxonomy": " union all ".join(
        f"""({with_(*BASE, predictions(label))} select model, review_id, true_label, predicted_label,
  {error_type('review_text')} as error_type from preds where true_label <> predicted_label)"""
        for label in ("sentiment_label", "label_5class")
    ),
    "label_set_mismatch": with_(
        REVIEWS,
        flag_preds(),
        f"sets as (select review_id, {label_set('true_')} as true_labels, {label_set('pred_')} as predicted_labels from flagged)",
    )
    + "select * from sets where true_labels <> predicted_labels",
    "error_cases_topn": with_(*BASE, predictions("sentiment_label"))
    + f"""select 'sentiment' as task, model, course_id, review_text as clean_text, true_label, predicted_label,
  {error_type('review_text')} as error_type, {_quote(settings.SENTIMENT_ERROR_NOTE)} as analysis_note
from preds where true_label <> predicted_label
qualify row_number() over (partition by model order by review_id) <= {settings.MAX_ERROR_CASES}""",
    "error_type_counts": with_(*BASE, predictions("label_5class"))
    + f"""select model, {error_type('review_text')} as error_type, count(*) as cases from preds
where true_label <> predicted_label group by 1, 2""",
    "data_summary": with_(
        REVIEWS,
        SOURCES,
        f"""kept as (select source_dataset, count(*) as n from (
  select source_dataset, row_number() over (partition by t order by row_key) as copy from
    (select *, {cleaned('review_text')} as t from sources) where t <> '') where copy = 1 group by 1)""",
    )
    + """select 'full' as mode, s.source_dataset as dataset_id, 'given table' as source_platform,
  case when s.source_dataset <> 'benchmark' then s.source_dataset || ' licence' else '' end as license,
  '' as license_status, count(*) as raw_rows_loaded, coalesce(any_value(k.n), 0) as cleaned_rows_used,
  case when count(label_raw) > 0 then 'explicit_label' else 'none' end as sentiment_source,
  count(label_raw) > 0 as sentiment_available
from sources s left join kept k on k.source_dataset = s.source_dataset group by s.source_dataset""",
    "course_sentiment_top40": with_(*BASE, EXPERIMENT)
    + f"""select course_id, sentiment_label, count(*) as count from experiment
where course_id is not null group by 1, 2 order by count desc, course_id, sentiment_label
limit {settings.COURSE_CHART_ROWS}""",
}
