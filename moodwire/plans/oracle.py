"""DuckDB twins of the registered queries (views of the given tables are registered
by the checker). Column names and types match the Spark results."""

from __future__ import annotations

from moodwire.functions import rules
from moodwire.plans import catalog
from moodwire.plans import oracle_text as O
from moodwire.sources.tables import PLANTED_TAILS

_TAIL_CASE = " ".join(f"WHEN {i} THEN {O.lit(t)}" for i, t in enumerate(PLANTED_TAILS))

TWEETS = f"""tweets AS (
  SELECT doc_id AS tweet_id,
         text || CASE ((doc_id % {len(PLANTED_TAILS)}) + {len(PLANTED_TAILS)}) % {len(PLANTED_TAILS)} {_TAIL_CASE} END AS text,
         lang,
         ((doc_id % 5) + 5) % 5 = 0 AS is_retweet,
         TIMESTAMP '{catalog.tables.STREAM_START}' + to_seconds(doc_id) AS ts
  FROM documents)"""

LABELLED = f"""labelled AS (
  SELECT *, CAST({O.distant_label('text')} AS DOUBLE) AS label FROM tweets)"""

BASE = f"WITH {TWEETS},\n{LABELLED}"

_TRACKED = O.contains_any("text", rules.TRACKED_TERMS)
_POS = O.contains_any("text", rules.POSITIVE_TERMS)
_NEG = O.contains_any("text", rules.NEGATIVE_TERMS)
_BUCKET = "((('0x' || substr(md5(CAST(tweet_id AS VARCHAR)), 1, 8))::BIGINT % 100) + 100) % 100"
_SPLIT = f"CASE WHEN {_BUCKET} < 80 THEN 'train' ELSE 'test' END"
_FIXTURE = "CAST((((tweet_id * 37) % 101 + 101) % 101) AS DOUBLE) / 100.0"
_HALF = catalog.CAP_TARGET // 2
_STRIPPED = "text"
for _term in rules.TRACKED_TERMS:
    _STRIPPED = f"replace({_STRIPPED}, {O.lit(_term)}, '')"


def _java_index(t: str, n: int) -> str:
    unsigned = (f"(CASE WHEN {t} = '' THEN 0::BIGINT ELSE list_reduce(list_transform(string_split({t}, ''), "
                f"lambda ch: ord(ch)::BIGINT), lambda a, x: (a * 31 + x) % 4294967296, 0::BIGINT) END)")
    signed = f"(CASE WHEN {unsigned} >= 2147483648 THEN {unsigned} - 4294967296 ELSE {unsigned} END)"
    return f"CAST((({signed} % {n}) + {n}) % {n} AS INTEGER)"


TOKENIZED = f"""normalized AS (
  SELECT tweet_id, {O.default_normalized('text')} AS norm FROM labelled),
tokenized AS (
  SELECT tweet_id, {O.default_tokens_from_normalized('norm')} AS tokens FROM normalized)"""

JAVA_TF = f"""tok AS (SELECT tweet_id, unnest(tokens) AS t FROM tokenized),
hashed AS (SELECT tweet_id, {_java_index('t', rules.ONLINE_FEATURES)} AS idx FROM tok),
counted AS (SELECT tweet_id, idx, CAST(count(*) AS DOUBLE) AS val FROM hashed GROUP BY tweet_id, idx),
tf AS (SELECT tweet_id, list(idx ORDER BY idx) AS idx, list(val ORDER BY idx) AS val FROM counted GROUP BY tweet_id)"""

DOC_FREQ = f"""dfreq AS (SELECT idx, count(*) AS df FROM counted GROUP BY idx),
m AS (SELECT count(*) AS m FROM tokenized),
idf AS (SELECT idx, ln(((SELECT m FROM m) + 1.0)::DOUBLE / (df + 1)) AS idf FROM dfreq)"""

TF_IDF = f"""weighted AS (
  SELECT c.tweet_id, c.idx, c.val * coalesce(idf.idf, ln((SELECT m + 1.0 FROM m)::DOUBLE)) AS val
  FROM counted c LEFT JOIN idf USING (idx))"""

FIXTURE_SCORED = f"""fixture_scored AS (
  SELECT 'batch' AS model, tweet_id, {_FIXTURE} AS prediction, label FROM labelled
  UNION ALL
  SELECT 'online' AS model, tweet_id, CASE WHEN {_NEG} THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS prediction, label
  FROM labelled)"""

STATS = f"""stats AS (
  SELECT model AS trainer, CAST(((tweet_id % {catalog.STAT_VERSIONS}) + {catalog.STAT_VERSIONS}) % {catalog.STAT_VERSIONS} AS BIGINT) AS model_version,
         avg(CASE WHEN (CASE WHEN prediction < 0.5 THEN 0.0 ELSE 1.0 END) = label THEN 1.0 ELSE 0.0 END)::DOUBLE AS accuracy,
         count(*) AS n
  FROM fixture_scored GROUP BY 1, 2)"""

STREAMED = f"""streamed AS (
  SELECT * FROM labelled WHERE {_TRACKED} AND lang = 'en' AND NOT is_retweet)"""


def _stream_corpus_cte() -> str:
    from moodwire.plans.models import STREAM_RANGES

    return f"""{STREAMED},
bounds AS (SELECT min(tweet_id) AS lo, max(tweet_id) AS hi FROM tweets),
capped AS (
  SELECT tweet_id, label FROM (
    SELECT tweet_id, label, row_number() OVER (PARTITION BY label ORDER BY ts, tweet_id) AS r FROM streamed)
  WHERE r <= {_HALF}),
stream_corpus AS (
  SELECT tweet_id, label,
         CAST(least(floor((tweet_id - (SELECT lo FROM bounds)) * {STREAM_RANGES}
                          / ((SELECT hi FROM bounds) - (SELECT lo FROM bounds) + 1)), {STREAM_RANGES} - 1) AS BIGINT)
           AS batch_id
  FROM capped)"""


def _sgd_sql(steps: int, start: str) -> str:
    """Unrolled gradient steps over all labelled tweets, weights rounded to 6 places."""
    from moodwire.plans.models import NOTEBOOK_REG

    n = "(SELECT count(*) FROM labelled)"
    parts = [f"{BASE},\n{TOKENIZED},\n{JAVA_TF}",
             f"w0 AS (SELECT CAST(j AS INTEGER) AS idx, CAST({start} AS DOUBLE) AS w FROM range({rules.ONLINE_FEATURES}) r(j))"]
    for i in range(1, steps + 1):
        eta = rules.SGD_STEP / i**0.5
        parts.append(f"""margin{i} AS (SELECT tweet_id, sum(val * w) AS m FROM counted JOIN w{i - 1} USING (idx) GROUP BY tweet_id),
grad{i} AS (SELECT idx, sum(val * (1 / (1 + exp(-m)) - label)) AS g
           FROM counted JOIN margin{i} USING (tweet_id) JOIN labelled USING (tweet_id) GROUP BY idx),
w{i} AS (SELECT idx, w * (1 - {eta!r}::DOUBLE * {NOTEBOOK_REG}) - {eta!r}::DOUBLE * coalesce(g, 0) / {n} AS w
        FROM w{i - 1} LEFT JOIN grad{i} USING (idx))""")
    return ",\n".join(parts) + f"\nSELECT idx AS bucket, round(w, 6) AS weight FROM w{steps}"


def _stream_ranges() -> str:
    from moodwire.plans.models import STREAM_RANGES

    return f"""{STREAMED},
bounds AS (SELECT min(tweet_id) AS lo, max(tweet_id) AS hi FROM tweets),
versions AS (
  SELECT CAST(least(floor((tweet_id - (SELECT lo FROM bounds)) * {STREAM_RANGES}
                          / ((SELECT hi FROM bounds) - (SELECT lo FROM bounds) + 1)), {STREAM_RANGES} - 1) AS BIGINT)
           AS version, count(*) AS rows
  FROM streamed GROUP BY 1)"""


def _fixed_evaluations(upto: str, extra: str = "") -> str:
    """Fixed weights on term counts of the hold-out: per evaluation the area, accuracy and size over the batches up to ``upto``."""
    from moodwire.plans.models import HOLDOUT_BATCHES

    return f"""{BASE},
{TOKENIZED},
{JAVA_TF},
w AS (SELECT CAST(i AS INTEGER) AS idx, (((7 * i) % 13) - 6)::DOUBLE / 1024 AS w FROM range({rules.ONLINE_FEATURES}) t(i)),
margins AS (SELECT tweet_id, sum(val * w) AS score FROM counted JOIN w USING (idx) GROUP BY tweet_id),
scored AS (SELECT coalesce(score, 0) AS score, label, tweet_id % {HOLDOUT_BATCHES} AS batch
           FROM labelled LEFT JOIN margins USING (tweet_id) WHERE {_SPLIT} = 'test'),
ticks AS (SELECT evaluation FROM range({HOLDOUT_BATCHES + 1}) t(evaluation)),
sc AS (SELECT evaluation, score, sum((label > 0.5)::INT) AS pos, sum((label <= 0.5)::INT) AS neg,
              sum((CASE WHEN score > 0 THEN label > 0.5 ELSE label <= 0.5 END)::INT) AS hit
       FROM ticks JOIN scored ON batch <= {upto} GROUP BY 1, 2),
cum AS (SELECT *, sum(pos) OVER (PARTITION BY evaluation ORDER BY score DESC) AS cum_pos FROM sc)
SELECT {extra}7::BIGINT AS model_version,
       round(sum(neg * (cum_pos - pos * 0.5)) / (sum(pos) * sum(neg)), 9)::DOUBLE AS area_under_roc,
       round(sum(hit)::DOUBLE / sum(pos + neg), 9) AS accuracy, sum(pos + neg)::BIGINT AS n
FROM cum GROUP BY evaluation"""


_HITS = (f"SELECT tweet_id FROM tweets WHERE lang = 'en' AND NOT is_retweet AND contains(lower(text), "
         f"'{catalog.SEARCH_KEYWORD}') ORDER BY ts DESC, tweet_id LIMIT {rules.SEARCH_LIMIT}")

_FIXED_CLASSES = f"""{BASE},
hits AS ({_HITS}),
hit_tweets AS (SELECT tweet_id, text FROM tweets JOIN hits USING (tweet_id)),
normalized AS (SELECT tweet_id, {O.default_normalized('text')} AS norm FROM hit_tweets),
tokenized AS (SELECT tweet_id, {O.default_tokens_from_normalized('norm')} AS tokens FROM normalized),
{JAVA_TF},
w AS (SELECT CAST(i AS INTEGER) AS idx, (((7 * i) % 13) - 6)::DOUBLE / 1024 AS w FROM range({rules.ONLINE_FEATURES}) t(i)),
margins AS (SELECT tweet_id, sum(val * w) AS margin FROM counted JOIN w USING (idx) GROUP BY tweet_id),
classified AS (
  SELECT 'batch' AS model, tweet_id, text AS tweet, CASE WHEN {_FIXTURE} > 0.5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction
  FROM hit_tweets
  UNION ALL
  SELECT 'online', tweet_id, text, CASE WHEN coalesce(margin, 0) > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END
  FROM hit_tweets LEFT JOIN margins USING (tweet_id))"""

_CSV_CORPUS = f"""{BASE}
SELECT text, CASE WHEN {_POS} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS label FROM tweets WHERE {_POS} OR {_NEG}"""


def _text_sql(fn) -> str:
    return f"{BASE}\nSELECT tweet_id, {fn('text')} AS normalized FROM tweets"


def _tok_sql(expr: str) -> str:
    return f"{BASE}\nSELECT tweet_id, {expr} AS tokens FROM tweets"


SQL: dict[str, str] = {
    "stream_filter": f"{BASE}\nSELECT tweet_id, text FROM tweets WHERE lang = 'en' AND NOT is_retweet",
    "stream_tracked": f"{BASE}\nSELECT tweet_id, lang, is_retweet FROM tweets WHERE {_TRACKED}",
    "distant_label": f"{BASE}\nSELECT tweet_id, label FROM labelled",
    "sentiment_flags": f"{BASE}\nSELECT tweet_id, {_POS} AS is_positive, {_NEG} AS is_negative, "
                       f"NOT {_POS} AND NOT {_NEG} AS is_neutral FROM tweets",
    "label_recode": f"""{BASE},
coded AS (SELECT tweet_id, CASE WHEN {_POS} THEN '4' WHEN {_NEG} THEN '0' ELSE '2' END AS polarity FROM tweets)
SELECT tweet_id, CASE polarity WHEN '0' THEN 0.0::DOUBLE WHEN '4' THEN 1.0::DOUBLE END AS label
FROM coded WHERE polarity IN ('0', '4')""",
    "class_split": f"{BASE}\nSELECT tweet_id, CASE WHEN label = 1.0 THEN 'positive' ELSE 'negative' END AS class FROM labelled",
    "corpus_union": f"{BASE}\nSELECT tweet_id, label FROM labelled WHERE label = 1.0 "
                    f"UNION ALL SELECT tweet_id, label FROM labelled WHERE label = 0.0",
    "sentiment_decision": f"{BASE}\nSELECT tweet_id, {_FIXTURE} AS prediction, "
                          f"CASE WHEN {_FIXTURE} < {rules.DISPLAY_THRESHOLD} THEN 'negative' ELSE 'positive' END "
                          f"AS decision FROM tweets",
    "keyword_search": f"{BASE}\nSELECT tweet_id, text FROM tweets WHERE lang = 'en' AND NOT is_retweet "
                      f"AND contains(lower(text), '{catalog.SEARCH_KEYWORD}') ORDER BY ts DESC, tweet_id "
                      f"LIMIT {rules.SEARCH_LIMIT}",
    "corpus_count": f"{BASE}\nSELECT count(*) AS n FROM labelled",
    "class_counts": f"{BASE}\nSELECT label, count(*) AS n FROM labelled GROUP BY label",
    "hash_split": f"{BASE}\nSELECT tweet_id, {_SPLIT} AS split FROM tweets",
    "label_distribution": f"{BASE}\nSELECT {_SPLIT} AS split, label, count(*) AS n FROM labelled GROUP BY 1, 2",
    "majority_baseline": f"{BASE}\nSELECT greatest(avg(label), 1 - avg(label)) AS baseline FROM labelled "
                         f"WHERE {_SPLIT} = 'test'",
    "balanced_cap": f"""{BASE},
{STREAMED}
SELECT tweet_id, label FROM (
  SELECT tweet_id, label, row_number() OVER (PARTITION BY label ORDER BY ts, tweet_id) AS r FROM streamed)
WHERE r <= {_HALF}""",
    "corpus_progress": f"""{BASE},
{STREAMED},
per_batch AS (
  SELECT CAST(floor(tweet_id / {catalog.STREAM_BATCH}) AS BIGINT) AS batch_id,
         CAST(sum(label) AS BIGINT) AS pos, CAST(sum(1 - label) AS BIGINT) AS neg
  FROM streamed GROUP BY 1),
cum AS (
  SELECT batch_id, pos, neg,
         sum(pos) OVER (ORDER BY batch_id) AS cum_pos, sum(neg) OVER (ORDER BY batch_id) AS cum_neg
  FROM per_batch)
SELECT batch_id, CAST(least(cum_pos, {_HALF}) AS BIGINT) AS positives, CAST(least(cum_neg, {_HALF}) AS BIGINT) AS negatives
FROM cum WHERE NOT (cum_pos - pos >= {_HALF} AND cum_neg - neg >= {_HALF})""",
    "sentiment_summary": f"""{BASE},
{FIXTURE_SCORED},
agg AS (
  SELECT model, CAST(sum(CASE WHEN prediction < {rules.DISPLAY_THRESHOLD} THEN 1 ELSE 0 END) AS BIGINT) AS negative,
         CAST(sum(CASE WHEN prediction < {rules.DISPLAY_THRESHOLD} THEN 0 ELSE 1 END) AS BIGINT) AS positive
  FROM fixture_scored GROUP BY model)
SELECT model, negative, positive,
       CASE WHEN negative > positive THEN 'negative' ELSE 'positive' END AS sentiment,
       floor((CASE WHEN negative > positive THEN negative ELSE positive END)::DOUBLE / (negative + positive) * 10000 + 0.5) / 100
         AS percent
FROM agg""",
    "normalize_sentiment": _text_sql(O.normalize_sentiment),
    "normalize_shortforms": _text_sql(O.normalize_shortforms),
    "normalize_noise": _text_sql(O.normalize_noise),
    "normalize_noise_https": _text_sql(lambda e: O.normalize_noise(e, https=True)),
    "tokens_whitespace": _tok_sql(O.whitespace_unigrams("text")),
    "distant_label_strict": f"""{BASE}
SELECT tweet_id, label, {_STRIPPED} AS text FROM labelled WHERE {_POS} <> {_NEG}""",
    "stem_vocabulary": f"""{BASE},
words AS (SELECT DISTINCT unnest(string_split(lower(text), ' ')) AS word FROM tweets)
SELECT word, {O.stem_words('[word]')}[1] AS stem FROM words""",
    "tokens_unigram": _tok_sql(O.unigrams("text")),
    "tokens_bigram": _tok_sql(O.ngrams("text", 2)),
    "tokens_trigram": _tok_sql(O.ngrams("text", 3)),
    "default_tokens": f"{BASE},\n{TOKENIZED}\nSELECT tweet_id, tokens FROM tokenized",
    "custom_chain": _tok_sql(O.unigrams(O.lower_replace("text", catalog.CUSTOM_DICTIONARY.items()))),
    "vocabulary": f"""{BASE},
{TOKENIZED},
occ AS (SELECT unnest(tokens) AS token FROM tokenized),
dis AS (SELECT unnest(list_distinct(tokens)) AS token FROM tokenized),
tf AS (SELECT token, count(*) AS term_frequency FROM occ GROUP BY token),
df AS (SELECT token, count(*) AS doc_frequency FROM dis GROUP BY token)
SELECT token, term_frequency, doc_frequency FROM tf JOIN df USING (token)""",
    "hashing_tf_java": f"{BASE},\n{TOKENIZED},\n{JAVA_TF}\nSELECT tweet_id, idx, val FROM tf",
    "doc_frequency": f"{BASE},\n{TOKENIZED},\n{JAVA_TF}\nSELECT idx, count(*) AS df FROM counted GROUP BY idx",
    "evaluation_increments": _fixed_evaluations("evaluation", "evaluation, "),
    "evaluation_by_clock": _fixed_evaluations("2 AND evaluation < 2"),
    "statistics_live_feed": f"""{BASE},
{FIXTURE_SCORED},
{STATS}
SELECT trainer, model_version, round(accuracy, 9) AS accuracy, n, model_version < {catalog.STAT_VERSIONS // 2} AS on_subscription
FROM stats WHERE model_version >= {catalog.STAT_VERSIONS // 2}
   OR trainer = 'batch' AND model_version = {catalog.STAT_VERSIONS // 2 - 1}""",
    "stream_corpus": f"{BASE},\n{_stream_corpus_cte()}\nSELECT tweet_id, label, batch_id FROM stream_corpus",
    "stream_progress": f"""{BASE},
{_stream_corpus_cte()},
per AS (SELECT batch_id, CAST(sum(label) AS BIGINT) AS pos, CAST(sum(1 - label) AS BIGINT) AS neg
        FROM stream_corpus GROUP BY batch_id)
SELECT batch_id, CAST(sum(pos) OVER (ORDER BY batch_id) AS BIGINT) AS positives,
       CAST(sum(neg) OVER (ORDER BY batch_id) AS BIGINT) AS negatives FROM per""",
    "sgd_three_steps": _sgd_sql(3, "0"),
    "sgd_warm_start_steps": _sgd_sql(2, "((7 * j) % 13 - 6) / 100.0"),
    "model_versions": f"{BASE},\n{_stream_ranges()}\nSELECT version, rows, CAST({rules.ONLINE_FEATURES} AS INTEGER) AS num_weights FROM versions",
    "model_versions_state": f"{BASE},\n{_stream_ranges()}\nSELECT version, rows, CAST({rules.ONLINE_FEATURES} AS INTEGER) AS num_weights FROM versions",
    "statistics_counts": f"{BASE},\n{_stream_ranges()}\nSELECT 'online' AS trainer, version AS model_version, "
                         f"(SELECT count(*) FROM tweets WHERE {_SPLIT} = 'test') AS n FROM versions",
    "predict_batch_untrained": f"""{BASE},
share AS (SELECT round(avg(label), 9) AS score, avg(label) > 0.5 AS up FROM labelled WHERE {_SPLIT} = 'train')
SELECT tweet_id, CASE WHEN up THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction, score FROM tweets, share WHERE {_SPLIT} = 'test'""",
    "batch_statistics_fixed": f"""{BASE},
held AS (SELECT label, {_FIXTURE} AS score FROM labelled WHERE {_SPLIT} = 'test'),
sc AS (SELECT score, sum((label > 0.5)::INT) AS pos, sum((label <= 0.5)::INT) AS neg,
              sum((CASE WHEN score > 0.5 THEN label > 0.5 ELSE label <= 0.5 END)::INT) AS hit FROM held GROUP BY score),
cum AS (SELECT *, sum(pos) OVER (ORDER BY score DESC) AS cum_pos FROM sc)
SELECT 'batch' AS trainer, 3::BIGINT AS model_version, 'fixture' AS model,
       round(sum(neg * (cum_pos - pos * 0.5)) / (sum(pos) * sum(neg)), 9)::DOUBLE AS area_under_roc,
       round(sum(hit)::DOUBLE / sum(pos + neg), 9) AS accuracy, sum(pos + neg)::BIGINT AS n FROM cum""",
    "classify_fixed": f"{_FIXED_CLASSES}\nSELECT model, tweet_id, tweet, prediction FROM classified",
    "classify_fixed_json": f"""{_FIXED_CLASSES},
listed AS (SELECT model, to_json(list({{'tweet': tweet, 'sentiment': CAST(prediction AS VARCHAR)}} ORDER BY tweet_id)) AS j
           FROM classified GROUP BY model)
SELECT '{{"batchModelResult":' || coalesce(max(j) FILTER (model = 'batch'), '[]') || ',"onlineModelResult":'
       || coalesce(max(j) FILTER (model = 'online'), '[]') || '}}' AS json FROM listed""",
    "batch_latest_model": f"{BASE}\nSELECT tweet_id, 1::BIGINT AS version, true AS same FROM tweets WHERE {_SPLIT} = 'test'",
    "hashing_tf_totals": f"{BASE},\n{TOKENIZED}\nSELECT tweet_id, CAST(len(tokens) AS BIGINT) AS total FROM tokenized",
    "cv_fold_constants": f"""{BASE},
folded AS (SELECT label, CAST(('0x' || substr(md5(CAST(tweet_id AS VARCHAR)), 1, 8))::BIGINT % 3 AS INTEGER) AS fold FROM labelled)
SELECT fold, count(*) AS n, any_value(share) AS low, any_value(share) AS high, 0.5::DOUBLE AS auc
FROM folded JOIN (SELECT f.fold, round(avg(o.label), 9) AS share FROM (SELECT DISTINCT fold FROM folded) f
                  JOIN folded o ON o.fold <> f.fold GROUP BY f.fold) USING (fold) GROUP BY fold""",
    "corpus_csv": _CSV_CORPUS,
    "corpus_csv_escaped": _CSV_CORPUS,
    "corpus_build": _CSV_CORPUS,
    "corpus_build_stream": f"{BASE},\n{_stream_corpus_cte()}\nSELECT t.text, c.label FROM stream_corpus c JOIN tweets t USING (tweet_id)",
    "corpus_dump": f"{BASE},\n{TOKENIZED}\nSELECT t.tokens, l.label FROM tokenized t JOIN labelled l USING (tweet_id)",
    "tweet_features": f"""{BASE},
{TOKENIZED},
{JAVA_TF},
train_ids AS (SELECT tweet_id FROM tweets WHERE {_SPLIT} = 'train'),
df_train AS (SELECT idx, count(*) AS df FROM counted JOIN train_ids USING (tweet_id) GROUP BY idx),
m_train AS (SELECT count(*)::DOUBLE AS m FROM train_ids),
hits AS (SELECT tweet_id FROM tweets WHERE lang = 'en' AND NOT is_retweet
         AND contains(lower(text), '{catalog.SEARCH_KEYWORD}') ORDER BY ts DESC, tweet_id LIMIT {rules.SEARCH_LIMIT}),
weighted_hits AS (
  SELECT c.tweet_id, c.idx, c.val * ln(((SELECT m FROM m_train) + 1) / (coalesce(df_train.df, 0) + 1)) AS val
  FROM counted c JOIN hits USING (tweet_id) LEFT JOIN df_train USING (idx))
SELECT tweet_id, list(idx ORDER BY idx) AS idx, list(round(val, 9) ORDER BY idx) AS val
FROM weighted_hits GROUP BY tweet_id""",
    "tf_idf": f"""{BASE},
{TOKENIZED},
{JAVA_TF},
{DOC_FREQ},
{TF_IDF}
SELECT tweet_id, list(idx ORDER BY idx) AS idx, list(round(val, 9) ORDER BY idx) AS val FROM weighted GROUP BY tweet_id""",
    "auc_roc": f"""{BASE},
{FIXTURE_SCORED},
sc AS (SELECT prediction AS score, sum(CASE WHEN label > 0.5 THEN 1 ELSE 0 END) AS pos,
              sum(CASE WHEN label > 0.5 THEN 0 ELSE 1 END) AS neg
       FROM fixture_scored WHERE model = 'batch' GROUP BY 1),
cum AS (SELECT pos, neg, sum(pos) OVER (ORDER BY score DESC) AS cum_pos FROM sc)
SELECT round(CASE WHEN sum(pos) * sum(neg) <> 0 THEN sum(neg * (cum_pos - pos * 0.5)) / (sum(pos) * sum(neg)) END, 9)::DOUBLE
  AS auc_roc FROM cum""",
    "auc_pr": f"""{BASE},
{FIXTURE_SCORED},
sc AS (SELECT prediction AS score, sum(CASE WHEN label > 0.5 THEN 1 ELSE 0 END) AS pos,
              sum(CASE WHEN label > 0.5 THEN 0 ELSE 1 END) AS neg
       FROM fixture_scored WHERE model = 'batch' GROUP BY 1),
cum AS (SELECT pos, neg, sum(pos) OVER (ORDER BY score DESC) AS tp, sum(neg) OVER (ORDER BY score DESC) AS fp FROM sc),
pts AS (SELECT pos, tp::DOUBLE / (tp + fp) AS prec,
               CASE WHEN (tp - pos) + (fp - neg) = 0 THEN tp::DOUBLE / (tp + fp)
                    ELSE (tp - pos)::DOUBLE / ((tp - pos) + (fp - neg)) END AS prev FROM cum)
SELECT round(CASE WHEN sum(pos) <> 0 THEN sum(pos * (prec + prev) / 2) / sum(pos) END, 9)::DOUBLE AS auc_pr FROM pts""",
    "accuracy": f"""{BASE},
{FIXTURE_SCORED}
SELECT avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END)::DOUBLE AS accuracy, count(*) AS n
FROM fixture_scored WHERE model = 'online'""",
    "precision_recall": f"""{BASE},
{FIXTURE_SCORED},
cm AS (SELECT label, prediction, count(*) AS c FROM fixture_scored WHERE model = 'online' GROUP BY 1, 2),
classes AS (SELECT label AS class FROM cm UNION SELECT prediction FROM cm),
per AS (
  SELECT class,
         coalesce((SELECT sum(c) FROM cm WHERE label = class AND prediction = class), 0) AS tp,
         coalesce((SELECT sum(c) FROM cm WHERE label = class), 0) AS actual,
         coalesce((SELECT sum(c) FROM cm WHERE prediction = class), 0) AS predicted
  FROM classes)
SELECT class, CASE WHEN predicted <> 0 THEN tp::DOUBLE / predicted END AS precision,
       CASE WHEN actual <> 0 THEN tp::DOUBLE / actual END AS recall FROM per
UNION ALL
SELECT NULL::DOUBLE, sum(CASE WHEN label = prediction THEN c ELSE 0 END)::DOUBLE / sum(c),
       sum(CASE WHEN label = prediction THEN c ELSE 0 END)::DOUBLE / sum(c) FROM cm""",
    "latest_statistics": f"""{BASE},
{FIXTURE_SCORED},
{STATS}
SELECT trainer, max_by(model_version, model_version) AS model_version, max_by(accuracy, model_version) AS accuracy,
       max_by(n, model_version) AS n
FROM stats GROUP BY trainer""",
    "accuracy_history": f"""{BASE},
{FIXTURE_SCORED},
{STATS}
SELECT trainer, model_version, row_number() OVER (PARTITION BY trainer ORDER BY model_version) AS point,
       floor(accuracy * 10000 + 0.5) / 100 AS accuracy_percent FROM stats""",
    "predict_online": f"""{BASE},
{TOKENIZED},
{JAVA_TF},
{DOC_FREQ},
{TF_IDF},
w AS (SELECT CAST(i AS INTEGER) AS idx, ((((7 * i) % 13) - 6) / 10.0)::DOUBLE AS w FROM range({rules.ONLINE_FEATURES}) t(i)),
margins AS (SELECT tweet_id, sum(val * w) AS margin FROM weighted JOIN w USING (idx) GROUP BY tweet_id)
SELECT tweet_id, CASE WHEN 1.0 / (1.0 + exp(-margin)) > 0.5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction
FROM margins""",
}
