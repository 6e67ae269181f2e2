"""Reference SQL (DuckDB dialect) for every registered query.

Written independently of the Spark plans: the label step is the plain range
join with the earliest window per review, windows are enumerated as
``date_trunc('minute', t) - i minutes`` for i in 0..9, percentiles use
``quantile_cont``. Tables ``events documents labels`` are views.
"""

from __future__ import annotations

from shoal.config import ORGANIC_COLUMNS, QUARANTINED_COLUMNS
from shoal.functions.numeric import sql_round_half as R

REVIEWS = """reviews AS (
  SELECT cast(e.event_id AS varchar) AS review_id,
         cast(e.event_id % 997 AS varchar) AS user_id,
         cast(e.user_id AS varchar) AS business_id,
         CASE WHEN e.event_id % 101 = 0 THEN NULL
              WHEN e.user_id % 4 = 0 THEN (CASE WHEN e.event_id % 33 = 0 THEN 2 ELSE 1 END)
              WHEN e.user_id % 4 = 1 THEN 3
              ELSE cast(1 + (e.event_id * 7 + cast(floor(e.value) AS bigint)) % 5 AS int) END AS stars,
         d.text AS text,
         make_timestamp(1704067200000000 + (epoch_us(e.ts) - 1704067200000000) // 720) AS event_time,
         make_timestamp(1704067200000000 + (epoch_us(e.ts) - 1704067200000000) // 720
                        + (1 + e.event_id % 90) * 1000000) AS ingestion_time,
         CASE WHEN (e.user_id % 4 = 0 AND e.event_id % 10 < 9)
                OR (e.user_id % 4 = 2 AND e.event_id % 50 = 0) THEN true END AS is_injected,
         cast(CASE WHEN e.value < 30 THEN 0 ELSE 1 END AS double) AS sentiment_label
  FROM events e LEFT JOIN documents d ON d.doc_id = e.event_id % (SELECT count(*) FROM documents))"""

STATS = """wexp AS (
  SELECT business_id, stars, date_trunc('minute', event_time) - to_minutes(cast(i AS integer)) AS window_start
  FROM reviews, range(10) t(i)
  WHERE business_id IS NOT NULL AND event_time IS NOT NULL AND review_id IS NOT NULL),
wagg AS (
  SELECT business_id, window_start, window_start + INTERVAL 10 MINUTE AS window_end,
         count(*) AS review_count, cast(count(stars) AS double) AS n,
         cast(sum(stars) AS double) AS s, cast(sum(stars * stars) AS double) AS ss,
         count(*) FILTER (WHERE stars <= 2) AS neg_count
  FROM wexp GROUP BY business_id, window_start),
stats AS (
  SELECT business_id, window_start, window_end, review_count,
         s / nullif(n, 0) AS avg_stars,
         sqrt((n * ss - s * s) / nullif(n * (n - 1.0), 0)) AS std_stars,
         neg_count
  FROM wagg),
classified AS (
  SELECT *, CASE WHEN review_count > 8 AND avg_stars < 2.5 THEN 'HIGH_VELOCITY_NEGATIVE'
                 WHEN review_count > 8 AND std_stars < 0.8 AND avg_stars < 3.5 THEN 'COORDINATED_UNIFORM_RATING'
                 WHEN review_count >= 5 AND cast(neg_count AS double) / review_count > 0.8 THEN 'NEGATIVE_RATIO_SPIKE'
                 ELSE 'NONE' END AS anomaly_reason
  FROM stats),
flagged AS (
  SELECT business_id, window_start, window_end, review_count AS window_review_count,
         avg_stars AS window_avg_stars, std_stars AS window_std_stars, anomaly_reason
  FROM classified WHERE anomaly_reason <> 'NONE')"""

LABELLED = """labelled AS (
  SELECT r.*, CASE WHEN f.window_start IS NULL THEN 'organic' ELSE 'quarantined' END AS label,
         f.window_start, f.window_end, f.window_review_count, f.window_avg_stars,
         f.window_std_stars, f.anomaly_reason
  FROM reviews r LEFT JOIN flagged f
    ON r.business_id = f.business_id AND r.event_time >= f.window_start
   AND r.event_time <= f.window_end + INTERVAL 2 MINUTE
  WHERE r.review_id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY r.review_id ORDER BY f.window_start NULLS LAST, r.event_time NULLS LAST, r.business_id) = 1),
organic AS (SELECT {o} FROM labelled WHERE label = 'organic'),
quarantined AS (SELECT {q} FROM labelled WHERE label = 'quarantined')""".format(
    o=", ".join(ORGANIC_COLUMNS), q=", ".join(QUARANTINED_COLUMNS))

INJ = "coalesce(is_injected, false)"


def ratio(a: str, b: str) -> str:
    return f"(cast({a} AS double) / nullif(cast({b} AS double), 0))"


def with_(*parts: str, body: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n" + body


def detect_sql(body: str) -> str:
    return with_(REVIEWS, STATS, LABELLED, body=body)


LAT_US = "(epoch_us(ingestion_time) - epoch_us(event_time))"


def _latency_sql(src: str, cohorts: tuple[str, ...]) -> str:
    """Latency block of each cohort of ``src`` (cohort, event_time, ingestion_time)."""
    us = "1000000.0"
    pct = ", ".join(f"{R(f'quantile_cont(lat_us, {p}) / {us}', 3)} AS {n}_seconds"
                    for n, p in (("p50", 0.5), ("p90", 0.9), ("p95", 0.95), ("p99", 0.99)))
    listed = ", ".join(f"('{c}')" for c in cohorts)
    return f"""SELECT k.cohort, coalesce(v.count, 0) AS count, mean_seconds, median_seconds, std_seconds, min_seconds, max_seconds,
         p50_seconds, p90_seconds, p95_seconds, p99_seconds, coalesce(a.n, 0) - coalesce(v.count, 0) AS excluded,
         CASE WHEN v.count IS NULL THEN 'No valid latency measurements' END AS error
  FROM (VALUES {listed}) k(cohort)
  LEFT JOIN (SELECT cohort, count(*) AS n FROM {src} GROUP BY cohort) a USING (cohort)
  LEFT JOIN (SELECT cohort, count(*) AS count,
         {R(f'{ratio("sum(lat_us)", "count(*)")} / {us}', 3)} AS mean_seconds,
         {R(f'quantile_cont(lat_us, 0.5) / {us}', 3)} AS median_seconds,
         {R(f'stddev_pop(cast(lat_us AS double)) / {us}', 3)} AS std_seconds,
         {R(f'min(lat_us) / {us}', 3)} AS min_seconds,
         {R(f'max(lat_us) / {us}', 3)} AS max_seconds, {pct}
    FROM (SELECT cohort, {LAT_US} AS lat_us FROM {src}
          WHERE event_time IS NOT NULL AND ingestion_time IS NOT NULL)
    WHERE lat_us >= 0 AND lat_us < 3600000000 GROUP BY cohort) v USING (cohort)"""


def _throughput_sql(src: str, cohorts: tuple[str, ...]) -> str:
    listed = ", ".join(f"('{c}')" for c in cohorts)
    return f"""SELECT k.cohort, coalesce(total_reviews, 0) AS total_reviews, coalesce(duration_minutes, 0) AS duration_minutes,
         avg_reviews_per_minute, max_reviews_per_minute, min_reviews_per_minute,
         CASE WHEN coalesce(duration_minutes, 0) = 0 THEN 'No timed reviews' END AS throughput_error
  FROM (VALUES {listed}) k(cohort)
  LEFT JOIN (SELECT cohort, sum(c) AS total_reviews, count(*) FILTER (WHERE m IS NOT NULL) AS duration_minutes,
         {R(ratio('sum(c) FILTER (WHERE m IS NOT NULL)', 'count(*) FILTER (WHERE m IS NOT NULL)'), 1)} AS avg_reviews_per_minute,
         max(c) FILTER (WHERE m IS NOT NULL) AS max_reviews_per_minute,
         min(c) FILTER (WHERE m IS NOT NULL) AS min_reviews_per_minute
    FROM (SELECT cohort, date_trunc('minute', ingestion_time) AS m, count(*) AS c FROM {src} GROUP BY ALL)
    GROUP BY cohort) USING (cohort)"""


BOTH = """both_t AS (
  SELECT 'organic' AS predicted, is_injected, ingestion_time, event_time FROM organic
  UNION ALL
  SELECT 'quarantined' AS predicted, is_injected, ingestion_time, event_time FROM quarantined)"""


def _detection_oracles() -> dict[str, str]:
    q: dict[str, str] = {}
    q["window_stats"] = detect_sql(
        "SELECT business_id, window_start, window_end, review_count, avg_stars, std_stars, neg_count FROM stats")
    q["anomaly_rules"] = detect_sql(
        "SELECT business_id, window_start, window_end, review_count, avg_stars, std_stars, neg_count,"
        " anomaly_reason, anomaly_reason <> 'NONE' AS is_anomaly FROM classified")
    q["rule_counts"] = detect_sql(
        "SELECT anomaly_reason, count(*) AS windows FROM classified GROUP BY anomaly_reason")
    q["flagged_windows"] = detect_sql("SELECT * FROM flagged")
    q["label_reviews"] = detect_sql("SELECT * FROM labelled")
    q["organic_reviews"] = detect_sql("SELECT * FROM organic")
    q["quarantined_reviews"] = detect_sql("SELECT * FROM quarantined")
    q["label_summary"] = detect_sql(
        f"SELECT label, {INJ} AS injected, count(*) AS reviews FROM labelled GROUP BY ALL")
    q["eval_precision"] = detect_sql(f"""SELECT true_positives, false_positives, total_quarantined,
         {R(ratio('true_positives', 'total_quarantined'), 4)} AS precision
  FROM (SELECT count(*) FILTER (WHERE {INJ}) AS true_positives,
               count(*) FILTER (WHERE NOT {INJ}) AS false_positives,
               count(*) AS total_quarantined FROM quarantined)""")
    q["eval_recall"] = detect_sql(f"""SELECT caught_count, total_injected,
         {R(ratio('caught_count', 'total_injected'), 4)} AS recall
  FROM (SELECT (SELECT count(*) FROM quarantined WHERE is_injected) AS caught_count,
               (SELECT count(*) FROM organic WHERE is_injected)
             + (SELECT count(*) FROM quarantined WHERE is_injected) AS total_injected)""")
    q["eval_f1"] = detect_sql(f"""SELECT {R('p', 4)} AS precision, {R('r', 4)} AS recall,
         {R('2.0 * p * r / nullif(p + r, 0)', 4)} AS f1_score
  FROM (SELECT {ratio('tp', 'nq')} AS p, {ratio('tp', 'ni')} AS r
        FROM (SELECT (SELECT count(*) FROM quarantined WHERE is_injected) AS tp,
                     (SELECT count(*) FROM quarantined) AS nq,
                     (SELECT count(*) FROM organic WHERE is_injected)
                   + (SELECT count(*) FROM quarantined WHERE is_injected) AS ni))""")
    q["eval_sentiment_accuracy"] = detect_sql(f"""SELECT correct, total, {R(ratio('correct', 'total'), 4)} AS sentiment_accuracy
  FROM (SELECT count(*) FILTER (WHERE (stars <= 2 AND sentiment_label = 0) OR (stars >= 4 AND sentiment_label = 1)) AS correct,
               count(*) AS total FROM organic WHERE stars != 3)""")
    q["attack_timeline"] = detect_sql(f"""SELECT business_id, anomaly_reason, min(event_time) AS attack_start,
         max(event_time) AS attack_end, count(*) AS flagged_count,
         {R(ratio('sum(stars)', 'count(stars)'), 2)} AS avg_stars,
         count(DISTINCT user_id) AS unique_attackers
  FROM quarantined GROUP BY business_id, anomaly_reason ORDER BY attack_start DESC""")
    q["latency_mean"] = detect_sql(
        f"SELECT {R(ratio(f'sum({LAT_US})', f'count({LAT_US})') + ' / 1000000.0', 2)} AS avg_latency_seconds FROM quarantined")
    q["throughput_per_minute"] = detect_sql(f"""SELECT date_trunc('minute', ingestion_time) AS minute_bucket,
         count(*) AS reviews_per_minute
  FROM (SELECT ingestion_time FROM organic UNION ALL SELECT ingestion_time FROM quarantined)
  GROUP BY 1 ORDER BY 1""")
    q["confusion_matrix"] = detect_sql(f"""SELECT predicted, CASE WHEN {INJ} THEN 'injected' ELSE 'organic' END AS actual,
         count(*) AS cnt
  FROM (SELECT 'quarantined' AS predicted, is_injected FROM quarantined
        UNION ALL SELECT 'organic', is_injected FROM organic)
  GROUP BY ALL ORDER BY predicted, actual""")
    q["false_positive_rate"] = detect_sql(f"""SELECT fp AS false_positives, tn AS true_negatives,
         {R(ratio('fp', 'fp + tn'), 4)} AS false_positive_rate
  FROM (SELECT (SELECT count(*) FROM quarantined WHERE NOT {INJ}) AS fp,
               (SELECT count(*) FROM organic WHERE NOT {INJ}) AS tn)""")
    q["detection_delay"] = detect_sql(f"""SELECT business_id, attack_start, detected_at, injected_count,
         {R('(epoch_us(detected_at) - epoch_us(attack_start)) / 1000000.0', 3)} AS detection_delay_seconds
  FROM (SELECT business_id, min(event_time) AS attack_start, min(window_end) AS detected_at,
               count(*) AS injected_count
        FROM (SELECT business_id, event_time, is_injected, CAST(NULL AS timestamp) AS window_end FROM organic
              UNION ALL SELECT business_id, event_time, is_injected, window_end FROM quarantined)
        WHERE {INJ} GROUP BY business_id) ORDER BY business_id""")
    every = "(SELECT 'all' AS cohort, event_time, ingestion_time FROM labelled)"
    q["latency_stats"] = detect_sql(f"SELECT * EXCLUDE (cohort) FROM ({_latency_sql(every, ('all',))})")
    q["throughput_stats"] = detect_sql(f"SELECT * EXCLUDE (cohort) FROM ({_throughput_sql(every, ('all',))})")
    cohorts = ("(SELECT 'organic' AS cohort, event_time, ingestion_time FROM organic"
               " UNION ALL SELECT 'quarantined', event_time, ingestion_time FROM quarantined"
               " UNION ALL SELECT 'combined', event_time, ingestion_time FROM labelled)")
    names = ("organic", "quarantined", "combined")
    q["profile_by_cohort"] = detect_sql(f"SELECT * FROM ({_throughput_sql(cohorts, names)}) t"
                                        f" JOIN ({_latency_sql(cohorts, names)}) l USING (cohort) ORDER BY cohort")
    q["latency_approx"] = detect_sql(f"""SELECT unnest([0.5, 0.95, 0.99])::DOUBLE AS percentile,
         {R(ratio(f'sum({LAT_US})', f'count({LAT_US})') + ' / 1000000.0', 2)} AS avg_latency_seconds, true AS rank_within_bound
  FROM quarantined""")
    base = REVIEWS.replace("reviews AS (", "base AS (", 1)
    damaged = """reviews AS (
  SELECT * REPLACE (CASE WHEN cast(review_id AS bigint) % 211 = 5 THEN NULL
                         WHEN cast(review_id AS bigint) % 59 = 7 THEN cast(cast(review_id AS bigint) + 1 AS varchar)
                         ELSE review_id END AS review_id) FROM base)"""
    q["label_damaged_ids"] = with_(base, damaged, STATS, LABELLED, body="SELECT * EXCLUDE (text) FROM labelled")
    q["damaged_id_rejects"] = with_(base, damaged, body="SELECT 'missing_review_id' AS status, count(*) AS rejects FROM reviews WHERE review_id IS NULL")
    q["star_distribution"] = with_(REVIEWS, body="SELECT stars, count(*) AS n FROM reviews GROUP BY stars ORDER BY stars")
    q["most_reviewed"] = with_(REVIEWS, body="""SELECT business_id, count(*) AS review_count FROM reviews
  WHERE business_id IS NOT NULL GROUP BY business_id ORDER BY review_count DESC, business_id LIMIT 1""")
    return q


# --- ingest ----------------------------------------------------------------
_EID = "cast(review_id AS bigint)"


def _ingest_oracles() -> dict[str, str]:
    q = {}
    e = _EID
    q["parse_reviews"] = with_(REVIEWS, body=f"""SELECT review_id, user_id, business_id, stars, text,
         cast(CASE WHEN {e} % 71 = 11 THEN 3 WHEN {e} % 71 = 12 THEN NULL WHEN {e} % 3 = 0 THEN {e} % 7 END AS integer) AS useful,
         CASE WHEN {e} % 73 = 13 THEN 1 END AS funny, CAST(NULL AS integer) AS cool,
         date_trunc('second', event_time) AS event_time, is_injected
  FROM reviews
  WHERE {e} % 97 <> 5 AND {e} % 89 <> 3 AND {e} % 83 <> 7 AND {e} % 67 <> 19
    AND business_id IS NOT NULL AND review_id IS NOT NULL""")
    q["parse_reject_split"] = with_(REVIEWS, body=f"""SELECT status, count(*) AS lines FROM (
    SELECT CASE WHEN {e} % 97 = 5 THEN 'malformed' WHEN {e} % 89 = 3 THEN 'blank'
                WHEN {e} % 67 = 19 THEN 'missing_review_id'
                WHEN {e} % 83 = 7 THEN 'bad_date' ELSE 'valid' END AS status FROM reviews)
  GROUP BY status""")
    q["keyed_messages"] = with_(REVIEWS, body=f"""SELECT business_id AS key,
         '{{"review_id":"' || review_id || '","user_id":"' || user_id || '","business_id":"' || business_id || '"'
         || coalesce(',"stars":' || cast(stars AS varchar), '')
         || coalesce(',"text":' || cast(to_json(text) AS varchar), '')
         || ',"date":"' || strftime(event_time, '%Y-%m-%d %H:%M:%S') || '"'
         || ',"useful":' || cast({e} % 7 AS varchar) || CASE WHEN {e} % 2 = 0 THEN ',"funny":0' ELSE '' END
         || CASE WHEN is_injected THEN ',"is_injected":true' WHEN NOT is_injected THEN ',"is_injected":false' ELSE '' END
         || '}}' AS value
  FROM reviews""")
    return q


# --- attack overlay ----------------------------------------------------------
def _attacks_sql(src: str) -> str:
    from shoal.operators.overlay import SCENARIOS
    from shoal.plans.catalog import ATTACK_DELAY_MINUTES, ATTACK_PLAN
    plan = ", ".join(f"('{n}', {f}, {k}, {SCENARIOS[n][0]}, {SCENARIOS[n][1]})" for n, f, k in ATTACK_PLAN)
    need = max(f + k for _, f, k in ATTACK_PLAN)

    def h(salt):
        return f"('0x' || substr(md5(seed || '{salt}'), 1, 8))::BIGINT"

    return f"""ranked AS (
  SELECT business_id, row_number() OVER (ORDER BY review_count DESC, business_id) - 1 AS rnk
  FROM (SELECT business_id, count(*) AS review_count FROM {src} WHERE business_id IS NOT NULL
        GROUP BY business_id ORDER BY review_count DESC, business_id LIMIT {need})),
plan(scenario, first_rank, n_targets, burst, dur) AS (VALUES {plan}),
atk0 AS (
  SELECT p.scenario, r.business_id, r.rnk - p.first_rank AS target_order, p.burst, p.dur,
         unnest(range(p.burst)) AS i
  FROM plan p JOIN ranked r ON r.rnk >= p.first_rank AND r.rnk < p.first_rank + p.n_targets),
atk1 AS (SELECT *, concat_ws('|', business_id, scenario, cast(i AS varchar)) AS seed FROM atk0),
atk AS (
  SELECT 'inj-' || scenario || '-' || substr(md5(seed), 1, 16) AS review_id,
         'atk-' || substr(md5(seed || 'u'), 1, 20) AS user_id, business_id,
         CASE WHEN {h('s')} % 33 = 0 THEN 2 ELSE 1 END AS stars,
         make_timestamp(epoch_us((SELECT min(event_time) FROM {src}) + INTERVAL {ATTACK_DELAY_MINUTES} MINUTE)
                        + target_order * dur * 1000000 + i * (dur * 1000000 // burst)) AS event_time,
         true AS is_injected, CAST(NULL AS double) AS sentiment_label
  FROM atk1)"""


def _attack_oracles() -> dict[str, str]:
    q = {}
    base = REVIEWS.replace("reviews AS (", "base AS (", 1)
    allr = """reviews AS (
  SELECT review_id, user_id, business_id, stars, event_time, ingestion_time, is_injected, sentiment_label FROM base
  UNION ALL
  SELECT review_id, user_id, business_id, stars, event_time, event_time, is_injected, sentiment_label FROM atk)"""
    lab = LABELLED.replace("SELECT r.*,", "SELECT r.*, NULL AS text,", 1)
    q["attack_detection"] = with_(base, _attacks_sql("base"), allr, STATS, lab, body=f"""SELECT
         split_part(review_id, '-', 2) AS scenario, count(*) AS injected,
         count(*) FILTER (WHERE label = 'quarantined') AS caught,
         {R(ratio("count(*) FILTER (WHERE label = 'quarantined')", 'count(*)'), 4)} AS recall
  FROM labelled WHERE review_id LIKE 'inj-%' GROUP BY 1""")
    return q


# --- text model and explanations -------------------------------------------
def _stop_list() -> str:
    from shoal.functions.text import english_stop_words
    return "(" + ", ".join("'" + w.replace("'", "''") + "'" for w in english_stop_words()) + ")"


def _tok(text: str) -> str:
    return f"unnest(regexp_extract_all(lower(coalesce({text}, '')), '[\\p{{L}}\\p{{N}}_]{{2,}}'))"


TRAIN = """tr AS (
  SELECT review_id, stars, text, sentiment_label,
         CAST(CASE WHEN stars <= 2 THEN 0.0 ELSE 1.0 END AS double) AS label
  FROM reviews WHERE text IS NOT NULL AND stars != 3)"""


def _uh(salt: str, digits: int = 8) -> str:
    return f"('0x' || substr(md5(concat_ws('|', cast(review_id AS varchar), '42{salt}')), 1, {digits}))::BIGINT"


def _corpus_ctes() -> list[str]:
    return [
        "docs AS (SELECT d.doc_id, d.text, l.quality AS label FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)",
        f"toks AS (SELECT doc_id, {_tok('text')} AS term FROM docs)",
        f"tc AS (SELECT doc_id, term, count(*) AS tf FROM toks WHERE term NOT IN {_stop_list()} GROUP BY doc_id, term)",
        "per_term AS (SELECT term, sum(tf) AS cf, count(*) AS df FROM tc GROUP BY term)",
        """vocab AS (SELECT term, row_number() OVER (ORDER BY cf DESC, term) - 1 AS idx,
         ln(cast(1 + (SELECT count(*) FROM docs) AS double) / cast(1 + df AS double)) + 1.0 AS idf
  FROM per_term QUALIFY idx < 20000)""",
        "tw AS (SELECT tc.doc_id, tc.term, v.idx, tc.tf, (1.0 + ln(cast(tc.tf AS double))) * v.idf AS w FROM tc JOIN vocab v USING (term))",
        "tfidf AS (SELECT doc_id, term, idx, tf, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS weight FROM tw)",
        """coefs AS (SELECT t.term, ln((count(*) FILTER (WHERE d.label = 1) + 1.0) / (count(*) FILTER (WHERE d.label = 0) + 1.0)) AS coef
  FROM tfidf t JOIN docs d USING (doc_id) GROUP BY t.term)""",
    ]


def _explain_ctes() -> list[str]:
    """Contributions and ranks are made once per text; reviews join their text's."""
    return _corpus_ctes() + [
        "contrib AS (SELECT t.doc_id, t.term, c.coef * t.weight AS contribution FROM tfidf t JOIN coefs c USING (term))",
        """qdocs AS (SELECT q.review_id, q.business_id, q.stars, d.doc_id, substring(d.text, 1, 100) AS text_preview
  FROM quarantined q LEFT JOIN documents d ON d.doc_id = cast(q.review_id AS bigint) % (SELECT count(*) FROM documents))""",
        """feats AS (SELECT doc_id, term AS feature, contribution,
         row_number() OVER (PARTITION BY doc_id ORDER BY abs(contribution) DESC, term) AS rank FROM contrib QUALIFY rank <= 5)""",
        "uses AS (SELECT business_id, doc_id, count(*) AS uses FROM qdocs GROUP BY ALL)",
        """imp AS (SELECT business_id, term, sum(uses * abs(contribution)) / n AS imp
  FROM uses JOIN contrib USING (doc_id) JOIN (SELECT business_id, count(*) AS n FROM quarantined GROUP BY business_id) USING (business_id)
  GROUP BY business_id, term, n)""",
        """signals AS (SELECT business_id, term, imp, row_number() OVER (PARTITION BY business_id ORDER BY imp DESC, term) AS rank
  FROM imp QUALIFY rank <= 15)""",
    ]


def _listed(feature: str, value: str) -> str:
    return f"string_agg({feature} || '=' || cast(round({R(value, 4)} * 10000) AS bigint), ' ' ORDER BY rank)"


def _text_oracles() -> dict[str, str]:
    q = {}
    q["training_rows"] = with_(REVIEWS, TRAIN, body="SELECT review_id, stars, text, label FROM tr")
    frac = """frac AS (SELECT label, cast(min(n) OVER () AS double) / cast(n AS double) AS fraction
  FROM (SELECT label, count(*) AS n FROM tr GROUP BY label))"""
    q["balance_classes"] = with_(REVIEWS, TRAIN, frac, body=f"""SELECT review_id, label FROM tr JOIN frac USING (label)
  WHERE {_uh('b')} / 4294967296.0 < fraction""")
    q["class_counts"] = with_(REVIEWS, TRAIN, frac, body=f"""SELECT label, count(*) AS before,
         count(*) FILTER (WHERE {_uh('b')} / 4294967296.0 < fraction) AS after
  FROM tr JOIN frac USING (label) GROUP BY label""")
    q["train_test_split"] = with_(REVIEWS, TRAIN, body=f"""SELECT review_id, label,
         CASE WHEN {_uh('s')} / 4294967296.0 < 0.8 THEN 'train' ELSE 'test' END AS split FROM tr""")
    q["stratified_split"] = with_(REVIEWS, TRAIN, body=f"""SELECT review_id, label,
         CASE WHEN row_number() OVER (PARTITION BY label ORDER BY {_uh('t', 15)})
                   <= floor(count(*) OVER (PARTITION BY label) * 0.8) THEN 'train' ELSE 'test' END AS split
  FROM tr""")
    q["classifier_metrics"] = with_(REVIEWS, TRAIN, """cm AS (SELECT label AS y, sentiment_label AS p, count(*) AS c FROM tr GROUP BY ALL)""",
                                    """per AS (
  SELECT a.cls, a.support, coalesce(b.tp, 0) AS tp, coalesce(d.predicted, 0) AS predicted
  FROM (SELECT y AS cls, sum(c) AS support FROM cm GROUP BY y) a
  LEFT JOIN (SELECT y AS cls, c AS tp FROM cm WHERE y = p) b ON a.cls = b.cls
  LEFT JOIN (SELECT p AS cls, sum(c) AS predicted FROM cm GROUP BY p) d ON a.cls = d.cls)""",
                                    body=f"""SELECT sum(support) AS total, sum(tp) AS correct,
         {R(ratio('sum(tp)', 'sum(support)'), 6)} AS accuracy,
         {R(ratio(f"sum(coalesce({ratio('2 * tp', 'support + predicted')}, 0.0) * support)", 'sum(support)'), 6)} AS weighted_f1
  FROM per""")
    q["tfidf_weights"] = with_(*_corpus_ctes(), body=f"SELECT doc_id, term, idx, tf, {R('weight', 6)} AS weight FROM tfidf")
    ex = [REVIEWS, STATS, LABELLED] + _explain_ctes()
    q["vocabulary_dropped"] = with_(*_corpus_ctes(), body="SELECT greatest(count(*) - 20000, 0) AS dropped_terms FROM per_term")
    q["contributions"] = with_(*ex, body=f"""SELECT review_id, business_id, coalesce(n_terms, 0) AS n_terms, {R('coalesce(score, 0.0)', 6)} AS score
  FROM qdocs LEFT JOIN (SELECT doc_id, count(*) AS n_terms, sum(contribution) AS score FROM contrib GROUP BY doc_id) USING (doc_id)""")
    q["top_attack_signals"] = with_(*ex, body=f"SELECT business_id, rank, term AS feature, {R('imp', 4)} AS importance FROM signals")
    q["review_top_features"] = with_(*ex, body=f"""SELECT review_id, business_id, stars, text_preview, coalesce(rank, 0) AS rank,
         feature, {R('contribution', 4)} AS shap_value FROM qdocs LEFT JOIN feats USING (doc_id)""")
    q["review_explanations"] = with_(*ex, body=f"""SELECT review_id, business_id, stars, text_preview, coalesce(n, 0) AS n_features, coalesce(f, '') AS features
  FROM qdocs LEFT JOIN (SELECT doc_id, count(*) AS n, {_listed('feature', 'contribution')} AS f FROM feats GROUP BY doc_id) USING (doc_id)""")
    q["model_metrics"] = with_(REVIEWS, TRAIN, frac, body=f"""SELECT label,
         count(*) FILTER (WHERE {_uh('s')} / 4294967296.0 < 0.8) AS train,
         count(*) FILTER (WHERE NOT {_uh('s')} / 4294967296.0 < 0.8) AS test, true AS metrics_valid
  FROM tr JOIN frac USING (label) WHERE {_uh('b')} / 4294967296.0 < fraction GROUP BY label""")
    n, s, ss = "cast(count(stars) AS double)", "cast(sum(stars) AS double)", "cast(sum(stars * stars) AS double)"
    L = "length(coalesce(text, ''))"
    ln_, ls, lq = "cast(count(*) AS double)", f"cast(sum({L}) AS double)", f"cast(sum({L} * {L}) AS double)"
    q["behaviour_patterns"] = detect_sql(f"""SELECT business_id, count(*) AS num_flagged_reviews,
         count(DISTINCT coalesce(user_id, '')) AS unique_users,
         {R(ratio("count(DISTINCT coalesce(user_id, ''))", 'greatest(count(*), 1)'), 3)} AS distinct_user_ratio,
         {R(f'{s} / nullif({n}, 0)', 2)} AS avg_stars,
         {R(f'sqrt(({n} * {ss} - {s} * {s}) / nullif({n} * {n}, 0))', 2)} AS std_stars,
         {R(f'{ls} / nullif({ln_}, 0)', 1)} AS avg_text_length,
         {R(f'sqrt(({ln_} * {lq} - {ls} * {ls}) / nullif({ln_} * {ln_}, 0))', 1)} AS std_text_length
  FROM quarantined GROUP BY business_id""")
    q["xai_reports"] = with_(*ex, body=f"""SELECT business_id, num_flagged_reviews, unique_users, avg_text_length, signals
  FROM (SELECT business_id, count(*) AS num_flagged_reviews, count(DISTINCT coalesce(user_id, '')) AS unique_users,
               {R(f'{ls} / nullif({ln_}, 0)', 1)} AS avg_text_length FROM quarantined GROUP BY business_id)
  LEFT JOIN (SELECT business_id, {_listed('term', 'imp')} AS signals FROM signals GROUP BY business_id) USING (business_id)""")
    doc_hash = _uh("s").replace("review_id", "doc_id")
    q["model_certificate"] = f"""WITH d AS (SELECT avg(cast(l.quality AS double)) AS p, count(*) AS rows
  FROM documents JOIN labels l USING (doc_id) WHERE l.quality IS NOT NULL AND {doc_hash} / 4294967296.0 < 0.8)
SELECT rows, {R('-(p * ln(p) + (1 - p) * ln(1 - p))', 6)} AS constant_loss, true AS better, true AS optimal FROM d"""
    scored = _corpus_ctes() + [f"""scored AS (
  SELECT label, {R('coalesce(s, 0.0)', 6)} AS score FROM docs
  LEFT JOIN (SELECT doc_id, sum(coef * weight) AS s FROM tfidf JOIN coefs USING (term) GROUP BY doc_id) USING (doc_id) WHERE label IS NOT NULL)"""]
    q["scorer_auc"] = with_(*scored, body=f"""SELECT sum(pos) AS positives, sum(neg) AS negatives,
         {ratio('sum(pos * (2 * below + neg))', '2 * sum(pos) * sum(neg)')} AS auc
  FROM (SELECT pos, neg, coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
        FROM (SELECT score, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label <> 1) AS neg FROM scored GROUP BY score))""")
    q["scorer_roc"] = with_(*scored, """grid AS (SELECT floor(score / 0.1::DOUBLE) AS g, count(*) FILTER (WHERE label = 1) AS pos,
         count(*) FILTER (WHERE label <> 1) AS neg FROM scored GROUP BY g)""", body=f"""SELECT g * 0.1::DOUBLE AS threshold,
         sum(pos) OVER w AS true_positives, sum(neg) OVER w AS false_positives,
         {ratio('sum(pos) OVER w', 'sum(pos) OVER ()')} AS tpr, {ratio('sum(neg) OVER w', 'sum(neg) OVER ()')} AS fpr
  FROM grid WINDOW w AS (ORDER BY g DESC)""")
    at = ", ".join(f"{R(f'min(lat_us) FILTER (WHERE k >= {p}::DOUBLE * n) / 1000000.0', 3)} AS p{round(100 * p)}_seconds" for p in (0.5, 0.9, 0.95, 0.99))
    q["latency_sketch_profile"] = detect_sql(f"""SELECT cohort, max(rows) AS rows, coalesce(max(n), 0) AS valid,
         {R('cast(sum(lat_us) AS double) / nullif(max(n), 0) / 1000000.0', 3)} AS mean_seconds, {at}
  FROM (SELECT cohort, lat_us, count(*) OVER c AS rows, count(lat_us) OVER c AS n,
               CASE WHEN lat_us IS NOT NULL THEN row_number() OVER (PARTITION BY cohort ORDER BY lat_us NULLS LAST) END AS k
        FROM (SELECT unnest([label, 'combined']) AS cohort, CASE WHEN {LAT_US} >= 0 AND {LAT_US} < 3600000000 THEN {LAT_US} END AS lat_us FROM labelled)
        WINDOW c AS (PARTITION BY cohort))
  GROUP BY cohort""")
    q["label_intervals"] = with_(REVIEWS, STATS, LABELLED, body="""SELECT review_id, user_id, business_id, stars, event_time, ingestion_time, is_injected,
         sentiment_label, label, window_start, window_end, window_review_count, window_avg_stars, window_std_stars, anomaly_reason FROM labelled""")
    q["incident_report"] = with_(REVIEWS, STATS, """opened AS (
  SELECT business_id, window_start AS s, window_end + INTERVAL 2 MINUTE AS e, window_review_count AS c,
         CASE WHEN window_start > max(window_end + INTERVAL 2 MINUTE) OVER (PARTITION BY business_id ORDER BY window_start
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 1 ELSE 0 END AS o FROM flagged)""",
                                 "runs AS (SELECT *, sum(o) OVER (PARTITION BY business_id ORDER BY s) AS run FROM opened)",
                                 """inc AS (SELECT business_id, min(s) AS incident_start, max(e) AS incident_end, count(*) AS windows, max(c) AS max_review_count
  FROM runs GROUP BY business_id, run)""", body="""SELECT i.*, count(*) AS reviews, count(stars) AS rated, cast(sum(stars) AS bigint) AS stars_sum,
         count(*) FILTER (WHERE coalesce(is_injected, false)) AS injected
  FROM inc i JOIN reviews r ON r.business_id = i.business_id AND r.event_time BETWEEN i.incident_start AND i.incident_end GROUP BY ALL""")
    q["report_parts"] = with_(*ex, body="""SELECT business_id, part, count(*) AS n, string_agg(review_id || ':' || f, ' ' ORDER BY review_id) AS reviews
  FROM (SELECT business_id, review_id, (row_number() OVER (PARTITION BY business_id ORDER BY review_id) - 1) // 50 + 1 AS part,
               least(coalesce(n, 0), 5) AS f
        FROM qdocs LEFT JOIN (SELECT doc_id, count(*) AS n FROM contrib GROUP BY doc_id) USING (doc_id))
  GROUP BY business_id, part""")
    q["business_users"] = detect_sql("""SELECT business_id, count(*) AS reviews, count(DISTINCT coalesce(user_id, '')) AS users
  FROM labelled GROUP BY business_id""")
    q["shared_attackers"] = with_(REVIEWS, STATS, LABELLED, """most AS (
  SELECT business_id FROM quarantined WHERE business_id IS NOT NULL GROUP BY business_id ORDER BY count(*) DESC, business_id LIMIT 20)""",
                                  "seen AS (SELECT DISTINCT business_id, coalesce(user_id, '') AS u FROM quarantined JOIN most USING (business_id))",
                                  "sizes AS (SELECT business_id, count(*) AS users FROM seen GROUP BY business_id)",
                                  body="""SELECT a.business_id AS business_a, b.business_id AS business_b, any_value(x.users) AS users_a,
         any_value(y.users) AS users_b, count(*) AS shared
  FROM seen a JOIN seen b ON a.u = b.u AND a.business_id < b.business_id JOIN sizes x ON x.business_id = a.business_id
  JOIN sizes y ON y.business_id = b.business_id GROUP BY a.business_id, b.business_id""")
    q["frequent_businesses"] = with_(REVIEWS, """counted AS (
  SELECT business_id, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, business_id) AS rank FROM reviews
  WHERE business_id IS NOT NULL GROUP BY business_id)""", body="""SELECT rank, business_id, n,
         n > greatest(coalesce((SELECT n FROM counted WHERE rank = 80), 0),
                      (SELECT count(*) FROM reviews WHERE business_id IS NOT NULL) * 3.5::DOUBLE / 16384) AS certain
  FROM counted WHERE rank <= 20""")
    q["report_index"] = detect_sql("""SELECT count(DISTINCT business_id) AS total_businesses,
         count(*) AS total_quarantined_reviews FROM quarantined""")
    return q


def oracles() -> dict[str, str]:
    return {**_detection_oracles(), **_ingest_oracles(), **_attack_oracles(), **_text_oracles()}
