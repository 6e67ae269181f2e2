"""Registered queries: ``name -> f(spark, sf_dir) -> DataFrame``.

Every query reads the driver's tables through the review adapter (or the
documents/labels tables) and runs over whole tables. Reviews are labelled, sampled
and counted on narrow rows that carry the number of their text; texts are joined to
what is left, once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shoal.functions.numeric import ratio, round_half
from shoal.operators import certificate as ce
from shoal.operators import evaluate as ev
from shoal.operators import explain as ex
from shoal.operators import intervals as iv
from shoal.operators import profile as pr
from shoal.operators import report_parts as rp
from shoal.operators import roc
from shoal.operators import sketches as sk
from shoal.operators import text_model as tm
from shoal.operators.label import missing_ids, organic, quarantined
from shoal.operators.windows import classify_windows
from shoal.plans.detect import Detection, detect
from shoal.sources.adapter import attach_text, labelled_documents, read_table, review_adapter

Query = Callable[[SparkSession, str], DataFrame]


def _det(spark: SparkSession, sf_dir: str, text_id: bool = False) -> Detection:
    return detect(review_adapter(spark, sf_dir, with_text=False, with_text_id=text_id))


def window_stats(spark, sf_dir):
    return _det(spark, sf_dir).stats


def anomaly_rules(spark, sf_dir):
    return classify_windows(_det(spark, sf_dir).stats)


def rule_counts(spark, sf_dir):
    return (anomaly_rules(spark, sf_dir).groupBy("anomaly_reason")
            .agg(F.count(F.lit(1)).alias("windows")))


def flagged_windows(spark, sf_dir):
    return _det(spark, sf_dir).flagged


def label_reviews(spark, sf_dir):
    return attach_text(_det(spark, sf_dir, text_id=True).labelled, spark, sf_dir)


def organic_reviews(spark, sf_dir):
    lab = _det(spark, sf_dir, text_id=True).labelled.where(F.col("label") == "organic")
    return organic(attach_text(lab, spark, sf_dir))


def quarantined_reviews(spark, sf_dir):
    lab = _det(spark, sf_dir, text_id=True).labelled.where(F.col("label") == "quarantined")
    return quarantined(attach_text(lab, spark, sf_dir))


def _damaged_ids(spark, sf_dir):
    """The review view with ids as a careless producer sends them: some NULL,
    some given to a second review of another time and business."""
    r = review_adapter(spark, sf_dir, with_text=False)
    eid = F.col("review_id").cast("bigint")
    rid = (F.when(eid % 211 == 5, F.lit(None)).when(eid % 59 == 7, (eid + 1).cast("string")).otherwise(F.col("review_id")))
    return r.withColumn("review_id", rid)


def label_damaged_ids(spark, sf_dir):
    """Duplicate ids keep the row of the earliest window; NULL ids are rejects."""
    return detect(_damaged_ids(spark, sf_dir)).labelled


def damaged_id_rejects(spark, sf_dir):
    return missing_ids(_damaged_ids(spark, sf_dir)).groupBy("status").agg(F.count(F.lit(1)).alias("rejects"))


def label_summary(spark, sf_dir):
    lab = _det(spark, sf_dir).labelled
    return (lab.groupBy("label", F.coalesce("is_injected", F.lit(False)).alias("injected"))
            .agg(F.count(F.lit(1)).alias("reviews")))


def _l(fn):
    def q(spark, sf_dir):
        return fn(_det(spark, sf_dir).labelled)
    q.__name__ = fn.__name__
    q.__doc__ = fn.__doc__
    return q


def _q(fn):
    def q(spark, sf_dir):
        return fn(_det(spark, sf_dir).quarantined)
    q.__name__ = fn.__name__
    q.__doc__ = fn.__doc__
    return q


def _o(fn):
    def q(spark, sf_dir):
        return fn(_det(spark, sf_dir).organic)
    q.__name__ = fn.__name__
    return q


def latency_stats(spark, sf_dir):
    return pr.latency_stats(_det(spark, sf_dir).labelled)


def throughput_stats(spark, sf_dir):
    return pr.throughput_stats(_det(spark, sf_dir).labelled)


def profile_by_cohort(spark, sf_dir):
    # the profile reads three columns of the labelled rows several times
    path = _scratch(spark)
    _det(spark, sf_dir).labelled.select("label", "event_time", "ingestion_time").write.parquet(path)
    return pr.profile(spark.read.parquet(path))


def label_intervals(spark, sf_dir):
    """The labels again, from the flagged windows as plain intervals."""
    r = review_adapter(spark, sf_dir, with_text=False)
    return iv.label_by_intervals(r, _det(spark, sf_dir).flagged, grace_minutes=2)


def incident_report(spark, sf_dir):
    """Runs of flagged windows and the reviews inside each."""
    return iv.incident_report(review_adapter(spark, sf_dir, with_text=False), _det(spark, sf_dir).flagged)


def latency_sketch_profile(spark, sf_dir):
    """Latency percentiles of both cohorts and of all rows, from sketches per minute."""
    s = sk.latency_sketches(_det(spark, sf_dir).labelled)
    every = F.explode(F.array(F.col("cohort"), F.lit("combined"))).alias("cohort")
    return sk.latency_profile(s.select(every, *[c for c in s.columns if c != "cohort"]))


def business_users(spark, sf_dir):
    """Reviews and distinct users of every business, merged from its days."""
    return sk.distinct_users(sk.user_sketches(_det(spark, sf_dir).labelled))


def shared_attackers(spark, sf_dir):
    """Users that two of the twenty businesses of most flagged reviews have in common."""
    return sk.shared_users(sk.user_sketches(_det(spark, sf_dir).quarantined))


def frequent_businesses(spark, sf_dir):
    """The twenty most reviewed businesses: candidates from sketches per day, exact counts."""
    r = review_adapter(spark, sf_dir, with_text=False)
    return sk.frequent_items(sk.item_sketches(r, "business_id"), r, "business_id")


def star_distribution(spark, sf_dir):
    return ev.star_distribution(review_adapter(spark, sf_dir, with_text=False))


def most_reviewed(spark, sf_dir):
    return ev.most_reviewed(review_adapter(spark, sf_dir, with_text=False))


# --- ingest --------------------------------------------------------------
# JSON lines made from the review view; some lines are damaged by id
# arithmetic so every status occurs: truncated JSON, blank, unparseable date,
# missing id; and fields of other types: stars and counts as doubles or text, a
# count that is no number, a flag as text.
def json_lines(spark, sf_dir):
    from shoal.sources.messages import review_wire
    r = review_adapter(spark, sf_dir, with_text=True)
    eid = F.col("review_id").cast("bigint")
    r = r.withColumn("stars", F.when(eid % 2 == 0, F.col("stars").cast("double").cast("string")).otherwise(F.col("stars").cast("string")))
    r = r.withColumns({
        "useful": F.when(eid % 71 == 11, F.lit("3.0")).when(eid % 71 == 12, F.lit("many")).when(eid % 3 == 0, (eid % 7).cast("string")),
        "funny": F.when(eid % 73 == 13, F.lit("1")), "cool": F.when(eid % 5 == 1, F.lit("2.5")),
        "is_injected": F.when((eid % 79 == 17) & F.col("is_injected"), F.lit("true")).otherwise(F.col("is_injected").cast("string")),
        # lines that are damaged as a whole keep their id, by which they are found below
        "review_id": F.when((eid % 67 == 19) & (eid % 97 != 5) & (eid % 89 != 3), F.lit(None)).otherwise(F.col("review_id"))})
    w = review_wire(r).withColumn("date", F.when(eid % 83 == 7, F.lit("not a date")).otherwise(F.col("date")))
    # numbers and flags were made as text: take the quotes off those that JSON would not have; the
    # text, by far the longest field, is put in afterwards
    js = F.to_json(F.struct(*[c for c in w.columns if c != "text"]))
    for c in ("stars", "useful", "cool", "is_injected"):
        js = F.regexp_replace(js, rf'"{c}":"([0-9.]+|true|false)"', rf'"{c}":$1')
    js = F.when(eid % 79 == 17, F.regexp_replace(js, r'"is_injected":true', r'"is_injected":"true"')).otherwise(js)
    text = F.btrim(F.to_json(F.struct("text")), F.lit("{}"))  # between its braces stands a field in quotes
    js = F.when(F.col("text").isNull(), js).otherwise(F.concat(F.lit("{"), text, F.lit(","), F.substring(js, 2, 1 << 20)))
    line = (F.when(eid % 97 == 5, F.substring(js, F.lit(1), (F.length(js) / 2).cast("int")))
            .when(eid % 89 == 3, F.lit("   "))
            .otherwise(js))
    return w.select(line.alias("value"))


def parse_reviews_q(spark, sf_dir):
    from shoal.sources.json_lines import parse_reviews
    return parse_reviews(json_lines(spark, sf_dir)).drop("ingestion_time")


def parse_reject_split(spark, sf_dir):
    from shoal.sources.json_lines import status_counts
    return status_counts(json_lines(spark, sf_dir))


def keyed_messages(spark, sf_dir):
    from shoal.sources.messages import WIRE_FIELDS, review_wire, to_keyed_messages
    r = review_adapter(spark, sf_dir, with_text=True)
    eid = F.col("review_id").cast("bigint")
    r = r.withColumns({"useful": (eid % 7).cast("int"), "funny": F.when(eid % 2 == 0, F.lit(0)), "cool": F.lit(None).cast("int")})
    return to_keyed_messages(review_wire(r), WIRE_FIELDS)


# --- attack overlay ------------------------------------------------------
ATTACK_PLAN = (("blitz", 0, 1), ("sustained", 1, 1), ("stealth", 2, 1), ("multi", 3, 3))
ATTACK_DELAY_MINUTES = 20


def _ranked_businesses(reviews, k):
    top = (reviews.where(F.col("business_id").isNotNull()).groupBy("business_id")
           .agg(F.count(F.lit(1)).alias("review_count"))
           .orderBy(F.desc("review_count"), "business_id").limit(k))
    return top.withColumn("rank", F.row_number().over(
        Window.orderBy(F.desc("review_count"), "business_id")) - 1)


def _attacks(reviews):
    from shoal.operators.overlay import attack_rows
    need = max(first + n for _, first, n in ATTACK_PLAN)
    ranked = _ranked_businesses(reviews, need)
    start = reviews.select(F.timestamp_micros(F.unix_micros(F.min("event_time"))
                                              + F.lit(ATTACK_DELAY_MINUTES * 60_000_000))).scalar()
    out = None
    for name, first, n in ATTACK_PLAN:
        t = ranked.where((F.col("rank") >= first) & (F.col("rank") < first + n)).select(
            "business_id", (F.col("rank") - first).cast("int").alias("target_order"))
        a = attack_rows(t, name, start)
        out = a if out is None else out.unionByName(a)
    return out


def attack_detection(spark, sf_dir):
    """Detection quality per attack scenario on the review view plus overlay."""
    r = review_adapter(spark, sf_dir, with_text=False)
    allr = r.unionByName(_attacks(r).select(*r.columns))
    d = detect(allr)
    lab = d.labelled.where(F.col("review_id").startswith("inj-"))
    return (lab.groupBy(F.split_part(F.col("review_id"), F.lit("-"), F.lit(2)).alias("scenario"))
            .agg(F.count(F.lit(1)).alias("injected"),
                 F.count_if(F.col("label") == "quarantined").alias("caught"))
            .withColumn("recall", round_half(ratio(F.col("caught"), F.col("injected")), 4)))


# --- text model and explanations -----------------------------------------
def _training_narrow(spark, sf_dir, *keep):
    """(review_id, stars, text_id, keep..., label): the training rows without their
    texts. Reviews whose document has no text are out, as in the text form."""
    r = review_adapter(spark, sf_dir, with_text=False, with_text_id=True)
    known = read_table(spark, sf_dir, "documents").where(F.col("text").isNotNull()).select(F.col("doc_id").alias("text_id"))
    return tm.star_labels(r.select("review_id", "stars", "text_id", *keep)).join(known, "text_id", "left_semi")


def _training(spark, sf_dir):
    return attach_text(_training_narrow(spark, sf_dir), spark, sf_dir)


def training_rows(spark, sf_dir):
    return _training(spark, sf_dir).select("review_id", "stars", "text", "label")


def _ids(spark, sf_dir):
    return _training_narrow(spark, sf_dir).select("review_id", "label")


def balance_classes(spark, sf_dir):
    return tm.balance(_ids(spark, sf_dir), "review_id")


def class_counts(spark, sf_dir):
    return tm.class_counts(_ids(spark, sf_dir), "review_id")


def train_test_split(spark, sf_dir):
    return tm.split(_ids(spark, sf_dir), "review_id")


def stratified_split(spark, sf_dir):
    return tm.stratified_split(_ids(spark, sf_dir), "review_id")


def classifier_metrics(spark, sf_dir):
    """Accuracy / weighted F1 of the view's sentiment column against star labels."""
    m = tm.classification_metrics(_training_narrow(spark, sf_dir, "sentiment_label"), "label", "sentiment_label")
    return m.select("total", "correct", round_half(F.col("accuracy"), 6).alias("accuracy"),
                    round_half(F.col("weighted_f1"), 6).alias("weighted_f1"))


def _trained(spark, sf_dir):
    texts = read_table(spark, sf_dir, "documents").where(F.col("text").isNotNull()).select(F.col("doc_id").alias("text_id"), "text")
    return tm.train_by_text(_training_narrow(spark, sf_dir), texts)


def model_metrics(spark, sf_dir):
    """The training job on review texts and stars: rows, balance, split, fit,
    evaluate. Per class the rows of each part, and whether every metric is a share and the
    fitted objective below that of the best model without terms."""
    t = _trained(spark, sf_dir)
    ok = all(0.0 <= t.metrics[k] <= 1.0 for k in ("auc", "accuracy", "f1")) and t.metrics["loss"] < t.metrics["constant_loss"]
    return t.counts.withColumn("metrics_valid", F.lit(ok))


def training_metrics(spark, sf_dir):
    """AUC, accuracy, weighted F1 and the objective of the training job."""
    return spark.createDataFrame(sorted(_trained(spark, sf_dir).metrics.items()), "metric string, value double")


def sentiment_scores(spark, sf_dir):
    """Every review scored by the model of the training job. A text is scored once,
    however many reviews carry it."""
    model = _trained(spark, sf_dir).model
    texts = read_table(spark, sf_dir, "documents").select(F.col("doc_id").alias("text_id"), "text")
    scored = tm.score(model, texts).select("text_id", "sentiment_label", "p_positive")
    r = review_adapter(spark, sf_dir, with_text=False, with_text_id=True).select("review_id", "text_id")
    return r.join(scored, "text_id", "left").select("review_id", "sentiment_label", "p_positive")


def _corpus(spark, sf_dir):
    return labelled_documents(spark, sf_dir).select("doc_id", "text", F.col("quality").alias("label"))


def _corpus_lists(spark, sf_dir):
    """(term lists of the corpus, whether every id is one row of it). Every text is tokenised
    once: the lists are stored, as vocabularies and weights both read them. Labels come
    as narrow rows; texts are joined to them only where a document has several."""
    texts = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    ids = _corpus(spark, sf_dir).select("doc_id")
    once = ids.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).isEmpty()
    path = _scratch(spark)
    tm.term_lists(texts if once else _corpus(spark, sf_dir), "doc_id").write.parquet(path)
    return spark.read.parquet(path), once


def _weights(spark, sf_dir, lists=None):
    """(documents, the lists of their TF-IDF weights)."""
    docs = _corpus(spark, sf_dir)
    lists = _corpus_lists(spark, sf_dir)[0] if lists is None else lists
    return docs, tm.tfidf_lists(tm.fit_tfidf(docs, "doc_id", lists=lists), lists, ("doc_id",))


def tfidf_weights(spark, sf_dir):
    t = _weights(spark, sf_dir)[1].long()
    return t.select("doc_id", "term", "idx", "tf", round_half(F.col("weight"), 6).alias("weight"))


def vocabulary_dropped(spark, sf_dir):
    """Terms that the vocabulary limit leaves without a weight."""
    return tm.fit_tfidf(_corpus(spark, sf_dir), "doc_id").dropped


def _flagged_ids(spark, sf_dir):
    """Quarantined reviews with the number of their text."""
    lab = _det(spark, sf_dir, text_id=True).labelled
    return lab.where(F.col("label") == "quarantined").select("review_id", "business_id", "user_id", "stars", "text_id")


def _text_contributions(spark, sf_dir, coefs=None, lists=None):
    """Contributions of every text, as lists by text_id, by default
    under the fixed log-ratio scorer of the labelled documents."""
    docs, weights = _weights(spark, sf_dir, lists)
    coefs = coefs if coefs is not None else tm.log_ratio_coefficients(weights, docs, "doc_id")
    weights.rows = weights.rows.withColumnRenamed("doc_id", "text_id")
    return ex.contributions(weights, coefs)


def contributions(spark, sf_dir):
    return ex.review_scores(_text_contributions(spark, sf_dir), _flagged_ids(spark, sf_dir), keep=("business_id",))


def top_attack_signals(spark, sf_dir):
    return ex.top_attack_signals(_text_contributions(spark, sf_dir), _flagged_ids(spark, sf_dir))


def _previews(spark, sf_dir):
    return ex.previews(read_table(spark, sf_dir, "documents").select(F.col("doc_id").alias("text_id"), "text"))


def review_top_features(spark, sf_dir):
    top = ex.text_top_features(_text_contributions(spark, sf_dir))
    return ex.review_top_features(top, _flagged_ids(spark, sf_dir), _previews(spark, sf_dir))


def _listed(items, value):
    """A list of (feature, value) as text, the values in ten-thousandths."""
    return F.array_join(F.transform(items, lambda x: F.concat(
        x["feature"], F.lit("="), F.round(x[value] * 10000).cast("bigint").cast("string"))), " ")


def review_explanations(spark, sf_dir):
    """One row per review; the list of features as text."""
    top = ex.text_top_features(_text_contributions(spark, sf_dir))
    e = ex.review_explanations(top, _flagged_ids(spark, sf_dir), _previews(spark, sf_dir))
    return e.select("review_id", "business_id", "stars", "text_preview", F.size("top_features").alias("n_features"),
                    _listed("top_features", "shap_value").alias("features"))


def report_parts(spark, sf_dir):
    """The explained reviews nested by business in parts of at most fifty; each part as text."""
    top = ex.text_top_features(_text_contributions(spark, sf_dir))
    parts = rp.report_parts(ex.review_explanations(top, _flagged_ids(spark, sf_dir), _previews(spark, sf_dir)))
    inner = F.transform("reviews", lambda r: F.concat(r["review_id"], F.lit(":"), F.size(r["top_features"]).cast("string")))
    return parts.select("business_id", "part", "n", F.array_join(inner, " ").alias("reviews"))


def _patterns(spark, sf_dir):
    lengths = read_table(spark, sf_dir, "documents").select(F.col("doc_id").alias("text_id"), F.length("text").alias("text_length"))
    return ex.behaviour_patterns(_flagged_ids(spark, sf_dir).join(lengths, "text_id", "left"))


def behaviour_patterns(spark, sf_dir):
    return _patterns(spark, sf_dir)


def report_index(spark, sf_dir):
    return ex.report_index(_det(spark, sf_dir).quarantined)


def xai_reports(spark, sf_dir):
    """Business reports, their signals and patterns flattened."""
    r = ex.build_reports(top_attack_signals(spark, sf_dir), _patterns(spark, sf_dir))
    return r.select("business_id", "num_flagged_reviews", F.col("aggregate_patterns.unique_users").alias("unique_users"),
                    F.col("aggregate_patterns.avg_text_length").alias("avg_text_length"),
                    _listed("top_attack_signals", "importance").alias("signals"))


def _fit_interpretable(spark, sf_dir, corpus=None):
    """(train rows, their long vectors, vocabulary, model) of the interpretable model,
    fitted on the labelled documents' train part. Lists and vectors are written once; so
    are the ids, by whose size Spark sees whether to broadcast them to the lists.
    ``corpus``: the stored lists of the corpus, if there are any."""
    docs = tm.split(_corpus(spark, sf_dir).where(F.col("label").isNotNull())
                    .withColumn("label", F.col("label").cast("double")), "doc_id")
    train = docs.where(F.col("split") == "train")
    lists, once = corpus or (None, False)
    path = _scratch(spark)
    train.select("doc_id", "label").write.parquet(f"{path}/train")
    texts, train = train, spark.read.parquet(f"{path}/train")
    part = lists.join(train.select("doc_id"), "doc_id", "left_semi") if once else tm.term_lists(texts, "doc_id")
    part.write.parquet(f"{path}/terms")
    part = spark.read.parquet(f"{path}/terms")
    m = tm.fit_tfidf(train, "doc_id", lists=part)
    weights = tm.tfidf_lists(m, part, ("doc_id",))
    weights.rows.write.parquet(f"{path}/weights")
    weights.rows = spark.read.parquet(f"{path}/weights")
    tm.write_vectors(weights, train, "doc_id", f"{path}/vectors")
    vocab = spark.createDataFrame([(r["term"], r["idx"], r["idf"]) for r in m.known()], "term string, idx int, idf double")
    return train, weights.long(), vocab, tm.fit_interpretable(spark, f"{path}/vectors", tm.NUM_FEATURES)


def _interpretable(spark, sf_dir, corpus=None):
    """(term, coef) of the interpretable model."""
    _, _, vocab, model = _fit_interpretable(spark, sf_dir, corpus)
    return tm.coefficient_table(spark, model, vocab)


def _scratch(spark) -> str:
    """A path in the shared folder that the cluster names. Only a local session, whose
    executors share the driver's disk, may do without."""
    import re
    import uuid
    base = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("name a folder that the cluster shares in spark.checkpoint.dir")
        import tempfile
        base = tempfile.mkdtemp(prefix="shoal-")
        spark.sparkContext.setCheckpointDir(base)
    return f"{base}/scratch-{uuid.uuid4().hex}"


def interpretable_model(spark, sf_dir):
    return _interpretable(spark, sf_dir)


GRADIENT_LIMIT = 1e-3  # norm of the gradient up to which a model counts as the optimum; at no model it is some 0.1


def model_certificate(spark, sf_dir):
    """Whether the interpretable model is the optimum of its objective: rows, the loss of the best
    model without terms, whether the fitted one is better, and its gradient vanishes."""
    train, long, vocab, model = _fit_interpretable(spark, sf_dir)
    coefs = spark.createDataFrame([(i, float(v)) for i, v in enumerate(model.coefficients.toArray())], "idx int, coef double")
    n = max(train.count(), 1)
    o = ce.optimality(long, train, coefs, model.intercept, 1.0 / (tm.INTERP_C * n), "doc_id")
    return o.select("rows", round_half(F.col("constant_loss"), 6).alias("constant_loss"), (F.col("loss") < F.col("constant_loss")).alias("better"),
                    (F.col("gradient_norm") <= GRADIENT_LIMIT).alias("optimal"))


def _scored_documents(spark, sf_dir):
    """(label, score) of the labelled documents under the log-ratio scorer."""
    s = ex.text_scores(_text_contributions(spark, sf_dir)).select("text_id", F.col("score").alias("_s"))
    docs = _corpus(spark, sf_dir).where(F.col("label").isNotNull()).select(F.col("doc_id").alias("text_id"), "label")
    return docs.join(s, "text_id", "left").select("label", round_half(F.coalesce("_s", F.lit(0.0)), 6).alias("score"))


def scorer_auc(spark, sf_dir):
    """Exact area under the ROC curve of the log-ratio scorer on the labelled documents."""
    return roc.auc(_scored_documents(spark, sf_dir), "score", "label")


def scorer_roc(spark, sf_dir):
    return roc.roc_points(_scored_documents(spark, sf_dir), "score", "label")


def model_explanations(spark, sf_dir):
    """Scores of the flagged reviews under the interpretable model's coefficients."""
    corpus = _corpus_lists(spark, sf_dir)
    c = _text_contributions(spark, sf_dir, _interpretable(spark, sf_dir, corpus), corpus[0])
    return ex.review_scores(c, _flagged_ids(spark, sf_dir), keep=("business_id",))


def registry() -> dict[str, Query]:
    named = (
        window_stats, anomaly_rules, rule_counts, flagged_windows, label_reviews, organic_reviews, quarantined_reviews, label_summary,
        label_damaged_ids, damaged_id_rejects, latency_stats, throughput_stats, profile_by_cohort, star_distribution, most_reviewed,
        parse_reject_split, keyed_messages, attack_detection, training_rows, balance_classes, class_counts, train_test_split,
        stratified_split, classifier_metrics, model_metrics, training_metrics, sentiment_scores, tfidf_weights, vocabulary_dropped,
        contributions, top_attack_signals, review_top_features, review_explanations, behaviour_patterns, report_index, xai_reports,
        interpretable_model, model_explanations, model_certificate, scorer_auc, scorer_roc, latency_sketch_profile, business_users,
        shared_attackers, frequent_businesses, label_intervals, incident_report, report_parts)
    return {f.__name__: f for f in named} | {
        "parse_reviews": parse_reviews_q,
        "eval_precision": _q(ev.eval_precision), "eval_recall": _l(ev.eval_recall), "eval_f1": _l(ev.eval_f1),
        "eval_sentiment_accuracy": _o(ev.eval_sentiment_accuracy), "attack_timeline": _q(ev.attack_timeline),
        "latency_mean": _q(ev.latency_mean), "latency_approx": _q(ev.latency_approx),
        "throughput_per_minute": _l(ev.throughput_per_minute), "confusion_matrix": _l(ev.confusion_matrix),
        "false_positive_rate": _l(ev.false_positive_rate), "detection_delay": _l(ev.detection_delay),
    }
