import pytest
from pyspark.sql import functions as F

from shoal.operators.explain import (contributions, previews, review_explanations, review_scores,
                                     review_top_features, text_top_features, top_attack_signals)
from shoal.operators.text_model import (balance, class_counts, fit_tfidf, hashed_model, score, split,
                                        stratified_split, transform_tfidf)

POS = ["the food was wonderful and the staff amazing", "great service lovely place", "excellent dinner great wine"]
NEG = ["terrible food and rude staff", "awful service never again", "worst dinner disgusting wine"]


def _docs(spark):
    rows = [(i, t, 1.0) for i, t in enumerate(POS * 10)] + [(100 + i, t, 0.0) for i, t in enumerate(NEG * 10)]
    return spark.createDataFrame(rows, "doc_id long, text string, label double")


def test_hashed_model_polarity_and_empty_text(spark):
    docs = _docs(spark)
    model = hashed_model(num_features=1 << 10).fit(docs)
    probe = spark.createDataFrame([(1, "wonderful amazing great"), (2, "awful rude terrible"), (3, ""),
                                   (4, "   "), (5, None)], "doc_id long, text string")
    out = {r["doc_id"]: r for r in score(model, probe).collect()}
    assert out[1]["sentiment_label"] == 1.0 and out[2]["sentiment_label"] == 0.0
    for r in out.values():
        assert 0.0 <= r["p_positive"] <= 1.0


def test_tfidf_long_is_l2_normalised(spark):
    docs = _docs(spark)
    m = fit_tfidf(docs, "doc_id", max_features=10)
    t = transform_tfidf(m, docs, "doc_id")
    assert m.vocab.count() == 10
    norms = t.groupBy("doc_id").agg(F.sum(F.col("weight") ** 2).alias("n2")).collect()
    assert all(abs(r["n2"] - 1.0) < 1e-9 for r in norms)
    assert t.where(F.col("term").isin("the", "and")).count() == 0          # stop words


def test_contributions_rank(spark):
    docs = _docs(spark).withColumnRenamed("doc_id", "text_id")
    reviews = docs.select(F.col("text_id").cast("string").alias("review_id"), F.lit("b").alias("business_id"), F.lit(1).alias("stars"), "text_id")
    reviews = reviews.unionByName(spark.createDataFrame([("none", "b", 2, -1), ("twice", "b", 1, 100)], reviews.schema))
    m = fit_tfidf(docs, "text_id")
    long = transform_tfidf(m, docs, "text_id")
    coefs = spark.createDataFrame([("terrible", -2.0), ("great", 1.5), ("food", 0.1)], "term string, coef double")
    c = contributions(long, coefs)
    top = top_attack_signals(c, reviews).orderBy("rank").collect()
    per_review = reviews.join(c, "text_id")
    direct = {r["term"]: round(r["s"] / 62, 4) for r in
              per_review.groupBy("term").agg(F.sum(F.abs("contribution")).alias("s")).collect()}
    assert [r["feature"] for r in top] == sorted(direct, key=lambda t: (-direct[t], t))
    assert all(abs(r["importance"] - direct[r["feature"]]) < 1e-4 for r in top)
    preview = previews(docs)
    per = review_top_features(text_top_features(c), reviews, preview).where(F.col("review_id") == "100").orderBy("rank").collect()
    assert per[0]["feature"] == "terrible" and per[0]["shap_value"] < 0
    e = {r["review_id"]: r for r in review_explanations(text_top_features(c), reviews, preview).collect()}
    assert len(e) == 62 and e["none"]["top_features"] == [] and e["none"]["text_preview"] is None
    assert e["twice"]["top_features"] == e["100"]["top_features"] != []
    scores = {r["review_id"]: (r["n_terms"], r["score"]) for r in review_scores(c, reviews).collect()}
    assert scores["none"] == (0, 0.0) and scores["100"][1] < 0


def test_vocabulary_limit_is_reported_and_can_be_lifted(spark):
    docs = _docs(spark)
    cut, whole = fit_tfidf(docs, "doc_id", max_features=5), fit_tfidf(docs, "doc_id", max_features=None)
    n = whole.vocab.count()
    assert cut.vocab.count() == 5 and cut.dropped.collect()[0][0] == n - 5 and whole.dropped.collect()[0][0] == 0
    assert transform_tfidf(whole, docs, "doc_id").select("term").distinct().count() == n


def test_training_job_saves_and_loads(spark, tmp_dir):
    from shoal.operators.text_model import train
    from shoal.sources.tables import load_model, save_model
    rows = _docs(spark).select(F.col("doc_id").cast("string").alias("review_id"), "text", "label")
    t = train(rows, pipeline=hashed_model(num_features=1 << 10))
    assert t.metrics["auc"] == 1.0 and {r["label"] for r in t.counts.collect()} == {0.0, 1.0}
    save_model(t.model, f"{tmp_dir}/model")
    probe = spark.createDataFrame([("awful rude terrible",), (None,)], "text string")
    a, b = (sorted(r["p_positive"] for r in score(m, probe).collect()) for m in (t.model, load_model(f"{tmp_dir}/model")))
    assert a == b


def test_interpretable_model_from_sparse_text(spark, tmp_dir):
    from shoal.operators.text_model import coefficient_table, fit_interpretable, write_vectors
    docs = _docs(spark).unionByName(spark.createDataFrame([(999, "", 1.0)], "doc_id long, text string, label double"))
    m = fit_tfidf(docs, "doc_id")
    write_vectors(transform_tfidf(m, docs, "doc_id"), docs, "doc_id", f"{tmp_dir}/v")
    size = m.vocab.count()
    coef = {r["term"]: r["coef"] for r in coefficient_table(spark, fit_interpretable(spark, f"{tmp_dir}/v", size), m.vocab).collect()}
    assert len(coef) == size and coef["wonderful"] > 0 > coef["terrible"]


def test_balance_and_guard(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("rid"),
                                  F.when(F.col("id") % 4 == 0, 0.0).otherwise(1.0).alias("label"))
    cc = {r["label"]: (r["before"], r["after"]) for r in class_counts(df, "rid").collect()}
    assert cc[0.0] == (250, 250) and 180 < cc[1.0][1] < 320
    assert balance(df, "rid").count() == cc[0.0][1] + cc[1.0][1]
    with pytest.raises(Exception, match="both classes"):
        balance(df.where(F.col("label") == 1.0), "rid").count()


def test_splits_are_partition_independent(spark):
    df = spark.range(2000).select(F.col("id").cast("string").alias("rid"), (F.col("id") % 3 == 0).cast("double").alias("label"))
    a = split(df, "rid").select("rid", "split")
    b = split(df.repartition(7), "rid").select("rid", "split")
    assert a.exceptAll(b).count() == 0
    s1 = stratified_split(df, "rid")
    s2 = stratified_split(df.repartition(5), "rid")
    assert s1.select("rid", "split").exceptAll(s2.select("rid", "split")).count() == 0
    cnt = {(r["label"], r["split"]): r["count"] for r in s1.groupBy("label", "split").count().collect()}
    n0, n1 = 1333, 667
    assert cnt[(0.0, "train")] == int(n0 * 0.8) and cnt[(1.0, "train")] == int(n1 * 0.8)


def test_evaluate_metrics(spark):
    from shoal.operators.text_model import classification_metrics, evaluate
    docs = _docs(spark)
    model = hashed_model(num_features=1 << 10).fit(docs)
    preds = model.transform(docs)
    m = evaluate(preds)
    mb = evaluate(preds, binary=True)
    assert m["accuracy"] == 1.0 and m["auc"] == 1.0 and mb["f1"] == 1.0
    sql = classification_metrics(preds).collect()[0]
    assert abs(sql["weighted_f1"] - m["f1"]) < 1e-12 and sql["accuracy"] == m["accuracy"]
