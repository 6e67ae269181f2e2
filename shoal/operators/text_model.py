"""Sentiment text model as Spark jobs: training rows, class balancing,
deterministic splits, TF-IDF in long form, two logistic models, metrics.

Row choices (balancing, splits) hash the row id with md5, so they do not
depend on partitioning and any SQL engine reproduces them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import HashingTF, IDF, StopWordsRemover, Tokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoal.functions.numeric import ratio
from shoal.functions.text import english_stop_words, tokens

# --- fixed values: original training settings -----------------------------
NUM_FEATURES = 20000      # hashed features and kept vocabulary
HASHED_MAX_ITER = 100
HASHED_REG = 0.01
INTERP_C = 1.0
INTERP_MAX_ITER = 500
SEED = 42
TRAIN_FRACTION = 0.8


def star_labels(rows: DataFrame) -> DataFrame:
    """``rows`` (stars, ...) with label: 3-star and NULL-star rows dropped, 1-2 stars
    -> 0.0, 4-5 stars -> 1.0. Needs no text, so sampling and splits run narrow."""
    return (rows.where(F.col("stars") != 3)
            .withColumn("label", F.when(F.col("stars") <= 2, F.lit(0.0)).otherwise(F.lit(1.0))))


def training_rows(reviews: DataFrame, id_col: str = "review_id", keep: tuple[str, ...] = ()) -> DataFrame:
    """id, stars, text, label of the reviews with a text and a label."""
    return star_labels(reviews.select(id_col, "stars", "text", *keep).na.drop(subset=["text"]))


def unit_hash(id_col: str, seed: int = SEED, salt: str = "") -> Column:
    """Uniform number in [0, 1) from md5(id || '|' || seed || salt)."""
    h = F.md5(F.concat_ws("|", F.col(id_col).cast("string"), F.lit(f"{seed}{salt}")))
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)


def class_sizes(df: DataFrame, label_col: str = "label") -> DataFrame:
    """One row per class: n, kept fraction (minority size / class size). Raises
    at run time when fewer than two classes are present."""
    c = df.groupBy(label_col).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy()  # over the class table: one row per class
    return (c.withColumn("_k", F.count(F.lit(1)).over(w))
            .withColumn("fraction", F.when(F.col("_k") >= 2, ratio(F.min("n").over(w), F.col("n")))
                        .otherwise(F.raise_error(F.lit("class balancing needs both classes"))))
            .drop("_k"))


def balance(df: DataFrame, id_col: str, label_col: str = "label", seed: int = SEED) -> DataFrame:
    """Undersample every class to the minority size in expectation: a row is
    kept when its id hash is below the class's fraction (Bernoulli per row,
    reproducible). The class table has one row per class, so it is broadcast."""
    sizes = class_sizes(df, label_col).select(label_col, "fraction")
    return (df.join(F.broadcast(sizes), label_col)
            .where(unit_hash(id_col, seed, "b") < F.col("fraction")).drop("fraction"))


def class_counts(df: DataFrame, id_col: str, label_col: str = "label", seed: int = SEED) -> DataFrame:
    """Rows per class before and after balancing, in one pass."""
    sizes = class_sizes(df, label_col).select(label_col, "fraction")
    keep = unit_hash(id_col, seed, "b") < F.col("fraction")
    return (df.join(F.broadcast(sizes), label_col).groupBy(label_col)
            .agg(F.count(F.lit(1)).alias("before"), F.count_if(keep).alias("after")))


def split(df: DataFrame, id_col: str, seed: int = SEED, train_fraction: float = TRAIN_FRACTION) -> DataFrame:
    """Adds ``split`` = 'train' | 'test' from the id hash (stable under repartitioning)."""
    return df.withColumn("split", F.when(unit_hash(id_col, seed, "s") < F.lit(train_fraction),
                                         F.lit("train")).otherwise(F.lit("test")))


def stratified_split(df: DataFrame, id_col: str, label_col: str = "label", seed: int = SEED,
                     train_fraction: float = TRAIN_FRACTION) -> DataFrame:
    """Per class, exactly floor(train_fraction * n) rows with the smallest id
    hash go to 'train'. The cut hash of each class is found with the exact
    two-level rank search of ``profile.values_at_ranks`` (no class is sorted
    in one task)."""
    from shoal.operators.profile import values_at_ranks
    hcol = F.conv(F.substring(F.md5(F.concat_ws("|", F.col(id_col).cast("string"), F.lit(f"{seed}t"))),
                              1, 15), 16, 10).cast("bigint")
    h = df.withColumn("_h", hcol)
    n = h.groupBy(label_col).agg(F.count(F.lit(1)).alias("_n"))
    ranks = n.select(label_col, F.lit("cut").alias("name"),
                     (F.floor(F.col("_n") * F.lit(train_fraction)) - 1).alias("rank"))
    cut = values_at_ranks(h, [label_col], "_h", ranks.where(F.col("rank") >= 0), coarse=1 << 44)
    cut = cut.select(label_col, F.col("value").alias("_cut"))
    out = h.join(F.broadcast(cut), label_col, "left")
    return out.withColumn("split", F.when(F.col("_h") <= F.col("_cut"), F.lit("train"))
                          .otherwise(F.lit("test"))).drop("_h", "_cut")


# --- hashed pipeline (streaming scorer) ------------------------------------
def hashed_model(num_features: int = NUM_FEATURES, max_iter: int = HASHED_MAX_ITER,
                 reg: float = HASHED_REG, text_col: str = "text") -> Pipeline:
    """Tokenizer -> English stop words -> HashingTF -> IDF -> L2 logistic regression."""
    return Pipeline(stages=[
        Tokenizer(inputCol=text_col, outputCol="tokens_"),
        StopWordsRemover(inputCol="tokens_", outputCol="kept_"),
        HashingTF(inputCol="kept_", outputCol="counts_", numFeatures=num_features),
        IDF(inputCol="counts_", outputCol="features"),
        LogisticRegression(featuresCol="features", labelCol="label", maxIter=max_iter,
                           regParam=reg, elasticNetParam=0.0),
    ])


@dataclass
class Trained:
    """A fitted pipeline, its test metrics, and the rows it saw."""

    model: object
    metrics: dict[str, float]
    counts: DataFrame   # label, train, test


def train(rows: DataFrame, id_col: str = "review_id", seed: int = SEED, pipeline: Pipeline | None = None) -> Trained:
    """The training job: balance the classes of ``rows`` (id, text, label), split,
    fit on the training part and evaluate on the rest."""
    part = split(balance(rows.select(id_col, "text", "label"), id_col, seed=seed), id_col, seed)
    fitted_on = safe_text(part.where(F.col("split") == "train")).persist()
    try:
        model = (pipeline or hashed_model()).fit(fitted_on)
    finally:
        fitted_on.unpersist()
    metrics = evaluate(model.transform(safe_text(part.where(F.col("split") == "test"))))
    counts = part.groupBy("label").agg(F.count_if(F.col("split") == "train").alias("train"), F.count_if(F.col("split") == "test").alias("test"))
    return Trained(model, metrics, counts)


def train_by_text(ids: DataFrame, texts: DataFrame, id_col: str = "review_id", text_id: str = "text_id", seed: int = SEED,
                  num_features: int = NUM_FEATURES) -> Trained:
    """The same job for rows (id, text_id, label) that share their texts (text_id, text).
    Balance and split run on the ids; a text is tokenised and hashed once, however
    many reviews carry it; rows of one text, label and part count as one of that weight.
    The model scores texts like the one of :func:`train`."""
    part = split(balance(ids.select(id_col, text_id, "label"), id_col, seed=seed), id_col, seed)
    uses = part.groupBy(text_id, "label", "split").agg(F.count(F.lit(1)).cast("double").alias("n"))
    tokenizer, stop, hashing, idf, lr = hashed_model(num_features).getStages()
    counts = texts.select(text_id, "text")
    for stage in (tokenizer, stop, hashing):
        counts = stage.transform(safe_text(counts) if stage is tokenizer else counts)
    rows = uses.join(counts.select(text_id, "counts_"), text_id).persist()
    try:
        # a term's document frequency counts reviews, so a text stands here as often as it is used
        train_rows = rows.where(F.col("split") == "train")
        idf_model = idf.fit(train_rows.withColumn("_k", F.explode(F.sequence(F.lit(1), F.col("n").cast("int")))))
        lr_model = lr.copy({lr.weightCol: "n"}).fit(idf_model.transform(train_rows))
        tested = lr_model.transform(idf_model.transform(rows.where(F.col("split") == "test")))
        metrics = evaluate(tested, weight_col="n")
    finally:
        rows.unpersist()
    history = lr_model.summary.objectiveHistory
    metrics["loss"], metrics["constant_loss"] = history[-1], history[0]
    counted = uses.groupBy("label").agg(*[F.coalesce(F.sum(F.when(F.col("split") == k, F.col("n"))), F.lit(0.0)).cast("bigint").alias(k)
                                          for k in ("train", "test")])
    return Trained(PipelineModel([tokenizer, stop, hashing, idf_model, lr_model]), metrics, counted)


def safe_text(df: DataFrame, text_col: str = "text") -> DataFrame:
    """The tokenizer fails on NULL text; score those rows as empty text."""
    return df.withColumn(text_col, F.coalesce(F.col(text_col), F.lit("")))


def score(model, df: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds ``sentiment_label`` (0/1) and ``p_positive``; works on streams."""
    out = model.transform(safe_text(df, text_col))
    return (out.withColumn("p_positive", vector_to_array("probability")[1])
            .withColumnRenamed("prediction", "sentiment_label")
            .drop("tokens_", "kept_", "counts_", "features", "rawPrediction", "probability"))


def evaluate(preds: DataFrame, label_col: str = "label", binary: bool = False, weight_col: str | None = None) -> dict[str, float]:
    """AUC, accuracy and F1 with Spark's evaluators: weighted F1 by default,
    the F1 of the positive class with ``binary=True``. ``weight_col``: rows that a row stands for."""
    weight = {"weightCol": weight_col} if weight_col else {}
    preds = preds.select(label_col, "prediction", "rawPrediction", *weight.values()).persist()
    mc = MulticlassClassificationEvaluator(labelCol=label_col, **weight)
    f1 = (mc.copy({mc.metricName: "fMeasureByLabel", mc.metricLabel: 1.0}) if binary
          else mc.copy({mc.metricName: "f1"}))
    try:
        return {
            "auc": BinaryClassificationEvaluator(labelCol=label_col, **weight).evaluate(preds),
            "accuracy": mc.copy({mc.metricName: "accuracy"}).evaluate(preds),
            "f1": f1.evaluate(preds),
        }
    finally:
        preds.unpersist()


def classification_metrics(df: DataFrame, label_col: str = "label", pred_col: str = "prediction") -> DataFrame:
    """Accuracy and weighted F1 as one small SQL plan over the confusion counts.
    (The weighted F1 equals MulticlassClassificationEvaluator's ``f1``.)"""
    cm = df.groupBy(F.col(label_col).alias("y"), F.col(pred_col).alias("p")).agg(F.count(F.lit(1)).alias("c"))
    lab = cm.groupBy(F.col("y").alias("cls")).agg(F.sum("c").alias("support"))
    tp = cm.where(F.col("y") == F.col("p")).select(F.col("y").alias("cls"), F.col("c").alias("tp"))
    pred = cm.groupBy(F.col("p").alias("cls")).agg(F.sum("c").alias("predicted"))
    per = (lab.join(tp, "cls", "left").join(pred, "cls", "left")
           .select("cls", "support", F.coalesce("tp", F.lit(0)).alias("tp"),
                   F.coalesce("predicted", F.lit(0)).alias("predicted")))
    f1 = ratio(F.lit(2) * F.col("tp"), F.col("support") + F.col("predicted"))
    return per.agg(
        F.sum("support").alias("total"), F.sum("tp").alias("correct"),
        ratio(F.sum("tp"), F.sum("support")).alias("accuracy"),
        ratio(F.sum(F.coalesce(f1, F.lit(0.0)) * F.col("support")), F.sum("support")).alias("weighted_f1"))


# --- interpretable TF-IDF ---------------------------------------------------
# A document's terms stay together: lists per document go through no shuffle, the long form
# (a row per document and term) is made from them where rows are asked for.
SLICE = 1000              # texts that a task counts at once
BROADCAST_IDS = 100_000   # repeated ids up to which they are broadcast
LISTS = (T.StructField("terms", T.ArrayType(T.StringType())), T.StructField("tf", T.ArrayType(T.IntegerType())))


@dataclass
class TfidfModel:
    vocab: DataFrame          # term, idx, idf
    bounded: bool             # whether vocab has at most max_features rows
    dropped: DataFrame        # dropped_terms: terms beyond max_features
    _known: list | None = field(default=None, repr=False)

    def known(self) -> list:
        """The rows of a bounded vocabulary in order of idx, computed once."""
        if self._known is None:
            self._known = self.vocab.select("term", "idx", "idf").orderBy("idx").collect()
        return self._known


def list_array(rows: np.ndarray, n: int, values) -> pa.ListArray:
    """``values`` as lists of ``n`` rows; ``rows`` is the ascending row number of each."""
    at = np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=n))])
    return pa.ListArray.from_arrays(pa.array(at, pa.int32()), values)


def flat_rows(lists: pa.ListArray) -> np.ndarray:
    """The row number of each value of ``lists``."""
    return np.repeat(np.arange(len(lists)), pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))


@dataclass
class TermLists:
    """A value of every vocabulary term of each text, in a row per text: ``rows`` has the key columns,
    the lists ``idx`` and ``tf``, and the ``norm`` of the text. The value of a term is its weight
    (1 + ln tf) * idf / norm, times its ``coef`` if there are any (NaN: the term is left
    out). So a row is a few bytes per term wherever it is shuffled. ``terms``, ``idf`` and
    ``coef`` go by idx and are bounded by the vocabulary."""

    rows: DataFrame
    terms: list[str]
    idf: np.ndarray
    coef: np.ndarray | None = None

    def keys(self) -> list[T.StructField]:
        return [f for f in self.rows.schema if f.name not in ("idx", "tf", "norm")]

    def values(self):
        """A function for tasks: of the columns idx, tf, norm of a batch the row number, idx, tf
        and value of every term, row by row."""
        idf, coef = self.idf, self.coef

        def of(idx: pa.ListArray, tf: pa.ListArray, norm: pa.Array) -> tuple[np.ndarray, ...]:
            row, at, n = flat_rows(idx), idx.flatten().to_numpy(), tf.flatten().to_numpy()
            value = (1.0 + np.log(n)) * idf[at] / norm.to_numpy()[row]
            if coef is None:
                return row, at, n, value
            known = ~np.isnan(coef[at])
            return row[known], at[known], n[known], coef[at[known]] * value[known]

        return of

    def mapped(self, made, fields: list[T.StructField]) -> DataFrame:
        """The rows of ``made(key columns, rows, (row, idx, tf, value))``, which gives the columns ``fields``."""
        keys, values = [f.name for f in self.keys()], self.values()
        names = [f.name for f in fields]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                yield pa.RecordBatch.from_arrays(made(b.columns[:-3], b.num_rows, values(*b.columns[-3:])), names=names)

        return self.rows.select(*keys, "idx", "tf", "norm").mapInArrow(run, T.StructType(fields))

    def lists(self) -> DataFrame:
        """(key..., idx, tf, weight), lists of equal length."""
        def made(keys, n, found):
            row, idx, tf, value = found
            return [*keys, *[list_array(row, n, pa.array(v, t)) for v, t in ((idx, pa.int32()), (tf, pa.int32()), (value, pa.float64()))]]

        kinds = (("idx", T.IntegerType()), ("tf", T.IntegerType()), ("weight", T.DoubleType()))
        return self.mapped(made, [*self.keys(), *[T.StructField(k, T.ArrayType(t)) for k, t in kinds]])

    def long(self) -> DataFrame:
        """(key..., term, idx, tf, weight), a row per text and term."""
        keys = [f.name for f in self.keys()]
        named = self.rows.sparkSession.createDataFrame(list(enumerate(self.terms)), "idx int, term string")
        rows = self.lists().select(*keys, F.inline(F.arrays_zip("idx", "tf", "weight")))
        return rows.join(F.broadcast(named), "idx").select(*keys, "term", "idx", F.col("tf").cast("bigint").alias("tf"), "weight")


def _counted(docs: DataFrame, keys: list[str], text_col: str) -> DataFrame:
    """keys, terms, tf of each row of ``docs``, counted inside its row."""
    stop = pa.array(english_stop_words())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                b = batch.slice(at, SLICE)
                found = pc.split_pattern(b.column(b.num_columns - 1), " ")
                words = found.flatten().dictionary_encode()
                names = words.dictionary
                size = max(len(names), 1)
                each, tf = np.unique(flat_rows(found) * size + words.indices.to_numpy(), return_counts=True)
                row, word = np.divmod(each, size)
                out = pc.or_(pc.is_in(names, value_set=stop), pc.equal(names, "")).to_numpy(zero_copy_only=False)
                keep = ~out[word] if len(names) else np.zeros(0, bool)
                row, word, tf = row[keep], word[keep], tf[keep]
                yield pa.RecordBatch.from_arrays(
                    [*b.columns[:-1], list_array(row, b.num_rows, names.take(pa.array(word))),
                     list_array(row, b.num_rows, pa.array(tf, pa.int32()))], names=[*keys, "terms", "tf"])

    schema = T.StructType([*[docs.schema[c] for c in keys], *LISTS])
    # tokens hold no space
    return docs.select(*keys, F.array_join(tokens(F.col(text_col)), " ").alias("_words")).mapInArrow(count, schema)


def term_lists(docs: DataFrame, id_col: str, text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, keep..., terms, tf): the distinct non-stop-word tokens of each id and their counts.
    Texts are counted row by row without a shuffle; only rows whose id repeats are brought
    together. ``keep`` columns are functions of the id."""
    keys = [id_col, *keep]
    ids = docs.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1).select(*[F.col(c).alias(f"_{c}") for c in keys])
    n = ids.limit(BROADCAST_IDS + 1).count()
    if not n:
        return _counted(docs, keys, text_col)
    ids = F.broadcast(ids) if n <= BROADCAST_IDS else ids
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in keys]
    again = (_counted(docs.join(ids, same, "left_semi"), keys, text_col).select(*keys, F.inline(F.arrays_zip("terms", "tf")))
             .groupBy(*keys, "terms").agg(F.sum("tf").cast("int").alias("tf"))
             .groupBy(*keys).agg(F.collect_list(F.struct("terms", "tf")).alias("_l")).select(*keys, "_l.terms", "_l.tf"))
    return _counted(docs.join(ids, same, "left_anti"), keys, text_col).unionByName(again)


def term_counts(docs: DataFrame, id_col: str, text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, keep..., term, tf): :func:`term_lists` in long form."""
    return _long_counts(term_lists(docs, id_col, text_col, keep), (id_col, *keep))


def _long_counts(lists: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    return (lists.select(*keys, F.inline(F.arrays_zip("terms", "tf")))
            .select(*keys, F.col("terms").alias("term"), F.col("tf").cast("bigint").alias("tf")))


def _term_totals(lists: DataFrame) -> DataFrame:
    """(term, cf, df): occurrences of each term and the lists it is in. The terms of many
    lists are added up before a row is made of each; every list has a term once."""
    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words = b.column(0).flatten().dictionary_encode()
            at, tf = words.indices.to_numpy(), b.column(1).flatten().to_numpy()
            n = len(words.dictionary)
            yield pa.RecordBatch.from_arrays(
                [words.dictionary, pa.array(np.bincount(at, tf, n).astype(np.int64)), pa.array(np.bincount(at, minlength=n))],
                names=["term", "cf", "df"])

    parts = lists.select("terms", "tf").mapInArrow(total, "term string, cf long, df long")
    return parts.groupBy("term").agg(F.sum("cf").alias("cf"), F.sum("df").alias("df"))


def fit_tfidf(docs: DataFrame, id_col: str, text_col: str = "text",
              max_features: int | None = NUM_FEATURES, lists: DataFrame | None = None) -> TfidfModel:
    """Vocabulary = the ``max_features`` terms with the highest corpus count
    (ties by term); smooth idf = ln((1 + n) / (1 + df)) + 1. With None every term
    has a weight; the vocabulary then has no idx and is joined by a shuffle. The
    model tells how many terms the limit leaves out. ``lists``: the stored
    :func:`term_lists` of ``docs``, which are else counted here."""
    n = docs.select(F.count(F.lit(1)).cast("double")).scalar()   # scalar subquery
    per_term = _term_totals(term_lists(docs, id_col, text_col) if lists is None else lists)
    idf = (F.ln((F.lit(1.0) + n) / (F.lit(1.0) + F.col("df"))) + F.lit(1.0)).alias("idf")
    over = F.lit(0).cast("bigint") if max_features is None else F.greatest(F.count(F.lit(1)) - F.lit(max_features), F.lit(0))
    dropped = per_term.agg(over.alias("dropped_terms"))
    if max_features is None:
        return TfidfModel(per_term.select("term", F.lit(None).cast("int").alias("idx"), idf), False, dropped)
    top = per_term.orderBy(F.desc("cf"), "term").limit(max_features)   # bounded top-k
    vocab = top.select("term", (F.row_number().over(Window.orderBy(F.desc("cf"), "term")) - 1).alias("idx"), idf)
    return TfidfModel(vocab, True, dropped)


def tfidf_lists(model: TfidfModel, lists: DataFrame, keys: tuple[str, ...]) -> TermLists:
    """The weights of :func:`transform_tfidf` under a bounded vocabulary, as lists per row of
    ``lists``. Every row has its whole document, so its norm needs no other row."""
    known = model.known()
    names, idf = pa.array([r["term"] for r in known], pa.string()), np.array([r["idf"] for r in known], np.float64)
    kind, of = (T.ShortType(), pa.int16()) if len(known) < 1 << 15 else (T.IntegerType(), pa.int32())

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, found = b.num_rows, b.column(b.num_columns - 2)
            idx = pc.fill_null(pc.index_in(found.flatten(), value_set=names), -1).to_numpy()
            inside = idx >= 0
            idx, row, tf = idx[inside], flat_rows(found)[inside], b.column(b.num_columns - 1).flatten().to_numpy()[inside]
            w = (1.0 + np.log(tf)) * idf[idx]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-2], list_array(row, n, pa.array(idx.astype(of.to_pandas_dtype()))), list_array(row, n, pa.array(tf, pa.int32())),
                 pa.array(np.sqrt(np.bincount(row, w * w, n)))], names=[*keys, "idx", "tf", "norm"])

    schema = T.StructType([*[lists.schema[c] for c in keys], T.StructField("idx", T.ArrayType(kind)),
                           T.StructField("tf", T.ArrayType(T.IntegerType())), T.StructField("norm", T.DoubleType())])
    return TermLists(lists.select(*keys, "terms", "tf").mapInArrow(weigh, schema), [r["term"] for r in known], idf)


def transform_tfidf(model: TfidfModel, docs: DataFrame, id_col: str, text_col: str = "text",
                    keep: tuple[str, ...] = (), lists: DataFrame | None = None) -> DataFrame:
    """(id, keep..., term, idx, tf, weight) with weight = (1 + ln tf) * idf,
    L2-normalised per document over vocabulary terms. With a bounded vocabulary
    (:func:`tfidf_lists`) nothing is shuffled; else the vocabulary is joined by a shuffle
    and the norm is a window per document, over its distinct terms."""
    keys = (id_col, *keep)
    lists = term_lists(docs, id_col, text_col, keep) if lists is None else lists
    if model.bounded:
        return tfidf_lists(model, lists, keys).long()
    tc = _long_counts(lists, keys).join(model.vocab, "term")
    w = (F.lit(1.0) + F.ln(F.col("tf").cast("double"))) * F.col("idf")
    tc = tc.withColumn("_w", w)
    norm = F.sqrt(F.sum(F.col("_w") * F.col("_w")).over(Window.partitionBy(id_col)))
    return tc.select(id_col, *keep, "term", "idx", "tf", (F.col("_w") / norm).alias("weight"))


def write_vectors(tfidf: DataFrame | TermLists, docs: DataFrame, id_col: str, path: str) -> None:
    """Training vectors (label and sorted idx:weight pairs) in LIBSVM text, built
    by SQL functions; documents without a vocabulary term are empty vectors. Spark
    reads that format into ML vectors in the JVM."""
    if isinstance(tfidf, TermLists):
        per = tfidf.lists().select(id_col, F.sort_array(F.arrays_zip("idx", "weight")).alias("_e"))
    else:
        per = tfidf.groupBy(id_col).agg(F.sort_array(F.collect_list(F.struct("idx", "weight"))).alias("_e"))
    pairs = F.transform(F.coalesce("_e", F.array().cast("array<struct<idx:int,weight:double>>")),
                        lambda x: F.concat((x["idx"] + 1).cast("string"), F.lit(":"), x["weight"].cast("string")))
    (docs.select(id_col, "label").join(per, id_col, "left")
     .select(F.concat_ws(" ", F.col("label").cast("string"), F.concat_ws(" ", pairs)).alias("value"))
     .write.mode("overwrite").text(path))


def fit_interpretable(spark, path: str, size: int, c: float = INTERP_C, max_iter: int = INTERP_MAX_ITER):
    """L2 logistic regression with the objective of C-regularised LR on the
    vectors written to ``path``: regParam = 1 / (C * n), no standardisation."""
    rows = spark.read.format("libsvm").option("numFeatures", size).load(path).persist()
    try:
        n = rows.count()
        lr = LogisticRegression(featuresCol="features", labelCol="label", maxIter=max_iter,
                                regParam=1.0 / (c * max(n, 1)), elasticNetParam=0.0, standardization=False)
        return lr.fit(rows)
    finally:
        rows.unpersist()


def coefficient_table(spark, lr_model, vocab: DataFrame) -> DataFrame:
    """(term, coef): one row per vocabulary term (bounded by the vocabulary)."""
    coefs = [(i, float(v)) for i, v in enumerate(lr_model.coefficients.toArray())]
    cdf = spark.createDataFrame(coefs, "idx int, coef double")
    return vocab.join(cdf, "idx").select("term", "coef")


def log_ratio_coefficients(tfidf: DataFrame | TermLists, labels: DataFrame, id_col: str) -> DataFrame:
    """(term, coef) = ln((docs with label 1 and term + 1) / (docs with label 0 and term + 1)):
    a fixed linear scorer computable in any SQL engine. From lists, those of labelled documents
    alone are joined; the other terms of the vocabulary have coefficient 0."""
    ratio_ = F.ln((F.col("pos") + F.lit(1.0)) / (F.col("neg") + F.lit(1.0))).alias("coef")
    if isinstance(tfidf, TermLists):
        per_id = (labels.where(F.col("label").isNotNull()).groupBy(id_col)
                  .agg(F.count_if(F.col("label") == 1).alias("pos"), F.count_if(F.col("label") == 0).alias("neg")))
        per = (tfidf.rows.select(id_col, "idx").join(per_id, id_col).select("pos", "neg", F.explode(F.col("idx").cast("array<int>")).alias("idx"))
               .groupBy("idx").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")))
        known = labels.sparkSession.createDataFrame(list(enumerate(tfidf.terms)), "idx int, term string")
        return known.join(per, "idx", "left").select("term", F.coalesce(ratio_, F.lit(0.0)).alias("coef"))
    j = tfidf.join(labels.select(id_col, "label"), id_col)
    per = j.groupBy("term").agg(F.count_if(F.col("label") == 1).alias("pos"),
                                F.count_if(F.col("label") == 0).alias("neg"))
    return per.select("term", ratio_)
