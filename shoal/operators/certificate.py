"""Proof that a fitted logistic model is the optimum of its objective.

The objective is the mean logistic loss plus ``reg``/2 times the squared norm of the
coefficients (the intercept is free). It is convex, so a small gradient shows a
model near the optimum, whichever solver made it. Loss and gradient are aggregates
over the long form of the training vectors: one join per pass, no vector is
gathered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def margins(long: DataFrame, docs: DataFrame, coefs: DataFrame, intercept: float, id_col: str) -> DataFrame:
    """(id, label, margin): the linear score of each row of ``docs`` (id, label) from
    its entries ``long`` (id, idx, weight); a row without entries has the intercept.
    ``coefs`` (idx, coef) is as long as the vocabulary."""
    part = (long.join(coefs, "idx").groupBy(id_col).agg(F.sum(F.col("coef") * F.col("weight")).alias("_m"))
            .withColumnRenamed(id_col, "_id"))
    return (docs.select(id_col, "label").join(part, F.col(id_col) == F.col("_id"), "left")
            .select(id_col, "label", (F.coalesce("_m", F.lit(0.0)) + F.lit(float(intercept))).alias("margin")))


def optimality(long: DataFrame, docs: DataFrame, coefs: DataFrame, intercept: float, reg: float, id_col: str) -> DataFrame:
    """One row: rows, loss, constant_loss (of the best model without features),
    gradient_norm (coefficients and intercept). Labels are 0 and 1."""
    m = margins(long, docs, coefs, intercept, id_col)
    # log(1 + exp(-z)) without overflow, z the margin towards the row's label
    z = F.when(F.col("label") == 1, F.col("margin")).otherwise(-F.col("margin"))
    loss = F.log1p(F.exp(-F.abs(z))) + F.greatest(-z, F.lit(0.0))
    residual = 1.0 / (1.0 + F.exp(-F.col("margin"))) - F.col("label")
    r = m.select(F.col(id_col).alias("_id"), "label", loss.alias("loss"), residual.alias("r"))
    whole = r.agg(F.count(F.lit(1)).alias("rows"), F.avg("loss").alias("loss"), F.avg("r").alias("_g0"), F.avg(F.col("label").cast("double")).alias("_p"))
    n = docs.select(F.count(F.lit(1)).cast("double")).scalar()
    grad = (long.join(r, F.col(id_col) == F.col("_id")).groupBy("idx").agg(F.sum(F.col("r") * F.col("weight")).alias("_g")))
    full = coefs.join(grad, "idx", "left").select("coef", (F.coalesce("_g", F.lit(0.0)) / n + F.lit(reg) * F.col("coef")).alias("_g"))
    norms = full.agg(F.coalesce(F.sum(F.col("_g") * F.col("_g")), F.lit(0.0)).alias("_gg"),
                     F.coalesce(F.sum(F.col("coef") * F.col("coef")), F.lit(0.0)).alias("_ww"))
    p = F.col("_p")
    constant = F.when((p > 0) & (p < 1), -(p * F.log(p) + (1 - p) * F.log(1 - p))).otherwise(F.lit(0.0))
    one = F.lit(1).alias("_one")
    return (whole.withColumn("_one", one).join(norms.withColumn("_one", one), "_one")  # a row each
            .select("rows", (F.col("loss") + F.lit(reg / 2) * F.col("_ww")).alias("loss"), constant.alias("constant_loss"),
                    F.sqrt(F.col("_gg") + F.col("_g0") * F.col("_g0")).alias("gradient_norm")))
