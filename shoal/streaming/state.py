"""What a streaming query keeps: rows of state by operator, store and variable,
read from its checkpoint. A query whose state is bounded shows the same numbers
after any number of batches."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

STATE = "operator_id long, operator string, store string, variable string, batch_id long, rows long"


def operators(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The stateful operators of a checkpoint, one row per store."""
    return spark.read.format("state-metadata").load(checkpoint)


def _variables(properties: str | None) -> list[str]:
    found = json.loads(properties or "{}").get("stateVariables") or []
    found = json.loads(found) if isinstance(found, str) else found
    return [v["stateName"] if isinstance(v, dict) else json.loads(v)["stateName"] for v in found]


def read_state(spark: SparkSession, checkpoint: str, operator_id: int = 0, store: str = "default", variable: str | None = None,
               batch_id: int | None = None) -> DataFrame:
    """Keys and values of one store (or state variable) after a batch, by
    default the last one."""
    r = spark.read.format("statestore").option("operatorId", operator_id)
    r = r.option("stateVarName", variable) if variable else r.option("storeName", store)
    if batch_id is not None:
        r = r.option("batchId", batch_id)
    return r.load(checkpoint)


def state_rows(spark: SparkSession, checkpoint: str, batch_id: int | None = None) -> DataFrame:
    """(operator_id, operator, store, variable, batch_id, rows) after a batch, one
    row per store of an operator and per variable of a stateful processor.
    Counted where the state lies, in one job per store (there are few)."""
    out = None
    # a row per store of the query's plan
    for op in operators(spark, checkpoint).orderBy("operatorId", "stateStoreName").collect():
        names = [v for v in _variables(op["operatorProperties"]) if not v.startswith("$")] or [None]
        for name in names:
            # a map variable holds an entry per user key
            n = (read_state(spark, checkpoint, op["operatorId"], op["stateStoreName"], name, batch_id).agg(F.count(F.lit(1)).alias("rows"))
                 .select(F.lit(op["operatorId"]).cast("long").alias("operator_id"), F.lit(op["operatorName"]).alias("operator"),
                         F.lit(op["stateStoreName"]).alias("store"), F.lit(name).cast("string").alias("variable"),
                         F.lit(op["maxBatchId"] if batch_id is None else batch_id).cast("long").alias("batch_id"), "rows"))
            out = n if out is None else out.unionByName(n)
    return out if out is not None else spark.createDataFrame([], STATE)


def progress_rows(query) -> list[tuple[int, int, int, int]]:
    """(batch, state rows, updated, dropped by the engine's watermark) of the batches
    that a running or ended query still reports."""
    return [(p.batchId, sum(s.numRowsTotal for s in p.stateOperators), sum(s.numRowsUpdated for s in p.stateOperators),
             sum(s.numRowsDroppedByWatermark for s in p.stateOperators)) for p in query.recentProgress]
