"""Shared helpers of the corpus operators: lineage cuts in the shared folder
and the word rule. A word is a maximal run of bytes other than space and
\\x09-\\x0D, which is what ``bytes.split()`` returns.
"""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Java regular expression of one word.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"
#: Tasks per core for rows that are short and quick to read.
PER_CORE = 4


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared checkpoint folder
    (``spark.checkpoint.dir``), so that a lost executor costs no recomputation."""
    _checkpoint_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def in_few_tasks(df: DataFrame) -> DataFrame:
    """``df`` in ``PER_CORE`` tasks per core at most, as many parts as its shuffle has. The driver keeps
    a record of every task; what reads a checkpoint of short rows would else have a task for each part."""
    return df.coalesce(PER_CORE * df.sparkSession.sparkContext.defaultParallelism)


def checkpointed_by_size(df: DataFrame) -> DataFrame:
    """:func:`checkpointed` for few rows made by many tasks: they are dealt anew by their
    size, so that there is no file, and no process that sets its mode, for every task."""
    return checkpointed(in_few_tasks(df.hint("rebalance")))


def shared_path(spark: SparkSession, name: str) -> str:
    """A path below the shared checkpoint folder, for a written table."""
    return f"{_checkpoint_folder(spark)}/{name}"


def _checkpoint_folder(spark: SparkSession) -> str:
    """The folder that the session names. Only a local session, whose executors
    share the driver's disk, may name none (tests); one is made then."""
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("name a folder that the cluster shares in spark.checkpoint.dir")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="shoal-checkpoint-"))
    return sc.getCheckpointDir()


def bounded_sample(df: DataFrame, n: int) -> DataFrame:
    """At most ``n`` distinct rows, those of least hash. A threshold on the hash,
    set from the number of rows, leaves little more than ``n`` in the scan, so no
    task gathers every partition's ``n``. Equal rows count once."""
    rows = df.withColumn("_order", F.xxhash64(*df.columns))
    total = df.count()
    if total > 1.25 * n:
        rows = rows.filter(F.shiftrightunsigned("_order", 1) < int(1.25 * n / total * (1 << 63)))
    return rows.dropDuplicates(["_order"]).orderBy("_order").limit(n).drop("_order")
