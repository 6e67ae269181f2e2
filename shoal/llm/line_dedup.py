"""Lines that recur across documents are dropped.

A text is split at ``\\n``. A line's key is the line without white space at both
ends and with A-Z lower-cased; keys are compared by their 128-bit digest. The lines
of every distinct text are exploded and counted by key: a text adds, for each
of its distinct keys, the number of documents that carry it. Lines whose key (of
``min_chars`` code points or more) is found in ``min_docs`` documents go, and each
text is put together again from the positions that stay.

Scale: copies of a text meet once, map-side first, and are one row from then
on, so a group of copies costs no more than one of them. That shuffle serves every
step (a filter that holds for every text keeps its columns in all of them, so that
Spark sees one and the same); nothing is written in between, no file for each of
many tasks. Only digests and positions are exploded and shuffled, never the lines.
Keys with over 1/``HOT`` of all lines are fewer than ``HOT`` and are broadcast; no
other key can fill a task. Documents are shuffled once, to the positions of their text; texts with over
1/``HOT`` of all documents (fewer than ``HOT``) are dealt over so many pieces that
none has more.

Defined results: each row is a document, so repeated rows and rows without
doc_id count as often as they occur. A null or empty text has one empty line and
stays as it is. Extra columns are carried unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoal.llm.common import SPACES

MIN_DOCS = 10
MIN_CHARS = 1
HOT = 1000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _lowered(line: Column) -> Column:
    """A-Z lower-cased: ``lower`` where the line is ASCII, which is faster."""
    return F.when(F.octet_length(line) == F.length(line), F.lower(line)).otherwise(F.translate(line, UPPER, LOWER))


def line_keys(text: Column, min_chars: int = MIN_CHARS) -> Column:
    """Digest of each line's key, null where the key is too short."""
    stripped = F.transform(lines(text), lambda x: F.btrim(x, F.lit(SPACES)))
    return F.transform(stripped, lambda x: F.when(F.length(x) >= min_chars, F.md5(_lowered(x))))


def _rows(documents: DataFrame) -> DataFrame:
    held = documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("_row"))
    return held.withColumn("_t", F.md5(F.coalesce("_row.text", F.lit(""))))


def _texts(documents: DataFrame, min_chars: int) -> DataFrame:
    """(t, keys, copies) of every distinct text, by its digest."""
    return (documents.select(F.md5(F.coalesce("text", F.lit(""))).alias("t"), line_keys(F.col("text"), min_chars).alias("keys"))
            .groupBy("t").agg(F.first("keys").alias("keys"), F.count("*").alias("copies"))
            .filter((F.col("copies") > 0) & (F.size("keys") > 0)))  # always so; see above


def _totals(texts: DataFrame) -> DataFrame:
    """One row: lines of the distinct texts, and documents."""
    return F.broadcast(texts.agg(F.sum(F.size("keys")).alias("_total_lines"), F.sum("copies").alias("_total_docs")))


def repeated_positions(texts: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(t, copies, positions): the lines to drop of every text that has any, counted from 0."""
    found = (texts.select("copies", F.explode(F.array_distinct("keys")).alias("key")).filter("key is not null")
             .groupBy("key").agg(F.sum("copies").alias("docs"), F.count("*").alias("n")).filter(F.col("docs") >= min_docs)
             .crossJoin(_totals(texts)))
    is_common = F.col("n") * HOT > F.col("_total_lines")
    common = F.broadcast(found.filter(is_common).select("key"))
    rare = found.filter(~is_common).select("key")
    each = texts.select("t", "copies", F.posexplode("keys").alias("at", "key")).filter("key is not null")
    hits = each.join(common, "key", "left_semi").unionByName(each.join(common, "key", "left_anti").join(rare, "key", "left_semi"))
    return hits.groupBy("t").agg(F.first("copies").alias("copies"), F.collect_list("at").alias("positions"))


def _without(text: Column, positions: Column) -> Column:
    """``text`` without the lines at ``positions``; split once, in time linear in its lines."""
    def kept(ls: Column) -> Column:
        rest = F.array_except(F.sequence(F.lit(0), F.size(ls) - 1), positions)
        return F.array_join(F.transform(rest, lambda i: F.get(ls, i)), "\n")
    return F.get(F.transform(F.array(lines(text)), kept), F.lit(0))


def _cut(documents: DataFrame, min_docs: int, min_chars: int) -> DataFrame:
    """(_row, _lines, _dropped, _kept) of every document."""
    texts = _texts(documents, min_chars)
    totals = _totals(texts)
    share = F.floor(F.col("_total_docs") / HOT) + 1  # documents of a piece
    many = F.ceil(F.col("copies") / share)
    pieces = F.broadcast(texts.crossJoin(totals).filter(F.col("copies") > share)
                         .select(F.col("t").alias("_hot"), many.alias("_pieces")))
    drops = (repeated_positions(texts, min_docs).crossJoin(totals)
             .select("t", "positions", F.explode(F.sequence(F.lit(0).cast("long"), many - 1)).alias("piece")))
    rows = (_rows(documents).join(pieces, F.col("_t") == F.col("_hot"), "left")
            .withColumn("_piece", F.pmod(F.monotonically_increasing_id(), F.coalesce("_pieces", F.lit(1)))))
    text = F.col("_row.text")
    return (rows.join(drops, (F.col("_t") == F.col("t")) & (F.col("_piece") == F.col("piece")), "left")
            .select("_row", F.size(lines(text)).cast("long").alias("_lines"),
                    F.when(F.col("positions").isNull(), F.lit(0)).otherwise(F.size("positions")).cast("long").alias("_dropped"),
                    F.when(F.col("positions").isNull(), text).otherwise(_without(text, F.col("positions"))).alias("_kept")))


def drop_repeated_lines(documents: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> DataFrame:
    """``documents`` with the recurring lines taken out of ``text``."""
    cut = _cut(documents, min_docs, min_chars)
    return cut.select(*[F.col("_kept" if c == "text" else f"_row.`{c}`").alias(c) for c in documents.columns])


def line_report(documents: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> DataFrame:
    """Per row: doc_id, n_lines, n_dropped, kept_sha256 of what stays (null: empty)."""
    cut = _cut(documents, min_docs, min_chars)
    return cut.select("_row.doc_id", F.col("_lines").alias("n_lines"), F.col("_dropped").alias("n_dropped"),
                      F.sha2(F.coalesce("_kept", F.lit("")).cast("binary"), 256).alias("kept_sha256"))
