"""Labels within the trigger: a stateful operator per business.

A review gets a ``provisional`` label in the trigger that brings it, from the windows
as they stand; a ``revised`` row follows whenever a later review changes its label or the
window that explains it, and one ``final`` row with the values of the batch plan once
the watermark has passed its last window. Replays of a review (same id and time) come out as
``duplicate`` and rows behind the watermark as ``late``: every row of the input comes
out once as ``provisional``, ``duplicate`` or ``late``, so accepted, late and rejected
lines add up to the input (:func:`live_output`, :func:`reconcile`).

State of a business, in RocksDB: ``sums``, the star moments of a minute, and
``held``, the reviews of a minute that are not final. Two timers per minute end both,
so a business that falls silent leaves nothing behind. Rows are narrow (id, time,
stars); texts are joined to the labels afterwards.

The engine drops rows behind the watermark before a stateful operator sees them.
Its watermark is therefore set ``SLACK_DAYS`` further back than the detector's;
the operator adds the slack again, so it knows the detector's watermark to the
millisecond, and gives out the late rows. Timers are set back by the same slack.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from shoal.config import (DEFAULT, LABEL_ORGANIC, LABEL_QUARANTINED, REASON_NONE, REASON_RATIO, REASON_UNIFORM, REASON_VELOCITY,
                          Thresholds)
from shoal.functions.timecols import MICROS_PER_MINUTE
from shoal.sources.json_lines import BLANK, VALID, parse_lines

SLACK_DAYS = 3650
PROVISIONAL, REVISED, FINAL, LATE, DUPLICATE = "provisional", "revised", "final", "late", "duplicate"
ONCE = (PROVISIONAL, DUPLICATE, LATE)  # statuses that an input row has exactly one of

OUTPUT = ("review_id string, business_id string, event_time timestamp, status string, label string, window_start timestamp, "
          "window_end timestamp, window_review_count long, window_avg_stars double, window_std_stars double, anomaly_reason string")
_COLUMNS = [x.split(" ")[0] for x in OUTPUT.split(", ")]
_ZERO = (0, 0, 0, 0, 0)


def window_values(m: tuple[int, int, int, int, int], thr: Thresholds) -> tuple[int, float | None, float | None, str]:
    """(count, mean, deviation, reason) of moments (rows, stars, sum, sum of
    squares, negative), as the column expressions of the batch plan give them."""
    rows, n, s, ss, neg = m
    mean = s / n if n else None
    std = math.sqrt((float(n) * ss - float(s) * s) / (float(n) * (n - 1.0))) if n > 1 else None
    busy = rows > thr.review_count_threshold
    if busy and mean is not None and mean < thr.avg_stars_threshold:
        reason = REASON_VELOCITY
    elif busy and std is not None and std < thr.std_threshold and mean < thr.coordinated_avg_threshold:
        reason = REASON_UNIFORM
    elif rows >= thr.neg_count_min_reviews and rows and neg / rows > thr.neg_ratio_threshold:
        reason = REASON_RATIO
    else:
        reason = REASON_NONE
    return rows, mean, std, reason


class _Windows:
    """The windows of one business over the minutes of its ``sums``. Minutes are
    numbered from the epoch, and ``slide`` of them make a step."""

    def __init__(self, sums: dict[int, tuple], thr: Thresholds):
        self.sums, self.thr, self.values = sums, thr, {}
        self.slide, self.length = thr.slide_minutes, thr.window_minutes
        self.reach = thr.window_minutes + thr.grace_minutes

    def at(self, start: int) -> tuple:
        if start not in self.values:
            parts = [self.sums.get(k, _ZERO) for k in range(start, start + self.length, self.slide)]
            self.values[start] = window_values(tuple(map(sum, zip(*parts))), self.thr)
        return self.values[start]

    def flagged(self, start: int) -> bool:
        return self.at(start)[3] != REASON_NONE

    def first(self, minute: int, micros: int) -> int | None:
        """Start of the earliest flagged window that covers the time ``micros`` of a
        slide step; the bound window_end + grace is closed."""
        edge = minute - self.reach
        if edge % self.slide == 0 and micros == minute * MICROS_PER_MINUTE and self.flagged(edge):
            return edge
        low = edge + self.slide - edge % self.slide
        return next((s for s in range(low, minute + 1, self.slide) if self.flagged(s)), None)


class LiveLabeller(StatefulProcessor):
    """See the module. Input rows: review_id, business_id, event_time, stars."""

    def __init__(self, thr: Thresholds = DEFAULT):
        if thr.window_minutes % thr.slide_minutes:
            raise ValueError("window length must be a multiple of the slide")
        self.thr = thr
        self.slack_ms = SLACK_DAYS * 86_400_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.sums = handle.getMapState("sums", "minute long", "rows long, n long, s long, ss long, neg long")
        self.held = handle.getMapState("held", "minute long", "ids array<string>, times array<long>, starts array<long>")

    def close(self) -> None:
        pass

    # -- helpers ----------------------------------------------------------
    def _minute(self, micros: int) -> int:
        step = self.thr.slide_minutes
        return micros // (MICROS_PER_MINUTE * step) * step

    def _windows(self) -> _Windows:
        return _Windows({k[0]: tuple(v) for k, v in self.sums.iterator()}, self.thr)

    def _row(self, key: str, rid: str, t: int, status: str, start: int | None, w: _Windows | None) -> tuple:
        time = pd.Timestamp(t, unit="us")
        if w is None:
            return (rid, key, time, status, None, None, None, None, None, None, None)
        if start is None:
            return (rid, key, time, status, LABEL_ORGANIC, None, None, None, None, None, None)
        minute = lambda m: pd.Timestamp(m * 60, unit="s")
        rows, mean, std, reason = w.at(start)
        return (rid, key, time, status, LABEL_QUARANTINED, minute(start), minute(start + w.length), rows, mean, std, reason)

    @staticmethod
    def _frame(rows: list[tuple]) -> pd.DataFrame:
        out = pd.DataFrame(rows, columns=_COLUMNS)
        for c in ("event_time", "window_start", "window_end"):
            out[c] = pd.to_datetime(out[c])
        out["window_review_count"] = out["window_review_count"].astype("Int64")
        for c in ("window_avg_stars", "window_std_stars"):
            out[c] = out[c].astype("Float64")
        return out

    # -- rows of a trigger ------------------------------------------------
    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        business = key[0]
        watermark_us = (timerValues.getCurrentWatermarkInMs() + self.slack_ms) * 1000
        new: dict[int, list[tuple[str, int, int | None]]] = {}
        out: list[tuple] = []
        for batch in rows:
            times = batch["event_time"].astype("datetime64[us]").astype("int64")
            for rid, t, stars in zip(batch["review_id"], times, batch["stars"]):
                if t <= watermark_us:
                    out.append(self._row(business, rid, t, LATE, None, None))
                else:
                    new.setdefault(self._minute(t), []).append((rid, int(t), None if pd.isna(stars) else int(stars)))
        w = self._windows()
        before = _Windows(dict(w.sums), self.thr)
        held = {}
        fresh: dict[int, int] = {}  # minute -> number of rows it held before
        for minute, added in new.items():
            old = self.held.getValue((minute,)) if self.held.containsKey((minute,)) else None
            ids, times, starts = ([], [], []) if old is None else map(list, old)
            known = set(zip(ids, times))
            fresh[minute] = len(ids)
            rows_, n, s, ss, neg = w.sums.get(minute, _ZERO)
            for rid, t, stars in added:
                if (rid, t) in known:
                    out.append(self._row(business, rid, t, DUPLICATE, None, None))
                    continue
                known.add((rid, t))
                ids.append(rid)
                times.append(t)
                starts.append(-1)
                rows_ += 1
                if stars is not None:
                    n, s, ss, neg = n + 1, s + stars, ss + stars * stars, neg + (stars <= self.thr.negative_max_stars)
            w.sums[minute] = (rows_, n, s, ss, neg)
            held[minute] = (ids, times, starts)
            if old is None:
                self._set_timers(minute)
        # minutes whose windows changed their verdict
        step = self.thr.slide_minutes
        touched = sorted({start for m in new for start in range(m - self.thr.window_minutes + step, m + 1, step)})
        turned = [start for start in touched if w.flagged(start) != before.flagged(start)]
        again = {m for start in turned for m in range(start, start + w.reach + 1, step)} - set(held)
        for minute in again:
            if self.held.containsKey((minute,)):
                held[minute] = tuple(map(list, self.held.getValue((minute,))))
        for minute, (ids, times, starts) in sorted(held.items()):
            first_new, changed = fresh.get(minute, len(ids)), minute in fresh
            for i, (rid, t) in enumerate(zip(ids, times)):
                start = w.first(minute, t)
                mark = -1 if start is None else start
                if i >= first_new:
                    out.append(self._row(business, rid, t, PROVISIONAL, start, w))
                elif mark != starts[i]:
                    out.append(self._row(business, rid, t, REVISED, start, w))
                changed |= mark != starts[i]
                starts[i] = mark
            if changed:
                self.held.updateValue((minute,), (ids, times, starts))
        for minute in new:
            self.sums.updateValue((minute,), w.sums[minute])
        if out:
            yield self._frame(out)

    def _set_timers(self, minute: int) -> None:
        """One when the minute's rows are final, one when no other minute needs its sums."""
        reach = self.thr.window_minutes + self.thr.grace_minutes
        for m in (minute + self.thr.window_minutes, minute + self.thr.window_minutes + reach):
            self.handle.registerTimer(m * 60_000 - self.slack_ms)

    # -- minutes that the watermark has passed ------------------------------
    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        at = (expiredTimerInfo.getExpiryTimeInMs() + self.slack_ms) // 60_000
        minute = at - self.thr.window_minutes
        if self.held.containsKey((minute,)):
            w = self._windows()
            ids, times, _ = self.held.getValue((minute,))
            out = [self._row(key[0], rid, t, FINAL, w.first(minute, t), w) for rid, t in zip(ids, times)]
            self.held.removeKey((minute,))
            if out:
                yield self._frame(out)
        done = minute - self.thr.window_minutes - self.thr.grace_minutes
        if self.sums.containsKey((done,)):
            self.sums.removeKey((done,))


def live_labels(reviews: DataFrame, thr: Thresholds = DEFAULT, time_col: str = "event_time") -> DataFrame:
    """Provisional, revised, final, late and duplicate rows of the stream
    ``reviews`` (without a watermark of its own). Needs state in RocksDB
    (:func:`shoal.streaming.detect_stream.use_rocksdb_state`)."""
    narrow = (reviews.select("review_id", "business_id", F.col(time_col).alias("event_time"), F.col("stars").cast("long").alias("stars"))
              .withWatermark("event_time", f"{thr.watermark_minutes + SLACK_DAYS * 1440} minutes"))
    return narrow.groupBy("business_id").transformWithStateInPandas(
        statefulProcessor=LiveLabeller(thr), outputStructType=OUTPUT, outputMode="Append", timeMode="EventTime")


def live_output(lines: DataFrame, thr: Thresholds = DEFAULT) -> DataFrame:
    """Labels of a ``value`` stream together with its rejects (status, raw), so that one
    query with one checkpoint accounts for every line."""
    p = parse_lines(lines)
    labels = live_labels(p.where(F.col("status") == VALID).select("review_id", "business_id", "event_time", "stars"), thr)
    rejects = p.where(~F.col("status").isin(VALID, BLANK)).select("status", "raw")
    return labels.unionByName(rejects, allowMissingColumns=True)


def live_sink(base: str):
    """foreachBatch function: appends the rows of a batch, by status, under
    ``base``. A retried batch replaces its own files."""
    def write(batch_df: DataFrame, batch_id: int) -> None:
        (batch_df.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id", "status").parquet(base))
    return write


def reconcile(spark: SparkSession, base: str) -> DataFrame:
    """(accepted, late, duplicate, rejected, total): the lines that the written
    batches account for, over any number of restarts."""
    rows = spark.read.parquet(base)
    count = lambda cond: F.count_if(cond)
    status = F.col("status")
    return rows.agg(
        count(status == PROVISIONAL).alias("accepted"), count(status == LATE).alias("late"), count(status == DUPLICATE).alias("duplicate"),
        count(~status.isin(*ONCE, REVISED, FINAL)).alias("rejected"), count(~status.isin(REVISED, FINAL)).alias("total"))


def current_labels(spark: SparkSession, base: str) -> DataFrame:
    """The latest row of every accepted review: final, else the last revision,
    else the provisional one."""
    rows = spark.read.parquet(base).where(F.col("status").isin(PROVISIONAL, REVISED, FINAL))
    rank = F.when(F.col("status") == FINAL, 2).when(F.col("status") == REVISED, 1).otherwise(0)
    last = rows.groupBy("review_id", "event_time").agg(F.max_by(F.struct("*"), F.struct(F.col("batch_id"), rank)).alias("r"))
    return last.select("r.*").drop("raw")
