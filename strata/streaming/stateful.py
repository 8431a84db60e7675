"""Stateful stream operators with their own state and timers
(``transformWithState``): dedup that keeps the newest copy, and gap sessions
emitted while they are still open.

Both emit again when a later row changes what was emitted. Every emission
carries a ``version``; the newest version of a key is its current row
(``current_rows``), which a sink can also apply as a keyed upsert. State is
dropped by event-time timers once the watermark makes a change impossible.
Needs a state store that supports it (``state_store``).

A group is a bucket of keys (hash of the key), not one key: a state value, a
timer and a call of the processor cost as much for one row as for thousands,
so a micro-batch pays for them once per bucket. A bucket's keys are handled
together, as columns. The number of buckets stays as it is for the life of a
checkpoint; it bounds what one call holds to the open rows of one bucket.
"""

from __future__ import annotations

import pickle
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

STATE_STORE = ("spark.sql.streaming.stateStore.providerClass",
               "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


@contextmanager
def state_store(spark: SparkSession):
    """Streams started inside use ``STATE_STORE``; the setting is put back."""
    before = spark.conf.get(STATE_STORE[0])
    spark.conf.set(*STATE_STORE)
    try:
        yield
    finally:
        spark.conf.set(STATE_STORE[0], before)


def current_rows(emitted: DataFrame, keys) -> DataFrame:
    """The newest emission per key, without retracted ones."""
    newest = Window.partitionBy(*keys).orderBy(F.desc("version"))
    rows = emitted.withColumn("_k", F.row_number().over(newest)).filter("_k = 1").drop("_k", "version")
    return rows.filter(~F.col("retracted")).drop("retracted") if "retracted" in emitted.columns else rows


BUCKETS = 128
_BUCKET = "_bucket"


def _in_buckets(events: DataFrame, key: str, buckets: int):
    return events.withColumn(_BUCKET, F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")).groupBy(_BUCKET)


def _micros(ts: pd.Series) -> np.ndarray:
    """Microseconds of times that are all set."""
    return ts.to_numpy("datetime64[us]").astype("int64")


def _one_timer(handle: StatefulProcessorHandle, at: int | None) -> None:
    """The bucket's timer goes to ``at`` (milliseconds; None: it has none)."""
    held = list(handle.listTimers())
    for t in held:
        if t != at:
            handle.deleteTimer(t)
    if at is not None and at not in held:
        handle.registerTimer(at)


# ------------------------------------------------------------------- dedup


class _Newest(StatefulProcessor):
    """One newest row per key of a bucket, with its version."""

    def __init__(self, columns, key: str, order, delay_ms: int):
        self.columns, self.key, self.order, self.delay = columns, key, order, delay_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("newest", "rows binary")

    def _ends(self, rows: pd.DataFrame) -> pd.Series:
        """Milliseconds at which a row with a time goes."""
        return pd.Series(_micros(rows[self.order[0]]) // 1000 + self.delay, index=rows.index, dtype="int64")

    def _store(self, rows: pd.DataFrame) -> None:
        if len(rows):
            self.held.update((pickle.dumps(rows),))
        elif self.held.exists():
            self.held.clear()
        timed = rows[rows[self.order[0]].notna()]
        _one_timer(self.handle, int(self._ends(timed).min()) if len(timed) else None)

    def _best(self, rows: pd.DataFrame) -> pd.DataFrame:
        """Newest row per key, missing values first; of equal rows the first."""
        several = rows[self.key].duplicated(keep=False)
        if not several.any():
            return rows
        ranked = rows[several].sort_values(self.order, ascending=False, kind="stable", na_position="last")
        return pd.concat([rows[~several], ranked.drop_duplicates(self.key)])

    def handleInputRows(self, key, rows, timerValues):
        came = [self._best(batch[self.columns]).assign(version=0) for batch in rows]      # version 0: not held yet
        held = [pickle.loads(self.held.get()[0])] if self.held.exists() else []
        best = self._best(pd.concat([*held, *came], ignore_index=True))
        fresh = best["version"] == 0
        if not fresh.any():
            return
        if held:
            before = held[0].set_index(self.key)["version"]
            best.loc[fresh, "version"] = best.loc[fresh, self.key].map(before).fillna(0).astype("int64")
        best["version"] += fresh.astype("int64")
        self._store(best)
        yield best[fresh]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        rows, mark = pickle.loads(self.held.get()[0]), timerValues.getCurrentWatermarkInMs()
        timed = rows[rows[self.order[0]].notna()]
        self._store(rows.drop(timed.index[self._ends(timed) <= mark]))
        yield pd.DataFrame()

    def close(self) -> None:
        pass


def dedup_newest(events: DataFrame, key: str, ts: str, delay: str, delay_ms: int, buckets: int = BUCKETS) -> DataFrame:
    """Newest copy per ``key``, by time and then the remaining columns (as
    ``operators.cleaning.latest_per_key``): a row is emitted when it is newer
    than what its key holds, with the next ``version``. A copy that arrives
    after the watermark has passed the held row's time by ``delay`` finds no
    state; one behind the watermark is dropped. Output mode: update."""
    columns = events.columns
    order = [ts, *[c for c in columns if c not in (key, ts)]]
    out = T.StructType([*events.schema.fields, T.StructField("version", T.LongType())])
    return _in_buckets(events.withWatermark(ts, delay), key, buckets).transformWithStateInPandas(
        statefulProcessor=_Newest(columns, key, order, delay_ms), outputStructType=out, outputMode="Update", timeMode="EventTime")


# ---------------------------------------------------------------- sessions

SESSION_OUT = ("user_id long, session_start_time timestamp, session_end_time timestamp, total_events long, "
               "first_event_type string, last_event_type string, closed boolean, retracted boolean, version long")
_FIRST, _LAST = ("start", "first_id", "first_type"), ("end", "last_id", "last_type")


def _ordered(spans: pd.DataFrame, by, row) -> pd.DataFrame:
    """Spans by the columns ``by`` and then one of their two rows (microseconds, event id, type)."""
    at, number, kind = row
    kinds = pd.factorize(spans[kind], sort=True)[0]
    return spans.iloc[np.lexsort((kinds, spans[number], spans[at], *reversed([spans[c] for c in by])))]


def _merged(spans: pd.DataFrame, gap: int) -> pd.DataFrame:
    """Spans of one user less than ``gap`` apart become one, which is held
    (``is_held``) only if it is made of held ones."""
    s = _ordered(spans, ["no_user", "user_id"], _FIRST).reset_index(drop=True)
    user = s.groupby(["no_user", "user_id"], sort=False)
    reach = user["end"].cummax().groupby([s["no_user"], s["user_id"]], sort=False).shift(fill_value=0)
    s["_k"] = ((user.cumcount() == 0) | (s["start"] - reach >= gap)).cumsum()
    if s["_k"].iat[-1] == len(s):
        return s.drop(columns="_k")
    of = s.groupby("_k", sort=True)
    out = s.drop_duplicates("_k")[["no_user", "user_id", *_FIRST]].reset_index(drop=True)
    last = _ordered(s, ["_k"], _LAST).drop_duplicates("_k", keep="last").reset_index(drop=True)
    return out.assign(**{c: last[c] for c in _LAST}, n=of["n"].sum().to_numpy(), is_held=of["is_held"].all().to_numpy())


class _OpenSessions(StatefulProcessor):
    """Open sessions of a bucket of users: the first and last row of each
    (microseconds, event id, type) and the number of its rows."""

    def __init__(self, gap_us: int):
        self.gap = gap_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("open", "sessions binary, version long")

    def _load(self):
        state = self.held.get() if self.held.exists() else None
        return (pickle.loads(state[0]), state[1]) if state else (None, 0)

    def _ends(self, spans: pd.DataFrame) -> pd.Series:
        """Milliseconds at which a session closes."""
        return (spans["end"] + self.gap) // 1000 + 1

    def _store(self, spans: pd.DataFrame, version: int) -> None:
        self.held.update((pickle.dumps(spans), version))        # the version outlives the sessions
        _one_timer(self.handle, int(self._ends(spans).min()) if len(spans) else None)

    def _rows(self, spans: pd.DataFrame, closed: bool, gone: bool, version: int) -> pd.DataFrame:
        return pd.DataFrame({
            "user_id": spans["user_id"].astype("Int64").mask(spans["no_user"]), "session_start_time": pd.to_datetime(spans["start"], unit="us"),
            "session_end_time": pd.to_datetime(spans["end"], unit="us"), "total_events": spans["n"],
            "first_event_type": spans["first_type"], "last_event_type": spans["last_type"], "closed": closed,
            "retracted": gone, "version": version})

    def _spans(self, rows: pd.DataFrame) -> pd.DataFrame | None:
        rows = rows[rows["event_timestamp"].notna()]
        if not len(rows):
            return None
        at, number = _micros(rows["event_timestamp"]), rows["event_id"].astype("int64")
        return _merged(pd.DataFrame({
            "no_user": rows["no_user"].astype("bool"), "user_id": rows["user_id"].astype("int64"), "start": at, "first_id": number,
            "first_type": rows["event_type"], "end": at, "last_id": number, "last_type": rows["event_type"], "n": 1, "is_held": False}), self.gap)

    def handleInputRows(self, key, rows, timerValues):
        held, version = self._load()
        came = [s for s in map(self._spans, rows) if s is not None]
        if not came:
            return
        after = _merged(pd.concat([*([] if held is None else [held]), *came], ignore_index=True), self.gap)
        changed = after[~after["is_held"]]
        self._store(after.assign(is_held=True), version + 1)
        yield self._rows(changed, False, False, version + 1)
        if held is not None:
            starts = ["no_user", "user_id", "start"]
            gone = held[~pd.MultiIndex.from_frame(held[starts]).isin(pd.MultiIndex.from_frame(after[starts]))]
            if len(gone):
                yield self._rows(gone, False, True, version + 1)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        held, version = self._load()
        done = self._ends(held) <= timerValues.getCurrentWatermarkInMs()
        self._store(held[~done], version + 1)
        yield self._rows(held[done], True, False, version + 1)

    def close(self) -> None:
        pass


def open_sessions(events: DataFrame, gap_seconds: int, delay: str, buckets: int = BUCKETS) -> DataFrame:
    """Sessions by inactivity gap per user, emitted whenever they change: a
    late event can extend a session to either side or join two (the later
    one is retracted, by its start). A timer closes a session when the
    watermark is a gap past its end. ``events``: event_id, user_id,
    event_type, event_timestamp; rows without a time belong to no session.
    Output mode: update."""
    rows = events.select("event_id", F.coalesce("user_id", F.lit(0)).cast("long").alias("user_id"), F.col("user_id").isNull().alias("no_user"),
                         "event_type", "event_timestamp")      # no NULL among the ids: pandas would turn them into doubles
    return _in_buckets(rows.withWatermark("event_timestamp", delay), "user_id", buckets).transformWithStateInPandas(
        statefulProcessor=_OpenSessions(gap_seconds * 1_000_000), outputStructType=SESSION_OUT, outputMode="Update", timeMode="EventTime")


def run_to_parquet(emitted: DataFrame, path: str, checkpoint: str):
    """Append every emission to a table by micro-batch; a replayed batch
    replaces its own."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{path}/batch={batch_id}")

    return (emitted.writeStream.foreachBatch(write).outputMode("update").option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
