"""Online features of open sessions as a stream, with state and timers per user.

A session window gives a session when it is over. A reader of online features
wants the one that is still open, so the sessions that can still change are
kept as state here, the newest one is given whenever it changes, and a timer
says when it has expired.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.query import StreamingQuery

from meterlake.functions import scalars as S
from meterlake.operators.features import ONLINE_NAMES
from meterlake.schemas import FEATURE_TTL_SECONDS
from meterlake.sources.online import online_rows, publish_online_features
from meterlake.streaming.jobs import AVAILABLE_NOW, ROCKS_DB
from meterlake.streaming.windows import EVENT_TIME

SESSION = "first bigint, last bigint, cost double, tokens bigint, latency double, calls bigint, last_id string, model string"
CHANGE = f"user_id string, {SESSION}, expired boolean"
FIELDS = ["first", "last", "cost", "tokens", "latency", "calls", "last_id", "model"]
CHANGED = Row("user_id", *FIELDS, "expired")
CALLS_AT_ONCE = 10_000


def sessions_of(calls: list[dict], gap: int) -> list[tuple]:
    """Sessions (FIELDS) of calls of one user (at, cost, tokens, latency, id, model), in any order."""
    return merged([
        (c["at"], c["at"], c["cost"] or 0.0, c["tokens"] or 0, c["latency"] or 0.0, 1, c["id"], c["model"]) for c in calls
    ], gap)


def merged(sessions: list[tuple], gap: int) -> list[tuple]:
    """Sessions in order, with those put together that lie less than the gap apart."""
    out: list[tuple] = []
    for s in sorted(sessions, key=lambda s: (s[0], s[6] or "")):
        if out and s[0] - out[-1][1] < gap:
            o = out[-1]
            last = max(o, s, key=lambda x: (x[1], x[6] or ""))
            out[-1] = (o[0], last[1], o[2] + s[2], o[3] + s[3], o[4] + s[4], o[5] + s[5], last[6], last[7])
        else:
            out.append(s)
    return out


class OpenSessions(StatefulProcessor):
    """State per user: the sessions that a call after the watermark can still reach, at most one per gap of its delay."""

    def __init__(self, gap_seconds: int):
        self.gap = gap_seconds * 1_000_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.sessions = handle.getListState("sessions", SESSION)

    def _expiry(self, session: tuple) -> int:
        """The moment a session expires; a timer counts milliseconds."""
        return -(-(session[1] + self.gap) // 1000)

    def _timer(self, before: tuple | None, newest: tuple) -> None:
        """One timer, at the expiry of the newest session. Every call goes to the task's JVM and back, so only a changed one is set."""
        at = self._expiry(newest)
        if before is not None:
            if self._expiry(before) == at:
                return
            self.handle.deleteTimer(self._expiry(before))
        self.handle.registerTimer(at)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        stored = [tuple(s) for s in self.sessions.get()]
        before, sessions = stored[-1] if stored else None, stored
        while calls := [r["call"] for r in islice(rows, CALLS_AT_ONCE)]:
            sessions = merged(sessions + sessions_of(calls, self.gap), self.gap)
        watermark = timerValues.getCurrentWatermarkInMs() * 1000
        kept = [s for s in sessions[:-1] if s[1] + self.gap > watermark] + sessions[-1:]
        self.sessions.put(kept)
        self._timer(before, kept[-1])
        if kept[-1] != before:
            yield CHANGED(key[0], *kept[-1], False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        sessions = [tuple(s) for s in self.sessions.get()]
        if sessions and self._expiry(sessions[-1]) <= timerValues.getCurrentWatermarkInMs():
            self.sessions.clear()
            yield CHANGED(key[0], *sessions[-1], True)

    def close(self) -> None:
        pass


def open_sessions(stream: DataFrame, gap_seconds: int = FEATURE_TTL_SECONDS) -> DataFrame:
    """Changes of each user's newest session, and its expiry, of a stream with the watermark column.

    Columns as activity_sessions has them, and expired. A call exactly the gap
    after the last one starts again; late calls within the watermark join,
    extend or bridge sessions. Calls without a user are left out. State ends
    when the watermark passes a session's expiry; each row of a user is added
    to a few sums, so a user with very many calls costs no memory.
    """
    # One column, as Python turns every cell into an object of its own.
    call = F.struct(
        S.micros("timestamp").alias("at"), F.col("cost_usd").cast("double").alias("cost"),
        F.col("total_tokens").cast("long").alias("tokens"), F.col("latency_ms").cast("double").alias("latency"),
        F.col("interaction_id").alias("id"), "model")
    calls = stream.where("user_id IS NOT NULL AND timestamp IS NOT NULL").select("user_id", call.alias("call"), EVENT_TIME)
    changes = calls.groupBy("user_id").transformWithState(OpenSessions(gap_seconds), CHANGE, "Update", "EventTime")
    return changes.select(
        "user_id", F.col("cost").alias("total_cost"), F.col("tokens").alias("total_tokens"), F.col("calls").alias("interaction_count"),
        (F.col("latency") / F.col("calls")).alias("avg_latency"), F.col("model").alias("last_model"),
        S.from_micros("first").alias("session_start"), S.from_micros("last").alias("last_interaction_time"),
        S.from_micros(F.col("last") + gap_seconds * 1_000_000).alias("expires_at"), "expired")


def publish_sessions(changes: DataFrame, online: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Write every change to the online store, as entries of the six names that expire with the session.

    A later batch replaces an earlier one's entries, and a repeated batch
    writes the same values. A reader sees what is open at its moment, whether
    the stream has noticed an expiry or not.
    """
    changes.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS_DB)

    def publish(batch: DataFrame, batch_id: int) -> None:
        rows = batch.where("NOT expired")
        now = F.current_timestamp().cast("timestamp_ntz")
        publish_online_features(online_rows(rows, ONLINE_NAMES, now, expires_at=F.col("expires_at")), online)

    writer = changes.writeStream.outputMode("update").foreachBatch(publish)
    return writer.option("checkpointLocation", checkpoint).trigger(**(trigger or AVAILABLE_NOW)).start()
