"""Structured Streaming: late and repeated rows of an id-keyed feed, and sessions that close."""

from __future__ import annotations

import datetime
import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions.calendar import to_session
from ..operators.news import mentions


def read_batches(spark: SparkSession, path: str, schema: str, files: int = 1) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)


def session_counts(stream: DataFrame, calendar: DataFrame, delay: str = "1 hour", near: int = 60) -> DataFrame:
    """Mention counts of each session and code, given out once the watermark has passed the session's close.

    Items look up their session by day in the calendar; the close is the event time, so state holds open sessions only.
    """
    items = to_session(stream, calendar).withWatermark("closes_at", delay)
    return items.groupBy("closes_at", "date", "tdi", "code").agg(*mentions(near))


#: Of a code: its last closed session, the mentions in that and in the one before it, and its open sessions as JSON.
FEATURE_STATE = "last int, n0 long, n1 long, open string"
FEATURE_ROWS = "date date, tdi int, code {code}, n_em long, n_cls long, n_near long, latest double, n_3d long, novel int"


def _sessions_of_code(near: int, gap: int):
    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last, n0, n1, held = state.get if state.exists else (None, 0, 0, "{}")
        # tdi -> [close in ms, day, n_em, n_cls, n_near, latest]
        sessions = {int(t): s for t, s in json.loads(held).items()}
        for f in [] if state.hasTimedOut else frames:
            for (tdi, day, close), g in f.groupby(["tdi", "date", "closes_at"]):
                s = sessions.setdefault(int(tdi), [int(close.timestamp() * 1000), str(day), 0, 0, 0, None])
                s[2] += int((g["feed"] == "em").sum())
                s[3] += int((g["feed"] == "cls").sum())
                s[4] += int((g["minutes_to_close"] <= near).sum())
                s[5] = float(g["minutes_to_close"].min()) if s[5] is None else min(s[5], float(g["minutes_to_close"].min()))
        now, rows = state.getCurrentWatermarkMs(), []
        for tdi in sorted(t for t, s in sessions.items() if s[0] <= now):
            _, day, n_em, n_cls, n_near, latest = sessions.pop(tdi)
            away, n = None if last is None else tdi - last, n_em + n_cls
            before = (n0, n1) if away == 1 else (0, n0) if away == 2 else (0, 0)
            rows.append((datetime.date.fromisoformat(day), tdi, key[0], n_em, n_cls, n_near, latest, n + sum(before), int(away is None or away > gap)))
            last, n0, n1 = tdi, n, before[0]
        state.update((last, n0, n1, json.dumps(sessions)))
        if sessions:
            state.setTimeoutTimestamp(max(min(s[0] for s in sessions.values()) - 1, now + 1))
        if rows:
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in FEATURE_ROWS.split(", ")])

    return step


def session_features(stream: DataFrame, calendar: DataFrame, delay: str = "1 hour", near: int = 60, gap: int = 5) -> DataFrame:
    """Mention counts of each session and code with n_3d, mentions in the last three sessions, and novel, whether the code was away for more than ``gap``.

    A session is given out once the watermark has passed its close, when no item can change it; each code's come in order and once, and after a
    restart the state goes on from the checkpoint. A code's state is three numbers and its open sessions, of which the delay bounds the number, whatever its history.
    """
    items = to_session(stream, calendar).withWatermark("closes_at", delay).select("code", "feed", "date", "tdi", "closes_at", "minutes_to_close")
    schema = FEATURE_ROWS.format(code=items.schema["code"].dataType.simpleString())
    return items.groupBy("code").applyInPandasWithState(_sessions_of_code(near, gap), schema, FEATURE_STATE, "append", GroupStateTimeout.EventTimeTimeout)


def overlap_dedupe(stream: DataFrame, key: str = "id", ts: str = "ts", delay: str = "7 days") -> DataFrame:
    """First arrival of each id; re-reads within the delay are caught by state that the watermark bounds."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])


def drain(stream: DataFrame, path: str) -> DataFrame:
    """Run what is available through the stream into a Parquet table with its own checkpoint, and read it."""
    q = stream.writeStream.format("parquet").option("path", f"{path}/data").option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start()
    q.awaitTermination()
    return stream.sparkSession.read.parquet(f"{path}/data")
