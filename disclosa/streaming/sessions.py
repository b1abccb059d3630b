"""Sessions on streams: windows over events, and the points machine as a keyed stateful processor."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from disclosa.operators.sessions import COSTS, IDLE, START

RESULT = "session_id long, seq long, action string, accepted boolean, error string, points int"


def session_counts(events: DataFrame, key: str, ts: str, gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    """Sessions closed by silence; the watermark drops their state."""
    stamped = events.withColumn("_ts", F.col(ts).cast("timestamp")).withWatermark("_ts", late)
    return stamped.groupBy(key, F.session_window("_ts", gap).alias("w")).agg(F.count("*").alias("n")).select(key, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def window_counts(events: DataFrame, ts: str, size: str = "1 hour", slide: str | None = None, late: str = "1 hour") -> DataFrame:
    """Tumbling or sliding counts by event type."""
    stamped = events.withColumn("_ts", F.col(ts).cast("timestamp")).withWatermark("_ts", late)
    return stamped.groupBy(F.window("_ts", size, slide).alias("w") if slide else F.window("_ts", size).alias("w"), "event_type").agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), "event_type", "n")


def points(actions: DataFrame) -> DataFrame:
    """The rules of disclosa.operators.sessions.points on a stream of (session_id, seq, action).

    State is the points left and whether a decision was made; a session idle for IDLE seconds is dropped.
    """

    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        left, decided = state.get if state.exists else (START, False)
        rows = []
        for turn in pd.concat(list(frames)).sort_values("seq").itertuples():
            price = COSTS.get(turn.action)
            locked = turn.action == "replay" and not decided
            error = "unknown_action" if price is None else "no_points" if left < price else "replay_locked" if locked else None
            if error in (None, "replay_locked"):
                left -= price
            decided = decided or (error is None and turn.action == "decision")
            rows.append((key[0], turn.seq, turn.action, error is None, error, left))
        state.update((left, decided))
        state.setTimeoutDuration(IDLE * 1000)
        yield pd.DataFrame(rows, columns=["session_id", "seq", "action", "accepted", "error", "points"])

    return actions.groupBy("session_id").applyInPandasWithState(run, RESULT, "points int, decided boolean", "append", GroupStateTimeout.ProcessingTimeTimeout)


def run_once(stream: DataFrame, path: str, checkpoint: str, one_batch: bool = False) -> None:
    """Writes what there is to a Parquet table and ends.

    one_batch: for processors with processing-time timeouts, which otherwise ask for another empty batch forever.
    """
    trigger = {"once": True} if one_batch else {"availableNow": True}
    stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(**trigger).start().awaitTermination()
