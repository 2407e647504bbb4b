"""The two stateful batch patterns as streams: hourly flow that grows, and trips that a vehicle broke off and went on with."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def hourly_counts(visits: DataFrame, time: str = "at", keys: tuple[str, ...] = ("unit", "vehicle_type"), late: str = "2 hours") -> DataFrame:
    """Visits of each hour and key; rows later than `late` are dropped, as the watermark says."""
    return visits.withWatermark(time, late).groupBy(F.window(time, "1 hour").alias("w"), *keys).agg(F.count("*").alias("flow_cnt")).select(F.col("w.start").alias("stat_hour"), *keys, "flow_cnt")


def continued_trips(trips: DataFrame, hours: float = 6.0) -> DataFrame:
    """Consecutive trips of a vehicle at most `hours` apart. trips: vehicle, event_id, enid, exid, entime, extime (timestamps), in event time order a vehicle.

    A vehicle's last trip is its state; it is forgotten `hours` after its end in event time.
    """
    out = "vehicle bigint, event_id bigint, next_event_id bigint, enid string, exid string, next_enid string, next_exid string"
    state = "event_id bigint, enid string, exid string, extime timestamp"

    def follow(key: tuple, parts: Iterator[pd.DataFrame], held: GroupState) -> Iterator[pd.DataFrame]:
        if held.hasTimedOut:
            held.remove()
            return
        last = held.get if held.exists else None
        found = []
        for row in pd.concat(list(parts)).sort_values(["entime", "event_id"]).itertuples(index=False):
            if last is not None:
                gap = (row.entime - pd.Timestamp(last[3])).total_seconds() / 3600
                if 0 <= gap <= hours and last[2] != row.enid:
                    found.append((key[0], last[0], row.event_id, last[1], last[2], row.enid, row.exid))
            last = (row.event_id, row.enid, row.exid, row.extime.to_pydatetime())
        held.update(last)
        held.setTimeoutTimestamp(max(int(pd.Timestamp(last[3]).timestamp() * 1000 + hours * 3_600_000), held.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame(found, columns=["vehicle", "event_id", "next_event_id", "enid", "exid", "next_enid", "next_exid"])

    return trips.withWatermark("entime", f"{int(hours * 60)} minutes").groupBy("vehicle").applyInPandasWithState(follow, out, state, "append", GroupStateTimeout.EventTimeTimeout)
