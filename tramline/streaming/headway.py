"""Live headways: the time since the last report on the same route and direction.

Reports first collapse to ticks per minute window, so a busy line sends its
state no more rows than the clock has ticks. Windows close in time order, which
leaves the state with one timestamp per line and only a sort inside a batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tramline.functions.measures import row_count
from tramline.operators.headway import LINE
from tramline.session import STATE_STORE
from tramline.streaming.kpis import POSITION_DELAY

OUTPUT = "route_id string, direction_id int, timestamp timestamp, reports bigint, headway_seconds double"


def live_ticks(positions: DataFrame, delay: str = POSITION_DELAY) -> DataFrame:
    return (
        positions.withWatermark("timestamp", delay)
        .groupBy(F.window("timestamp", "1 minute").alias("w"), *LINE, F.unix_micros("timestamp").alias("micros"))
        .agg(row_count().alias("reports"))
        .select(*LINE, "micros", "reports"))


class HeadwayProcessor(StatefulProcessor):
    """Keeps the last tick of a line; emits each tick with the time since the one before."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last_tick", "micros bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timer_values) -> Iterator[pd.DataFrame]:
        ticks = pd.concat(list(rows)).sort_values("micros")
        known = self.last.get()
        before = ticks["micros"].shift(1)
        if known is not None:
            before.iloc[0] = known[0]
        self.last.update((int(ticks["micros"].iloc[-1]),))
        yield pd.DataFrame({
            "route_id": key[0], "direction_id": key[1],
            "timestamp": pd.to_datetime(ticks["micros"], unit="us"),
            "reports": ticks["reports"],
            "headway_seconds": (ticks["micros"] - before) / 1e6,
        })

    def close(self) -> None:
        pass


def live_headways(positions: DataFrame, delay: str = POSITION_DELAY) -> DataFrame:
    # transformWithState keeps its state in RocksDB, which the session has to name.
    positions.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    return live_ticks(positions, delay).groupBy(*LINE).transformWithStateInPandas(
        statefulProcessor=HeadwayProcessor(), outputStructType=OUTPUT,
        outputMode="Append", timeMode="None")
