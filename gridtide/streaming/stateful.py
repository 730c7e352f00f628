"""Operators that remember one small value per region between micro-batches."""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions import lookups as L
from ..sources.schemas import table_schema

# the functions below travel with the job, so executors need no installed package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

CHANGE_SCHEMA = table_schema(
    "region_id string, timestamp timestamp, demand_mw double, previous_mw double, "
    "change_mw double, acceleration_mw double"
)


class _Change(StatefulProcessor):
    """Change of demand and change of that change, per region and reading time.

    Readings wait until the watermark has passed their time, and then go out in order; those
    of one time count once, by their lowest value.  The result depends on the readings that
    came within the watermark's delay, and not on where micro-batches were cut.  State is the
    last reading with its change, and the waiting times, which the delay bounds.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._last = handle.getValueState("last", "at bigint, mw double, change double")
        self._waiting = handle.getValueState("waiting", "at array<bigint>, mw array<double>")

    def _load(self) -> pd.Series:
        if not self._waiting.exists():
            return pd.Series(dtype="float64", index=pd.Index([], dtype="int64"))
        at, mw = self._waiting.get()
        return pd.Series(np.array(mw, dtype="float64"), index=np.array(at, dtype="int64"))

    def _keep(self, waiting: pd.Series) -> None:
        if not len(waiting):
            self._waiting.clear()
            return
        self._waiting.update((waiting.index.tolist(), waiting.tolist()))
        # the first waiting time, in whole milliseconds from above
        self._handle.registerTimer(-(-int(waiting.index[0]) // 1000))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        waiting = self._load()
        for chunk in rows:
            part = chunk.groupby("at")["demand_mw"].min()
            waiting = pd.concat([waiting, part]).groupby(level=0).min()
        if self._last.exists():
            waiting = waiting[waiting.index > self._last.get()[0]]
        self._keep(waiting)
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        waiting = self._load()
        passed = waiting.index <= timerValues.getCurrentWatermarkInMs() * 1000
        ready = waiting[passed]
        if not len(ready):
            return
        self._keep(waiting[~passed])
        at = ready.index.to_numpy(dtype="int64")
        values = ready.to_numpy(dtype="float64")
        known = self._last.get() if self._last.exists() else None
        before = np.concatenate([[np.nan if known is None else known[1]], values[:-1]])
        change = values - before
        first = np.nan if known is None or known[2] is None else known[2]
        faster = change - np.concatenate([[first], change[:-1]])
        last_change = None if np.isnan(change[-1]) else float(change[-1])
        self._last.update((int(at[-1]), float(values[-1]), last_change))
        yield pd.DataFrame(
            {
                "region_id": key[0],
                "timestamp": pd.to_datetime(at, unit="us"),
                "demand_mw": values,
                "previous_mw": before,
                "change_mw": change,
                "acceleration_mw": faster,
            }
        )

    def close(self) -> None:
        pass


def _lowest_per_time(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        yield pdf.groupby(["region_id", "at"], as_index=False)["demand_mw"].min()


def _distinct(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        yield pdf.drop_duplicates()


def demand_change(live: DataFrame, delay: str = L.DEMAND_WATERMARK) -> DataFrame:
    """Stream of changes per region; needs the RocksDB state store.

    A reading goes out once the watermark, ``delay`` behind the newest reading, has passed it.
    Rows are reduced per time before the shuffle, so the task of a busy region gets one row
    per time and Arrow batch.
    """
    slim = live.where(F.col("timestamp").isNotNull() & F.col("region_id").isNotNull()).select(
        "region_id", F.unix_micros("timestamp").alias("at"), "demand_mw"
    )
    reduced = slim.mapInPandas(_lowest_per_time, slim.schema)
    timed = reduced.withColumn("timestamp", F.timestamp_micros("at")).withWatermark("timestamp", delay)
    return timed.groupBy("region_id").transformWithStateInPandas(
        statefulProcessor=_Change(),
        outputStructType=CHANGE_SCHEMA,
        outputMode="Append",
        timeMode="EventTime",
    )


ALERT_SCHEMA = table_schema("region_id string, alert_time timestamp")


def _fire(instants: np.ndarray, last: int | None, cooldown: int) -> list[int]:
    """Ordered instants at which an alert goes out: none within the cooldown after another."""
    fired = []
    at = 0 if last is None else int(np.searchsorted(instants, last + cooldown))
    while at < len(instants):
        fired.append(int(instants[at]))
        at = int(np.searchsorted(instants, fired[-1] + cooldown))
    return fired


def _instants(chunks: Iterable[pd.DataFrame]) -> np.ndarray:
    seen = np.empty(0, dtype="int64")
    for chunk in chunks:
        seen = np.union1d(seen, chunk["micros"].to_numpy(dtype="int64"))
    return seen


def _alerts(region: str, fired: list[int]) -> pd.DataFrame:
    times = pd.to_datetime(np.array(fired, dtype="int64"), unit="us")
    return pd.DataFrame({"region_id": [region] * len(fired), "alert_time": times})


def _known(anomalies: DataFrame) -> DataFrame:
    known = F.col("timestamp").isNotNull() & F.col("region_id").isNotNull()
    micros = F.unix_micros(F.col("timestamp").cast("timestamp"))
    return anomalies.where(known).select("region_id", micros.alias("micros"))


def alert_cooldown(anomalies: DataFrame, minutes: int = L.ALERT_COOLDOWN_MINUTES) -> DataFrame:
    """Stream of alerts: an anomaly raises one unless its region had one in the cooldown.

    State is the instant of the region's last alert, in microseconds.  Repeated instants are
    dropped before the shuffle and again as they arrive.
    """

    def step(key, chunks, state):  # noqa: ANN001
        last = state.get[0] if state.exists else None
        fired = _fire(_instants(chunks), last, minutes * 60_000_000)
        if fired:
            state.update((fired[-1],))
            yield _alerts(key[0], fired)

    slim = _known(anomalies)
    reduced = slim.mapInPandas(_distinct, slim.schema)
    return reduced.groupBy("region_id").applyInPandasWithState(
        step, ALERT_SCHEMA, "last bigint", "append", "NoTimeout"
    )
