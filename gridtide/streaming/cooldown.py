"""Alert cooldown over a stored history: a scan over days instead of a walk over all rows.

What a day does to its region is a step function: from the moment on which alerts are allowed
again (the last alert of the day before, plus the cooldown) to the last alert of the day.
Functions of days are found side by side, composed over spans of days, and only the spans of a
region are chained one after another.  With the alert carried into each day known, all days
fire side by side.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import lookups as L
from .stateful import ALERT_SCHEMA, _alerts, _fire, _known

# the functions below travel with the job, so executors need no installed package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

DAY = 24 * 3600 * 1_000_000
#: Days whose functions one task composes.
SPAN_DAYS = 32
#: No alert is near enough to matter; a moment after all others.
FREE, NEVER = -(1 << 62), (1 << 63) - 1

STEPS = "region_id string, day long, upper array<long>, last array<long>"
SPANS = "region_id string, span long, first_day long, last_day long, upper array<long>, last array<long>"


def merged(upper: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same step function with steps of equal value joined."""
    ends = np.append(last[1:] != last[:-1], True)
    return upper[ends], last[ends]


def day_steps(instants: np.ndarray, start: int, cooldown: int) -> tuple[np.ndarray, np.ndarray]:
    """``upper, last``: the day's last alert if alerts are allowed from ``upper`` or before.

    ``instants`` are ordered and distinct, from ``start`` on.  Only those within the cooldown
    behind the start, and the next one, can be the first alert of the day.
    """
    early = int(np.searchsorted(instants, start + cooldown))
    firsts = min(len(instants), early + 1)
    following = np.searchsorted(instants, instants + cooldown)
    at = np.arange(firsts)
    while True:
        to = following[at]
        more = to < len(instants)
        if not more.any():
            break
        at = np.where(more, to, at)
    upper, last = instants[:firsts], instants[at]
    if firsts == early:
        # alerts can be forbidden until the last anomaly of the day is over
        upper, last = np.append(upper, NEVER), np.append(last, FREE)
    return merged(upper, last)


def evaluate(upper: np.ndarray, last: np.ndarray, allowed: np.ndarray) -> np.ndarray:
    at = np.searchsorted(upper, allowed)
    return np.where(at < len(last), last[np.minimum(at, len(last) - 1)], FREE)


def _steps(row) -> tuple[np.ndarray, np.ndarray]:
    return np.asarray(row.upper, "int64"), np.asarray(row.last, "int64")


def composed(days: pd.DataFrame, cooldown: int) -> tuple[int, int, np.ndarray, np.ndarray]:
    """First and last day and the function of consecutive days of one region."""
    upper = last = first = before = None
    for row in days.sort_values("day").itertuples():
        own = _steps(row)
        if upper is None:
            first, (upper, last) = row.day, own
        else:
            carried = last if row.day == before + 1 else np.full(len(last), FREE)
            upper, last = merged(upper, evaluate(*own, carried + cooldown))
        before = row.day
    return first, before, upper, last


def alert_cooldown_history(
    anomalies: DataFrame, minutes: int = L.ALERT_COOLDOWN_MINUTES, day: int = DAY
) -> DataFrame:
    """The alerts of ``stateful.alert_cooldown`` for a stored history.

    A region is spread over its days, however many rows it has: equal instants count once
    and are dropped before the shuffle, and a task holds the distinct instants of one
    region and day.  What a region's days pass on are steps; at most the instants of a
    day's first ``minutes``, and usually one, because alerts fall into step within the day.
    ``day`` is in microseconds and at least the cooldown.
    """
    cooldown = minutes * 60_000_000
    if day < cooldown:
        raise ValueError("a day is at least as long as the cooldown")

    def summarize(key, pdf):
        instants = np.sort(pdf["micros"].to_numpy("int64"))
        upper, last = day_steps(instants, key[1] * day, cooldown)
        return pd.DataFrame({"region_id": [key[0]], "day": [key[1]], "upper": [upper], "last": [last]})

    def compose(key, pdf):
        first, final, upper, last = composed(pdf, cooldown)
        return pd.DataFrame({
            "region_id": [key[0]], "span": [key[1]], "first_day": [first], "last_day": [final],
            "upper": [upper], "last": [last],
        })

    def chain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        region, carried, before = None, FREE, None
        for pdf in batches:
            found = []
            for row in pdf.itertuples():
                if row.region_id != region or row.first_day != before + 1:
                    carried = FREE
                found.append((row.region_id, row.span, carried))
                carried = int(evaluate(*_steps(row), np.array([carried + cooldown]))[0])
                region, before = row.region_id, row.last_day
            yield pd.DataFrame(found, columns=["region_id", "span", "carried"])

    def spread(key, pdf):
        carried, before, found = None, None, []
        for row in pdf.sort_values("day").itertuples():
            if before is None:
                carried = row.carried
            elif row.day != before + 1:
                carried = FREE
            found.append((key[0], row.day, carried))
            carried = int(evaluate(*_steps(row), np.array([carried + cooldown]))[0])
            before = row.day
        return pd.DataFrame(found, columns=["region_id", "day", "carried"])

    def fire(key, pdf):
        carried = int(pdf["carried"].iloc[0])
        instants = np.sort(pdf["micros"].to_numpy("int64"))
        return _alerts(key[0], _fire(instants, carried, cooldown))

    at_day = F.floor(F.col("micros") / F.lit(day)).cast("long")
    instants = _known(anomalies).distinct().withColumn("day", at_day)
    days = instants.groupBy("region_id", "day").applyInPandas(summarize, STEPS)
    days = days.withColumn("span", F.floor(F.col("day") / SPAN_DAYS).cast("long"))
    spans = days.groupBy("region_id", "span").applyInPandas(compose, SPANS)
    chained = spans.repartition("region_id").sortWithinPartitions("region_id", "span").mapInPandas(
        chain, "region_id string, span long, carried long"
    )
    carried = days.join(chained, ["region_id", "span"]).groupBy("region_id", "span").applyInPandas(
        spread, "region_id string, day long, carried long"
    )
    ready = instants.join(carried, ["region_id", "day"]).select("region_id", "day", "micros", "carried")
    return ready.groupBy("region_id", "day").applyInPandas(fire, ALERT_SCHEMA)
