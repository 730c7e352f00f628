"""Streams that are watched and started again.

A feed's policy says how often its state is committed and how failures are met; a monitor
takes counts and latencies out of each micro-batch's observed metrics, so nothing is computed
twice for them.
"""

from __future__ import annotations

import threading
import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ..functions import lookups as L

#: Name of the observed metrics of a watched stream.
METRICS = "arrivals"


@dataclass(frozen=True)
class FeedPolicy:
    """How the stream of a feed runs.

    Spark commits offsets and state with every micro-batch, so a stream that must not lose
    more than ``commit_s`` of work on a failure runs a micro-batch at least that often.
    """

    name: str
    poll_s: float
    commit_s: float
    #: Failures in a row, without a finished micro-batch between them, that are met by a restart.
    restarts: int = 5
    first_wait_s: float = 1.0
    longest_wait_s: float = 300.0

    @property
    def trigger(self) -> str:
        return f"{min(self.poll_s, self.commit_s):g} seconds"

    def wait_s(self, failures: int) -> float:
        """Pause before a restart, doubled by each failure in a row."""
        return min(self.longest_wait_s, self.first_wait_s * 2 ** (failures - 1))


DEMAND = FeedPolicy("demand", L.DEMAND_POLL_S, L.DEMAND_COMMIT_S)
PRICES = FeedPolicy("prices", L.PRICE_POLL_S, L.PRICE_COMMIT_S)


def watched(live: DataFrame, latency: str = "latency_seconds") -> DataFrame:
    """The stream with its rows counted and their latency measured as they pass."""
    return live.observe(
        METRICS,
        F.count("*").alias("rows"),
        F.max(latency).alias("max_latency_s"),
        F.sum(F.when(F.col(latency) > L.LATENCY_TARGET_S, 1).otherwise(0)).alias("late_rows"),
    )


@dataclass
class Health:
    """What a stream did so far, over all its restarts."""

    rows: int = 0
    late_rows: int = 0
    batches: int = 0
    max_latency_s: float | None = None
    #: Longest time from the start of a micro-batch to its commit.
    max_batch_s: float = 0.0
    last_batch: int = -1
    failures: list[str] = field(default_factory=list)


class Monitor(StreamingQueryListener):
    """Health by query id, which a restart from the checkpoint keeps."""

    def __init__(self) -> None:
        self.health: dict[str, Health] = {}
        self._ended: set[str] = set()
        self._change = threading.Condition()

    def of(self, query: StreamingQuery) -> Health:
        return self.health.setdefault(str(query.id), Health())

    def onQueryStarted(self, event) -> None:
        self.health.setdefault(str(event.id), Health())

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        found = self.health.setdefault(str(progress.id), Health())
        seen = progress.observedMetrics.get(METRICS)
        # an idle trigger repeats the number of the batch to come, without rows
        if seen is None or progress.batchId <= found.last_batch or not seen["rows"]:
            return
        found.last_batch = progress.batchId
        found.batches += 1
        found.rows += seen["rows"]
        found.late_rows += seen["late_rows"] or 0
        if seen["max_latency_s"] is not None:
            found.max_latency_s = max(found.max_latency_s or 0.0, seen["max_latency_s"])
        found.max_batch_s = max(found.max_batch_s, progress.durationMs.get("triggerExecution", 0) / 1000)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.exception:
            found = self.health.setdefault(str(event.id), Health())
            found.failures = [*found.failures, event.exception][-10:]
        with self._change:
            self._ended.add(str(event.runId))
            self._change.notify_all()

    def settled(self, query: StreamingQuery, seconds: float = 30.0) -> Health:
        """Health of a stream that ended, after its last event has come."""
        with self._change:
            self._change.wait_for(lambda: str(query.runId) in self._ended, seconds)
        return self.of(query)


def supervise(
    start: Callable[[], StreamingQuery], policy: FeedPolicy, sleep: Callable[[float], None] = time.sleep
) -> int:
    """Run a stream until it stops by itself, starting it again after failures; how often it was.

    ``start`` starts the stream from its checkpoint, so a restart repeats the unfinished
    micro-batch and no other.  A finished micro-batch makes the failures before it forgotten.
    The last error is raised when the policy allows no further restart.
    """
    failures, again = 0, 0
    while True:
        query = start()
        try:
            query.awaitTermination()
            return again
        except StreamingQueryException:
            if query.lastProgress is not None and query.lastProgress.numInputRows:
                failures = 0
            failures += 1
            if failures > policy.restarts:
                raise
            again += 1
            sleep(policy.wait_s(failures))
