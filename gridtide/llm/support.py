"""Helpers the operators share: reading, cutting lineage, per-text functions, labelled samples."""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir

#: Labelled rows a model is fitted and calibrated on, at most; the choice is by hash of the id.
LABELLED_ROWS = 20_000
#: Largest table that is sent to every executor on purpose.
BROADCAST_ROWS = 50_000
#: Rows that are worth a task, where steps over few rows follow one another.
TASK_ROWS = 16_384
#: Rows and bytes of text that are Python objects at once in a task, at most, but for one text.
SLICE_ROWS, SLICE_BYTES = 512, 1 << 18
BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: A batch of long texts ends behind the row that reaches this size.
BATCH_BYTES, BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "4m"
#: Rows the Parquet reader unpacks at once; 4096 long texts are arrays of many megabytes.
READ, READ_ROWS = "spark.sql.parquet.columnarReaderBatchSize", 256


def small_batches(spark: SparkSession) -> None:
    """Texts are long: hand few to Python at once, unless the session has its own number.

    A number somebody set, at the start or since, stays, also where it is Spark's default.
    """
    set_by_hand = spark.conf.getAll
    if BATCH not in set_by_hand:
        spark.conf.set(BATCH, str(SLICE_ROWS))
        spark.conf.set(BATCH_BYTES, BYTES)
    if READ not in set_by_hand:
        spark.conf.set(READ, str(READ_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> None:
    """Have checkpoints go to ``spark.checkpoint.dir``; a local master without it uses its own disk."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(scratch_dir(spark, "checkpoints"))


def cut(df: DataFrame) -> DataFrame:
    """Compute once into the shared folder; later reads survive lost executors."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def gathered(df: DataFrame, rows: int, each: int = TASK_ROWS) -> DataFrame:
    """In a task for ``each`` of about so many rows, but as many as run at a time at least.

    Without it every step over a few thousand rows starts a task, and leaves shuffle and
    checkpoint files, for each shuffle partition, unless adaptive execution joins these.
    """
    return df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // each)))


def with_columns(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add columns; input columns whose names differ from a new one at most in case are replaced."""
    new = {name.lower() for name in columns}
    kept = [df[f"`{c}`"] for c in df.columns if c.lower() not in new]
    return df.select(*kept, *[value.alias(name) for name, value in columns.items()])


def spare(df: DataFrame, *wanted: str) -> list[str]:
    """Names for helper columns that no column of a table has, whatever the case."""
    taken, found = {c.lower() for c in df.columns}, []
    for name in wanted:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        found.append(name)
    return found


def slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Bounds of consecutive parts of a binary array that are small enough to unpack."""
    ends = pc.cumulative_sum(pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64())).to_numpy()
    first = 0
    while first < len(texts):
        before = int(ends[first - 1]) if first else 0
        last = int(np.searchsorted(ends, before + SLICE_BYTES, side="right"))
        last = max(first + 1, min(last, first + SLICE_ROWS, len(texts)))
        yield first, last
        first = last


def tidy() -> None:
    """Give memory back at the end of a task.

    Spark keeps more Python workers than run at a time, and a worker at rest should hold little
    of what its last task needed.
    """
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # another C library has no such call
        ctypes.CDLL(None).malloc_trim(0)


def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[list[list]]:
    """Columns of small parts of record batches as lists; the first column holds the texts."""
    for batch in batches:
        for first, last in slices(batch.column(0)):
            yield [c.slice(first, last - first).to_pylist() for c in batch.columns]
        del batch
    tidy()


def per_text(make: Callable[[], Callable[[list], pa.Array]], schema: str):
    """Arrow function over a binary column; ``make`` runs once a task and gives the batch function."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        apply = make()
        for batch in batches:
            parts = [apply(batch.slice(a, b - a).to_pylist()) for a, b in slices(batch)]
            yield pa.concat_arrays(parts) if parts else apply([])
            del batch, parts
        del apply
        tidy()

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, schema)


def as_bytes(column: str | Column) -> Column:
    value = F.col(column) if isinstance(column, str) else column
    return value.cast("binary")


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, rows: int = LABELLED_ROWS
) -> DataFrame:
    """At most ``rows`` labelled documents with their 0/1 label in ``_label``.

    Ids labelled twice count by their larger label.  The ids are few by construction, so
    they go to every task and no text is shuffled.
    """
    ids = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
        .groupBy("doc_id")
        .agg(F.max(label).alias("_label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )
    return docs.join(F.broadcast(ids), "doc_id")


def best_cut(good: list[float], bad: list[float], weight: float = 4.0) -> float | None:
    """Value from which on rows count as good, or None without rows of both kinds.

    It minimizes ``weight`` times the lost share of good rows plus the kept share of bad
    rows; of equal cuts the middle between the neighbours of the lowest one is taken.
    """
    if not good or not bad:
        return None
    marks = sorted([(v, 1) for v in good] + [(v, 0) for v in bad])
    best, at, lost, dropped = None, None, 0, 0
    for i in range(len(marks) + 1):
        if i == 0 or i == len(marks) or marks[i][0] != marks[i - 1][0]:
            cost = weight * lost / len(good) + 1 - dropped / len(bad)
            if best is None or cost < best - 1e-12:
                best = cost
                low = marks[i - 1][0] if i else marks[0][0] - 1
                high = marks[i][0] if i < len(marks) else marks[-1][0] + 1
                at = (low + high) / 2
        if i < len(marks):
            lost += marks[i][1]
            dropped += 1 - marks[i][1]
    return at
