"""Tables that change under a running stream.

A side input is published in versions, each valid from a moment on.  Every micro-batch reads
the version that is valid when it runs, and notes which one that was, so that a micro-batch
which is repeated after a failure reads the same version again.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

PUBLISHED = "version long, valid_from timestamp"
USED = "version long, batch_id long"


def _rows(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """A stored table, or an empty one where nothing has been written."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


class SideInput:
    """Versions of a small table in a folder that every executor can reach; one publisher."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def published(self) -> DataFrame:
        return _rows(self.spark, f"{self.path}/published", PUBLISHED)

    def publish(self, table: DataFrame, valid_from: datetime | None = None) -> int:
        """Store the next version; readers see it when all of it is there."""
        version = (self.published().agg(F.max("version")).first()[0] or 0) + 1
        table.write.mode("overwrite").parquet(f"{self.path}/version={version}")
        moment = valid_from or datetime.now(timezone.utc)
        row = self.spark.createDataFrame([(version, moment)], PUBLISHED)
        row.coalesce(1).write.mode("append").parquet(f"{self.path}/published")
        return version

    def valid_at(self, moment: datetime) -> int | None:
        """The version published last of those that are valid at a moment."""
        known = self.published().where(F.col("valid_from") <= F.lit(moment))
        return known.agg(F.max(F.struct("valid_from", "version")).alias("v")).select("v.version").first()[0]

    def read(self, version: int) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/version={version}")


def _used(spark: SparkSession, folder: str, batch_id: int) -> int | None:
    found = _rows(spark, f"{folder}/used", USED).where(F.col("batch_id") == batch_id)
    return found.agg(F.max("version")).first()[0]


def start_with(
    stream: DataFrame,
    side: SideInput,
    combine: Callable[[DataFrame, DataFrame], DataFrame],
    folder: str,
    trigger: str | None = None,
    clock: Callable[[], datetime] = lambda: datetime.now(timezone.utc),
):
    """Append ``combine(micro-batch, side input)`` to ``folder/rows``, by micro-batch.

    A micro-batch that comes before any version is valid raises a LookupError, and is run again
    when the stream is started anew.  Without a trigger, what is there now is processed.
    """
    spark = side.spark

    def process(batch: DataFrame, batch_id: int) -> None:
        version = _used(spark, folder, batch_id)
        if version is None:
            version = side.valid_at(clock())
            if version is None:
                raise LookupError(f"no version of {side.path} is valid")
            row = spark.createDataFrame([(version, batch_id)], USED)
            writer = row.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            writer.partitionBy("batch_id").parquet(f"{folder}/used")
        found = combine(batch, side.read(version)).withColumn("batch_id", F.lit(batch_id))
        writer = found.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("batch_id").parquet(f"{folder}/rows")

    writer = stream.writeStream.foreachBatch(process).option("checkpointLocation", f"{folder}/checkpoint")
    if trigger is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=trigger).start()


def results(spark: SparkSession, folder: str, schema: StructType) -> DataFrame:
    """All rows a stream with a side input has written."""
    return _rows(spark, f"{folder}/rows", schema).select(*[f"`{c}`" for c in schema.names])
