"""Starting streaming queries and collecting what a bounded run wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, LongType, StructField, StructType

from ..functions import lookups as L
from ..session import ROCKSDB, scratch_dir
from . import live

PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def start(df: DataFrame, path: str, checkpoint: str, trigger: str = L.DEMAND_TRIGGER, name=None):
    """Append a live stream to a Parquet folder at the interval of its feed.

    The file sink commits each micro-batch once, also after a restart from the checkpoint.
    """
    writer = (
        df.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .option("path", path)
        .trigger(processingTime=trigger)
    )
    return (writer.queryName(name) if name else writer).start()


def start_prices(df: DataFrame, path: str, checkpoint: str, name=None):
    """The same at the interval of the price feed."""
    return start(df, path, checkpoint, L.PRICE_TRIGGER, name)


def start_available(df: DataFrame, path: str, checkpoint: str):
    """Append what a stream has now to a Parquet folder, and stop."""
    writer = df.writeStream.format("parquet").outputMode("append")
    writer = writer.option("checkpointLocation", checkpoint).option("path", path)
    return writer.trigger(availableNow=True).start()


def drain(df: DataFrame, purpose: str, folder: str | None = None) -> DataFrame:
    """Process all data a stream has now, stop, and read back what it wrote.

    A given ``folder`` keeps output and checkpoint, so a later call continues the stream.
    """
    spark: SparkSession = df.sparkSession
    folder = folder or scratch_dir(spark, purpose)
    if spark.conf.get(PROVIDER, None) != ROCKSDB:
        # for good: changing it back would disturb another stream that is just starting
        spark.conf.set(PROVIDER, ROCKSDB)
    start_available(df, f"{folder}/rows", f"{folder}/checkpoint").awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{folder}/rows")


def write_split(batch: DataFrame, batch_id: int, folder: str, max_bytes: int = L.MAX_ROW_BYTES) -> None:
    """Rows of a micro-batch to the accepted and the rejected output, in one write.

    Each output keeps the rows of a micro-batch under its number, and writing a number again
    replaces them, so a repeated micro-batch leaves both outputs as they were.
    """
    marked = live.split_oversized(batch, max_bytes).withColumn("batch_id", F.lit(batch_id))
    (
        marked.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("accepted", "batch_id")
        .parquet(folder)
    )


def start_guarded(
    records: DataFrame,
    folder: str,
    checkpoint: str,
    max_bytes: int = L.MAX_ROW_BYTES,
    trigger: str | None = None,
    write=write_split,
):
    """Append a stream to two outputs by the size of its rows; without a trigger, what is there now."""

    def split(batch: DataFrame, batch_id: int) -> None:
        write(batch, batch_id, folder, max_bytes)

    writer = records.writeStream.foreachBatch(split).option("checkpointLocation", checkpoint)
    if trigger is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=trigger).start()


def guarded(spark: SparkSession, folder: str, schema: StructType, accepted: bool = True) -> DataFrame:
    """Rows of one output; rejected ones with their size, for whoever mends the source."""
    kinds = {"row_bytes": IntegerType(), "accepted": BooleanType(), "batch_id": LongType()}
    stored = StructType([*schema.fields, *[StructField(name, kind) for name, kind in kinds.items()]])
    rows = spark.read.schema(stored).parquet(folder).where(F.col("accepted") == accepted)
    return rows.drop("accepted", "batch_id", *(["row_bytes"] if accepted else []))
