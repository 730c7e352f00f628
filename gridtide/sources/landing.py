"""Readers and writers at the edges: landed pages, datasets, increments and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import lookups as L
from ..functions import scalar as S
from . import schemas
from .feeds import DAY_PART, Feed, parse_pages, records

#: Pages of a landed file that holds one a line.
PAGES_PER_FILE = 10_000


def read_pages(spark: SparkSession, path: str, feed: Feed) -> DataFrame:
    """Pages with their envelope, one JSON document per file, and the page's file path.

    A page holds at most a few thousand records, so a whole file is one row; a folder of
    millions of pages is split over all tasks.
    """
    text = spark.read.text(path, wholetext=True)
    pages = text.select(F.col("value").alias("body"), F.col("_metadata.file_path").alias("page"))
    return parse_pages(pages, feed)


def land_pages(pages: DataFrame, path: str, body: str = "body") -> None:
    """Write pages one a line, compressed: field names are most of a page.

    Such a file is read by one task, so files are many rather than large.
    """
    files = pages.select(body).write.option("compression", "gzip")
    files.option("maxRecordsPerFile", PAGES_PER_FILE).text(path)


def read_feed(spark: SparkSession, path: str, feed: Feed, lines: bool = False) -> DataFrame:
    """All records of a landed feed; an empty folder gives an empty, typed result."""
    if lines:
        return records(spark.read.schema(feed.schema).json(path), feed)
    return records(read_pages(spark, path, feed), feed)


def read_registry(spark: SparkSession, path: str, schema: StructType, fmt: str = "json"):
    """Site registry download, JSON lines or CSV with a header, all fields as landed."""
    reader = spark.read.schema(schema)
    return reader.csv(path, header=True) if fmt == "csv" else reader.json(path)


def read_national_baseline(spark: SparkSession, path: str | None = None) -> DataFrame:
    """National consumption by year: an uploaded CSV, or the published figures."""
    if path:
        return spark.read.schema(schemas.NATIONAL_BASELINE).csv(path, header=True)
    return spark.createDataFrame(L.NATIONAL_BASELINE, schemas.NATIONAL_BASELINE)


def empty(spark: SparkSession, schema: StructType) -> DataFrame:
    """Typed result of a feed that delivered nothing."""
    return spark.createDataFrame([], schema)


def read_dataset(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


def _dated(df: DataFrame, month_of: str) -> DataFrame:
    return df.withColumn("month_part", F.date_format(month_of, "yyyy-MM"))


def write_dataset(
    df: DataFrame, path: str, month_of: str | None = None, mode: str = "overwrite"
) -> None:
    """Write Parquet; large time-keyed tables are laid out in month folders.

    Rebalancing groups the rows of a month and lets Spark split a month that holds most of
    them, and merge small ones, so files come out near the advisory partition size.
    """
    if month_of is None:
        df.write.mode(mode).parquet(path)
        return
    balanced = _dated(df, month_of).hint("rebalance", F.col("month_part"))
    balanced.write.mode(mode).partitionBy("month_part").parquet(path)


def save_bucketed(df: DataFrame, name: str, keys: list[str], buckets: int, path: str | None = None) -> DataFrame:
    """Save a table whose rows are dealt into buckets by the keys that later joins use.

    Tables dealt alike, by all keys of a join and into as many buckets, are joined without an
    exchange.  Keys of region and day, or region and month, spread a region over all buckets;
    the region alone would put a busy one into one of them.  Rows are dealt once before the
    write, so a bucket is one file.
    """
    dealt = df.repartition(buckets, *keys)
    writer = dealt.write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys)
    (writer.option("path", path) if path else writer).saveAsTable(name)
    return df.sparkSession.table(name)


def land_by_day(
    records: DataFrame, path: str, period: str = "period", mode: str = "append"
) -> None:
    """Write hourly records into folders by day, which the feed filters prune.

    Records whose period is no hour go to the folder of no day.
    """
    dated = records.withColumn(DAY_PART, F.to_date(S.parse_hour(F.col(period))))
    balanced = dated.hint("rebalance", F.col(DAY_PART))
    balanced.write.mode(mode).partitionBy(DAY_PART).parquet(path)


def new_rows(
    batch: DataFrame, existing: DataFrame, keys: list[str], since: str | None = None
) -> DataFrame:
    """Rows of an overlapping batch whose key is not stored yet.

    ``since`` names a key column that grows with time.  Stored rows older than the oldest
    row of the batch cannot match; a scalar subquery keeps them out of the scan, so the
    cost follows the overlap and not the history.
    """
    if since is not None:
        oldest = batch.agg(F.min(since)).scalar()
        existing = existing.where(F.col(since) >= oldest)
    return batch.join(existing.select(*keys), keys, "left_anti")


def append_new(
    batch: DataFrame,
    path: str,
    keys: list[str],
    since: str | None = None,
    month_of: str | None = None,
    newest: str | None = None,
) -> None:
    """Append the new rows of an overlapping batch to a stored dataset.

    A key that occurs twice in the batch is stored once: its row with the largest ``newest``,
    then the largest other columns.  A dataset in month folders must be appended with the same
    ``month_of``; then only the batch's months are read, and rows never land beside the folders.
    """
    existing = read_dataset(batch.sparkSession, path)
    laid_out = "month_part" in existing.columns
    if laid_out != (month_of is not None):
        raise ValueError(f"{path} is {'' if laid_out else 'not '}laid out in month folders")
    rest = [c for c in batch.columns if c not in (*keys, newest)]
    order = [F.col(c).desc_nulls_last() for c in ([newest] if newest else []) + rest]
    first = Window.partitionBy(*keys).orderBy(*order or [F.col(keys[0])])
    once = batch.withColumn("_place", F.row_number().over(first)).where("_place = 1").drop("_place")
    if month_of is not None:
        if month_of in keys:
            oldest = _dated(batch, month_of).agg(F.min("month_part")).scalar()
            existing = existing.where(F.col("month_part") >= oldest)
    fresh = new_rows(once, existing, keys, since)
    write_dataset(fresh, path, month_of, mode="append")


def stream_files(
    spark: SparkSession,
    path: str,
    schema: StructType,
    fmt: str = "json",
    files_per_batch: int | None = None,
    **options: str,
) -> DataFrame:
    """File stream over a landing folder."""
    reader = spark.readStream.format(fmt).schema(schema).options(**options)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def stream_topic(spark: SparkSession, servers: str, topic: str, schema: StructType) -> DataFrame:
    """Kafka stream of JSON values (needs the Kafka connector on the class path)."""
    raw = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .load()
    )
    value = F.from_json(F.col("value").cast("string"), schema.simpleString())
    return raw.select(value.alias("_v")).select("_v.*")
