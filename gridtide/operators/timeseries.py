"""Trailing averages and previous values of long series.

A region may hold a third of all readings, so no step orders a whole region in one task.
A series is cut into buckets of time.  What a bucket needs from outside is computed from
per-bucket summaries and put into the bucket as extra rows; one window per (region, bucket)
then gives the exact result of a window over the whole series.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import lookups as L
from ..functions import scalar as S
from ..functions.exact import as_decimal

HOUR = 3600
DAY = 24 * HOUR
#: Days that the longest trailing average of the series table covers.
LONGEST_DAYS = 30


def trailing_averages(
    series: DataFrame,
    key: str,
    time: str,
    value: str,
    spans: dict[str, int],
    bucket_seconds: int = HOUR,
) -> DataFrame:
    """Add the average of ``value`` over the last ``n`` seconds, both ends inclusive.

    ``spans`` maps output column to n, a multiple of the bucket.  Rows of one second share
    their averages, so the series is first summed per second; a bucket then has at most one
    row per second and span, however many readings fall into it.

    For second t in bucket b the frame [t - n, t] is: the seconds of b up to t, plus the
    whole buckets b - n/size .. b - 1, less the seconds of the oldest of these that lie
    before t - n.  Those are moved n seconds forward and so meet t in bucket b.
    """
    if any(n % bucket_seconds for n in spans.values()):
        raise ValueError("spans must be multiples of the bucket")
    shifts = list(spans.values())
    seconds = series.groupBy(key, F.unix_timestamp(time).alias("_t")).agg(
        F.sum(as_decimal(F.col(value))).alias("_v"), F.count(as_decimal(F.col(value))).alias("_n")
    )
    averages = _averages_per_second(seconds, key, shifts, list(spans), bucket_seconds)
    rows, found = series.withColumn("_t", F.unix_timestamp(time)).alias("r"), averages.alias("a")
    same = F.col(f"r.{key}").eqNullSafe(F.col(f"a.{key}")) & F.col("r._t").eqNullSafe(
        F.col("a._t")
    )
    return rows.join(found, same, "left").select(
        *[F.col(f"r.`{c}`") for c in series.columns], *spans
    )


def _averages_per_second(
    seconds: DataFrame, key: str, shifts: list[int], names: list[str], size: int
) -> DataFrame:
    """Trailing averages of per-second sums ``_v`` and counts ``_n``."""
    slot = F.floor(F.col("_s") / size)
    # shift 0 is the second itself, the others are its subtrahends
    moved = (
        seconds.withColumn("_shift", F.explode(F.array(*[F.lit(n) for n in (0, *shifts)])))
        .where((F.col("_shift") == 0) | F.col("_t").isNotNull())
        .withColumn("_s", F.col("_t") + F.col("_shift"))
        .withColumn("_b", slot)
    )
    # no filter on the time here: the per-second sums stay one shared exchange
    totals = seconds.groupBy(key, F.floor(F.col("_t") / size).alias("_b")).agg(
        F.sum("_v").alias("_sum"), F.sum("_n").alias("_cnt")
    )
    timed = F.col("_b").isNotNull()
    # differences of running sums: a frame that only grows is summed in one pass, while a
    # sliding one would add up all its buckets again for every row
    by_bucket = Window.partitionBy(key).orderBy("_b")

    def running(column: str, last: int) -> Column:
        frame = by_bucket.rangeBetween(Window.unboundedPreceding, last)
        return F.coalesce(F.sum(column).over(frame), F.lit(0))

    whole = []
    for i, n in enumerate(shifts):
        for column, name in (("_sum", f"_sum{i}"), ("_cnt", f"_cnt{i}")):
            spanned = running(column, -1) - running(column, -(n // size) - 1)
            whole.append(F.when(timed, spanned).alias(name))
    carried = totals.select(key, "_b", *whole).withColumns(
        {"_s": F.col("_b") * size, "_shift": F.lit(-1)}
    )

    rows = moved.unionByName(carried, allowMissingColumns=True)
    in_bucket = Window.partitionBy(key, "_b").orderBy("_s")
    up_to_now = in_bucket.rangeBetween(Window.unboundedPreceding, 0)
    before_now = in_bucket.rangeBetween(Window.unboundedPreceding, -1)

    def total(column: str, shift: int, over) -> Column:
        return F.coalesce(
            F.sum(F.when(F.col("_shift") == shift, F.col(column))).over(over), F.lit(0)
        )

    def handed(column: str) -> Column:
        # the carried row starts its bucket, so every frame that ends now includes it
        return F.coalesce(F.max(column).over(up_to_now), F.lit(0))

    steps = {"_own": total("_v", 0, up_to_now), "_own_n": total("_n", 0, up_to_now)}
    for i, n in enumerate(shifts):
        steps[f"_w{i}"] = handed(f"_sum{i}") - total("_v", n, before_now)
        steps[f"_wn{i}"] = handed(f"_cnt{i}") - total("_n", n, before_now)
    framed = rows.withColumns(steps).where("_shift = 0")
    return framed.select(
        key,
        "_t",
        *[
            (
                (F.col("_own") + F.col(f"_w{i}")).cast("double")
                / F.nullif(F.col("_own_n") + F.col(f"_wn{i}"), F.lit(0)).cast("double")
            ).alias(name)
            for i, name in enumerate(names)
        ],
    )


def demand_timeseries(energy: DataFrame) -> DataFrame:
    """Readings with 7-day and 30-day trailing averages and the residual to the latter."""
    series = energy.select("region_id", "timestamp", "demand_mw", "temperature_f")
    spans = {"demand_7d_avg_mw": 7 * DAY, "demand_30d_avg_mw": LONGEST_DAYS * DAY}
    return trailing_averages(series, "region_id", "timestamp", "demand_mw", spans).withColumn(
        "demand_anomaly_mw", F.col("demand_mw") - F.col("demand_30d_avg_mw")
    )


def rolling_deviation(energy: DataFrame, hours: int = L.SMOOTHING_HOURS) -> DataFrame:
    """Readings that deviate from their trailing average by more than the threshold."""
    series = energy.select("region_id", "timestamp", "demand_mw")
    smooth = trailing_averages(
        series, "region_id", "timestamp", "demand_mw", {"rolling_avg_mw": hours * HOUR}
    )
    deviation = S.pct_change(F.col("demand_mw"), F.col("rolling_avg_mw"))
    return (
        smooth.withColumn("deviation_pct", deviation)
        .where(F.abs("deviation_pct") > L.ANOMALY_PCT)
        .withColumn("severity", S.severity(F.col("deviation_pct")))
    )


def with_previous(
    series: DataFrame,
    key: str,
    time: str,
    columns: dict[str, tuple[str, int]],
    ties: tuple[str, ...] = (),
    buckets: tuple[int, int] = (HOUR, 1),
) -> DataFrame:
    """Add values of preceding rows of the same key.

    ``columns`` maps a new column to (source column, distance).  With d the largest
    distance, the last d rows of every bucket are enough to know the d rows before each
    bucket; these are handed to it and sorted before its own rows.  ``buckets`` are the
    seconds of a coarse and a fine bucket: tails of fine buckets are handed on within their
    coarse one, and only those of coarse buckets along the whole key, so an hour that holds
    most rows of a region is worked through by the second.
    """
    depth = max(distance for _, distance in columns.values())
    sources = list(dict.fromkeys(source for source, _ in columns.values()))
    order = [time, *ties]
    seconds = F.unix_timestamp(time)
    coarse, fine = (F.floor(seconds / size) for size in buckets)
    bucketed = series.withColumns({"_h": coarse, "_b": fine})

    slim = bucketed.select(key, "_h", "_b", *dict.fromkeys([*order, *sources]))
    inner = _tails(slim, [key, "_h", "_b"], order, depth)
    inner = inner.select(key, "_h", "_b", "_rn", *order, F.struct(*sources).alias("_row"))
    outer = _tails(inner.drop("_rn"), [key, "_h"], order, depth).select(key, "_h", "_rn", "_row")
    before_hour = _handed(outer, [key], "_h", depth)
    # a row handed to an hour comes before the hour's own tails; it has no bucket of its own
    guests = before_hour.select(key, "_h", (-F.col("_place")).alias("_rn"), "_row")
    entered = inner.select(key, "_h", "_b", "_rn", "_row").unionByName(guests, allowMissingColumns=True)
    carried = _handed(entered, [key, "_h"], "_b", depth).select(key, "_h", "_b", "_place", "_row.*")

    rows = bucketed.withColumn("_place", F.lit(0)).unionByName(carried, allowMissingColumns=True)
    ordered = Window.partitionBy(key, "_h", "_b").orderBy("_place", *order)
    lags = {new: F.lag(source, d).over(ordered) for new, (source, d) in columns.items()}
    return rows.withColumns(lags).where("_place = 0").drop("_h", "_b", "_place")


def _tails(rows: DataFrame, group: list[str], order: list[str], depth: int) -> DataFrame:
    """The last rows of each group, numbered ``_rn`` from the last one."""
    newest = Window.partitionBy(*group).orderBy(*[F.col(c).desc() for c in order])
    return rows.withColumn("_rn", F.row_number().over(newest)).where(F.col("_rn") <= depth)


def _handed(tails: DataFrame, scope: list[str], bucket: str, depth: int) -> DataFrame:
    """``_row`` of the rows before each bucket within its scope, at ``_place`` -1, -2, ...

    Rows without a bucket come first and get nothing.
    """
    along = Window.partitionBy(*scope).orderBy(F.col(bucket).asc_nulls_first(), F.col("_rn").desc())
    places = [
        F.struct(F.lit(-d).alias("_place"), F.lag("_row", d).over(along).alias("_row"))
        for d in range(1, depth + 1)
    ]
    lagged = tails.select(
        *scope, bucket, F.lag(F.struct(bucket)).over(along).alias("_before"), F.array(*places).alias("_rows")
    )
    # the first tail row of a bucket is the one whose predecessor is in another bucket
    first = F.col("_before").isNull() | ~F.col(f"_before.{bucket}").eqNullSafe(F.col(bucket))
    return (
        lagged.where(first & F.col(bucket).isNotNull())
        .select(*scope, bucket, F.inline("_rows"))
        .where(F.col("_row").isNotNull())
    )


def change_rate(series: DataFrame, key: str, time: str, value: str, ties=()) -> DataFrame:
    """Change since the preceding row, in total and per hour."""
    hours = (F.unix_micros(time) - F.unix_micros("_prev_time")) / 3_600_000_000
    change = F.col(value) - F.col("_prev")
    before = {"_prev": (value, 1), "_prev_time": (time, 1)}
    return (
        with_previous(series, key, time, before, ties)
        .withColumns({"change": change, "change_per_hour": F.try_divide(change, hours)})
        .drop("_prev", "_prev_time")
    )


def acceleration(series: DataFrame, key: str, time: str, value: str, ties=()) -> DataFrame:
    """Change since the preceding row, and how much it differs from the change before."""
    change = F.col(value) - F.col("_prev")
    return (
        with_previous(series, key, time, {"_prev": (value, 1), "_prev2": (value, 2)}, ties)
        .withColumns(
            {"change": change, "acceleration": change - (F.col("_prev") - F.col("_prev2"))}
        )
        .drop("_prev", "_prev2")
    )


def long_form(
    readings: DataFrame,
    ids: tuple[str, ...] = ("region_id", "timestamp"),
    values: tuple[str, ...] = ("demand_mw", "temperature_f", "price_per_mwh"),
) -> DataFrame:
    """One row per reading and time-series property."""
    return readings.unpivot(list(ids), list(values), "property", "value")
