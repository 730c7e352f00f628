"""Column functions: parsing, classification, time, units and guarded ratios."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import lookups as L

HOUR_PERIOD = "yyyy-MM-dd'T'HH"
_BLANK = " \t\n\r\f\u000b"


# ---- parsing --------------------------------------------------------------------
def to_double(value: Column, default: float | None = None) -> Column:
    """Number in a text column; text that is no number gives ``default``."""
    text = value.cast("string")
    # the JVM parser also accepts a trailing type letter ("12d"), which is not a number here
    suffixed = text.rlike(r"^.*[0-9.]\s*[dDfF]\s*$")
    parsed = F.when(~suffixed, text.try_cast("double"))
    return parsed if default is None else F.coalesce(parsed, F.lit(float(default)))


def to_bigint(value: Column, default: int | None = None) -> Column:
    """Whole number in a text column; fractions and other text give ``default``.

    A JSON number such as ``96000.0`` or ``1.0E7`` reaches here as text and is whole.
    """
    text = value.cast("string")
    number = F.when(
        text.rlike(r"^\s*[+-]?[0-9]+[.][0-9]*([eE][+-]?[0-9]+)?\s*$"), text.try_cast("double")
    )
    # beyond 2^53 a double no longer tells whole numbers apart
    whole = F.when((number == F.floor(number)) & (F.abs(number) < 2.0**53), number.try_cast("bigint"))
    parsed = F.coalesce(text.try_cast("bigint"), whole)
    return parsed if default is None else F.coalesce(parsed, F.lit(int(default)))


def parse_hour(period: Column) -> Column:
    """Timestamp of an hourly period such as ``2024-01-15T14``; NULL when malformed."""
    return F.try_to_timestamp(period, F.lit(HOUR_PERIOD))


def format_hour(timestamp: Column) -> Column:
    return F.date_format(timestamp, HOUR_PERIOD)


def stamp_id(prefix: str, region: Column, timestamp: Column) -> Column:
    """Reading id ``<prefix>_<region>_<yyyyMMddHH>``."""
    return F.concat_ws("_", F.lit(prefix), region, F.date_format(timestamp, "yyyyMMddHH"))


# ---- classification -------------------------------------------------------------
def _contains_any(text: Column, parts: tuple[str, ...]) -> Column:
    lowered = F.lower(F.coalesce(text, F.lit("")))
    return reduce(lambda a, b: a | b, [F.contains(lowered, F.lit(p)) for p in parts])


def _is_given(count: Column) -> Column:
    text = F.trim(F.coalesce(count.cast("string"), F.lit("")))
    return (text != "") & F.coalesce(text.try_cast("double") != 0, F.lit(True))


def is_ai_site(gpus: Column, accelerators: Column, owner: Column, name: Column) -> Column:
    """True for a site with accelerators, an AI owner or an AI word in its name."""
    return (
        _is_given(gpus)
        | _is_given(accelerators)
        | _contains_any(owner, L.AI_OWNERS)
        | _contains_any(name, L.AI_NAME_PARTS)
    )


def site_status(status: Column) -> Column:
    """One of operational, under_construction, planned, expanding, unknown."""
    key = F.trim(F.lower(F.coalesce(status, F.lit(""))), F.lit(_BLANK))
    return F.coalesce(L.lookup(L.STATUS_SYNONYMS, key), F.lit("unknown"))


def state_of_fips(fips: Column) -> Column:
    return L.lookup(L.FIPS_STATE, fips)


def authority_of_state(state: Column) -> Column:
    return L.lookup(L.STATE_AUTHORITY, state)


def zone_of_authority(authority: Column) -> Column:
    return F.coalesce(L.lookup(L.AUTHORITY_ZONE, authority), F.lit(L.DEFAULT_ZONE))


# ---- time -----------------------------------------------------------------------
def local_to_utc(local: Column, zone: Column) -> Column:
    """UTC instant of a wall-clock time; an hour that occurs twice is the later one.

    Spark resolves the repeated autumn hour to daylight time.  If the instant one hour
    later reads the same on the wall clock, that later (standard-time) instant is meant.
    """
    utc = F.to_utc_timestamp(local, zone)
    later = utc + F.expr("INTERVAL 1 HOUR")
    return F.when(F.from_utc_timestamp(later, zone) == local, later).otherwise(utc)


def hour_to_utc(period: Column, authority: Column) -> Column:
    """UTC instant of an hourly period in the authority's local time."""
    return local_to_utc(parse_hour(period), zone_of_authority(authority))


def calendar_months(earlier: Column, later: Column) -> Column:
    """Difference of the calendar months; the day of month does not count."""
    return (F.year(later) - F.year(earlier)) * 12 + F.month(later) - F.month(earlier)


def month_start(timestamp: Column) -> Column:
    return F.date_trunc("month", timestamp)


def first_month_from(day: Column) -> Column:
    """First day of the earliest month that starts on or after ``day``."""
    return F.trunc(F.add_months(F.date_sub(day, 1), 1), "MM")


# ---- numbers --------------------------------------------------------------------
def pct_change(value: Column, base: Column) -> Column:
    """Percent change against a positive base, otherwise NULL."""
    return F.when(base > 0, (value - base) / base * 100)


def pct_of(part: Column, whole: Column) -> Column:
    """``part`` in percent of a positive ``whole``, otherwise NULL."""
    return F.when(whole > 0, part / whole * 100)


def convert(value: Column, factor: float) -> Column:
    """Unit conversion with one of the factors in ``lookups``."""
    return value * F.lit(float(factor))


# ---- scores and buckets ---------------------------------------------------------
def data_completeness(
    pre: Column, post: Column, months_online: Column, window: int = L.ANALYSIS_WINDOW_MONTHS
) -> Column:
    expected = F.lit(L.BASELINE_MONTHS) + F.least(F.lit(window), months_online)
    return F.least(F.lit(1.0), (pre + post) / F.greatest(F.lit(1), expected))


def confidence_score(
    pre: Column,
    post: Column,
    completeness: Column,
    capacity: Column,
    pre_avg: Column,
    window: int = L.ANALYSIS_WINDOW_MONTHS,
) -> Column:
    """Weighted score in [0, 1]: 30% completeness, 20% + 20% period length, 30% signal.

    The signal part is capacity over a tenth of demand.  Without a capacity or a positive
    demand it is 0.1; a capacity of zero is a known, empty signal and gives 0.
    """

    def share(part: Column, whole: float) -> Column:
        return F.least(F.lit(1.0), part / F.lit(whole))

    signal = F.when(
        (pre_avg > 0) & capacity.isNotNull(), share(capacity / pre_avg, 0.10)
    ).otherwise(F.lit(0.1))
    total = (
        F.lit(0.3) * share(completeness, L.MIN_COMPLETENESS)
        + F.lit(0.2) * share(pre, float(L.BASELINE_MONTHS))
        + F.lit(0.2) * share(post, float(window))
        + F.lit(0.3) * signal
    )
    return F.round(F.least(F.lit(1.0), F.greatest(F.lit(0.0), total)), 3)


def severity(deviation: Column) -> Column:
    size = F.abs(deviation)
    return (
        F.when(size > L.HIGH_PCT, "HIGH").when(size > L.MEDIUM_PCT, "MEDIUM").otherwise("LOW")
    )


def anomaly_kind(deviation: Column) -> Column:
    return F.when(deviation > 0, "DEMAND_SPIKE").otherwise("DEMAND_DROP")


def above(value: Column, limit: float) -> Column:
    """Alert flag that is never NULL."""
    return F.coalesce(value > F.lit(limit), F.lit(False))


def latency_seconds(now: Column, timestamp: Column) -> Column:
    return F.unix_timestamp(now) - F.unix_timestamp(timestamp)


def row_bytes(*columns: str) -> Column:
    """Size of a row as JSON text."""
    return F.octet_length(F.to_json(F.struct(*columns)))


# ---- statistics -----------------------------------------------------------------
def pearson(x: Column, y: Column) -> Column:
    """Aggregate: correlation over complete pairs, NULL for a constant side.

    Built from moments because the built-in ``corr`` raises on a constant column.
    """
    x_pair, y_pair = F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)
    spread = F.stddev_pop(x_pair) * F.stddev_pop(y_pair)
    return F.try_divide(F.covar_pop(x_pair, y_pair), spread)


def t_statistic(r: Column, n: Column) -> Column:
    return F.try_divide(r * F.sqrt(n - 2), F.sqrt(1 - r * r))


def two_sided_p(t: Column, freedom: Column) -> Column:
    """Two-sided tail probability of Student's t with whole degrees of freedom.

    The distribution has a finite series in the cosine of atan(t / sqrt(v)): with v
    odd over odd powers, with v even over even powers.  ``aggregate`` sums it in the JVM.
    """
    v = freedom.cast("int")
    angle = F.atan(F.abs(t) / F.sqrt(v))
    sine, cosine = F.sin(angle), F.cos(angle)
    odd = v % 2 == 1
    # number of series terms after the first
    more = F.when(odd, (v - 3) / 2).otherwise((v - 2) / 2).cast("int")
    steps = F.when(more >= 1, F.sequence(F.lit(1), more)).otherwise(F.array().cast("array<int>"))

    def advance(acc: Column, k: Column) -> Column:
        ratio = F.when(odd, (2 * k) / (2 * k + 1.0)).otherwise((2 * k - 1) / (2.0 * k))
        term = acc["term"] * ratio * cosine * cosine
        return F.struct(term.alias("term"), (acc["total"] + term).alias("total"))

    first = F.when(odd, F.when(v > 1, cosine).otherwise(0.0)).otherwise(1.0)
    series = F.aggregate(
        steps,
        F.struct(first.alias("term"), first.alias("total")),
        advance,
        lambda acc: acc["total"],
    )
    inside = F.when(odd, (angle + sine * series) * (2 / 3.141592653589793)).otherwise(sine * series)
    # greatest() would turn an unknown t into a certain zero
    return F.when((v >= 1) & t.isNotNull(), F.greatest(F.lit(0.0), 1 - inside))
