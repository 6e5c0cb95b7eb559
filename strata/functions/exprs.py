"""Scalar column helpers.

Every helper returns a ``Column`` built from ``pyspark.sql.functions`` so it
stays inside whole-stage code generation; none of them is a Python UDF.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's rules.
# ---------------------------------------------------------------------------

# Weather code to label: (low, high inclusive, label); anything else "unknown".
WEATHER_CODE_LABELS = [
    (0, 0, "clear"),
    (1, 3, "partly_cloudy"),
    (4, 9, "cloudy"),
    (10, 19, "fog"),
    (20, 29, "drizzle"),
    (30, 39, "rain"),
    (40, 49, "snow"),
    (50, 59, "heavy_rain"),
    (60, 69, "heavy_snow"),
    (70, 79, "snow_grains"),
    (80, 89, "thunderstorm"),
    (90, 99, "severe_thunderstorm"),
]
WEATHER_UNKNOWN = "unknown"

# Payment method (lower-cased, trimmed) to channel; anything else "other".
PAYMENT_CHANNELS = [
    (("credit_card", "debit_card"), "card"),
    (("alipay", "wechat_pay"), "e_wallet"),
    (("bank_transfer",), "bank_transfer"),
]
PAYMENT_OTHER = "other"

# Product rating tiers, tested on the unrounded rating, highest first.
RATING_TIERS = [(4.5, "platinum"), (4.0, "gold"), (3.0, "silver")]
RATING_DEFAULT = "bronze"

# Customer tiers, tested on the rounded revenue, highest first.
CUSTOMER_TIERS = [(50000, "vip"), (10000, "premium"), (5000, "standard")]
CUSTOMER_DEFAULT = "basic"

# Heat thresholds (degrees C) and storm code ranges for weather alerts.
HEAT_CRITICAL = 40.0
HEAT_WARNING = 38.0
STORM_CRITICAL = (90, 99)
STORM_WARNING = (80, 89)

# Load-time default for an empty target ("1970-01-01").
EPOCH = _dt.datetime(1970, 1, 1)


# ---------------------------------------------------------------------------
# Rounding and arithmetic
# ---------------------------------------------------------------------------

def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def in_values(c: str | Column, values: Sequence) -> Column:
    """``c`` is one of the values, null being a value too: a filter of literals that reaches the scan."""
    known = [F.lit(v).cast("timestamp_ntz") if isinstance(v, _dt.datetime) else F.lit(v) for v in values if v is not None]
    out = col_(c).isin(*known) if known else F.lit(False)
    return out | col_(c).isNull() if len(known) < len(values) else out


def round_money(c: str | Column, digits: int = 2) -> Column:
    """F1: ``ROUND(x::NUMERIC, n)::DOUBLE PRECISION``.

    Rounds through DECIMAL(38,6) so half-way cases round like a decimal
    (HALF_UP), not like the binary double.
    """
    return F.round(col_(c).cast("decimal(38,6)"), digits).cast("double")


def exact_sum(c: str | Column, scale: int = 2) -> Column:
    """Sum of values that are already rounded to ``scale`` digits, as double.

    Summing doubles depends on the order partial sums meet across tasks. The
    values are summed as whole cents in BIGINT instead: exact, so every run and
    every engine agrees, and a plain long add in generated code (a
    DECIMAL(38,2) sum runs on BigDecimal). ANSI mode raises on overflow, at
    about 9e16 cents in one group.
    """
    unit = 10 ** scale
    return F.sum(F.round(col_(c) * unit).cast("long")) / F.lit(unit)


def exact_avg(c: str | Column, scale: int = 2) -> Column:
    """Average of values with up to ``scale`` digits, from their exact sum: the same in any order of tasks."""
    return exact_sum(c, scale) / F.nullif(F.count(col_(c)), F.lit(0))


def line_total(quantity: str | Column, unit_price: str | Column, discount_pct: str | Column) -> Column:
    """``quantity * unit_price * (1 - coalesce(discount, 0) / 100)``, rounded."""
    q, p, d = col_(quantity), col_(unit_price), col_(discount_pct)
    return round_money(q * p * (F.lit(1.0) - F.coalesce(d, F.lit(0.0)) / F.lit(100.0)), 2)


def pct_change(current: str | Column, previous: str | Column, digits: int = 2) -> Column:
    """``(x - prev) / prev * 100`` rounded, null unless ``prev > 0``."""
    cur, prev = col_(current).cast("double"), col_(previous).cast("double")
    return F.when(prev > 0, round_money((cur - prev) / prev * F.lit(100.0), digits))


def share_pct(part: str | Column, total: str | Column, digits: int = 1) -> Column:
    """F7 + F15: ``part / NULLIF(total, 0) * 100`` rounded; null on a zero total."""
    return round_money(col_(part).cast("double") / F.nullif(col_(total), F.lit(0)).cast("double") * 100.0, digits)


def abs_pct_change(today: str | Column, yesterday: str | Column) -> Column:
    """F16: absolute percent change; a zero baseline gives 100 (growth) or 0."""
    t, y = col_(today).cast("double"), col_(yesterday).cast("double")
    return F.when(y == 0, F.when(t > 0, F.lit(100.0)).otherwise(F.lit(0.0))).otherwise(
        F.abs(t - y) / y * F.lit(100.0)
    )


# ---------------------------------------------------------------------------
# Text
# ---------------------------------------------------------------------------

def first_match_replace(c: str | Column, pattern: str, replacement: str = "") -> Column:
    """replace the FIRST match only (PostgreSQL ``regexp_replace`` without ``g``).

    Spark's ``regexp_replace`` replaces every match, so the text before the
    first match is captured and put back. ``pattern`` may alternate but must not
    contain capturing groups; ``replacement`` is literal text.
    """
    literal = replacement.replace("\\", "\\\\").replace("$", "\\$")
    return F.regexp_replace(col_(c), f"(?s)^(.*?)(?:{pattern})", "$1" + literal)


def remove_first_blank(c: str | Column) -> Column:
    """M10 phone rule: ``REGEXP_REPLACE(COALESCE(phone, ''), '\\s', '')``."""
    return first_match_replace(F.coalesce(col_(c), F.lit("")), r"\s", "")


def number_to_text(c: str | Column) -> Column:
    """print a double like PostgreSQL does (``38`` for ``38.0``)."""
    return F.regexp_replace(col_(c).cast("string"), r"\.0$", "")


def clean_report_text(c: str | Column, width: int = 80) -> Column:
    """cut to ``width`` characters, then newline to space, then escape pipes."""
    cut = F.substring(F.coalesce(col_(c), F.lit("")), 1, width)
    return F.regexp_replace(F.regexp_replace(cut, "\n", " "), r"\|", r"\\|")


def id_part(c: str | Column, from_end: int) -> Column:
    """F21 helper: the ``from_end``-th dotted part counted from the end (1 = last)."""
    return F.element_at(F.split(col_(c), r"\."), -from_end)


# ---------------------------------------------------------------------------
# Time
# ---------------------------------------------------------------------------

def trunc_ts(c: str | Column, unit: str) -> Column:
    """F8: ``DATE_TRUNC(unit, ts)`` that stays ``TIMESTAMP_NTZ`` (a timestamp, not a date)."""
    if unit == "day":
        return col_(c).cast("date").cast("timestamp_ntz")
    return F.date_trunc(unit, col_(c)).cast("timestamp_ntz")


def elapsed_days(later: str | Column, earlier: str | Column) -> Column:
    """``EXTRACT(DAY FROM (later - earlier))``: whole elapsed days, as bigint."""
    return F.extract(F.lit("DAY"), col_(later) - col_(earlier)).cast("long")


def ts_literal(value: _dt.datetime | str | Column | None) -> Column:
    """a fixed clock for reproducible runs, else ``current_timestamp`` as NTZ."""
    if value is None:
        return F.current_timestamp().cast("timestamp_ntz")
    if isinstance(value, Column):
        return value
    if isinstance(value, str):
        value = _dt.datetime.fromisoformat(value)
    if isinstance(value, _dt.date) and not isinstance(value, _dt.datetime):
        value = _dt.datetime(value.year, value.month, value.day)
    return F.lit(value.replace(tzinfo=None)).cast("timestamp_ntz")


def iso_to_ts(c: str | Column, tz: str | None = None, on_bad: str = "raise") -> Column:
    """ISO text (``...Z`` or local ``YYYY-MM-DDTHH:MM``) to NTZ UTC.

    ``tz`` names the zone a local time was written in (the weather API returns
    local times); it is converted to UTC. Text that is no time raises, like the
    cast it stands for; ``on_bad="null"`` makes it null on request.
    """
    raw = col_(c)
    ts = F.coalesce(
        F.try_to_timestamp(raw),
        F.try_to_timestamp(raw, F.lit("yyyy-MM-dd'T'HH:mm:ssXXX")),
        F.try_to_timestamp(raw, F.lit("yyyy-MM-dd'T'HH:mm:ss")),
        F.try_to_timestamp(raw, F.lit("yyyy-MM-dd'T'HH:mm")),
    )
    if tz:
        ts = F.to_utc_timestamp(ts, tz)
    ts = ts.cast("timestamp_ntz")
    if on_bad == "null":
        return ts
    bad = F.raise_error(F.concat(F.lit("not a time: "), raw.cast("string"))).cast("timestamp_ntz")
    return F.when(raw.isNotNull() & ts.isNull(), bad).otherwise(ts)


# ---------------------------------------------------------------------------
# Coded values and tiers
# ---------------------------------------------------------------------------

def tier(c: str | Column, thresholds: Sequence[tuple[float, str]], default: str) -> Column:
    """First threshold (descending) the value reaches; null falls to default."""
    value = col_(c)
    expr = None
    for bound, label in thresholds:
        expr = F.when(value >= bound, label) if expr is None else expr.when(value >= bound, label)
    return expr.otherwise(default) if expr is not None else F.lit(default)


def range_label(c: str | Column, ranges: Sequence[tuple[int, int, str]], default: str) -> Column:
    """label by inclusive integer ranges (P7 ``BETWEEN``); null and gaps get default."""
    value = col_(c)
    expr = None
    for low, high, label in ranges:
        cond = value.between(low, high)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(default)


def weather_category(code: str | Column, labels: Sequence[tuple[int, int, str]] = WEATHER_CODE_LABELS) -> Column:
    return range_label(code, labels, WEATHER_UNKNOWN)


def payment_channel(method: str | Column) -> Column:
    """P6 + P8: channel of a payment method; null and unknown methods are "other"."""
    m = F.lower(F.trim(F.coalesce(col_(method), F.lit(""))))
    expr = None
    for methods, channel in PAYMENT_CHANNELS:
        cond = m.isin(*methods)
        expr = F.when(cond, channel) if expr is None else expr.when(cond, channel)
    return expr.otherwise(PAYMENT_OTHER)


def heat_alert(temperature: str | Column) -> Column:
    t = col_(temperature)
    return F.when(t >= HEAT_CRITICAL, "critical").when(t >= HEAT_WARNING, "warning")


def storm_alert(code: str | Column) -> Column:
    c = col_(code)
    return F.when(c.between(*STORM_CRITICAL), "critical").when(c.between(*STORM_WARNING), "warning")
