"""Column expressions used across the library.

Every function returns a ``Column`` built from built-in Spark functions only,
so it stays inside whole-stage codegen; no Python runs per row.
"""

from __future__ import annotations

import datetime as _dt
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from lifetide.schemas import MONEY, STATUS_ACTIVE, STATUS_INACTIVE, STATUS_NEW

# The thresholds and factors of the reference's rules.
ACTIVE_WITHIN_DAYS = 90          # last order at most this many days ago -> active
STALE_AFTER_DAYS = 180           # confidence drops when the last order is older
FEW_ORDERS = 3                   # confidence drops below this many orders
FACTOR_FEW_ORDERS = Decimal("0.7")
FACTOR_STALE = Decimal("0.8")
FACTOR_MISSING_DATES = Decimal("0.6")
DEFAULT_LOOKBACK_DAYS = 30
MICROS_PER_DAY = 86_400_000_000


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def ts_lit(value) -> Column:
    """A TIMESTAMP_NTZ literal from a datetime or 'YYYY-MM-DD HH:MM:SS' text."""
    if isinstance(value, Column):
        return value
    if isinstance(value, _dt.datetime):
        value = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    text = str(value)
    if not all(ch.isdigit() or ch in "-:. T" for ch in text):
        raise ValueError(f"not a timestamp: {text!r}")
    # a typed literal: folded at planning time, never parsed per row
    return F.expr(f"TIMESTAMP_NTZ '{text}'")


# --------------------------------------------------------------------- parsing
def money(x, strict: bool = True) -> Column:
    """Money text -> DECIMAL(18,2); NULL, missing and '' become 0.

    ``strict=True`` raises on junk like ``float()`` does (ANSI cast);
    ``strict=False`` yields NULL for junk so the row can be quarantined.
    """
    s = F.nullif(F.trim(_c(x).cast("string")), F.lit(""))
    parsed = s.cast(MONEY) if strict else s.try_cast(MONEY)
    return F.when(s.isNull(), F.lit(0).cast(MONEY)).otherwise(parsed)


def money_is_valid(x) -> Column:
    """True when the text is NULL, '' or a number; False for junk."""
    s = F.nullif(F.trim(_c(x).cast("string")), F.lit(""))
    return s.isNull() | s.try_cast(MONEY).isNotNull()


def iso_utc(x, strict: bool = False) -> Column:
    """ISO-8601 text (with 'Z', an offset, or none) -> UTC wall clock NTZ.

    A direct cast to TIMESTAMP_NTZ would drop the offset, so the text is read
    as an instant first and then expressed in UTC, independent of the
    session time zone.
    """
    s = _c(x).cast("string")
    instant = F.to_timestamp(s) if strict else F.try_to_timestamp(s)
    return F.convert_timezone(None, F.lit("UTC"), instant.cast("timestamp_ntz"))


def id_text(x) -> Column:
    """Null-safe id to text: NULL, 0 and '' become NULL, like ``str(x) if x``."""
    s = _c(x).cast("string")
    return F.when(s.isNull() | (s == "") | (s == "0"), F.lit(None).cast("string")).otherwise(s)


def consent_flag(state) -> Column:
    """email_marketing_consent.state == 'subscribed', False when absent (P5)."""
    return F.coalesce(_c(state) == F.lit("subscribed"), F.lit(False))


def tags_json(x) -> Column:
    """Tags as JSON text: a string is JSON-quoted, missing gives '[]' (P10)."""
    quoted = F.regexp_extract(F.to_json(F.struct(_c(x).alias("v"))), r'^\{"v":(.*)\}$', 1)
    return F.when(_c(x).isNull(), F.lit("[]")).otherwise(quoted)


# ------------------------------------------------------------------------ time
def whole_days(ts, as_of) -> Column:
    """Whole elapsed 24-hour periods from ``ts`` to ``as_of`` (floor), 0 if NULL.

    Not ``datediff`` (calendar days): 23:00 -> 01:00 next day is 0 days.
    """
    micros = F.timestamp_diff("MICROSECOND", _c(ts), ts_lit(as_of))
    days = F.floor(micros / F.lit(MICROS_PER_DAY)).cast("long")
    return days


def whole_days_or_zero(ts, as_of) -> Column:
    return F.coalesce(whole_days(ts, as_of), F.lit(0).cast("long"))


def minutes_between(start, end, mode: str = "boundary") -> Column:
    """Minutes from ``start`` to ``end``.

    ``boundary`` counts minute boundaries crossed (00:00:59 -> 00:01:01 is 1);
    ``elapsed`` counts whole elapsed minutes (that example is 0).
    """
    if mode == "boundary":
        return F.timestamp_diff("MINUTE", F.date_trunc("minute", _c(start)),
                                F.date_trunc("minute", _c(end)))
    if mode == "elapsed":
        return F.timestamp_diff("MINUTE", _c(start), _c(end))
    raise ValueError(f"unknown mode {mode!r}")


def lookback_start(as_of, days: int = DEFAULT_LOOKBACK_DAYS) -> Column:
    return ts_lit(as_of) - F.make_dt_interval(F.lit(days))


# --------------------------------------------------------------------- metrics
def status(last_order_date, as_of, current=None) -> Column:
    """active / inactive by recency of the last order; no orders keeps the
    current status, 'new' when there is none (X3)."""
    keep = F.coalesce(_c(current), F.lit(STATUS_NEW)) if current is not None else F.lit(STATUS_NEW)
    return (F.when(_c(last_order_date).isNull(), keep)
            .when(whole_days(last_order_date, as_of) <= ACTIVE_WITHIN_DAYS, F.lit(STATUS_ACTIVE))
            .otherwise(F.lit(STATUS_INACTIVE)))


def guarded_ratio(num, den) -> Column:
    """num / den as DOUBLE when den > 0, else 0.0."""
    n, d = _c(num).cast("double"), _c(den).cast("double")
    return F.when(d > 0, n / d).otherwise(F.lit(0.0))


def confidence(total_orders, first_order_date, last_order_date, as_of) -> Column:
    """Confidence score of a prediction (X6): 1.0, x0.7 with fewer than 3
    orders, x0.8 when the last order is over 180 days old, x0.6 when the
    first or last order date is missing; rounded to 2 places.

    Factors multiply as exact decimals, so the result is one of
    {1, .8, .7, .6, .56, .48, .42, .34} on every engine.
    """
    one = F.lit(Decimal("1.0"))
    few = F.when(F.coalesce(_c(total_orders), F.lit(0)) < FEW_ORDERS,
                 F.lit(FACTOR_FEW_ORDERS)).otherwise(one)
    stale = F.when(_c(last_order_date).isNotNull()
                   & (whole_days(last_order_date, as_of) > STALE_AFTER_DAYS),
                   F.lit(FACTOR_STALE)).otherwise(one)
    missing = F.when(_c(first_order_date).isNull() | _c(last_order_date).isNull(),
                     F.lit(FACTOR_MISSING_DATES)).otherwise(one)
    return F.round(few * stale * missing, 2).cast("double")


def money_out(x) -> Column:
    """Exact DECIMAL money -> DOUBLE for reports (cast once, at the end)."""
    return _c(x).cast("double")
