"""Numeric scalar expressions."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def nan_to_null(x) -> Column:
    """Spark orders NaN above every number (``NaN > 0`` is true); pandas
    treats it as missing.  Inputs go through this at load."""
    col = _c(x).cast("double")
    return F.when(F.isnan(col), F.lit(None).cast("double")).otherwise(col)


def round_to(x, digits: int = 2) -> Column:
    """Float + round half up (matches the SQL oracle)."""
    return F.round(_c(x).cast("double"), digits)


def days_between(ts, reference) -> Column:
    """Floor of the exact interval in days (``Timedelta.days``).

    Not ``datediff``: that counts calendar-date changes (T5)."""
    if isinstance(reference, (_dt.date, _dt.datetime, str)):
        ref = F.lit(str(reference)).cast("timestamp_ntz")
    else:
        ref = _c(reference)
    micros = F.timestamp_diff("MICROSECOND", _c(ts).cast("timestamp_ntz"), ref.cast("timestamp_ntz"))
    return F.floor(micros / F.lit(86_400_000_000.0)).cast("bigint")


def min_max_scale(x, lo, hi) -> Column:
    """(x - lo) / (hi - lo); degenerate range -> 0."""
    x, lo, hi = _c(x), _c(lo), _c(hi)
    return F.when(hi <= lo, F.lit(0.0)).otherwise((x - lo) / (hi - lo))


def gate(x, threshold) -> Column:
    """Value if >= threshold else 0."""
    x = _c(x)
    t = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return F.when(x >= t, x).otherwise(F.lit(0.0))


def price_match(price, avg_price, tolerance) -> Column:
    """exp(-|p - avg| / max(tol, 1))."""
    return F.exp(-F.abs(_c(price) - _c(avg_price)) / F.greatest(_c(tolerance), F.lit(1.0)))
