"""Price change and its class (SCL7, SCL8)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlake import fixed
from ledgerlake.functions.scalars import ColumnOrName, _c

_INF = float("inf")


def percent_change(first: ColumnOrName, last: ColumnOrName, orientation: str = "reference") -> Column:
    """Percent change between the first and last close of a window.

    ``reference``: (first - last) * 100 / last -- positive means the price
    fell, which is what the original job stores.  ``return``: the usual
    (last - first) * 100 / first.
    A zero divisor follows IEEE rules (x/0 = +-inf, 0/0 = NaN) instead of
    raising under ANSI mode.
    """
    f, l = _c(first).cast("double"), _c(last).cast("double")
    if orientation == "reference":
        num, den = f - l, l
    elif orientation == "return":
        num, den = l - f, f
    else:
        raise ValueError(f"unknown orientation {orientation!r}")
    return (
        F.when(den.isNull() | num.isNull(), F.lit(None).cast("double"))
        .when(den != 0, num * 100 / den)
        .when(num > 0, F.lit(_INF))
        .when(num < 0, F.lit(-_INF))
        .otherwise(F.lit(float("nan")))
    )


def change_class(pct: ColumnOrName) -> Column:
    """Seven-way class of a percent change; NaN and null give null.
    NaN is tested first: Spark orders NaN above every number."""
    p = _c(pct).cast("double")
    large, medium = fixed.CLASS_LARGE, fixed.CLASS_MEDIUM
    return (
        F.when(p.isNull() | F.isnan(p), F.lit(None))
        .when(p < -large, 1)
        .when(p < -medium, 2)
        .when(p < 0, 3)
        .when(p == 0, 4)
        .when(p <= medium, 5)
        .when(p <= large, 6)
        .otherwise(7)
        .cast("int")
    )
