"""Column builders shared by the operators.

Spark 4 runs with ANSI mode on: a bad cast or a division by zero raises.
The reference ran Spark 3 where those gave NULL, so every cast/parse/divide
here uses the ``try_`` variant to keep the NULL-on-bad-input behaviour.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from txlens.schema import MONTH_FORMAT, NIGHT_HOURS, TS_FORMAT, WEEKDAY_ORDER, WEEKEND_DAYS


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_timestamp(c, fmt: str = TS_FORMAT) -> Column:
    return F.try_to_timestamp(col_(c), F.lit(fmt))


def whole_number(c, kind: str) -> Column:
    """Text -> bigint/int as a non-ANSI cast gives it: surrounding white space and a
    fraction are dropped (``1.0`` -> 1, ``-2.9`` -> -2, ``.5`` -> 0); anything else that
    is no plain number (``1e3``, ``abc``, empty) is NULL."""
    text = col_(c).cast("string")
    # most values are plain numbers: patterns are tried only where the cast gives NULL
    digits = F.regexp_extract(text, r"^\s*([+-]?[0-9]+)(?:\.[0-9]*)?\s*$", 1)
    slow = F.when(text.rlike(r"^\s*[+-]?\.[0-9]+\s*$"), F.lit(0).cast(kind)).otherwise(digits.try_cast(kind))
    return F.coalesce(text.try_cast(kind), slow)


def ratio(num, den) -> Column:
    return F.try_divide(col_(num), col_(den))


def spark_round(c, scale: int) -> Column:
    return F.round(col_(c), scale)


def pct(num, den, scale: int = 2) -> Column:
    """round(num / den * 100, scale); NULL when den is 0."""
    return F.round(F.try_divide(col_(num), col_(den)) * F.lit(100), scale)


MONEY_LIMIT, MONEY_SCALE = 4e8, 100_000_000       # amounts below the limit are summed in whole 1e-8


def _money(c) -> tuple[Column, Column, Column]:
    """(fits, whole part sum, 1e-8 part sum) of an amount: two sums of longs, exact in any order of the partitions."""
    x = col_(c).cast("double")
    small = F.abs(x) < F.lit(MONEY_LIMIT)                        # false for NaN and infinity
    units = F.floor(F.when(small, x))
    parts = F.floor((F.when(small, x) - units) * F.lit(float(MONEY_SCALE)) + F.lit(0.5))
    units, parts = F.try_sum(units), F.try_sum(parts)
    fits = F.coalesce(F.max(F.abs(x)) < F.lit(MONEY_LIMIT), F.lit(False)) & units.isNotNull() & parts.isNotNull()
    return fits, units.cast("decimal(28,8)"), parts.cast("decimal(20,0)") * F.lit("0.00000001").cast("decimal(8,8)")


def money_sum(c="TX_AMOUNT") -> Column:
    """Sum of a money column as a double that does not depend on the order of the partitions.

    Amounts of 4e8 and more, NaN and infinity make the group's sum a plain double sum."""
    fits, units, parts = _money(c)
    return F.when(fits, (units + parts).cast("double")).otherwise(F.sum(col_(c).cast("double")))


def money_avg(c="TX_AMOUNT") -> Column:
    """Mean of a money column, rounded once to cents (2 dp).

    The unrounded amounts (to 1e-8) are summed in whole numbers, so the mean and the HALF_UP
    rounding of a tie (x.xx5) do not depend on the order in which partitions
    were summed (a double ``round(avg, 2)`` does).  Amounts of 4e8 and more, NaN and infinity make the
    group's mean a rounded plain ``avg``; no amount ends the job."""
    fits, units, parts = _money(c)
    exact = F.round((units + parts).cast("decimal(38,10)") / F.count(col_(c)), 2).cast("double")
    return F.when(fits, exact).otherwise(F.round(F.avg(col_(c).cast("double")), 2))


def vertex_id(prefix: str, c) -> Column:
    return F.concat(F.lit(prefix), col_(c).cast("string"))


def weekday_number(day_col) -> Column:
    """1 for Mon ... 7 for Sun (0 if unknown) — an explicit sort key."""
    return F.array_position(F.array(*[F.lit(d) for d in WEEKDAY_ORDER]), col_(day_col)).cast("int")


def is_weekend(day_col) -> Column:
    return F.when(col_(day_col).isin(*WEEKEND_DAYS), F.lit(1)).otherwise(F.lit(0))


def is_night(hour_col) -> Column:
    lo, hi = NIGHT_HOURS
    h = col_(hour_col)
    return F.when((h >= lo) & (h < hi), F.lit(1)).otherwise(F.lit(0))


def calendar_columns(ts_col="TX_DATETIME") -> dict[str, Column]:
    ts = col_(ts_col)
    return {
        "tx_date": F.to_date(ts),
        "tx_year_month": F.date_format(ts, MONTH_FORMAT),
        "tx_hour": F.hour(ts),
        "tx_day_of_week": F.date_format(ts, "E"),
    }
