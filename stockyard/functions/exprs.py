"""Column expressions shared by the operators. All of them stay inside generated JVM code."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, functions as F

MONEY = "decimal(15,2)"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch(c: Column | str) -> Column:
    """Whole seconds since the epoch; fractions are cut."""
    return F.unix_timestamp(col(c))


def hour(c: Column | str) -> Column:
    return F.hour(col(c))


def rounded(c: Column | str, digits: int) -> Column:
    return F.round(col(c), digits)


def today(as_of: date | datetime) -> Column:
    """The current date is always an argument, so that a rerun gives the same answer."""
    return F.lit(as_of.date() if isinstance(as_of, datetime) else as_of)


def moment(at: date | datetime) -> Column:
    """A zone-less timestamp literal; it compares with stored columns without a cast, so it is pushed to the scan."""
    stamp = at if isinstance(at, datetime) else datetime(at.year, at.month, at.day)
    return F.lit(stamp.isoformat(sep=" ")).cast("timestamp_ntz")


def trunc_to(unit: str, c: Column | str) -> Column:
    return F.date_trunc(unit, col(c)).cast("timestamp_ntz")


def hours_between(start: Column | str, end: Column | str) -> Column:
    return (epoch(end) - epoch(start)) / F.lit(3600.0)


def ratio(num: Column, den: Column) -> Column:
    """Division that yields NULL on a zero or NULL divisor; ANSI mode raises on ``/ 0``."""
    return num.cast("double") / F.nullif(den.cast("double"), F.lit(0.0))


def percent(num: Column, den: Column, digits: int) -> Column:
    return F.round(ratio(F.lit(100.0) * num, den), digits)


def money_sum(c: Column | str) -> Column:
    """Sum of amounts in decimal arithmetic: the result does not depend on how the rows are partitioned."""
    return F.sum(col(c).cast(MONEY)).cast("double")


def money_avg(c: Column | str, digits: int = 2) -> Column:
    return F.round(ratio(F.sum(col(c).cast(MONEY)), F.count(col(c))), digits)


def exact_avg(c: Column | str, scale: int = 10) -> Column:
    """Mean of a measure with few digits, summed as decimal for the same reason."""
    return ratio(F.sum(col(c).cast(f"decimal(28,{scale})")), F.count(col(c)))


def lenient_double(c: Column | str) -> Column:
    """Text to number; text that is blank, unreadable, or names no finite number counts as zero."""
    number = F.trim(col(c).cast("string")).try_cast("double")
    return F.when(F.abs(number) < float("inf"), number).otherwise(0.0)


def digits_only(c: Column | str) -> Column:
    return F.regexp_replace(col(c), "[^0-9]", "")


def cep_digits(c: Column | str) -> Column:
    """The eight digits of a postal code, NULL if it has any other length."""
    digits = digits_only(c)
    return F.when(F.length(digits) == 8, digits)
