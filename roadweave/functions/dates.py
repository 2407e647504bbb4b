"""Calendar expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_list(first: Column, last: Column) -> Column:
    """Months from first to last as yyyyMM, both included."""
    return F.transform(F.sequence(F.trunc(first, "month"), F.trunc(last, "month"), F.expr("interval 1 month")), lambda m: F.date_format(m, "yyyyMM"))


def week_range(day: Column) -> tuple[Column, Column]:
    """Monday and Sunday of a day's week."""
    start = F.trunc(day, "week").cast("date")
    return start, F.date_add(start, 6)


def month_range(day: Column) -> tuple[Column, Column]:
    return F.trunc(day, "month"), F.last_day(day)


def quarter_range(day: Column) -> tuple[Column, Column]:
    start = F.trunc(day, "quarter")
    return start, F.last_day(F.add_months(start, 2))


def business_days(first: Column, last: Column) -> Column:
    """Number of days from Monday to Friday, both ends included."""
    return F.size(F.filter(F.sequence(first, last), lambda d: F.weekday(d) < 5))


def batches(first: Column, last: Column, days: int) -> Column:
    """Consecutive ranges of `days` days from first to last, the last one shorter."""
    starts = F.sequence(first, last, F.expr(f"interval {days} days"))
    return F.transform(starts, lambda d: F.struct(d.alias("first"), F.least(F.date_add(d, days - 1), last).alias("last")))


def topology_version(day: Column) -> Column:
    """The graph that holds on a day: a step function."""
    return F.when(F.year(day) >= 2026, "202512").when(day >= F.to_date(F.lit("2025-07-01")), "202507").otherwise("202412")


def month_key(text: Column) -> Column:
    """`2027/1/1`, `2027-01` or a spreadsheet's day number as yyyy-MM; null for anything else."""
    number = F.expr("date_add(date '1899-12-30', try_cast({} as int))".format("month_text"))
    parts = F.regexp_extract(text, r"^(\d{4})[/-](\d{1,2})", 1), F.regexp_extract(text, r"^(\d{4})[/-](\d{1,2})", 2)
    return F.when(parts[0] != "", F.concat(parts[0], F.lit("-"), F.lpad(parts[1], 2, "0"))).when(text.rlike(r"^\d{5}$"), F.date_format(number, "yyyy-MM"))
