"""Date columns.  A decena is a third of a month: days 1-10, 11-20 and 21 to the end."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from cosecha.functions.text import month_number


def decena_of(d: Column) -> Column:
    return F.least(F.ceil(F.dayofmonth(d) / 10), F.lit(3)).cast("int")


def decena_end(year: Column, month: Column, decena: Column) -> Column:
    """Last day of a decena; null if any part is out of range."""
    first = F.try_to_date(F.format_string("%04d-%02d-01", year.cast("int"), month.cast("int")))
    return F.when(decena == 1, F.date_add(first, 9)).when(decena == 2, F.date_add(first, 19)).when(decena == 3, F.last_day(first))


def decena_of_year(month: Column, decena: Column) -> Column:
    return ((month - 1) * 3 + decena).cast("int")


def decena_index(year: Column, month: Column, decena: Column) -> Column:
    """Consecutive number of a decena."""
    return ((year * 12 + month - 1) * 3 + decena - 1).cast("int")


def of_decena_index(i: Column) -> tuple[Column, Column, Column]:
    """(year, month, decena) of a consecutive number."""
    months = F.floor(i / 3).cast("int")
    return F.floor(months / 12).cast("int"), (F.pmod(months, F.lit(12)) + 1).cast("int"), (F.pmod(i, F.lit(3)) + 1).cast("int")


def week_start(d: Column) -> Column:
    return F.date_trunc("week", d).cast("date")


def available_on(d: Column, frequency: Column, delay_days: int = 7) -> Column:
    """When a value is known: monthly series a week after the month's end, others on their own day."""
    return F.when(F.lower(frequency).startswith("mens"), F.date_add(F.last_day(d), delay_days)).otherwise(d)


def any_date(*columns: Column) -> Column:
    """The first that is a date: day/month/year or ISO."""
    tries = []
    for c in columns:
        tries += [F.try_to_date(c.cast("string"), "dd/MM/yyyy"), F.try_to_date(F.substring(c.cast("string"), 1, 10), "yyyy-MM-dd")]
    return F.coalesce(*tries)


def long_date(c: Column) -> Column:
    """'30 de abril de 2026'."""
    pattern = r"(?i)(\d{1,2})\s+de\s+([a-záéíóú]+)\s+(?:de\s+|del\s+)?(\d{4})"
    day, month, year = (F.regexp_extract(c, pattern, i) for i in (1, 2, 3))
    return F.try_to_date(F.concat_ws("-", F.nullif(year, F.lit("")), F.lpad(month_number(month).cast("string"), 2, "0"), F.lpad(day, 2, "0")), "yyyy-MM-dd")


def month_code(c: Column) -> Column:
    """'2026M01' as the first of the month."""
    return F.try_to_date(F.concat(F.nullif(F.regexp_extract(c, r"^(\d{4})M(\d{2})$", 1), F.lit("")), F.lit("-"), F.regexp_extract(c, r"^(\d{4})M(\d{2})$", 2), F.lit("-01")))


def cyclic(value: Column, period: float) -> tuple[Column, Column]:
    """(sine, cosine) of a value that repeats after ``period``."""
    angle = 2 * F.pi() * value / F.lit(period)
    return F.sin(angle), F.cos(angle)


def week_label(start: Column) -> Column:
    """'05/01/2026 a 11/01/2026' for a week that starts on a day."""
    return F.concat(F.date_format(start, "dd/MM/yyyy"), F.lit(" a "), F.date_format(F.date_add(start, 6), "dd/MM/yyyy"))


def query_date(run_date: Column) -> Column:
    """What a run asks for: the day before it."""
    return F.date_sub(run_date, 1)


def target_period(target: date | None = None, year: int | None = None, month: int | None = None, decena: int | None = None) -> tuple[int, int, int]:
    """(year, month, decena) as given, or of a date, which is today if nothing is given."""
    parts = (year, month, decena)
    if any(x is not None for x in parts):
        if None in parts or target is not None:
            raise ValueError("give year, month and decena, or a date, but not both")
        if month not in range(1, 13) or decena not in (1, 2, 3):
            raise ValueError(f"no such period: month {month}, decena {decena}")
        return year, month, decena
    day = target or date.today()
    return day.year, day.month, min(-(-day.day // 10), 3)
