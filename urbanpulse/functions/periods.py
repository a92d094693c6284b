"""Period parsing (X1-X6) and period keys.

Free-form dates (deals, rent) keep only their ASCII digits, then take digits
1-4 as the year and 5-6 as the month -- faithfully, so ``2024.3.5`` gives
month 35 (``valid_period`` filters such rows).  Fixed codes (sales ``YYYYQ``,
population ``YYYYMMDD``) are cut by position.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _digits(c) -> Column:
    return F.regexp_replace(_col(c), "[^0-9]", "")


def extract_year(c) -> Column:
    d = _digits(c)
    return F.when(F.length(d) >= 4, F.substring(d, 1, 4).try_cast("int"))


def extract_month(c) -> Column:
    d = _digits(c)
    return F.when(F.length(d) >= 6, F.substring(d, 5, 2).try_cast("int"))


def code_year(c) -> Column:
    v = _col(c)
    return F.when(F.length(v) >= 4, F.substring(v, 1, 4).try_cast("int"))


def code_month(c) -> Column:
    v = _col(c)
    return F.when(F.length(v) >= 6, F.substring(v, 5, 2).try_cast("int"))


def code_quarter(c) -> Column:
    """Everything after the 4th character of a ``YYYYQ`` code."""
    v = _col(c)
    return F.when(F.length(v) > 4, v.substr(F.lit(5), F.length(v)).try_cast("int"))


def quarter_of_month(month) -> Column:
    return F.ceil(_col(month) / F.lit(3)).cast("int")


def period_key(year, quarter) -> Column:
    """YEAR*10 + QUARTER, e.g. 20241."""
    return (_col(year) * 10 + _col(quarter)).cast("int")


def month_end_yyyymmdd(year, month) -> Column:
    """Last day of the month as zero-padded ``yyyyMMdd`` text."""
    return F.date_format(F.last_day(F.make_date(_col(year), _col(month), F.lit(1))), "yyyyMMdd")


def parse_yyyymmdd(c) -> Column:
    """``yyyyMMdd`` text -> date, null when not a real date (never raises)."""
    v = _col(c)
    return F.when(v.rlike("^[0-9]{8}$"), F.try_to_date(v, "yyyyMMdd"))
