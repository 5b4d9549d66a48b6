"""Scalar column builders. Each returns a ``Column``; none leaves the JVM."""

from __future__ import annotations

import math
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from stationlake.schema import SEASON_NH, TENTHS


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def blank_to_null(col: str | Column) -> Column:
    """Strip a flag; an empty result becomes NULL."""
    return F.nullif(F.trim(_c(col)), F.lit(""))


def scale_units(value_raw: str | Column, element: str | Column, tenths: Iterable[str] = TENTHS) -> Column:
    """Raw integer value to physical units: tenths elements are divided by 10 once."""
    raw = _c(value_raw).cast("double")
    return F.when(_c(element).isin(list(tenths)), raw / 10.0).otherwise(raw)


def date_key(d: str | Column) -> Column:
    """DATE -> integer YYYYMMDD."""
    d = _c(d)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def days_between(later: str | Column, earlier: str | Column) -> Column:
    """Integer day difference (``date - date`` in SQL), as BIGINT."""
    return F.datediff(_c(later), _c(earlier)).cast("bigint")


def decade(year: str | Column) -> Column:
    """Integer decade bucket: (year div 10) * 10."""
    return (F.floor(_c(year) / 10) * 10).cast("int")


def iso_weekday(d: str | Column) -> Column:
    """ISO weekday, Monday = 1 ... Sunday = 7 (``dayofweek`` is Sunday = 1)."""
    return (F.weekday(_c(d)) + 1).cast("int")


def season_nh(month: str | Column) -> Column:
    """Northern-hemisphere season name of a calendar month 1..12."""
    return F.element_at(F.array(*[F.lit(s) for s in SEASON_NH]), _c(month).cast("int"))


def cyclic_doy(d: str | Column, period: float = 365.25) -> tuple[Column, Column]:
    """(sin, cos) of 2*pi*day_of_year/period."""
    angle = F.lit(2.0 * math.pi) * F.dayofyear(_c(d)) / F.lit(period)
    return F.sin(angle), F.cos(angle)


def round_opt(col: str | Column, digits: int | None) -> Column:
    """``round(col, digits)``; ``digits=None`` keeps the value unrounded."""
    return _c(col) if digits is None else F.round(_c(col), digits)
