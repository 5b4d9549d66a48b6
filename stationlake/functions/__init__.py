"""Column expressions shared by the operators (all JVM-side, no UDFs)."""

from stationlake.functions.columns import (
    blank_to_null,
    cyclic_doy,
    date_key,
    days_between,
    decade,
    iso_weekday,
    round_opt,
    scale_units,
    season_nh,
)

__all__ = [
    "blank_to_null", "cyclic_doy", "date_key", "days_between", "decade", "iso_weekday",
    "round_opt", "scale_units", "season_nh",
]
