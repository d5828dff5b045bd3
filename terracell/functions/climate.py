"""Unit and climate formulas."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..constants import GDD_BASE_C, KELVIN_OFFSET


def to_celsius(value: Column, units: Column) -> Column:
    return F.when(F.trim(units) == "K", value - KELVIN_OFFSET).otherwise(value)


def saturation_vapor_pressure(temp_c: Column) -> Column:
    """Tetens formula, kPa."""
    return F.exp(temp_c * 17.27 / (temp_c + 237.3)) * 0.6108


def vapor_pressure_deficit(temp_c: Column, humidity_pct: Column) -> Column:
    return saturation_vapor_pressure(temp_c) * (1 - humidity_pct / 100)


def degree_days(tmax_c: Column, tmin_c: Column, base: float = GDD_BASE_C) -> Column:
    return F.greatest((tmax_c + tmin_c) / 2 - base, F.lit(0.0))
