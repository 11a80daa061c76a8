"""The five dashboard views over the top-k roll-up."""

from __future__ import annotations

from pyspark.sql import DataFrame

from carelens.operators.aggregate import minmax_scale
from carelens.schemas import GRADIENT_COLS, VIEW_HOURS_CENSUS, VIEW_OCCUPANCY, VIEW_RATING, VIEW_STAFF_MIX, VIEW_TABLE


def view_hours_census(top: DataFrame) -> DataFrame:
    """Provider, mean total nurse hours, mean census."""
    return top.select(*VIEW_HOURS_CENSUS)


def view_occupancy(top: DataFrame) -> DataFrame:
    """P9."""
    return top.select(*VIEW_OCCUPANCY)


def view_rating(top: DataFrame) -> DataFrame:
    """P10."""
    return top.select(*VIEW_RATING)


def view_staff_mix(top: DataFrame) -> DataFrame:
    """P11."""
    return top.select(*VIEW_STAFF_MIX)


def view_table(top: DataFrame) -> DataFrame:
    """State, provider, name, census, hours, occupancy, rating."""
    return top.select(*VIEW_TABLE)


def view_table_scaled(top: DataFrame) -> DataFrame:
    """P12 with census and occupancy scaled to [0, 1] over the shown rows (A5),
    the numbers behind the table's colour gradient."""
    return minmax_scale(view_table(top), GRADIENT_COLS, bounded=True)
