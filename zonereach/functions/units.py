"""Unit conversions. The factors below are fixed values."""

from __future__ import annotations

from pyspark.sql import Column

M_PER_MI = 1609.34
KM_PER_MI = 1.60934
FT_PER_M = 3.28084
SQM_PER_SQMI = 2.59e6
MPH_PER_MPS = 2.2369363


def m_to_ft(c: Column) -> Column:
    return c * FT_PER_M


def ft_to_m(c: Column) -> Column:
    return c / FT_PER_M


def mi_to_m(c: Column) -> Column:
    return c * M_PER_MI


def m_to_mi(c: Column) -> Column:
    return c / M_PER_MI


def mi_to_km(c: Column) -> Column:
    return c * KM_PER_MI


def km_to_mi(c: Column) -> Column:
    return c / KM_PER_MI


def sqm_to_sqmi(c: Column) -> Column:
    return c / SQM_PER_SQMI


def sqmi_to_sqm(c: Column) -> Column:
    return c * SQM_PER_SQMI


def mps_to_mph(c: Column) -> Column:
    return c * MPH_PER_MPS


def mph_to_mps(c: Column) -> Column:
    return c / MPH_PER_MPS


def seconds_to_minutes(c: Column) -> Column:
    return c / 60.0
