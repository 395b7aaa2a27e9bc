"""Identifiers, labels and names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Digits of a zone id at each level of the census hierarchy.
LEVEL_WIDTH = {"Block": 15, "BG": 12, "Tract": 11, "County": 5}


def zero_pad(c: Column, width: int) -> Column:
    """Left-pad with zeros; longer values stay whole (``lpad`` alone would cut them)."""
    s = c.cast("string")
    return F.when(F.length(s) >= width, s).otherwise(F.lpad(s, width, "0"))


def slug(c: Column) -> Column:
    return F.replace(F.replace(F.lower(c), F.lit(" "), F.lit("-")), F.lit("."), F.lit(""))


def title_from_slug(c: Column) -> Column:
    return F.initcap(F.replace(c, F.lit("-"), F.lit(" ")))


def principal_city(c: Column) -> Column:
    """First place named in an urban-area name."""
    return F.regexp_extract(c, r"^[^,\-/]*", 0)


def prefix(c: Column, level: str) -> Column:
    return F.substring(c, 1, LEVEL_WIDTH[level])


def purpose_of(kind: Column) -> Column:
    return F.when(kind.startswith("Jobs"), "Work").otherwise("Non-work")


def minutes_label(c: Column) -> Column:
    return F.concat(c.cast("string"), F.lit(" min"))


def minutes_from_label(c: Column) -> Column:
    return F.regexp_replace(c, " min$", "").cast("int")


def compact_stamp(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMdd-HHmmss")


def unit_name(city: Column, mode: Column, departure: Column) -> Column:
    """Name of one routed unit: city slug, lower-case mode and departure stamp."""
    return F.concat_ws("_", slug(city), F.lower(mode), compact_stamp(departure))
