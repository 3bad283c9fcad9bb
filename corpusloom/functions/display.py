"""Figures as people read them, and times of run records."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def moment(iso: Column) -> Column:
    """The time that an ISO 8601 text says; null for anything else."""
    return F.try_to_timestamp(iso)


def iso_text(at: Column) -> Column:
    """A time as ISO 8601 in UTC (with a session in that zone)."""
    return F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")


def age_text(iso: Column, now: Column) -> Column:
    """How long before ``now`` an ISO time was: minutes below an hour, hours below a day, else days; a dash without one, a text that is no time as it is."""
    at = moment(iso)
    seconds = now.cast("double") - at.cast("double")
    hours = F.concat(F.format_string("%.1f", F.bround(seconds / 3600, 1)), F.lit("h ago"))
    said = F.when(seconds < 3600, F.concat((seconds / 60).cast("long").cast("string"), F.lit("m ago"))).when(seconds < 86400, hours).otherwise(F.concat(F.floor(seconds / 86400).cast("string"), F.lit("d ago")))
    return F.when(iso.isNull() | (iso == ""), "—").when(at.isNull(), iso).otherwise(said)


def bytes_text(n: Column) -> Column:
    """Bytes, or kilo- or megabytes with one digit; null stays null."""
    scaled = lambda size, unit: F.concat(F.format_string("%.1f", F.bround(n / size, 1)), F.lit(unit))
    return F.when(n < 1024, F.concat(n.cast("string"), F.lit(" B"))).when(n < 1024 * 1024, scaled(1024, " KB")).when(n.isNotNull(), scaled(1024 * 1024, " MB"))
