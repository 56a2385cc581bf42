"""Instants, local time and positions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pricegrid.schemas import DISPLAY_TZ


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def local_to_utc(
    local: str | Column, zone: str = DISPLAY_TZ, ambiguous: str = "first"
) -> Column:
    """Instant of a zone-less local time.

    A skipped local time moves forward to the first instant after the change
    (zone changes fall on full hours). A repeated one means its first instant,
    or null with ``ambiguous='null'``.
    """
    naive = _col(local).cast("timestamp_ntz").cast("timestamp")
    instant = F.to_utc_timestamp(naive, zone)
    skipped = F.from_utc_timestamp(instant, zone) != naive
    out = F.when(skipped, F.date_trunc("hour", instant))
    if ambiguous == "null":
        later = instant + F.make_dt_interval(hours=F.lit(1))
        out = out.when(F.from_utc_timestamp(later, zone) == naive, F.lit(None))
    elif ambiguous != "first":
        raise ValueError(f"unknown rule for repeated hours {ambiguous!r}")
    return out.otherwise(instant)


def is_repeated(local: str | Column, zone: str = DISPLAY_TZ) -> Column:
    """Whether a zone-less local time occurs twice in the zone."""
    return _col(local).isNotNull() & local_to_utc(local, zone, "null").isNull()


def occurrences(times: Column, parsed, zone: str = DISPLAY_TZ) -> Column:
    """For the local times of a document in its order, which occurrence each one is.

    0 is the first instant of a repeated hour, and any hour that is not repeated; 1 is
    the later instant: the same local time stands further ahead in the document. Null
    where a repeated hour stands there only once, so the order does not tell. ``parsed``
    makes a local time of an entry. Only repeated hours, two a year, are looked up.
    """

    def one(time: Column, i: Column) -> Column:
        ahead = F.array_position(times, time) <= i
        behind = F.array_position(F.slice(times, i + 2, F.size(times)), time) > 0
        told = F.when(ahead, 1).when(behind, 0)
        return F.when(is_repeated(parsed(time), zone), told).otherwise(0)

    return F.transform(times, one)


def utc_to_local(ts: str | Column, zone: str = DISPLAY_TZ) -> Column:
    """Zone-less local time of an instant, for presentation."""
    return F.from_utc_timestamp(_col(ts), zone)


def position_time(start: str | Column, position: str | Column, minutes: str | Column) -> Column:
    """Instant of a 1-based position in a period of equal steps."""
    offset = ((_col(position) - 1) * _col(minutes)).cast("int")
    return _col(start) + F.make_dt_interval(mins=offset)


def month_id(ts: str | Column, zone: str | None = None) -> Column:
    """``yyyy-MM`` of an instant, in UTC or in a zone."""
    moment = _col(ts) if zone is None else F.from_utc_timestamp(_col(ts), zone)
    return F.date_format(moment, "yyyy-MM")
