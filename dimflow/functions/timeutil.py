"""Hour / minute batch arithmetic as Column expressions.

Every expression works on ``TIMESTAMP_NTZ`` and integer hours so results do not
depend on the session time zone: ``timestampdiff``/``timestampadd`` against an
NTZ epoch literal, and ``date_format`` on NTZ values, never the session-zone
``TIMESTAMP`` type.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = "Column | str"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ntz(text: str) -> Column:
    """A TIMESTAMP_NTZ literal (folded to a constant by the optimizer)."""
    return F.to_timestamp_ntz(F.lit(text))


EPOCH_NTZ = "1970-01-01 00:00:00"


def utc_hour(ts) -> Column:
    """H1: floor(epoch seconds / 3600) of a UTC wall-clock timestamp, BIGINT.

    Days since the epoch times 24 plus the hour of day -- plain NTZ field
    arithmetic, no cast through the session time zone."""
    c = _col(ts)
    return (F.unix_date(F.to_date(c)).cast("bigint") * 24 + F.hour(c)).cast("bigint")


def hour_ts(hour) -> Column:
    """H2: the UTC hour number back to a TIMESTAMP_NTZ."""
    return F.timestamp_add("HOUR", _col(hour).cast("bigint"), ntz(EPOCH_NTZ))


def to_pacific(ts, zone: str = "US/Pacific") -> Column:
    """H3: a UTC wall time shown as wall time in ``zone`` (NTZ in, NTZ out)."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), _col(ts))


def minute_string(ts) -> Column:
    """The ``yyyyMMddHHmm`` batch stamp of a timestamp."""
    return F.date_format(_col(ts), "yyyyMMddHHmm")


def parse_minute(stamp) -> Column:
    """``yyyyMMddHHmm`` text (or number) to TIMESTAMP_NTZ."""
    return F.to_timestamp_ntz(_col(stamp).cast("string"), F.lit("yyyyMMddHHmm"))


def truncate_to_second(ts) -> Column:
    """Drop sub-second digits of an NTZ value and stay NTZ (no session zone)."""
    return F.to_timestamp_ntz(F.date_format(_col(ts), "yyyy-MM-dd HH:mm:ss"))


# Batch directory layouts used by the dump and load steps.
BATCH_FORMATS = {
    "slash_hour": "yyyy/MM/dd/HH",      # wrapper hour folder
    "hour": "yyyyMMddHH",               # hourly load, production
    "hour00": "yyyyMMddHH00",           # hourly load, staging environments
    "minute": "yyyyMMddHHmm",           # minute loads and non-hourly dumps
    "date": "'date='yyyy-MM-dd",        # daily load
}


def batch_path(hour, layout: str = "hour") -> Column:
    """The batch folder name for a UTC hour number in one of the layouts."""
    return F.date_format(hour_ts(hour), BATCH_FORMATS[layout])


def next_minute_stamp(stamp, step_minutes: int) -> Column:
    """H4 (minute mode): last ``yyyyMMddHHmm`` stamp plus ``step`` minutes."""
    return minute_string(F.timestamp_add("MINUTE", F.lit(step_minutes),
                                         parse_minute(stamp)))


def hour_of_minute(stamp) -> Column:
    """H4, manual minute: a given ``yyyyMMddHHmm`` stamp is loaded as is (no
    step) and its UTC hour is derived from it."""
    return utc_hour(parse_minute(stamp))
