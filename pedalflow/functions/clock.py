"""Time expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import TIME_TOLERANCE

# Epoch seconds of 0001-01-01 and 9999-12-31T23:59:59 (UTC), the range of a timestamp that prints and casts.
_FIRST_SECOND = -62135596800
_LAST_SECOND = 253402300799


def event_time(epoch) -> Column:
    """Timestamp of an epoch second; null outside the years 1 to 9999.

    The number goes straight to a timestamp. A detour over local clock text would fold the repeated hour of an autumn
    clock change, and an absurd number must not stop a running stream with an overflow error.
    """
    epoch = F.col(epoch) if isinstance(epoch, str) else epoch
    return F.when(epoch.between(_FIRST_SECOND, _LAST_SECOND), F.timestamp_seconds(epoch))


def plausible(moment, sent, tolerance=TIME_TOLERANCE) -> Column:
    """The event time, or null if it lies more than ``tolerance`` after the message was sent.

    One absurd time would move the watermark of a stream there and make all later rows late. An unknown time of sending
    judges nothing.
    """
    moment = F.col(moment) if isinstance(moment, str) else moment
    sent = F.col(sent) if isinstance(sent, str) else sent
    return F.when(sent.isNull() | (moment <= sent + F.expr(f"INTERVAL {tolerance}")), moment)


def epoch_seconds(moment) -> Column:
    """Whole epoch seconds of a timestamp, rounded down."""
    moment = F.col(moment) if isinstance(moment, str) else moment
    return F.unix_seconds(moment.cast("timestamp"))


def _local(moment, zone) -> Column:
    moment = F.col(moment) if isinstance(moment, str) else moment
    return moment if zone is None else F.from_utc_timestamp(moment, zone)


def hour_of(moment, zone=None) -> Column:
    """Hour of day, in the session zone or in ``zone`` (the session then has to be UTC)."""
    return F.hour(_local(moment, zone))


def weekday_of(moment, zone=None) -> Column:
    """Day of week, Sunday = 1 to Saturday = 7."""
    return F.dayofweek(_local(moment, zone))


def is_weekend(weekday) -> Column:
    """1.0 for Saturday and Sunday, 0.0 for any other day."""
    weekday = F.col(weekday) if isinstance(weekday, str) else weekday
    return F.when(weekday.isin(1, 7), F.lit(1.0)).otherwise(F.lit(0.0))
