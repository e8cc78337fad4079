"""Date and time texts, always in the session time zone."""

from pyspark.sql import Column, functions as F

from ..constants import DATE_FORMAT, DATETIME_FORMAT

# Beyond this a millisecond value no longer fits Spark's microsecond clock; such a value counts as no time.
_MAX_MILLIS = 9_000_000_000_000_000


def millis_timestamp(millis: Column) -> Column:
    """The time of an epoch value in milliseconds; null where Spark has no such time, so that no record ends a job."""
    return F.timestamp_millis(F.when(millis.between(-_MAX_MILLIS, _MAX_MILLIS), millis))


def epoch_date(millis: Column) -> Column:
    return F.date_format(millis_timestamp(millis), DATE_FORMAT)


def epoch_datetime(millis: Column) -> Column:
    return F.date_format(millis_timestamp(millis), DATETIME_FORMAT)


def format_date(c: Column) -> Column:
    """Bring a date text to ``yyyy-MM-dd HH:mm:ss``.

    A text that starts with a date and a time, all parts but the year of one or two digits, keeps these. Otherwise a decimal
    number is read as epoch milliseconds, with any fraction cut off. Everything else gives the empty string. Impossible
    dates such as month 13 count as "everything else"; they are not rolled over into the next year.
    """
    lead = F.regexp_extract(c, r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}", 0)
    number = c.try_cast("decimal(38,6)").try_cast("bigint")
    stamp = F.coalesce(F.try_to_timestamp(lead, F.lit("yyyy-M-d H:m:s")), millis_timestamp(number))
    return F.coalesce(F.date_format(stamp, DATETIME_FORMAT), F.lit(""))
