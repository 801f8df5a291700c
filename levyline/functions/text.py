"""Text, time and id expressions. Everything here is a built-in column expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss"
SQL_SECONDS = "yyyy-MM-dd HH:mm:ss"


def col(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def seconds_text(stamp) -> Column:
    """First 19 characters with a space between date and time; the zone offset is cut off, not applied."""
    return F.replace(F.substring(col(stamp), 1, 19), F.lit("T"), F.lit(" "))


def event_time(stamp) -> Column:
    """Event time of an ISO text; NULL when it cannot be parsed."""
    return F.try_to_timestamp(seconds_text(stamp), F.lit(SQL_SECONDS))


def iso_text(ts) -> Column:
    return F.date_format(col(ts), ISO_SECONDS)


def sql_text(ts) -> Column:
    return F.date_format(col(ts), SQL_SECONDS)


def minute_text(epoch_millis) -> Column:
    return F.date_format(F.timestamp_millis(col(epoch_millis)), "yyyy-MM-dd HH:mm")


def trimmed(value) -> Column:
    """Spaces off both ends; tabs and line breaks stay."""
    return F.trim(col(value))


def upper_trimmed(value) -> Column:
    return F.upper(trimmed(value))


# fixed values: white space in the Unicode sense
WHITE = "".join(
    map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000])
)


def stripped(value) -> Column:
    """All white space off both ends."""
    return F.btrim(col(value), F.lit(WHITE))


def token_estimate(value) -> Column:
    return (F.floor(F.length(col(value)) / F.lit(4)) + 1).cast("long")


def to_number(value) -> Column:
    """Number of a text or number, 0 for anything that is not one (NaN and infinities included)."""
    number = col(value).try_cast("double")
    return F.when(F.isnan(number) | (F.abs(number) == F.lit(float("inf"))), F.lit(0.0)).otherwise(
        F.coalesce(number, F.lit(0.0))
    )


# fixed value: the DNS namespace of RFC 4122
UUID_DNS_NAMESPACE = "6ba7b8109dad11d180b400c04fd430c8"


def uuid5(name) -> Column:
    """Version-5 UUID of a name in the DNS namespace, as text."""
    digest = F.sha1(F.concat(F.unhex(F.lit(UUID_DNS_NAMESPACE)), F.encode(col(name), "UTF-8")))
    variant = F.translate(F.substring(digest, 17, 1), "0123456789abcdef", "89ab89ab89ab89ab")
    return F.concat_ws(
        "-",
        F.substring(digest, 1, 8),
        F.substring(digest, 9, 4),
        F.concat(F.lit("5"), F.substring(digest, 14, 3)),
        F.concat(variant, F.substring(digest, 18, 3)),
        F.substring(digest, 21, 12),
    )
