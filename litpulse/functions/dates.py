"""Date expressions. The session time zone must be UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from litpulse.functions.once import let

# Accepted date formats.
MAIL_DATE = (
    r"(?i)^(?:mon|tue|wed|thu|fri|sat|sun),\s+(\d{1,2})\s+"
    r"(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)\s+(\d{4})\s+"
    r"(\d{1,2}):(\d{1,2}):(\d{1,2})\s+GMT$"
)
LENIENT_MAIL_DATE = (
    r"(?i)^\s*(?:[a-z]+\s*,?\s+)?(\d{1,2})[\s-]+"
    r"(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*[\s-]+(\d{4}|\d{2})\s+"
    r"([01]?\d|2[0-3])[:.]([0-5]?\d)(?:[:.]([0-5]?\d))?(?:\s.*)?$"
)
STRICT_ISO_DATE = r"^[0-9]{4}-(0[1-9]|1[0-2])-(0[1-9]|[12][0-9]|3[01])$"
# Marks text that a pattern has matched and rewritten, so that it is matched once.
MATCHED = "\x01"
ISO_DATE_PREFIX = r"^\d{4}-(0[1-9]|1[0-2])-(0[1-9]|[12]\d|3[01])"
ISO_TIMESTAMP = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?(Z|[+-]\d{2}:?\d{2})?)?$"


def parse_mail_timestamp(c: Column) -> Column:
    """``Mon, 2 Oct 2023 00:11:47 GMT`` as a UTC timestamp; anything else is null."""
    flat = F.regexp_replace(F.trim(c), MAIL_DATE, MATCHED + "$1 $2 $3 $4:$5:$6")
    return let(
        flat,
        lambda t: F.when(
            F.startswith(t, F.lit(MATCHED)),
            F.try_to_timestamp(F.substring(t, 2, 40), F.lit("d MMM yyyy H:m:s")),
        ),
    )


def parse_lenient_mail_date(c: Column) -> Column:
    """The date as written in a mail-style stamp, whatever its offset, as ``yyyy-MM-dd``.

    Weekday and seconds may be absent, month names may be long, years of two
    digits are read as 1969 to 2068.
    """

    def written_date(t: Column) -> Column:
        year = F.substring_index(t, " ", -1)
        full_year = (
            F.when(F.length(year) == 4, year)
            .when(year < "69", F.concat(F.lit("20"), year))
            .otherwise(F.concat(F.lit("19"), year))
        )
        day_month = F.substring(F.substring_index(t, " ", 2), 2, 10)
        parsed = F.try_to_date(F.concat_ws(" ", day_month, full_year), "d MMM yyyy")
        return F.when(F.startswith(t, F.lit(MATCHED)), F.date_format(parsed, "yyyy-MM-dd"))

    return let(F.regexp_replace(c, LENIENT_MAIL_DATE, MATCHED + "$1 $2 $3"), written_date)


def iso_date(c: Column) -> Column:
    """The written date of ISO text; time and offset are dropped, bad text is null."""
    return F.try_to_date(F.substring(c, 1, 10), "yyyy-MM-dd")


def iso_timestamp_date(c: Column) -> Column:
    """The written date of a complete ISO time stamp; null where date or time is impossible."""
    return F.when(c.rlike(ISO_TIMESTAMP) & F.try_to_timestamp(c).isNotNull(), iso_date(c))


def iso_instant(c: Column) -> Column:
    """A complete ISO time stamp as a UTC instant, null when it does not parse."""
    return F.try_to_timestamp(c)


def strict_iso_date(c: Column) -> Column:
    """A date only when the first ten characters are exactly ``YYYY-MM-DD``."""
    head = F.substring(c, 1, 10)
    return F.when(head.rlike(STRICT_ISO_DATE), F.try_to_date(head, "yyyy-MM-dd"))


def epoch_date(c: Column) -> Column:
    """Epoch seconds, as number or text, to a UTC date; bad text is null."""
    return F.to_date(F.timestamp_seconds(c.try_cast("bigint")))


def months_back(c: Column, months: int) -> Column:
    """First day of a window of ``months`` that ends on ``c``; month ends are clamped."""
    return F.date_add(F.add_months(c, -months), 1)


def year_start(c: Column) -> Column:
    return F.trunc(c, "year")


def date_text(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd")


def iso_utc_text(c: Column) -> Column:
    """A UTC timestamp as ISO text with offset, the stored form of a publication date."""
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'+00:00'")
