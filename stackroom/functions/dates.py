"""Years out of free-text dates, decades, caption times."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

YEAR = r"(?U)\b(?:18|19|20)\d{2}\b"


def metadata_year(*dates: Column) -> Column:
    """First plausible year over the date lists, in list order; null entries and lists are skipped."""
    values = F.concat(*[F.coalesce(d, F.array().cast("array<string>")) for d in dates])
    found = F.transform(values, lambda v: F.regexp_extract(F.coalesce(v, F.lit("")), YEAR, 0))
    years = F.filter(found, lambda y: y != "")
    return F.try_element_at(years, F.lit(1)).try_cast("int")


def year_from_digits(text: Column) -> Column:
    """First four digits of a text as a number, wherever they stand."""
    return F.substring(F.regexp_replace(text, "[^0-9]", ""), 1, 4).try_cast("bigint")


def decade(year: Column) -> Column:
    return F.concat((F.floor(year / 10) * 10).cast("string"), F.lit("s"))


def caption_time(seconds: Column, separator: str = ",") -> Column:
    """``HH:MM:SS,mmm`` with half-even rounding to milliseconds; negative times become zero."""
    millis = F.greatest(F.lit(0), F.rint(seconds * 1000)).cast("bigint")
    whole = F.floor(millis / 1000).cast("bigint")
    return F.format_string(
        f"%02d:%02d:%02d{separator}%03d",
        F.floor(whole / 3600).cast("bigint"),
        (F.floor(whole / 60) % 60).cast("bigint"),
        (whole % 60).cast("bigint"),
        (millis % 1000).cast("bigint"),
    )
