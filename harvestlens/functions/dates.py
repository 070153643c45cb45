"""Date expressions. A date's id is its day number since 1970-01-01."""

from pyspark.sql import Column
from pyspark.sql import functions as F

_DAY_FIRST = r"^(\d{1,2})-(\d{1,2})-(\d{4})\z"
_TEN_DAY_FIRST = r"^\d\d[-/]\d\d[-/]\d{4}\z"
_YEAR_FIRST = r"^\d{4}-\d{1,2}-\d{1,2}\z"
_TIME = r"[ T]\d{1,2}:\d{2}(:\d{2}(\.\d+)?)?Z?$"


def parse_day_first(text: Column) -> Column:
    """Day-first text (or year-first, as ISO dates are) as a date; NULL where neither fits.

    A time of day behind the date is left out. Day-first text is put year first, which a cast reads faster than a
    pattern parses; the usual ten characters are taken apart by place. 31/02/2025 has a layout but is no date, so it is NULL as well.
    """
    turned = F.concat_ws("-", text.substr(7, 4), text.substr(4, 2), text.substr(1, 2))
    dashed = F.regexp_replace(F.replace(F.trim(text), F.lit("/"), F.lit("-")), _TIME, "")
    year_first = F.regexp_replace(dashed, _DAY_FIRST, "$3-$2-$1")
    other = F.when(year_first.rlike(_YEAR_FIRST), year_first.try_cast("date"))
    return F.when(text.rlike(_TEN_DAY_FIRST), turned.try_cast("date")).otherwise(other)


def date_id(day: Column) -> Column:
    return F.unix_date(day)


def weekday_number(day: Column) -> Column:
    """Monday 0 ... Sunday 6."""
    return F.weekday(day)


def weekday_name(day: Column) -> Column:
    return F.date_format(day, "EEEE")


def short_date(day: Column) -> Column:
    return F.date_format(day, "MMM dd")
