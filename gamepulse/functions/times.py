"""Time keys. Times are `yyyy-MM-dd HH:mm:ss` strings; keys are prefixes of them."""

from datetime import date, datetime, time, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# English month names of the web access log, with its long form of September.
LOG_MONTHS = {
    "Jan": "01", "Feb": "02", "Mar": "03", "Apr": "04", "May": "05", "Jun": "06", "Jul": "07",
    "Aug": "08", "Sep": "09", "Sept": "09", "Oct": "10", "Nov": "11", "Dec": "12",
}
LOG_STAMP = r"\[([0-9]{2})/([A-Za-z]+)/([0-9]{4}):([0-9]{2})[^\]]*\]"


def as_date(d: date | str) -> date:
    return d if isinstance(d, date) else date.fromisoformat(d)


def prefix_before(c: Column | str, sep: str) -> Column:
    """Text before the first separator; null where the text is nothing but separators."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(~c.rlike(rf"^(?:{sep})+\z"), F.substring_index(c, sep, 1))


def hour_key(c: Column | str) -> Column:
    return F.substring_index(c, ":", 1)


def day_key(c: Column | str) -> Column:
    return F.substring_index(c, " ", 1)


def day_of(c: Column | str) -> Column:
    return F.try_to_date(c)


def access_log_hour(line: Column | str) -> Column:
    """`yyyy-MM-dd HH` of the bracketed access-log stamp in local log time; null if malformed."""
    part = lambda i: F.regexp_extract(line, LOG_STAMP, i)
    months = F.create_map(*[F.lit(x) for kv in LOG_MONTHS.items() for x in kv])
    day = F.concat_ws("-", part(3), F.try_element_at(months, part(2)), part(1))
    return F.when(F.try_to_date(day, "yyyy-MM-dd").isNotNull(), F.concat_ws(" ", day, part(4)))


def day_range(df: DataFrame, time_col: str, start: date | str | None, end: date | str | None) -> DataFrame:
    """Rows whose time lies on a day in [start, end]; either end may be open.

    The bounds are plain string comparisons because those reach the file scan, which a
    `to_date(time)` predicate does not. A table that also carries the time as a typed
    column `<time_col>_ts` gets the same bound on it, for sources where that one prunes.
    """
    text, typed = F.col(time_col), f"{time_col}_ts"
    keep = day_of(time_col).isNotNull()
    bounds = []
    if start is not None:
        bounds.append((">=", as_date(start)))
    if end is not None:
        bounds.append(("<", as_date(end) + timedelta(days=1)))
    for op, day in bounds:
        edge = F.lit(day.isoformat())
        keep = keep & ((text >= edge) if op == ">=" else (text < edge))
        if typed in df.columns:
            stamp = F.lit(datetime.combine(day, time()).isoformat(" ")).cast("timestamp_ntz")
            keep = keep & ((F.col(typed) >= stamp) if op == ">=" else (F.col(typed) < stamp))
    return df.filter(keep)
