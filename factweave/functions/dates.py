"""Date normaliser (F08) and mixed date formats (F25), natively.

A value's shape is rewritten as year-month-day (``REWRITES``), which is then parsed
once. Of the shapes that two forms fit, such as day first and month first, the form
that is tried first wins if it gives a date.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from factweave.functions.numbers import result
from factweave.functions.text import bound, col, strip

FAR_PAST = dt.date(1799, 12, 31)
FUTURE_YEARS = 50

_Y, _M, _D = "([0-9]{4})", "([0-9]{1,2})", "([0-9]{1,2})"
_MONTHS = "january february march april may june july august september october november december".split()
_LONG, _SHORT = "|".join(_MONTHS), "|".join(m[:3] for m in _MONTHS)
_TIME = "(?:2[0-3]|[01]?[0-9]):[0-5]?[0-9]:[0-5]?[0-9]"
_MINUTES = "(?:2[0-3]|[01]?[0-9]):[0-5]?[0-9]"
_OFFSET = "(?:z|[+-][0-9]{2}:?[0-5][0-9](?::?[0-5][0-9](?:[.][0-9]{1,6})?)?)"
#: Of a time with T: seconds alone or with z, or a fraction of any length with or without an offset.
_ISO_TIME = f"t{_TIME}(?:z|[.][0-9]+{_OFFSET}?)?"

#: Stands before a year that may have two digits.
_SHORT_YEAR = "\x01"
#: Shapes of values in lower case, and how they read as year-month-day.
REWRITES = (
    (f"{_Y}-{_M}-{_D} {_TIME}", "$1-$2-$3"),
    (f"{_Y}([/-]){_M}\\2{_D}{_ISO_TIME}", "$1-$3-$4"),
    (f"{_Y}/{_M}/{_D}(?: +{_MINUTES}| +{_TIME}(?:{_OFFSET}|[+]00)?)?", "$1-$2-$3"),
    (f"{_D}/{_M}/{_Y}(?: +(?:{_MINUTES}|{_TIME}))?", "$3-$2-$1"),
    (f"{_D}([.-]){_M}\\2{_Y}", "$4-$3-$1"),
    (f"{_D}([./-]){_M}\\2([0-9]{{2}})", f"{_SHORT_YEAR}$4-$3-$1"),
    (f"{_Y}([ .]){_M}\\2{_D}", "$1-$3-$4"),
    (f"{_Y}[-./ ](0?[1-9]|1[0-2])", "$1-$2-1"),
    (f"{_Y}(?:[.]0)?", "$1-1-1"),
    (f"{_D}-({_SHORT})-([0-9]{{4}}|[0-9]{{2}})", f"{_SHORT_YEAR}$3-$2-$1"),
    (f"{_D} +({_LONG}) +{_Y}", "$3-$2-$1"),
    (f"(?:mon|tue|wed|thu|fri|sat|sun), +{_D} +({_SHORT}) +{_Y} +{_TIME} +(?:utc|gmt)", "$3-$2-$1"),
    (f"({_SHORT}) +{_D}, +([0-9]{{4}}|[0-9]{{2}})", f"{_SHORT_YEAR}$3-$1-$2"),
    (f"({_SHORT})-([0-9]{{2}})", f"{_SHORT_YEAR}$2-$1-1"),
    (f"({_LONG}) +{_Y}", "$2-$1-1"),
    ("([0-9]{4})([0-9]{2})([0-9]{2})(?:(?:2[0-3]|[01][0-9])[0-5][0-9][0-5][0-9])?", "$1-$2-$3"),
    (f"{_SHORT_YEAR}(69|[7-9][0-9])-(.*)", "19$1-$2"),
    (f"{_SHORT_YEAR}([0-9]{{2}})-(.*)", "20$1-$2"),
    (f"{_SHORT_YEAR}(.*)", "$1"),
)
#: The shapes that are read another way if the first gives no date.
ELSE = ((f"{_Y}-{_M}-{_D}", "$1-$3-$2"), (f"{_D}/{_M}/{_Y}", "$3-$1-$2"))
#: Seconds or milliseconds since 1970: by the digits before the point, at least so many and at most.
EPOCH_DIGITS, MILLISECOND_DIGITS = (9, 13), 11
#: Ten digits or fewer are seconds if they give a day between these years, else milliseconds.
EPOCH_YEARS = (1800, 2100)


def _rewritten(value: Column, rewrites) -> Column:
    for pattern, reads in rewrites:
        value = F.regexp_replace(value, f"^{pattern}$", reads)
    return value


def _epoch(value: Column) -> Column:
    whole = F.length(F.regexp_extract(value, "^[+-]?([0-9]+)", 1))
    number = value.try_cast("double")
    days = F.floor(number / 86400).cast("int")
    low, high = ((dt.date(y, 1, 1) - dt.date(1970, 1, 1)).days for y in EPOCH_YEARS)
    seconds = (whole < MILLISECOND_DIGITS) & (number >= low * 86400) & (number <= high * 86400)
    days = F.when(seconds, days).otherwise(F.floor(number / 86_400_000).cast("int"))
    return F.when(value.rlike("^[+-]?[0-9]+([.][0-9]+)?$") & whole.between(*EPOCH_DIGITS), F.date_add(F.lit(dt.date(1970, 1, 1)), days))


def parse_date(c: Column | str) -> Column:
    """The date in a text, or null; quotes and commas around it do not count."""
    value = F.regexp_replace(strip(c), '^[",]+|[",]+$', "")
    # Nearly all values of a clean table are plain ISO dates.
    plain = lambda v: F.when(v.rlike("^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"), F.try_to_date(v, "yyyy-M-d"))

    def shaped(low: Column) -> Column:
        first = _rewritten(low, REWRITES)
        for n, month in enumerate(_MONTHS, 1):
            for name in sorted({month, month[:3]}):
                first = F.replace(first, F.lit(f"-{name}-"), F.lit(f"-{n}-"))
        return F.coalesce(F.try_to_date(first, "yyyy-M-d"), F.try_to_date(_rewritten(low, ELSE), "yyyy-M-d"))

    low = lambda v: F.regexp_replace(F.lower(v), "[\\t\\n\\r]", " ")
    return bound(value, lambda v: F.coalesce(plain(v), bound(low(v), shaped), _epoch(v)))


def far_future(today: Column | None = None) -> Column:
    return F.add_months(F.current_date() if today is None else today, 12 * FUTURE_YEARS)


def normalise_date(c: Column | str, today: Column | None = None, far_past: dt.date | None = FAR_PAST, check_future: bool = True) -> Column:
    """an ISO date, or '' with the issue ``far-past-date``, ``far-future-date`` or ``invalid date``."""
    original = col(c)

    def judged(date: Column) -> Column:
        issue = F.when(date.isNull(), "invalid date")
        if far_past:
            issue = issue.when(date < F.lit(far_past), "far-past-date")
        if check_future:
            issue = issue.when(date > far_future(today), "far-future-date")
        return result(F.when(issue.isNull(), date.cast("string")).otherwise(""), issue, F.when(issue.isNotNull(), original))

    return bound(parse_date(original), judged)


#: Forms of register dates (fixed values), as Spark writes them.
REGISTER_FORMS = ("yyyy-MM-dd'T'HH:mm:ss'Z'", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd", "dd/MM/yyyy")


def register_date(c: Column | str) -> Column:
    """the ISO date of a register entry in one of several forms, or ''."""
    value = strip(c)
    tries = [F.try_to_timestamp(value, F.lit(f)).cast("date") for f in REGISTER_FORMS]
    return F.coalesce(F.coalesce(*tries).cast("string"), F.lit(""))
