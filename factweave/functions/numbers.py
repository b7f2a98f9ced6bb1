"""Number normalisers (F03, F04, F05, K12): every result is ``struct<value, issue, issue_value>``.

Integers are handled as digit strings, so their size is not bounded; decimals by
DECIMAL(38,18), so values need at most 20 digits before and 18 after the point.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from factweave.functions.arrow import arrow_udf
from factweave.functions.text import col, strip

INTEGER = r"^[+-]?[0-9]+(_[0-9]+)*$"
DECIMAL = r"^[+-]?([0-9]+(_[0-9]+)*\.?([0-9]+(_[0-9]+)*)?|\.[0-9]+(_[0-9]+)*)([eE][+-]?[0-9]+)?$"


def result(value: Column, issue: Column | None = None, issue_value: Column | None = None) -> Column:
    none = F.lit(None).cast("string")
    return F.struct(value.alias("value"), (none if issue is None else issue).alias("issue"), (none if issue_value is None else issue_value).alias("issue_value"))


def normalise_integer(c: Column | str, minimum: int | None = 0, maximum: int | None = None) -> Column:
    """one trailing ``.0`` is dropped; plain digits without leading zeros come out."""
    value = F.regexp_replace(col(c), r"\.0+$", "")
    bare = F.translate(strip(value), "_", "")
    digits = F.regexp_extract(bare, "^[+-]?0*([0-9]*)$", 1)
    digits = F.when(digits == "", "0").otherwise(digits)
    plain = F.when(bare.startswith("-") & (digits != "0"), F.concat(F.lit("-"), digits)).otherwise(digits)
    number = plain.try_cast("decimal(38,0)")
    ok = strip(value).rlike(INTEGER)
    issue = F.when(~ok, "invalid integer")
    if minimum is not None:
        low = (number < F.lit(minimum)) | (number.isNull() & plain.startswith("-"))
        issue = issue.when(low, "too small")
    if maximum is not None:
        high = (number > F.lit(maximum)) | (number.isNull() & ~plain.startswith("-"))
        issue = issue.when(high, "too large")
    return result(F.when(issue.isNull(), plain).otherwise(""), issue, F.when(issue.isNotNull(), value))


def plain_decimal(number: Column, precision: int = 6) -> Column:
    """A decimal as text: rounded half to even, without exponent or trailing zeros."""
    text = F.bround(number, precision).cast("string")
    text = F.when(text.contains("."), F.rtrim(F.rtrim(text, F.lit("0")), F.lit("."))).otherwise(text)
    return F.when(text == "-0", "0").otherwise(text)


def normalise_decimal(c: Column | str, precision: int = 6, minimum: float | None = 0.0, maximum: float | None = None, drop: str = ",£") -> Column:
    """thousands commas and pound signs are dropped."""
    value = F.translate(col(c), drop, "")
    bare = strip(value)
    number = F.when(bare.rlike(DECIMAL), F.translate(bare, "_", "").try_cast("decimal(38,18)"))
    issue = F.when(number.isNull(), "invalid decimal")
    if minimum is not None:
        issue = issue.when(number < F.lit(str(minimum)).cast("decimal(38,18)"), "too small")
    if maximum is not None:
        issue = issue.when(number > F.lit(str(maximum)).cast("decimal(38,18)"), "too large")
    return result(F.when(issue.isNull(), plain_decimal(number, precision)).otherwise(""), issue, F.when(issue.isNotNull(), value))


def normalise_coordinate(c: Column | str) -> Column:
    """latitude or longitude; as decimals, but of either sign and without pound signs."""
    return normalise_decimal(c, minimum=None, drop=",")


@arrow_udf("string")
def _printed(values: pd.Series, places: pd.Series) -> pd.Series:
    return pd.Series([f"{v:.{n}f}" for v, n in zip(values, places)], dtype=object)


def printed(c: Column | str, places: int) -> Column:
    """A double as C prints it: its exact value with so many places, ties to even, and the sign of zero. Spark's own functions round its shortest text."""
    return F.when(col(c).isNotNull(), _printed(col(c).cast("double"), F.lit(places)))


def whole_number(c: Column | str) -> Column:
    """A value as a whole number, cut towards zero; null where blank."""
    return F.nullif(strip(c), F.lit("")).try_cast("decimal(38,18)").cast("bigint")
