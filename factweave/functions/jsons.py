"""JSON columns."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from factweave.functions.arrow import arrow_udf
from factweave.functions.text import col


def overflow(fields: dict[str, Column]) -> Column:
    """a JSON object of the non-null values, keys in order; null where there are none."""
    items = [v.alias(k) for k, v in sorted(fields.items())]
    return F.nullif(F.to_json(F.struct(*items)), F.lit("{}")) if items else F.lit(None).cast("string")


def value_of(c: Column | str, key: str) -> Column:
    """a top-level value of a JSON object as text; the key may hold hyphens."""
    return F.get_json_object(col(c), "$['" + key.replace("'", "\\'") + "']")


def is_blank(c: Column | str, key: str) -> Column:
    """whether a key is missing from a JSON object, or its value blank."""
    return F.trim(F.coalesce(value_of(c, key), F.lit(""))) == ""


def as_map(c: Column | str) -> Column:
    return F.coalesce(F.from_json(col(c), "map<string,string>"), F.create_map().cast("map<string,string>"))


def flattened(c: Column | str, keys: list[str]) -> list[Column]:
    """the values of ``keys`` of a JSON object, as kebab-case columns ('' where missing)."""
    values = as_map(c)
    return [F.coalesce(F.try_element_at(values, F.lit(k)), F.lit("")).alias(k.replace("_", "-")) for k in keys]


@arrow_udf("string")
def canonical(values: pd.Series) -> pd.Series:
    """a JSON text with sorted keys; other texts stay as they are."""

    def one(text):
        try:
            return json.dumps(json.loads(text), sort_keys=True)
        except (TypeError, ValueError):
            return text

    return values.map(one, na_action="ignore")
