"""Arrow UDFs that can be declared before a session exists."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def arrow_udf(returns: str) -> Callable:
    """Like ``pandas_udf`` with a DDL type, which is parsed when the function is first applied to columns."""

    def declare(function: Callable) -> Callable[..., Column]:
        @functools.wraps(function)
        def apply(*columns) -> Column:
            return F.pandas_udf(function, returns)(*columns)

        return apply

    return declare
