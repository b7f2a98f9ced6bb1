"""Numbers for the rows of a whole table in an order (W04, W05), without one task that sorts them all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def numbered(df: DataFrame, order: list[Column | str], name: str, first: int = 0) -> DataFrame:
    """``df`` with its rows' numbers in ``order``, counted from ``first``.

    Rows are sorted in ranges; a row's number is its place in its range after the sizes of the ranges before. The sorted
    rows are held, so that ranges do not change between the count and the use; the driver sees one number for each range.
    """
    place = F.monotonically_increasing_id()
    held = df.orderBy(*order).withColumn("_place", place).persist()
    part = F.shiftright("_place", 33)
    sizes = {r["part"]: r["n"] for r in held.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()}
    before, starts = first, {}
    for k in sorted(sizes):
        starts[k], before = before, before + sizes[k]
    if not starts:
        return held.withColumn(name, F.lit(first).cast("bigint")).drop("_place")
    start = F.get(F.array(*(F.lit(starts.get(k, 0)) for k in range(max(starts) + 1))), part.cast("int"))
    return held.withColumn(name, (start + F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))).cast("bigint")).drop("_place")
