"""Exact quantiles by narrowing histograms.

A pass counts the rows of some thousand equal intervals, and the next one looks only into the interval that holds the wanted
rank, so a few aggregates of fixed size find the value whatever the number of rows and of distinct values; the driver sees
one interval a pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Intervals of a pass.
BINS = 4096
#: Rows that are few enough to be sorted.
FEW_ROWS = 4096


def exact_quantile(rows: DataFrame, column: str, q: float = 0.5) -> float | None:
    """The ``q``-quantile of ``column``, between the two nearest rows in proportion; null if no row has a value.

    Nulls are left out. Minus infinity counts as the least value, infinity and then NaN as the largest ones.
    """
    value = F.col(column).cast("double")
    finite = ~F.isnan(value) & (F.abs(value) != float("inf"))
    found = rows.agg(
        F.count(value).alias("n"), F.count_if(value == float("-inf")).alias("least"), F.count_if(finite).alias("finite"),
        F.count_if((value == float("inf")) & ~F.isnan(value)).alias("largest"), F.min(F.when(finite, value)).alias("low"), F.max(F.when(finite, value)).alias("high"),
    ).first()
    if not found["n"]:
        return None
    place = q * (found["n"] - 1)
    rank = int(place)

    def at(wanted: int) -> float:
        if wanted < found["least"]:
            return float("-inf")
        if wanted < found["least"] + found["finite"]:
            return _of_rank(rows.select(value.alias("x")).filter(finite), wanted - found["least"], found["finite"], found["low"], found["high"])
        return float("inf") if wanted < found["least"] + found["finite"] + found["largest"] else float("nan")

    lower = at(rank)
    if place == rank:
        return lower
    upper = at(rank + 1)
    return lower if lower == upper else lower + (place - rank) * (upper - lower)


def _of_rank(values: DataFrame, rank: int, n: int, low: float, high: float) -> float:
    """The value of ``rank`` (from 0) among ``n`` finite ``x`` between ``low`` and ``high``."""
    while low != high:
        if n <= FEW_ROWS:
            place = Window.orderBy("x")
            few = values.filter(F.col("x").between(low, high)).withColumn("place", F.row_number().over(place))
            return few.filter(F.col("place") == rank + 1).first()["x"]
        # Halves, so that the width of the widest range is a number.
        share = (F.col("x") / 2 - low / 2) / (high / 2 - low / 2)
        number = F.least(F.floor(share * BINS), F.lit(BINS - 1))
        counted = values.filter(F.col("x").between(low, high)).groupBy(number.alias("bin")).agg(
            F.count(F.lit(1)).alias("n"), F.min("x").alias("low"), F.max("x").alias("high")
        )
        upto = F.sum("n").over(Window.orderBy("bin"))
        holding = counted.withColumn("upto", upto).filter(F.col("upto") > rank).orderBy("bin").first()
        rank -= holding["upto"] - holding["n"]
        n, low, high = holding["n"], holding["low"], holding["high"]
    return low


def quantile_row(rows: DataFrame, column: str, name: str, q: float = 0.5) -> DataFrame:
    """``name, value`` of a quantile."""
    return rows.sparkSession.createDataFrame([(name, exact_quantile(rows, column, q))], "name string, value double")

