"""Whole orders, ranks and running sums over any number of rows, without a window that gathers them in one task.

Rows are dealt into ranges of the order and sorted in each; what the ranges
before hold is summed over a table of one row per range and broadcast back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rinkline.sources.storage import new_path

_ID, _PART, _AT, _KEY, _NEW = "_rinkline_id", "_rinkline_part", "_rinkline_at", "_rinkline_key", "_rinkline_new"


def laid_out(df: DataFrame, order: list[Column]) -> DataFrame:
    """df in range partitions of the order, stored, with the number of each row's range and its place there.

    Rows of equal order share a range, so give the order a last key that tells them apart.
    """
    spark = df.sparkSession
    path = new_path(spark, "ordered")
    df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(_ID, F.monotonically_increasing_id()).write.parquet(path)
    rows = spark.read.parquet(path)
    return rows.select(*df.columns, F.shiftright(_ID, 33).cast("int").alias(_PART), F.col(_ID).bitwiseAND(F.lit((1 << 33) - 1)).alias(_AT))


def _before(per_range: DataFrame, keys: list[str], value: Column) -> Column:
    """value, an aggregation, over the ranges before; per_range has a row or two for each range, so one task holds them."""
    return value.over(Window.partitionBy(*keys).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1))


def row_numbers(df: DataFrame, order: list[Column], name: str = "row_number") -> DataFrame:
    """df with the number of each row in the whole order, from 1: one shuffle, one row per range to the driver's broadcast.

    Equal rows are numbered in any order; null keys stand where the order puts them; an empty table stays empty.
    """
    rows = laid_out(df, order)
    sizes = rows.groupBy(_PART).agg(F.count(F.lit(1)).alias("n"))
    begins = sizes.select(_PART, F.coalesce(_before(sizes, [], F.sum("n")), F.lit(0)).alias("n"))
    numbered = rows.join(F.broadcast(begins), _PART)
    return numbered.select(*df.columns, (F.col("n") + F.col(_AT) + 1).alias(name))


#: What running() can take, and how two partial results combine.
_TOGETHER = {"sum": lambda a, b: a + b, "max": F.greatest, "min": F.least}


def running(df: DataFrame, keys: list[str], order: list[Column], values: dict[str, tuple[str, Column]]) -> DataFrame:
    """df with running values: for each name (kind, column) the sum, max or min of the column over the rows of the same keys up to this one, in order.

    Like a window over keys, but a key with a third of all rows lies in many
    ranges, each a task; nulls don't count, null keys are keys.  The order,
    within a key, must tell rows apart.
    """
    rows = laid_out(df.withColumns({f"{_NEW}_{n}": column for n, (_, column) in values.items()}), [*(F.col(k).asc() for k in keys), *order])
    rows = rows.withColumn(_KEY, F.struct(*(F.col(k) for k in keys)) if keys else F.struct(F.lit(0).alias("all")))
    whole = {n: getattr(F, kind)(f"{_NEW}_{n}") for n, (kind, _) in values.items()}
    # what a range adds to its last key goes on to the ranges that begin with that key
    ends = rows.groupBy(_PART).agg(F.min_by(_KEY, _AT).alias("first"), F.max_by(_KEY, _AT).alias("last"))
    parts = rows.groupBy(_PART, _KEY).agg(*(c.alias(n) for n, c in whole.items())).join(F.broadcast(ends), _PART)
    edges = parts.where((F.col(_KEY) == F.col("first")) | (F.col(_KEY) == F.col("last")))
    carried = edges.withColumns({n: _before(edges, [_KEY], getattr(F, kind)(n)) for n, (kind, _) in values.items()}).where(F.col(_KEY) == F.col("first"))
    carried = carried.select(_PART, F.col(_KEY).alias("first"), *(F.col(n).alias(f"{_NEW}_{n}_before") for n in values))
    local = Window.partitionBy(_PART, _KEY).orderBy(_AT).rowsBetween(Window.unboundedPreceding, 0)
    here = rows.withColumns({n: getattr(F, kind)(f"{_NEW}_{n}").over(local) for n, (kind, _) in values.items()}).join(F.broadcast(carried), _PART)

    def total(n: str, kind: str) -> Column:
        before = F.when(F.col(_KEY) == F.col("first"), F.col(f"{_NEW}_{n}_before"))
        return F.coalesce(_TOGETHER[kind](F.col(n), before), F.col(n), before).alias(n)

    kept = [c for c in df.columns if c not in values]
    return here.select(*kept, *(total(n, kind) for n, (kind, _) in values.items()))


def ranks(df: DataFrame, keys: list[str], order: list[Column], name: str = "rank") -> DataFrame:
    """df with rank(): rows with equal keys share the smallest of their numbers in the order, which begins with the keys in any direction and tells all rows apart."""
    number = f"{_NEW}_number"
    return running(row_numbers(df, order, number), keys, [F.col(number)], {name: ("min", F.col(number))}).drop(number)


def islands(df: DataFrame, keys: list[str], value: str, order: list[Column], name: str = "island") -> DataFrame:
    """df with a number that rows of equal keys and value share where nothing else stands between them in the order.

    It is the row's number within its keys less that within keys and value; a
    hot key or value lies in many ranges.  Null values are a value.
    """
    one = ("sum", F.lit(1).cast("long"))
    numbered = running(df, keys, order, {f"{_NEW}_all": one})
    return running(numbered, [*keys, value], order, {f"{_NEW}_own": one}).withColumn(name, F.col(f"{_NEW}_all") - F.col(f"{_NEW}_own")).drop(f"{_NEW}_all", f"{_NEW}_own")
