"""Data profiling: counts, distinct values, comparisons, differences."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebook.functions import scalars as S


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """``(value, n)`` without nulls."""
    return df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))


def unique_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct stripped values, missing ones as empty text."""
    return df.select(S.strip(F.coalesce(F.col(column).cast("string"), F.lit(""))).alias("value")).distinct()


def unique_elements(df: DataFrame, column: str) -> DataFrame:
    """Distinct elements of a list text."""
    return df.select(F.explode(F.split(column, S.SEP)).alias("value")).distinct()


def describe_strings(df: DataFrame, columns: list[str]) -> DataFrame:
    """Per column: count, number of distinct values, the most frequent (of ties the smallest), and how often it comes.

    One pass: each row is unpivoted, values are counted first and the counts summed up, so no column's values meet in one task before they are counts.
    """
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])).alias("x")).select("x.*")
    counts = long.where("value is not null").groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    top = F.min_by("value", F.struct(-F.col("n"), F.col("value")))
    return counts.groupBy("column").agg(F.sum("n").alias("count"), F.count(F.lit(1)).alias("unique"), top.alias("top"), F.max("n").alias("freq"))


def compare(df: DataFrame, a: str, b: str, operator: str) -> DataFrame:
    """``(holds, n)``: how often ``a operator b`` is true; with a missing side it isn't."""
    return df.select(holds(a, b, operator).alias("holds")).groupBy("holds").agg(F.count(F.lit(1)).alias("n"))


def holds(a: str, b: str, operator: str):
    ops = {"==": lambda x, y: x == y, "<=": lambda x, y: x <= y, "<": lambda x, y: x < y}
    if operator not in ops:
        raise ValueError(f"operator must be one of {sorted(ops)}")
    return F.coalesce(ops[operator](F.col(a), F.col(b)), F.lit(False))


def counter_examples(df: DataFrame, a: str, b: str, operator: str, number: int = 5, order: list[str] | None = None) -> DataFrame:
    """The first rows in ``order`` with both sides present for which the comparison fails."""
    return df.where(~holds(a, b, operator) & F.col(a).isNotNull() & F.col(b).isNotNull()).orderBy(*(order or df.columns)).limit(number)


def differences(a: DataFrame, b: DataFrame) -> DataFrame:
    """Values of one column that only one side has: ``(side, value)``."""
    x, y = (d.toDF("value") for d in (a, b))
    return x.subtract(y).select(F.lit("left").alias("side"), "value").unionByName(y.subtract(x).select(F.lit("right").alias("side"), "value"))


def intersection(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.toDF("value").intersect(b.toDF("value"))


def counters(df: DataFrame, **conditions) -> DataFrame:
    """One row: how many rows meet each condition."""
    return df.agg(*[F.count(F.when(c, 1)).alias(n) for n, c in conditions.items()])


def timings(df: DataFrame, label: str, seconds: str) -> DataFrame:
    return df.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("runs"), F.avg(seconds).alias("average"), F.sum(seconds).alias("total"))


def all_of(conds):
    return reduce(lambda a, b: a & b, conds)
