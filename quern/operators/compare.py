"""Comparison of results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TRIPLE = ("user_id", "item_id", "score")


def result_diff(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Rows by which two bags differ: `side, …, copies`.

    One signed count over both inputs instead of two set differences, so each is read once.
    """
    columns = expected.columns
    signed = expected.withColumn("sign", F.lit(1)).unionByName(actual.select(columns).withColumn("sign", F.lit(-1)))
    balance = signed.groupBy(columns).agg(F.sum("sign").alias("balance")).where("balance <> 0")
    side = F.when(F.col("balance") > 0, "expected only").otherwise("actual only")
    return balance.select(side.alias("side"), *columns, F.abs("balance").alias("copies"))


def result_verdict(expected: DataFrame, actual: DataFrame) -> str:
    """'same', 'swapped' (user and item exchanged) or 'different' for score results."""
    expected, actual = expected.select(*TRIPLE), actual.select(*TRIPLE)
    if result_diff(expected, actual).isEmpty():
        return "same"
    swapped = actual.select(F.col("item_id").alias("user_id"), F.col("user_id").alias("item_id"), "score")
    return "swapped" if result_diff(expected, swapped).isEmpty() else "different"


def top_k_diff(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Per count, whether two top-K results agree up to ties: `cnt, expected, actual, shared, status`.

    Every count must have the same words, except that the lowest expected count, where the list was
    cut, needs only words of the expected ones.
    """
    marked = expected.select("cnt", "word", F.lit(1).alias("e"), F.lit(0).alias("a")).unionByName(
        actual.select("cnt", "word", F.lit(0).alias("e"), F.lit(1).alias("a"))
    )
    words = marked.groupBy("cnt", "word").agg(F.max("e").alias("e"), F.max("a").alias("a"))
    groups = words.groupBy("cnt").agg(
        F.sum("e").alias("expected"), F.sum("a").alias("actual"), F.sum(F.col("e") * F.col("a")).alias("shared")
    )
    lowest = expected.agg(F.min("cnt")).scalar()
    status = (
        F.when(F.col("expected") == 0, "unexpected count")
        .when(F.col("actual") == 0, "missing count")
        .when((F.col("cnt") == lowest) & (F.col("shared") == F.col("actual")), "ok")
        .when(F.col("cnt") == lowest, "not a subset")
        .when((F.col("shared") == F.col("expected")) & (F.col("shared") == F.col("actual")), "ok")
        .otherwise("words differ")
    )
    return groups.select("cnt", "expected", "actual", "shared", status.alias("status"))


def order_breaks(ranked: DataFrame, position: str = "rank") -> DataFrame:
    """Positions whose count is higher than the one before: `position, cnt, previous`."""
    before = ranked.select((F.col(position) + 1).alias(position), F.col("cnt").alias("previous"))
    return ranked.select(position, "cnt").join(before, position).where("cnt > previous")


def top_k_verdict(expected: DataFrame, ranked: DataFrame, position: str = "rank") -> str:
    """'passed', 'wrong order', 'too long' or 'wrong words' for a ranked top-K result."""
    if not order_breaks(ranked, position).isEmpty():
        return "wrong order"
    found = {r["status"] for r in top_k_diff(expected, ranked).select("status").distinct().collect()} - {"ok"}
    if not found:
        return "passed"
    return "too long" if found == {"unexpected count"} else "wrong words"
