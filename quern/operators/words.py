"""Word operators."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.session import BROADCAST_BYTES
from quern.sources.readers import as_word_list, word_frame

Words = DataFrame | Iterable[str]


def explode_words(df: DataFrame, words: Column, *keep: str) -> DataFrame:
    """One row per word, the empty one left out: `keep…, word`.

    The coalesce keeps Spark from testing the array's size in a filter below, which would compute a
    tokenised column once more for every test.
    """
    none = F.array().cast("array<string>")
    return df.select(*keep, F.explode(F.coalesce(words, none)).alias("word")).where(F.col("word") != "")


def drop_stop_words(words: DataFrame, stops: Words, column: str = "word") -> DataFrame:
    """Rows whose word is not in the list, compared exactly and by case.

    A list within the word-list limit is broadcast if its words are short enough; any other is joined as Catalyst sees fit.
    """
    stops = stops if isinstance(stops, DataFrame) else list(stops)
    found = as_word_list(stops)
    if found is None:
        listed = word_frame(words.sparkSession, stops, column)
    elif not found:
        return words
    else:
        listed = words.sparkSession.createDataFrame([(s,) for s in found], f"{column} string")
        if sum(len(s.encode()) for s in found) <= BROADCAST_BYTES:
            listed = F.broadcast(listed)
    return words.join(listed, column, "left_anti")


def count_words(words: DataFrame, *keys: str, column: str = "word") -> DataFrame:
    """`keys…, word, cnt`; Spark combines per task before the shuffle, so hot words stay cheap."""
    return words.groupBy(*keys, column).agg(F.count(F.lit(1)).alias("cnt"))


def corpus_counts(words: DataFrame, stops: Words | None = None) -> DataFrame:
    """Word counts of one corpus without its stop words: `word, cnt` (A2)."""
    return count_words(words if stops is None else drop_stop_words(words, stops))


def common_words(left: DataFrame, right: DataFrame) -> DataFrame:
    """Words counted on both sides with the smaller count: `cnt, word`."""
    pair = left.withColumnRenamed("cnt", "left_cnt").join(right.withColumnRenamed("cnt", "right_cnt"), "word")
    return pair.select(F.least("left_cnt", "right_cnt").alias("cnt"), "word")


def common_words_of(left: DataFrame, right: DataFrame) -> DataFrame:
    """`common_words` straight from two word streams.

    Both corpora are counted in one aggregation, so there is a single shuffle and no join.
    """
    both = left.select("word", F.lit(1).alias("in_left"), F.lit(0).alias("in_right")).unionByName(
        right.select("word", F.lit(0).alias("in_left"), F.lit(1).alias("in_right"))
    )
    counts = both.groupBy("word").agg(F.sum("in_left").alias("left_cnt"), F.sum("in_right").alias("right_cnt"))
    return counts.where("left_cnt > 0 and right_cnt > 0").select(
        F.least("left_cnt", "right_cnt").alias("cnt"), "word"
    )


def top_k(counts: DataFrame, k: int = 20, count: str = "cnt", word: str = "word") -> DataFrame:
    """The `k` highest counts; equal counts in word order."""
    return counts.orderBy(F.desc(count), F.asc(word)).limit(k)


def top_n_per_group(
    counts: DataFrame, group: str, n: int = 5, count: str = "cnt", word: str = "word"
) -> DataFrame:
    """The `n` highest counts of each group with their `rank`.

    The rank filter lets Spark cut every group to `n` rows before the shuffle, so a group holding
    most rows is not gathered in one task.
    """
    by_count = Window.partitionBy(group).orderBy(F.desc(count), F.asc(word))
    return counts.withColumn("rank", F.row_number().over(by_count)).where(F.col("rank") <= n)
