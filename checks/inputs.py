"""The given tables seen as the inputs of the five analyses."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.session import fill_cores
from quern.sources.readers import lines_of

# A short stop list, and the known topics; 5-LOW is left out so that one is unknown.
STOP_WORDS = (
    "the of and to a in is that for it was on are as with his they at be this have from or one had by"
).split()
PRIORITY_TOPICS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED"]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def spread_table(spark: SparkSession, sf: str, name: str, *columns: str, where: str = "true") -> DataFrame:
    """Columns of a table dealt over all cores when its file has fewer splits than that."""
    return fill_cores(table(spark, sf, name).where(where).select(*columns))


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return spread_table(spark, sf, "documents", "text")


def benchmark(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "benchmark").select("text")


def ratings(spark: SparkSession, sf: str) -> DataFrame:
    """Customers rate brand-and-type items in half points."""
    bought = spread_table(spark, sf, "lineitem", "l_orderkey", "l_partkey", "l_quantity")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    part = table(spark, sf, "part").select("p_partkey", "p_brand", "p_type")
    return (
        bought.join(orders, bought.l_orderkey == orders.o_orderkey)
        .join(part, bought.l_partkey == part.p_partkey)
        .groupBy("o_custkey", F.concat_ws("|", "p_brand", "p_type").alias("item_id"))
        .agg(F.max((F.col("l_quantity") % 10) / 2).alias("rating"))
        .select(F.col("o_custkey").cast("string").alias("user_id"), "item_id", "rating")
    )


def posting_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as question lines, line items as answer lines."""
    asked = spread_table(spark, sf, "orders", "o_orderkey", "o_orderpriority").select(
        F.concat_ws(
            ",", F.lit("1"), "o_orderkey", F.lit(""), (F.col("o_orderkey") % 20 - 3).cast("string"), "o_orderpriority"
        ).alias("value")
    )
    given = spread_table(spark, sf, "lineitem", "l_orderkey", "l_linenumber", "l_quantity").select(
        F.concat_ws(
            ",",
            F.lit("2"),
            F.col("l_orderkey") * 10 + F.col("l_linenumber"),
            "l_orderkey",
            F.col("l_quantity").cast("int") - 6,
            F.lit(""),
        ).alias("value")
    )
    return asked.unionByName(given)


def short_text_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Every line of every document as a six-field line: `doc_id, lang, value`."""
    whole = spread_table(spark, sf, "documents", "doc_id", "lang", "text")
    lines = lines_of(whole, "text", "doc_id", "lang")
    head = F.concat(F.lit('"0","'), F.col("doc_id"), F.lit('","Mon","NO","user","'))
    return lines.select("doc_id", "lang", F.concat(head, "value", F.lit('"')).alias("value"))


def short_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Every line of every document: `doc_id, lang, text`."""
    whole = spread_table(spark, sf, "documents", "doc_id", "lang", "text")
    return lines_of(whole, "text", "doc_id", "lang").withColumnRenamed("value", "text")


def embeddings(spark: SparkSession, sf: str) -> DataFrame:
    """`vec_id, label, vector`."""
    vector = array_to_vector(F.col("embedding").cast("array<double>"))
    return table(spark, sf, "embeddings").select("vec_id", "label", vector.alias("vector"))
