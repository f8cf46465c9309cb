"""How the filters of a cleaning chain interact, for every order in which they could be applied."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import permutations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quern.llm.common import fresh

#: Most filters: the table of removal steps has an entry for each order, step and set of failed filters.
MOST_FILTERS = 6

# White space as in `[\x20\x09-\x0D]`, and the characters that condition D looks for.
_SPACE = "[\\x20\\x09-\\x0D]+"
_ODD = "[#$%&*|]"


def removal_steps(filters: int) -> tuple[np.ndarray, np.ndarray]:
    """`orders, steps`: all orders of so many filters, and the step at which each set of failed filters is removed.

    Row m of a mask matrix is 0 where set m (bit i: filter i) fails filter i, else infinite; column p of the position
    matrix has the steps at which order p applies the filters, its inverse permutation. Their min-plus product is the
    removal step; infinite for the empty set.
    """
    orders = np.array(list(permutations(range(filters))))
    position = np.argsort(orders, axis=1).T + 1.0
    fails = (np.arange(1 << filters)[:, None] >> np.arange(filters)) & 1
    mask = np.where(fails == 1, 0.0, np.inf)
    return orders, (mask[:, :, None] + position[None]).min(axis=1)


def _effects(spark: SparkSession, names: Sequence[str]) -> DataFrame:
    """`mask, filter_order, step, kept, removed, redundant, unique`: what each step does with each set of failed filters."""
    orders, removal = removal_steps(len(names))
    rows = []
    for mask in range(1 << len(names)):
        for p, order in enumerate(orders.tolist()):
            label = "".join(names[i] for i in order)
            for step, i in enumerate(order, 1):
                fails, at = mask >> i & 1, removal[mask, p]
                rows.append((mask, label, step, int(at > step), int(at == step), int(fails and at < step), int(mask == 1 << i)))
    flags = ("kept", "removed", "redundant", "unique")
    return spark.createDataFrame(rows, "mask int, filter_order string, step int, " + ", ".join(f"{f} int" for f in flags))


def interactions(counted: DataFrame, names: Sequence[str], weight: str = "n", lost: Mapping[str, str] | None = None) -> DataFrame:
    """`part, filter_order, step, kept, removed, redundant, unique_fails, …, shapley` from counts of sets of failed filters.

    `counted` has `part`, `mask` (bit i: fails filter i of `names`), `weight` and the weights that `lost` names as
    `output column: weight column`: each is summed over what a step removes. Rows of equal part and mask add up. One row
    for each part, order and step, zeros included. `shapley` is what the step's filter removes, summed over all orders.
    The orders' table is of fixed size for so many filters; every part is a few rows for each set of failed filters.
    """
    lost = lost or {}
    if not 1 <= len(names) <= MOST_FILTERS or any(len(n) != 1 for n in names):
        raise ValueError(f"1 to {MOST_FILTERS} filters of one letter each")
    sums = counted.groupBy("part", "mask").agg(*[F.sum(c).alias(c) for c in {weight, *lost.values()}])
    met = sums.join(F.broadcast(_effects(counted.sparkSession, names)), "mask")
    total = lambda flag, what=weight: F.sum(F.col(flag) * F.col(what)).cast("long")
    steps = met.groupBy("part", "filter_order", "step").agg(
        total("kept").alias("kept"), total("removed").alias("removed"), total("redundant").alias("redundant"),
        total("unique").alias("unique_fails"), *[total("removed", w).alias(name) for name, w in lost.items()],
    )
    named = steps.withColumn("_filter", F.expr("substring(filter_order, step, 1)"))
    shares = named.groupBy("part", "_filter").agg(F.sum("removed").alias("shapley"))
    return named.join(shares, ["part", "_filter"]).drop("_filter")


def conditions(text: Column, words: Column) -> dict[str, Column]:
    """The conditions that one text alone decides, by letter: A, B, C and D. `words` are the text's."""
    return {
        "A": F.size(words) < 100,
        "B": 100 * F.size(F.array_distinct(words)) < 80 * F.size(words),
        "C": 100 * F.length(F.regexp_replace(text, "[^A-Z]+", "")) > 10 * F.length(text),
        "D": text.rlike(_ODD),
    }


def audit_documents(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "lang"
) -> DataFrame:
    """The interactions of filters A to E on whole texts, within each `part` (null: the empty string).

    E fails a text that equals the text of any row with a smaller id, in any part. A null id is never smaller and has
    nothing smaller; rows of one id and text don't fail each other. Null texts are empty texts. A document is good or
    toxic if any row of `labels` (`doc_id, quality, toxic`) with its id says 1; null ids have no label. Repeated rows
    count as often as they occur; an empty table gives no rows; other columns don't matter.

    Texts are not shuffled, only their digests. Copies become one row for each digest, id, part and pair of labels in
    every task, and then one without the id, which has the smallest id and how many rows have it: all others fail E.
    """
    known = fresh(docs, "_known")
    marks = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias(known)).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False)).cast("int")).alias("_good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False)).cast("int")).alias("_toxic"),
    )
    texts = docs.select(
        F.col(doc_id).cast("long").alias("id"),
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col(text), F.lit("")).alias("body"),
    )
    # In a projection of its own the text is split once, though its words are used several times.
    split = texts.withColumn("words", F.array_remove(F.split("body", _SPACE), ""))
    tests = conditions(F.col("body"), F.col("words")).values()
    facts = split.select(
        "id", "part", F.unhex(F.sha2("body", 256)).alias("digest"),
        sum((test.cast("int") * (1 << i) for i, test in enumerate(tests)), F.lit(0)).alias("alone"),
    )
    marked = facts.join(marks, facts["id"] == F.col(known), "left").fillna(0, ["_good", "_toxic"])
    alike = ["digest", "part", "alone", "_good", "_toxic"]
    by_id = marked.groupBy(*alike, "id").agg(F.count(F.lit(1)).alias("rows"))
    by_text = by_id.groupBy(*alike).agg(
        F.sum("rows").alias("n"),
        F.sum(F.when(F.col("id").isNull(), F.col("rows")).otherwise(0)).alias("unnamed"),
        F.min(F.when(F.col("id").isNotNull(), F.struct("id", "rows"))).alias("least"),
    )
    first = F.min("least.id").over(Window.partitionBy("digest"))  # a few rows for each text
    passing = F.col("unnamed") + F.when(F.col("least.id") == F.col("first"), F.col("least.rows")).otherwise(0)
    dealt = by_text.withColumn("first", first).withColumn("passing", passing).select(
        "part", "_good", "_toxic",
        F.inline(F.array(
            F.struct(F.col("alone").alias("mask"), F.col("passing").alias("n")),
            F.struct((F.col("alone") + 16).alias("mask"), (F.col("n") - F.col("passing")).alias("n")),
        )),
    )
    counted = dealt.groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("_good")).alias("good"), F.sum(F.col("n") * F.col("_toxic")).alias("toxic")
    )
    return interactions(counted, "ABCDE", lost={"good_lost": "good", "toxic_lost": "toxic"}).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"
    )
