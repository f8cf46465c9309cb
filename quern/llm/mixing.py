"""Mixing sources to target weights by exact subset sums over document lengths."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.llm.common import fresh, ranked
from quern.session import broadcast_if_small, stage

#: Budget left after the proportional part that the dynamic programme fills exactly.
EXACT_BUDGET = 65_536


def word_count(text: Column) -> Column:
    """Number of words between white space; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """`source, source_size, target`: `share` of all words dealt by weight, at most `most` times a source's own.

    Sources take the weights in code-point order, null last, over and over. What a full source cannot
    take goes to the others by weight: every source gets `level` times its weight or its most, and the
    level is found by adding up over the sources, a few times. `sizes` is a stage table of one row per source.
    """
    total = sizes.agg(F.sum("source_size")).first()[0] or 0
    # Places in the order come from counts per block of sources, so that no task orders all of them.
    order = [F.col("source").isNull(), F.col("source")]
    dealt = stage(sizes.repartitionByRange(*order).withColumn("block", F.spark_partition_id()), "sources")
    blocks = dealt.groupBy("block").agg(F.count(F.lit(1)).alias("n"))
    before = blocks.withColumn(
        "before", F.coalesce(F.sum("n").over(Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    )
    at = F.col("before") + F.row_number().over(Window.partitionBy("block").orderBy(*order)) - 1
    weight = F.element_at(F.array(*map(F.lit, map(float, weights))), (F.pmod(at, F.lit(len(weights))) + 1).cast("int"))
    weighed = stage(dealt.join(before, "block").select("source", "source_size", weight.alias("weight")), "weights")
    cap = F.col("source_size") * F.lit(float(most))
    level, full = 0.0, -1
    while True:
        is_full = cap <= F.lit(level) * F.col("weight")
        n, taken, rest = weighed.agg(
            F.count(F.when(is_full, 1)), F.sum(F.when(is_full, cap)), F.sum(F.when(~is_full, F.col("weight")))
        ).first()
        if n == full or not rest:
            break
        full, level = n, (share * total - (taken or 0.0)) / rest
    return weighed.select("source", "source_size", F.least(cap, F.lit(level) * F.col("weight")).alias("target"))


def fill_budget(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many documents of each length to take so that their lengths add up to `budget`, or as close below as can be.

    Every length first gives its share of all but half of `EXACT_BUDGET`, rounded down, and the longest that fit
    bring the budget left below `EXACT_BUDGET`; a bounded-knapsack dynamic programme over sets of reachable sums fills that. `lengths` are
    positive and differ. Taken are the same for the same counts.
    """
    total = int((lengths * counts).sum())
    if budget >= total:
        return counts.copy()
    taken = (counts.astype(object) * max(0, budget - EXACT_BUDGET // 2) // total).astype(np.int64)
    left = budget - int((lengths * taken).sum())
    for i in np.argsort(-lengths):
        if left < EXACT_BUDGET:
            break
        more = min(int(counts[i] - taken[i]), (left - EXACT_BUDGET) // int(lengths[i]) + 1, left // int(lengths[i]))
        taken[i] += more
        left -= more * int(lengths[i])
    # Reachable sums are the bits of an integer; a length that occurs n times goes in as 1, 2, 4, ... of them.
    mask, sums, steps = (1 << (left + 1)) - 1, 1, []
    for i in np.argsort(lengths):
        free, lot = min(int(counts[i] - taken[i]), left // int(lengths[i])), 1
        while free > 0 and not sums >> left & 1:
            lot = min(lot, free)
            steps.append((i, lot, sums))
            sums |= sums << lot * int(lengths[i]) & mask
            free, lot = free - lot, 2 * lot
    at = sums.bit_length() - 1
    for i, lot, before in reversed(steps):
        if not before >> at & 1:
            taken[i] += lot
            at -= lot * int(lengths[i])
    return taken


def mix(
    docs: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: float = 2.0, seed: int = 11,
    doc_id: str = "doc_id", source: str = "source", text: str = "text",
) -> DataFrame:
    """`doc_id, source, size, source_size, target, taken, copies`: one row per document; `taken` is a multiple of its size.

    A document is taken whole, as often as its source's target holds its source whole, and once more if it is
    among those that fill what is left of the target. Those are chosen by their number of each length, found by
    exact subset sums, and among the documents of one length by a seeded order. Null texts have no words; a null
    source is a source of its own, the last; rows that repeat are documents of their own; no rows give no rows.
    A source larger than a task is no matter: tasks get its counts by length and buckets of its documents.
    """
    words = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.col(source).cast("string").alias("source"),
        word_count(F.col(text)).alias("size"),
    )
    sized = stage(words, "sizes")
    per_source = stage(sized.groupBy("source").agg(F.sum("size").alias("source_size")), "source-sizes")
    targets = stage(source_targets(per_source, weights, share, most), "targets")
    lengths = sized.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n"))
    met = lengths.withColumnsRenamed({"source": "s"}).join(targets, F.col("s").eqNullSafe(targets["source"])).drop("s")

    def choose(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("size")
        size, target = int(group["source_size"].iloc[0]), round(float(group["target"].iloc[0]))
        times = target // size if size else 0
        sizes, counts = group["size"].to_numpy(np.int64), group["n"].to_numpy(np.int64)
        some = sizes > 0
        taken = np.zeros(len(group), dtype=np.int64)
        taken[some] = fill_budget(sizes[some], counts[some], target - times * size)
        return group.assign(times=times, once_more=taken)[["source", "size", "source_size", "target", "times", "once_more"]]

    chosen = met.groupBy("source").applyInPandas(
        choose, "source string, size long, source_size long, target double, times long, once_more long"
    )
    placed = ranked(sized, ["source", "size"], seed, ["doc_id"], stage(chosen, "chosen"))
    again = F.col("times") + (F.col("rank") < F.col("once_more")).cast("long")
    return placed.select(
        "doc_id", "source", "size", "source_size", "target", (F.col("size") * again).alias("taken"), again.alias("copies")
    )


def repeat(docs: DataFrame, mixed: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """The rows of `docs` as often as the mix takes them, with their columns; rows of one id are taken alike."""
    key, times, copy = (fresh(docs, n) for n in ("_id", "_copies", "_copy"))
    copies = mixed.groupBy(F.col("doc_id").alias(key)).agg(F.max("copies").alias(times)).where(F.col(times) > 0)
    met = docs.join(broadcast_if_small(copies), docs[doc_id].cast("long").eqNullSafe(F.col(key)))
    return met.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(times)))).drop(key, times, copy)
