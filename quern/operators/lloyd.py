"""Integer k-means on weighted points.

Points are `x, y, w` rows of bigints, `w` counting equal points; sums, sizes, medians and nearest
centres depend on nothing else, so the loop works on the distinct points only.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quern.functions.geometry import Center, with_nearest
from quern.session import stage

# Number of clusters, movement that ends the loop, and most iterations.
CLUSTERS = 45
ETA = 20.0
MAX_ITERATIONS = 120

CENTER_SCHEMA = "idx int, x bigint, y bigint"
HISTORY_SCHEMA = (
    "iter int, idx int, old_x bigint, old_y bigint, new_x bigint, new_y bigint, "
    "moved double, total_moved double, converged boolean, reached_max boolean"
)
SUMMARY_SCHEMA = "x bigint, y bigint, size bigint, median bigint, average bigint"
#: Up to this many distinct points an iteration is too short to be worth compiling or shuffling.
FEW_POINTS = 100_000
#: Rows with equal leading bits form one bin of the median search; a bin has at most 2**16 values.
BIN_BITS = 16


@dataclass
class Fit:
    """Final centres and, per iteration and centre, the movement."""

    centers: list[Center]
    history: list[tuple] = field(default_factory=list)
    iterations: int = 0
    converged: bool = False
    many: bool = False  # more distinct points than FEW_POINTS

    def centers_df(self, spark: SparkSession) -> DataFrame:
        return centers_df(spark, self.centers)

    def history_df(self, spark: SparkSession) -> DataFrame:
        """`iter, idx, old_x, old_y, new_x, new_y, moved, total_moved, converged, reached_max` (M3).

        `reached_max` marks the iteration that the limit allows as the last, converged or not.
        """
        return spark.createDataFrame(self.history, HISTORY_SCHEMA)


def centers_df(spark: SparkSession, centers: Sequence[Center]) -> DataFrame:
    """`idx, x, y`, one row per centre."""
    return spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(centers)], CENTER_SCHEMA)


def weigh_points(points: DataFrame, ordered: bool = True) -> DataFrame:
    """Distinct points with their number, as a stage table: `x, y, w`, and `place` when `ordered`.

    `place` is made of the sorted partition and the row's position in it, which `points_at_ranks`
    turns into ranks without bringing the points into one task. Only the ordered start needs it and
    the sort it takes.
    """
    weighted = points.groupBy("x", "y").agg(F.count(F.lit(1)).alias("w"))
    if ordered:
        weighted = weighted.orderBy("x", "y").withColumn("place", F.monotonically_increasing_id())
    return stage(weighted, "points")


def points_at_ranks(points: DataFrame, clusters: int) -> list[Center]:
    """`clusters` distinct points at evenly spaced ranks in (x, y) order (T5, ordered start)."""
    position_bits = 33  # of monotonically_increasing_id
    sizes = {
        r["part"]: r["n"]
        for r in points.groupBy(F.shiftright("place", position_bits).alias("part"))
        .agg(F.count(F.lit(1)).alias("n"))
        .collect()
    }
    total = sum(sizes.values())
    k = min(clusters, total)
    wanted = [i * total // k for i in range(k)]
    places, start = [], 0
    for part in sorted(sizes):
        places += [(part << position_bits) + r - start for r in wanted if start <= r < start + sizes[part]]
        start += sizes[part]
    found = points.where(F.col("place").isin(places)).select("x", "y").collect()
    return sorted((r["x"], r["y"]) for r in found)


def sample_points(points: DataFrame, clusters: int, seed: int, key: str = "id") -> DataFrame:
    """`clusters` rows drawn without replacement, in drawing order: `draw, x, y` (T5).

    Rows are ordered by a digest of seed and `key`, so a draw does not depend on partitioning.
    """
    draw = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    return points.select(draw.alias("draw"), "x", "y").orderBy("draw", "x", "y").limit(clusters)


def sampled_centers(points: DataFrame, clusters: int, seed: int, key: str = "id") -> list[Center]:
    drawn = sample_points(points, clusters, seed, key).collect()
    return [(r["x"], r["y"]) for r in sorted(drawn, key=lambda r: (r["draw"], r["x"], r["y"]))]


def assign(points: DataFrame, centers: Sequence[Center], many: bool = False) -> DataFrame:
    """Points with `idx` and squared `dist` of their nearest centre."""
    return with_nearest(points, centers, many=many)


def centroids(assigned: DataFrame) -> DataFrame:
    """`idx, x, y`: mean of each cluster, cut toward zero; empty clusters are absent (A10)."""
    return assigned.groupBy("idx").agg(
        F.expr("sum(x * w) div sum(w)").alias("x"), F.expr("sum(y * w) div sum(w)").alias("y")
    )


def _moved(a: Center, b: Center) -> float:
    dx, dy = float(a[0] - b[0]), float(a[1] - b[1])
    return dx * dx + dy * dy


def fit(
    points: DataFrame, centers: Sequence[Center], eta: float = ETA, max_iterations: int = MAX_ITERATIONS
) -> Fit:
    """Move the centres until they move less than `eta` in total.

    One Spark job per iteration over the weighted points; only the centres reach the driver. A
    counted small set of distinct points takes one partition, so its iterations do not shuffle.
    """
    points = points.select("x", "y", "w")
    if not centers:
        if points.isEmpty():
            return Fit([], converged=True)
        raise ValueError("k-means needs at least one centre")
    many = points.count() > FEW_POINTS
    state = Fit(list(centers), many=many)
    points = (points if many else points.coalesce(1)).persist()
    try:
        while not state.converged and state.iterations < max_iterations:
            old = state.centers
            new = list(old)
            for row in centroids(assign(points, old, many)).collect():
                new[row["idx"]] = (row["x"], row["y"])
            moves = [_moved(a, b) for a, b in zip(old, new)]
            total = sum(moves)
            state.iterations += 1
            state.converged = total < eta
            state.centers = new
            state.history += [
                (state.iterations, i, *old[i], *new[i], moves[i], total, state.converged, state.iterations >= max_iterations)
                for i in range(len(old))
            ]
    finally:
        points.unpersist()
    return state


def integer_median(counts: DataFrame, group: str, value: str = "y", count: str = "n") -> DataFrame:
    """`group, median` of an integer column given as counted values.

    The middle value, or of an even number half the sum of the two, cut toward zero. Exact in two
    bounded steps: count the values in bins of 2**16, then rank inside the one or two bins that hold
    the middle. No group is ever ordered as a whole.
    """
    bin_of = F.shiftright(value, BIN_BITS).alias("bin")
    bins = counts.groupBy(group, bin_of).agg(F.sum(count).alias("held"))
    in_group = Window.partitionBy(group)
    reached = bins.select(
        group,
        "bin",
        "held",
        F.sum("held").over(in_group.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)).alias("upto"),
        F.sum("held").over(in_group).alias("total"),
    )
    low, high = F.expr("(total - 1) div 2"), F.expr("total div 2")
    before = F.col("upto") - F.col("held")
    middle = reached.where((F.col("upto") > low) & (before <= high)).select(
        group, "bin", before.alias("before"), "total"
    )
    inside = counts.select(group, value, count, bin_of).join(middle, [group, "bin"])
    by_value = Window.partitionBy(group, "bin").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    ranked = inside.withColumn("upto", F.col("before") + F.sum(count).over(by_value))

    def at(rank):
        held = (F.col("upto") - F.col(count) <= rank) & (rank < F.col("upto"))
        return F.max(F.when(held, F.col(value)))

    pair = ranked.groupBy(group).agg(at(low).alias("lower"), at(high).alias("upper"))
    return pair.select(group, F.expr("(lower + upper) div 2").alias("median"))


def summary(points: DataFrame, centers: Sequence[Center], many: bool = False) -> DataFrame:
    """`x, y, size, median, average` of every non-empty cluster, in that order.

    `many` compiles the distances, which pays for many distinct points; the result is the same.
    """
    if not centers:
        return points.sparkSession.createDataFrame([], SUMMARY_SCHEMA)
    counts = assign(points, centers, many).groupBy("idx", "y").agg(F.sum("w").alias("n"))
    sizes = counts.groupBy("idx").agg(F.sum("n").alias("size"), F.expr("sum(y * n) div sum(n)").alias("average"))
    places = F.broadcast(centers_df(points.sparkSession, centers))  # one row per centre
    return (
        sizes.join(integer_median(counts, "idx"), "idx")
        .join(places, "idx")
        .select("x", "y", "size", "median", "average")
        .orderBy("x", "y", "size", "median", "average")
    )
