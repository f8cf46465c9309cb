"""Point expressions for the integer clustering."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Center = tuple[int, int]
#: More centres than this make the unrolled comparison too long to compile.
UNROLLED_CENTERS = 64


def list_position(value: Column, choices: Sequence[str]) -> Column:
    """1-based place of `value` in a fixed list, 0 when it is not there."""
    return F.array_position(F.array(*[F.lit(c) for c in choices]), value)


def squared_distance(x: str, y: str, cx: str, cy: str) -> str:
    """SQL of the squared Euclidean distance as a double."""
    dx, dy = f"(cast({x} as double) - {cx})", f"(cast({y} as double) - {cy})"
    return f"{dx} * {dx} + {dy} * {dy}"


def with_nearest(df: DataFrame, centers: Sequence[Center], x: str = "x", y: str = "y", many: bool = False) -> DataFrame:
    """Adds `idx` and squared `dist` of the closest centre; equal distances go to the lowest index.

    With `many` rows the comparison is unrolled into compiled code. That costs a compilation for
    every new set of centres, so by default the centres are a constant array that is scanned.
    """
    if many and 1 < len(centers) <= UNROLLED_CENTERS:
        found = [
            f"struct({squared_distance(x, y, f'{cx}D', f'{cy}D')} as dist, {i} as idx)"
            for i, (cx, cy) in enumerate(centers)
        ]
        nearest = df.withColumn("nearest", F.expr(f"least({', '.join(found)})"))
        return nearest.select(*df.columns, "nearest.idx", "nearest.dist")
    xs, ys = (", ".join(f"{c[axis]}D" for c in centers) for axis in (0, 1))
    distances = F.expr(f"zip_with(array({xs}), array({ys}), (cx, cy) -> {squared_distance(x, y, 'cx', 'cy')})")
    return (
        df.withColumn("distances", distances)
        .withColumn("dist", F.array_min("distances"))
        .withColumn("idx", (F.array_position("distances", F.col("dist")) - 1).cast("int"))
        .select(*df.columns, "idx", "dist")
    )
