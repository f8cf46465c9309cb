"""Small helpers the operators of this subpackage share."""

from __future__ import annotations

import string
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Rows of one group that are put in order in one task; larger groups are dealt into more buckets.
ROWS_PER_BUCKET = 4096
#: Most texts in one Arrow batch.
TEXTS_PER_BATCH = 512


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case and nothing else."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def fold_of(doc_id: str, folds: int) -> Column:
    """crc32 of the id's text modulo `folds`; a null id counts as the empty text."""
    text = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.pmod(F.crc32(text.cast("binary")), F.lit(folds))


def fresh(df: DataFrame, name: str) -> str:
    """`name`, with underscores until no column of `df` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def map_texts(rows: DataFrame, run, schema) -> DataFrame:
    """`rows.mapInArrow`, with no more than `TEXTS_PER_BATCH` rows sent to Python at once.

    Spark's own default is 10,000 rows, which can be very much text. The session's setting is lowered; results
    do not depend on it.
    """
    setting, conf = "spark.sql.execution.arrow.maxRecordsPerBatch", rows.sparkSession.conf
    now = int(conf.get(setting))
    if now <= 0 or now > TEXTS_PER_BATCH:
        conf.set(setting, str(TEXTS_PER_BATCH))
    return rows.mapInArrow(run, schema)


def raw_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 of a text column; null is empty."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, range]]:
    """Batches with row numbers that no other task uses. Only for results that are staged at once:
    a second run of the task may number its rows anew."""
    at = TaskContext.get().partitionId() << 40
    for batch in batches:
        yield batch, range(at, at + batch.num_rows)
        at += batch.num_rows


def ranked(rows: DataFrame, keys: list[str], seed: int, ties: list[str], also: DataFrame | None = None) -> DataFrame:
    """`rows` with `rank`, from 0 in each group of `keys`, in an order drawn from `seed` and `ties`.

    `rows` is read twice, so it should be a stage table. A group is dealt into as many buckets of
    the drawn order as its size asks for; only counts per bucket are summed up across the group, so
    no task orders a large group. `also` holds one row per group; its other columns are added.
    Null keys form groups of their own. Equal rows may swap their ranks.
    """
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    largest = sizes.agg(F.max("_n")).first()[0] or 0
    buckets = max(1, -(-largest // ROWS_PER_BUCKET))
    drawn = rows.withColumn("_drawn", F.xxhash64(F.lit(seed), *ties)).withColumn(
        "_bucket", F.expr(f"cast(((_drawn >> 1) + {2**62}) / {2.0**63 / buckets!r} as int)")
    )
    per_bucket = drawn.groupBy(*keys, "_bucket").agg(F.count(F.lit(1)).alias("_count"))
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    first = per_bucket.withColumn("_first", F.coalesce(F.sum("_count").over(before), F.lit(0))).drop("_count")
    if also is not None:
        first = _null_safe(first, also, keys)
    inside = Window.partitionBy(*keys, "_bucket").orderBy("_drawn", *ties)
    placed = drawn.withColumn("_at", F.row_number().over(inside) - 1)
    return (
        _null_safe(placed, first, [*keys, "_bucket"])
        .withColumn("rank", F.col("_first") + F.col("_at"))
        .drop("_bucket", "_drawn", "_first", "_at")
    )


def _null_safe(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join in which null keys meet; the keys come from the left."""
    names = {k: f"_right{i}" for i, k in enumerate(keys)}
    renamed = right.withColumnsRenamed(names)
    meet = [left[k].eqNullSafe(renamed[n]) for k, n in names.items()]
    return left.join(renamed, meet).drop(*names.values())
