"""Pages of long lists, cut in the partitions of one range sort."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.session import let_workers_import, stage


def pages(rows: DataFrame, key: str, entry: list[str], name: str, limit: int) -> DataFrame:
    """`key, piece, name`: every key's entries in entry order, `limit` to a page, numbered from 0.

    Rows are shuffled once, by range of key and entry, with a number that splits repeated rows too, so no key has to fit
    in one partition. A sorted partition is cut into pages as it streams by; a row's rank in its key is its place there,
    but for the partition's first key, which may have begun in an earlier partition. Pages of first keys, and the last
    page of a partition, which may go on in the next, stay open: they alone are placed by what earlier partitions hold of
    their key, counted by one row for each key and partition. Null keys form a list like others; no rows give no pages.
    """
    apart = rows.select(key, *entry).withColumn("_tie", F.monotonically_increasing_id())
    inside = apart.repartitionByRange(key, *entry, "_tie").sortWithinPartitions(key, *entry, "_tie").drop("_tie")
    fields = {f.name: f for f in inside.schema.fields}
    listed = T.ArrayType(T.StructType([fields[e] for e in entry]), containsNull=False)
    schema = T.StructType(
        [
            fields[key],
            T.StructField("_part", T.IntegerType()),
            T.StructField("_place", T.LongType()),
            T.StructField("_open", T.BooleanType()),
            T.StructField(name, listed),
        ]
    )

    def cut(batches):
        part = TaskContext.get().partitionId()
        for found, places, is_open in _pages_of(batches, limit):
            starts = np.flatnonzero(places % limit == 0)
            starts = starts if len(starts) and starts[0] == 0 else np.r_[0, starts]
            structs = pa.StructArray.from_arrays([found.column(i) for i in range(1, found.num_columns)], entry)
            lists = pa.ListArray.from_arrays(pa.array(np.r_[starts, len(places)], pa.int32()), structs)
            columns = [
                found.column(0).take(pa.array(starts)), pa.array(np.full(len(starts), part, dtype=np.int32)),
                pa.array(places[starts]), pa.array(is_open[starts]), lists,
            ]
            yield pa.RecordBatch.from_arrays(columns, [key, "_part", "_place", "_open", name])

    let_workers_import(rows.sparkSession)
    found = stage(inside.mapInArrow(cut, schema), "pages")
    piece = F.floor(F.col("_place") / limit).cast("int").alias("piece")
    whole = found.where("not _open").select(key, piece, name)

    left = found.where("_open")
    ends = left.groupBy(key, "_part").agg(F.max(F.col("_place") + F.size(name)).alias("_rows"))
    before = Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(
        F.col(key).alias("_key"), F.col("_part").alias("_at"), F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before")
    )
    met = left.join(carried, left[key].eqNullSafe(carried["_key"]) & (left["_part"] == carried["_at"]))
    entries = met.select(key, (F.col("_before") + F.col("_place")).alias("_from"), F.posexplode(name).alias("_i", "_entry"))
    again = entries.withColumn("_rank", F.col("_from") + F.col("_i"))
    mended = again.groupBy(key, F.floor(F.col("_rank") / limit).cast("int").alias("piece")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("_rank", "_entry"))), lambda x: x["_entry"]).alias(name)
    )
    return whole.unionByName(mended)


def _pages_of(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Sorted rows again, cut between pages: `rows, places, open`, the place of each row in its key so far.

    The last page, which the next rows may continue, is held back; at most `limit` rows and a batch are held.
    """
    held: pa.RecordBatch | None = None
    held_place, first_key = 0, True
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = batch if held is None else pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        places, new = _places(rows, held_place)
        is_open = np.full(len(places), first_key)
        if first_key and new.any():
            is_open[np.argmax(new) :] = False
            first_key = False
        keep = int(np.flatnonzero((places % limit == 0) | new | (np.arange(len(places)) == 0))[-1])
        if keep:
            yield rows.slice(0, keep), places[:keep], is_open[:keep]
        held, held_place = rows.slice(keep), int(places[keep])
    if held is not None:
        yield held, held_place + np.arange(held.num_rows), np.ones(held.num_rows, dtype=bool)


def _places(rows: pa.RecordBatch, start: int) -> tuple[np.ndarray, np.ndarray]:
    """Each row's place in its key, the first row's being `start`, and which rows begin a key after the first."""
    keys = rows.column(0)
    new = np.zeros(len(keys), dtype=bool)
    if len(keys) > 1:
        a, b = keys.slice(1), keys.slice(0, len(keys) - 1)
        differ = pc.fill_null(pc.not_equal(a, b), pc.not_equal(pc.is_null(a), pc.is_null(b)))
        new[1:] = differ.to_numpy(zero_copy_only=False)
    at = np.arange(len(keys))
    begin = np.maximum.accumulate(np.where(new, at, -start))
    return at - begin, new
