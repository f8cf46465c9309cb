"""Products of ratings with a well filled co-occurrence matrix, a batch of users at a time."""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from decimal import ROUND_HALF_UP, Context, Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.session import broadcast_if_small, let_workers_import, stage, tasks_for

#: Cells of users and items that are summed at a time.
CELLS_AT_ONCE = 1_000_000
#: Cells of the matrix that a task holds when targets are dealt into blocks.
MATRIX_AT_ONCE = 4_000_000
#: What a row of a cell is; rows of a cell are sorted by it.
NAME, ENTRY, RATING = 0, 1, 2
#: Enough digits for any double.
EXACT = Context(prec=700)
#: A matrix is well filled if at least one in so many of its cells has an entry.
FILLED = 8


def is_filled(entries: int, items: int) -> bool:
    return entries * FILLED >= items * items


def dense_sums(rated: DataFrame, matrix: DataFrame, tasks: int, decimals: int | None = None) -> DataFrame:
    """`user_id, item_id, score, own`: the sum of a user's products for every item that one of them reaches.

    `rated` has `user_id, item_id, rating double`, `matrix` has `item_id, item_b, cnt, own` and is of broadcast size.
    Ratings are dealt and sorted by user, so a user's sums are a row of one matrix product and products never are rows.
    With `decimals`, products are rounded before they are summed, and `rated` has a row for each different rating of an item
    and its number of `times`; a task then holds all of a user's rows.
    """
    entries = matrix.select("item_id", "item_b", "cnt", "own").collect()  # measured before, as for a broadcast
    names = sorted({r[0] for r in entries} | {r[1] for r in entries})
    at = {name: i for i, name in enumerate(names)}
    counts = np.zeros((len(names), len(names)))
    there, own = np.zeros(counts.shape, dtype=np.float32), np.zeros(counts.shape, dtype=np.float32)
    for a, b, cnt, mark in entries:
        counts[at[a], at[b]], there[at[a], at[b]], own[at[a], at[b]] = cnt, 1, mark
    items = rated.sparkSession.createDataFrame(list(at.items()), "item_id string, _item int")
    numbered = rated.repartition(tasks, "user_id").join(F.broadcast(items), "item_id")
    user = rated.schema["user_id"]
    schema = T.StructType([
        user, T.StructField("item_id", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("own", T.IntegerType()),
    ])

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _summed_users(batches, pa.array(names, pa.string()), counts, there, own, schema.names, decimals)

    let_workers_import(rated.sparkSession)
    columns = ["user_id", "_item", "rating", *([] if decimals is None else ["times"])]
    return numbered.select(*columns).sortWithinPartitions("user_id").mapInArrow(summed, schema)


def dense_grid(rated: DataFrame, matrix: DataFrame, items: DataFrame, blocks: tuple[int, int]) -> DataFrame:
    """`user_id, item_id, score, own` as by `dense_sums`, for a matrix of any size that is dealt into `blocks` of users and targets.

    `items` is `target_blocks` of all of the matrix's items. Every pair of a user and a target block is a cell: it gets the matrix
    columns of its targets and the ratings of its users, sorted by user. So a task holds the columns of one block, and ratings
    and entries of the matrix are shuffled, products never. Rows are flat, as Spark measures a batch anew for every row it adds.
    """
    user_blocks, blocks_of_targets = blocks
    height = blocks_of_targets * (items.agg(F.max("at")).first()[0] + 1)
    width = height // blocks_of_targets
    known = items.select("item_id", (F.col("target_block") * width + F.col("at")).alias("item"))
    targets = items.withColumnRenamed("item_id", "item_b")

    kind = lambda number: F.lit(number).alias("kind")
    cell = (F.col("user_block").cast("long") * blocks_of_targets + F.col("target_block")).alias("cell")
    every_user_block = F.explode(F.sequence(F.lit(0), F.lit(user_blocks - 1)))
    names = items.withColumn("user_block", every_user_block)
    entries = matrix.join(broadcast_if_small(known), "item_id").join(broadcast_if_small(targets), "item_b")
    entries = entries.withColumn("user_block", every_user_block)
    dealt = (
        rated.join(broadcast_if_small(known), "item_id")
        .withColumn("user_block", F.pmod(F.xxhash64("user_id"), F.lit(user_blocks)).cast("int"))
        .withColumn("target_block", F.explode(F.sequence(F.lit(0), F.lit(blocks_of_targets - 1))))
    )
    value = F.col("cnt").cast("double").alias("value")
    cells = (
        dealt.select(cell, kind(RATING), "user_id", "item", F.col("rating").alias("value"))
        .unionByName(entries.select(cell, kind(ENTRY), "item", "at", value, F.col("own").cast("int").alias("own")), True)
        .unionByName(names.select(cell, kind(NAME), "at", F.col("item_id").alias("name")), True)
    )
    schema = T.StructType([
        rated.schema["user_id"], T.StructField("item_id", T.StringType()), T.StructField("score", T.DoubleType()),
        T.StructField("own", T.IntegerType()),
    ])

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, of_cell in itertools.groupby(_runs(batches), lambda run: run[0]):
            shown, counts = pa.array([], pa.string()), np.zeros((height, width))
            there, own = np.zeros(counts.shape, dtype=np.float32), np.zeros(counts.shape, dtype=np.float32)
            for kind, runs in itertools.groupby(of_cell, lambda run: run[1]):
                parts = (rows for _, _, rows in runs)
                if kind == NAME:
                    found = pa.Table.from_batches(parts).combine_chunks()
                    shown = found["name"].chunk(0).take(pc.sort_indices(found["at"]))
                elif kind == ENTRY:
                    for rows in parts:
                        place = rows["item"].to_numpy(), rows["at"].to_numpy()
                        counts[place], there[place], own[place] = rows["value"].to_numpy(), 1, rows["own"].to_numpy()
                else:
                    ratings = (rows.select(["user_id", "item", "value"]) for rows in parts)
                    yield from _summed_users(ratings, shown, counts, there, own, schema.names)

    let_workers_import(rated.sparkSession)
    tasks = tasks_for(rated.sparkSession, user_blocks * blocks_of_targets, 1)
    dealt_cells = cells.repartitionById(tasks, F.pmod("cell", F.lit(tasks)).cast("int"))
    return dealt_cells.sortWithinPartitions("cell", "kind", "user_id").mapInArrow(summed, schema)


def target_blocks(items: DataFrame, blocks: int) -> DataFrame:
    """`item_id, target_block, at`: a block for every item, and its place there, as a stage table."""
    dealt = items.select("item_id", F.pmod(F.xxhash64("item_id"), F.lit(blocks)).cast("int").alias("target_block"))
    place = F.row_number().over(Window.partitionBy("target_block").orderBy("item_id")) - 1
    return stage(dealt.withColumn("at", place), "targets")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, pa.RecordBatch]]:
    """Batches cut where cell or kind changes, with both."""
    for batch in batches:
        cell, kind = batch.column("cell").to_numpy(), batch.column("kind").to_numpy()
        edges = 1 + np.flatnonzero((np.diff(cell) != 0) | (np.diff(kind) != 0))
        for start, end in itertools.pairwise([0, *edges.tolist(), len(cell)]):
            if end > start:
                yield int(cell[start]), int(kind[start]), batch.slice(start, end - start)


def _summed_users(batches, shown, counts, there, own, columns, decimals=None) -> Iterator[pa.RecordBatch]:
    """The sums of users whose ratings are sorted by user; `shown` has the items of the matrix's columns."""
    width = counts.shape[1]
    for rows, user_no in _whole_users(batches):
        item, rating = rows.column(1).to_numpy().astype(np.int64), rows.column(2)
        known = pc.is_valid(rating).to_numpy(zero_copy_only=False)
        value = pc.fill_null(rating, 0.0).to_numpy(zero_copy_only=False)
        times = None if decimals is None else rows.column(3).to_numpy()
        for part in _slices(user_no, max(counts.shape)):
            rounded = None if decimals is None else (times[part], decimals)
            cells, score, marks, valid = _sums(user_no[part], item[part], value[part], known[part], counts, there, own, rounded)
            first = part.start + np.flatnonzero(np.diff(user_no[part], prepend=-1))
            users = rows.column(0).take(pa.array(first[cells // width]))
            scores = pa.array(score, mask=~valid)
            yield pa.RecordBatch.from_arrays([users, shown.take(pa.array(cells % width)), scores, pa.array(marks)], columns)


def _whole_users(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Sorted rows with a number for each user, cut between users; the last user's rows wait for the next batch."""
    held: pa.RecordBatch | None = None
    for batch in itertools.chain((b for b in batches if b.num_rows), [None]):
        both = [b for b in (held, batch) if b is not None]
        if not both:
            return
        rows = pa.Table.from_batches(both).combine_chunks().to_batches()[0]
        users = rows.column(0)
        a, b = users.slice(1), users.slice(0, len(users) - 1)
        differ = pc.fill_null(pc.not_equal(a, b), pc.not_equal(pc.is_null(a), pc.is_null(b)))
        user_no = np.r_[0, np.cumsum(differ.to_numpy(zero_copy_only=False))]
        cut = int(np.searchsorted(user_no, user_no[-1])) if batch is not None else len(users)
        if cut:
            yield rows.slice(0, cut), user_no[:cut]
        held = rows.slice(cut)


def _slices(user_no: np.ndarray, width: int) -> Iterator[slice]:
    """Rows of whole users, as many as `CELLS_AT_ONCE` allows."""
    most = max(1, CELLS_AT_ONCE // width)
    edges = np.searchsorted(user_no, np.arange(0, user_no[-1] + 1, most))
    for start, end in itertools.pairwise([*edges.tolist(), len(user_no)]):
        yield slice(start, end)


def _sums(user_no, item, value, known, counts, there, own, rounded=None):
    """`cells, score, own, valid` of the cells (user times target) that a user's ratings reach; no known rating gives null."""
    rated_items = np.flatnonzero(np.bincount(item, minlength=len(counts)))
    if len(rated_items) < len(counts):  # other rows of the matrix have no part in it
        item = np.searchsorted(rated_items, item)
        counts, there, own = counts[rated_items], there[rated_items], own[rated_items]
    user, height = user_no - user_no[0], len(counts)
    users, at = int(user[-1]) + 1, user * height + item
    rated = np.zeros((users, height), dtype=np.float32)
    rated[user, item] = 1
    odd = ~np.isfinite(value)
    finite = np.where(odd, 0, value)
    if rounded is None:
        sums = np.bincount(at, finite, users * height).reshape(users, height) @ counts
    else:
        sums = _rounded_sums(user, item, finite, *rounded, counts)
    for i in np.flatnonzero(odd):  # infinity and NaN reach the cells that have an entry only
        row = there[item[i]] > 0
        with np.errstate(invalid="ignore"):
            sums[user[i], row] += value[i] * counts[item[i], row]
    cells = np.flatnonzero(rated @ there > 0)
    marks = ((rated @ own).ravel()[cells] > 0).astype(np.int32)
    if known.all():
        return cells, sums.ravel()[cells], marks, np.ones(len(cells), dtype=bool)
    rated[:] = 0
    rated[user[known], item[known]] = 1
    return cells, sums.ravel()[cells], marks, (rated @ there).ravel()[cells] > 0


def _rounded_sums(user, item, value, times, decimals, counts):
    """For each user the sum of rounded products, some rows at a time; `user` is sorted and numbered from 0.

    A product of the same item and rating is rounded once if that is worth while.
    """
    sums = np.zeros((int(user[-1]) + 1, counts.shape[1]))
    at_once = max(1, CELLS_AT_ONCE // counts.shape[1])
    pairs, at = np.unique(np.stack([item, value], axis=1), axis=0, return_inverse=True)
    table = None
    if 4 * len(pairs) <= len(user) and len(pairs) <= 4 * at_once:
        table = round_half_up(counts[pairs[:, 0].astype(np.int64)] * pairs[:, 1:], decimals)
    for start in range(0, len(user), at_once):
        some = slice(start, start + at_once)
        products = round_half_up(counts[item[some]] * value[some, None], decimals) if table is None else table[at[some]]
        if (times[some] != 1).any():
            products = products * times[some, None]
        first = np.flatnonzero(np.diff(user[some], prepend=-1))
        sums[user[some][first]] += np.add.reduceat(products, first, axis=0)
    return sums


def round_half_up(values: np.ndarray, decimals: int) -> np.ndarray:
    """Values rounded as Spark's `round` does: halves away from zero, by the shortest decimal number that is the value."""
    scaled = np.abs(values) * 10.0**decimals
    whole = np.floor(scaled)
    part = scaled - whole
    found = np.copysign((whole + (part >= 0.5)) / 10.0**decimals, values)
    # The scaled value is not exact: near a half, and where no digits are left for a fraction, the number itself decides.
    unsure = (np.abs(part - 0.5) <= 4e-16 * scaled) | (scaled > 1e15)
    if decimals and unsure.any():
        different, place = np.unique(values[unsure], return_inverse=True)
        digit = Decimal(1).scaleb(-decimals)
        exact = [float(Decimal(repr(v)).quantize(digit, ROUND_HALF_UP, EXACT)) for v in different.tolist()]
        found[unsure] = np.array(exact)[place]
    return found
