"""Approximate nearest neighbours by cosine: balanced posting lists behind a graph of centroids."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quern.llm.common import numbered
from quern.session import stage

#: The index is fitted on at most so many vectors; every vector is indexed.
FIT_VECTORS = 16_384
#: Vectors in a list on average, the most lists, and rows of a list or queries that meet in one task.
LIST_VECTORS = 256
MOST_LISTS = 4096
ROWS_PER_BLOCK = 4096
#: Lists that every query visits, if there are as many.
LISTS_LEAST = 16
#: Rows whose distances to the centroids are in memory at once.
ROWS_AT_ONCE = 1024


@dataclass
class Centroids:
    """Unit centroids with, for each, its nearest others: the graph that a search walks along."""

    points: np.ndarray
    links: np.ndarray
    entries: np.ndarray

    @classmethod
    def fit(cls, vectors: np.ndarray, lists: int, rounds: int = 12, degree: int = 16) -> Centroids:
        """Balanced spherical k-means: a list that has more than its share of the vectors attracts less."""
        lists = max(1, min(lists, len(vectors)))
        points = vectors[np.linspace(0, len(vectors) - 1, lists).astype(int)].copy()
        weight = np.zeros(lists)
        for _ in range(rounds):
            sums, counts = np.zeros_like(points), np.zeros(lists)
            for start in range(0, len(vectors), ROWS_AT_ONCE):
                part = vectors[start : start + ROWS_AT_ONCE]
                nearest = (part @ points.T - weight).argmax(axis=1)
                np.add.at(sums, nearest, part)
                counts += np.bincount(nearest, minlength=lists)
            length = np.linalg.norm(sums, axis=1, keepdims=True)
            points = np.where(length > 1e-9, sums / np.maximum(length, 1e-9), points)
            weight = np.clip(0.02 * (counts * lists / len(vectors) - 1), 0, 0.1)
        degree = min(degree, lists - 1)
        links = np.zeros((lists, degree), dtype=np.int64)
        for start in range(0, lists, ROWS_AT_ONCE):
            near = points[start : start + ROWS_AT_ONCE] @ points.T
            near[np.arange(len(near)), start + np.arange(len(near))] = -2
            links[start : start + ROWS_AT_ONCE] = np.argsort(-near, axis=1, kind="stable")[:, :degree]
        entries = np.unique(np.linspace(0, lists - 1, min(lists, 16)).astype(int))
        return cls(points.astype(np.float32), links, entries)

    def near(self, vectors: np.ndarray, ratio: float, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Distances to the centroids met (inf: not met), and the limit of `ratio` times the least, for each vector.

        Best-first walk for many vectors together: a centroid's neighbours are met as long as it is within the
        limit or among the `least` nearest so far.
        """
        n, lists = len(vectors), len(self.points)
        far = np.full((n, lists), np.inf, dtype=np.float32)
        walked = np.zeros((n, lists), dtype=bool)
        rows = np.arange(n)
        far[:, self.entries] = _distance(vectors @ self.points[self.entries].T)
        least = min(least, lists)
        while self.links.shape[1]:
            limit = np.maximum(far.min(axis=1) * ratio, np.partition(far, least - 1, axis=1)[:, least - 1])
            open_ = np.where(walked | (far > limit[:, None]), np.inf, far)
            step = min(4, lists)
            first = np.argpartition(open_, step - 1, axis=1)[:, :step]
            r, c = np.repeat(rows, step), first.ravel()
            go = np.isfinite(open_[r, c])
            r, c = r[go], c[go]
            if not len(r):
                break
            walked[r, c] = True
            new_r, new_c = np.repeat(r, self.links.shape[1]), self.links[c].ravel()
            new = ~np.isfinite(far[new_r, new_c])
            at = np.unique(new_r[new] * lists + new_c[new])
            new_r, new_c = at // lists, at % lists
            far[new_r, new_c] = _distance(np.einsum("ij,ij->i", vectors[new_r], self.points[new_c]))
        return far, far.min(axis=1) * ratio


def reach(far: np.ndarray, sizes: np.ndarray, rows: int, least: int, ratio: float) -> np.ndarray:
    """How far each query looks, for its distances to all lists and the rows that have each as their nearest.

    `ratio` times the distance within which lists of `rows` such rows lie, and as far as the `least` nearest lists.
    """
    order = np.argsort(far, axis=1, kind="stable")
    sorted_far = np.take_along_axis(far, order, axis=1)
    enough = np.cumsum(sizes[order], axis=1) >= min(rows, int(sizes.sum()))
    base = sorted_far[np.arange(len(far)), enough.argmax(axis=1)]
    return np.maximum(base * ratio, sorted_far[:, min(least, far.shape[1]) - 1])


def _distance(cosine: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * cosine, 1e-12))


def _matrix(column: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), dtype=np.float64).reshape(-1, dim)


def _unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def usable(vectors: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """`row, vec_id, vector` of the rows that can be compared, as a stage table.

    Dropped are vectors that are null, empty or zero, that hold null or non-finite components, or that have
    another number of components than most.
    """
    typed = vectors.select(
        F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector")
    ).where(
        F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("vector", lambda x: x != 0)
    )

    def number(batches):
        for batch, rows in numbered(batches):
            yield pa.RecordBatch.from_arrays([pa.array(rows), *batch.columns], ["row", *batch.schema.names])

    staged = stage(typed.mapInArrow(number, "row long, vec_id long, vector array<double>"), "vectors")
    size = F.size("vector").alias("size")
    common = staged.groupBy(size).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("size")).first()
    return staged if common is None else staged.where(F.size("vector") == common["size"])


def nearest(
    vectors: DataFrame, is_query, k: int = 5, vec_id: str = "vec_id", vector: str = "embedding",
    boundary: float = 1.08, copies: int = 4, ratio: float = 1.3,
) -> DataFrame:
    """`query_id, rank, vec_id, score`: for rows where `is_query` holds, the `k` nearest other rows found.

    Nearness is the cosine of the original vectors in double precision; ties go to the smaller id. Centroids
    are fitted on at most `FIT_VECTORS` vectors drawn by a digest. Every vector lies in the list of its nearest
    centroid and, near a boundary, in up to `copies` lists whose centroids are at most `boundary` times as far.
    A query visits the `LISTS_LEAST` nearest lists and those whose centroids are at most `ratio` times as far as
    the nearest lists that `LIST_VECTORS` rows, or more than `k`, have as their nearest; there is no cap on their
    number, so a query that is the centroid of a small list goes on to others. Lists and the queries that visit them meet in blocks of `ROWS_PER_BLOCK` each, so a
    list of very many equal vectors spreads over tasks and stays whole. Rows that `usable` drops are neither
    queries nor candidates; a row repeated is a row of its own. With fewer than `k` others in the table all are
    returned, and an empty table gives no rows.
    """
    rows = usable(vectors, vec_id, vector)
    total = rows.count()
    if not total:
        return rows.select(
            F.col("vec_id").alias("query_id"), F.lit(1).alias("rank"), "vec_id", F.lit(0.0).alias("score")
        ).limit(0)
    drawn = rows.orderBy(F.xxhash64("vec_id", "vector"), "vec_id").limit(FIT_VECTORS).select("vector").toArrow()
    dim = len(drawn["vector"][0])
    sample = np.unique(_unit(_matrix(drawn["vector"], dim)), axis=0)
    np.random.default_rng(3).shuffle(sample)
    centroids = Centroids.fit(sample, min(MOST_LISTS, -(-total // LIST_VECTORS)))

    def batches_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS_AT_ONCE):
                batch = whole.slice(start, ROWS_AT_ONCE)
                yield batch, _unit(_matrix(batch.column("vector"), dim)).astype(np.float32)

    def chosen(batch: pa.RecordBatch, far: np.ndarray, edge: np.ndarray) -> pa.RecordBatch:
        row, to = np.nonzero(far <= edge[:, None])
        out = batch.take(pa.array(row))
        first = pa.array(to == far.argmin(axis=1)[row])
        return pa.RecordBatch.from_arrays([pa.array(to.astype(np.int32)), first, *out.columns], ["list", "first", *out.schema.names])

    def copied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, unit in batches_of(batches):
            far, edge = centroids.near(unit, boundary, 16)
            most = min(copies, far.shape[1]) - 1
            yield chosen(batch, far, np.minimum(edge, np.partition(far, most, axis=1)[:, most]))

    schema = "list int, first boolean, row long, vec_id long, vector array<double>"
    lists = stage(rows.mapInArrow(copied, schema), "lists")
    sizes_of = np.zeros(len(centroids.points), dtype=np.int64)
    for r in lists.where("first").groupBy("list").count().collect():  # at most `MOST_LISTS`
        sizes_of[r["list"]] = r["count"]

    enough = max(LIST_VECTORS, k + 1)

    def visited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, unit in batches_of(batches):
            far = _distance(unit @ centroids.points.T)
            yield chosen(batch, far, reach(far, sizes_of, enough, LISTS_LEAST, ratio))

    asked = stage(rows.where(is_query).mapInArrow(visited, schema), "visits")

    def blocks(of: DataFrame, name: str) -> DataFrame:
        n = F.ceil(F.count(F.lit(1)) / ROWS_PER_BLOCK).cast("int")
        return of.groupBy("list").agg(n.alias(name))

    # One row for each list, at most `MOST_LISTS`.
    sizes = F.broadcast(blocks(lists, "list_blocks").join(blocks(asked, "query_blocks"), "list"))
    own = F.xxhash64("row")

    def dealt(of: DataFrame, mine: str, other: str) -> DataFrame:
        return (
            of.join(sizes, "list")
            .withColumn(mine, F.pmod(own, F.col(f"{mine}s")).cast("int"))
            .withColumn(other, F.explode(F.sequence(F.lit(0), F.col(f"{other}s") - 1)))
            .select("list", "list_block", "query_block", "row", "vec_id", "vector")
        )

    keys = ["list", "list_block", "query_block"]

    def best(found: pa.Table, queries: pa.Table) -> pa.Table:
        base, ask = _matrix(found["vector"], dim), _matrix(queries["vector"], dim)
        base_row, ask_row = found["row"].to_numpy(), queries["row"].to_numpy()
        base_id, ask_id = found["vec_id"].to_numpy(), queries["vec_id"].to_numpy()
        base_unit = _unit(base) if len(base) else base
        out = []
        for start in range(0, len(ask) if len(base) else 0, 256):
            part = ask[start : start + 256]
            near = _unit(part) @ base_unit.T
            near[base_row[None, :] == ask_row[start : start + 256, None]] = -np.inf
            at = min(k, near.shape[1])
            edge = np.partition(near, near.shape[1] - at, axis=1)[:, near.shape[1] - at]
            q, b = np.nonzero((near >= edge[:, None] - 1e-9) & np.isfinite(near))
            # Summed alike for every pair, so that equal vectors tie exactly.
            score = (part[q] * base[b]).sum(axis=1) / (
                np.sqrt((part[q] * part[q]).sum(axis=1)) * np.sqrt((base[b] * base[b]).sum(axis=1))
            )
            order = np.lexsort((base_id[b], -score, q))
            q, b, score = q[order], b[order], score[order]
            place = np.arange(len(q)) - np.searchsorted(q, q)
            keep = place < k
            out.append((start + q[keep], b[keep], score[keep]))
        q, b, score = (np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.zeros(0, int),) * 2 + (np.zeros(0),)
        return pa.table({"query": ask_row[q], "query_id": ask_id[q], "row": base_row[b], "vec_id": base_id[b], "score": score})

    met = dealt(lists, "list_block", "query_block").groupBy(*keys).cogroup(
        dealt(asked, "query_block", "list_block").groupBy(*keys)
    )
    found = met.applyInArrow(best, "query long, query_id long, row long, vec_id long, score double")
    # A vector found in several lists has one score.
    single = found.groupBy("query", "query_id", "row", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id", "row")
    return (
        single.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
