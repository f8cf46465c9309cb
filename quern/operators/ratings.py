"""Item-based recommendation.

Ratings are `user_id, item_id, rating` rows. A pair of items co-occurs once for every combination of
a row of one and a row of the other by the same user. The score of an item for a user is the sum,
over the user's ratings, of co-occurrence times rating.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from quern.functions import text as tx
from quern.operators.dense import MATRIX_AT_ONCE, dense_grid, dense_sums, is_filled, target_blocks
from quern.operators.grouping import large_groups, piece_of, replicate, with_pieces
from quern.operators.pages import pages
from quern.session import BROADCAST_BYTES, ROWS_PER_TASK, planned_with, row_bytes, shuffle_tasks, stage, tasks_for

#: Most items of one user that meet in one join group; more are dealt into pieces.
ITEMS_PER_PIECE = 4096
#: Products per task when all of a user's products meet in one task.
PRODUCTS_PER_USER_TASK = 1_000_000
#: Up to so many products stay rows in a grid with a filled matrix too, as for these no Python workers need to start.
FEW_PRODUCTS = 1_000_000
#: Most decimals to which products of a filled matrix are rounded outside Spark.
MOST_DECIMALS = 15
#: Cells of the score grid for each task, so that tasks come out alike.
CELLS_PER_TASK = 4
#: Rows that are dealt by cell meet on the cell and the item without being dealt again by both.
CELLS_MEET = {
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.requireAllClusterKeysForDistribution": "false",
}
#: Most entries in one list of the list views; longer lists continue in further pieces.
ENTRIES_PER_LIST = 100_000


def rating_totals(ratings: DataFrame) -> DataFrame:
    """One row per user and item: `user_id, item_id, copies, rating` with repeated rows summed.

    Both later steps are linear in the rows, so this changes no result, and it bounds every user's
    group by the number of distinct items.
    """
    return ratings.groupBy("user_id", "item_id").agg(
        F.count(F.lit(1)).alias("copies"), F.sum("rating").alias("rating")
    )


def item_pairs(totals: DataFrame, items_per_piece: int = ITEMS_PER_PIECE) -> DataFrame:
    """`item_a < item_b, cnt`: how often two items meet at one user.

    `totals` should be a stage table, as it is read several times. The count's shuffle follows
    `spark.sql.shuffle.partitions`; `pair_table` sizes it from the measured work.
    """
    return _pairs_and_tasks(totals, items_per_piece)[0]


def pair_table(totals: DataFrame, items_per_piece: int = ITEMS_PER_PIECE) -> DataFrame:
    """`item_pairs` as a stage table, counted in as many tasks as its products ask for."""
    pairs, tasks = _pairs_and_tasks(totals, items_per_piece)
    with shuffle_tasks(totals.sparkSession, tasks):
        return stage(pairs, "pairs")


def _pairs_and_tasks(totals: DataFrame, items_per_piece: int) -> tuple[DataFrame, int]:
    """The pairs, and the number of tasks that their products take.

    A user with more than
    `items_per_piece` items is dealt into pieces and every two pieces form their own join group, so
    the largest user is spread over many tasks. Pairs go straight into the map-side count; what is
    shuffled is the count per task, not the pairs.
    """
    per_user = totals.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    work, largest = per_user.agg(F.sum(F.col("n").cast("double") * F.col("n") / 2), F.max("n")).first()
    split = (largest or 0) > items_per_piece
    sizes = large_groups(per_user, "user_id", F.ceil(F.col("n") / items_per_piece)) if split else None

    rows = totals.select("user_id", "item_id", "copies")
    keys = ["user_id"]
    left, right = rows, rows
    if sizes is not None:
        dealt = with_pieces(rows, "user_id", sizes).withColumn("piece", piece_of("item_id"))
        keys = ["user_id", "left_piece", "right_piece"]
        left = replicate(dealt.withColumn("left_piece", F.col("piece")), "right_piece")
        right = replicate(dealt.withColumn("right_piece", F.col("piece")), "left_piece")
    tasks = tasks_for(totals.sparkSession, work or 0)
    left = left.repartition(tasks, *keys).select(
        *keys, F.col("item_id").alias("item_a"), F.col("copies").alias("copies_a")
    )
    right = right.repartition(tasks, *keys).select(
        *keys, F.col("item_id").alias("item_b"), F.col("copies").alias("copies_b")
    )
    pairs = (
        left.join(right, keys)
        .where("item_a < item_b")
        .groupBy("item_a", "item_b")
        .agg(F.sum(F.col("copies_a") * F.col("copies_b")).alias("cnt"))
    )
    return pairs, tasks


def mirror_pairs(pairs: DataFrame) -> DataFrame:
    """Both directions of every pair: `item_a, item_b, cnt`."""
    both = F.array(F.struct("item_a", "item_b"), F.struct(F.col("item_b").alias("item_a"), F.col("item_a").alias("item_b")))
    return pairs.select(F.explode(both).alias("p"), "cnt").select("p.item_a", "p.item_b", "cnt")


def _contribution(product_decimals: int | None) -> Column:
    product = F.col("cnt") * F.col("rating")
    return product if product_decimals is None else F.col("times") * F.round(product, product_decimals)


def _rated(ratings: DataFrame, totals: DataFrame, product_decimals: int | None) -> DataFrame:
    """The ratings side of the product. Rounded products are not linear, so equal ratings only merge."""
    if product_decimals is None:
        return totals.select("user_id", "item_id", "rating")
    return ratings.groupBy("user_id", "item_id", "rating").agg(F.count(F.lit(1)).alias("times"))


def _multiply(
    rated: DataFrame, matrix: DataFrame, product_decimals: int | None, broadcast_bytes: int, rows_per_task: int
) -> DataFrame:
    """`user_id, item_id, score, own`: summed products, and whether the user rated the item.

    `matrix` holds `item_a, item_b, cnt, own`; `own` is 1 on the diagonal, whose `cnt` is 0.
    """
    spark = rated.sparkSession
    matrix = matrix.withColumnRenamed("item_a", "item_id")
    widths = matrix.groupBy("item_id").agg(
        F.count(F.lit(1)).alias("width"), F.sum(row_bytes(matrix)).alias("size")
    )
    widest, size, entries, items = widths.agg(F.max("width"), F.sum("size"), F.sum("width"), F.count(F.lit(1))).first()
    filled = bool(entries) and is_filled(entries, items) and isinstance(rated.schema["rating"].dataType, DoubleType)

    if (size or 0) <= broadcast_bytes:
        # A user with n items puts n(n-1) entries into the matrix, so a matrix of this size also
        # bounds every user's summed rows. Dealt by user, they need no second shuffle for the sum,
        # and small tasks keep its hash table in the processor's cache.
        rows = matrix.groupBy("item_id").agg(F.collect_list(F.struct("item_b", "cnt", "own")).alias("row"))
        if product_decimals is not None:
            dense = matrix if filled and 0 <= product_decimals <= MOST_DECIMALS else None
            return _rounded_sums(rated, rows, widest or 0, product_decimals, rows_per_task, dense)
        products = rated.count() * (widest or 0)
        if filled:
            return dense_sums(rated, matrix, tasks_for(spark, products))
        tasks = tasks_for(spark, products, PRODUCTS_PER_USER_TASK)
        joined = rated.repartition(tasks, "user_id").join(F.broadcast(rows), "item_id").select("*", F.inline("row"))
        return _sum_products(joined, ["user_id"], None)
    if filled and product_decimals is None and rated.count() * widest > FEW_PRODUCTS:
        return filled_grid(rated, matrix, widths.select("item_id"), entries, rows_per_task)
    return grid_product(rated, matrix, widths, product_decimals, rows_per_task)


def filled_grid(
    rated: DataFrame, matrix: DataFrame, items: DataFrame, entries: int, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """The summed products for a well filled matrix of any size: cells as in `grid_product`, but products are not made as rows.

    The numbers of blocks come from the measured sizes: a block's columns of the matrix fit a task, and a cell has about
    `rows_per_task` sums. A user has at most one rating for each of the matrix's items, so no user has to be dealt further.
    """
    targets = items.count()
    ratings, users = rated.agg(F.count(F.lit(1)), F.approx_count_distinct("user_id")).first()
    cells = tasks_for(rated.sparkSession, users * targets, rows_per_task)
    user_blocks, blocks = grid(cells, ratings or 1, entries, targets)
    if blocks * MATRIX_AT_ONCE < targets * targets:
        blocks = -(-targets * targets // MATRIX_AT_ONCE)
        user_blocks = -(-cells // blocks)
    return dense_grid(rated, matrix, target_blocks(items, blocks), (user_blocks, blocks))


def _sum_products(joined: DataFrame, keys: list[str], product_decimals: int | None) -> DataFrame:
    return (
        joined.groupBy(*keys, "item_b")
        .agg(F.sum(_contribution(product_decimals)).alias("score"), F.max("own").alias("own"))
        .withColumnRenamed("item_b", "item_id")
    )


def _rounded_sums(
    rated: DataFrame, rows: DataFrame, widest: int, product_decimals: int, rows_per_task: int, dense: DataFrame | None = None
) -> DataFrame:
    """The sums of rounded products, dealt by user too, so that ratings are shuffled and products never.

    Different ratings of one item don't merge, so the matrix doesn't bound a user's rows: a user with more products than a
    task should make is dealt further by item, and only such users' sums are summed again. With a well filled matrix, `dense`,
    the products of all other users are not made as rows, unless they are few.
    """
    per_user = stage(rated.groupBy("user_id").agg(F.count(F.lit(1)).alias("ratings")), "ratings-per-user")
    total = per_user.agg(F.sum("ratings")).first()[0] or 0
    sizes = large_groups(per_user, "user_id", F.ceil(F.col("ratings") * widest / rows_per_task))
    dealt = with_pieces(rated, "user_id", sizes).withColumn("piece", piece_of("item_id"))
    tasks = tasks_for(rated.sparkSession, total * widest, PRODUCTS_PER_USER_TASK)

    def sums(some: DataFrame, *keys: str) -> DataFrame:
        joined = some.repartition(tasks, *keys).join(F.broadcast(rows), "item_id").select("*", F.inline("row"))
        return _sum_products(joined, [*keys], product_decimals)

    def sums_of_users(some: DataFrame) -> DataFrame:
        if dense is None or total * widest <= FEW_PRODUCTS:
            return sums(some, "user_id")
        return dense_sums(some, dense, tasks_for(rated.sparkSession, total * widest), product_decimals)

    if sizes is None:
        return sums_of_users(dealt)
    parts = sums(dealt.where("pieces > 1"), "user_id", "piece").groupBy("user_id", "item_id")
    whole = parts.agg(F.sum("score").alias("score"), F.max("own").alias("own"))
    return sums_of_users(dealt.where("pieces = 1")).unionByName(whole)


def grid_product(
    rated: DataFrame, matrix: DataFrame, widths: DataFrame, product_decimals: int | None, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """The summed products as a stage table, for a matrix of any size; `widths` has the entries of each item's row.

    Users and target items are dealt into blocks, and every pair of blocks is a cell of its own: it gets the ratings of its
    users and the matrix columns of its targets, and all products of one sum are made in one cell. So ratings are shuffled
    once for each target block and matrix entries once for each user block, and products never. The numbers of blocks come
    from the measured sizes of both sides. The ratings of a user with more products than a task should make are dealt
    further by item, and only such users' sums are summed again.
    """
    spark = rated.sparkSession
    work = stage(
        rated.join(widths, "item_id").groupBy("user_id").agg(
            F.sum(F.col("width").cast("double")).alias("products"), F.count(F.lit(1)).alias("ratings")
        ),
        "work",
    )
    products, ratings = work.agg(F.sum("products"), F.sum("ratings")).first()
    targets, entries = widths.agg(F.count(F.lit(1)), F.sum("width")).first()
    sizes = large_groups(work, "user_id", F.ceil(F.col("products") / rows_per_task))
    tasks = tasks_for(spark, products or 0, rows_per_task)
    user_blocks, target_blocks = grid(tasks * CELLS_PER_TASK, ratings or 1, entries or 1, targets or 1)
    cell = ["user_block", "target_block"]
    with planned_with(spark, CELLS_MEET):
        sums = stage(_cell_sums(rated, matrix, sizes, (user_blocks, target_blocks), tasks, product_decimals), "sums")
    if sizes is not None:
        whole = sums.where("pieces = 1").drop(*cell, "pieces")
        parts = sums.where("pieces > 1").groupBy("user_id", "item_id").agg(F.sum("score").alias("score"), F.max("own").alias("own"))
        return whole.unionByName(parts)
    return sums.drop(*cell, "pieces")


def grid(cells: int, ratings: int, entries: int, targets: int) -> tuple[int, int]:
    """User and target blocks for about so many cells, so that the fewest rows are copied: ratings go to every target
    block, matrix entries to every user block."""
    target_blocks = round((cells * entries / ratings) ** 0.5)
    target_blocks = max(1, min(target_blocks, targets, cells))
    return -(-cells // target_blocks), target_blocks


def _cell_sums(
    rated: DataFrame, matrix: DataFrame, sizes: DataFrame | None, blocks: tuple[int, int], tasks: int, product_decimals: int | None
) -> DataFrame:
    """Sums within cells. Planned with `CELLS_MEET`, both sides and the sum keep the partitioning by cell."""
    user_blocks, target_blocks = blocks
    dealt = with_pieces(rated, "user_id", sizes).withColumn("piece", piece_of("item_id"))
    left = dealt.withColumn("user_block", F.pmod(F.xxhash64("user_id", "piece"), F.lit(user_blocks)).cast("int")).withColumn(
        "target_block", F.explode(F.sequence(F.lit(0), F.lit(target_blocks - 1)))
    )
    right = matrix.withColumn("target_block", F.pmod(F.xxhash64("item_b"), F.lit(target_blocks)).cast("int")).withColumn(
        "user_block", F.explode(F.sequence(F.lit(0), F.lit(user_blocks - 1)))
    )
    cell = ["user_block", "target_block"]
    joined = left.repartition(tasks, *cell).join(right.repartition(tasks, *cell), [*cell, "item_id"])
    return (
        joined.groupBy(*cell, "user_id", "pieces", "item_b")
        .agg(F.sum(_contribution(product_decimals)).alias("score"), F.max("own").alias("own"))
        .withColumnRenamed("item_b", "item_id")
    )


def raw_scores(
    ratings: DataFrame,
    totals: DataFrame,
    pairs: DataFrame,
    product_decimals: int | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """`user_id, item_id, score` for every reachable item, rated ones included."""
    rated = _rated(ratings, totals, product_decimals)
    matrix = mirror_pairs(pairs).withColumn("own", F.lit(0))
    return _multiply(rated, matrix, product_decimals, broadcast_bytes, rows_per_task).drop("own")


def unseen_scores(
    ratings: DataFrame,
    totals: DataFrame,
    pairs: DataFrame,
    product_decimals: int | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """`user_id, item_id, score` for the items a user has not rated.

    The matrix gets one marker per item on its diagonal. A marked cell is one the user rated, so
    the sum that builds the scores also drops them and no anti join over all scores is needed.
    """
    rated = _rated(ratings, totals, product_decimals)
    matrix = mirror_pairs(pairs)
    marks = matrix.select("item_a").distinct().select(
        "item_a", F.col("item_a").alias("item_b"), F.lit(0).cast("long").alias("cnt"), F.lit(1).alias("own")
    )
    marked = matrix.withColumn("own", F.lit(0)).unionByName(marks)
    scored = _multiply(rated, marked, product_decimals, broadcast_bytes, rows_per_task)
    return scored.where("own = 0").drop("own")


def drop_seen(scores: DataFrame, ratings: DataFrame) -> DataFrame:
    """Scores without the cells a user has rated (J4), for score tables made elsewhere."""
    return scores.join(ratings.select("user_id", "item_id"), ["user_id", "item_id"], "left_anti")


def user_preferences(ratings: DataFrame, limit: int = ENTRIES_PER_LIST) -> DataFrame:
    """`user_id, piece, prefs`: the user's items and ratings in item order (A3).

    A list longer than `limit` continues in further pieces, in order, so no task gathers an unbounded list;
    repeated rows count like others.
    """
    return pages(ratings, "user_id", ["item_id", "rating"], "prefs", limit)


def item_raters(ratings: DataFrame, limit: int = ENTRIES_PER_LIST) -> DataFrame:
    """`item_id, piece, raters`: the same ratings seen from the items."""
    return pages(ratings, "item_id", ["user_id", "rating"], "raters", limit)


def matrix_rows(pairs: DataFrame, limit: int = ENTRIES_PER_LIST) -> DataFrame:
    """`item_a, piece, entries`: the co-occurrence matrix row by row (A5)."""
    return pages(mirror_pairs(pairs), "item_a", ["item_b", "cnt"], "entries", limit)


def list_to_text(lists: DataFrame, column: str) -> DataFrame:
    """Turn a list view's column into 'a:1,b:2' text."""
    left, right = lists.schema[column].dataType.elementType.names
    return lists.withColumn(column, tx.pairs_to_text(F.col(column), left, right))
