import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from quern import plans
from quern.operators import dense
from quern.operators import ratings as R
from quern.session import stage

SCHEMA = "user_id string, item_id string, rating double"
HAND_MADE = [("u1", "a", 4.0), ("u1", "b", 2.0), ("u2", "b", 3.0), ("u2", "c", 1.0), ("u3", "a", 1.0)]


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def as_set(df):
    return sorted(map(tuple, df.collect()))


def brute_pairs(rows):
    by_user = defaultdict(list)
    for u, i, _ in rows:
        by_user[u].append(i)
    return Counter((a, b) for items in by_user.values() for a in items for b in items if a != b)


def brute_scores(rows, unseen=True, decimals=None):
    cooc = brute_pairs(rows)
    seen = {(u, i) for u, i, _ in rows}
    scores = defaultdict(float)
    for u, i, r in rows:
        for (a, b), n in cooc.items():
            if a == i:
                scores[u, b] += n * r if decimals is None else round(n * r, decimals)
    return sorted((u, b, s) for (u, b), s in scores.items() if not unseen or (u, b) not in seen)


def skewed(seed=3, users=12, items=9):
    rng = random.Random(seed)
    rows = [
        (f"u{rng.randrange(users)}", f"i{rng.randrange(items)}", rng.randrange(10) / 2) for _ in range(120)
    ]
    return rows + [("hot", f"i{k % items}", 1.5) for k in range(60)] + [(f"v{k}", "i0", 2.0) for k in range(40)]


def test_hand_made_stages(spark):
    rated = frame(spark, HAND_MADE)
    totals = stage(R.rating_totals(rated), "t")
    pairs = stage(R.item_pairs(totals), "p")
    assert as_set(R.mirror_pairs(pairs)) == [("a", "b", 1), ("b", "a", 1), ("b", "c", 1), ("c", "b", 1)]
    assert as_set(R.raw_scores(rated, totals, pairs)) == [
        ("u1", "a", 2.0), ("u1", "b", 4.0), ("u1", "c", 2.0),
        ("u2", "a", 3.0), ("u2", "b", 1.0), ("u2", "c", 3.0), ("u3", "b", 1.0),
    ]
    assert as_set(plans.recommend_scores(rated)) == [("u1", "c", 2.0), ("u2", "a", 3.0), ("u3", "b", 1.0)]


def test_zero_scores_are_kept_and_lonely_items_give_nothing(spark):
    rows = [("u1", "a", 0.0), ("u2", "a", 1.0), ("u2", "b", 1.0), ("u3", "solo", 5.0)]
    assert as_set(plans.recommend_scores(frame(spark, rows))) == [("u1", "b", 0.0)]


def test_no_ratings_give_no_scores(spark):
    assert plans.recommend_scores(frame(spark, [])).collect() == []


def test_repeated_ratings_multiply(spark):
    rows = [("u1", "a", 1.0), ("u1", "a", 2.0), ("u1", "b", 1.0), ("u2", "a", 1.0)]
    totals = stage(R.rating_totals(frame(spark, rows)), "t")
    assert as_set(R.item_pairs(totals)) == [("a", "b", 2)]
    assert as_set(plans.recommend_scores(frame(spark, rows))) == brute_scores(rows) == [("u2", "b", 2.0)]


@pytest.mark.parametrize("per_piece", [1, 2, 4096])
def test_pairs_equal_brute_force_however_users_are_dealt(spark, per_piece):
    rows = skewed()
    totals = stage(R.rating_totals(frame(spark, rows)), "t")
    found = R.mirror_pairs(R.item_pairs(totals, items_per_piece=per_piece))
    assert {(a, b): n for a, b, n in as_set(found)} == dict(brute_pairs(rows))


@pytest.mark.parametrize("broadcast_bytes,rows_per_task", [(1 << 26, 10), (0, 7), (0, 20_000_000)])
@pytest.mark.parametrize("decimals", [None, 6])
def test_scores_equal_brute_force_on_every_join_path(spark, broadcast_bytes, rows_per_task, decimals):
    rows = skewed()
    rated = frame(spark, rows)
    totals = stage(R.rating_totals(rated), "t")
    pairs = stage(R.item_pairs(totals), "p")
    args = (rated, totals, pairs, decimals, broadcast_bytes, rows_per_task)
    assert as_set(R.unseen_scores(*args)) == brute_scores(rows, decimals=decimals)
    raw = R.raw_scores(*args)
    assert as_set(raw) == brute_scores(rows, unseen=False, decimals=decimals)
    assert as_set(R.drop_seen(raw, rated)) == brute_scores(rows, decimals=decimals)


def test_rounded_products(spark):
    rows = [("u1", "a", 0.1234567), ("u2", "a", 1.0), ("u2", "b", 1.0)]
    assert as_set(plans.recommend_scores(frame(spark, rows), product_decimals=6)) == [("u1", "b", 0.123457)]


def test_list_views(spark):
    rated = frame(spark, HAND_MADE)
    assert as_set(R.list_to_text(R.user_preferences(rated), "prefs")) == [
        ("u1", 0, "a:4.0,b:2.0"), ("u2", 0, "b:3.0,c:1.0"), ("u3", 0, "a:1.0")
    ]
    assert as_set(R.list_to_text(R.item_raters(rated), "raters")) == [
        ("a", 0, "u1:4.0,u3:1.0"), ("b", 0, "u1:2.0,u2:3.0"), ("c", 0, "u2:1.0")
    ]
    pairs = R.item_pairs(stage(R.rating_totals(rated), "t"))
    assert as_set(R.list_to_text(R.matrix_rows(pairs), "entries")) == [
        ("a", 0, "b:1"), ("b", 0, "a:1,c:1"), ("c", 0, "b:1")
    ]


def test_long_lists_continue_in_pieces_and_stay_whole(spark):
    rated = frame(spark, skewed())
    rated = rated.union(rated.where("item_id = 'i0'").limit(1).crossJoin(spark.range(35)).select(*rated.columns))
    lists = sorted(R.item_raters(rated, limit=10).collect(), key=lambda r: (r["item_id"], r["piece"]))
    for item in {r["item_id"] for r in lists}:
        pages = [r for r in lists if r["item_id"] == item]
        assert [r["piece"] for r in pages] == list(range(len(pages)))
        assert all(len(r["raters"]) == 10 for r in pages[:-1]) and len(pages[-1]["raters"]) <= 10
        users = [e["user_id"] for r in pages for e in r["raters"]]
        assert users == sorted(users)
    assert len([r for r in lists if r["item_id"] == "i0"]) > 1
    got = sorted((e["user_id"], r["item_id"], e["rating"]) for r in lists for e in r["raters"])
    assert got == sorted(map(tuple, rated.collect()))


@pytest.mark.parametrize(("rows_per_task", "decimals"), [(5_000_000, None), (40, None), (7, None), (40, 1), (7, 1)])
def test_grid_equals_brute_force_however_it_is_dealt(spark, rows_per_task, decimals):
    rows = skewed()
    rated = stage(frame(spark, rows), "r")
    totals = stage(R.rating_totals(rated), "t")
    pairs = R.pair_table(totals)
    found = R.unseen_scores(rated, totals, pairs, decimals, broadcast_bytes=0, rows_per_task=rows_per_task)
    assert as_set(found) == brute_scores(rows, decimals=decimals)
    found = R.raw_scores(rated, totals, pairs, decimals, broadcast_bytes=0, rows_per_task=rows_per_task)
    assert as_set(found) == brute_scores(rows, unseen=False, decimals=decimals)


def test_grid_blocks_copy_few_rows():
    for cells, ratings, entries, targets in ((64, 10**6, 10**6, 5000), (64, 10**8, 10**3, 50), (7, 10, 10**9, 3), (1, 1, 1, 1)):
        users, blocks = R.grid(cells, ratings, entries, targets)
        assert users * blocks >= cells and 1 <= blocks <= targets
        best = min(ratings * b + entries * -(-cells // b) for b in range(1, min(cells, targets) + 1))
        assert ratings * blocks + entries * users <= 2 * best


def test_products_are_not_shuffled(spark):
    """Above the product join there is no exchange: cells hold whole sums."""
    from pyspark.sql import functions as F

    from quern.session import planned_with

    totals = stage(R.rating_totals(frame(spark, skewed())), "t")
    matrix = R.mirror_pairs(R.pair_table(totals)).withColumn("own", F.lit(0)).withColumnRenamed("item_a", "item_id")
    settings = {**R.CELLS_MEET, "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    with planned_with(spark, settings):
        sums = R._cell_sums(totals.select("user_id", "item_id", "rating"), matrix, None, (3, 2), 4, None)
        plan = sums._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 2
    assert plan.index("SortMergeJoin") < plan.index("Exchange")
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"


def test_filled_matrix_gives_the_same_scores_as_rows_of_products(spark, monkeypatch):
    """Nulls, infinities and users without an id included; a well filled matrix is multiplied in batches of users."""
    rng = [(f"u{i % 9}" if i % 9 else None, f"i{(i * i) % 11}", [1.5, 0.1, None, float("inf"), 3.0][i % 5]) for i in range(150)]
    totals = stage(R.rating_totals(frame(spark, rng)), "t")
    pairs = R.pair_table(totals)
    show = lambda df: sorted((str(r[0]), r[1], None if r[2] is None else f"{r[2]:.9g}") for r in df.collect())
    dense = [R.raw_scores(totals, totals, pairs), R.unseen_scores(totals, totals, pairs)]
    assert all("MapInArrow" in df._jdf.queryExecution().executedPlan().toString() for df in dense)
    monkeypatch.setattr(R, "is_filled", lambda entries, items: False)
    plain = [R.raw_scores(totals, totals, pairs), R.unseen_scores(totals, totals, pairs)]
    assert [show(df) for df in dense] == [show(df) for df in plain] and len(show(dense[0])) > 50


@pytest.mark.parametrize("matrix_at_once", [4_000_000, 30])
def test_filled_grid_gives_the_same_scores_as_rows_of_products(spark, monkeypatch, matrix_at_once):
    """A filled matrix that isn't broadcast: users and targets in several blocks, batches cut anywhere, several cells in a task."""
    from quern.session import planned_with

    some = [(f"u{i % 9}" if i % 9 else None, f"i{(i * i) % 11}", [1.5, 0.1, None, float("inf"), 3.0][i % 5]) for i in range(150)]
    some += [("u1", None, 1.0), ("alone", "solo", 1.0), ("nan", "i4", float("nan")), ("null", "i4", None)]
    totals = stage(R.rating_totals(frame(spark, some)), "t")
    pairs = R.pair_table(totals)
    show = lambda df: sorted((str(r[0]), r[1], None if r[2] is None else f"{r[2]:.9g}") for r in df.collect())
    monkeypatch.setattr(R, "MATRIX_AT_ONCE", matrix_at_once)
    monkeypatch.setattr(R, "FEW_PRODUCTS", 0)
    settings = {"spark.sql.execution.arrow.maxRecordsPerBatch": "7", "spark.quern.most.tasks": "5"}
    with planned_with(spark, settings):
        filled = [f(totals, totals, pairs, broadcast_bytes=0, rows_per_task=3) for f in (R.raw_scores, R.unseen_scores)]
        plans_of = [df._jdf.queryExecution().executedPlan().toString() for df in filled]
        found = [show(df) for df in filled]
    assert all("MapInArrow" in plan and "ShuffledHashJoin" not in plan for plan in plans_of)
    monkeypatch.setattr(R, "is_filled", lambda entries, items: False)
    plain = [f(totals, totals, pairs, broadcast_bytes=0) for f in (R.raw_scores, R.unseen_scores)]
    assert found == [show(df) for df in plain] and len(found[0]) > 50


def test_filled_grid_places_every_item_in_a_block(spark, monkeypatch):
    """Blocks of the matrix are as many as a task's share asks for."""
    seen = []
    monkeypatch.setattr(R, "dense_grid", lambda rated, matrix, items, blocks: seen.append((items.collect(), blocks)) or rated)
    monkeypatch.setattr(R, "MATRIX_AT_ONCE", 30)
    totals = stage(R.rating_totals(frame(spark, skewed())), "t")
    matrix = R.mirror_pairs(R.pair_table(totals)).withColumnRenamed("item_a", "item_id")
    R.filled_grid(totals, matrix, matrix.select("item_id").distinct(), matrix.count(), 50)
    items, (users, blocks) = seen[0]
    assert blocks * 30 >= len(items) ** 2 and users >= 1
    assert len({(r["target_block"], r["at"]) for r in items}) == len(items) == 9
    assert {r["target_block"] for r in items} <= set(range(blocks))


@pytest.mark.parametrize("rows_per_task", [5_000_000, 200])
def test_rounded_products_of_a_filled_matrix_are_not_made_as_rows(spark, monkeypatch, rows_per_task):
    """Also beside a user with too many products, repeated and different ratings of an item, and null, infinite and NaN ones."""
    odd = [("odd", "i1", None), ("odd", "i2", 0.125), ("none", "i3", None), ("inf", "i2", float("inf")), ("inf", "i4", 1.25)]
    rows = [*skewed(), *odd, ("nan", "i5", float("nan")), *((f"m{k % 3}", f"i{k % 9}", k / 16) for k in range(90))]
    rated = stage(frame(spark, rows), "r")
    totals = stage(R.rating_totals(rated), "t")
    pairs = R.pair_table(totals)
    args = (rated, totals, pairs, 1, 1 << 26, rows_per_task)
    as_rows = as_set(R.unseen_scores(*args).fillna(-1.0))
    monkeypatch.setattr(R, "FEW_PRODUCTS", 0)
    found = R.unseen_scores(*args)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan and ("inline" in plan) == (rows_per_task == 200)
    assert [r[:2] for r in as_rows] == [r[:2] for r in as_set(found.fillna(-1.0))]
    assert [r[2] for r in as_set(found.fillna(-1.0))] == pytest.approx([r[2] for r in as_rows], nan_ok=True)


def test_products_are_rounded_as_by_spark(spark):
    rng = random.Random(1)
    values = [k / 8 for k in range(-40, 40)] + [k / 1000 for k in range(2000)] + [rng.uniform(-1e6, 1e6) for _ in range(500)]
    values += [rng.randrange(10**7) / 10**6 * rng.randrange(99) for _ in range(2000)] + [2.675, 1.005, 1e22 / 3, 4e15 + 0.5, 1e-9]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for decimals in (0, 1, 2, 6, 15):
        expected = [r[0] for r in df.select(F.round("v", decimals)).collect()]
        assert dense.round_half_up(np.array(values), decimals).tolist() == expected
