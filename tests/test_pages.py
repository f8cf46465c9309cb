import collections
import random

import pytest

from quern.operators import pages as P

SCHEMA = "k string, e string, v double"


def made(seed, n, keys, hot=0.3):
    r = random.Random(seed)
    names = [None, *[f"k{i}" for i in range(keys)]]
    return [
        ("k0" if r.random() < hot else r.choice(names), r.choice([None, f"e{r.randrange(60)}"]), r.randrange(5) / 2)
        for _ in range(n)
    ]


def wanted(rows, limit):
    by = collections.defaultdict(list)
    for k, e, v in rows:
        by[k].append((e, v))
    found = []
    for k, entries in by.items():
        entries.sort(key=lambda x: (x[0] is not None, x[0] or "", x[1]))
        found += [(k, i // limit, entries[i : i + limit]) for i in range(0, len(entries), limit)]
    return sorted(found, key=repr)


def found(df, limit):
    rows = P.pages(df, "k", ["e", "v"], "l", limit).collect()
    return sorted(((r["k"], r["piece"], [tuple(x) for x in r["l"]]) for r in rows), key=repr)


@pytest.fixture
def small_batches(spark):
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "13")
    yield
    spark.conf.set(setting, before)


@pytest.mark.parametrize(("n", "keys", "limit"), [(2000, 5, 17), (1500, 300, 4), (500, 1, 7), (3, 3, 5), (900, 40, 10**6), (0, 1, 3)])
def test_pages_are_those_of_sorted_lists(spark, small_batches, n, keys, limit):
    rows = made(n, n, keys)
    assert found(spark.createDataFrame(rows, SCHEMA), limit) == wanted(rows, limit)


def test_one_key_over_all_partitions(spark, small_batches):
    rows = made(1, 1200, 2, hot=1.0)
    df = spark.createDataFrame(rows, SCHEMA)
    assert found(df, 100) == wanted(rows, 100)


def test_equal_rows_fill_pages(spark):
    rows = [("a", "x", 1.0)] * 250 + [(None, None, 0.0)] * 25
    assert found(spark.createDataFrame(rows, SCHEMA), 20) == wanted(rows, 20)


def test_rows_are_shuffled_once(spark, tmp_path):
    """All rows pass one exchange, by range; the page table's own plan has no other."""
    plan = []
    stage = P.stage
    try:
        P.stage = lambda df, label: plan.append(df._jdf.queryExecution().executedPlan().toString()) or stage(df, label)
        result = P.pages(spark.createDataFrame(made(2, 100, 9), SCHEMA), "k", ["e"], "l", 10)
    finally:
        P.stage = stage
    assert plan[0].count("Exchange") == 1 and "rangepartitioning" in plan[0]
    whole = result._jdf.queryExecution().optimizedPlan().toString()
    assert whole.count("MapInArrow") == 0
