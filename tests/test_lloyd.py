import random
import statistics

import pytest
from pyspark.sql import functions as F

from quern import plans
from quern.operators import lloyd


def cut(a, b):
    """Integer division toward zero."""
    return abs(a) // b * (1 if a >= 0 else -1)


def closest(p, centers):
    return min(range(len(centers)), key=lambda i: ((p[0] - centers[i][0]) ** 2 + (p[1] - centers[i][1]) ** 2, i))


def brute_fit(points, centers, eta, most):
    totals = []
    while True:
        groups = {}
        for p in points:
            groups.setdefault(closest(p, centers), []).append(p)
        new = list(centers)
        for i, held in groups.items():
            new[i] = tuple(cut(sum(p[axis] for p in held), len(held)) for axis in (0, 1))
        total = float(sum((a - c) ** 2 + (b - d) ** 2 for (a, b), (c, d) in zip(centers, new)))
        totals.append(total)
        centers = new
        if total < eta or len(totals) >= most:
            return centers, totals


def brute_summary(points, centers):
    groups = {}
    for p in points:
        groups.setdefault(closest(p, centers), []).append(p[1])
    out = []
    for i, ys in groups.items():
        ys.sort()
        lower, upper = ys[(len(ys) - 1) // 2], ys[len(ys) // 2]
        out.append((*centers[i], len(ys), cut(lower + upper, 2), cut(sum(ys), len(ys))))
    return sorted(out)


def weighted(spark, points):
    return lloyd.weigh_points(spark.createDataFrame(points, "x bigint, y bigint"))


def random_points(seed, n=200):
    rng = random.Random(seed)
    return [(rng.choice([50_000, 100_000, 150_000]), rng.randrange(-40, 60)) for _ in range(n)]


@pytest.mark.parametrize("seed", range(3))
def test_fit_and_summary_equal_brute_force(spark, seed):
    points = random_points(seed)
    start = random.Random(seed).sample(points, 7)
    fit = lloyd.fit(weighted(spark, points), start, eta=20.0, max_iterations=50)
    centers, totals = brute_fit(points, start, 20.0, 50)
    assert fit.centers == centers
    assert fit.iterations == len(totals) and fit.converged == (totals[-1] < 20.0)
    assert sorted({(r[0], r[7]) for r in fit.history}) == list(enumerate(totals, 1))
    assert [tuple(r) for r in lloyd.summary(weighted(spark, points), fit.centers).collect()] == brute_summary(
        points, centers
    )


def test_equal_starts_leave_empty_clusters_where_they_are(spark):
    points = [(0, -3), (0, -4), (10, 5)]
    fit = lloyd.fit(weighted(spark, points), [(0, 0), (0, 0), (9, 5)], eta=0.0, max_iterations=1)
    assert fit.centers == [(0, -3), (0, 0), (10, 5)]
    assert [r["size"] for r in lloyd.summary(weighted(spark, points), [(0, -3), (0, -3), (10, 5)]).collect()] == [2, 1]


@pytest.mark.parametrize("many", [False, True])
def test_ties_go_to_the_lowest_index(spark, many):
    points = spark.createDataFrame([(5, 0), (5, 1)], "x bigint, y bigint")
    found = lloyd.assign(points, [(10, 0), (0, 0), (10, 0)], many).orderBy("y").collect()
    assert [(r["idx"], r["dist"]) for r in found] == [(0, 25.0), (0, 26.0)]


def test_both_forms_of_the_nearest_centre_agree(spark):
    points = spark.createDataFrame(random_points(9), "x bigint, y bigint")
    centers = random_points(10, 30)
    few, many = (sorted(lloyd.assign(points, centers, m).collect()) for m in (False, True))
    assert few == many


def test_compiled_path_gives_the_same_fit(spark, monkeypatch):
    points = random_points(4)
    start = points[:5]
    plain = lloyd.fit(weighted(spark, points), start)
    monkeypatch.setattr(lloyd, "FEW_POINTS", 0)
    assert lloyd.fit(weighted(spark, points), start).centers == plain.centers


def test_median_over_wide_and_negative_values(spark):
    rng = random.Random(1)
    groups = {g: [rng.randrange(-(2**31), 2**31) for _ in range(n)] for g, n in ((1, 1), (2, 2), (3, 31), (4, 100))}
    groups[5] = [-3, -4]
    groups[6] = [2**17, -(2**17) - 1, 7, 7]
    rows = spark.createDataFrame([(g, y) for g, ys in groups.items() for y in ys], "g int, y bigint")
    counts = rows.groupBy("g", "y").agg(F.count("*").alias("n"))
    found = {r["g"]: r["median"] for r in lloyd.integer_median(counts, "g").collect()}
    low = {g: statistics.median_low(ys) + statistics.median_high(ys) for g, ys in groups.items()}
    assert found == {g: cut(s, 2) for g, s in low.items()}


@pytest.mark.parametrize("k", [1, 3, 7, 500])
def test_ordered_start_takes_even_ranks(spark, k):
    points = random_points(5)
    distinct = sorted(set(points))
    k_used = min(k, len(distinct))
    expected = [distinct[i * len(distinct) // k_used] for i in range(k_used)]
    assert lloyd.points_at_ranks(weighted(spark, points), k) == expected


def test_sample_does_not_depend_on_partitioning(spark):
    df = spark.createDataFrame([(i, i * 10, -i) for i in range(100)], "id bigint, x bigint, y bigint")
    one = lloyd.sampled_centers(df.coalesce(1), 10, seed=3)
    assert one == lloyd.sampled_centers(df.repartition(7), 10, seed=3)
    assert len(set(one)) == 10 and one != lloyd.sampled_centers(df, 10, seed=4)
    assert len(lloyd.sampled_centers(df, 1000, seed=3)) == 100


def test_history(spark):
    fit = lloyd.fit(weighted(spark, [(0, 0), (0, 4), (9, 9)]), [(0, 0), (9, 9)], eta=1.0)
    rows = [tuple(r) for r in fit.history_df(spark).orderBy("iter", "idx").collect()]
    assert rows == [
        (1, 0, 0, 0, 0, 2, 4.0, 4.0, False, False), (1, 1, 9, 9, 9, 9, 0.0, 4.0, False, False),
        (2, 0, 0, 2, 0, 2, 0.0, 0.0, True, False), (2, 1, 9, 9, 9, 9, 0.0, 0.0, True, False),
    ]


@pytest.mark.parametrize("most, expected", [(1, [(1, False, True)]), (2, [(1, False, False), (2, True, True)])])
def test_history_marks_the_last_iteration_allowed(spark, most, expected):
    fit = lloyd.fit(weighted(spark, [(0, 0), (0, 4), (9, 9)]), [(0, 0), (9, 9)], eta=1.0, max_iterations=most)
    found = fit.history_df(spark).select("iter", "converged", "reached_max").distinct().collect()
    assert sorted(map(tuple, found)) == expected


@pytest.mark.parametrize("init", ["sample", "ordered"])
def test_cluster_postings_end_to_end(spark, texts, init):
    lines = [f"1,{i},,0,{'Security' if i % 2 else 'Algorithm'}" for i in range(1, 21)]
    lines += [f"2,{100 + i},{i},{i % 5 - 2}," for i in range(1, 21)]
    found = plans.cluster_postings(texts(*lines), clusters=3, init=init, seed=1)
    summary = found.summary.collect()
    assert sum(r["size"] for r in summary) == 20
    assert found.fit.converged and found.history.count() == 3 * found.fit.iterations
    assert [tuple(r) for r in summary] == brute_summary(
        [(300_000 if i % 2 else 150_000, i % 5 - 2) for i in range(1, 21)], found.fit.centers
    )


@pytest.mark.parametrize("init", ["sample", "ordered"])
def test_no_points_give_no_clusters(texts, init):
    found = plans.cluster_postings(texts("1,1,,0,Security"), init=init)
    assert found.summary.collect() == [] and found.history.collect() == [] and found.fit.centers == []


def test_summary_types(spark):
    frame = lloyd.summary(weighted(spark, [(0, 0)]), [(0, 0)])
    assert ", ".join(f"{n} {t}" for n, t in frame.dtypes) == lloyd.SUMMARY_SCHEMA


def test_refusals(spark, texts):
    with pytest.raises(ValueError):
        lloyd.fit(weighted(spark, [(0, 0)]), [])
    with pytest.raises(ValueError):
        plans.cluster_postings(texts("1,1,,0,Security"), init="random")
