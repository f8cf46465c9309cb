from quern.operators import compare

SCORES = "user_id int, item_id int, score double"


def test_result_diff_is_a_bag_difference(spark):
    left = spark.createDataFrame([(1, 2, 3.0), (1, 2, 3.0), (4, 5, 6.0)], SCORES)
    right = spark.createDataFrame([(1, 2, 3.0), (4, 5, 6.5)], SCORES)
    assert sorted(map(tuple, compare.result_diff(left, right).collect())) == [
        ("actual only", 4, 5, 6.5, 1), ("expected only", 1, 2, 3.0, 1), ("expected only", 4, 5, 6.0, 1)
    ]


def test_verdict(spark):
    scores = spark.createDataFrame([(1, 2, 3.0), (4, 5, 6.0)], SCORES)
    turned = spark.createDataFrame([(5, 4, 6.0), (2, 1, 3.0)], SCORES)
    other = spark.createDataFrame([(1, 2, 3.0)], SCORES)
    assert compare.result_verdict(scores, scores.orderBy("score", ascending=False)) == "same"
    assert compare.result_verdict(scores, turned) == "swapped"
    assert compare.result_verdict(scores, other) == "different"


def top(spark, *rows):
    return spark.createDataFrame(list(rows), "cnt bigint, word string")


def statuses(expected, actual):
    return {r["cnt"]: r["status"] for r in compare.top_k_diff(expected, actual).collect()}


def test_ties_may_be_ordered_and_cut_differently(spark):
    expected = top(spark, (9, "a"), (8, "b"), (8, "c"), (7, "d"), (7, "e"))
    actual = top(spark, (9, "a"), (8, "c"), (8, "b"), (7, "e"))
    assert set(statuses(expected, actual).values()) == {"ok"}


def test_each_kind_of_difference(spark):
    expected = top(spark, (9, "a"), (8, "b"), (7, "c"))
    actual = top(spark, (9, "x"), (7, "y"), (6, "c"))
    assert statuses(expected, actual) == {
        9: "words differ", 8: "missing count", 7: "not a subset", 6: "unexpected count"
    }


def test_order_breaks(spark):
    ranked = spark.createDataFrame([(1, 9), (2, 9), (3, 4), (4, 6)], "rank int, cnt bigint")
    assert [tuple(r) for r in compare.order_breaks(ranked).collect()] == [(4, 6, 4)]


def test_top_k_verdict(spark):
    expected = top(spark, (9, "a"), (8, "b"), (8, "c"))

    def verdict(*rows):
        return compare.top_k_verdict(expected, spark.createDataFrame(list(rows), "rank int, cnt bigint, word string"))

    assert verdict((1, 9, "a"), (2, 8, "c")) == "passed"
    assert verdict((1, 8, "c"), (2, 9, "a")) == "wrong order"
    assert verdict((1, 9, "a"), (2, 8, "c"), (3, 7, "d")) == "too long"
    assert verdict((1, 9, "x"), (2, 8, "c")) == "wrong words"
    assert verdict((1, 9, "a")) == "wrong words"
