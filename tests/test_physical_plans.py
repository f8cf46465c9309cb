"""The shapes the plans must keep at scale."""
import re

import pytest
from pyspark.sql import functions as F

from quern.operators import postings as P
from quern.operators import ratings as R
from quern.operators import words
from quern.plans.analyses import word_count
from quern.session import stage, tasks_for


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_auto_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture
def totals(spark):
    rows = [(f"u{i % 20}", f"i{i % 7}", 1.0) for i in range(200)]
    return stage(R.rating_totals(spark.createDataFrame(rows, "user_id string, item_id string, rating double")), "t")


@pytest.fixture
def small_skew_limits(spark, no_auto_broadcast):
    limits = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {k: spark.conf.get(k, None) for k in limits}
    for key, value in limits.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value) if value is not None else spark.conf.unset(key)


def test_a_question_with_most_answers_is_split(spark, small_skew_limits):
    asked = spark.range(1, 201).selectExpr(
        "1 posting_type", "id", "cast(null as bigint) parent_id", "0 score", "'Security' tag"
    )
    given = spark.range(0, 40_000, 1, 8).selectExpr(
        "2 posting_type", "id + 1000 as id", "if(id % 3 = 0, 7, id % 200 + 1) as parent_id",
        "cast(id % 90 as int) score", "cast(null as string) tag"
    )
    joined = P.question_answers(asked.unionByName(given))
    assert joined.count() == 40_000
    joined.collect()
    assert "SortMergeJoin(skew=true)" in plan(joined)


def test_words_are_combined_before_their_one_shuffle(texts):
    text = plan(word_count(texts("a b"), ordered=False))
    assert text.count("Exchange hashpartitioning(word") == 1
    assert "partial_count" in text


def test_top_n_is_cut_before_the_shuffle(spark):
    df = spark.createDataFrame([("g", "w", 1)], "grp string, word string, cnt bigint")
    assert plan(words.top_n_per_group(df, "grp", 5)).count("WindowGroupLimit") == 2


def test_top_k_needs_no_full_sort(spark):
    df = spark.createDataFrame([("w", 1)], "word string, cnt bigint")
    assert "TakeOrderedAndProject" in plan(words.top_k(df))


def test_common_words_need_one_shuffle_and_no_join(texts):
    text = plan(words.common_words_of(texts("a").toDF("word"), texts("a").toDF("word")))
    assert text.count("Exchange") == 1 and "Join" not in text


def test_scores_meet_a_broadcast_matrix_without_a_second_shuffle(totals):
    text = plan(R.unseen_scores(totals, totals, stage(R.item_pairs(totals), "p")))
    assert "BroadcastHashJoin" in text
    assert sum("Exchange hashpartitioning(user_id" in line for line in text.splitlines()) == 1


def test_rounded_scores_are_summed_without_a_shuffle_of_products(totals):
    pairs = stage(R.item_pairs(totals), "p")
    text = plan(R.unseen_scores(totals.withColumn("rating", F.col("rating") / 3), totals, pairs, 6))
    assert "BroadcastHashJoin" in text
    above = text[: text.index("BroadcastHashJoin")]
    assert "Exchange" not in above and "HashAggregate" in above


def test_large_matrix_is_joined_by_cell_and_item(spark, totals, no_auto_broadcast, monkeypatch):
    pairs = stage(R.item_pairs(totals), "p")
    plans_of = {}
    real = R.stage

    def seen(df, label):
        plans_of[label] = plan(df)
        return real(df, label)

    monkeypatch.setattr(R, "stage", seen)
    R.unseen_scores(totals, totals, pairs, broadcast_bytes=0, rows_per_task=10)
    text = plans_of["sums"]
    assert "SortMergeJoin [user_block" in text and "CartesianProduct" not in text
    above = text[: text.index("SortMergeJoin")]
    assert "Exchange" not in above and "HashAggregate" in above



def test_cells_have_as_many_tasks_as_their_products_ask_for(spark, totals, no_auto_broadcast, monkeypatch):
    pairs = R.pair_table(totals)
    products = sum(r["n"] * (r["n"] - 1) for r in totals.groupBy("user_id").agg(F.count("*").alias("n")).collect())
    plans_of = {}
    real = R.stage

    def seen(df, label):
        plans_of[label] = plan(df)
        return real(df, label)

    monkeypatch.setattr(R, "stage", seen)
    R.unseen_scores(totals, totals, pairs, broadcast_bytes=0, rows_per_task=10)
    found = re.findall(r"Exchange hashpartitioning\(user_block#\d+, target_block#\d+, (\d+)\)", plans_of["sums"])
    assert len(found) == 2 and len(set(found)) == 1 and int(found[0]) >= products / 10



def test_pairs_are_counted_in_as_many_tasks_as_their_products_ask_for(spark, totals, monkeypatch):
    seen = []
    monkeypatch.setattr(R, "stage", lambda df, label: seen.append(spark.conf.get("spark.sql.shuffle.partitions")))
    monkeypatch.setattr(R, "tasks_for", lambda session, rows: 77)
    R.pair_table(totals)
    assert seen == ["77"] and spark.conf.get("spark.sql.shuffle.partitions") == "4"


def test_the_most_tasks_are_a_setting(spark):
    assert tasks_for(spark, 1e15) == 20_000
    spark.conf.set("spark.quern.most.tasks", "30000")
    assert tasks_for(spark, 1e15) == 30_000
    spark.conf.unset("spark.quern.most.tasks")


def test_pairs_join_within_users_only(totals, no_auto_broadcast):
    text = plan(R.item_pairs(totals))
    assert "SortMergeJoin [user_id" in text and "partial_sum" in text
    assert "CartesianProduct" not in text and "NestedLoop" not in text
