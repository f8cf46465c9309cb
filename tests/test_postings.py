import pytest

from quern.operators import postings as P
from quern.plans.analyses import posting_points
from quern.sources.readers import parse_postings

LINES = [
    "1,9002525,,4,Security", "2,9003401,9002525,4,", "2,9003942,9002525,1,", "2,9005311,9002525,0,",
    "1,10,,0,Big-Data", "1,11,,0,Cooking", "2,12,11,9,", "1,13,,0", "2,14,13,9,", "2,15,999,7,", "2,16,,5,",
    "1,20,,-2,Architecture", "2,21,20,-3,",
]


@pytest.fixture
def parsed(texts):
    return parse_postings(texts(*LINES))


def test_join_drops_unanswered_and_orphans(parsed):
    found = {(r["id"], r["answer_id"]) for r in P.question_answers(parsed).collect()}
    assert found == {(9002525, 9003401), (9002525, 9003942), (9002525, 9005311), (11, 12), (13, 14), (20, 21)}


def test_best_answer_per_question(parsed):
    assert {r["id"]: r["max_score"] for r in P.best_answers(parsed).collect()} == {9002525: 4, 11: 9, 13: 9, 20: -3}


def test_questions_are_told_apart_by_their_whole_record(texts):
    lines = texts("1,1,,0,Security", "1,1,,0,Security", "1,1,,5,Security", "2,2,1,3,", "2,3,1,8,")
    found = sorted((r["id"], r["score"], r["max_score"]) for r in P.best_answers(parse_postings(lines)).collect())
    assert found == [(1, 0, 8), (1, 5, 8)]


def test_null_ids_and_other_kinds_meet_nothing(spark):
    rows = [(1, None, None, 3, "Security"), (2, 5, None, 9, None), (3, 1, 1, 9, None), (1, 1, None, 0, "Security"), (2, 6, 1, 2, None)]
    frame = spark.createDataFrame(rows, "posting_type int, id bigint, parent_id bigint, score int, tag string")
    assert [(r["id"], r["max_score"]) for r in P.best_answers(frame).collect()] == [(1, 2)]
    assert P.best_answers(frame.limit(0)).collect() == []


def test_best_answers_take_one_pass_without_a_join(parsed):
    text = P.best_answers(parsed)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in text and text.count("partial_max") == 1


def test_points_drop_unknown_and_missing_topics(texts):
    found = sorted((r["id"], r["x"], r["y"]) for r in posting_points(texts(*LINES)).collect())
    assert found == [(20, 750_000, -3), (9002525, 300_000, 4)]


def test_spread_must_be_positive(parsed):
    with pytest.raises(ValueError):
        P.topic_points(P.best_answers(parsed), spread=0)
