from collections import Counter

from pyspark.sql import functions as F

from quern import plans
from quern.functions import text as tx
from quern.operators import words
from quern.plans.analyses import corpus_words
from quern.sources.readers import as_word_list


def pairs(df):
    return [tuple(r) for r in df.collect()]


def test_word_count_golden(texts):
    df = texts("Hello World Bye World", "Hello Hadoop Goodbye Hadoop")
    assert pairs(plans.word_count(df)) == [("Bye", 1), ("Goodbye", 1), ("Hadoop", 2), ("Hello", 2), ("World", 2)]


def test_the_two_splitters_differ_on_tabs_and_form_feeds(texts):
    df = texts(" a\tb\f c  \r\n c")
    assert dict(pairs(plans.word_count(df))) == {"a": 1, "b": 1, "c": 2}
    found = Counter(r[0] for r in corpus_words(df).collect())
    assert found == Counter({"a\tb\f": 1, "c": 2})


def test_words_keep_case_and_punctuation(texts):
    df = texts("It it it. It")
    assert dict(pairs(words.corpus_counts(corpus_words(df), ["it"]))) == {"It": 2, "it.": 1}


def test_stop_words_as_list_frame_or_too_long_list(spark, texts, monkeypatch):
    counted = corpus_words(texts("a b c a"))
    stops = spark.createDataFrame([("a",), ("a",), ("z",)], "word string")
    expected = {"b": 1, "c": 1}
    assert dict(pairs(words.corpus_counts(counted, ["a", "z"]))) == expected
    assert dict(pairs(words.corpus_counts(counted, stops))) == expected
    monkeypatch.setattr(words, "as_word_list", lambda s: as_word_list(s, limit=1))
    assert dict(pairs(words.corpus_counts(counted, stops))) == expected
    assert dict(pairs(words.corpus_counts(counted, ["a", "z"]))) == expected
    monkeypatch.undo()
    assert dict(pairs(words.corpus_counts(counted, []))) == {"a": 2, "b": 1, "c": 1}


def test_common_words_take_the_smaller_count(spark):
    left = spark.createDataFrame([("I", 746), ("It", 85), ("will", 64), ("only", 9)], "word string, cnt bigint")
    right = spark.createDataFrame([("I", 287), ("It", 44), ("will", 15), ("other", 9)], "word string, cnt bigint")
    found = words.top_k(words.common_words(left, right), 2)
    assert pairs(found) == [(287, "I"), (44, "It")]


def test_both_ways_to_common_words_agree(texts):
    left = corpus_words(texts("a a a b c", "d d"))
    right = corpus_words(texts("a a b b", "e d"))
    joined = words.common_words(words.corpus_counts(left), words.corpus_counts(right))
    assert sorted(pairs(joined)) == sorted(pairs(words.common_words_of(left, right))) == [(1, "b"), (1, "d"), (2, "a")]


def test_top_k_breaks_ties_by_word(texts):
    left, right = texts("b a c The the"), texts("c b a The the x")
    assert pairs(plans.top_k_common_words(left, right, ["the"], k=3)) == [(1, "The"), (1, "a"), (1, "b")]


def test_top_n_per_group(spark):
    df = spark.createDataFrame(
        [("g", "b", 2), ("g", "a", 2), ("g", "c", 5), ("h", "z", 1)], "grp string, word string, cnt bigint"
    )
    found = words.top_n_per_group(df, "grp", 2).select("grp", "rank", "word")
    assert sorted(pairs(found)) == [("g", 1, "c"), ("g", 2, "a"), ("h", 1, "z")]


def test_empty_words_never_count(texts):
    assert pairs(words.explode_words(texts("", "   "), tx.whitespace_words(F.col("value")))) == []
