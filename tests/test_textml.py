import threading
import time
from collections import Counter

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from quern import plans
from quern.operators import blocks, textml, wordvec
from quern.plans.analyses import clean_tokens

STOPS = ["the", "A", "bye"]


@pytest.fixture(scope="module")
def clustered(spark):
    rng = np.random.default_rng(0)
    spots = np.array([[0, 0, 0], [9, 9, 0], [0, 9, 9]])
    rows = [(i, Vectors.dense(spots[i % 3] + rng.normal(size=3) / 4), int(i % 3), [f"w{i % 3}", "all", ""]) for i in range(60)]
    return spark.createDataFrame(rows, ["id", "vector", "truth", "kept"])


def tokens(df):
    return [r["kept"] for r in df.collect()]


def test_tokens(texts):
    df = clean_tokens(texts("Hello  World i'm Bye", "", "  the", "tail  "), STOPS, "value")
    assert tokens(df) == [["hello", "", "world", "i'm"], [""], ["", ""], ["tail"]]


def test_long_stop_list_is_joined_with_the_same_result(spark, texts):
    tokenized = textml.tokenize(texts("The cat the CAT bye", "bye", "x  y x", "x  y x"), "value")
    expected = sorted(tokens(textml.remove_stop_words(tokenized, STOPS)))
    assert sorted(tokens(textml.remove_stop_words(tokenized, STOPS, limit=1))) == expected
    frame = spark.createDataFrame([(s,) for s in STOPS], "word string")
    assert sorted(tokens(textml.remove_stop_words(tokenized, frame, limit=1))) == expected


def test_long_stop_lists_meet_tokens_once_for_each_block(spark, texts):
    """Tokens are not shuffled one by one: only different ones of a block are, and whole texts."""
    tokenized = textml.tokenize(texts("The cat the CAT bye", "bye"), "value")
    kept = textml.remove_stop_words(tokenized, STOPS, limit=1)
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan and "collect_list" not in plan
    assert plan.index("Aggregate") < plan.index("Generate explode")


def test_blocks_are_bounded_and_whole(spark):
    df = spark.createDataFrame([([str(j) for j in range(i % 9)],) for i in range(300)] + [(["x"] * 50,), (None,)], "kept array<string>")
    found = blocks.in_blocks(df.coalesce(2), "kept", tokens=20)
    sizes = found.groupBy("_block").agg(F.sum(F.coalesce(F.size("kept"), F.lit(0)) + 1), F.count("*"), F.max(F.coalesce(F.size("kept"), F.lit(0)))).collect()
    assert sum(r[2] for r in sizes) == 302
    assert all(r[1] < 20 + 1 + r[3] for r in sizes) and len(sizes) > 20


def test_document_vector_is_the_mean_of_word_vectors(spark):
    df = spark.createDataFrame([(["a", "b", "a"],), (["a", "b"],), (["rare"],), ([],)], "kept array<string>")
    model = textml.word_vectors(df, seed=1, vector_size=3, min_count=2, tasks=1)
    words = {r["word"]: r["vector"].toArray() for r in model.getVectors().collect()}
    assert set(words) == {"a", "b"}
    found = [r["vector"].toArray() for r in model.transform(df).collect()]
    np.testing.assert_allclose(found[0], (2 * words["a"] + words["b"]) / 3, atol=1e-6)
    np.testing.assert_allclose(found[2], 0)  # an unknown word
    np.testing.assert_allclose(found[3], 0)


def test_word_vectors_are_repeatable(spark):
    df = spark.createDataFrame([(["a", "b", "c"],)] * 20, "kept array<string>").coalesce(1)
    one, two = (
        {r["word"]: list(r["vector"]) for r in textml.word_vectors(df, 5, 4, 1).getVectors().collect()} for _ in range(2)
    )
    assert one == two


def test_pca_equals_eigenvectors_without_centring(clustered):
    projected = textml.project_2d(clustered).orderBy("id").collect()
    x = np.array([r["vector"].toArray() for r in projected])
    values, vectors = np.linalg.eigh(np.cov(x.T))
    expected = x @ vectors[:, np.argsort(values)[::-1][:2]]
    found = np.array([r["projection"].toArray() for r in projected])
    np.testing.assert_allclose(np.abs(found), np.abs(expected), atol=1e-6)


def test_kmeans_and_silhouette(clustered):
    model = textml.cluster_vectors(clustered, seed=1, clusters=3)
    found = model.transform(clustered)
    assert found.select("truth", "cluster").distinct().count() == 3
    x = np.array([r["vector"].toArray() for r in found.orderBy("id").collect()])
    truth = np.arange(60) % 3
    sq = ((x[:, None] - x[None]) ** 2).sum(-1)
    scores = []
    for i in range(60):
        a = sq[i][truth == truth[i]].sum() / 19
        b = min(sq[i][truth == c].mean() for c in range(3) if c != truth[i])
        scores.append((b - a) / max(a, b))
    assert textml.silhouette(found) == pytest.approx(np.mean(scores))


def test_report(clustered):
    report = textml.cluster_report(
        clustered.withColumn("cluster", F.col("truth").cast("int")), [[0, 0, 0], [9, 9, 0], [0, 9, 9], [5, 5, 5]], n=2
    ).collect()
    assert [(r["cluster"], r["size"]) for r in report] == [(0, 20), (1, 20), (2, 20), (3, 0)]
    assert [tuple(t) for t in report[1]["top_tokens"]] == [("all", 20), ("w1", 20)]
    assert report[3]["top_tokens"] == [] and report[3]["center"] == [5.0, 5.0, 5.0]


def test_cluster_texts_end_to_end(spark):
    rows = [("cats purr cats purr the",), ("dogs bark dogs bark the",), ("sun shines sun shines",)] * 15
    texts = spark.createDataFrame(rows, "text string")
    found = plans.cluster_texts(texts, STOPS, seed=3, clusters=3, vector_size=4, min_count=1)
    assert found.clustered.count() == 45
    assert set(found.clustered.columns) == {"kept", "vector", "projection", "cluster"}
    assert sum(r["size"] for r in found.report.collect()) == 45
    metrics = found.metrics.first()
    assert (metrics["k"], metrics["vector_size"], metrics["min_count"]) == (3, 4, 1)
    assert -1 <= metrics["silhouette"] <= 1


def test_sweep_is_ranked(spark):
    tokens_df = spark.createDataFrame([(["a", "b"],), (["c", "d"],), (["e"],)] * 10, "kept array<string>")
    found = textml.sweep(tokens_df, [(2, 2, 1), (3, 2, 1)], seed=2, tasks=1).collect()
    assert {r["k"] for r in found} == {2, 3}
    assert [r["silhouette"] for r in found] == sorted((r["silhouette"] for r in found), reverse=True)


def test_one_shard_trains_the_same_vectors_however_texts_lie(spark):
    words = [[f"w{(i * j) % 23}" for j in range(12)] for i in range(400)]
    df = spark.createDataFrame([(w,) for w in words], "kept array<string>")
    found = [
        sorted((r["word"], tuple(r["vector"])) for r in textml.word_vectors(d, 3, vector_size=3, min_count=1).getVectors().collect())
        for d in (df, df.repartition(7), df.repartition(3, "kept"))
    ]
    assert found[0] == found[1] == found[2] and len(found[0]) == 23


def test_shards_follow_the_tokens(spark, monkeypatch):
    df = spark.createDataFrame([([f"a{i % 5}", "b"],) for i in range(100)], "kept array<string>")
    asked = []
    monkeypatch.setattr(textml, "TOKENS_PER_SHARD", 60)
    real = textml.Word2Vec
    monkeypatch.setattr(textml, "Word2Vec", lambda **k: asked.append(k["numPartitions"]) or real(**k))
    textml.word_vectors(df, seed=1, vector_size=2, min_count=1)
    textml.word_vectors(df, seed=1, vector_size=2, min_count=1, tasks=2)
    assert asked == [4, 2]


def test_settings_of_a_sweep_overlap(spark):
    """Jobs of different settings run at the same time, and the result is that of one after the other."""
    tokens_df = spark.createDataFrame([([f"a{i % 7}", f"b{i % 3}", "c"],) for i in range(300)], "kept array<string>")
    grid = [(2, 2, 1), (3, 2, 1), (2, 3, 1), (3, 3, 1)]
    tracker, most, done = spark.sparkContext.statusTracker(), [0], threading.Event()

    def watch():
        while not done.is_set():
            most[0] = max(most[0], len(tracker.getActiveJobsIds()))
            time.sleep(0.002)

    watcher = threading.Thread(target=watch)
    watcher.start()
    together = textml.sweep(tokens_df, grid, seed=2, tasks=1, at_once=4).collect()
    done.set()
    watcher.join()
    assert most[0] > 1
    alone = textml.sweep(tokens_df, grid, seed=2, tasks=1, at_once=1).collect()
    assert [r[:3] for r in together] == [r[:3] for r in alone]
    assert [r["silhouette"] for r in together] == pytest.approx([r["silhouette"] for r in alone])


def test_a_setting_that_fails_fails_the_sweep(spark):
    tokens_df = spark.createDataFrame([(["a", "b"],)] * 4, "kept array<string>")
    with pytest.raises(Exception):  # noqa: B017
        textml.sweep(tokens_df, [(2, 2, 1), (-1, 2, 1)], seed=2, tasks=1)


def test_a_large_vocabulary_is_trained_as_tables(spark, monkeypatch):
    """Beyond what the driver should hold, Spark's trainer isn't used: same words, same means, alike words near each other."""
    monkeypatch.setattr(textml, "Word2Vec", None)
    rng = np.random.default_rng(1)
    rows = [([f"{'ab'[i % 2]}{j}" for j in rng.integers(0, 6, 12)] + ["all", ""] + [f"rare{i}"] * (i % 3 == 0),) for i in range(600)]
    df = spark.createDataFrame([*rows, ([],)], "kept array<string>")
    for tasks in (1, 3):
        model = textml.word_vectors(df, seed=1, vector_size=3, min_count=2, tasks=tasks, most_words=5)
        words = {r["word"]: r["vector"].toArray() for r in model.getVectors().collect()}
        assert set(words) == {f"{c}{j}" for c in "ab" for j in range(6)} | {"all", ""}
        found = model.transform(df).collect()
        assert len(found) == len(rows) + 1
        for r in found:
            mean = sum((words.get(w, np.zeros(3)) for w in r["kept"]), np.zeros(3)) / max(len(r["kept"]), 1)
            np.testing.assert_allclose(r["vector"].toArray(), mean, atol=1e-6)


def test_a_large_vocabulary_in_one_piece_is_repeatable(spark):
    df = spark.createDataFrame([([f"w{(i * j) % 23}" for j in range(12)],) for i in range(400)], "kept array<string>")
    one, two = (
        sorted((r["word"], tuple(r["vector"])) for r in textml.word_vectors(d, 3, 3, 1, most_words=0).getVectors().collect())
        for d in (df, df.repartition(7))
    )
    assert one == two and len(one) == 23


def test_code_lengths_are_optimal():
    for counts in ([1], [1, 1], [1, 1, 1, 1, 1, 2], [1, 1, 2, 3, 5, 8, 13], [7] * 11, [1, 2, 2, 9, 9, 40]):
        lengths = wordvec.huffman_lengths(Counter(counts))
        each = sorted(n for n, many in lengths.items() for _ in range(many))
        assert len(each) == len(counts)
        assert sum(c * n for c, n in zip(sorted(counts, reverse=True), each, strict=True)) == _inner_weights(counts)


def _inner_weights(counts):
    """The weighted lengths of an optimal code add up to the weights of its inner nodes."""
    left, total = sorted(counts), 0
    while len(left) > 1:
        both = left[0] + left[1]
        total, left = total + both, sorted([both, *left[2:]])
    return total


def test_training_brings_words_that_occur_together_closer():
    rng = np.random.default_rng(0)
    text = np.repeat(np.arange(2000), 10)
    tokens = rng.integers(0, 8, len(text)) + 8 * (text % 2)
    lengths, codes = np.full(16, 4), np.arange(16)
    start = ((rng.random((16, 6)) - 0.5) / 6).astype(np.float32)
    found = wordvec.skip_grams(np.tile(tokens, 10), np.repeat(np.arange(20000), 10), start, codes, lengths, 1)
    unit = found / np.linalg.norm(found, axis=1)[:, None]
    near = unit @ unit.T
    assert near[:8, :8].mean() > near[:8, 8:].mean() + 0.5


def test_a_sweep_counts_and_codes_its_texts_once(spark, monkeypatch):
    """Also with a large vocabulary; what is made for each size and least count is the vectors."""
    made = []
    for module in (textml, wordvec):
        monkeypatch.setattr(module, "stage", lambda df, label, real=module.stage: made.append(label) or real(df, label))
    monkeypatch.setattr(textml, "MOST_TOKENS", 0)
    df = spark.createDataFrame([([f"a{i % 7}", f"b{i % 3}", "c"],) for i in range(90)], "kept array<string>")
    found = textml.sweep(df, [(2, 2, 1), (3, 2, 1), (2, 3, 1)], seed=2, tasks=2).collect()
    assert {tuple(r[:3]) for r in found} == {(2, 2, 1), (3, 2, 1), (2, 3, 1)}
    assert Counter(made) == {"word-counts": 1, "ordered-words": 1, "pieces": 1, "coded": 1, "word-vectors": 2, "vectors": 2}


def test_coded_texts_come_back_whole(spark, monkeypatch):
    monkeypatch.setattr(textml, "MOST_TOKENS", 0)
    rows = [*([f"w{i % 5}", "x", "x", f"once{i}"] for i in range(40)), None, [], [None, "x"], [""], ["x"] * 50]
    df = spark.createDataFrame([(r,) for r in rows], "kept array<string>")
    model = textml.word_vectors(df, seed=1, vector_size=2, min_count=2, tasks=3)
    words = {r["word"]: r["vector"].toArray() for r in model.getVectors().collect()}
    assert set(words) == {*(f"w{i}" for i in range(5)), "x"}
    found = model.transform(df).collect()
    assert sorted(map(repr, (r["kept"] for r in found))) == sorted(map(repr, rows))
    for r in found:
        each = [words.get(w, np.zeros(2)) for w in r["kept"] or []]
        np.testing.assert_allclose(r["vector"].toArray(), np.mean(each, axis=0) if each else np.zeros(2), atol=1e-6)
    alone = sorted(tuple(r["vector"]) for r in model.means().collect())
    np.testing.assert_allclose(alone, sorted(tuple(r["vector"]) for r in found))


def test_steps_are_those_of_the_pairs_one_by_one():
    """A reach of one to five tokens inside a text; sums at the same vectors, damped by their curvature."""
    rng = np.random.default_rng(3)
    tokens, text, seed = rng.integers(0, 5, 60), np.repeat(np.arange(12), 5), 4
    codes, lengths = np.array([0, 2, 6, 14, 15]), np.array([1, 2, 3, 4, 4])
    start = rng.normal(size=(5, 3)).astype(np.float32)
    reach = np.random.default_rng(seed).integers(1, 6, len(tokens))
    inner, outer = start.astype(float), {}
    for begin in range(0, 60, 20):
        rate = wordvec.RATE * (1 - begin / 60)
        steps, bounds = {}, Counter()
        for i in range(begin, begin + 20):
            for j in range(60):
                if i == j or text[i] != text[j] or abs(i - j) > reach[i]:
                    continue
                for depth in range(lengths[tokens[i]]):
                    below = lengths[tokens[i]] - depth
                    node = ("node", depth, codes[tokens[i]] >> below)
                    at = outer.setdefault(node, np.zeros(3))
                    vector = inner[tokens[j]]
                    error = 1 - ((codes[tokens[i]] >> (below - 1)) & 1) - 1 / (1 + np.exp(-at @ vector))
                    for key, step, bound in ((tokens[j], error * at, at @ at), (node, error * vector, vector @ vector)):
                        steps[key] = steps.get(key, 0) + step
                        bounds[key] += bound
        for key, step in steps.items():
            table = outer if isinstance(key, tuple) else inner
            table[key] = table[key] + rate * step / (1 + rate / 4 * bounds[key])
    before, wordvec.TOKENS_AT_ONCE = wordvec.TOKENS_AT_ONCE, 20
    try:
        found = wordvec.skip_grams(tokens, text, start, codes, lengths, seed)
    finally:
        wordvec.TOKENS_AT_ONCE = before
    np.testing.assert_allclose(found, inner, atol=1e-5)
