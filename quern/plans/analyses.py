"""E1-E5."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.functions import text as tx
from quern.operators import lloyd, postings, ratings, textml, words
from quern.session import stage
from quern.sources.readers import parse_postings


def word_count(texts: DataFrame, column: str = "value", ordered: bool = True) -> DataFrame:
    """Frequency of every blank-delimited word, in word order: `word, cnt`."""
    found = words.explode_words(texts, tx.whitespace_words(F.col(column)))
    counts = words.count_words(found)
    return counts.orderBy("word") if ordered else counts


def corpus_words(texts: DataFrame, stops: words.Words | None = None, column: str = "value") -> DataFrame:
    """The space-delimited words of a corpus without its stop words: `word`."""
    found = words.explode_words(texts, tx.space_words(F.col(column)))
    return found if stops is None else words.drop_stop_words(found, stops)


def top_k_common_words(
    left: DataFrame, right: DataFrame, stops: words.Words, k: int = 20, column: str = "value"
) -> DataFrame:
    """The `k` words with the highest smaller count over two corpora: `cnt, word`."""
    common = words.common_words_of(corpus_words(left, None, column), corpus_words(right, None, column))
    return words.top_k(words.drop_stop_words(common, stops).select("cnt", "word"), k)


def recommend_scores(rated: DataFrame, product_decimals: int | None = None) -> DataFrame:
    """`user_id, item_id, score` for every item a user has not rated and can be scored for.

    The summed ratings and the pair counts are written as stage tables, as each is read several
    times and the size of the pair counts decides how the product is joined.
    """
    if product_decimals is not None:
        rated = stage(rated, "ratings")
    totals = stage(ratings.rating_totals(rated), "totals")
    pairs = ratings.pair_table(totals)
    return ratings.unseen_scores(rated, totals, pairs, product_decimals)


@dataclass
class PostingClusters:
    fit: lloyd.Fit
    summary: DataFrame
    history: DataFrame


def posting_points(
    lines: DataFrame, topics: Sequence[str] = postings.TOPICS, spread: int = postings.TOPIC_SPREAD,
    column: str = "value", mode: str = "strict",
) -> DataFrame:
    """`id, x, y` points of the answered questions with a known topic, in one pass over the lines."""
    return postings.topic_points(postings.best_answers(parse_postings(lines, column, mode)), topics, spread)


def cluster_postings(
    lines: DataFrame,
    topics: Sequence[str] = postings.TOPICS,
    spread: int = postings.TOPIC_SPREAD,
    clusters: int = lloyd.CLUSTERS,
    eta: float = lloyd.ETA,
    max_iterations: int = lloyd.MAX_ITERATIONS,
    init: str = "sample",
    seed: int = 0,
    column: str = "value",
    mode: str = "strict",
) -> PostingClusters:
    """K-means of questions by topic and best answer score, with a summary per cluster.

    `init="sample"` draws the first centres from the questions, `"ordered"` takes distinct points at
    even ranks. The number of centres never exceeds the number of points to draw from.
    """
    if init not in ("sample", "ordered"):
        raise ValueError(f"init must be 'sample' or 'ordered', not {init!r}")
    points = stage(posting_points(lines, topics, spread, column, mode), "vectors")
    weighted = lloyd.weigh_points(points, ordered=init == "ordered")
    if init == "sample":
        start = lloyd.sampled_centers(points, clusters, seed)
    else:
        start = lloyd.points_at_ranks(weighted, clusters)
    fit = lloyd.fit(weighted, start, eta, max_iterations)
    return PostingClusters(fit, lloyd.summary(weighted, fit.centers, fit.many), fit.history_df(lines.sparkSession))


@dataclass
class TextClusters:
    """`assigned` holds `kept, vector, cluster`; what else is asked for is computed when it is."""

    assigned: DataFrame
    report: DataFrame
    settings: tuple[int, int, int]

    @cached_property
    def clustered(self) -> DataFrame:
        """`kept, vector, projection, cluster`, ready for the projection sink."""
        return textml.project_2d(self.assigned)

    @cached_property
    def metrics(self) -> DataFrame:
        """`k, vector_size, min_count, silhouette`."""
        row = (*self.settings, textml.silhouette(self.assigned))
        return self.assigned.sparkSession.createDataFrame([row], "k int, vector_size int, min_count int, silhouette double")


def clean_tokens(texts: DataFrame, stops: words.Words, column: str = "text") -> DataFrame:
    """Adds `tokens` and `kept` to short texts."""
    return textml.remove_stop_words(textml.tokenize(texts, column), stops)


def cluster_texts(
    texts: DataFrame,
    stops: words.Words,
    seed: int,
    clusters: int = textml.CLUSTERS,
    vector_size: int = textml.VECTOR_SIZE,
    min_count: int = textml.MIN_COUNT,
    tasks: int | None = None,
    column: str = "text",
) -> TextClusters:
    """E5: clusters of short texts by their mean word vector, with top tokens and silhouette."""
    tokens = stage(clean_tokens(texts, stops, column).select("kept"), "tokens")
    model = textml.word_vectors(tokens, seed, vector_size, min_count, tasks)
    vectors = stage(model.transform(tokens), "vectors")
    kmeans = textml.cluster_vectors(vectors, seed, clusters)
    assigned = kmeans.transform(vectors)
    report = textml.cluster_report(assigned, kmeans.clusterCenters())
    return TextClusters(assigned, report, (clusters, vector_size, min_count))
