"""Short-text clustering on Spark ML."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from threading import Lock

import numpy as np
import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA, StopWordsRemover, Tokenizer, Word2Vec, Word2VecModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.operators import wordvec
from quern.operators.blocks import in_blocks, meet_in_blocks, places
from quern.operators.words import Words, count_words, explode_words, top_n_per_group
from quern.session import planned_with, stage
from quern.sources.readers import WORD_LIST_LIMIT, as_word_list, word_frame

# Number of clusters, length of the vectors, least count of a word, tokens reported.
CLUSTERS = 19
VECTOR_SIZE = 10
MIN_COUNT = 2
TOP_TOKENS = 5

#: Tokens that one shard of a Word2Vec training should have, unless the number of shards is given.
TOKENS_PER_SHARD = 2_000_000
#: Settings of a sweep that are fitted at the same time.
SETTINGS_AT_ONCE = 4
#: Distinct words whose vectors the driver is asked to hold, and tokens that Spark's trainer gets; beyond either, words,
#: codes and vectors stay tables (`wordvec`).
MOST_WORDS = 200_000
MOST_TOKENS = 50_000_000


def tokenize(texts: DataFrame, column: str = "text") -> DataFrame:
    """Adds `tokens`: lower-cased, split at single blanks; double blanks yield '' (F3)."""
    return Tokenizer(inputCol=column, outputCol="tokens").transform(texts)


def remove_stop_words(tokenized: DataFrame, stops: Words, limit: int = WORD_LIST_LIMIT) -> DataFrame:
    """Adds `kept`: the tokens that are not in the list, compared without case.

    A list beyond the word-list limit stays distributed: blocks of texts then meet the listed words that occur in them, so
    tokens are not shuffled one by one.
    """
    stops = stops if isinstance(stops, DataFrame) else list(stops)
    found = as_word_list(stops, limit)
    if found is not None:
        return StopWordsRemover(inputCol="tokens", outputCol="kept", stopWords=found).transform(tokenized)
    listed = word_frame(tokenized.sparkSession, stops).select(F.lower("word").alias("word")).distinct()
    schema = T.StructType([*tokenized.schema.fields, T.StructField("kept", tokenized.schema["tokens"].dataType)])
    return meet_in_blocks(in_blocks(tokenized, "tokens"), "tokens", listed, _without(schema.names), schema, F.lower)


def _without(columns: list[str]) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Adds `kept` to a block's texts: their tokens without those whose lower-case form is listed."""

    def kept(texts: pa.Table, listed: pa.Table) -> pa.Table:
        sizes, text, found = places(texts.column("tokens"), listed.column("word"))
        left = found < 0
        ends = np.cumsum(np.bincount(text[left], minlength=len(sizes)))
        values = texts.column("tokens").combine_chunks().flatten().filter(pa.array(left))
        lists = pa.ListArray.from_arrays(pa.array(np.r_[0, ends].astype(np.int32)), values)
        return texts.select(columns[:-1]).append_column("kept", lists)

    return kept


class Corpus:
    """Tokenised texts that several fits share: their words are counted once, and coded once if they are many."""

    def __init__(self, texts: DataFrame, column: str = "kept"):
        self.texts, self.column = texts, column
        self.counts = stage(count_words(texts.select(F.explode(column).alias("word"))), "word-counts")
        self.tokens = self.counts.agg(F.sum("cnt")).first()[0] or 0
        #: Shards of a training, unless their number is given.
        self.shards = max(1, -(-self.tokens // TOKENS_PER_SHARD))
        self._pieces: dict[int, wordvec.Pieces] = {}
        self._one_at_a_time = Lock()

    def pieces(self, many: int) -> wordvec.Pieces:
        with self._one_at_a_time:
            if many not in self._pieces:
                self._pieces[many] = wordvec.code_texts(self.texts, self.counts, self.column, many)
            return self._pieces[many]


def word_vectors(
    tokenized: DataFrame | Corpus,
    seed: int,
    vector_size: int = VECTOR_SIZE,
    min_count: int = MIN_COUNT,
    tasks: int | None = None,
    column: str = "kept",
    most_words: int = MOST_WORDS,
) -> Word2VecModel | wordvec.WordVectors:
    """Fitted word vectors (M5).

    Texts are dealt into `tasks` shards by a digest of their tokens and put in order inside them, so what a shard trains on,
    and in which order, follows from the texts alone. Without `tasks` the number of tokens decides, `TOKENS_PER_SHARD` to a
    shard. One shard trains the same vectors in every run and on every cluster. Several don't: Spark's tasks of one executor
    change the same vectors while they train.
    Spark keeps the vocabulary on the driver, so it is counted first. With more than `most_words` words, or `MOST_TOKENS`
    tokens, the same model is trained by `wordvec.train`, in shards of at most `TOKENS_PER_SHARD` tokens on average and
    without bringing words or vectors to the driver. Nothing is dropped. A `Corpus` (whose column holds then) is counted, and
    coded for that, once for all fits.
    """
    corpus = tokenized if isinstance(tokenized, Corpus) else Corpus(tokenized, column)
    words = corpus.counts.where(F.col("cnt") >= min_count).count()
    if words > most_words or corpus.tokens > MOST_TOKENS:
        pieces = corpus.pieces(max(tasks or 1, corpus.shards))
        return wordvec.train(corpus.texts, pieces, vector_size, min_count, seed)
    tasks, column = tasks or corpus.shards, corpus.column
    digest = F.xxhash64(F.array_join(column, " "))
    shards = corpus.texts.select(column, digest.alias("_digest")).repartition(tasks, "_digest")
    return Word2Vec(
        inputCol=column,
        outputCol="vector",
        vectorSize=vector_size,
        minCount=min_count,
        numPartitions=tasks,
        seed=seed,
    ).fit(shards.sortWithinPartitions("_digest", column).select(column))


def text_vectors(model: Word2VecModel | wordvec.WordVectors, corpus: Corpus) -> DataFrame:
    """`vector`: that of each text the model was fitted on, without the text."""
    if isinstance(model, wordvec.WordVectors):
        return model.means()
    return model.transform(corpus.texts).select("vector")


def cluster_vectors(vectors: DataFrame, seed: int, clusters: int = CLUSTERS, column: str = "vector") -> KMeansModel:
    """Fitted k-means; its `transform` adds `cluster` (M6)."""
    return KMeans(k=clusters, featuresCol=column, predictionCol="cluster", seed=seed).fit(vectors)


def project_2d(vectors: DataFrame, column: str = "vector") -> DataFrame:
    """Adds `projection`: the first two principal components (M7)."""
    return PCA(k=2, inputCol=column, outputCol="projection").fit(vectors).transform(vectors)


def silhouette(clustered: DataFrame, column: str = "vector", cluster: str = "cluster") -> float:
    """Mean silhouette with squared Euclidean distance."""
    return ClusteringEvaluator(featuresCol=column, predictionCol=cluster).evaluate(clustered)


def token_report(clustered: DataFrame, group: str = "cluster", column: str = "kept", n: int = TOP_TOKENS) -> DataFrame:
    """`group, rank, word, cnt`: each group's most frequent tokens, in one pass."""
    counts = count_words(explode_words(clustered, F.col(column), group), group)
    return top_n_per_group(counts, group, n).select(group, "rank", "word", "cnt")


def cluster_report(clustered: DataFrame, centers: Sequence[Iterable[float]], n: int = TOP_TOKENS) -> DataFrame:
    """`cluster, size, center, top_tokens` for every cluster, empty ones too."""
    sizes = clustered.groupBy("cluster").agg(F.count(F.lit(1)).alias("size"))
    top = (
        token_report(clustered, n=n)
        .groupBy("cluster")
        .agg(F.sort_array(F.collect_list(F.struct("rank", "word", "cnt"))).alias("ranked"))  # n entries at most
        .select("cluster", F.transform("ranked", lambda t: F.struct(t.word.alias("token"), t.cnt.alias("freq"))).alias("top_tokens"))
    )
    where = clustered.sparkSession.createDataFrame(
        [(i, [float(v) for v in c]) for i, c in enumerate(centers)], "cluster int, center array<double>"
    )
    empty = F.array().cast("array<struct<token:string,freq:bigint>>")
    return (
        F.broadcast(where)  # one row per cluster
        .join(sizes, "cluster", "left")
        .join(top, "cluster", "left")
        .select(
            "cluster",
            F.coalesce("size", F.lit(0)).cast("long").alias("size"),
            "center",
            F.coalesce("top_tokens", empty).alias("top_tokens"),
        )
        .orderBy("cluster")
    )


def sweep(
    tokenized: DataFrame,
    grid: Iterable[tuple[int, int, int]],
    seed: int,
    tasks: int | None = None,
    at_once: int = SETTINGS_AT_ONCE,
) -> DataFrame:
    """`k, vector_size, min_count, silhouette` per setting, best first (M9).

    `grid` holds (k, vector size, least count); vectors are made once per size and count. `at_once` fits run at the same
    time (see `together`). The first one that fails fails the sweep.
    """
    settings = list(grid)
    made = sweep_vectors(tokenized, sorted({(size, count) for _, size, count in settings}), seed, tasks, at_once)
    return score_settings(made, settings, seed, at_once)


def sweep_vectors(
    tokenized: DataFrame, kinds: Sequence[tuple[int, int]], seed: int, tasks: int | None = None, at_once: int = SETTINGS_AT_ONCE
) -> dict[tuple[int, int], DataFrame]:
    """`vector` of each text for each vector size and least count, a stage table each; `at_once` are made at the same time.

    The files of one shard's vectors (few then) are read in order of their names: the first centres of k-means depend on the order
    of rows, and files of one length would be read in any.
    """
    corpus = Corpus(tokenized)
    spark, shards = tokenized.sparkSession, max(tasks or 1, corpus.shards)

    def vectors(kind: tuple[int, int]) -> DataFrame:
        found = stage(text_vectors(word_vectors(corpus, seed, *kind, tasks), corpus), "vectors")
        return spark.read.schema(found.schema).parquet(*sorted(found.inputFiles())) if shards == 1 else found

    with planned_with(spark, wordvec.split_by_piece(shards, spark)):  # as each of them would set it
        return dict(zip(kinds, together(spark, vectors, kinds, at_once), strict=True))


def score_settings(
    made: Mapping[tuple[int, int], DataFrame], grid: Iterable[tuple[int, int, int]], seed: int, at_once: int = SETTINGS_AT_ONCE
) -> DataFrame:
    """The ranked settings of a sweep, for vectors `made` for each size and least count; a stage table each."""
    settings = list(grid)
    spark = next(iter(made.values())).sparkSession

    def score(setting: tuple[int, int, int]) -> float:
        k, *kind = setting
        found = made[tuple(kind)]
        return silhouette(cluster_vectors(found, seed, k).transform(found))

    values = together(spark, score, settings, at_once)
    schema = "k int, vector_size int, min_count int, silhouette double"
    rows = [(*setting, value) for setting, value in zip(settings, values, strict=True)]
    return spark.createDataFrame(rows, schema).orderBy(F.desc("silhouette"), "k", "vector_size", "min_count")


def together(spark: SparkSession, fn: Callable, items: Sequence, at_once: int) -> list:
    """`fn` of every item, `at_once` of them at the same time, each as Spark jobs of its own, so that the last tasks of one
    leave no cores idle. With Spark's fair scheduler each has its own pool."""

    def run(place: int):
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"together-{place % at_once}")
        try:
            return fn(items[place])
        finally:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)

    with ThreadPoolExecutor(max_workers=max(1, min(at_once, len(items)))) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(spark)(run), i) for i in range(len(items))]]
