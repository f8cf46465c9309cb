"""One entry per operator or analysis; each runs over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import inputs
from quern import plans
from quern.functions import text as tx
from quern.operators import compare, lloyd, postings, ratings, textml, words
from quern.plans import analyses
from quern.session import new_path, stage
from quern.sources import readers, writers

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

SEED = 7
#: Entries to a page of the list views, so that keys have several; ranks that `order_breaks` looks at.
PAGE = 20
RANKS = 1000
#: Partitions that Word2Vec trains in where its vectors need not be the same in every run.
TASKS = 8
SHOWN_CLUSTERS = 8


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# ---- words ---------------------------------------------------------------------------------


@query
def word_count(spark, sf):
    return plans.word_count(inputs.spread_table(spark, sf, "documents", "text"), "text")


@query
def corpus_word_count(spark, sf):
    return words.corpus_counts(analyses.corpus_words(inputs.documents(spark, sf), inputs.STOP_WORDS, "text"))


LISTED = 50  # words of the list that is read from a file


def _word_list_file(spark, sf):
    """The most frequent words of the benchmark, written as a word list and read back."""
    path = new_path(spark, "word-list")
    frequent = words.top_k(words.corpus_counts(analyses.corpus_words(inputs.benchmark(spark, sf), None, "text")), LISTED)
    writers.write_texts(frequent, path, "word")
    return readers.read_word_list(spark, path)


@query
def file_stop_words(spark, sf):
    listed = _word_list_file(spark, sf)
    return words.corpus_counts(analyses.corpus_words(inputs.documents(spark, sf), listed, "text"))


@query
def common_words(spark, sf):
    left = words.corpus_counts(analyses.corpus_words(inputs.documents(spark, sf), None, "text"), inputs.STOP_WORDS)
    right = words.corpus_counts(analyses.corpus_words(inputs.benchmark(spark, sf), None, "text"), inputs.STOP_WORDS)
    return words.common_words(left, right)


@query
def topk_common_words(spark, sf):
    return plans.top_k_common_words(
        inputs.documents(spark, sf), inputs.benchmark(spark, sf), inputs.STOP_WORDS, 20, "text"
    )


@query
def multi_input_union(spark, sf):
    return readers.union_sources(
        {
            "documents": inputs.table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "text"),
            "benchmark": inputs.table(spark, sf, "benchmark").select(F.col("item_id").alias("id"), "text"),
            "conversations": inputs.table(spark, sf, "conversations").select(F.col("conv_id").alias("id"), "text"),
        }
    )


@query
def text_lines(spark, sf):
    return readers.lines_of(inputs.table(spark, sf, "documents"), "text", "doc_id")


@query
def kv_scan(spark, sf):
    turns = inputs.table(spark, sf, "conversations")
    key = F.concat_ws(":", "conv_id", "turn")
    rest = F.when(F.col("turn") % 3 != 2, F.concat(F.lit("\t"), "role", F.lit("\t"), "text")).otherwise("")
    return readers.parse_key_values(turns.select(F.regexp_replace(F.concat(key, rest), "[\r\n]", " ").alias("value")))


# ---- recommendation ------------------------------------------------------------------------


@query
def ratings_parse(spark, sf):
    line = F.concat_ws(",", "user_id", "item_id", F.col("rating").cast("string"))
    return readers.parse_ratings(inputs.ratings(spark, sf).select(line.alias("value")))


@query
def user_preferences(spark, sf):
    rated = stage(inputs.ratings(spark, sf), "ratings")
    return ratings.list_to_text(ratings.user_preferences(rated, PAGE), "prefs")


@query
def item_raters(spark, sf):
    rated = stage(inputs.ratings(spark, sf), "ratings")
    return ratings.list_to_text(ratings.item_raters(rated, PAGE), "raters")


def _totals_and_pairs(spark, sf):
    totals = stage(ratings.rating_totals(inputs.ratings(spark, sf)), "totals")
    return totals, ratings.pair_table(totals)


@query
def cooccurrence_counts(spark, sf):
    return ratings.mirror_pairs(_totals_and_pairs(spark, sf)[1])


@query
def cooccurrence_rows(spark, sf):
    return ratings.list_to_text(ratings.matrix_rows(_totals_and_pairs(spark, sf)[1], PAGE), "entries")


@query
def recommendation_raw_scores(spark, sf):
    totals, pairs = _totals_and_pairs(spark, sf)
    return ratings.raw_scores(totals, totals, pairs)


@query
def recommendations(spark, sf):
    return plans.recommend_scores(inputs.ratings(spark, sf))


@query
def recommendations_grid(spark, sf):
    """The scores as for a matrix that is too large to be broadcast."""
    rated = stage(inputs.ratings(spark, sf), "ratings")
    totals = stage(ratings.rating_totals(rated), "totals")
    return ratings.unseen_scores(rated, totals, ratings.pair_table(totals), broadcast_bytes=0)


@query
def recommendations_rounded(spark, sf):
    return plans.recommend_scores(inputs.ratings(spark, sf), product_decimals=6)


@query
def drop_seen(spark, sf):
    totals, pairs = _totals_and_pairs(spark, sf)
    return ratings.drop_seen(ratings.raw_scores(totals, totals, pairs), totals)


# ---- postings ------------------------------------------------------------------------------


def _points(spark, sf):
    return analyses.posting_points(inputs.posting_lines(spark, sf), inputs.PRIORITY_TOPICS)


def _weighted(spark, sf):
    return lloyd.weigh_points(_points(spark, sf))


def _fixed_fit(spark, sf, iterations):
    weighted = _weighted(spark, sf)
    start = lloyd.points_at_ranks(weighted, SHOWN_CLUSTERS)
    return weighted, lloyd.fit(weighted, start, eta=0.0, max_iterations=iterations)


@query
def postings_parse(spark, sf):
    return readers.parse_postings(inputs.posting_lines(spark, sf))


@query
def question_answer_join(spark, sf):
    return postings.question_answers(readers.parse_postings(inputs.posting_lines(spark, sf)))


@query
def question_answer_digest(spark, sf):
    """One row for each question record: how many answers it meets, and a digest of them."""
    met = postings.question_answers(readers.parse_postings(inputs.posting_lines(spark, sf)))
    each = F.concat_ws(":", F.col("answer_id").cast("string"), F.col("answer_score").cast("string"))
    return met.groupBy("id", "score", "tag").agg(
        F.count(F.lit(1)).alias("answers"),
        F.sum("answer_score").alias("total"),
        F.md5(F.array_join(F.array_sort(F.collect_list(each)), ",")).alias("digest"),
    )


@query
def posting_line_report(spark, sf):
    """What was kept of posting lines of which some are broken, and what was rejected and why."""
    lines = inputs.posting_lines(spark, sf)
    size = F.length("value")
    broken = (
        F.when(size % 7 == 0, F.concat(F.lit("x"), "value"))
        .when(size % 7 == 1, F.substring_index("value", ",", 2))
        .when(size % 7 == 2, F.regexp_replace("value", "^([0-9]+),([0-9]+),", "$1,$2,?"))
        .otherwise(F.col("value"))
    )
    checked = readers.checked_postings(lines.select(broken.alias("value")))
    kept = readers.kept_lines(checked).select(F.lit("kept").alias("reason"), F.col("score").cast("long").alias("measure"))
    rejected = readers.rejected_lines(checked).select("reason", F.length("value").cast("long").alias("measure"))
    return kept.unionByName(rejected).groupBy("reason").agg(F.count(F.lit(1)).alias("lines"), F.sum("measure").alias("measure"))


@query
def question_max_score(spark, sf):
    return postings.best_answers(readers.parse_postings(inputs.posting_lines(spark, sf)))


@query
def posting_vectors(spark, sf):
    return _points(spark, sf)


@query
def sample_points(spark, sf):
    return lloyd.sample_points(_points(spark, sf), lloyd.CLUSTERS, SEED)


@query
def nearest_center(spark, sf):
    weighted = _weighted(spark, sf)
    return lloyd.assign(weighted.select("x", "y", "w"), lloyd.points_at_ranks(weighted, SHOWN_CLUSTERS))


@query
def kmeans_step(spark, sf):
    weighted = _weighted(spark, sf)
    return lloyd.centroids(lloyd.assign(weighted, lloyd.points_at_ranks(weighted, SHOWN_CLUSTERS)))


@query
def kmeans_3_iterations(spark, sf):
    return _fixed_fit(spark, sf, 3)[1].centers_df(spark)


@query
def kmeans_summary(spark, sf):
    weighted, fit = _fixed_fit(spark, sf, 3)
    return lloyd.summary(weighted, fit.centers)


@query
def kmeans_history(spark, sf):
    return _fixed_fit(spark, sf, 3)[1].history_df(spark)


@query
def kmeans_converged(spark, sf):
    return plans.cluster_postings(inputs.posting_lines(spark, sf), inputs.PRIORITY_TOPICS, seed=SEED).summary


@query
def kmeans_converged_history(spark, sf):
    return plans.cluster_postings(inputs.posting_lines(spark, sf), inputs.PRIORITY_TOPICS, init="ordered").history


# ---- short texts ---------------------------------------------------------------------------


def _clean(spark, sf):
    return analyses.clean_tokens(inputs.short_texts(spark, sf), inputs.STOP_WORDS)


@query
def tail_field_text(spark, sf):
    return readers.tail_field_text(inputs.short_text_lines(spark, sf), "doc_id")


@query
def tokens_clean(spark, sf):
    return _clean(spark, sf).select("doc_id", F.size("tokens").alias("n"), F.array_join("kept", " ").alias("kept"))


@query
def tokens_clean_joined(spark, sf):
    """A word list from a file, taken for too long to leave the cluster."""
    tokens = textml.tokenize(inputs.short_texts(spark, sf)).select("doc_id", "tokens")  # blocks move all columns
    kept = textml.remove_stop_words(tokens, _word_list_file(spark, sf), limit=0)
    return kept.select("doc_id", F.size("tokens").alias("n"), F.array_join("kept", " ").alias("kept"))


@query
def token_freq_by_group(spark, sf):
    return words.count_words(words.explode_words(_clean(spark, sf), F.col("kept"), "lang"), "lang")


@query
def top_tokens_by_group(spark, sf):
    return textml.token_report(_clean(spark, sf), "lang")


@query
def silhouette_by_label(spark, sf):
    value = textml.silhouette(inputs.embeddings(spark, sf), cluster="label")
    return spark.createDataFrame([(round(value, 6),)], "silhouette double")


@query
def vector_text(spark, sf):
    """Every component as the text shows it, read back as a number."""
    shown = inputs.embeddings(spark, sf).select("vec_id", tx.vector_to_text(F.col("vector")).alias("shown"))
    inner = F.split(F.expr("substring(shown, 2, length(shown) - 2)"), ",")
    return shown.select("vec_id", F.posexplode(inner).alias("at", "value")).withColumn("value", F.col("value").cast("double"))


def _embedded(spark, sf):
    tokens = stage(_clean(spark, sf).select("doc_id", "kept"), "tokens")
    return textml.word_vectors(tokens, SEED, vector_size=4).transform(tokens)


@query
def word2vec_vectors(spark, sf):
    return _embedded(spark, sf).select("doc_id", vector_to_array("vector").alias("vector"))


@query
def pca_2d(spark, sf):
    projected = textml.project_2d(inputs.embeddings(spark, sf))
    return projected.select("vec_id", vector_to_array("projection").alias("projection"))


@query
def ml_kmeans(spark, sf):
    vectors = inputs.embeddings(spark, sf)
    return textml.cluster_vectors(vectors, SEED, SHOWN_CLUSTERS).transform(vectors).select("vec_id", "label", "cluster")


@query
def text_cluster_report(spark, sf):
    found = plans.cluster_texts(inputs.short_texts(spark, sf), inputs.STOP_WORDS, SEED, SHOWN_CLUSTERS, 4, tasks=TASKS)
    return found.report


@query
def word2vec_vocabulary(spark, sf):
    """The words that got a vector."""
    tokens = stage(_clean(spark, sf).select("kept"), "tokens")
    return textml.word_vectors(tokens, SEED, vector_size=4, tasks=TASKS).getVectors().select("word")


@query
def word2vec_means(spark, sf):
    """Texts, and those whose vector is not the mean over their tokens, where a word without a vector adds nothing."""
    tokens = stage(_clean(spark, sf).select(F.monotonically_increasing_id().alias("text_no"), "kept"), "tokens")
    model = textml.word_vectors(tokens, SEED, vector_size=4, tasks=TASKS)
    known = model.getVectors().select("word", vector_to_array("vector").alias("of_word"))
    words_of = tokens.select("text_no", F.size("kept").alias("n"), F.explode("kept").alias("word")).join(known, "word")
    parts = [F.sum(F.col("of_word")[i] / F.col("n")) for i in range(4)]
    means = words_of.groupBy("text_no").agg(F.array(*parts).alias("mean"))
    found = model.transform(tokens).select("text_no", vector_to_array("vector").alias("vector")).join(means, "text_no", "left")
    far = [F.abs(F.col("vector")[i] - F.coalesce(F.col("mean")[i], F.lit(0.0))) > 1e-5 for i in range(4)]
    wrong = F.greatest(*[f.cast("long") for f in far])
    return found.agg(F.count(F.lit(1)).alias("texts"), F.sum(wrong).alias("differing"))


@query
def pca_facts(spark, sf):
    """What makes two columns the first principal components, but for their direction."""
    xy = textml.project_2d(inputs.embeddings(spark, sf)).select(vector_to_array("projection").alias("p"))
    x, y = F.col("p")[0], F.col("p")[1]
    return xy.agg(
        F.count(F.lit(1)).alias("points"),
        F.abs(F.round(F.covar_pop(x, y), 6)).alias("covariance"),
        (F.var_pop(x) >= F.var_pop(y)).alias("ordered"),
    )


@query
def ml_kmeans_facts(spark, sf):
    """Points, and those that are not with their nearest centre."""
    vectors = inputs.embeddings(spark, sf)
    model = textml.cluster_vectors(vectors, SEED, SHOWN_CLUSTERS)
    centers = [F.array(*[F.lit(float(v)) for v in c]) for c in model.clusterCenters()]
    point = vector_to_array("vector").alias("p")
    away = F.array(*[
        F.aggregate(F.zip_with("p", c, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, v: s + v) for c in centers
    ])
    placed = model.transform(vectors).select("cluster", point).select("cluster", away.alias("away"))
    wrong = F.col("away")[F.col("cluster")] > F.array_min("away") + 1e-9
    return placed.agg(F.count(F.lit(1)).alias("points"), F.sum(wrong.cast("long")).alias("misplaced"))


@query
def cluster_report_by_key(spark, sf):
    """The report of known clusters, the last of them empty."""
    clustered = _clean(spark, sf).withColumn("cluster", (F.col("doc_id") % SHOWN_CLUSTERS).cast("int"))
    report = textml.cluster_report(clustered, [[float(i), 0.5] for i in range(SHOWN_CLUSTERS + 1)])
    shown = F.transform("top_tokens", lambda t: F.concat_ws(":", t["token"], t["freq"].cast("string")))
    return report.select("cluster", "size", F.col("center")[0].alias("center_x"), F.array_join(shown, " ").alias("top"))


@query
def text_cluster_sizes(spark, sf):
    """From six-field lines to clusters: how many there are and how many texts they hold."""
    texts = readers.tail_field_text(inputs.short_text_lines(spark, sf))
    found = plans.cluster_texts(texts, inputs.STOP_WORDS, SEED, SHOWN_CLUSTERS, 4, tasks=TASKS)
    return found.report.agg(F.count(F.lit(1)).alias("clusters"), F.sum("size").alias("texts"))


@query
def silhouette_sweep(spark, sf):
    tokens = stage(_clean(spark, sf).select("kept"), "tokens")
    return textml.sweep(tokens, [(4, 3, 2), (8, 3, 2), (4, 5, 1)], SEED)


@query
def silhouette_sweep_facts(spark, sf):
    """What must hold of a sweep whatever the random numbers are: its settings, the order of its rows, and values that are
    those of the same fit made alone."""
    tokens = stage(_clean(spark, sf).select("kept"), "tokens")
    grid = [(3, 3, 2), (5, 3, 2), (4, 2, 1)]
    corpus, made = textml.Corpus(tokens), {}
    for _, size, count in grid:
        model = textml.word_vectors(corpus, SEED, size, count, TASKS)
        made[size, count] = stage(textml.text_vectors(model, corpus), "vectors")
    found = textml.score_settings(made, grid, SEED).collect()
    in_order = found == sorted(found, key=lambda r: (-r["silhouette"], r["k"]))
    rows = []
    for k, size, count, value in found:
        vectors = made[size, count]
        alone = textml.silhouette(textml.cluster_vectors(vectors, SEED, k).transform(vectors))
        rows.append((k, size, count, in_order, abs(alone - value) < 1e-6))
    return spark.createDataFrame(rows, "k int, vector_size int, min_count int, in_order boolean, as_alone boolean")


# ---- comparison ----------------------------------------------------------------------------


def _two_ratings(spark, sf):
    expected = inputs.ratings(spark, sf)
    other = F.when(F.col("user_id").cast("long") % 7 == 0, F.col("rating") + 0.5).otherwise(F.col("rating"))
    both = [df.withColumnRenamed("rating", "score") for df in (expected, expected.withColumn("rating", other))]
    return both


@query
def result_diff(spark, sf):
    return compare.result_diff(*_two_ratings(spark, sf))


@query
def topk_diff(spark, sf):
    left = inputs.documents(spark, sf)
    chat = inputs.table(spark, sf, "conversations").select("text")
    return compare.top_k_diff(
        plans.top_k_common_words(left, inputs.benchmark(spark, sf), inputs.STOP_WORDS, 20, "text"),
        plans.top_k_common_words(left, chat, inputs.STOP_WORDS, 20, "text"),
    )


@query
def top_k_verdict(spark, sf):
    """A top-k result against itself, against itself in reverse, and against one of another corpus."""
    left = inputs.documents(spark, sf)
    chat = inputs.table(spark, sf, "conversations").select("text")
    expected, other = (
        stage(
            words.top_n_per_group(
                plans.top_k_common_words(left, right, inputs.STOP_WORDS, 20, "text").withColumn("all", F.lit(1)), "all", 20
            ).drop("all"),
            "top",
        )
        for right in (inputs.benchmark(spark, sf), chat)
    )
    turned = expected.withColumn("rank", -F.col("rank"))
    cases = {"same": expected, "turned": turned, "other": other}
    rows = [(case, compare.top_k_verdict(expected.select("cnt", "word"), ranked)) for case, ranked in cases.items()]
    return spark.createDataFrame(rows, "case string, verdict string")


@query
def result_verdict(spark, sf):
    scores = inputs.ratings(spark, sf).withColumnRenamed("rating", "score")
    turned = scores.select(F.col("item_id").alias("user_id"), F.col("user_id").alias("item_id"), "score")
    return spark.createDataFrame([(compare.result_verdict(scores, turned),)], "verdict string")


@query
def order_breaks(spark, sf):
    lang_and_rank = textml.token_report(_clean(spark, sf).withColumn("lang", F.lit("all")), "lang", n=RANKS)
    raised = F.when(F.col("rank") % 5 == 0, F.col("cnt") + 100).otherwise(F.col("cnt"))
    return compare.order_breaks(lang_and_rank.withColumn("cnt", raised))


# ---- sinks, read back ----------------------------------------------------------------------


@query
def kv_sink(spark, sf):
    path = new_path(spark, "word-count")
    writers.write_key_values(plans.word_count(inputs.spread_table(spark, sf, "documents", "text"), "text"), path, "word", "cnt")
    return readers.read_key_values(spark, path)


@query
def score_sink(spark, sf):
    path = new_path(spark, "scores")
    writers.write_scores(inputs.ratings(spark, sf).withColumnRenamed("rating", "score"), path, "tab")
    return readers.read_lines(spark, path)


@query
def score_csv_sink(spark, sf):
    path = new_path(spark, "scores")
    writers.write_scores(inputs.ratings(spark, sf).withColumnRenamed("rating", "score"), path)
    return readers.read_ratings(spark, path)


def _labelled_pairs(spark, sf):
    """Every two components of the vectors, with their label."""
    values = inputs.embeddings(spark, sf).select(vector_to_array("vector").alias("v"), F.col("label").alias("cluster"))
    starts = F.explode(F.sequence(F.lit(1), F.size("v") - 1, F.lit(2))).alias("at")
    two = array_to_vector(F.slice("v", F.col("at"), F.lit(2))).alias("projection")
    return values.select("v", "cluster", starts).select(two, "cluster")


@query
def projection_sink(spark, sf):
    path = new_path(spark, "projection")
    writers.write_projection(_labelled_pairs(spark, sf), path)
    return spark.read.csv(path, schema="x double, y double, cluster int")


@query
def projection_sink_bracketed(spark, sf):
    path = new_path(spark, "projection")
    writers.write_projection(_labelled_pairs(spark, sf), path, layout="bracketed")
    shown = spark.read.csv(path, schema="projection string, cluster int")
    part = F.split(F.expr("substring(projection, 2, length(projection) - 2)"), ",")
    return shown.select(part[0].cast("double").alias("x"), part[1].cast("double").alias("y"), "cluster")


@query
def text_sink(spark, sf):
    path = new_path(spark, "texts")
    writers.write_texts(inputs.short_texts(spark, sf), path)
    return readers.read_lines(spark, path).groupBy("value").agg(F.count(F.lit(1)).alias("cnt"))


@query
def short_text_csv(spark, sf):
    path = new_path(spark, "short-text-csv")
    docs = inputs.table(spark, sf, "documents")
    fixed = [F.lit(v).alias(n) for n, v in (("f0", "0"), ("f2", "Mon"), ("f3", "NO"), ("f4", "user"))]
    wide = docs.select(fixed[0], F.col("doc_id").cast("string").alias("f1"), *fixed[1:], "text")
    wide.write.csv(path, encoding="ISO-8859-1", quoteAll=True, escape='"', lineSep="\n")
    return readers.read_short_text_csv(spark, path, multi_line=True).select(F.md5("text").alias("digest"))
