"""Question-and-answer operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quern.functions.geometry import list_position

# Posting kinds, the topic list in its order, and the distance between topics.
QUESTION, ANSWER = 1, 2
TOPICS = (
    "Machine-Learning",
    "Compute-Science",
    "Algorithm",
    "Big-Data",
    "Data-Analysis",
    "Security",
    "Silicon Valley",
    "Computer-Systems",
    "Deep-learning",
    "Internet-Service-Providers",
    "Programming-Language",
    "Cloud-services",
    "Software-Engineering",
    "Embedded-System",
    "Architecture",
)
TOPIC_SPREAD = 50_000


def questions(postings: DataFrame) -> DataFrame:
    """The question rows (P5)."""
    return postings.where(F.col("posting_type") == QUESTION)


def answers(postings: DataFrame) -> DataFrame:
    """The answer rows that name a question."""
    return postings.where((F.col("posting_type") == ANSWER) & F.col("parent_id").isNotNull())


def question_answers(postings: DataFrame) -> DataFrame:
    """Every answer beside its question: question columns, `answer_id, answer_score`.

    Unanswered questions and orphan answers drop out. A question with very many answers is split
    by Spark's adaptive skew join.
    """
    replies = answers(postings).select(
        F.col("parent_id").alias("question_id"), F.col("id").alias("answer_id"), F.col("score").alias("answer_score")
    )
    asked = questions(postings)
    return asked.join(replies, asked["id"] == replies["question_id"]).drop("question_id")


def best_answers(postings: DataFrame) -> DataFrame:
    """One row per distinct question record with its best answer's score: `…, max_score`.

    One pass and no join: within each task, answers shrink to one row per question and questions to
    distinct records, and what is left meets by question id. So a question with very many answers
    is no burden. Postings that belong to no question shrink to one row per task.
    """
    asks = F.col("posting_type") == QUESTION
    replies = F.col("posting_type") == ANSWER
    marked = postings.select(
        F.when(asks, F.col("id")).when(replies, F.col("parent_id")).alias("question_id"),
        F.when(asks & F.col("id").isNotNull(), F.struct(*postings.columns)).alias("asked"),
        F.when(replies, F.col("score")).alias("answer_score"),
    )
    shrunk = marked.groupBy("question_id", "asked").agg(F.max("answer_score").alias("best"))
    per_question = Window.partitionBy("question_id")
    met = shrunk.select(
        "asked",
        F.max("best").over(per_question).alias("max_score"),
        F.max(F.col("asked").isNull()).over(per_question).alias("answered"),
    )
    return met.where("asked is not null and answered").select("asked.*", "max_score")


def topic_points(scored: DataFrame, topics: Sequence[str] = TOPICS, spread: int = TOPIC_SPREAD) -> DataFrame:
    """`id, x, y`: topic place times `spread`, and best score; unknown and missing topics drop out."""
    if spread <= 0:
        raise ValueError("spread must be positive")
    x = list_position(F.col("tag"), topics) * F.lit(spread).cast("long")
    return scored.select("id", x.alias("x"), F.col("max_score").cast("long").alias("y")).where("x > 0")
