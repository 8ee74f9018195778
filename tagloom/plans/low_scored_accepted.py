"""Answers that were accepted as best in spite of a low score."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.operators.posts import accepted_answers


def low_scored_accepted(
    posts: DataFrame,
    users: DataFrame,
    max_score: int = 5,
    limit: int | None = 20,
    tag: str | None = None,
    tag_rows: DataFrame | None = None,
) -> DataFrame:
    """Accepted answers with a score up to ``max_score`` by known users, lowest
    first, then by the newest question. With ``tag`` only of questions that carry it, which
    a stored post-tag table (``tag_rows``) tells without reading tag texts."""
    authors = users.select(
        F.col("id").alias("user_id"),
        F.col("display_name").alias("user_name"),
        F.col("reputation").alias("user_reputation"),
    )
    found = accepted_answers(posts, tag, tag_rows).where(F.col("answer_score") <= max_score)
    found = found.join(authors, "user_id")
    if limit is not None:
        found = found.orderBy(
            F.col("answer_score").asc_nulls_last(),
            F.col("question_date").desc_nulls_first(),
            "answer_id",
        ).limit(limit)
    return found.select(
        "answer_id",
        "question_id",
        "question_title",
        "answer_score",
        "answer_date",
        "user_id",
        "user_name",
        "user_reputation",
    )
