"""Questions, answers, their authors and their tags."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.functions.tagtext import extract_tags, has_two_tags
from tagloom.functions.timing import minutes_between
from tagloom.schemas import ANSWER, QUESTION


def questions(posts: DataFrame) -> DataFrame:
    return posts.where(F.col("post_type_id") == QUESTION)


def answers(posts: DataFrame) -> DataFrame:
    return posts.where(F.col("post_type_id") == ANSWER)


def response_times(posts: DataFrame) -> DataFrame:
    """Each answer of a question that carries a tag text, and the minutes it took."""
    q = questions(posts).where("tags is not null")
    q = q.select(F.col("id").alias("question_id"), F.col("creation_date").alias("question_date"))
    a = answers(posts).select(
        F.col("parent_id").alias("question_id"),
        F.col("id").alias("answer_id"),
        F.col("creation_date").alias("answer_date"),
        F.col("owner_user_id").alias("answerer_id"),
    )
    minutes = minutes_between(F.col("question_date"), F.col("answer_date"))
    return a.join(q, "question_id").select(
        "question_id", "answer_id", "answerer_id", minutes.alias("response_time_minutes")
    )


def with_author(responses: DataFrame, users: DataFrame) -> DataFrame:
    """Answers by known users, with the author's reputation."""
    authors = users.select(
        F.col("id").alias("answerer_id"), F.col("reputation").alias("answerer_reputation")
    )
    return responses.join(authors, "answerer_id")


def accepted_answers(posts: DataFrame, tag: str | None = None, tag_rows: DataFrame | None = None) -> DataFrame:
    """Each question that accepted an answer, with that answer.

    With ``tag`` only questions that carry it, once per occurrence: what a join
    to the post-tag rows of that tag gives, but without shuffling by tag. With a stored post-tag table
    as ``tag_rows`` it is that join, and no tag text is read.
    """
    q = questions(posts).where("accepted_answer_id is not null")
    if tag is not None and tag_rows is not None:
        q = with_tag(q, tag_rows, tag)
    elif tag is not None:
        q = q.where(F.contains("tags", F.lit(tag)))
        q = q.withColumn("tag", F.explode(F.filter(extract_tags(F.col("tags")), lambda x: x == tag)))
    q = q.select(
        F.col("accepted_answer_id").alias("answer_id"),
        F.col("id").alias("question_id"),
        F.col("title").alias("question_title"),
        F.col("creation_date").alias("question_date"),
    )
    a = answers(posts).select(
        F.col("id").alias("answer_id"),
        F.col("score").alias("answer_score"),
        F.col("creation_date").alias("answer_date"),
        F.col("owner_user_id").alias("user_id"),
    )
    return q.join(a, "answer_id")


def post_tags(posts: DataFrame) -> DataFrame:
    """One row per post and tag occurrence."""
    # Answers have an empty text; the filter reaches the scan.
    return posts.where("tags <> ''").select(
        F.col("id").alias("post_id"), F.explode(extract_tags(F.col("tags"))).alias("tag")
    )


def unfold_tag_pairs(rows: DataFrame, tag: str | None = None) -> DataFrame:
    """A row per pair tag1 < tag2 out of the array column ``tags``, which goes.

    A repeated tag repeats its pairs. With ``tag`` only pairs that start with
    it, once more per occurrence of it: as rows do when they are also joined to
    the post-tag rows of that tag. Pairs stream out one by one, so a text with
    very many tags needs no more memory than its tags.
    """
    rest = [c for c in rows.columns if c != "tags"]
    # Outer, as the plain form first filters by the array's size, below the select
    # that made it, and so splits the text twice. The last filter drops NULLs.
    if tag is None:
        rows = rows.select("*", F.explode_outer("tags").alias("tag1"))
    else:
        rows = rows.select("*", F.filter("tags", lambda t: t == tag).alias("_anchor"))
        rows = rows.select(*rest, "tags", "_anchor", F.explode_outer("_anchor").alias("tag1"))
        rows = rows.select(*rest, "tags", "tag1", F.explode_outer("_anchor"))
    pairs = rows.select(*rest, "tag1", F.explode_outer("tags").alias("tag2"))
    return pairs.where("tag1 < tag2")


def with_tag(posts: DataFrame, tag_rows: DataFrame, tag: str) -> DataFrame:
    """Posts that carry the tag, by a join to a stored post-tag table; a repeated
    tag repeats its post. Worth it where the tag is rare: the stored table is laid
    out by tag and the tag texts are not read."""
    found = tag_rows.where(F.col("tag") == tag).select("post_id")
    return posts.join(found, posts["id"] == found["post_id"]).drop("post_id")


def question_tag_pairs(posts: DataFrame) -> DataFrame:
    """One row per question and unordered pair of its tags."""
    q = questions(posts).where(has_two_tags(F.col("tags")))
    q = q.select(F.col("id").alias("question_id"), extract_tags(F.col("tags")).alias("tags"))
    return unfold_tag_pairs(q)
