"""Which tags occur together, how fast they are answered and by whom.

Row by row this would join every answer to its question and repeat it for every
tag pair. Instead the answers are summed up per question first. A question with
a third of all answers is then one row per task at the join, and a question's
pairs are unfolded once, not once per answer. An author of a third of all answers is met by
many tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.functions.stats import Moments
from tagloom.functions.tagtext import extract_tags, has_two_tags
from tagloom.functions.timing import epoch_millis
from tagloom.operators.posts import answers, questions, unfold_tag_pairs
from tagloom.operators.spread import spread_join

# x: answer time in milliseconds, y: reputation of the author
M = Moments()
MILLIS_PER_MINUTE = 60_000


def reputation_pairs(
    posts: DataFrame,
    users: DataFrame,
    min_count: int = 2,
    limit: int | None = 20,
    tag: str | None = None,
) -> DataFrame:
    """Per tag pair of a question: number of answers by known users, mean and
    deviation of the minutes to answer, mean reputation, their correlation.

    With ``tag`` only questions that carry it, and pairs that start with it.
    """
    q = questions(posts).where(has_two_tags(F.col("tags")))
    if tag is not None:
        q = q.where(F.contains("tags", F.lit(tag)))
    q = q.select("id", "tags", epoch_millis(F.col("creation_date")).alias("asked"))
    answered_by = answers(posts).where("parent_id is not null")
    if tag is not None:  # few questions: their answers are picked before they meet the authors
        answered_by = answered_by.join(q.select(F.col("id").alias("parent_id")), "parent_id", "left_semi")
    authors = users.select(F.col("id").alias("owner_user_id"), "reputation")
    timed = answered_by.select("parent_id", "owner_user_id", epoch_millis(F.col("creation_date")).alias("time"))
    per_question = (
        spread_join(timed, authors, "owner_user_id")
        .groupBy("parent_id")
        .agg(*M.of_rows(F.col("time"), F.col("reputation")))
    )
    answered = q.join(per_question, q["id"] == per_question["parent_id"])
    # Tags and shift once per question, before the pairs unfold.
    answered = answered.select(extract_tags(F.col("tags")).alias("tags"), *M.shifted(F.col("asked")))
    per_pair = unfold_tag_pairs(answered, tag).groupBy("tag1", "tag2").agg(*M.of_sums())
    found = M.statistics(per_pair.where(M["rows"] >= min_count), "tag1", "tag2")
    result = found.select(
        "tag1",
        "tag2",
        F.col("row_count").alias("pair_count"),
        (F.col("mean_x") / MILLIS_PER_MINUTE).alias("avg_response_time_minutes"),
        F.col("mean_y").alias("avg_answerer_reputation"),
        (F.col("stddev_x") / MILLIS_PER_MINUTE).alias("stddev_response_time"),
        F.col("corr").alias("correlation_time_reputation"),
    )
    if limit is None:
        return result
    return result.orderBy(
        F.col("pair_count").desc_nulls_first(),
        F.col("avg_response_time_minutes").asc_nulls_last(),
        "tag1",
        "tag2",
    ).limit(limit)
