"""Joins on keys that a third of all rows share."""

import statistics

import pytest
from pyspark.sql import functions as F

from tagloom.operators.references import null_dangling
from tagloom.operators.spread import heavy_keys, spread_join
from tagloom.plans.reputation_pairs import reputation_pairs


@pytest.fixture
def shuffled(spark):
    """Plans as for tables too big to broadcast, without adaptive help."""
    kept = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16"}
    for k, v in kept.items():
        spark.conf.set(k, v)
    yield
    for k in kept:
        spark.conf.unset(k)
    spark.conf.set("spark.sql.shuffle.partitions", "8")


@pytest.fixture
def answers(spark):
    """Author 7 wrote a third of all answers; some have no author, some an unknown one."""
    n = F.col("id")
    owner = F.when(n % 3 == 0, 7).when(n % 50 == 1, None).otherwise(n * 31 % 5000 + 100)
    return spark.range(60_000).select(n.alias("answer"), owner.cast("long").alias("owner"))


def users(spark):
    rows = spark.range(4000).select((F.col("id") + 100).alias("owner"), (F.col("id") % 900).alias("reputation"))
    return rows.unionByName(spark.createDataFrame([(7, 5000)], "owner long, reputation long"))


def test_rows_are_those_of_a_plain_join(spark, shuffled, answers):
    expected = answers.join(users(spark), "owner")
    found = spread_join(answers, users(spark), "owner")
    assert found.columns == ["owner", "answer", "reputation"]
    assert found.count() == expected.count()
    assert found.exceptAll(expected.select(*found.columns)).isEmpty()


def test_no_task_gets_a_third_of_the_rows(spark, shuffled, answers):
    def sizes(df):
        rows = df.select("answer", "reputation").groupBy(F.spark_partition_id().alias("task")).count().collect()
        return [r["count"] for r in rows]

    plain = sizes(answers.join(users(spark), "owner"))
    assert max(plain) > 3 * statistics.median(plain)
    spread = sizes(spread_join(answers, users(spark), "owner"))
    assert max(spread) <= 3 * statistics.median(spread)


def test_heavy_keys_are_few(spark, answers):
    heavy = heavy_keys(answers, "owner", 16).collect()
    assert [r["owner"] for r in heavy] == [7] and 9 <= heavy[0]["salts"] <= 12
    assert heavy_keys(answers.limit(0), "owner", 16).count() == 0
    even = spark.range(1000).select((F.col("id") % 100).alias("owner"))
    assert heavy_keys(even, "owner", 16).count() == 0


def test_a_small_side_is_joined_as_it_is(spark, answers):
    small = users(spark)
    assert "_salt" not in spread_join(answers, small.limit(10), "owner")._jdf.queryExecution().toString()


def test_a_hot_author_changes_no_report(spark, shuffled):
    n = F.col("id")
    questions = spark.range(300).select(
        n, F.lit(1).alias("post_type_id"), F.lit(None).cast("long").alias("parent_id"), F.lit(5).cast("long").alias("owner_user_id"),
        F.expr("timestamp_ntz'2020-01-01 00:00:00'").alias("creation_date"), F.concat(F.lit("<a><b"), n % 5, F.lit(">")).alias("tags"),
    )
    replies = spark.range(9000).select(
        (n + 1000).alias("id"), F.lit(2).alias("post_type_id"), (n % 300).alias("parent_id"),
        F.when(n % 3 == 0, 7).otherwise(100 + n % 700).cast("long").alias("owner_user_id"),
        F.expr("timestamp_ntz'2020-01-01 00:00:00' + make_dt_interval(0, 0, cast(id % 77 as int))").alias("creation_date"), F.lit("").alias("tags"),
    )
    posts = questions.unionByName(replies)
    authors = spark.range(900).select(n, (n * 7 % 1000).cast("int").alias("reputation"))
    spread = reputation_pairs(posts, authors)
    assert "_salt" in spread._jdf.queryExecution().toString()
    rows = [tuple(r) for r in spread.collect()]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m")
    assert rows == [tuple(r) for r in reputation_pairs(posts, authors).collect()] and len(rows) == 5


def test_a_hot_dangling_value(spark, shuffled):
    rows = spark.range(9000).select("id", F.when(F.col("id") % 3 == 0, 999_999).otherwise(F.col("id") % 2000).alias("parent_id"))
    ids = spark.range(1500).select("id")
    found = null_dangling(rows, {"parent_id": ids}, broadcast_values=0)
    expected = rows.withColumn("parent_id", F.when(F.col("parent_id") < 1500, F.col("parent_id")))
    assert found.exceptAll(expected).isEmpty() and found.count() == 9000
