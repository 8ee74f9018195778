"""Tag texts, time differences and statistics of groups."""

import datetime
import itertools
import statistics

import pytest
from pyspark.sql import functions as F

from tagloom.functions.stats import Moments, corr_or_null
from tagloom.functions.tagtext import extract_tags, has_two_tags
from tagloom.functions.timing import epoch_millis, micros_between, minutes_between
from tagloom.operators.posts import post_tags, unfold_tag_pairs

T = datetime.datetime


@pytest.mark.parametrize(
    "text, tags",
    [
        ("<mysql><innodb>", ["mysql", "innodb"]),
        ("<a><a><b>", ["a", "a", "b"]),
        ("|a|b|", ["|a|b|"]),
        ("a b\t\nc", ["a", "b", "c"]),
        ("<c#><.net-4.0>", ["c#", ".net-4.0"]),
        ("><", []),
        ("", []),
        ("  ", []),
        (None, None),
    ],
)
def test_extract_tags(spark, text, tags):
    df = spark.createDataFrame([(1, text)], "id long, tags string")
    row = df.select(extract_tags(F.col("tags")), has_two_tags(F.col("tags"))).first()
    assert row[0] == tags
    assert bool(row[1]) == (len(tags or []) >= 2)
    assert [r["tag"] for r in post_tags(df).collect()] == (tags or [])


@pytest.mark.parametrize("tags", [[], ["a"], ["b", "a"], ["a", "a", "b"], list("fbdace"), ["x"] * 3])
def test_tag_pairs(spark, tags):
    df = spark.createDataFrame([(1, tags)], "id long, tags array<string>")
    pairs = unfold_tag_pairs(df)
    assert pairs.columns == ["id", "tag1", "tag2"]
    got = sorted((r["tag1"], r["tag2"]) for r in pairs.collect())
    assert got == sorted(p for p in itertools.product(tags, tags) if p[0] < p[1])
    if len(set(tags)) == len(tags):
        assert len(got) == len(tags) * (len(tags) - 1) // 2


def test_anchored_pairs_repeat_as_a_join_would(spark):
    tags = ["b", "a", "b", "c", "d"]
    df = spark.createDataFrame([(tags, 1)], "tags array<string>, id long")
    got = sorted((r["tag1"], r["tag2"]) for r in unfold_tag_pairs(df, "b").collect())
    expected = sorted(
        (x, y) for scope in tags if scope == "b" for x in tags if x == "b" for y in tags if x < y
    )
    assert got == expected
    assert unfold_tag_pairs(df, "z").collect() == []


@pytest.mark.parametrize(
    "start, end",
    [
        (T(2020, 1, 1), T(2020, 1, 1, 1, 0, 0, 120000)),
        (T(2020, 1, 1), T(2019, 12, 31, 23, 59, 59, 999999)),
        (T(1, 1, 1), T(2024, 2, 29, 12, 30, 15, 1)),
        (T(2011, 3, 13, 1), T(2011, 3, 13, 4)),
    ],
)
@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_time_between(spark, start, end, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(start, end)], "s timestamp_ntz, e timestamp_ntz")
        s, e = F.col("s"), F.col("e")
        row = df.select(micros_between(s, e), minutes_between(s, e), epoch_millis(s)).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    micros = (end - start) // datetime.timedelta(microseconds=1)
    assert row[0] == micros
    assert row[1] == micros / 6e7
    assert row[2] == (start - T(1970, 1, 1)) // datetime.timedelta(milliseconds=1)


GROUPS = {
    "spread": [(5, 1), (7, 4), (1, -3), (12, 9)],
    "one row": [(5, 1)],
    "x constant": [(5, 1), (5, 2), (5, 3)],
    "y constant": [(5, 1), (6, 1), (8, 1)],
    "both constant": [(5, 1), (5, 1)],
    # means far larger than the spread
    "narrow": [(10**12, 2_000_000_000), (10**12 + 1, 2_000_000_001), (10**12 + 2, 2_000_000_001)],
    "negative": [(-(6 * 10**13), 3), (-(6 * 10**13) + 60_000, 5), (-(6 * 10**13) - 9, -2)],
}


def expected_stats(pairs):
    x, y = [float(p[0] - pairs[0][0]) for p in pairs], [float(p[1] - pairs[0][1]) for p in pairs]
    try:
        corr = statistics.correlation(x, y)
    except statistics.StatisticsError:
        corr = None
    return statistics.stdev(x) if len(pairs) > 1 else None, corr


@pytest.mark.parametrize("name", GROUPS)
def test_moments_added_up_in_parts(spark, name):
    pairs = GROUPS[name]
    m = Moments()
    origin = 1_234_567
    # each part has its own origin, as each question has its own date
    data = [(i % 2, x + origin * (i % 2), y) for i, (x, y) in enumerate(pairs)]
    parts = (
        spark.createDataFrame(data, "part int, x long, y int")
        .groupBy("part")
        .agg(*m.of_rows(F.col("x"), F.col("y")))
        .select(*m.shifted(F.col("part") * origin))
    )
    row = m.statistics(parts.agg(*m.of_sums())).first()
    deviation, corr = expected_stats(pairs)
    assert row[0] == len(pairs)
    assert row[1] == pytest.approx(sum(p[0] for p in pairs) / len(pairs), rel=1e-15)
    assert row[2] == pytest.approx(sum(p[1] for p in pairs) / len(pairs), rel=1e-15)
    assert row[3] == (deviation if deviation is None else pytest.approx(deviation, rel=1e-12))
    assert row[4] == (corr if corr is None else pytest.approx(corr, rel=1e-12))


def test_rows_without_x_count_but_do_not_weigh(spark):
    m = Moments()
    data = [(1, 10, 3), (1, None, 100), (1, 14, 5), (2, None, 8), (3, 7, 50), (1, 18, 1)]
    origins = {1: 4, 2: 4, 3: None}  # nothing is known in group 3
    per_group = spark.createDataFrame(data, "g int, x long, y int").groupBy("g")
    sums = per_group.agg(*m.of_rows(F.col("x"), F.col("y")))
    shift = spark.createDataFrame(list(origins.items()), "g int, o long")
    parts = sums.join(shift, "g").select("g", *m.shifted(F.col("o")))
    row = m.statistics(parts.agg(*m.of_sums())).first()
    x, y = [6, 10, 14], [3, 5, 1]
    assert row[0] == 6
    assert row[1] == 10
    assert row[2] == pytest.approx(sum(r[2] for r in data) / 6)
    assert row[3] == pytest.approx(statistics.stdev(x))
    assert row[4] == pytest.approx(statistics.correlation(x, y))
    alone = m.statistics(parts.where("g > 1").groupBy("g").agg(*m.of_sums()), "g")
    assert {tuple(r)[1:] for r in alone.collect()} == {(1, None, 8.0, None, None), (1, None, 50.0, None, None)}
    masked = spark.createDataFrame([(6, 3), (10, 5), (14, 1), (None, 900), (77, None)], "x int, y int")
    got = masked.agg(corr_or_null(F.col("x"), F.col("y"))).first()[0]
    assert got == pytest.approx(statistics.correlation(x, y))


@pytest.mark.parametrize("name", [n for n in GROUPS if n not in ("narrow", "negative")])
def test_corr_or_null(spark, name):
    df = spark.createDataFrame([(float(x), y) for x, y in GROUPS[name]], "x double, y int")
    corr = expected_stats(GROUPS[name])[1]
    got = df.agg(corr_or_null(F.col("x"), F.col("y"))).first()[0]
    assert got == (corr if corr is None else pytest.approx(corr, rel=1e-12))


def test_moments_of_many_far_rows_do_not_overflow(spark):
    # rows without a usable date carry the year 1
    m = Moments()
    df = spark.range(100_000).select(F.lit(-62135596800000).alias("x"), F.lit(2147483647).alias("y"))
    sums = df.agg(*m.of_rows(F.col("x"), F.col("y"))).select(*m.shifted(F.lit(1735689600000)))
    row = m.statistics(sums).first()
    mean = -62135596800000.0 - 1735689600000.0
    assert tuple(row) == (100_000, mean, 2147483647.0, 0.0, None)


def test_unknown_values_count_for_what_they_tell(spark):
    data = [(1, 10), (5, None), (None, 40), (7, 30), (9, 20), (None, None)]
    df = spark.createDataFrame(data, "x long, y int")
    m = Moments()
    parts = df.groupBy(F.spark_partition_id()).agg(*m.of_rows(F.col("x") + 100, F.col("y")))
    parts = parts.select(*m.shifted(F.lit(100)))
    row = m.statistics(parts.agg(*m.of_sums())).first()
    expected = df.agg(F.avg("x"), F.avg("y"), F.stddev_samp("x"), corr_or_null(F.col("x"), F.col("y"))).first()
    assert row["row_count"] == 6
    assert [row[c] for c in ("mean_x", "mean_y", "stddev_x", "corr")] == pytest.approx(list(expected))
    nothing = df.where("y is null").agg(*m.of_rows(F.col("x"), F.col("y")))
    assert [m.statistics(nothing).first()[c] for c in ("mean_y", "corr")] == [None, None]
