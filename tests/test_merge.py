"""Merges of rows with known and unknown keys."""

import random

import pytest
from pyspark.sql import functions as F

from tagloom.operators.merge import collapse_repeats, insert_ignore, merge_upsert

SCHEMA = "id long, a string, b int, at int"


def fold(base, new, update):
    """Row after row, as a database would take them."""
    names = ["id", "a", "b", "at"]
    known = {r[0]: dict(zip(names, r)) for r in base}
    for r in sorted(new, key=lambda r: r[3]):
        row = dict(zip(names, r))
        if row["id"] not in known:
            known[row["id"]] = row
        else:
            known[row["id"]].update({c: row[c] for c in update})
    return sorted((tuple(r.values()) for r in known.values()), key=repr)


@pytest.mark.parametrize("split_above", [1_000_000, 0], ids=["whole base", "key range"])
@pytest.mark.parametrize("update", [(), ("b",), ("a", "b")])
def test_same_as_row_by_row(spark, rows, update, split_above):
    random.seed(3)
    base = [(i, f"base{i}", i, -1) for i in range(-20, 120, 2)]
    new = [
        (random.randrange(80), random.choice([None, f"new{t}"]), random.choice([None, t]), t)
        for t in range(150)
    ]
    # a third of the rows share one key
    new += [(7, f"hot{t}", t, t) for t in range(150, 225)]
    random.shuffle(new)
    got = merge_upsert(
        spark.createDataFrame(base, SCHEMA),
        spark.createDataFrame(new, SCHEMA).repartition(5),
        update=update,
        order=F.col("at"),
        split_above=split_above,
    )
    assert rows(got) == fold(base, new, update)


def test_merging_a_table_with_itself_changes_nothing(spark, rows):
    df = spark.createDataFrame([(i, f"r{i}", None if i % 3 else i, 0) for i in range(30)], SCHEMA)
    assert rows(merge_upsert(df, df, update=("a", "b"))) == rows(df)
    assert rows(insert_ignore(df, df)) == rows(df)


def test_a_null_overwrites(spark, rows):
    base = spark.createDataFrame([(1, "x", 5, 0)], SCHEMA)
    new = spark.createDataFrame([(1, "y", None, 0)], SCHEMA)
    assert rows(merge_upsert(base, new, update=("b",))) == [(1, "x", None, 0)]


def test_empty_sides(spark, rows):
    full = spark.createDataFrame([(1, "x", 5, 0)], SCHEMA)
    none = spark.createDataFrame([], SCHEMA)
    assert rows(merge_upsert(none, full, update=("a",))) == rows(full)
    assert rows(merge_upsert(full, none, update=("a",))) == rows(full)
    assert rows(insert_ignore(none, none)) == []


def test_repeats_without_an_order_collapse_repeatably(spark, rows):
    data = [(1, "x", 1, 0), (1, "y", 2, 0), (1, None, 3, 0), (2, "z", 1, 0)]
    results = {
        repr(rows(collapse_repeats(spark.createDataFrame(random.sample(data, 4), SCHEMA).repartition(n))))
        for n in (1, 2, 4)
    }
    assert len(results) == 1


def test_keys_without_a_value_collapse_too(spark, rows):
    data = [(None, "x", 1, 0), (None, "y", 2, 1), (1, "z", 1, 0), (None, "w", 3, 2)]
    got = collapse_repeats(spark.createDataFrame(data, SCHEMA), update=("b",), order=F.col("at"))
    assert rows(got) == [(1, "z", 1, 0), (None, "x", 3, 0)]


def test_unique_rows_are_not_grouped(spark):
    df = spark.range(100).withColumn("wide", F.lit("w"))
    assert collapse_repeats(df) is df


def test_rows_outside_the_key_range_are_not_shuffled(spark, tmp_path):
    # Range-partitioned by key, as a dump is.
    spark.range(1000).selectExpr("id", "cast(id as string) as a", "1 as b", "0 as at").write.parquet(
        str(tmp_path / "base")
    )
    base = spark.read.parquet(str(tmp_path / "base"))
    new = spark.range(40).selectExpr("id", "'n' as a", "2 as b", "0 as at")
    got = merge_upsert(base, new, update=("b",), split_above=0)
    assert got.where("b = 2").count() == 40 and got.count() == 1000
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(id), GreaterThanOrEqual(id,0), LessThanOrEqual(id,39)]" in plan


@pytest.mark.parametrize("new", [[(None, "n")], [(None, "n"), (2, "m")], []])
def test_null_keys_lose_no_row_either_way(spark, rows, new):
    base = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "id long, x string")
    df = spark.createDataFrame(new, "id long, x string")
    usual = rows(merge_upsert(base, df, update=["x"]))
    assert rows(merge_upsert(base, df, update=["x"], split_above=0)) == usual
    assert len(usual) == 3 + (1 if new else 0)


def test_new_rows_are_computed_once(spark):
    from pyspark.sql import functions as F

    from tagloom.operators.merge import merge_upsert

    runs = spark.sparkContext.accumulator(0)

    def count(batches):
        runs.add(1)
        yield from batches

    new = spark.range(5, 15, 1, 1).select("id", F.lit(2).alias("n")).mapInArrow(count, "id long, n int")
    base = spark.range(10).select("id", F.lit(1).alias("n"))
    merged = merge_upsert(base, new, update=["n"], split_above=0)
    assert sorted(map(tuple, merged.collect())) == [*((i, 1) for i in range(5)), *((i, 2) for i in range(5, 15))]
    assert runs.value == 1


def test_keys_of_a_big_table_are_not_broadcast(spark, tmp_path):
    """Nor is any parent's id, whatever the planner takes its size for."""
    from pyspark.sql import functions as F

    from tagloom.operators.merge import merge_upsert
    from tagloom.operators.references import without_target

    spark.range(1000).select("id", F.lit("x").alias("text"), F.lit(1).alias("n")).write.parquet(f"{tmp_path}/base")
    base = spark.read.parquet(f"{tmp_path}/base")
    new = base.select(F.col("id") * 2 + 1, "text", F.lit(2)).toDF("id", "text", "n")
    for split in (0, 1_000_000):
        merged = merge_upsert(base, new, update=["n"], split_above=split)
        assert merged.count() == 1500 and merged.where("n = 2").count() == 1000
        plan = merged._jdf.queryExecution().optimizedPlan().toString()
        assert ("strategy=merge" if split == 0 else "LeftSemi") in plan
    gone = without_target(spark.range(990, 1010).select(F.col("id").alias("value")), base.select("id"))
    assert sorted(r[0] for r in gone.collect()) == list(range(1000, 1010))
    assert "strategy=merge" in gone._jdf.queryExecution().optimizedPlan().toString()
