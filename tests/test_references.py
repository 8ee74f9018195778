"""References without a target."""

import random

import pytest

from tagloom.fixtures import full, table
from tagloom.operators.audit import fk_audit, not_null_audit, pk_audit
from tagloom.operators.references import dangling_values, null_dangling, orphan_rows
from tagloom.schemas import ENTITIES, REPAIRED_KEYS

SCHEMA = "id long, x long, y long, wide string"


@pytest.fixture(scope="module")
def children(spark):
    random.seed(5)
    values = [None, None, 1, 2, 3, 404, 404, 404, 500, 0]
    return [(i, random.choice(values), random.choice(values), f"w{i}") for i in range(300)]


@pytest.mark.parametrize("broadcast_values", [1_000_000, 0], ids=["broadcast", "by key"])
def test_null_dangling(spark, rows, children, broadcast_values):
    df = spark.createDataFrame(children, SCHEMA)
    parents = {
        "x": spark.createDataFrame([(1,), (2,), (3,)], "id long"),
        "y": spark.createDataFrame([(0,), (404,)], "some_id long"),
    }
    got = null_dangling(df, parents, broadcast_values=broadcast_values)
    expected = [
        (i, x if x in (1, 2, 3) else None, y if y in (0, 404) else None, w) for i, x, y, w in children
    ]
    assert rows(got) == sorted(expected, key=repr)
    assert got.columns == df.columns
    same_parent = dict.fromkeys(parents, parents["x"])
    got_same = null_dangling(df, same_parent, broadcast_values=broadcast_values)
    known = (1, 2, 3)
    expected = [(i, x if x in known else None, y if y in known else None, w) for i, x, y, w in children]
    assert rows(got_same) == sorted(expected, key=repr)
    again = null_dangling(got, parents, broadcast_values=broadcast_values)
    assert rows(again) == rows(got)


def test_repeated_and_null_keys_get_the_same_answer_either_way(spark, rows):
    data = [(1, 404, 3), (1, 3, 404), (None, 404, None), (None, 3, 3), (2, None, 500), (1, 404, 3)]
    df = spark.createDataFrame(data, "id long, x long, y long")
    known = spark.createDataFrame([(3,)], "id long")
    expected = [(i, 3 if x == 3 else None, 3 if y == 3 else None) for i, x, y in data]
    for broadcast_values in (1_000_000, 0):
        got = null_dangling(df, {"x": known, "y": known}, broadcast_values=broadcast_values)
        assert rows(got) == sorted(expected, key=repr)


def test_nothing_dangling_leaves_the_plan_alone(spark):
    df = spark.createDataFrame([(1, 2), (2, None)], "id long, x long")
    got = null_dangling(df, {"x": df.select("id")})
    assert "Join" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_dangling_values_and_orphan_rows(spark, rows, children):
    df = spark.createDataFrame(children, SCHEMA)
    ids = spark.createDataFrame([(1,), (2,), (3,)], "id long")
    assert rows(dangling_values(df, ["x"], ids), "value") == [(0,), (404,), (500,)]
    both = dangling_values(df, ["x", "y"], spark.createDataFrame([(404,)], "id long"))
    for value, in_x, in_y in both.collect():
        assert in_x == any(r[1] == value for r in children)
        assert in_y == any(r[2] == value for r in children)
    expected = [r for r in children if r[1] in (0, 404, 500)]
    assert rows(orphan_rows(df, "x", ids)) == sorted(expected, key=repr)


def test_repaired_posts_pass_the_audit(spark, sf_dir):
    tables = {name: table(spark, sf_dir, name) for name in ENTITIES}
    parents = {c: tables[p].select("id") for c, p in REPAIRED_KEYS.items()}
    before = {tuple(r)[:2]: r["orphan_rows"] for r in fk_audit(tables).collect()}
    assert before["posts", "owner_user_id"] > 0 and before["posts", "accepted_answer_id"] > 0
    tables["posts"] = null_dangling(tables["posts"], parents)
    after = {tuple(r)[:2]: r["orphan_rows"] for r in fk_audit(tables).collect()}
    assert all(after["posts", column] == 0 for column in parents)
    assert after["votes", "post_id"] == before["votes", "post_id"] > 0


def small_tables(spark, **given):
    return {
        name: full(given.get(name, spark.range(1).select("id")), entity)
        for name, entity in ENTITIES.items()
    }


def test_audits_count_what_is_wrong(spark):
    posts = spark.createDataFrame(
        [(1, 1, None, 5), (1, None, None, 5), (2, 2, 9, 5), (None, 2, 9, 1)],
        "id long, post_type_id int, parent_id long, owner_user_id long",
    )
    tables = small_tables(spark, posts=posts)
    pk = {r["table_name"]: tuple(r)[1:] for r in pk_audit(tables).collect()}
    assert pk["posts"] == (4, 2, 1, 1)
    assert pk["users"] == (1, 1, 0, 0)
    nulls = {tuple(r)[:2]: r["null_rows"] for r in not_null_audit(tables).collect()}
    assert nulls["posts", "post_type_id"] == 1
    assert nulls["posts", "creation_date"] == 0
    assert len(nulls) == 22
    fk = {tuple(r)[:2]: tuple(r)[3:] for r in fk_audit(tables).collect()}
    assert fk["posts", "parent_id"] == (2, 1)
    assert fk["posts", "owner_user_id"] == (4, 2)
    assert fk["badges", "user_id"] == (0, 0)  # user 0 exists
    assert fk["comments", "post_id"] == (1, 1)
    assert len(fk) == 13


def test_audits_of_empty_tables(spark):
    empty = {n: spark.createDataFrame([], e.schema) for n, e in ENTITIES.items()}
    assert {tuple(r)[3:] for r in fk_audit(empty).collect()} == {(0, 0)}
    assert {tuple(r)[1:] for r in pk_audit(empty).collect()} == {(0, 0, 0, 0)}
    assert {r["null_rows"] for r in not_null_audit(empty).collect()} == {0}


def test_one_big_set_is_met_on_the_value(spark, rows):
    """Rows without a value, or with one that most share, go to many tasks, and none is lost or doubled."""
    random.seed(6)
    values = [None, 404, 3, 4, *range(1000, 1200)]
    weights = [400, 300, 50, 50, *[1] * 200]
    data = [(None if i % 50 == 0 else i // 2, random.choices(values, weights)[0], 1, f"w{i}") for i in range(3000)]
    df, known = spark.createDataFrame(data, SCHEMA), spark.createDataFrame([(3,), (1000,)], "id long")
    expected = sorted([(i, x if x in (3, 1000) else None, y, w) for i, x, y, w in data], key=repr)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        got = null_dangling(df, {"x": known}, broadcast_values=0)
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        assert "collect_set" not in plan and "_salt" in plan
        assert rows(got) == expected
        assert rows(null_dangling(df, {"x": known}, broadcast_values=0, by_value=False)) == expected
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
