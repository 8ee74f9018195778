"""The clustered store: the same rows, and plans that leave them in place."""

import re

import pytest
from pyspark.sql import functions as F

from tagloom.fixtures import table, tables
from tagloom.operators.audit import fk_audit, pk_audit
from tagloom.operators.merge import insert_ignore, merge_upsert
from tagloom.operators.posts import accepted_answers, response_times
from tagloom.operators.references import orphan_rows, without_target
from tagloom.schemas import ENTITIES
from tagloom.session import work_folder
from tagloom.sinks.clustered import read_clustered, write_clustered
from tagloom.sinks.tables import read_tables, write_tables


@pytest.fixture(scope="module")
def stores(spark, sf_dir):
    plain, clustered = work_folder(spark), work_folder(spark)
    write_tables(spark, tables(spark, sf_dir), plain)
    write_clustered(spark, tables(spark, sf_dir), clustered, buckets=8)
    return read_tables(spark, plain), read_clustered(spark, clustered)


@pytest.fixture
def unknown_sizes(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    return re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan), plan


def same(a, b):
    columns = a.columns
    assert a.count() == b.count()
    assert a.select(*columns).exceptAll(b.select(*columns)).isEmpty()


def test_rows_and_types(stores):
    plain, clustered = stores
    for name, entity in ENTITIES.items():
        assert [(f.name, f.dataType) for f in clustered[name].schema] == [(f.name, f.dataType) for f in entity.schema]
        same(plain[name], clustered[name])


def test_joins_by_id_move_one_side(stores, unknown_sizes):
    plain, clustered = stores
    posts = clustered["posts"]
    for df, expected, column in (
        (response_times(posts), response_times(plain["posts"]), "question_id"),
        (accepted_answers(posts), accepted_answers(plain["posts"]), "answer_id"),
    ):
        found, plan = exchanges(df)
        assert len(found) == 1 and column in found[0]
        assert "Bucketed: true" in plan
        same(df, expected)


def test_grouping_and_merging_by_id(spark, sf_dir, stores, unknown_sizes):
    plain, clustered = stores
    for name in ("posts", "comments"):
        counted = clustered[name].groupBy("id").count().where("count > 1")
        assert exchanges(counted)[0] == []
    same(pk_audit(clustered), pk_audit(plain))
    same(fk_audit(clustered), fk_audit(plain))
    new = table(spark, sf_dir, "posts_meta")
    update = ENTITIES["posts"].update
    # With updates by a shuffled join, only the new rows' keys move.
    merged = merge_upsert(clustered["posts"], new, update=update, split_above=0)
    same(merge_upsert(plain["posts"], new, update=update, split_above=0), merged)
    stored = [x for x in exchanges(merged)[0] if x.startswith("id#")]
    moved = exchanges(merge_upsert(plain["posts"], new, update=update, split_above=0))[0]
    assert len(exchanges(merged)[0]) < len(moved) and len(stored) < len([x for x in moved if x.startswith("id#")])
    comments = table(spark, sf_dir, "comments_meta")
    same(insert_ignore(plain["comments"], comments), insert_ignore(clustered["comments"], comments))


def test_references_meet_their_targets_in_place(stores, unknown_sizes):
    plain, clustered = stores
    values = clustered["comments"].select(F.col("post_id").alias("value")).where("value is not null")
    found, plan = exchanges(without_target(values, clustered["posts"].select("id")))
    assert len(found) == 1 and "post_id" in found[0] + plan
    same(
        orphan_rows(plain["comments"], "post_id", plain["posts"].select("id")),
        orphan_rows(clustered["comments"], "post_id", clustered["posts"].select("id")),
    )


def test_a_store_is_read_by_another_session_and_rebuilt(spark, sf_dir):
    store = work_folder(spark)
    few = {"users": table(spark, sf_dir, "users").where("id < 50")}
    write_clustered(spark, few, store, buckets=4)
    first = read_clustered(spark, store)
    assert first["users"].count() == few["users"].count() and first["posts"].count() == 0
    other = spark.newSession()
    for name in [t.name for t in spark.catalog.listTables() if t.name.startswith("tagloom_users")]:
        spark.sql(f"drop table {name}")
    assert read_clustered(other, store)["users"].count() == few["users"].count()
    write_clustered(spark, {"users": table(spark, sf_dir, "users").where("id < 20")}, store, buckets=2)
    assert read_clustered(spark, store)["users"].count() == table(spark, sf_dir, "users").where("id < 20").count()


def test_buckets_grow_with_the_tables(spark, sf_dir, monkeypatch):
    from tagloom.sinks import clustered

    stored = {"posts": table(spark, sf_dir, "posts"), "users": table(spark, sf_dir, "users")}
    assert clustered.buckets_for(spark, stored, least=8) == 8
    size = clustered._bytes(stored["posts"])
    assert size > clustered.ROW_BYTES * stored["posts"].count() > clustered._bytes(stored["users"])
    monkeypatch.setattr(clustered, "BUCKET_BYTES", size // 20)
    assert clustered.buckets_for(spark, stored, least=8) in (20, 21)
    assert clustered.buckets_for(spark, {}, least=8) == 8
