"""The store in blocks of ids: merges in place, and audits from footers."""

import pathlib

import pytest
from pyspark.sql import functions as F

from tagloom.fixtures import table, tables
from tagloom.operators.audit import not_null_audit, not_null_audit_stored
from tagloom.operators.merge import merge_upsert
from tagloom.schemas import ENTITIES
from tagloom.sinks.blocks import BLOCK, merge_blocks, read_blocks, write_blocks
from tagloom.sinks.tables import table_path, write_tables


def files(store, name):
    return {str(p) for p in pathlib.Path(table_path(store, name)).rglob("*.parquet")}


def comments(spark, ids, text="old"):
    rows = [(i, 1, None, 0, f"{text} {i}", None) for i in ids]
    return spark.createDataFrame(rows, ENTITIES["comments"].schema)


def users(spark, ids, reputation):
    schema = ENTITIES["users"].schema
    df = spark.createDataFrame([(i, reputation) for i in ids], "id long, reputation int")
    return df.select(*[
        F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schema
    ])


@pytest.fixture
def store(tmp_path):
    return str(tmp_path / "store")


def test_rows_and_types(spark, sf_dir, store):
    stored = tables(spark, sf_dir)
    write_blocks(spark, stored, store, width=1_000_000)
    for name, df in read_blocks(spark, store).items():
        entity = ENTITIES[name]
        assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in entity.schema]
        expected = stored[name].select(*[F.col(f.name).cast(f.dataType) for f in entity.schema])
        assert df.count() == expected.count() and df.exceptAll(expected).isEmpty()


def test_files_outside_the_range_keep_their_names(spark, rows, store):
    write_blocks(spark, {"users": users(spark, [*range(-30, 100), None], 1)}, store, width=10)
    before = files(store, "users")
    new = users(spark, [-25, 31, 32, 250], 7)
    assert sorted(merge_blocks(spark, store, "users", new)) == [-3, 3, 25]
    after, reached = files(store, "users"), ("id_block=-3/", "id_block=3/", "id_block=25/")
    changed = {f for f in before ^ after}
    assert all(any(r in f for r in reached) for f in changed)
    assert len(before & after) == len(before) - 2 and len(after) == len(before) + 1
    found = rows(read_blocks(spark, store)["users"], "id", "reputation")
    expected = {i: 1 for i in [*range(-30, 100), None]} | dict.fromkeys([-25, 31, 32, 250], 7)
    assert found == sorted(expected.items(), key=repr)


@pytest.mark.parametrize("name, width", [("users", 29), ("posts", 700_000), ("comments", 2_000)])
def test_same_as_a_merge_of_whole_tables(spark, sf_dir, store, name, width):
    base, new = table(spark, sf_dir, name).where("id % 5 < 2"), table(spark, sf_dir, f"{name}_meta")
    new = new.unionByName(new.where("id % 3 = 0"))  # repeated rows
    write_blocks(spark, {name: base}, store, width)
    merge_blocks(spark, store, name, new)
    columns = ENTITIES[name].columns
    expected = merge_upsert(base.select(*columns), new.select(*columns), update=ENTITIES[name].update)
    expected = expected.select(*[F.col(f.name).cast(f.dataType) for f in ENTITIES[name].schema])
    found = read_blocks(spark, store)[name]
    assert found.count() == expected.count() and found.exceptAll(expected).isEmpty()
    again = files(store, name)
    merge_blocks(spark, store, name, new)
    assert read_blocks(spark, store)[name].exceptAll(expected).isEmpty()
    if not ENTITIES[name].update:
        assert files(store, name) == again


def test_known_ids_of_an_insert_only_table_rewrite_nothing(spark, rows, store):
    write_blocks(spark, {"comments": comments(spark, range(50))}, store, width=10)
    before = files(store, "comments")
    assert merge_blocks(spark, store, "comments", comments(spark, range(20), "new")) == []
    assert files(store, "comments") == before
    assert merge_blocks(spark, store, "comments", comments(spark, [3, 12, 60], "new")) == [6]
    assert before < files(store, "comments")
    found = dict(rows(read_blocks(spark, store)["comments"], "id", "text"))
    assert (found[3], found[12], found[60]) == ("old 3", "old 12", "new 60")


def test_rows_without_an_id_and_empty_sides(spark, rows, store):
    write_blocks(spark, {}, store, width=10)
    assert read_blocks(spark, store)["users"].count() == 0
    assert merge_blocks(spark, store, "users", users(spark, [], 1)) == []
    assert merge_blocks(spark, store, "users", users(spark, [None, 4], 1)) in ([None, 0], [0, None])
    assert None in merge_blocks(spark, store, "users", users(spark, [None], 2))
    assert rows(read_blocks(spark, store)["users"], "id", "reputation") == [(4, 1), (None, 1), (None, 2)]


def test_a_merge_opens_only_the_blocks_it_reaches(spark, store):
    from tagloom.sinks.blocks import _among, _stored

    write_blocks(spark, {"comments": comments(spark, range(100))}, store, width=10)
    near = _stored(spark, store, "comments").where(_among([2, 5]))
    assert len({r[BLOCK] for r in near.collect()}) == 2
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert f"PartitionFilters: [{BLOCK}" in plan


def test_null_audit_reads_footers_only(spark, sf_dir, rows, store):
    stored = tables(spark, sf_dir)
    stored["comments"] = stored["comments"].withColumn("text", F.when(F.col("id") % 3 > 0, F.col("text")))
    stored["votes"] = stored["votes"].limit(0)
    write_tables(spark, stored, store)
    report = not_null_audit_stored(spark, {n: table_path(store, n) for n in ENTITIES})
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    scans = report._jdf.queryExecution().executedPlan().toString()
    assert rows(report) == rows(not_null_audit(stored))
    assert scans.count("PushedAggregation: [COUNT(*)") == len(ENTITIES), plan
    # The session that asked keeps its settings.
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"


def test_sparse_ids_share_blocks_and_full_ones_are_cut(spark, rows, store):
    ids = [i * 1000 for i in range(200)]
    write_blocks(spark, {"users": users(spark, ids, 1)}, store, width=10)
    assert 10 <= len(files(store, "users")) <= 25
    before = files(store, "users")
    # Most of these lie in one block, some below and above all, one in the last but one.
    new = [*range(50_000, 50_100), -7, 900_000, 900_005, 188_000]
    changed = merge_blocks(spark, store, "users", users(spark, new, 7))
    found = rows(read_blocks(spark, store)["users"], "id", "reputation")
    assert found == sorted((dict.fromkeys(ids, 1) | dict.fromkeys(new, 7)).items(), key=repr)
    assert len(before & files(store, "users")) >= len(before) - 3
    sizes = {r[BLOCK]: r["count"] for r in spark.read.parquet(table_path(store, "users")).groupBy(BLOCK).count().collect()}
    assert max(sizes.values()) <= 30 and {-1, 90_000} <= {*changed} <= {*sizes}
    # A block's rows lie between its number and the next one's.
    low = spark.read.parquet(table_path(store, "users")).groupBy(BLOCK).agg(F.min("id"), F.max("id")).orderBy(BLOCK).collect()
    assert all(a[0] * 10 <= a[1] and a[2] < b[0] * 10 for a, b in zip(low, low[1:]))
    assert merge_blocks(spark, store, "users", users(spark, [188_000], 8)) == [max(b for b in sizes if b <= 18_800)]
    assert dict(rows(read_blocks(spark, store)["users"], "id", "reputation"))[188_000] == 8
