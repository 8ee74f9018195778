"""What queries leave on disk while they run."""

import pathlib
import time

from pyspark.sql import functions as F

import __spark_entry__ as e
from tagloom import fixtures
from tagloom.fixtures import both_views, view, write_xml
from tagloom.plans.importing import add_to_blocks, stage_site
from tagloom.schemas import ENTITIES
from tagloom.session import one_work_folder, settled, shuffles_freed, work_folder
from tagloom.sinks.blocks import read_blocks, write_blocks
from tagloom.sinks.clustered import read_clustered, write_clustered
from tagloom.sources.site import ingest


def shuffle_files(spark):
    dirs = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {str(p) for d in dirs for p in pathlib.Path(d).rglob("shuffle_*")}


def left_by(spark, job):
    """The shuffle files that are there some time after the job and were not before."""
    before, until = shuffle_files(spark), time.time() + 20
    kept = job()  # what it returns still refers to its plan
    while (new := shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.2)
    del kept
    return new


def posts(spark, n):
    df = spark.range(1, n + 1).select("id", F.lit(1).alias("post_type_id"), F.concat(F.lit("A title & "), "id").alias("title"))
    return df.withColumn("tags", F.when(F.col("id") % 3 > 0, F.lit("<a><b>")))


def test_what_is_written_leaves_no_shuffles(spark):
    def job():
        with shuffles_freed(spark):
            df = spark.range(2000).repartition(3, "id")
            return df, settled(df)

    assert left_by(spark, job) == set()
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
    with shuffles_freed(spark):
        again = spark.range(2000).repartition(3, "id").groupBy((F.col("id") % 7).alias("k")).count()
    assert sorted(again.collect()) == sorted(again.collect())


def test_xml_is_compressed_and_cut_into_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(fixtures, "FILE_ROWS", 400)
    df = posts(spark, 2000).coalesce(1)
    path = write_xml(df, ENTITIES["posts"], str(tmp_path))
    files = list(pathlib.Path(path).glob("part-*"))
    text = sum(len(r[0]) + 1 for r in spark.read.text(path).collect())
    assert len(files) == 5 and sum(f.stat().st_size for f in files) < text / 3
    got = ingest(spark, path, ENTITIES["posts"]).select("id", "title", "tags").collect()
    assert sorted(got) == [(i, f"A title & {i}", "<a><b>" if i % 3 else "") for i in range(1, 2001)]


def test_a_second_site_is_the_same_out_of_the_first(spark, sf_dir):
    for name in ("users", "posts"):
        for found, suffix in zip(both_views(spark, sf_dir, name), ("", "_meta")):
            expected = view(spark, sf_dir, name + suffix)
            assert found.schema.simpleString() == expected.schema.simpleString()
            assert found.exceptAll(expected).isEmpty() and expected.exceptAll(found).isEmpty()
        assert not spark.catalog.tableExists(name)


def test_a_load_keeps_no_xml(spark, sf_dir):
    with one_work_folder(spark) as folder:
        assert not e.queries()["load_two_sites_posts"](spark, sf_dir).isEmpty()
    assert not list(pathlib.Path(folder).rglob("*.xml"))


def test_a_merged_site_keeps_its_rows_only(spark, tmp_path):
    write_xml(posts(spark, 50), ENTITIES["posts"], str(tmp_path))
    store = f"{tmp_path}/store"
    with one_work_folder(spark) as folder:
        write_blocks(spark, {}, store, 1000)
        staged = stage_site(spark, str(tmp_path))
        before = {p.name for p in pathlib.Path(folder).iterdir()}
        add_to_blocks(spark, staged, store)
        assert {p.name for p in pathlib.Path(folder).iterdir()} == before
    assert read_blocks(spark, store)["posts"].count() == 50


def test_a_load_in_place_keeps_its_store_only(spark, sf_dir):
    with one_work_folder(spark) as folder:
        assert not e.queries()["load_two_sites_posts_in_place"](spark, sf_dir).isEmpty()
    (kept,) = pathlib.Path(folder).iterdir()
    assert (kept / "layout").is_dir()


def test_a_clustered_store_leaves_no_shuffles(spark):
    store = work_folder(spark)
    stored = {"posts": fixtures.full(posts(spark, 300), ENTITIES["posts"])}
    assert left_by(spark, lambda: write_clustered(spark, stored, store, buckets=3)) == set()
    assert read_clustered(spark, store)["posts"].count() == 300
