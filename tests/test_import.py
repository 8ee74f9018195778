"""Loading two sites end to end."""

import datetime
import json
import pathlib

import pytest

from tagloom.plans.importing import import_into_blocks, import_sites
from tagloom.plans.job import run_all, run_queries
from tagloom.schemas import ENTITIES
from tagloom.sinks.blocks import read_blocks
from tagloom.sinks.results import read_json, write_json
from tagloom.sinks.tables import read_post_tags, read_tables, table_path

DATE = 'CreationDate="2011-01-03T20:00:00.000"'
MAIN = {
    "Users.xml": f"""<?xml version="1.0" encoding="utf-8"?>
<users>
  <row Id="-1" Reputation="1" DisplayName="bot" {DATE} />
  <row Id="7" Reputation="50" DisplayName="Ann" Location="here" Views="3" {DATE} />
  <row Id="8" Reputation="60" DisplayName="Bo" {DATE} />
  <row Id="8" Reputation="61" DisplayName="Bo twice" Location="ignored" {DATE} />
</users>""",
    "Posts.xml": f"""<posts>
  <row Id="1" PostTypeId="1" AcceptedAnswerId="2" {DATE} Score="5" ViewCount="10" Title="t" Tags="&lt;a&gt;&lt;b&gt;" OwnerUserId="7" AnswerCount="1" />
  <row Id="2" PostTypeId="2" ParentId="1" CreationDate="2011-01-03T20:30:00.000" Score="-2" OwnerUserId="8" />
  <row Id="3" PostTypeId="2" ParentId="1" CreationDate="2011-01-03T21:30:00.000" Score="1" OwnerUserId="70" LastEditorUserId="7" />
  <row Id="4" PostTypeId="1" AcceptedAnswerId="90" {DATE} Tags="&lt;b&gt;" OwnerUserId="404" />
  <row Id="5" PostTypeId="2" ParentId="404" {DATE} OwnerUserId="7" LastEditorUserId="405" />
  <row Id="6" PostTypeId="1" <broken />
</posts>""",
    "Comments.xml": f"""<comments>
  <row Id="1" PostId="1" Score="2" Text="first" {DATE} UserId="7" />
  <row Id="1" PostId="2" Score="3" Text="same id, later" {DATE} />
</comments>""",
}
META = {
    "meta_users.xml": f"""<users>
  <row Id="7" Reputation="99" DisplayName="Ann M" Location="there" Views="9" {DATE} />
  <row Id="70" Reputation="5" DisplayName="Cy" {DATE} />
</users>""",
    "meta_posts.xml": f"""<posts>
  <row Id="1" PostTypeId="1" {DATE} Score="500" Title="other" Tags="&lt;meta&gt;" OwnerUserId="70" AnswerCount="4" />
  <row Id="90" PostTypeId="2" ParentId="1" {DATE} Score="3" OwnerUserId="70" />
  <row Id="91" PostTypeId="2" ParentId="4" {DATE} Score="3" OwnerUserId="71" />
</posts>""",
    "meta_comments.xml": f"""<comments>
  <row Id="1" PostId="9" Score="9" Text="not this" {DATE} />
  <row Id="2" PostId="90" Score="1" Text="new" {DATE} UserId="70" />
</comments>""",
}


def write_site(folder, files):
    folder.mkdir()
    for name, text in files.items():
        (folder / name).write_text(text)
    return str(folder)


@pytest.fixture(scope="module")
def imported(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("dump")
    sites = [write_site(root / "main", MAIN), write_site(root / "meta", META)]
    store, results = str(root / "store"), str(root / "results")
    run_all(spark, sites, store, results)
    return sites, store, results


def test_users_keep_all_but_the_updated_columns(spark, imported):
    users = {r["id"]: r for r in read_tables(spark, imported[1])["users"].collect()}
    assert sorted(users) == [-1, 7, 8, 70]
    ann = users[7]
    assert (ann["reputation"], ann["display_name"]) == (99, "Ann M")
    assert (ann["location"], ann["views"]) == ("here", 3)
    # a repeated id inside one file acts like a later site
    assert (users[8]["reputation"], users[8]["display_name"], users[8]["location"]) == (61, "Bo twice", "")
    assert users[8]["last_access_date"] == datetime.datetime(1, 1, 1)


def test_posts_are_merged_and_repaired(spark, imported):
    posts = {r["id"]: r for r in read_tables(spark, imported[1])["posts"].collect()}
    assert sorted(posts) == [1, 2, 3, 4, 5, 90, 91]
    one = posts[1]
    assert (one["score"], one["view_count"], one["answer_count"]) == (500, None, 4)
    assert (one["title"], one["tags"], one["owner_user_id"], one["accepted_answer_id"]) == ("t", "<a><b>", 7, 2)
    # 70 and 90 came with the second site, after the main site was repaired
    assert posts[3]["owner_user_id"] is None and posts[3]["last_editor_user_id"] == 7
    assert posts[4]["accepted_answer_id"] is None and posts[4]["owner_user_id"] is None
    assert posts[5]["parent_id"] is None and posts[5]["last_editor_user_id"] is None
    assert posts[90]["owner_user_id"] == 70 and posts[90]["parent_id"] == 1
    assert posts[91]["owner_user_id"] is None and posts[91]["parent_id"] == 4


def test_the_first_row_of_a_comment_wins(spark, imported):
    comments = {r["id"]: r["text"] for r in read_tables(spark, imported[1])["comments"].collect()}
    assert comments == {1: "first", 2: "new"}


def test_entities_without_a_file_are_empty_tables(spark, imported):
    tables = read_tables(spark, imported[1])
    for name in ("badges", "post_history", "post_links", "tags", "votes"):
        assert tables[name].count() == 0
        assert tables[name].columns == ENTITIES[name].columns


def test_post_tags_and_quarantine(spark, imported):
    sites, store, _ = imported
    assert sorted(tuple(r) for r in read_post_tags(spark, store).collect()) == [(1, "a"), (1, "b"), (4, "b")]
    bad = spark.read.parquet(table_path(store, "quarantine")).collect()
    assert [(r["site_dir"], r["entity"]) for r in bad] == [(sites[0], "posts")]
    assert 'Id="6"' in bad[0]["_corrupt_record"]


def lines(folder):
    return [line for p in sorted(pathlib.Path(folder).glob("part-*")) for line in p.read_text().splitlines()]


def test_results_and_plans_are_saved(spark, imported):
    results = imported[2]
    # answers 2 and 90 to question 1, after 30 and 0 minutes, by authors with 61 and 5 points
    q1 = [json.loads(line) for line in lines(f"{results}/q1.json")]
    assert len(q1) == 1 and list(q1[0]) == sorted(q1[0])
    assert (q1[0]["tag1"], q1[0]["tag2"], q1[0]["pair_count"]) == ("a", "b", 2)
    assert (q1[0]["avg_response_time_minutes"], q1[0]["avg_answerer_reputation"]) == (15.0, 33.0)
    assert q1[0]["correlation_time_reputation"] == pytest.approx(1.0)
    q2 = [json.loads(line) for line in lines(f"{results}/q2.json")]
    assert [(r["answer_id"], r["question_id"], r["user_name"]) for r in q2] == [(2, 1, "Bo twice")]
    assert len(lines(f"{results}/fk_audit.json")) == 13
    assert "== Physical Plan ==" in "\n".join(lines(f"{results}/q1.explain.txt"))


def test_import_starts_from_nothing(spark, imported, tmp_path):
    site = write_site(tmp_path / "only", {"Users.xml": "<u><row Id='1' DisplayName='x'/></u>"})
    store = str(tmp_path / "store")
    import_sites(spark, imported[0], store)
    import_sites(spark, [site], store)
    tables = read_tables(spark, store)
    assert [r["id"] for r in tables["users"].collect()] == [1]
    assert tables["posts"].count() == 0
    assert read_post_tags(spark, store).count() == 0
    run_queries(spark, store, str(tmp_path / "results"))
    assert lines(tmp_path / "results" / "q1.json") == []


def test_failfast_import(spark, imported, tmp_path):
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        import_sites(spark, imported[0], str(tmp_path / "store"), mode="failfast")


def test_three_sites(spark, imported, tmp_path):
    third = write_site(
        tmp_path / "third", {"Users.xml": "<u><row Id='7' Reputation='1' DisplayName='z'/></u>"}
    )
    store = str(tmp_path / "store")
    import_sites(spark, [*imported[0], third], store)
    users = {r["id"]: r for r in read_tables(spark, store)["users"].collect()}
    assert (users[7]["reputation"], users[7]["display_name"], users[7]["location"]) == (1, "z", "here")
    assert read_tables(spark, store)["posts"].count() == 7


def test_json_keeps_nulls_and_types(spark, tmp_path, rows):
    df = spark.createDataFrame(
        [(1, None, datetime.datetime(2020, 1, 1, 0, 0, 0, 5000), 1.5, 'a"\n'), (2, "x", None, None, None)],
        "id long, t string, at timestamp_ntz, d double, s string",
    )
    path = write_json(df, str(tmp_path), "report")
    assert all(set(json.loads(line)) == set(df.columns) for line in lines(path))
    assert rows(read_json(spark, path, df.schema), *df.columns) == rows(df)


def test_json_of_no_rows(spark, tmp_path):
    path = write_json(spark.range(0), str(tmp_path), "none")
    assert lines(path) == []


def test_files_that_are_not_well_formed_are_named(spark, imported):
    found = spark.read.parquet(table_path(imported[1], "malformed")).collect()
    assert [(r["entity"], r["message"]) for r in found] == [("posts", "malformed tag")]
    assert found[0]["record"].startswith('row Id="6"')


def test_sites_added_to_a_store_of_blocks(spark, rows, tmp_path):
    store = str(tmp_path / "store")
    import_into_blocks(spark, [write_site(tmp_path / "main", MAIN)], store, width=10)
    import_into_blocks(spark, [write_site(tmp_path / "meta", META)], store)
    found = read_blocks(spark, store)
    assert rows(found["comments"], "id", "text") == [(1, "first"), (2, "new")]
    posts = {r["id"]: r for r in found["posts"].collect()}
    assert sorted(posts) == [1, 2, 3, 4, 5, 90, 91]
    assert (posts[1]["score"], posts[1]["view_count"], posts[1]["accepted_answer_id"]) == (500, None, 2)
    assert posts[3]["owner_user_id"] is None and posts[4]["accepted_answer_id"] is None
    assert (posts[90]["owner_user_id"], posts[90]["parent_id"], posts[91]["owner_user_id"]) == (70, 1, None)
