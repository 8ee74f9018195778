
from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom import fixtures
from tagloom.fixtures import both_views, table, tables, view, write_xml
from tagloom.functions.stats import corr_or_null
from tagloom.functions.tagtext import extract_tags
from tagloom.operators import audit
from tagloom.operators.merge import insert_ignore, merge_upsert
from tagloom.operators.posts import (
    accepted_answers,
    post_tags,
    question_tag_pairs,
    response_times,
    with_author,
)
from tagloom.operators.references import null_dangling, orphan_rows
from tagloom.plans.importing import import_into_blocks, merge_sites, stage_sites
from tagloom.plans.low_scored_accepted import low_scored_accepted
from tagloom.plans.reputation_pairs import reputation_pairs
from tagloom.schemas import ENTITIES
from tagloom.session import one_work_folder, remove_folder, settled, shuffles_freed, side_by_side, work_folder
from tagloom.sinks.blocks import merge_blocks, read_blocks, write_blocks
from tagloom.sinks.clustered import buckets_for, read_clustered, write_clustered
from tagloom.sinks.results import read_json, write_json
from tagloom.sinks.tables import (
    read_post_tags,
    read_table,
    read_tables,
    refresh_post_tags,
    table_path,
    write_table,
    write_tables,
)
from tagloom.sources.site import ingest
from tagloom.sources.xml_rows import good_rows, read_xml_rows

try:
    import corpus_pipeline
    from tagloom.llm import queries as llm
except ModuleNotFoundError as missing:
    # Both are left out together; anything else that is missing is an error.
    if missing.name not in ("corpus_pipeline", "tagloom.llm"):
        raise
    corpus_pipeline = llm = None

Query = Callable[[SparkSession, str], DataFrame]

ctes = partial(fixtures.ctes, materialized=True)

PAIR_TAG = "f"  # for the query that is anchored at one tag
NULL_EVERY = 11  # ids of rows that are spoiled for the audits
QUESTION_TAG = "automobile"  # for the query on questions with one tag


def entry(spark: SparkSession) -> DataFrame:
    return queries()["q1"](spark, "/root/testdata/sf0.001")


# --- queries -----------------------------------------------------------------


def _rounded(df: DataFrame, **places: int) -> DataFrame:
    """Engines differ in the last digits of a double."""
    return df.withColumns({c: F.round(c, n) for c, n in places.items()})


def _pair_report(df: DataFrame) -> DataFrame:
    return _rounded(
        df,
        avg_response_time_minutes=3,
        avg_answerer_reputation=3,
        stddev_response_time=3,
        correlation_time_reputation=6,
    )


def _q1(spark: SparkSession, sf: str) -> DataFrame:
    return _pair_report(reputation_pairs(view(spark, sf, "posts"), view(spark, sf, "users")))


def _q1_anchored(spark: SparkSession, sf: str) -> DataFrame:
    posts, users = view(spark, sf, "posts"), view(spark, sf, "users")
    return _pair_report(reputation_pairs(posts, users, min_count=5, tag=PAIR_TAG))


def _q2(spark: SparkSession, sf: str) -> DataFrame:
    return low_scored_accepted(view(spark, sf, "posts"), view(spark, sf, "users"))


def _q2_tagged(spark: SparkSession, sf: str) -> DataFrame:
    posts, users = view(spark, sf, "posts"), view(spark, sf, "users")
    return low_scored_accepted(posts, users, max_score=-1, tag=QUESTION_TAG)


def _q2_tagged_stored(spark: SparkSession, sf: str) -> DataFrame:
    store = work_folder(spark)
    for name in ("posts", "users"):
        write_table(table(spark, sf, name), store, name)
    refresh_post_tags(spark, store)
    posts, users = read_table(spark, store, "posts"), read_table(spark, store, "users")
    tag_rows = read_post_tags(spark, store)
    return low_scored_accepted(posts, users, max_score=-1, tag=QUESTION_TAG, tag_rows=tag_rows)


def _extract_tags(spark: SparkSession, sf: str) -> DataFrame:
    documents = spark.read.parquet(f"{sf}/documents.parquet")
    tags = documents.select("doc_id", F.explode(extract_tags(F.col("text"))).alias("tag"))
    return tags.groupBy("doc_id", "tag").agg(F.count(F.lit(1)).alias("uses"))


def _post_tags(spark: SparkSession, sf: str) -> DataFrame:
    store = work_folder(spark)
    write_table(table(spark, sf, "posts"), store, "posts")
    refresh_post_tags(spark, store)
    return read_post_tags(spark, store)


def _tag_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return question_tag_pairs(view(spark, sf, "posts"))


def _response_time(spark: SparkSession, sf: str) -> DataFrame:
    return response_times(view(spark, sf, "posts"))


def _response_with_author(spark: SparkSession, sf: str) -> DataFrame:
    return with_author(_response_time(spark, sf), view(spark, sf, "users"))


def _corr_guarded(spark: SparkSession, sf: str) -> DataFrame:
    corr = corr_or_null(F.col("response_time_minutes"), F.col("answerer_reputation"))
    answers = _response_with_author(spark, sf).groupBy("question_id")
    report = answers.agg(F.count(F.lit(1)).alias("answers"), corr.alias("correlation"))
    return _rounded(report, correlation=6)


def _accepted_answers(spark: SparkSession, sf: str) -> DataFrame:
    return accepted_answers(view(spark, sf, "posts"))


def _xml_rows(spark: SparkSession, sf: str) -> DataFrame:
    comments = ENTITIES["comments"]
    path = write_xml(view(spark, sf, "comments"), comments, work_folder(spark))
    attributes = [f.attribute for f in comments.fields]
    return good_rows(read_xml_rows(spark, path, attributes)).select(*attributes)


def _xml_sections(spark: SparkSession, sf: str) -> DataFrame:
    """Comments, one in five of which stands with other tags in a comment or a CDATA section."""
    entity = ENTITIES["comments"]
    attributes = [f.attribute for f in entity.fields]
    source, path = f"{work_folder(spark)}/{entity.file}.xml", f"{work_folder(spark)}/{entity.file}.xml"
    lines = spark.read.text(write_xml(view(spark, sf, "comments"), entity, source.rsplit("/", 1)[0]))
    number = F.regexp_extract("value", ' Id="([0-9]+)"', 1).cast("long")
    hidden = F.concat(F.lit("<!-- <old> <row Id='0'/>"), "value", F.lit("</other> -->"))
    quoted = F.concat(F.lit("<![CDATA[<b>"), "value", F.lit("]]>"))
    lines = lines.select(F.when(number % 10 == 0, hidden).when(number % 10 == 5, quoted).otherwise(F.col("value")).alias("value"))
    lines.write.text(path)
    return good_rows(read_xml_rows(spark, path, attributes)).select(*attributes)


# Columns that hold the year 1 throughout, which not every client can show.
_DATELESS = {"users": ("creation_date", "last_access_date")}


def _ingest(name: str) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        entity = ENTITIES[name]
        path = write_xml(view(spark, sf, name), entity, work_folder(spark))
        rows = good_rows(ingest(spark, path, entity)).select(*entity.columns)
        return rows.withColumns({c: F.col(c).cast("string") for c in _DATELESS.get(name, ())})

    return run


def _site_dirs(spark: SparkSession, sf: str, *names: str) -> list[str]:
    site_dirs = [work_folder(spark), work_folder(spark)]
    with shuffles_freed(spark):
        with one_work_folder(spark) as folder:
            views = {name: both_views(spark, sf, name) for name in names}
        writes = [
            partial(write_xml, rows, ENTITIES[name], site_dir)
            for name, sites in views.items()
            for rows, site_dir in zip(sites, site_dirs)
        ]
        side_by_side(spark, writes)
    remove_folder(spark, folder)
    return site_dirs


def _two_sites(spark: SparkSession, sf: str, *names: str) -> dict[str, DataFrame]:
    site_dirs = _site_dirs(spark, sf, *names)
    sites = stage_sites(spark, site_dirs)
    for site_dir in site_dirs:  # written here, and read to the end
        remove_folder(spark, site_dir)
    return merge_sites(spark, sites)


def _load_two_sites_users(spark: SparkSession, sf: str) -> DataFrame:
    users = _two_sites(spark, sf, "users")["users"]
    return users.select("id", "reputation", "display_name", "views")


POST_COLUMNS = (
    "id", "post_type_id", "accepted_answer_id", "parent_id", "creation_date", "score",
    "view_count", "owner_user_id", "title", "tags", "answer_count",
)


def _load_two_sites_posts(spark: SparkSession, sf: str) -> DataFrame:
    return _two_sites(spark, sf, "users", "posts")["posts"].select(*POST_COLUMNS)


def _upsert_users(spark: SparkSession, sf: str, **how: int) -> DataFrame:
    base, new = view(spark, sf, "users"), view(spark, sf, "users_meta")
    return merge_upsert(base, new, update=ENTITIES["users"].update, **how)


def _upsert_posts(spark: SparkSession, sf: str, **how: int) -> DataFrame:
    base, new = table(spark, sf, "posts"), table(spark, sf, "posts_meta")
    return merge_upsert(
        base.select(*POST_COLUMNS), new.select(*POST_COLUMNS), update=ENTITIES["posts"].update, **how
    )


def _insert_ignore(name: str) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return insert_ignore(view(spark, sf, name), view(spark, sf, f"{name}_meta"))

    return run


def _null_dangling_accepted_answer(spark: SparkSession, sf: str, **how: int) -> DataFrame:
    posts = view(spark, sf, "posts")
    return null_dangling(posts, {"accepted_answer_id": posts.select("id")}, **how)


def _null_dangling_parent(spark: SparkSession, sf: str, **how: int) -> DataFrame:
    # All parents exist, so those without an accepted answer count as missing here.
    # The view is computed once, as its rows are read several times.
    posts = settled(view(spark, sf, "posts"))
    known = posts.where("accepted_answer_id is not null").select("id")
    return null_dangling(posts, {"parent_id": known}, **how)


def _null_dangling_owner(spark: SparkSession, sf: str, **how: int) -> DataFrame:
    posts, users = view(spark, sf, "posts"), view(spark, sf, "users")
    return null_dangling(posts, {"owner_user_id": users.select("id")}, **how)


def _null_dangling_last_editor(spark: SparkSession, sf: str, **how: int) -> DataFrame:
    posts, users = view(spark, sf, "posts"), view(spark, sf, "users")
    editor = F.coalesce("parent_id", "id").alias("last_editor_user_id")
    edited = settled(posts.select("id", "post_type_id", editor))
    return null_dangling(edited, {"last_editor_user_id": users.select("id")}, **how)


def _fk_audit(spark: SparkSession, sf: str) -> DataFrame:
    return audit.fk_audit(tables(spark, sf))


def _fk_orphans_comments_post(spark: SparkSession, sf: str) -> DataFrame:
    comments, posts = view(spark, sf, "comments"), view(spark, sf, "posts")
    return orphan_rows(comments, "post_id", posts.select("id"))


def _pk_audit(spark: SparkSession, sf: str) -> DataFrame:
    return audit.pk_audit(tables(spark, sf))


def _not_null_audit(spark: SparkSession, sf: str) -> DataFrame:
    return audit.not_null_audit(tables(spark, sf))


def _flawed_tables(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """Both sites' rows in one table, so that ids repeat, and NULLs in required columns."""
    found = {}
    for name, entity in ENTITIES.items():
        rows = table(spark, sf, name).unionByName(table(spark, sf, f"{name}_meta"))
        spoiled = F.col("id") % NULL_EVERY == 0
        found[name] = rows.withColumns({c: F.when(~spoiled, F.col(c)) for c in ("id", *entity.required)})
    return found


def _pk_audit_flawed(spark: SparkSession, sf: str) -> DataFrame:
    return audit.pk_audit(_flawed_tables(spark, sf))


def _not_null_audit_flawed(spark: SparkSession, sf: str) -> DataFrame:
    return audit.not_null_audit(_flawed_tables(spark, sf))


def _store_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    store = work_folder(spark)
    write_tables(spark, tables(spark, sf), store)
    report = None
    for name, df in read_tables(spark, store).items():
        line = df.agg(F.count(F.lit(1)).alias("row_count"), F.sum("id").alias("id_sum"))
        line = line.select(F.lit(name).alias("table_name"), "*")
        report = line if report is None else report.unionByName(line)
    return report


CLUSTERED_BUCKETS = 8  # of small tables; bigger ones get more


def _clustered(query: Callable[[dict[str, DataFrame]], DataFrame], *names: str) -> Query:
    """``query`` on the named tables, all if none, read from a clustered store."""

    def run(spark: SparkSession, sf: str) -> DataFrame:
        store = work_folder(spark)
        with shuffles_freed(spark):
            stored = {n: table(spark, sf, n) for n in names} or tables(spark, sf)
            write_clustered(spark, stored, store, buckets_for(spark, stored, CLUSTERED_BUCKETS))
        return query(read_clustered(spark, store))

    return run


def _upsert_posts_clustered(spark: SparkSession, sf: str) -> DataFrame:
    def merge(stored: dict[str, DataFrame]) -> DataFrame:
        new, update = table(spark, sf, "posts_meta").select(*POST_COLUMNS), ENTITIES["posts"].update
        return merge_upsert(stored["posts"].select(*POST_COLUMNS), new, update=update, split_above=0)

    return _clustered(merge, "posts")(spark, sf)


def _merge_in_place(name: str, width: int, *columns: str) -> Query:
    """The second site's rows of an entity merged into its stored table."""

    def run(spark: SparkSession, sf: str) -> DataFrame:
        store = work_folder(spark)
        write_blocks(spark, {name: table(spark, sf, name)}, store, width)
        merge_blocks(spark, store, name, table(spark, sf, f"{name}_meta"))
        return read_blocks(spark, store)[name].select(*columns or _VIEW_COLUMNS[name].split())

    return run


def _load_two_sites_in_place(spark: SparkSession, sf: str) -> DataFrame:
    store, names = work_folder(spark), ("users", "posts")
    site_dirs = _site_dirs(spark, sf, *names)
    import_into_blocks(spark, site_dirs, store, 1_000_000)
    for site_dir in site_dirs:
        remove_folder(spark, site_dir)
    return read_blocks(spark, store)["posts"].select(*POST_COLUMNS)


def _not_null_audit_stored(spark: SparkSession, sf: str) -> DataFrame:
    store = work_folder(spark)
    write_tables(spark, _flawed_tables(spark, sf), store)
    return audit.not_null_audit_stored(spark, {n: table_path(store, n) for n in ENTITIES})


def _json_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    posts = view(spark, sf, "posts")
    path = write_json(posts, work_folder(spark), "posts")
    return read_json(spark, path, posts.schema).select(*posts.columns)


def queries() -> dict[str, Query]:
    found: dict[str, Query] = {
        "q1": _q1,
        "q1_anchored": _q1_anchored,
        "q2": _q2,
        "q2_tagged": _q2_tagged,
        "q2_tagged_stored": _q2_tagged_stored,
        "extract_tags": _extract_tags,
        "post_tags": _post_tags,
        "tag_pairs": _tag_pairs,
        "response_time": _response_time,
        "response_with_author": _response_with_author,
        "corr_guarded": _corr_guarded,
        "accepted_answers": _accepted_answers,
        "xml_rows": _xml_rows,
        "xml_sections": _xml_sections,
        "load_two_sites_users": _load_two_sites_users,
        "load_two_sites_posts": _load_two_sites_posts,
        "upsert_users": _upsert_users,
        "upsert_posts": _upsert_posts,
        "null_dangling_accepted_answer": _null_dangling_accepted_answer,
        "null_dangling_parent": _null_dangling_parent,
        "null_dangling_owner": _null_dangling_owner,
        "null_dangling_last_editor": _null_dangling_last_editor,
        "fk_audit": _fk_audit,
        "fk_orphans_comments_post": _fk_orphans_comments_post,
        "pk_audit": _pk_audit,
        "not_null_audit": _not_null_audit,
        "pk_audit_flawed": _pk_audit_flawed,
        "not_null_audit_flawed": _not_null_audit_flawed,
        "store_roundtrip": _store_roundtrip,
        "json_roundtrip": _json_roundtrip,
        "response_time_clustered": _clustered(lambda t: response_times(t["posts"]), "posts"),
        "accepted_answers_clustered": _clustered(lambda t: accepted_answers(t["posts"]), "posts"),
        "pk_audit_clustered": _clustered(audit.pk_audit),
        "upsert_posts_clustered": _upsert_posts_clustered,
        "upsert_users_in_place": _merge_in_place("users", 500, "id", "reputation", "display_name"),
        "upsert_posts_in_place": _merge_in_place("posts", 1_000_000, *POST_COLUMNS),
        "insert_ignore_comments_in_place": _merge_in_place("comments", 10_000),
        "load_two_sites_posts_in_place": _load_two_sites_in_place,
        "not_null_audit_stored": _not_null_audit_stored,
    }
    found |= {f"ingest_{name}": _ingest(name) for name in ENTITIES}
    found |= {
        f"insert_ignore_{name}": _insert_ignore(name)
        for name, entity in ENTITIES.items()
        if not entity.update
    }
    # The ways that big tables take.
    for name in ("upsert_users", "upsert_posts"):
        found[f"{name}_split"] = partial(found[name], split_above=0)
    for name in [n for n in found if n.startswith("null_dangling_")]:
        found[f"{name}_by_key"] = partial(found[name], broadcast_values=0, by_value=False)
    if llm is not None:
        found |= llm.queries() | {"pipeline": corpus_pipeline.run}
    return found


# --- the same in SQL -----------------------------------------------------------

# The tags of a text: its longest runs of characters that are neither bracket nor space.
_TAG_LIST = r"regexp_extract_all({0}, '[^<>\s]+')"
_MINUTES = "(epoch_us(a.creation_date) - epoch_us(q.creation_date)) / 6e7"
_NO_DATE = "timestamp '0001-01-01 00:00:00'"


def _corr_sql(x: str, y: str) -> str:
    return f"round(case when isnan(corr({x}, {y})) then null else corr({x}, {y}) end, 6)"


def _q1_sql(min_count: int, tag: str | None = None) -> str:
    scope, anchor = "", ""
    if tag is not None:
        scope = f"join post_tags s on s.post_id = q.id and s.tag = '{tag}'"
        anchor = f"and t1.tag = '{tag}'"
    return f"""
    with {ctes("users", "posts")},
    post_tags as (select id as post_id, unnest({_TAG_LIST.format("tags")}) as tag from posts),
    timed as (
      select t1.tag as tag1, t2.tag as tag2, {_MINUTES} as minutes, u.reputation
      from posts q join posts a on a.parent_id = q.id
      {scope}
      join post_tags t1 on t1.post_id = q.id
      join post_tags t2 on t2.post_id = q.id
      join users u on u.id = a.owner_user_id
      where q.post_type_id = 1 and a.post_type_id = 2 and t1.tag < t2.tag {anchor})
    select tag1, tag2, count(*) as pair_count,
      round(avg(minutes), 3) as avg_response_time_minutes,
      round(avg(reputation), 3) as avg_answerer_reputation,
      round(stddev_samp(minutes), 3) as stddev_response_time,
      {_corr_sql("minutes", "reputation")} as correlation_time_reputation
    from timed group by tag1, tag2 having count(*) >= {min_count}
    order by pair_count desc, avg(minutes) asc nulls last, tag1, tag2 limit 20"""


def _q2_sql(max_score: int, tag: str | None = None) -> str:
    scope = ""
    if tag is not None:
        scope = f"""join (select id as post_id, unnest({_TAG_LIST.format("tags")}) as tag from posts) s
          on s.post_id = q.id and s.tag = '{tag}'"""
    return f"""
    with {ctes("users", "posts")}
    select a.id as answer_id, q.id as question_id, q.title as question_title,
      a.score as answer_score, a.creation_date as answer_date,
      u.id as user_id, u.display_name as user_name, u.reputation as user_reputation
    from posts q join posts a on q.accepted_answer_id = a.id join users u on a.owner_user_id = u.id
    {scope}
    where q.post_type_id = 1 and a.post_type_id = 2 and a.score <= {max_score}
    order by a.score asc nulls last, q.creation_date desc nulls first, a.id limit 20"""


# Questions and answers once each, as small tables: a self-join of the whole view reads it twice.
_SIDES = """questions as materialized (
      select id, accepted_answer_id, title, tags, creation_date from posts where post_type_id = 1),
    answers as materialized (
      select id, parent_id, creation_date, score, owner_user_id from posts where post_type_id = 2)"""

_RESPONSES = f"""select q.id as question_id, a.id as answer_id, a.owner_user_id as answerer_id,
      {_MINUTES} as response_time_minutes
    from answers a join questions q on a.parent_id = q.id where q.tags is not null"""

# What loading gives for the columns a view lacks.
_ABSENT_SQL = {
    "id": "cast(0 as bigint)",
    "id?": "cast(null as bigint)",
    "int": "0",
    "int?": "cast(null as int)",
    "text": "''",
    "time": _NO_DATE,
    "time?": "cast(null as timestamp)",
}

_VIEW_COLUMNS = {
    "users": "id reputation display_name",
    "posts": "id post_type_id accepted_answer_id parent_id creation_date score owner_user_id title tags",
    "comments": "id post_id user_id score text creation_date",
    "badges": "id user_id name date class tag_based",
    "post_history": "id post_id user_id post_history_type_id revision_guid creation_date text comment",
    "post_links": "id creation_date post_id related_post_id link_type_id",
    "tags": "id tag_name count excerpt_post_id wiki_post_id",
    "votes": "id post_id vote_type_id user_id creation_date bounty_amount",
}


def _ingest_sql(name: str) -> str:
    cells = []
    for f in ENTITIES[name].fields:
        value = f.column
        if f.column not in _VIEW_COLUMNS[name].split():
            value = _ABSENT_SQL[f.rule]
        elif f.rule.startswith("time"):
            value = f"date_trunc('millisecond', {f.column})"
        if f.column in _DATELESS.get(name, ()):
            value = f"cast({value} as varchar)"
        cells.append(f"{value} as {f.column}")
    return f"with {ctes(name)} select {', '.join(cells)} from {name}"


def _insert_ignore_sql(name: str) -> str:
    columns = ", ".join(_VIEW_COLUMNS[name].split())
    return f"""with {ctes(name, f"{name}_meta")}
    select {columns} from {name}
    union all
    select {columns} from {name}_meta m where not exists (select 1 from {name} b where b.id = m.id)"""


_UPSERTED_USERS = """
    select b.id, case when m.id is null then b.reputation else m.reputation end as reputation,
      case when m.id is null then b.display_name else m.display_name end as display_name
    from users b left join users_meta m on m.id = b.id
    union all
    select id, reputation, display_name from users_meta m
    where not exists (select 1 from users b where b.id = m.id)"""


def _upserted_posts(base: str) -> str:
    return f"""
    select b.id, b.post_type_id, b.accepted_answer_id, b.parent_id, b.creation_date,
      case when m.id is null then b.score else m.score end as score,
      case when m.id is null then null else m.view_count end as view_count,
      b.owner_user_id, b.title, b.tags,
      case when m.id is null then 0 else m.answer_count end as answer_count
    from {base} b left join posts_meta m on m.id = b.id
    union all
    select id, post_type_id, accepted_answer_id, parent_id, creation_date, score, view_count,
      owner_user_id, title, tags, answer_count
    from posts_meta m where not exists (select 1 from {base} b where b.id = m.id)"""


def _repaired_sql(posts: str, users: str, *more: str) -> str:
    kept = ", ".join(f"p.{c}" for c in more)
    return f"""
    select p.id, p.post_type_id, p.creation_date, p.score, p.title, p.tags{", " if kept else ""}{kept},
      case when a.id is not null then p.accepted_answer_id end as accepted_answer_id,
      case when q.id is not null then p.parent_id end as parent_id,
      case when u.id is not null then p.owner_user_id end as owner_user_id
    from {posts} p
    left join (select distinct id from {posts}) a on a.id = p.accepted_answer_id
    left join (select distinct id from {posts}) q on q.id = p.parent_id
    left join (select distinct id from {users}) u on u.id = p.owner_user_id
    order by p.id"""


_TWO_SITES_POSTS = f"""with {ctes("users", "posts", "users_meta", "posts_meta")},
    main_posts as materialized ({_repaired_sql("posts", "users")}),
    all_users as materialized (select id from users union all select id from users_meta),
    all_posts as materialized ({_upserted_posts("main_posts")})
    {_repaired_sql("all_posts", "all_users", "view_count", "answer_count")}"""


def _null_dangling_sql(column: str, parents: str, rows: str = "posts") -> str:
    columns = [c for c in _VIEW_COLUMNS["posts"].split() if c != column]
    return f"""with {ctes("posts", "users")},
    known as materialized (select distinct id as known_id from {parents})
    select {", ".join(columns)}, case when known_id is not null then {column} end as {column}
    from {rows} left join known on known_id = {column} order by id"""


def _fk_audit_sql() -> str:
    # last_editor_user_id is not in the view: no references, no orphans.
    parts = ["select 'posts' as child_table, 'last_editor_user_id' as child_column,"
             " 'users' as parent_table, 0 as orphan_rows, 0 as orphan_values"]
    for child, column, parent in audit.FOREIGN_KEYS:
        if column != "last_editor_user_id":
            parts.append(f"""select '{child}', '{column}', '{parent}', count(*), count(distinct {column})
              from {child} c where {column} is not null
              and not exists (select 1 from {parent} p where p.id = c.{column})""")
    return f"with {ctes(*ENTITIES)} {' union all '.join(parts)}"


def _pk_audit_sql() -> str:
    parts = [
        f"""select '{name}' as table_name, count(*) as row_count, count(distinct id) as distinct_ids,
          (select count(*) from (select id from {name} where id is not null
             group by id having count(*) > 1)) as repeated_ids,
          count(*) filter (where id is null) as null_ids from {name}"""
        for name in ENTITIES
    ]
    return f"with {ctes(*ENTITIES)} {' union all '.join(parts)}"


def _not_null_audit_sql() -> str:
    parts = []
    for name, entity in ENTITIES.items():
        for column in entity.required:
            nulls = "count(*) filter (where " + column + " is null)"
            if column not in _VIEW_COLUMNS[name].split():
                nulls = "cast(0 as bigint)"
            parts.append(
                f"select '{name}' as table_name, '{column}' as column_name,"
                f" (select {nulls} from {name}{'' if 'count' in nulls else ' limit 1'}) as null_rows"
            )
    return f"with {ctes(*ENTITIES)} {' union all '.join(parts)}"


def _both_sites(name: str, columns: str) -> str:
    return f"(select {columns} from {name} union all select {columns} from {name}_meta)"


def _pk_audit_flawed_sql() -> str:
    parts = [
        f"""select '{name}' as table_name, count(*) as row_count, count(distinct id) as distinct_ids,
          (select count(*) from (select id from {_both_sites(name, "id")} where id % {NULL_EVERY} <> 0
             group by id having count(*) > 1)) as repeated_ids,
          count(*) filter (where id is null) as null_ids
        from (select nullif(id, case when id % {NULL_EVERY} = 0 then id end) as id from {_both_sites(name, "id")})"""
        for name in ENTITIES
    ]
    return f"with {_site_ctes()} {' union all '.join(parts)}"


def _not_null_audit_flawed_sql() -> str:
    parts = [
        f"""select '{name}' as table_name, '{column}' as column_name,
          (select count(*) from {_both_sites(name, "id")} where id % {NULL_EVERY} = 0) as null_rows"""
        for name, entity in ENTITIES.items()
        for column in entity.required
    ]
    return f"with {_site_ctes()} {' union all '.join(parts)}"


def _site_ctes() -> str:
    meta = [f"{name}_meta as materialized ({fixtures.VIEWS[f'{name}_meta']})" for name in ENTITIES]
    return ", ".join([ctes(*ENTITIES), *meta])


def _store_sql() -> str:
    parts = [
        f"select '{n}' as table_name, count(*) as row_count, cast(sum(id) as bigint) as id_sum from {n}"
        for n in ENTITIES
    ]
    return f"with {ctes(*ENTITIES)} {' union all '.join(parts)}"


def oracle_sql() -> dict[str, str]:
    posts, both = ctes("posts"), ctes("users", "posts")
    found = {
        "q1": _q1_sql(2),
        "q1_anchored": _q1_sql(5, PAIR_TAG),
        "q2": _q2_sql(5),
        "q2_tagged": _q2_sql(-1, QUESTION_TAG),
        "extract_tags": f"""select doc_id, tag, count(*) as uses
            from (select doc_id, unnest({_TAG_LIST.format("text")}) as tag from documents)
            group by doc_id, tag""",
        "post_tags": f"""with {posts}
            select id as post_id, unnest({_TAG_LIST.format("tags")}) as tag from posts""",
        "tag_pairs": f"""with {posts},
            t as (select id, unnest({_TAG_LIST.format("tags")}) as tag from posts where post_type_id = 1)
            select t1.id as question_id, t1.tag as tag1, t2.tag as tag2
            from t t1 join t t2 on t1.id = t2.id where t1.tag < t2.tag""",
        "response_time": f"with {posts}, {_SIDES} {_RESPONSES} order by answer_id",
        "response_with_author": f"""with {both}, {_SIDES}, r as ({_RESPONSES})
            select r.*, u.reputation as answerer_reputation from r join users u on u.id = r.answerer_id
            order by answer_id""",
        "corr_guarded": f"""with {both}, {_SIDES}, r as ({_RESPONSES})
            select question_id, count(*) as answers,
              {_corr_sql("response_time_minutes", "reputation")} as correlation
            from r join users u on u.id = r.answerer_id group by question_id""",
        "accepted_answers": f"""with {posts}, {_SIDES}
            select q.accepted_answer_id as answer_id, q.id as question_id, q.title as question_title,
              q.creation_date as question_date, a.score as answer_score,
              a.creation_date as answer_date, a.owner_user_id as user_id
            from questions q join answers a on q.accepted_answer_id = a.id order by answer_id""",
        "xml_rows": f"""with {ctes("comments")}
            select cast(id as varchar) as Id, cast(post_id as varchar) as PostId,
              cast(user_id as varchar) as UserId, cast(score as varchar) as Score, text as Text,
              strftime(creation_date, '%Y-%m-%dT%H:%M:%S.%g') as CreationDate
            from comments""",
        "xml_sections": f"""with {ctes("comments")}
            select cast(id as varchar) as Id, cast(post_id as varchar) as PostId,
              cast(user_id as varchar) as UserId, cast(score as varchar) as Score, text as Text,
              strftime(creation_date, '%Y-%m-%dT%H:%M:%S.%g') as CreationDate
            from comments where id % 5 <> 0""",
        "load_two_sites_users": f"""with {ctes("users", "users_meta")}
            select *, 0 as views from ({_UPSERTED_USERS})""",
        "load_two_sites_posts": _TWO_SITES_POSTS,
        "upsert_users": f"with {ctes('users', 'users_meta')} {_UPSERTED_USERS}",
        "upsert_posts": f"with {ctes('posts', 'posts_meta')} {_upserted_posts('posts')}",
        "null_dangling_accepted_answer": _null_dangling_sql("accepted_answer_id", "posts"),
        "null_dangling_parent": _null_dangling_sql(
            "parent_id", "posts where accepted_answer_id is not null"
        ),
        "null_dangling_owner": _null_dangling_sql("owner_user_id", "users"),
        "null_dangling_last_editor": f"""with {both}
            select id, post_type_id, case when exists (select 1 from users x where x.id = editor)
              then editor end as last_editor_user_id
            from (select id, post_type_id, coalesce(parent_id, id) as editor from posts)""",
        "fk_audit": _fk_audit_sql(),
        "fk_orphans_comments_post": f"""with {ctes("comments", "posts")}
            select * from comments c where not exists (select 1 from posts p where p.id = c.post_id)""",
        "pk_audit": _pk_audit_sql(),
        "not_null_audit": _not_null_audit_sql(),
        "pk_audit_flawed": _pk_audit_flawed_sql(),
        "not_null_audit_flawed": _not_null_audit_flawed_sql(),
        "store_roundtrip": _store_sql(),
        "json_roundtrip": f"with {posts} select * from posts",
    }
    found |= {f"ingest_{name}": _ingest_sql(name) for name in ENTITIES}
    found |= {
        f"insert_ignore_{name}": _insert_ignore_sql(name)
        for name, entity in ENTITIES.items()
        if not entity.update
    }
    found |= {f"{n}_split": found[n] for n in ("upsert_users", "upsert_posts")}
    clustered = ("response_time", "accepted_answers", "pk_audit", "upsert_posts")
    found |= {f"{n}_clustered": found[n] for n in clustered}
    merged = ("upsert_users", "upsert_posts", "insert_ignore_comments", "load_two_sites_posts")
    found |= {f"{n}_in_place": found[n] for n in merged}
    found["q2_tagged_stored"] = found["q2_tagged"]
    found["not_null_audit_stored"] = found["not_null_audit_flawed"]
    found |= {f"{n}_by_key": sql for n, sql in found.items() if n.startswith("null_dangling_")}
    if llm is not None:
        found |= llm.oracle_sql()
        if corpus_pipeline.ORACLE_SQL is not None:
            found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found
