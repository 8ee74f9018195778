"""Sample sites out of general-purpose tables, for tests, checks and the benchmark.

The views are plain SQL that Spark and other engines read alike, so a check can
run the same text. ``posts`` and its fellows are the main site, the ``_meta``
views a second site that shares some ids and adds others. References without a
target and NULL keys are there on purpose.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.functions.lenient import NO_DATE
from tagloom.schemas import ENTITIES, Entity, Field
from tagloom.session import settled

SOURCES = ("customer", "supplier", "part", "orders", "lineitem", "events", "documents")

# A line's number inside its order is not unique, its rank is.
_LINE_RANK = """row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey,
               l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate)"""

VIEWS: dict[str, str] = {
    "users": """
        select c_custkey as id, cast(floor(c_acctbal) as int) as reputation,
               c_name as display_name
        from customer""",
    "posts": f"""
        select o_orderkey as id, 1 as post_type_id,
               case when o_orderstatus = 'F' then 1000000000 + o_orderkey * 1000 + 1 end as accepted_answer_id,
               cast(null as bigint) as parent_id, o_orderdate as creation_date,
               cast(floor(o_totalprice / 1000) as int) as score,
               o_custkey as owner_user_id,
               concat('Order ', cast(o_orderkey as string)) as title,
               concat('<', lower(replace(o_orderpriority, ' ', '-')), '><', lower(o_orderstatus),
                      '><', lower(c_mktsegment), '>') as tags
        from orders join customer on o_custkey = c_custkey
        union all
        select 1000000000 + l_orderkey * 1000
               + {_LINE_RANK},
               2, cast(null as bigint), l_orderkey, l_shipdate,
               cast(floor(l_quantity) as int) - 10, l_partkey, '', ''
        from lineitem""",
    "comments": """
        select event_id as id, event_id * 2 as post_id,
               case when event_id % 7 = 0 then null else user_id * 12 end as user_id,
               cast(floor(value) as int) as score, props as text, ts as creation_date
        from events where event_type in ('click', 'view')""",
    "badges": """
        select event_id as id, user_id * 12 as user_id, event_type as name, ts as date,
               cast(user_id % 3 + 1 as int) as class, event_id % 2 = 0 as tag_based
        from events where event_type = 'signup'""",
    "post_history": """
        select doc_id as id, doc_id as post_id, case when doc_id % 5 = 0 then null else o_custkey end as user_id,
               2 as post_history_type_id, md5(source) as revision_guid,
               o_orderdate as creation_date, text, '' as comment
        from documents join orders on doc_id = o_orderkey""",
    "post_links": f"""
        select l_orderkey * 1000 + {_LINE_RANK} as id,
               l_shipdate as creation_date, l_orderkey as post_id, l_partkey * 9 as related_post_id,
               case when l_linenumber = 1 then 3 else 1 end as link_type_id
        from lineitem""",
    "tags": """
        select p_partkey as id, p_name as tag_name, p_size as count,
               case when p_size > 25 then p_partkey end as excerpt_post_id,
               case when p_size > 40 then p_partkey * 10 end as wiki_post_id
        from part""",
    "votes": """
        select event_id as id, event_id * 2 as post_id,
               case when event_type = 'error' then 3 else 2 end as vote_type_id,
               case when event_id % 3 = 0 then null else user_id * 12 end as user_id,
               ts as creation_date,
               case when value > 50 then cast(floor(value) as int) end as bounty_amount
        from events where event_type in ('purchase', 'error')""",
    # The last branch holds ids that main answers name as owner but only this site has.
    "users_meta": """
        select c_custkey as id, cast(floor(c_acctbal) as int) + 1 as reputation,
               concat(c_name, '-meta') as display_name
        from customer where c_mktsegment = 'MACHINERY'
        union all
        select 1000000000 + s_suppkey, cast(floor(s_acctbal) as int), s_name from supplier
        union all
        select p_partkey, p_size, p_name from part
        where not exists (select 1 from customer where c_custkey = p_partkey)""",
    "posts_meta": """
        select id, post_type_id, accepted_answer_id, parent_id, creation_date,
               score + 1000 as score, case when score > 200 then 7 end as view_count, owner_user_id,
               concat(title, ' (meta)') as title, '<meta>' as tags, 3 as answer_count
        from posts where post_type_id = 1 and accepted_answer_id is null
        union all
        select 4000000000000 + id, post_type_id, accepted_answer_id, parent_id, creation_date,
               score, cast(null as int), owner_user_id, title, tags, 0
        from posts where post_type_id = 2 and score > 30""",
    "comments_meta": """
        select id, post_id, user_id, score + 1 as score, concat(text, ' meta') as text, creation_date
        from comments where user_id is null
        union all
        select 1000000000 + id, post_id, user_id, score, text, creation_date
        from comments where score > 20""",
    "badges_meta": """
        select id, user_id, concat(name, ' meta') as name, date, class, tag_based
        from badges where class = 1
        union all
        select 1000000000 + id, user_id, name, date, class, tag_based from badges where class = 2""",
    "post_history_meta": """
        select id, post_id, user_id, 5 as post_history_type_id, revision_guid, creation_date,
               concat(text, ' meta') as text, comment
        from post_history where user_id is null
        union all
        select 1000000000 + id, post_id, user_id, post_history_type_id, revision_guid,
               creation_date, text, comment
        from post_history where user_id is not null""",
    "post_links_meta": """
        select id, creation_date, related_post_id as post_id, post_id as related_post_id, link_type_id
        from post_links where link_type_id = 3
        union all
        select 1000000000000 + id, creation_date, post_id, related_post_id, link_type_id
        from post_links where link_type_id = 1""",
    "tags_meta": """
        select id, concat(tag_name, '-meta') as tag_name, count + 1 as count, excerpt_post_id, wiki_post_id
        from tags where excerpt_post_id is null
        union all
        select 1000000000 + id, tag_name, count, excerpt_post_id, wiki_post_id
        from tags where wiki_post_id is not null""",
    "votes_meta": """
        select id, post_id, vote_type_id + 10 as vote_type_id, user_id, creation_date, bounty_amount
        from votes where bounty_amount is null
        union all
        select 1000000000 + id, post_id, vote_type_id, user_id, creation_date, bounty_amount
        from votes where bounty_amount is not null""",
}


def view_sql(name: str) -> str:
    """The view's SELECT, preceded by what it builds on."""
    if name.endswith("_meta"):
        return f"with {ctes(name.removesuffix('_meta'))} {VIEWS[name]}"
    return VIEWS[name]


def ctes(*names: str, materialized: bool = False) -> str:
    """The named views as a list of common table expressions, in a usable order;
    ``materialized`` is for engines that would compute one anew for each use."""
    needed = [n for n in VIEWS if n in names or f"{n}_meta" in names]
    how = "as materialized" if materialized else "as"
    return ",\n".join(f"{n} {how} ({VIEWS[n]})" for n in needed)


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    sql = view_sql(name)
    for source in SOURCES:
        if re.search(rf"\b{source}\b", sql):
            spark.read.parquet(f"{sf_dir}/{source}.parquet").createOrReplaceTempView(source)
    return spark.sql(sql)


def both_views(spark: SparkSession, sf_dir: str, name: str) -> tuple[DataFrame, DataFrame]:
    """The main site's view, written to the work folder, and the second site's, which reads it there."""
    second = view(spark, sf_dir, f"{name}_meta")  # its sources are named now
    main = settled(view(spark, sf_dir, name))
    if re.search(rf"\b{name}\b", VIEWS[f"{name}_meta"]):
        main.createOrReplaceTempView(name)
        second = spark.sql(VIEWS[f"{name}_meta"])
        spark.catalog.dropTempView(name)
    return main, second


def _absent(field: Field) -> Column:
    if field.rule.endswith("?"):
        value = F.lit(None)
    elif field.rule == "text":
        value = F.lit("")
    elif field.rule == "time":
        value = F.lit(NO_DATE)
    elif field.rule == "flag":
        value = F.lit(False)
    else:
        value = F.lit(0)
    return value.cast(field.type)


def full(df: DataFrame, entity: Entity) -> DataFrame:
    """All columns of the entity; one that ``df`` lacks holds what loading gives
    for an absent attribute."""
    return df.select(
        *[
            (F.col(f.column).cast(f.type) if f.column in df.columns else _absent(f)).alias(f.column)
            for f in entity.fields
        ]
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return full(view(spark, sf_dir, name), ENTITIES[name.removesuffix("_meta")])


def tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: table(spark, sf_dir, name) for name in ENTITIES}


# Characters that an attribute value must not hold as such.
_ESCAPES = (
    ("&", "&amp;"),
    ("<", "&lt;"),
    (">", "&gt;"),
    ('"', "&quot;"),
    ("\t", "&#x9;"),
    ("\n", "&#xA;"),
    ("\r", "&#xD;"),
)


def _attribute(field: Field) -> Column:
    value = F.col(field.column)
    if field.rule.startswith("time"):
        # Out of the text form, as date_format would go through the session's zone.
        text = value.cast("string")
        millis = F.rpad(F.substring(text, 21, 3), 3, "0")
        value = F.concat(F.substring(text, 1, 10), F.lit("T"), F.substring(text, 12, 8), F.lit("."), millis)
    elif field.rule == "text":
        for character, escaped in _ESCAPES:
            value = F.replace(value, F.lit(character), F.lit(escaped))
    else:
        value = value.cast("string")
    return F.concat(F.lit(f'{field.attribute}="'), value, F.lit('"'))


# Of one part file: it is compressed and can't be cut, so this is what one task reads at most.
FILE_ROWS = 1_000_000


def write_xml(df: DataFrame, entity: Entity, site_dir: str) -> str:
    """``df`` as row elements in a folder of part files named like the dump's file.

    NULLs and columns that ``df`` lacks leave their attribute out. The text, most of which
    repeats from row to row, lies compressed.
    """
    path = f"{site_dir}/{entity.file}.xml"
    attributes = [_attribute(f) for f in entity.fields if f.column in df.columns]
    line = F.concat(F.lit("  <row "), F.concat_ws(" ", *attributes), F.lit(" />"))
    lines = df.select(line.alias("value"))
    how = {"maxRecordsPerFile": FILE_ROWS, "zlib.compress.level": "BEST_SPEED"}
    lines.write.options(**how).text(path, compression="gzip")
    return path
