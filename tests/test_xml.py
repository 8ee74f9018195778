"""Reading row elements, whatever the layout of the file."""

import datetime
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tagloom.fixtures import write_xml
from tagloom.schemas import ENTITIES
from tagloom.sources.site import entity_file, ingest, load_site, xml_files
from tagloom.sources.xml_blocks import xml_errors
from tagloom.sources.xml_rows import POSITION, corrupt_rows, good_rows, read_xml_rows

EDGE_POSTS = """<?xml version="1.0" encoding="utf-8"?>
<posts>
  <row Id="1" PostTypeId="1" AcceptedAnswerId="2" CreationDate="2011-01-03T20:52:52.880" Score="16" ViewCount="337" Body="&lt;p&gt;a &gt; b&#xA;x&lt;/p&gt;" Title=" T > 1 " Tags="&lt;mysql&gt;&lt;innodb&gt;" OwnerUserId="7" AnswerCount="1" />
  <row Id="2" PostTypeId="2" ParentId="1" CreationDate="2011-01-03T21:52:52.880" Score="" Body="b" OwnerUserId="7" />
  <row Id="3" PostTypeId="2" ParentId="1" CreationDate="bad" Score="x" Body="c" OwnerUserId="999" />
  <row Id="4" PostTypeId="1" AcceptedAnswerId="404" CreationDate="2011-01-04T00:00:00.000" Tags="&lt;a&gt;&lt;a&gt;&lt;b&gt;" LastEditDate="2011-01-05" />
  <row Id="5" PostTypeId="2" ParentId="404" CreationDate="2011-01-04T00:00:00.000" OwnerUserId="" />
  <row Id="6" PostTypeId="1" CreationDate="2011-01-04T00:00:00.000" <broken />
</posts>
"""


@pytest.fixture
def xml(tmp_path):
    def write(text, name="Posts.xml"):
        path = tmp_path / name
        path.write_text(text, encoding="utf-8")
        return str(path)

    return write


def attribute_rows(df, *attributes):
    return [tuple(r) for r in good_rows(df).orderBy(POSITION).select(*attributes).collect()]


def test_edge_rows(spark, xml):
    df = ingest(spark, xml(EDGE_POSTS), ENTITIES["posts"])
    posts = {r["id"]: r for r in good_rows(df).collect()}
    assert sorted(posts) == [1, 2, 3, 4, 5]
    one = posts[1]
    assert one["body"] == "<p>a > b\nx</p>"
    assert one["title"] == " T > 1 "
    assert one["tags"] == "<mysql><innodb>"
    assert one["creation_date"] == datetime.datetime(2011, 1, 3, 20, 52, 52, 880000)
    assert (one["score"], one["view_count"], one["answer_count"]) == (16, 337, 1)
    assert (one["accepted_answer_id"], one["parent_id"], one["last_edit_date"]) == (2, None, None)
    assert (posts[2]["score"], posts[2]["view_count"], posts[2]["title"]) == (0, None, "")
    assert (posts[3]["score"], posts[3]["creation_date"]) == (0, datetime.datetime(1, 1, 1))
    assert posts[4]["last_edit_date"] is None
    assert posts[5]["owner_user_id"] is None
    bad = [r[0] for r in corrupt_rows(df).collect()]
    assert len(bad) == 1 and 'Id="6"' in bad[0]


def test_failfast_stops_at_a_malformed_row(spark, xml):
    df = ingest(spark, xml(EDGE_POSTS), ENTITIES["posts"], mode="failfast")
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        df.collect()


@pytest.mark.parametrize(
    "text",
    [
        '<a><row Id="1" T="x"/><row Id="2"/></a>',
        '<row Id="1" T="x"/>\n<row Id="2"/>',
        '\n  <?xml version="1.0"?>\n<a>\n<row\n  Id="1"\n  T="x"\n/>\n<row Id="2"></row></a>',
        "<rows><deep><row Id='1' T='x'><child T='no'/></row></deep>\r\n<row\tId='2'/>\r\n</rows>",
        '<a><rowset/><row Id="1" T="x"/><other Id="9"/><row Id="2"/></a>',
        '﻿<a><row Other="9" T="x" Id="1"/><row Id="2"/></a>\n\n',
    ],
)
def test_layouts(spark, xml, text):
    df = read_xml_rows(spark, xml(text), ["Id", "T"])
    assert attribute_rows(df, "Id", "T") == [("1", "x"), ("2", None)]
    assert corrupt_rows(df).count() == 0


@pytest.mark.parametrize("text", ["", "<a>\n</a>\n", "  \n", '<?xml version="1.0"?>\n<a/>'])
def test_files_without_rows(spark, xml, text):
    df = read_xml_rows(spark, xml(text), ["Id"])
    assert df.count() == 0


def test_a_big_file_is_split_without_losing_rows_or_their_order(spark, xml):
    random.seed(7)
    lines = [f'  <row Id="{i}" T="{"é<row>".replace("<", "&lt;") * random.randrange(40)}" />' for i in range(4000)]
    path = xml("<a>\n" + "\n".join(lines) + "\n</a>\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9973")
    try:
        df = read_xml_rows(spark, path, ["Id"])
        assert df.rdd.getNumPartitions() > 20
        got = attribute_rows(df, "Id")
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == [(str(i),) for i in range(4000)]
    assert corrupt_rows(df).count() == 0


def test_text_survives_the_round_trip(spark, tmp_path):
    texts = ["a\nb\r\nc\td", '<b x="1">&amp;</b>', "  spaces  ", "'\"", "", "日本 😀 é", "]]>", "<row Id='1'/>"]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    write_xml(df, ENTITIES["comments"], str(tmp_path / "site"))
    got = load_site(spark, str(tmp_path / "site"))["comments"]
    assert {r["id"]: r["text"] for r in good_rows(got).collect()} == dict(enumerate(texts))


# Every character that XML can hold.
CHARACTERS = st.characters(blacklist_categories=("Cs", "Cc"), blacklist_characters="\ufffe\uffff")
TEXTS = st.lists(st.text(CHARACTERS | st.sampled_from("\t\n\r<>&\"'/ ")), min_size=50, max_size=80)


@settings(max_examples=12, deadline=None, database=None, derandomize=True, suppress_health_check=list(HealthCheck))
@given(texts=TEXTS)
def test_any_text_survives_the_round_trip(spark, tmp_path_factory, texts):
    site_dir = str(tmp_path_factory.mktemp("any") / "site")
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    write_xml(df, ENTITIES["comments"], site_dir)
    got = load_site(spark, site_dir)["comments"]
    assert {r["id"]: r["text"] for r in good_rows(got).collect()} == dict(enumerate(texts))


def test_file_lookup(spark, tmp_path, caplog):
    for name in ("z_POSTS.xml", "PostHistory.xml", "my-PostLinks.xml", "b_users.xml", "a_Users.xml", "Tags.txt"):
        (tmp_path / name).write_text('<a><row Id="1"/></a>')
    files = xml_files(spark, str(tmp_path))
    assert list(files) == sorted(files) and "Tags.txt" not in files
    found = {n: entity_file(files, e) for n, e in ENTITIES.items()}
    assert found["users"].endswith("a_Users.xml")
    assert found["posts"].endswith("z_POSTS.xml")
    assert found["post_history"].endswith("PostHistory.xml")
    assert found["post_links"].endswith("my-PostLinks.xml")
    assert found["tags"] is None
    tables = load_site(spark, str(tmp_path))
    assert set(tables) == {"users", "posts", "post_history", "post_links"}
    assert "no file for tags" in caplog.text
    for name, df in tables.items():
        got = [(f.name, f.dataType) for f in good_rows(df).drop(POSITION).schema]
        assert got == [(f.column, f.type) for f in ENTITIES[name].fields]


def test_only_the_needed_attributes_are_parsed(spark, xml):
    df = good_rows(ingest(spark, xml(EDGE_POSTS), ENTITIES["posts"])).select("id")
    assert sorted(r[0] for r in df.collect()) == [1, 2, 3, 4, 5]
    assert df.where(F.col("id") == 4).count() == 1


@pytest.mark.parametrize("size", [1_000_000, 5_000_000])
def test_attributes_of_any_length(spark, xml, size):
    df = read_xml_rows(spark, xml(f'<a>\n<row Id="1" T="{"x&amp;" * (size // 6)}"/>\n<row Id="2" T="y"/></a>'), ["Id", "T"])
    rows = good_rows(df).orderBy(POSITION).select("Id", F.length("T"), F.substring("T", 1, 4)).collect()
    assert [tuple(r) for r in rows] == [("1", 2 * (size // 6), "x&x&"), ("2", 1, "y")]
    assert corrupt_rows(df).count() == 0


@pytest.mark.parametrize(
    "text, expected",
    [
        ('<a><!-- <row Id="6"/> --><row Id="1"/></a>', [("1", None)]),
        ('<a><![CDATA[<row Id="6"/>]]><row Id="1"/></a>', [("1", None)]),
        ('<x:a><x:row Id="1" y:T="b"/></x:a>', [("1", "b")]),
        ('<a><row Id="1" T="p"><row Id="2"/><b/></row></a>', [("1", "p"), ("2", None)]),
        ('<a><row Id="1" T="p" T="q"/></a>', [("1", "q")]),
        ('<a><row Id="1" T="&#38;lt; &#x1F600;&#233; &amp;amp;&#xA;&apos;&quot;"/></a>', [("1", "&lt; 😀é &amp;\n'\"")]),
        ("<a><row Id='1' T='a>b\r\nc\td \"'/></a>", [("1", 'a>b c d "')]),
        ('<a><rows Id="9"/><row-x Id="9"/><arow Id="9"/><row Id="1"/></a>', [("1", None)]),
    ],
)
def test_rows_that_other_readers_find(spark, xml, text, expected):
    df = read_xml_rows(spark, xml(text), ["Id", "T"])
    assert attribute_rows(df, "Id", "T") == expected
    assert corrupt_rows(df).count() == 0


@pytest.mark.parametrize("row", ['<row Id="6" T=x/>', '<row Id="6" T="a & b"/>', '<row Id="6" T="&nope;"/>', '<row Id="6" T="'])
def test_malformed_rows_are_set_aside(spark, xml, row):
    df = read_xml_rows(spark, xml(f'<a><row Id="1"/>{row}<row Id="2"/></a>'), ["Id"])
    assert attribute_rows(df, "Id") == [("1",), ("2",)]
    assert [r[0].startswith('<row Id="6"') for r in corrupt_rows(df).collect()] == [True]


def test_a_final_line_break_spoils_numbers_and_times(spark, xml):
    text = '<a><row Id="5&#xA;" CreationDate="2011-01-03T20:52:52.880&#xA;" ParentId="7&#xA;"/></a>'
    row = good_rows(ingest(spark, xml(text), ENTITIES["posts"])).first()
    assert (row["id"], row["parent_id"], row["creation_date"]) == (0, 0, datetime.datetime(1, 1, 1))


def test_a_row_with_very_many_attributes(spark, xml):
    many = " ".join(f'a{i}="{i}"' for i in range(100_000))
    df = read_xml_rows(spark, xml(f'<a><row Id="1" {many} T="x"/><row Id="2" {many} T=x/></a>'), ["Id", "T", "a77777"])
    assert attribute_rows(df, "Id", "T", "a77777") == [("1", "x", "77777")]
    assert corrupt_rows(df).count() == 1


@pytest.fixture
def small_blocks(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "997")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


def numbered(low, high):
    return "\n".join(f'<row Id="{i}" T="t"/>' for i in range(low, high))


@pytest.mark.parametrize(
    "opening, closing",
    [("<!--", "-->"), ("<![CDATA[", "]]>"), ("<?note ", "?>"), ("<!DOCTYPE a [ <!ENTITY x 'y'> ", " ] >")],
)
def test_rows_in_sections_over_many_blocks_are_dropped(spark, xml, small_blocks, opening, closing):
    text = f"<a>{numbered(0, 100)}{opening}{numbered(100, 1100)}{closing}{numbered(1100, 1200)}{opening}{numbered(1200, 1203)}{closing}<row Id='x'/></a>"
    df = read_xml_rows(spark, xml(text), ["Id"])
    assert df.rdd.getNumPartitions() > 20
    assert attribute_rows(df, "Id") == [*((str(i),) for i in (*range(100), *range(1100, 1200))), ("x",)]
    assert corrupt_rows(df).count() == 0


def test_section_ends_in_values_mean_nothing(spark, xml, small_blocks):
    rows = "".join(f'<row Id="{i}" T="--> ]]> ?> ]>"/>' for i in range(200))
    df = read_xml_rows(spark, xml(f"<a>{rows}<!-- <b> <row Id='no'/>--> {rows}<!----></a>"), ["Id", "T"])
    assert attribute_rows(df, "Id", "T") == [(str(i), "--> ]]> ?> ]>") for i in range(200)] * 2


def test_sections_of_one_file_leave_the_others_alone(spark, tmp_path):
    folder = tmp_path / "Posts.xml"
    folder.mkdir()
    (folder / "part-0").write_text("<a><row Id='1'/><!-- <row Id='2'/>")
    (folder / "part-1").write_text("<a><row Id='3'/></a>")
    assert sorted(attribute_rows(read_xml_rows(spark, str(folder), ["Id"]), "Id")) == [("1",), ("3",)]


def first_error(text):
    """The nesting that a reader of one file after the other would accept, record by record."""
    import re

    at, open_tags = 0, []
    while (at := text.find("<", at)) >= 0:
        rest = text[at:]
        for opening, closing in (("<!--", "-->"), ("<![CDATA[", "]]>"), ("<?", "?>")):
            if rest.startswith(opening):
                end = rest.find(closing, len(opening))
                if end < 0:
                    return "end"
                if opening == "<!--" and "--" in rest[4:end]:
                    return "comment"
                at += end + len(closing)
                break
        else:
            tag = re.match(r"""<(/?)([a-z]+)((?:\s+[a-zA-Z]+=(?:"[^"<]*"|'[^'<]*'))*)\s*(/?)>""", rest)
            if not tag or (tag[1] and (tag[3] or tag[4])):
                return "tag"
            if tag[1]:
                if not open_tags or open_tags.pop() != tag[2]:
                    return "nesting"
            elif not tag[4]:
                open_tags.append(tag[2])
            at += tag.end()
    return "end" if open_tags else None


PARTS = ["<a>", "</a>", "<b>", "</b>", '<row Id="1"/>', "<row Id='2' T=\"y\"></row>", "text", "<!-- <b> -->", "<![CDATA[</a>]]>",
         "<!-- x", "-->", "<? p ?>", "<row", "<row Id=1/>", "\n"]
WEIGHTS = [6, 6, 6, 6, 8, 6, 4, 2, 2, 0.2, 0.2, 1, 0.1, 0.1, 4]


def test_errors_of_random_files(spark, tmp_path):
    rng, expected = random.Random(11), {}
    folder = tmp_path / "Posts.xml"
    folder.mkdir()
    for i in range(120):
        if i % 2:  # well nested, then perhaps one part too many
            text, open_tags = "", []
            for _ in range(rng.randint(0, 40)):
                part = rng.choices(PARTS[:9], k=1)[0]
                if part in ("</a>", "</b>"):
                    text += f"</{open_tags.pop()}>" if open_tags else ""
                    continue
                if part in ("<a>", "<b>"):
                    open_tags.append(part[1])
                text += part
            text += "".join(f"</{t}>" for t in reversed(open_tags)) + (rng.choice(PARTS) if rng.random() < 0.3 else "")
        else:
            text = "".join(rng.choices(PARTS, WEIGHTS, k=rng.randint(0, 12)))
        (folder / f"part-{i}").write_text(text)
        expected[i] = first_error(text) is not None
    spark.conf.set("spark.sql.files.maxPartitionBytes", "67")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        found = {int(r["file"].rsplit("-", 1)[1]) for r in xml_errors(spark, str(folder)).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert found == {i for i, bad in expected.items() if bad}


@pytest.mark.parametrize(
    "text",
    [
        f"<a>{numbered(0, 300)}",
        f"<a>{numbered(0, 300)}</b>",
        f"<a><b>{numbered(0, 300)}</a></b>",
        f"<a>{numbered(0, 300)}</a></a>",
        f"<a>{numbered(0, 150)}<broken x>{numbered(150, 300)}</a>",
        f"<a>{numbered(0, 150)}&nope;{numbered(150, 300)}</a>",
        f"<a>{numbered(0, 150)}]]>{numbered(150, 300)}</a>",
        f"<a>{numbered(0, 150)}<!-- -- -->{numbered(150, 300)}</a>",
        f"<a>{numbered(0, 300)}</a><!-- ",
    ],
)
def test_failfast_stops_at_errors_outside_rows(spark, xml, small_blocks, text):
    path = xml(text)
    assert xml_errors(spark, path).count() == 1
    with pytest.raises(Exception, match="malformed"):
        read_xml_rows(spark, path, ["Id"], mode="failfast").count()
    assert good_rows(read_xml_rows(spark, path, ["Id"])).count() == 300


def test_failfast_accepts_what_is_well_formed(spark, xml, small_blocks):
    deep = "<b>" * 200 + numbered(0, 100) + "</b>" * 200
    text = f'<?xml version="1.0"?>\n<!DOCTYPE a [ <!ELEMENT a (b)> ]>\n<a>\n{deep}<row Id="7"><c>&amp;</c></row><!-- <d> --></a>\n'
    path = xml(text)
    assert xml_errors(spark, path).collect() == []
    assert read_xml_rows(spark, path, ["Id"], mode="failfast").count() == 101


def test_a_block_with_very_many_sections(spark, xml):
    """The rows of one block among as many sections take a time that grows with them, not with their product."""
    from time import monotonic

    def took(n):
        hidden = "".join(f'<row Id="{i}"/><!-- <b> <row Id="x"/> </b> -->' for i in range(n))
        path = xml(f"<a>{hidden}<!-- {numbered(0, 1000)} --><row Id='end'/></a>")
        began = monotonic()
        assert attribute_rows(read_xml_rows(spark, path, ["Id"]), "Id") == [*((str(i),) for i in range(n)), ("end",)]
        return monotonic() - began

    took(100)
    assert took(30_000) < 30


def test_spans_are_kept_by_pieces(spark, xml):
    from tagloom.sources.xml_blocks import PIECE, block_events, records, section_spans

    hidden = "".join(f'<row Id="{i}"/><!-- <b> -->' for i in range(2 * PIECE))
    path = xml(f"<a>{hidden}<!-- {numbered(0, 3 * PIECE)} --></a>")
    spans, cut_off = section_spans(block_events(records(spark, path)))
    sizes = [len(r["spans"]) for r in spans.collect()]
    assert len(sizes) >= 8 and max(sizes) <= PIECE and cut_off.isEmpty()


def test_rows_are_taken_apart_once_whatever_is_read(spark, tmp_path):
    path = tmp_path / "x.xml"
    path.write_text('<rows><row Id="1" A="x"/><row Id="2" A="&no;"/><row Id=3/><row  Id=\'4\'\tA="y z"/></rows>')
    good = good_rows(read_xml_rows(spark, str(path), ["Id", "A"])).select("Id", "A")
    assert sorted(map(tuple, good.collect())) == [("1", "x"), ("4", "y z")]
    plan = good._jdf.queryExecution().optimizedPlan().toString()
    # The pattern of a usual tag is not matched again in a filter below.
    assert plan.count("^row((?: [^") == 1


def test_values_that_look_like_names(spark, xml):
    text = """<a><row Id="1" T=" Id="/><row T=" Id=" Id="2"/><row T=' Id=' x:Id="3"/><row A="=" T="a=" Id="4"/><row Id=" T=" T="="/>
    <row Id="" T=""/><row T=" &#38;#32;"/><row a:b:Id='"' T=' "x" Id="'/></a>"""
    df = read_xml_rows(spark, xml(text), ["Id", "T", "A"])
    expected = [("1", " Id=", None), ("2", " Id=", None), ("3", " Id=", None), ("4", "a=", "="), (" T=", "=", None)]
    assert attribute_rows(df, "Id", "T", "A") == [*expected, ("", "", None), (None, " &#32;", None), ('"', ' "x" Id="', None)]
    assert corrupt_rows(df).count() == 0


def test_usual_rows_are_taken_apart_in_generated_code(spark, xml):
    df = read_xml_rows(spark, xml(EDGE_POSTS), [f.attribute for f in ENTITIES["posts"].fields])
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    # Lambdas, which are interpreted, are left to unusual tags and to references by number in the 19 attributes.
    assert plan.count("lambdafunction(") == 20
    assert "filter(" not in plan


def test_files_of_sites_are_looked_through_side_by_side(spark, tmp_path, monkeypatch):
    from threading import Barrier

    from tagloom.plans.importing import stage_sites
    from tagloom.sources import site

    together, plain = Barrier(4, timeout=60), site.ingest

    def ingest_with_others(*args):
        together.wait()
        return plain(*args)

    monkeypatch.setattr(site, "ingest", ingest_with_others)
    dirs = [tmp_path / "main", tmp_path / "meta"]
    for i, folder in enumerate(dirs):
        folder.mkdir()
        for name in ("Users", "Posts"):
            (folder / f"{name}.xml").write_text(f'<a><row Id="{i}"/></a>')
    staged = stage_sites(spark, [str(d) for d in dirs])
    assert [{n: df.first()["id"] for n, df in tables.items()} for tables in staged] == [{"users": i, "posts": i} for i in (0, 1)]
