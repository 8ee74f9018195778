"""What spans several tags of an XML file, found side by side in all its blocks.

The text source cuts a file into records, one from each ``<`` to the next, and its blocks are
read by different tasks. Whether a record lies in a comment, and how deep, depends on all
records before it. Here each block first tells what it does to any state that it may be entered
in; these few values are put together in order; then each block knows its own. What opens and ends
sections is kept in pieces of ``PIECE`` records, put together by blocks and then by files, so that
the work grows with the records however many sections a block has. No task gets
more than one block's records, or one row of each block of a file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tagloom.session import settled

# Sections, by the text that opens and the text that ends them.
COMMENT, CDATA, INSTRUCTION, SUBSET = 1, 2, 3, 4
_SUBSET_END = r"\]\s*>"
# The parts of a tag, and the five entities that XML names.
PREFIX = r"(?:[^\s/>=:\"']+:)?"
ATTRIBUTE = r"\s+[^\s=/>\"']+\s*=\s*(?:\"[^\"]*+\"|'[^']*+')"
BAD_REFERENCE = r"&(?!(?:lt|gt|amp|quot|apos|#[0-9]{1,7}|#x[0-9A-Fa-f]{1,6});)"
# Possessive, as a matcher that can go back keeps a stack frame for each attribute.
_START = rf"^([^\s/>=!?&\"']+)(?:{ATTRIBUTE})*+\s*(/?)>"
_END = r"^/([^\s/>=&\"']+)\s*>"

RECORD = ["file", "block", "row"]  # where a record is: rows grow along a block
PIECE = 256  # records whose events and spans lie in one list


def records(spark: SparkSession, path: str) -> DataFrame:
    """``value``, the text after each ``<``, and its place. The rows are numbered before any
    filter, so that every plan built on this numbers them alike."""
    return spark.read.text(path, lineSep="<").select("value", "_metadata").select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )


def _opened(value: Column) -> Column:
    """The section that a record opens and does not end, or 0."""
    comment, cdata = value.startswith("!--"), value.startswith("![CDATA[")
    subset = value.startswith("!") & ~comment & ~cdata & value.contains("[")
    return (
        F.when(comment & ~F.substring(value, F.lit(4), F.length(value)).contains("-->"), COMMENT)
        .when(cdata & ~value.contains("]]>"), CDATA)
        .when(value.startswith("?") & ~value.contains("?>"), INSTRUCTION)
        .when(subset & ~value.rlike(_SUBSET_END), SUBSET)
        .otherwise(0)
    )


def _ended(value: Column) -> Column:
    """For each kind of section, whether a record within one would end it."""
    subset = F.when(value.contains("]"), value.rlike(_SUBSET_END)).otherwise(False)
    return F.array(value.contains("-->"), value.contains("]]>"), value.contains("?>"), subset)


def _after(state: Column, event: Column) -> Column:
    """The section that goes on after an event, if ``state`` did before it."""
    return F.when(state == 0, event["opened"]).when(F.element_at(event["ended"], state), 0).otherwise(state)


def _piece(row: Column) -> Column:
    return F.shiftright(row, PIECE.bit_length() - 1)


def block_events(found: DataFrame) -> DataFrame:
    """``file, block, piece, first, last, events``: of each piece of a block of ``records`` its records that
    open a section without ending it or would end one, and the first and last row there. What is
    no event has no piece."""
    value = F.col("value")
    event = F.struct("row", _opened(value).alias("opened"), _ended(value).alias("ended"))
    seen = (event["opened"] > 0) | F.exists(event["ended"], lambda e: e)
    # Most records are no event, so the lists are short; a block without any keeps its row.
    marked = found.select(*RECORD, F.when(_may_matter(value), F.when(seen, event)).alias("event"))
    piece = F.when(F.col("event").isNotNull(), _piece(F.col("row"))).alias("piece")
    events = F.sort_array(F.collect_list("event")).alias("events")
    return settled(marked.groupBy("file", "block", piece).agg(F.min("row").alias("first"), F.max("row").alias("last"), events))


def _walked(parts: str, state: Column) -> Column:
    """The state after ``parts``, an array with their exits, and the states they are entered in."""
    start = F.struct(state.alias("state"), F.expr("cast(array() as array<int>)").alias("entries"))
    return F.aggregate(
        parts,
        start,
        lambda w, b: F.struct(
            F.element_at(b["exits"], w["state"] + 1).alias("state"),
            F.concat(w["entries"], F.array(w["state"])).alias("entries"),
        ),
    )


def section_spans(events: DataFrame) -> tuple[DataFrame, DataFrame] | None:
    """What lies in a section that began in an earlier record.

    ``file, block, piece, spans``: rows above ``since`` up to ``until``, for the pieces that have any; and
    the files that end within a section. None if no section spans records.
    """
    if events.where(F.exists("events", lambda e: e["opened"] > 0)).isEmpty():
        return None
    every = F.sequence(F.lit(0), F.lit(SUBSET))
    exits = F.aggregate("events", every, lambda states, e: F.transform(states, lambda s: _after(s, e)))
    # A block's pieces, and what it does as a whole; one without events leaves the state as it is.
    pieces = F.sort_array(F.collect_list(F.when(F.size("events") > 0, F.struct("piece", exits.alias("exits")))))
    ends = [_piece(F.min("first")).alias("first"), _piece(F.max("last")).alias("last")]
    blocks = events.groupBy("file", "block").agg(pieces.alias("pieces"), *ends)
    whole = F.aggregate(
        "pieces", every, lambda states, p: F.transform(states, lambda s: F.element_at(p["exits"], s + 1))
    )
    blocks = settled(blocks.withColumn("exits", whole))
    along = F.sort_array(F.collect_list(F.struct("block", "exits"))).alias("blocks")
    files = blocks.select("file", "block", "exits").groupBy("file").agg(along)
    files = settled(files.select("file", "blocks.block", _walked("blocks", F.lit(0)).alias("walked")))
    entered = files.select("file", F.explode(F.arrays_zip("block", F.col("walked.entries").alias("entry"))).alias("b"))
    entered = blocks.join(entered.select("file", "b.block", "b.entry"), ["file", "block"])
    walked = settled(entered.select("file", "block", "first", "last", "pieces", _walked("pieces", F.col("entry")).alias("walked")))
    place = F.col("pieces.piece")
    known = F.arrays_zip(place.alias("piece"), F.col("walked.entries").alias("entry"))
    known = walked.select("file", "block", F.explode(known).alias("p")).select("file", "block", "p.piece", "p.entry")
    begin = F.struct(
        F.col("entry").alias("state"),
        F.lit(-1).cast("long").alias("since"),
        F.expr("cast(array() as array<struct<since: bigint, until: bigint>>)").alias("spans"),
    )

    def step(w: Column, e: Column) -> Column:
        state = _after(w["state"], e)
        span = F.struct(w["since"].alias("since"), e["row"].alias("until"))
        return F.struct(
            state.alias("state"),
            F.when((w["state"] == 0) & (state > 0), e["row"]).otherwise(w["since"]).alias("since"),
            F.when((w["state"] > 0) & (state == 0), F.concat(w["spans"], F.array(span))).otherwise(w["spans"]).alias("spans"),
        )

    last = F.lit((1 << 63) - 1)
    walk = F.aggregate(
        "events",
        begin,
        step,
        lambda w: F.when(
            w["state"] > 0, F.concat(w["spans"], F.array(F.struct(w["since"].alias("since"), last.alias("until"))))
        ).otherwise(w["spans"]),
    )
    busy = events.where(F.size("events") > 0).join(known, ["file", "block", "piece"])
    inside = busy.select("file", "block", "piece", walk.alias("spans")).where(F.size("spans") > 0)
    # Pieces without events lie in a section as a whole, or not at all.
    gap = F.arrays_zip(
        F.concat(F.array(F.col("first")), F.transform(place, lambda p: p + 1)).alias("since"),
        F.concat(F.transform(place, lambda p: p - 1), F.array(F.col("last"))).alias("until"),
        F.concat("walked.entries", F.array("walked.state")).alias("state"),
    )
    gaps = walked.select("file", "block", F.explode(gap).alias("g")).where("g.state > 0 and g.since <= g.until")
    everything = F.array(F.struct(F.lit(-1).cast("long").alias("since"), last.alias("until"))).alias("spans")
    gaps = gaps.select("file", "block", F.explode(F.sequence("g.since", "g.until")).alias("piece"), everything)
    return settled(inside.unionByName(gaps)), files.where("walked.state > 0").select("file")


def _may_matter(value: Column) -> Column:
    """A cheap test that nearly all records fail: one that opens or ends something."""
    return value.startswith("!") | value.startswith("?") | value.contains("-->") | value.contains("]") | value.contains("?>")


def outside_sections(found: DataFrame, spans: DataFrame | None) -> DataFrame:
    """The records that lie in no section. The spans have been written, so that the planner
    broadcasts few of them and shuffles many; a record looks among those of its piece."""
    if spans is None:
        return found
    inside = F.exists("spans", lambda s: (F.col("row") > s["since"]) & (F.col("row") <= s["until"]))
    joined = found.withColumn("piece", _piece(F.col("row"))).join(spans, ["file", "block", "piece"], "left")
    return joined.where(~F.coalesce(inside, F.lit(False))).drop("spans", "piece")


def xml_errors(spark: SparkSession, path: str) -> DataFrame:
    """``file, block, row, message, record``: the first place of each file at ``path`` where it is
    not well-formed, from its tags, its references, or its nesting. A folder's files stand
    each for itself."""
    found = records(spark, path)
    blocks = block_events(found)
    sections = section_spans(blocks)
    spans, cut_off = sections if sections else (None, None)
    value = F.col("value")
    tag = F.when(value.startswith("/"), F.regexp_extract(value, _END, 0)).otherwise(F.regexp_extract(value, _START, 0))
    text = F.substring(value, F.length("tag") + 1, F.length(value))
    special = value.startswith("!") | value.startswith("?")
    inner = F.substring_index(F.substring(value, F.lit(4), F.length(value)), "-->", 1)
    in_text = F.when(value.contains("&") & value.rlike(BAD_REFERENCE), "unknown reference").when(
        text.contains("]]>"), "]]> outside a section"
    )
    message = (
        F.when(value.startswith("!--") & inner.contains("--"), "-- in a comment")
        .when(special, None)
        .when(F.col("tag") == "", "malformed tag")
        .otherwise(in_text)
    )
    ending = value.startswith("/")
    empty = F.col("tag").endswith("/>")
    step = F.when(F.col("tag") == "", 0).when(ending, -1).when(empty, 0).otherwise(1)
    name = F.when(ending, F.regexp_extract("tag", _END, 1)).otherwise(F.regexp_extract("tag", _START, 1))
    marks = outside_sections(found, spans).withColumn("tag", F.when(special, "").otherwise(tag))
    marks = marks.select(
        *RECORD, message.alias("message"), in_text.alias("in_text"), step.alias("step"), name.alias("name"), F.substring(value, 1, 200).alias("record")
    )
    # Most tags end themselves; only the others and the errors go on.
    marks = marks.where("step != 0 or message is not null")
    # What stands before a file's first tag is a record too, but no tag.
    heads = blocks.where("block = 0").groupBy("file", "block").agg(F.min("first").alias("row"))
    heads = heads.withColumn("head", F.lit(True))
    marks = marks.join(heads, RECORD, "left").withColumns(
        {"message": F.when(F.col("head"), F.col("in_text")).otherwise(F.col("message")), "step": F.when(F.col("head"), 0).otherwise(F.col("step"))}
    )
    marks = settled(marks.drop("head", "in_text"))
    tags = marks.where("step != 0")
    in_block = Window.partitionBy("file", "block").orderBy("row")
    per_block = tags.groupBy("file", "block").agg(F.sum("step").alias("rise"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    per_block = per_block.withColumn("depth", F.coalesce(F.sum("rise").over(earlier), F.lit(0)))
    placed = tags.join(per_block.drop("rise"), ["file", "block"])
    reached = F.col("depth") + F.sum("step").over(in_block)
    placed = placed.withColumn("level", reached + F.when(F.col("step") < 0, 1).otherwise(0))
    # Tags of one level of a block take turns; the first and the last may have their partners elsewhere.
    level = Window.partitionBy("file", "block", "level").orderBy("row")
    placed = placed.withColumns(
        {"partner": F.lag("name").over(level), "begins": F.lag("step").over(level).isNull(), "ends": F.lead("step").over(level).isNull()}
    )
    placed = settled(placed)
    wrong = "closes what was not opened here"
    crossed = F.when(F.col("level") < 1, wrong).when(~F.col("begins") & (F.col("name") != F.col("partner")), wrong)
    here = placed.where("step < 0").withColumn("message", crossed)
    across = Window.partitionBy("file", "level").orderBy("block", "row")
    open_ends = placed.where("(step < 0 and begins) or (step > 0 and ends)")
    open_ends = open_ends.withColumns({"partner": F.lag("name").over(across), "before": F.lag("step").over(across)})
    there = open_ends.where("step < 0 and level >= 1").withColumn(
        "message", F.when((F.col("before") == 1) & F.col("name").eqNullSafe(F.col("partner")), None).otherwise(wrong)
    )
    columns = [*RECORD, "message", "record"]
    unclosed = per_block.groupBy("file").agg(F.sum("rise").alias("rise")).where("rise > 0")
    at_end = unclosed.select("file")
    if cut_off is not None:
        at_end = at_end.unionByName(cut_off)
    far = F.lit((1 << 63) - 1)
    at_end = at_end.select("file", far.alias("block"), far.alias("row"), F.lit("ends too early").alias("message"), F.lit("").alias("record"))
    every = marks.select(*columns).unionByName(here.select(*columns)).unionByName(there.select(*columns))
    every = every.where("message is not null").unionByName(at_end)
    first = F.min_by(F.struct("message", "record"), F.struct("block", "row"))
    place = F.min(F.struct("block", "row"))
    return every.groupBy("file").agg(place.alias("place"), first.alias("what")).select("file", "place.*", "what.*")
