"""Row elements of an XML file as a DataFrame.

Built-in XML reading keeps a multi-line file in one task, and limits the length of
an attribute. Here the text source splits the file at every tag, so one big file is
read by many tasks and a row may lie on part of a line, one line or several. One pattern
finds where a tag ends; one split at its quotes then gives names and values in turn, and a column is
a lookup among the names, whatever the number of attributes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.sources.xml_blocks import (
    ATTRIBUTE,
    BAD_REFERENCE,
    PREFIX,
    RECORD,
    block_events,
    outside_sections,
    records,
    section_spans,
    xml_errors,
)

POSITION = "_position"  # where the row was in the file; orders rows as the file does
CORRUPT = "_corrupt_record"  # the text of a malformed row, else NULL

MODES = ("quarantine", "failfast")

# A row's tag, the same as dumps usually write it, where no value begins with a space, one
# attribute, and references to characters that are no part of another reference.
_ROW = r"^row(?=[\s/>]|\z)"
_PREFIXED_ROW = rf"^{PREFIX}row(?=[\s/>]|\z)"
_WHOLE = rf"^{PREFIX}row((?:{ATTRIBUTE})*+\s*/?>)"
_USUAL = r"^row((?: [^\s=/>\"':]+=\"(?! )[^\"\t\r\n]*+\")*+ ?/?>)"
_EACH = r"\s+([^\s=/>\"']+)\s*=\s*(\"[^\"]*+\"|'[^']*+')"
_MARK = "&;"  # no reference, so no value of a well-formed tag holds it
_NAMED = {"lt": "<", "gt": ">", "quot": '"', "apos": "'"}
_NUMBERED = {"#xA": "\n", "#xD": "\r", "#x9": "\t"}


def _code_point(number: Column) -> Column:
    """The character of a code point in hexadecimal."""
    return F.decode(F.unhex(F.lpad(number, 8, "0")), "UTF-32")


def _numbered(value: Column) -> Column:
    """A value with references by number resolved, one by one."""

    def resolved(piece: Column, i: Column) -> Column:
        name = F.substring_index(piece, ";", 1)
        rest = F.substring(piece, F.length(name) + 2, F.length(piece))
        number = F.when(name.startswith("#x"), F.substring(name, F.lit(3), F.length(name))).otherwise(
            F.hex(F.substring(name, F.lit(2), F.length(name)).try_cast("bigint"))
        )
        character = _code_point(number)
        for known, text in {**_NAMED, "amp": "&"}.items():
            character = F.when(name == known, F.lit(text)).otherwise(character)
        return F.when(i == 0, piece).otherwise(F.concat(character, rest))

    return F.array_join(F.transform(F.split(value, "&"), resolved), "")


def _plain(value: Column) -> Column:
    """What the references in a value name. The usual ones need no list; ``&amp;`` comes last, so
    that what it leaves is not taken for another reference."""
    unmarked = F.replace(value, F.lit(_MARK), F.lit(""))
    usual = unmarked
    for name, text in {**_NUMBERED, **_NAMED}.items():
        usual = F.replace(usual, F.lit(f"&{name};"), F.lit(text))
    usual = F.when(usual.contains("&#"), _numbered(unmarked)).otherwise(F.replace(usual, F.lit("&amp;"), F.lit("&")))
    return F.when(value.contains("&"), usual).otherwise(value)


def _unusual_parts(tag: Column) -> Column:
    """The parts of a tag with single quotes, prefixes or other spaces, as if it were a usual one.
    Its values are marked, so that none is taken for a name."""
    each = F.arrays_zip(
        F.regexp_extract_all(tag, F.lit(_EACH), F.lit(1)).alias("name"), F.regexp_extract_all(tag, F.lit(_EACH), F.lit(2)).alias("value")
    )
    pairs = F.transform(
        each,
        lambda e: F.array(
            F.concat(F.lit(" "), F.substring_index(e["name"], ":", -1), F.lit("=")),
            F.concat(F.lit(_MARK), F.substring(e["value"], F.lit(2), F.length(e["value"]) - 2)),
        ),
    )
    return F.concat(F.flatten(pairs), F.array(F.lit("/>")))


def _spaced(tag: Column) -> Column:
    """White space of a tag, within values or not, reads as spaces; a line end as one."""
    return F.translate(F.replace(tag, F.lit("\r\n"), F.lit(" ")), "\t\n\r", "   ")


def _refused(spark: SparkSession, attributes: Sequence[str], message: str) -> DataFrame:
    """Rows of a file that is not well-formed: any job on them stops with the message."""
    empty = F.lit(None).cast("string")
    place = F.struct(F.lit("").alias("file"), *[F.lit(0).cast("long").alias(c) for c in ("block", "row", "again")])
    stop = F.raise_error(F.concat(F.lit(message), F.col("id").cast("string"))).cast("string").isNull()
    return spark.range(1).where(stop).select(*[empty.alias(a) for a in attributes], empty.alias(CORRUPT), place.alias(POSITION))


def read_xml_rows(
    spark: SparkSession, path: str, attributes: Sequence[str], mode: str = "quarantine"
) -> DataFrame:
    """One string column per attribute (NULL if absent), plus position and corrupt text.

    ``path`` is a file or a folder of part files. Every start tag whose local name is
    ``row`` is a row, at any depth; attributes go by their local names, and of a repeated
    one the last counts. Other elements are ignored, as is what stands in a comment, a CDATA
    section, an instruction or a document type, over however many tags they go: one pass over the
    text looks for those first. A malformed row keeps its text in the corrupt column. With
    ``mode="failfast"`` it stops the job, as does whatever else is not well-formed in a file.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    if mode == "failfast":
        error = xml_errors(spark, path).orderBy("file").first()
        if error is not None:
            return _refused(spark, attributes, f"malformed: {error['message']} in {error['file']}: <{error['record']}")
    found = records(spark, path)
    value = F.col("value")
    sections = section_spans(block_events(found))
    is_row = F.when(value.startswith("row "), True).when(value.startswith("row"), value.rlike(_ROW)).otherwise(value.contains(":row") & value.rlike(_PREFIXED_ROW))
    rows = outside_sections(found.where(is_row), sections[0] if sections else None)
    usual = F.regexp_extract(value, _USUAL, 1)
    # The second number says nothing new; as it can't be computed twice, it keeps filters above
    # this projection, where they would take rows apart once more.
    place = F.struct(*RECORD, F.monotonically_increasing_id().alias("again"))
    tags = rows.select("value", usual.alias("usual"), place.alias(POSITION))
    other = _spaced(F.regexp_extract(value, _WHOLE, 1))
    tags = tags.select("value", F.when(F.col("usual") != "", F.col("usual")).otherwise(other).alias("tag"), (F.col("usual") != "").alias("usual"), POSITION)
    tag = F.col("tag")
    bad = (tag == "") | (tag.contains("&") & tag.rlike(BAD_REFERENCE))
    bad = bad & (F.col(POSITION)["again"] >= 0)
    shaped = tags.select(F.when(bad, F.concat(F.lit("<"), value)).alias(CORRUPT), F.when(~bad, tag).alias("tag"), "usual", POSITION)
    if mode == "failfast":
        stop = F.raise_error(F.concat(F.lit("malformed row: "), F.substring(CORRUPT, 1, 200)))
        shaped = shaped.withColumn(CORRUPT, F.when(F.col(CORRUPT).isNotNull(), stop))
    # Alternately a value and its name, as it stands in a usual tag, from the last to the first, so that
    # the last of a name is found. No value looks like a name, which begins with a space.
    parts = F.reverse(F.when(F.col("usual"), F.split("tag", '"')).otherwise(_unusual_parts(tag)))
    shaped = shaped.select(parts.alias("parts"), CORRUPT, POSITION)

    def last(attribute: str) -> Column:
        place = F.array_position("parts", f" {attribute}=")
        return F.get("parts", (place - 2).cast("int")).alias(attribute)

    # Values are picked before they are resolved, so that each is picked once.
    picked = shaped.select(*[last(a) for a in attributes], CORRUPT, POSITION)
    return picked.select(*[_plain(F.col(a)).alias(a) for a in attributes], CORRUPT, POSITION)


def good_rows(rows: DataFrame) -> DataFrame:
    """The well-formed rows, still with their position."""
    return rows.where(F.col(CORRUPT).isNull()).drop(CORRUPT)


def corrupt_rows(rows: DataFrame) -> DataFrame:
    """The texts of the malformed rows."""
    return rows.where(F.col(CORRUPT).isNotNull()).select(CORRUPT)
