"""The files of one site's dump as typed DataFrames."""

from __future__ import annotations

import logging
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from tagloom.functions.lenient import typed
from tagloom.schemas import ENTITIES, Entity
from tagloom.session import side_by_side
from tagloom.sources.xml_rows import CORRUPT, POSITION, read_xml_rows

log = logging.getLogger(__name__)


def xml_files(spark: SparkSession, site_dir: str) -> dict[str, str]:
    """Name -> path of the ``*.xml`` files (or folders of part files), by name."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(site_dir, "*.xml")
    fs = pattern.getFileSystem(spark._jsc.hadoopConfiguration())
    paths = [status.getPath() for status in fs.globStatus(pattern) or []]
    return dict(sorted((p.getName(), p.toString()) for p in paths))


def entity_file(files: dict[str, str], entity: Entity) -> str | None:
    """The first file whose name contains the entity's, in any letter case."""
    wanted = entity.file.lower()
    return next((path for name, path in files.items() if wanted in name.lower()), None)


def entity_files(spark: SparkSession, site_dir: str) -> dict[str, str]:
    """Entity -> path of its file. An entity without one is left out."""
    files = xml_files(spark, site_dir)
    paths = {name: entity_file(files, entity) for name, entity in ENTITIES.items()}
    return {name: path for name, path in paths.items() if path is not None}


def ingest(
    spark: SparkSession,
    path: str,
    entity: Entity,
    mode: str = "quarantine",
    bad_time: str = "sentinel",
) -> DataFrame:
    """Typed columns of the entity, plus position and corrupt text."""
    rows = read_xml_rows(spark, path, [f.attribute for f in entity.fields], mode)
    columns = [typed(f, rows[f.attribute], bad_time) for f in entity.fields]
    return rows.select(*columns, CORRUPT, POSITION)


def load_site(
    spark: SparkSession, site_dir: str, mode: str = "quarantine", bad_time: str = "sentinel"
) -> dict[str, DataFrame]:
    """Entity -> rows of one site. An entity without a file is left out. The files are looked
    through for sections side by side."""
    files = entity_files(spark, site_dir)
    for name in ENTITIES:
        if name not in files:
            log.warning("%s: no file for %s, skipped", site_dir, name)
    reads = [partial(ingest, spark, path, ENTITIES[name], mode, bad_time) for name, path in files.items()]
    return dict(zip(files, side_by_side(spark, reads)))
