"""Loading the dumps of several sites into one table store.

The sites share one id space and are loaded one after another: a later site
updates a few columns of the users and posts it meets again and adds the rest.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.operators.merge import collapse_repeats, key_profile, merge_upsert
from tagloom.operators.references import null_dangling
from tagloom.schemas import ENTITIES, REPAIRED_KEYS
from tagloom.session import one_work_folder, remove_folder, settled, shuffles_freed, side_by_side
from tagloom.sinks.blocks import merge_blocks, read_blocks, write_blocks
from tagloom.sinks.tables import refresh_post_tags, table_path, write_tables
from tagloom.sources.site import entity_files, load_site
from tagloom.sources.xml_blocks import xml_errors
from tagloom.sources.xml_rows import CORRUPT, POSITION, corrupt_rows, good_rows

QUARANTINE, MALFORMED = "quarantine", "malformed"


def stage_sites(
    spark: SparkSession,
    site_dirs: Sequence[str],
    mode: str = "quarantine",
    bad_time: str = "sentinel",
) -> list[dict[str, DataFrame]]:
    """The sites' rows parsed once, to parquet in the work folder.

    What follows reads single columns several times; that is cheap on parquet
    and would parse all text again on XML. No file needs another one, so those
    of all sites are parsed side by side.
    """
    with shuffles_freed(spark):
        sites = side_by_side(spark, [partial(load_site, spark, d, mode, bad_time) for d in site_dirs])
        staged = iter(side_by_side(spark, [partial(settled, df) for rows in sites for df in rows.values()]))
    return [{name: next(staged) for name in rows} for rows in sites]


def stage_site(
    spark: SparkSession, site_dir: str, mode: str = "quarantine", bad_time: str = "sentinel"
) -> dict[str, DataFrame]:
    return stage_sites(spark, [site_dir], mode, bad_time)[0]


def add_site(
    spark: SparkSession, tables: Mapping[str, DataFrame], staged: Mapping[str, DataFrame]
) -> dict[str, DataFrame]:
    """``tables`` with the rows of one more site merged in and the posts repaired."""
    merged = dict(tables)
    rows = {name: good_rows(staged[name]) for name in ENTITIES if name in staged}
    profiles = dict(zip(rows, side_by_side(spark, [partial(key_profile, r) for r in rows.values()])))
    order = F.col(POSITION)
    for name, new in rows.items():
        entity = ENTITIES[name]
        how = {"update": entity.update, "order": order, "profile": profiles[name]}
        if name in tables:
            merged[name] = merge_upsert(tables[name], new, **how)
        else:
            merged[name] = collapse_repeats(new, **how).select(*entity.columns)
        if name == "posts":
            merged[name] = _repair(merged, met_before=name in tables)
    return merged


def _repair(tables: Mapping[str, DataFrame], met_before: bool) -> DataFrame:
    posts = tables["posts"]
    slim = posts.select("id", *REPAIRED_KEYS)
    users = tables.get("users")
    if users is None:
        users = slim.select("id").where(F.lit(False))
    else:
        users = users.select("id")
    if met_before:  # four checks are to come: merge the slim columns once
        slim, users = settled(slim), settled(users)
    parents = {"posts": slim.select("id"), "users": users}
    return null_dangling(
        posts, {column: parents[p] for column, p in REPAIRED_KEYS.items()}, slim=slim
    )


def merge_sites(spark: SparkSession, sites: Sequence[Mapping[str, DataFrame]]) -> dict[str, DataFrame]:
    """The tables of several staged sites, in order."""
    tables: dict[str, DataFrame] = {}
    with shuffles_freed(spark):
        for i, staged in enumerate(sites):
            if i > 1:
                tables = {name: settled(df) for name, df in tables.items()}
            tables = add_site(spark, tables, staged)
    return {name: df.select("*") for name, df in tables.items()}


def add_to_blocks(
    spark: SparkSession, staged: Mapping[str, DataFrame], store: str
) -> dict[str, list[int | None]]:
    """One more staged site merged into a store of blocks; the blocks of each table it rewrote.

    A merge takes no id away, so a reference that had its target keeps it, and none of the columns
    that a site updates is a reference: only the site's own posts are repaired, by the ids there
    are with it.
    """
    rewritten = {}
    for name in ENTITIES:
        if name not in staged:
            continue
        new = good_rows(staged[name])
        with one_work_folder(spark) as folder, shuffles_freed(spark):
            if name == "posts":
                stored = read_blocks(spark, store)
                parents = {
                    "posts": stored["posts"].select("id").unionByName(new.select("id")),
                    "users": stored["users"].select("id"),
                }
                new = null_dangling(new, {column: parents[p] for column, p in REPAIRED_KEYS.items()})
            rewritten[name] = merge_blocks(spark, store, name, new, order=F.col(POSITION))
        remove_folder(spark, folder)
    return rewritten


def _errors(spark: SparkSession, path: str) -> DataFrame:
    """What is wrong in a file; all that was written to find it out goes."""
    with one_work_folder(spark) as folder:
        errors = xml_errors(spark, path)
    found = settled(errors)
    remove_folder(spark, folder)
    return found


Place = tuple[str, str, str]  # site, entity, file


def _places_and_errors(spark: SparkSession, site_dirs: Sequence[str]) -> tuple[list[Place], list[DataFrame]]:
    places = [(d, name, path) for d in site_dirs for name, path in entity_files(spark, d).items()]
    with shuffles_freed(spark):
        return places, side_by_side(spark, [partial(_errors, spark, path) for _, _, path in places])


def _write_faults(
    spark: SparkSession,
    sites: Sequence[Mapping[str, DataFrame]],
    site_dirs: Sequence[str],
    places: Sequence[Place],
    errors: Sequence[DataFrame],
    store: str,
    how: str,
) -> None:
    """Text of malformed rows, and the first place of each file that is not well-formed."""
    corrupt = spark.createDataFrame([], f"site_dir string, entity string, {CORRUPT} string")
    for site_dir, staged in zip(site_dirs, sites):
        for name, df in staged.items():
            source = [F.lit(site_dir).alias("site_dir"), F.lit(name).alias("entity")]
            corrupt = corrupt.unionByName(corrupt_rows(df).select(*source, CORRUPT))
    corrupt.write.mode(how).parquet(table_path(store, QUARANTINE))
    malformed = spark.createDataFrame([], "site_dir string, entity string, file string, message string, record string")
    for (site_dir, name, _), found in zip(places, errors):
        source = [F.lit(site_dir).alias("site_dir"), F.lit(name).alias("entity")]
        malformed = malformed.unionByName(found.select(*source, "file", "message", "record"))
    malformed.write.mode(how).parquet(table_path(store, MALFORMED))


def import_sites(
    spark: SparkSession,
    site_dirs: Sequence[str],
    store: str,
    mode: str = "quarantine",
    bad_time: str = "sentinel",
    keep_staged: bool = False,
) -> None:
    """Rebuild the store from the unpacked dumps of the sites, in order.

    Text of malformed rows goes to ``<store>/quarantine``, and the first place of each file that is
    not well-formed to ``<store>/malformed``; with ``mode="failfast"`` either stops the import. Staged rows lie in one
    folder below the shared work folder, named in the log, which is removed when
    the store is written unless ``keep_staged`` is set.
    """
    with one_work_folder(spark) as folder:
        sites = stage_sites(spark, site_dirs, mode, bad_time)
        places, errors = _places_and_errors(spark, site_dirs)
        write_tables(spark, merge_sites(spark, sites), store)
        refresh_post_tags(spark, store)
        _write_faults(spark, sites, site_dirs, places, errors, store, "overwrite")
    if not keep_staged:
        remove_folder(spark, folder)


def import_into_blocks(
    spark: SparkSession,
    site_dirs: Sequence[str],
    store: str,
    width: int | None = None,
    mode: str = "quarantine",
    bad_time: str = "sentinel",
) -> None:
    """Merge the unpacked dumps of the sites, in order, into a store of blocks.

    With ``width`` the store is begun anew in blocks of so many ids; without, what it holds is
    kept. Malformed rows and files are noted as ``import_sites`` does, beside those of earlier
    imports.
    """
    with one_work_folder(spark) as folder:
        sites = stage_sites(spark, site_dirs, mode, bad_time)
        places, errors = _places_and_errors(spark, site_dirs)
        if width is not None:
            write_blocks(spark, {}, store, width)
        for staged in sites:
            add_to_blocks(spark, staged, store)
        how = "append" if width is None else "overwrite"
        _write_faults(spark, sites, site_dirs, places, errors, store, how)
    remove_folder(spark, folder)
