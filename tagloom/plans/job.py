"""The jobs: import, queries, and both."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession

from tagloom.operators.audit import fk_audit
from tagloom.plans.importing import import_sites
from tagloom.plans.low_scored_accepted import low_scored_accepted
from tagloom.plans.reputation_pairs import reputation_pairs
from tagloom.sinks.results import write_json, write_plan
from tagloom.sinks.tables import read_tables, refresh_post_tags

QUERIES = {"q1": reputation_pairs, "q2": low_scored_accepted}


def run_queries(spark: SparkSession, store: str, results: str, refresh: bool = True) -> None:
    """Refresh post_tags unless told not to, audit the references, run each query;
    save rows and plans."""
    if refresh:
        refresh_post_tags(spark, store)
    tables = read_tables(spark, store)
    write_json(fk_audit(tables), results, "fk_audit")
    for name, query in QUERIES.items():
        rows = query(tables["posts"], tables["users"])
        write_plan(rows, results, name)
        write_json(rows, results, name)


def run_all(spark: SparkSession, site_dirs: Sequence[str], store: str, results: str) -> None:
    import_sites(spark, site_dirs, store)
    run_queries(spark, store, results, refresh=False)  # the import has just built post_tags
