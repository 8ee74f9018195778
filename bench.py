"""Times the headline queries and prints one JSON line.

As in an import followed by queries, the tables are first written to a store
(``setup``, not part of the value); the queries then read the stored parquet and
the XML files. Every query runs over its whole tables, twice to warm up and then
three times, and the best time counts.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import DataFrame

from tagloom.fixtures import table, tables, view, write_xml
from tagloom.operators.audit import fk_audit, not_null_audit, pk_audit
from tagloom.operators.merge import insert_ignore, merge_upsert
from tagloom.operators.posts import post_tags
from tagloom.operators.references import null_dangling
from tagloom.plans.importing import merge_sites, stage_sites
from tagloom.plans.low_scored_accepted import low_scored_accepted
from tagloom.plans.reputation_pairs import reputation_pairs
from tagloom.schemas import ENTITIES, REPAIRED_KEYS
from tagloom.session import local_session, settled, work_folder
from tagloom.sinks.tables import read_tables, write_tables
from tagloom.sources.site import ingest
from tagloom.sources.xml_rows import good_rows

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
WARM_UPS, RUNS = 2, 3


def run_all_rows(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = local_session(CPUS)
    started = time.perf_counter()
    store = work_folder(spark)
    write_tables(spark, tables(spark, SF_DIR), store)
    t = read_tables(spark, store)
    posts, users = t["posts"], t["users"]
    sites = []
    for suffix in ("", "_meta"):
        sites.append(work_folder(spark))
        for name in ("users", "posts", "comments"):
            write_xml(view(spark, SF_DIR, name + suffix), ENTITIES[name], sites[-1])
    meta = {n: settled(table(spark, SF_DIR, f"{n}_meta")) for n in ("users", "posts", "comments")}
    parents = {c: t[p].select("id") for c, p in REPAIRED_KEYS.items()}
    setup = time.perf_counter() - started

    queries = {
        "q1": lambda: reputation_pairs(posts, users),
        "q1_anchored": lambda: reputation_pairs(posts, users, min_count=5, tag="f"),
        "q2": lambda: low_scored_accepted(posts, users),
        "q2_tagged": lambda: low_scored_accepted(posts, users, max_score=-1, tag="automobile"),
        "post_tags": lambda: post_tags(posts),
        "null_dangling_owner": lambda: null_dangling(posts, {"owner_user_id": parents["owner_user_id"]}),
        "null_dangling_all": lambda: null_dangling(posts, parents),
        "upsert_posts": lambda: merge_upsert(posts, meta["posts"], update=ENTITIES["posts"].update),
        "insert_ignore_comments": lambda: insert_ignore(t["comments"], meta["comments"]),
        "fk_audit": lambda: fk_audit(t),
        "pk_audit": lambda: pk_audit(t),
        "not_null_audit": lambda: not_null_audit(t),
        "ingest_posts": lambda: good_rows(ingest(spark, f"{sites[0]}/Posts.xml", ENTITIES["posts"])),
        "load_two_sites_posts": lambda: merge_sites(spark, stage_sites(spark, sites))["posts"],
    }
    times = {}
    for name, query in queries.items():
        for _ in range(WARM_UPS):
            run_all_rows(query())
        runs = []
        for _ in range(RUNS):
            begin = time.perf_counter()
            run_all_rows(query())
            runs.append(time.perf_counter() - begin)
        times[name] = round(min(runs), 3)
    line = {
        "metric": "headline queries, sum of best times",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
        "cpus": CPUS,
        "setup": round(setup, 3),
        "rows": {"posts": posts.count(), "users": users.count()},
    }
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()
