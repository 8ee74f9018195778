import tempfile
from collections import Counter

from tagloom.llm.queries import shard_digest
from tagloom.llm.sharding import sharded, write_shards


def test_law_of_rows(table):
    docs = table([(k, f"text {k % 5}" * (k % 9), "en", "s", k) for k in range(1003)])
    found = sharded(docs, shards=16, bucket_bytes=2000).collect()
    counts = Counter(r["shard"] for r in found)
    assert set(counts) == set(range(16)) and max(counts.values()) - min(counts.values()) <= 1
    for shard, n in counts.items():
        assert sorted(r["slot"] for r in found if r["shard"] == shard) == list(range(n))
    assert sorted(r["doc_id"] for r in found) == list(range(1003))
    order = [r["doc_id"] for r in sorted(found, key=lambda r: (r["shard"], r["slot"]))]
    assert order != sorted(order)
    again = sharded(docs.repartition(7), shards=16, bucket_bytes=2000).collect()
    assert {(r["doc_id"], r["shard"], r["slot"]) for r in found} == {(r["doc_id"], r["shard"], r["slot"]) for r in again}
    other = sharded(docs, shards=16, bucket_bytes=2000, seed=1).collect()
    assert {(r["doc_id"], r["shard"]) for r in found} != {(r["doc_id"], r["shard"]) for r in other}


def test_fewer_rows_than_shards_and_none(table):
    found = sharded(table([(1, "a"), (2, None)]), shards=16).collect()
    assert len({r["shard"] for r in found}) == 2 and [r["slot"] for r in found] == [0, 0]
    assert sharded(table([])).count() == 0


def test_written_shards_hold_the_rows(awkward):
    with tempfile.TemporaryDirectory() as folder:
        found = write_shards(awkward, f"{folder}/out")
        assert set(found.columns) == set(awkward.columns)  # its shard and slot are the operator's
        same = [c for c in awkward.columns if c not in ("shard", "slot")]
        assert sorted(map(repr, found.select(*same).collect())) == sorted(map(repr, awkward.select(*same).collect()))
        digest = shard_digest(found).collect()
        import zlib

        texts = {r["doc_id"]: r["text"] for r in awkward.collect()}
        for row in digest:
            if row["doc_id"] is not None:
                data = (texts[row["doc_id"]] or "").encode()
                assert (row["size"], row["text_crc32"]) == (len(data) + 1, zlib.crc32(data))


def _placed(found):
    """Shards' slots are gapless and their counts at most one apart."""
    counts = Counter(r["shard"] for r in found)
    assert max(counts.values()) - min(counts.values()) <= 1
    for shard, n in counts.items():
        assert sorted(r["slot"] for r in found if r["shard"] == shard) == list(range(n))


def test_one_id_on_a_third_of_all_rows(table):
    """Its rows fill many buckets, the same ones in each run."""
    rows = [(7 if k % 3 else k, f"text {k} " * 9, "en", "s", k) for k in range(1200)]
    docs = table(rows)
    found = sharded(docs, shards=4, bucket_bytes=4000).collect()
    _placed(found)
    assert sorted((r["doc_id"], r["text"]) for r in found) == sorted(r[:2] for r in rows)
    again = sharded(docs.repartition(5), shards=4, bucket_bytes=4000).collect()
    assert {tuple(r) for r in found} == {tuple(r) for r in again}
    hot = sorted((r["shard"], r["slot"]) for r in found if r["doc_id"] == 7)
    assert len({shard for shard, _ in hot}) == 4


def test_equal_rows_fill_many_buckets(spark, table):
    rows = [(None, "the same text", "en", "s", 1)] * 600 + [(k, f"text {k}", "en", "s", k) for k in range(300)]
    found = sharded(table(rows), shards=4, bucket_bytes=700)
    together = found.collect()
    _placed(together)
    assert sorted(repr(tuple(r)[:5]) for r in together) == sorted(map(repr, rows))
    assert len({r["shard"] for r in together if r["doc_id"] is None}) == 4


def test_buckets_stay_small(spark, table):
    """No bucket is left with more than a few times its bytes, however rows repeat."""
    from pyspark.sql import functions as F

    from tagloom.llm.scratch import Scratch
    from tagloom.llm.sharding import _begins, _split

    rows = spark.range(5000).select(
        F.lit(3).cast("long").alias("_bucket"), F.lit(10).cast("long").alias("_size"), (F.col("id") % 2).alias("_row")
    )
    scratch = Scratch(spark)
    halves = _split(rows, F.xxhash64("_row"), 1000, scratch)
    assert halves.select("_bucket").distinct().count() <= 2
    many = _split(halves, F.xxhash64(F.monotonically_increasing_id()), 1000, scratch)
    loads = many.groupBy("_bucket").agg(F.sum("_size").alias("n")).collect()
    assert len(loads) >= 40 and max(r["n"] for r in loads) <= 4000
    begins = {r["_of"]: r["begin"] for r in _begins(many, 50_000).collect()}
    ends = sorted((begins[r["_bucket"]], begins[r["_bucket"]] + r["n"] // 10) for r in loads)
    assert ends[0][0] == 0 and ends[-1][1] == 5000
    assert all(a[1] == b[0] for a, b in zip(ends, ends[1:], strict=False))
