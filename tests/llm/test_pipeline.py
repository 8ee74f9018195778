import corpus_pipeline


def test_stages_and_run(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "similar", "benchmark", "mix", "shard"]
    assert corpus_pipeline.ORACLE_SQL is None
    found = corpus_pipeline.run(spark, sf_dir)
    assert found.columns == [*docs.columns, "shard", "slot"]
    rows = found.select("doc_id", "shard", "slot").collect()
    counts = {}
    for r in rows:
        counts.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in counts.values())
    assert max(map(len, counts.values())) - min(map(len, counts.values())) <= 1
    # What the stages reject is gone: benchmark texts, and copies beyond the mix's second round.
    items = [r["text"] for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    assert not any(i in r["text"] for r in found.select("text").collect() for i in items)
    ids = [r["doc_id"] for r in rows]
    assert max(map(ids.count, set(ids))) <= 2


def test_stages_on_awkward_and_empty_tables(spark, sf_dir, awkward, table, tmp_path):
    """Nulls, empty and long texts, repeated rows and clashing names pass through every stage."""
    for name, docs in (("awkward", awkward), ("empty", table([]))):
        columns = docs.columns
        for stage, step in corpus_pipeline.STAGES:
            path = str(tmp_path / f"{name}-{stage}")
            step(spark, docs, sf_dir).write.parquet(path)
            docs = spark.read.parquet(path)
            if stage != "shard":
                assert docs.columns == columns
        found = docs.collect()
        assert docs.columns == [*[c for c in columns if c not in ("shard", "slot")], "shard", "slot"]
        assert (len(found) > 0) == (name == "awkward")
        assert len({(r["shard"], r["slot"]) for r in found}) == len(found)
