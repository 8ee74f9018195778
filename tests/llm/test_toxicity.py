import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tagloom.llm import toxicity as tx
from tagloom.llm.words import words_of


def scores(network, texts):
    return network.scores(words_of(pa.array(texts, pa.string()), fold_case=True))


def test_network_learns_and_reads_to_the_end():
    from conftest import sentence

    texts = [sentence(k, 50, 400) for k in range(300)]
    labels = np.arange(300) % 2
    marked = [t + (" vileword," if k % 4 == 1 else " badness") if k % 2 else t for k, t in enumerate(texts)]
    network = tx.fit(marked, labels)
    clean = sentence(0, 50, 400)
    long = " ".join([sentence(k, 50, 400) for k in range(0, 120, 2)])
    found = scores(network, [clean, clean + " vileword", long, long + " BADNESS!", None, ""])
    assert (found[[1, 3]] > 0.5).all() and (found[[0, 2, 4, 5]] < 0.5).all()
    assert found[4] == found[5]
    usual = tx.PIECE_WORDS
    tx.PIECE_WORDS = 64
    try:
        assert np.allclose(scores(network, [clean, clean + " vileword", long, long + " BADNESS!", None, ""]), found, atol=1e-5)
    finally:
        tx.PIECE_WORDS = usual


def test_thresholds():
    assert tx.best_threshold(np.array([0.9, 0.8, 0.2]), np.array([1, 1, 0])) == 0.5
    assert tx.best_threshold(np.array([]), np.array([])) == 0.5
    assert tx.best_threshold(np.array([0.4, 0.4]), np.array([1, 1])) == 0.5


def test_awkward_rows(awkward, table, spark):
    labels = spark.createDataFrame(
        [(1, 1), (2, 0), (3, 1), (None, 1), (7, None), (6, 0), (1, 1)], "doc_id long, toxic int"
    )
    network, thresholds = tx.train(awkward, labels)
    assert network is not None and None in thresholds
    found = tx.scored(awkward, network, thresholds, keep={"held_out": F.lit(False)}).collect()
    assert len(found) == awkward.count()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in found)
    assert tx.scored(table([]), network, thresholds).count() == 0
    none, _ = tx.train(awkward, labels.where("toxic = 1"))
    assert none is None
    assert {r["score"] for r in tx.scored(awkward, None, {}).collect()} == {0.0}


def test_counted_scores_give_the_same_threshold():
    rng = np.random.default_rng(3)
    labels = (rng.random(500) < 0.3).astype(np.int64)
    bins = np.minimum((rng.random(500) * 0.5 + labels * 0.4) * tx.BINS, tx.BINS - 1).astype(int)
    found = [(int(b), 1, int(k)) for b, k in zip(bins, labels, strict=True)]
    assert abs(tx.best_of_bins(found) - tx.best_threshold((bins + 0.5) / tx.BINS, labels)) < 2 / tx.BINS
    assert tx.best_of_bins([]) == tx.best_of_bins([(3, 5, 5)]) == 0.5


def test_all_labelled_rows_and_whole_texts_are_learned(spark, table, monkeypatch):
    """Rows beyond any sample and words beyond any length count, on one task and on several."""
    from conftest import sentence

    docs, labels = [], []
    for k in range(400):
        long = sentence(k, 50, 400)
        if k in (5, 7, 9, 11):
            long = f"{long} " * (70_000 // len(long) + 1)
        mark = " rareword" if k in (5, 7, 9, 11) else " vileword" if k % 4 == 1 else ""
        docs.append((k, long + mark, "en"))
        labels.append((k, int(bool(mark))))
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    seen = []
    count = tx._shared_hashes
    monkeypatch.setattr(tx, "_shared_hashes", lambda rows, n: seen.append((rows.count(), n)) or count(rows, n))
    for share in (12_800, 150):
        monkeypatch.setattr(tx, "SHARE", share)
        network, thresholds = tx.train(table(docs), marks)
        assert seen.pop() == (400, 400)
        clean = sentence(1000, 50, 400)
        found = scores(network, [clean, clean + " vileword"])
        assert found[1] > 0.5 > found[0], (share, found)
        assert {None, "en"} <= set(thresholds)
        assert (network.tables[0] != 0).any(axis=1).sum() >= 50
