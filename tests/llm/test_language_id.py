import numpy as np
from pyspark.sql import functions as F

from tagloom.llm import language_id as li


def test_bundle_is_the_sum_of_bound_letters():
    encoder = li.Encoder(size=64)
    v = [encoder.letter(ord(c)).astype(int) for c in "ab"]
    gap = encoder.letter(0).astype(int)
    # " ab " has the n-grams " ab" and "ab ".
    expected = gap * 0
    for x, y, z in ((gap, v[0], v[1]), (v[0], v[1], gap)):
        expected = expected + np.roll(x, 2) * np.roll(y, 1) * z
    assert li.bundles(["Ab"], encoder)[0].astype(int).tolist() == expected.tolist()
    assert li.bundles([".. ab ,"], encoder)[0].astype(int).tolist() == expected.tolist()
    assert not li.bundles(["", "12 !?"], encoder).any()


def test_long_texts_are_counted_whole():
    text = "abc déf " * 300
    usual = li.PIECE_CHARS
    whole = [np.sort(np.concatenate(list(li.gram_codes(text))))]
    li.PIECE_CHARS = 7
    try:
        parts = np.sort(np.concatenate(list(li.gram_codes(text))))
    finally:
        li.PIECE_CHARS = usual
    assert whole[0].tolist() == parts.tolist()


def test_awkward_rows(awkward, table):
    languages, profiles = li.learn_profiles(awkward)
    assert languages == ["en", "fr", "xx"]  # the German texts have no letter
    rows = li.identify(awkward, languages, profiles, keep={"n": F.lit(1)}).collect()
    assert len(rows) == awkward.count()
    by = {r["doc_id"]: r for r in rows if r["doc_id"] is not None}
    assert [by[k]["lang_pred"] for k in (3, 4, 5)] == ["und"] * 3
    assert by[9]["lang_pred"] == "xx" and by[1]["lang_pred"] == "en"
    assert all(0 <= r["score"] <= 1 for r in rows)
    empty = table([])
    assert li.learn_profiles(empty)[0] == []
    assert li.identify(empty, languages, profiles).count() == 0
    assert {r["lang_pred"] for r in li.identify(awkward, *li.learn_profiles(empty)).collect()} == {"und"}


def test_held_out_accuracy(spark, sf_dir):
    from tagloom.llm.queries import queries

    found = queries()["op1_language_id"](spark, sf_dir.replace("0.001", "0.01"))
    docs = spark.read.parquet(sf_dir.replace("0.001", "0.01") + "/documents.parquet")
    right = found.where("held_out").join(docs, "doc_id").where("lang is not null")
    assert right.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.97
