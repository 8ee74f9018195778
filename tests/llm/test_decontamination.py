import random

import numpy as np
import pyarrow as pa
import pytest
from conftest import sentence
from hypothesis import given, settings
from hypothesis import strategies as st

from tagloom.llm.decontamination import (
    IDF_BITS,
    clean_documents,
    common_subsequence,
    contaminated,
    places_of,
    word_weights,
)
from tagloom.llm.words import words_of


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 4), max_size=12), st.lists(st.integers(0, 4), max_size=12))
def test_common_subsequence(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    assert common_subsequence(a, b) == table[-1][-1]


def items(spark, extra=()):
    rows = [(k, sentence(1000 + k, 15 + 7 * k, 4000)) for k in range(12)]
    return rows, spark.createDataFrame([*rows, *extra], "item_id long, text string")


def test_planted_items_are_found(spark, table):
    rows, benchmark = items(spark, [(50, None), (51, ""), (0, sentence(1000, 15, 4000))])
    rng = random.Random(4)
    docs, planted = [], set()
    for k in range(200):
        text = sentence(k, rng.randint(10, 700), 4000).split()
        if k % 8 == 0:
            item = rows[k // 8 % 12]
            words = item[1].split()
            if k % 16 == 0:  # a paraphrase: every fourth word is another, but for the end
                words = [w if j % 4 or j >= len(words) - 4 else f"other{j}" for j, w in enumerate(words)]
            at = rng.randint(0, len(text))
            text[at:at] = words
            planted.add((k, item[0]))
        docs.append((k, "\n".join([" ".join(text).upper()]) if k % 3 == 0 else " ".join(text)))
    found = contaminated(table(docs), benchmark).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == planted
    assert {r["kind"] for r in found} == {"verbatim", "paraphrase"}
    kept = clean_documents(table(docs, clashing=True), benchmark)
    assert {r["doc_id"] for r in kept.collect()} == set(range(200)) - {d for d, _ in planted}


def test_answers_decide_about_paraphrases(spark, table):
    words = [f"q{k}" for k in range(20)]
    benchmark = spark.createDataFrame([(1, " ".join(words), "forty two")], "item_id long, text string, answer string")
    half = [w if k % 3 else f"z{k}" for k, w in enumerate(words)]
    filler = [(10 + k, sentence(k, 60, 3000)) for k in range(40)]
    docs = table([(1, " ".join(half)), (2, " ".join([*half, "forty", "two"])), *filler])
    assert {r["doc_id"] for r in contaminated(docs, benchmark).collect()} == {2}


def test_awkward_rows(spark, awkward, table):
    _, benchmark = items(spark)
    assert contaminated(awkward, benchmark).count() == 0
    assert sorted(map(repr, clean_documents(awkward, benchmark).collect())) == sorted(map(repr, awkward.collect()))
    assert contaminated(table([]), benchmark).count() == 0
    assert contaminated(awkward, benchmark.limit(0)).count() == 0
    # Every row has it, the null ids' too, which are reported together.
    text = awkward.where("doc_id = 1").first()["text"]
    many = table([(100 + k, sentence(50 + k, 50, 3000)) for k in range(200)] + [(1, text), (None, text), (None, text)])
    found = contaminated(many, spark.createDataFrame([(9, text)], "item_id long, text string"))
    assert sorted(map(repr, (r["doc_id"] for r in found.collect()))) == ["1", "None"]


@pytest.mark.parametrize("n", [1000, 2500])
def test_recall_does_not_fall_with_the_number_of_items(spark, table, n):
    rng = random.Random(n)
    pool = [f"w{k}" for k in range(20_000)]
    rows = [(k, " ".join(rng.choices(pool, k=rng.randint(15, 59)))) for k in range(n)]
    docs = []
    for k, item in rows:
        words = item.split()
        if k % 2:  # a paraphrase: every fifth word is another, but for the end
            words = [w if j % 5 or j >= len(words) - 4 else f"other{j}" for j, w in enumerate(words)]
        docs.append((k, " ".join([*rng.choices(pool, k=40), *words, *rng.choices(pool, k=40)])))
    benchmark = spark.createDataFrame(rows, "item_id long, text string")
    found = contaminated(table(docs), benchmark).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == {(k, k) for k in range(n)}


def test_a_leak_in_a_third_of_all_rows_is_found(spark, table):
    rows, benchmark = items(spark)
    words = rows[4][1].split()
    paraphrase = [w if j % 4 or j >= len(words) - 4 else f"other{j}" for j, w in enumerate(words)]
    docs, planted = [], set()
    for k in range(300):
        text = sentence(5000 + k, 120, 4000).split()
        if k % 3 == 0:
            text[40:40] = paraphrase if k % 2 else words
            planted.add(k)
        docs.append((k, " ".join(text)))
    found = contaminated(table(docs), benchmark).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == {(k, rows[4][0]) for k in planted}
    assert {r["doc_id"]: r["kind"] for r in found} == {k: "paraphrase" if k % 2 else "verbatim" for k in planted}
    assert {r["doc_id"] for r in clean_documents(table(docs), benchmark).collect()} == set(range(300)) - planted


def test_items_of_few_or_common_words_are_found_word_for_word(spark, table):
    short = [(1, "zebra"), (2, "Zebra quagga"), (3, "of the and it"), (4, "what of the and it then or so to")]
    benchmark = spark.createDataFrame(short, "item_id long, text string")
    common = "what of the and so it then or to"
    docs = [(k, f"{sentence(k, 60, 3000)} {common}") for k in range(100)]
    docs += [(200 + k, f"{sentence(300 + k, 60, 3000)} {text} {common}") for k, text in short]
    docs += [(300, "zebra"), (301, "quagga zebra\nquagga")]
    found = contaminated(table(docs), benchmark).collect()
    wanted = {(200 + k, k) for k, _ in short} | {(202, 1), (204, 3), (300, 1), (301, 1), (301, 2)}
    assert {(r["doc_id"], r["item_id"]) for r in found} == wanted


def test_a_bound_stands_for_a_subsequence_that_is_too_short_anyway():
    rng = random.Random(8)
    for _ in range(200):
        a, b = ([rng.randrange(9) for _ in range(rng.randrange(1, 40))] for _ in range(2))
        exact = common_subsequence(a, b)
        for least in (0, len(a) // 2, len(a)):
            got = common_subsequence(a, b, places_of(a), least)
            assert got == exact or exact <= got < least
    # Words that are not in the passage bound it without a look at their order.
    assert common_subsequence([1, 2, 3, 4], [2, 1, 7, 7, 7], places_of([1, 2, 3, 4]), 3) == 2


def test_words_weigh_what_their_texts_say(spark):
    # More texts in a slice than the short form of a text and a word's bucket can tell apart.
    texts = [f"w{i % 7000} w{i % 7000} x{i} rare" if i % 40 == 0 else f"w{i % 7000} x{i}" for i in range(20_000)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, None, ""])], "doc_id long, text string").coalesce(1)
    batches = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(batches)
    spark.conf.set(batches, "50000")
    try:
        weights = word_weights(docs)
    finally:
        spark.conf.set(batches, before)
    seen = np.zeros(1 << IDF_BITS, dtype=np.int64)
    for t in texts:
        hashes = words_of(pa.array([t]), fold_case=True).hashes
        seen[np.unique((hashes >> np.uint64(64 - IDF_BITS)).astype(np.int64))] += 1
    n = len(texts) + 1  # an empty text counts, null doesn't
    expected = np.where(seen > 0.05 * n, 0, np.log((n + 1) / (seen + 1))).astype(np.float32)
    assert (weights == expected).all()
