"""Ranks against a row-by-row computation."""

import math
import random
import re
from collections import Counter

import pytest

from tagloom.llm import lexical_search as module
from tagloom.llm.lexical_search import ranked_documents

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def by_brute_force(docs, items, k):
    held = [(d, Counter(terms(t))) for d, t in docs]
    count = sum(1 for _, c in held if c)
    total = sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in set(items):
        scored = []
        for d, c in held:
            if not c:
                continue
            m = 100 - 25 + (25 * sum(c.values()) * count) // total
            score = sum(
                math.floor(1000 * math.log((2 * count + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 12 * m))
                for t in terms(text)
                if c[t]
            )
            if score > 0:
                scored.append((-score, d is None, d))
        out += [(item, i + 1, d, -s) for i, (s, _, d) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:k])]
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def corpus(table):
    rng = random.Random(6)
    pool = ["The", "the", "a", "Çe", "çe", "漢字", "x1", "x", "rare", "word", "Word", "-", "...", "e_e", "É", "é"]
    texts = [" ".join(rng.choices(pool, k=rng.randint(0, 30))) for _ in range(300)]
    texts += [texts[5]] * 40 + ["the " * 5000, None, "", "- - ."]
    docs = [(i * 7 % 1000, t) for i, t in enumerate(texts)] + [(None, texts[5]), (3, texts[5]), (3, texts[5])]
    items = [(i, " ".join(rng.choices(pool, k=rng.randint(0, 8)))) for i in range(25)]
    items += [(1, "rare"), items[0], (None, "x1 é"), (30, None), (31, ""), (32, "nowhere"), (33, "the the the")]
    return docs, items


@pytest.mark.parametrize("postings", [module.POSTINGS, 9])
@pytest.mark.parametrize("k", [1, 20])
def test_ranks(spark, corpus, table, k, postings):
    docs, items = corpus
    asked = spark.createDataFrame([(*i, "extra", 1) for i in items], "item_id long, text string, rank string, score int")
    got = ranked_documents(table(docs, clashing=True).repartition(5), asked, k=k, postings=postings)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert found(got) == by_brute_force(docs, items, k)


def test_few_cells_at_once(spark, corpus, table, monkeypatch):
    docs, items = corpus
    asked = spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(module, "CELLS", 50)
    assert found(ranked_documents(table(docs), asked)) == by_brute_force(docs, items, 20)


def test_awkward_and_empty(spark, awkward):
    asked = spark.createDataFrame([(1, "ONE two 漢字"), (2, None)], "item_id long, text string")
    docs = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    assert found(ranked_documents(awkward, asked)) == by_brute_force(docs, [(1, "ONE two 漢字"), (2, None)], 20)
    assert ranked_documents(awkward.limit(0), asked).count() == 0
    assert ranked_documents(awkward, asked.limit(0)).count() == 0


def test_lengths_beyond_64_bits():
    import numpy as np

    n = np.array([10**7, 3])
    assert module.length_terms(n, 10**11, 10**14).tolist() == [75 + 25 * 10**7 * 10**11 // 10**14, 75]
