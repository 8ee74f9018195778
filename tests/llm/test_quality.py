import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from conftest import sentence
from pyspark.sql import functions as F

from tagloom.llm import quality as q


def by_definition(texts, alphabet):
    """Losses of texts under interpolated modified Kneser-Ney, with dictionaries."""
    number = {c: i + 1 for i, c in enumerate(alphabet)}

    def symbols(text):
        return (0,) * 3 + tuple(number.get(ord(c), 63) for c in text) + (0,)

    def grams(text):
        s = symbols(text)
        return [s[i : i + 4] for i in range(len(s) - 3)] if text else []

    tables = {4: Counter(g for t in texts for g in grams(t))}
    for n in (3, 2, 1):
        tables[n] = Counter(g[1:] for g in tables[n + 1])
    discounts = {}
    for n, table in tables.items():
        n1, n2, n3, n4 = (sum(v == k for v in table.values()) for k in (1, 2, 3, 4))
        y = n1 / max(1, n1 + 2 * n2)
        discounts[n] = [
            min(max(k - (k + 1) * y * b / max(1, a), 0), k) for k, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4))
        ]

    def p(gram):
        n = len(gram)
        if not n:
            return 1 / 64
        lower, table = p(gram[1:]), tables[n]
        mine = {g: c for g, c in table.items() if g[:-1] == gram[:-1]}
        if not mine:
            return lower
        cut = {g: min(discounts[n][min(c, 3) - 1], c) for g, c in mine.items()}
        total = sum(mine.values())
        return (mine.get(gram, 0) - cut.get(gram, 0)) / total + sum(cut.values()) / total * lower

    return lambda text: -sum(math.log(p(g)) for g in grams(text))


def test_model_equals_definition(spark, table):
    texts = ["abba", "a b a b", "bab", "", "abab abba é"]
    docs = table(list(enumerate(texts)))
    alphabet = q.common_symbols(docs)
    assert alphabet == sorted(map(ord, set("".join(texts))))
    model = q.kneser_ney(q.gram_counts(docs, alphabet), alphabet)
    expected = by_definition(texts, alphabet)
    others = table([(k, t) for k, t in enumerate([*texts, "zab", "bbbb", "🙂", None])])
    for row in q.with_loss(others, model).collect():
        assert row["_loss"] == pytest.approx(expected(row["text"] or ""), rel=1e-5)
        assert row["_symbols"] == (len(row["text"]) + 1 if row["text"] else 0)
    losses = model.losses()
    assert np.exp(-losses.reshape(-1, 64)[:200].astype(float)).sum(axis=1) == pytest.approx(1, rel=1e-3)


def test_grams_of_several_texts():
    table = q.symbol_table([ord("a")])
    codes, n = q.text_grams(pa.array(["a", None, "", "aa"]), table)
    assert n.tolist() == [2, 0, 0, 3]
    assert codes.tolist() == [1, 64, 1, 65, 65 * 64]


def corpus(table, clashing=False):
    good = [(k, sentence(k % 30, 60, 300), "en" if k % 2 else None) for k in range(300)]
    bad = [(1000 + k, "#%&*" * 200, "en") for k in range(10)]
    return table([*good, *bad], clashing)


def test_junk_goes_and_trusted_like_texts_stay(spark, table):
    trusted = spark.range(0, 300, 2).union(spark.range(1, 300, 4)).select(F.col("id").alias("doc_id"))
    docs = corpus(table, clashing=True)
    found = q.quality(docs, trusted).collect()
    assert {r["doc_id"] for r in found if not r["kept"]} == set(range(1000, 1010))
    assert all((r["perplexity"] <= r["threshold"]) == r["kept"] for r in found)
    kept = q.good_documents(docs, trusted)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == set(range(300))


def test_awkward_rows(spark, awkward, table):
    ids = spark.createDataFrame([(1,), (1,), (2,), (None,), (6,)], "doc_id long")
    found = {r["doc_id"]: r for r in q.quality(awkward, ids).collect()}
    assert found[3]["kept"] and found[4]["kept"] and found[1]["kept"]
    assert q.quality(awkward, ids).count() == awkward.count()
    assert all(r["kept"] for r in q.quality(awkward, ids.limit(0)).collect())
    assert q.quality(table([]), ids).count() == 0
    assert q.good_documents(awkward, ids.limit(0)).count() == awkward.count()


def test_code_points_without_a_symbol_are_told_apart(spark, table):
    few = "".join(chr(0x4E00 + k) * (200 - k) for k in range(62))
    texts = [few + "éééx", "é🙂" + few, few]
    docs = table([*enumerate(texts), (9, few + "ü")])
    trusted = spark.createDataFrame([(0,), (1,), (2,)], "doc_id long").where(~q.held_back("doc_id"))
    model = q.learn(docs, trusted)
    assert len(model.alphabet) == 62
    shares = dict(zip(map(chr, model.rest[0].tolist()), np.exp(-model.rest[1]).tolist(), strict=True))
    assert set(shares) == set("éx🙂ü") and sum(shares.values()) == pytest.approx(1)
    kept = [t for k, t in enumerate(texts) if trusted.where(f"doc_id = {k}").count()]
    counts = Counter("".join(kept))
    total = sum(counts[c] for c in shares) + len(shares)
    assert shares == pytest.approx({c: (counts[c] + 1) / total for c in shares})
    pair = table([(1, few + "é"), (2, few + "ü"), (3, few), (4, None), (5, "é"), (6, "ü")])
    loss = {r["doc_id"]: r["_loss"] for r in q.with_loss(pair, model).collect()}
    gap = math.log(shares["é"] / shares["ü"])
    assert loss[2] - loss[1] == pytest.approx(gap, rel=1e-3, abs=1e-3) and loss[6] - loss[5] == pytest.approx(gap, rel=1e-3, abs=1e-3)
    assert loss[4] == 0


def exactly(texts, corpus, alphabet):
    """Probabilities of n-grams by all code points, from those of their symbols, with dictionaries."""
    apart, number = set("".join(corpus)) - set(map(chr, alphabet)), {c: i + 1 for i, c in enumerate(map(chr, alphabet))}

    def grams(text):
        s = (None,) * 3 + tuple(text) + (None,)
        return [s[i : i + 4] for i in range(len(s) - 3)] if text else []

    rest = Counter(c for t in texts for c in t if c in apart)
    share = {c: (rest[c] + 1) / (sum(rest.values()) + len(apart)) for c in apart}
    tables = {4: Counter(g for t in texts for g in grams(t) if apart & {*g})}
    for n in (3, 2):
        tables[n] = Counter(g[1:] for g in tables[n + 1] if apart & {*g[1:]})
    off = {}
    for n, table in tables.items():
        n1, n2, n3, n4 = (sum(v == k for v in table.values()) for k in (1, 2, 3, 4))
        y = n1 / max(1, n1 + 2 * n2)
        off[n] = [min(max(k - (k + 1) * y * b / max(1, a), 0.1), k) for k, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4))]

    def p(gram, symbol):
        """``symbol`` is the probability of the last one's symbol after those of the others."""
        found = symbol * share.get(gram[-1], 1.0)
        for n in (2, 3, 4):
            context, last = gram[4 - n : 3], gram[3]
            mine = {g: c for g, c in tables[n].items() if g[:-1] == context}
            if not mine or not (apart & {*context} or last in apart):
                continue
            cut = {g: min(off[n][min(c, 3) - 1], c) for g, c in mine.items()}
            own, total = (*context, last), sum(mine.values())
            mass = 1.0 if apart & {*context} else symbol
            found = mass * (mine.get(own, 0) - cut.get(own, 0)) / total + sum(cut.values()) / total * found
        return found

    return p, grams, number, apart


FEW = "".join(chr(0x4E00 + k) * 40 for k in range(62))


@pytest.mark.parametrize("known", [1 << 20, 2, 0])
def test_other_scripts_have_contexts_of_their_own(spark, table, monkeypatch, known):
    monkeypatch.setattr(q, "KNOWN", known)
    texts = ["абвабваб", "вабаб а", f"{FEW}аб", "", "ббв" + FEW[:50]]
    others = ["абаб", "баба", "яааб", FEW[30:60], "а", FEW[10:45] + "аб" + FEW[:3], None, "вввввв абв абв"]
    docs = table([*enumerate([*texts, *others])])
    corpus = [*texts, *(t for t in others if t)]
    scratch = q.Scratch(spark)
    trusted = spark.createDataFrame([(k,) for k in range(len(texts))], "doc_id long")
    monkeypatch.setattr(q, "held_back", lambda id: F.lit(False))
    model, exact = q._refined(docs, trusted, "doc_id", "text", scratch)
    alphabet = model.alphabet
    assert len(alphabet) == 62 and exact.count() > 2
    p, grams, number, apart = exactly(texts, corpus, alphabet)
    losses = model.losses()

    def symbol(gram):
        code = 0
        for c in gram:
            code = code * 64 + (0 if c is None else number.get(c, 63))
        return math.exp(-float(losses[code]))

    def loss(text):
        return -sum(math.log(p(g, symbol(g))) for g in grams(text))

    found = {r["doc_id"]: r for r in q._scored(docs, model, exact, "text", scratch).collect()}
    for k, text in enumerate([*texts, *others]):
        assert found[k]["_loss"] == pytest.approx(loss(text or ""), rel=1e-5, abs=1e-9)
        assert found[k]["_symbols"] == (len(text) + 1 if text else 0)
    every = [None, *map(chr, alphabet), *sorted(apart)]
    for context in [(None, None, None), ("а", "б", "а"), ("я", "я", "я"), (None, None, "в"), ("б", "в", chr(0x4E00)), tuple(FEW[-3:])]:
        assert sum(p((*context, c), symbol((*context, c))) for c in every) == pytest.approx(1, rel=1e-4)
    assert found[5]["_loss"] < found[6]["_loss"] - 1  # in an order that trusted texts have, and in one they lack


def test_quality_tells_other_scripts_apart(spark, table):
    good = [(k, FEW + "абвгдежз" * 30, "en") for k in range(200)]
    mixed = [(500, "зжедгвба" * 300, "en"), (501, "абвгдежз" * 300, "en")]
    trusted = spark.range(200).select(F.col("id").alias("doc_id"))
    found = {r["doc_id"]: r for r in q.quality(table([*good, *mixed]), trusted).collect()}
    assert found[500]["perplexity"] > 2 * found[501]["perplexity"]


def test_good_documents_tell_other_scripts_apart(spark, table):
    good = [(k, FEW + "абвгдежз" * 30, "en") for k in range(200)]
    trusted = spark.range(200).select(F.col("id").alias("doc_id"))
    docs = table([*good, (500, FEW + "зжедгвба" * 30, "en")])
    assert {r["doc_id"] for r in q.good_documents(docs, trusted).collect()} == set(range(200))
