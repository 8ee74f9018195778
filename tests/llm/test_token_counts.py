"""Counts against the library that the vocabulary is for."""

import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tagloom.llm import token_counts as module
from tagloom.llm.token_counts import Counter, load_vocabulary, merged_count_of_long, merged_counts, token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def vocabulary():
    return load_vocabulary(PATH)


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda text: len(tokenizer.encode(text or "", add_special_tokens=False).ids)


PARTS = ["a", "aa", "the", " ", "  ", "\n", "\t", "'s", "'LL", "1", "23", "é", "漢", "🙂", ".", "!!", " ", " ", "\x1c",
         "\x85", "<|endoftext|>", "<|endof", "࢏", "\U0001d6a6", "ß", "é", "\x00"]


def test_random_texts(vocabulary, library):
    rng = random.Random(3)
    texts = ["".join(rng.choices(PARTS, k=rng.randint(0, 40))) for _ in range(1500)]
    assert Counter(vocabulary).tokens(texts).tolist() == [library(t) for t in texts]


def test_every_character(vocabulary, library):
    """Its kind decides where a text is split, so each stands beside a letter, a number and others."""
    texts = []
    for low in range(0, 0x110000, 64):
        some = [chr(c) for c in range(low, low + 64) if not 0xD800 <= c < 0xE000]
        if low < 0x3400 or low % 512 == 0 or 0xA000 <= low < 0x20000:
            texts.append("".join(f"a{c}b1{c}2.{c}, {c} {c}{c}x" for c in some))
    assert Counter(vocabulary).tokens(texts).tolist() == [library(t) for t in texts]


def test_long_pre_tokens(vocabulary, library):
    rng = random.Random(4)
    pieces = ["a" * 1001, "ab" * 800, *("".join(rng.choices("abcdeth", k=rng.randint(1, 400))) for _ in range(100))]
    expected = [library(p) for p in pieces]
    assert merged_counts(vocabulary, [p.encode() for p in pieces]).tolist() == expected
    assert [merged_count_of_long(vocabulary, p.encode()) for p in pieces] == expected


def test_texts_cut_into_parts_and_a_full_memory(vocabulary, library, monkeypatch):
    rng = random.Random(5)
    texts = ["".join(rng.choices([*PARTS, " word", " other"], k=400)) for _ in range(30)]
    monkeypatch.setattr(module, "PIECE_CHARS", 17)
    monkeypatch.setattr(module, "KNOWN", 8)
    assert Counter(vocabulary).tokens(texts).tolist() == [library(t) for t in texts]


def test_awkward_rows(spark, awkward, vocabulary, library):
    rows = token_counts(awkward, vocabulary, limit=2).collect()
    texts = awkward.select("doc_id", "text").collect()
    size = lambda t: len((t or "").encode())
    expected = [(d, size(t), library(t), library(t) > 2) for d, t in texts]
    assert sorted(map(repr, map(tuple, rows))) == sorted(map(repr, expected))
    assert token_counts(awkward.limit(0), vocabulary).count() == 0
    one = spark.createDataFrame([(1, "x" * 3_000_000 + " " + "ab cd " * 500_000)], "doc_id long, text string")
    assert token_counts(one, vocabulary).first()["n_tokens"] == library(one.first()["text"])


def test_given_documents(spark, sf_dir, vocabulary, library):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = {r["doc_id"]: (r["n_tokens"], r["over_limit"]) for r in token_counts(docs, vocabulary).collect()}
    for r in docs.collect():
        n = library(r["text"])
        assert found[r["doc_id"]] == (n, n > 1024)


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError, match="byte-level"):
        load_vocabulary(public_tokenizers.path("word_bpe_49k.json"))
