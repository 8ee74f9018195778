"""Tries against a row-by-row construction, and the brackets they are read from."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from tagloom.llm import parentheses
from tagloom.llm.conversation_trie import Borrowing, prefix_trie
from tagloom.llm.parentheses import Parentheses, RangeMinimum

SCHEMA = "conv_id long, turn int, role string, text string"


def by_brute_force(rows, borrowing=True):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            tie = hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()
            own[conv].append((turn is not None, turn or 0, tie, role, text))
    own = {c: [(r, x) for *_, r, x in sorted(v)] for c, v in own.items()}
    built = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 9 if borrowing else 0
        base = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        built[c] = own.get(base, [])[:h] + v[h:]
    members, children = defaultdict(list), defaultdict(list)
    for c, v in built.items():
        for d in range(len(v) + 1):
            members[tuple(v[:d])].append(c)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[k] for k in children[p]) or 1
        size = len(p[-1][1].encode()) if p else 0
        saved[p] = (len(members[p]) - 1) * size + sum(saved[k] for k in children[p])
    return sorted(
        (
            (min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children[p]), leaves[p], saved[p],
             hashlib.sha256(",".join(str(c) for c in sorted(m) if len(built[c]) == len(p)).encode()).hexdigest())
            for p, m in members.items()
        ),
        key=repr,
    )


def made_up(seed, convs=range(-7, 40)):
    rng, rows = random.Random(seed), []
    for c in convs:
        for t in range(rng.choice([0, 1, 2, 3, 8, 12, 20])):
            text = rng.choice(["a", "é", ""]) if rng.random() < 0.15 else "same"
            rows.append((c, None if rng.random() < 0.05 else t, "user" if rng.random() < 0.9 else "assistant", text))
    rng.shuffle(rows)
    return rows


def nodes(spark, rows, borrowing=Borrowing(5, 9), **sizes):
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' as n", "1 as band", "2 as depth", "3 as root1")
    return sorted((tuple(r) for r in prefix_trie(df, borrowing, **sizes).collect()), key=repr)


# Shards of one turn, of some, and of all; conversations of one and of many bands.
@pytest.mark.parametrize("sizes", [{}, {"band": 4, "shard": 1}, {"band": 3, "shard": 17}, {"band": 1000, "shard": 6}])
def test_nodes(spark, sizes):
    rows = made_up(len(sizes) + sizes.get("band", 0))
    assert nodes(spark, rows, **sizes) == by_brute_force(rows)


def test_without_borrowing(spark):
    rows = made_up(9)
    assert nodes(spark, rows, None, band=4, shard=9) == by_brute_force(rows, borrowing=False)


def test_one_conversation_holds_a_third_of_all_turns_and_copies_another(spark):
    rows = [(100, t, "user", f"turn {t}") for t in range(600)]
    rows += [(c, t, "user", f"turn {t}") for c in range(101, 161) for t in range(10)]
    rows += [(200, t, "user", f"turn {t}" if t < 500 else "other") for t in range(600)]
    assert nodes(spark, rows, band=64, shard=100) == by_brute_force(rows)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert nodes(spark, rows, band=64, shard=100) == by_brute_force(rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_awkward_rows(spark):
    rows = [
        (1, 0, None, None), (1, 0, None, None), (1, None, "", ""), (None, 0, "user", "x"), (6, 0, "", "漢字" * 50_000),
        (6, 0, "", "漢字" * 50_000), (7, 5, "a", "b:c"), (8, 5, "a:b", "c"), (9, 3, "ab", ":c"),
    ]
    assert nodes(spark, rows) == by_brute_force(rows)
    assert nodes(spark, [(None, 0, "user", "x")]) == []
    assert nodes(spark, []) == []
    assert nodes(spark, [(1, 0, "user", "x")] * 5000) == by_brute_force([(1, 0, "user", "x")] * 5000)


@pytest.mark.parametrize("block", [2, 4, 256])
def test_brackets(monkeypatch, block):
    monkeypatch.setattr(parentheses, "BLOCK", block)
    for seed in range(60):
        rng, bits, depth = random.Random(seed), [], 0
        left = n = rng.randint(1, 700 if seed < 3 else 60)
        while left or depth:
            opens = bool(left) and (depth == 0 or rng.random() < rng.choice([0.5, 0.9]))
            bits.append(opens)
            left, depth = left - opens, depth + (1 if opens else -1)
        open_at, close, parent = [], {}, {}
        for i, opens in enumerate(bits):
            if opens:
                parent[i] = open_at[-1] if open_at else None
                open_at.append(i)
            else:
                close[open_at.pop()] = i
        places = [i for i, opens in enumerate(bits) if opens]
        number = {i: k for k, i in enumerate(places)} | {None: -1}
        trie = Parentheses(np.array(bits))
        ends, leaves = trie.subtree_ends()
        assert trie.find_close(np.arange(n)).tolist() == [close[i] for i in places]
        assert ends.tolist() == [sum(bits[: close[i]]) for i in places]
        assert leaves.tolist() == [sum(bits[j] and not bits[j + 1] for j in range(i, close[i])) for i in places]
        assert trie.parents().tolist() == [number[parent[i]] for i in places]


def test_range_minimum():
    rng = np.random.default_rng(0)
    values = rng.integers(0, 99, 77)
    begin = rng.integers(0, 77, 300)
    end = begin + 1 + rng.integers(0, 77, 300) % (77 - begin)
    assert RangeMinimum(values).of(begin, end).tolist() == [values[a:b].min() for a, b in zip(begin, end)]
