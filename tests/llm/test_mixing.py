import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tagloom.llm.mixing import Mix, apportioned, mixed, mixed_documents, targets


def highest_quotients(weights, seats):
    given = [0] * len(weights)
    for _ in range(seats):
        i = max(range(len(weights)), key=lambda k: (weights[k] / (2 * given[k] + 1), -k))
        given[i] += 1
    return given


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 50), min_size=1, max_size=7), st.integers(0, 60))
def test_apportionment_is_by_highest_quotients(weights, seats):
    if sum(weights):
        got = apportioned(np.array(weights), seats).tolist()
        expected = highest_quotients(weights, seats)
        assert sum(got) == seats
        # Equal quotients may go to either.
        assert sorted(w / (2 * g + 1) for w, g in zip(weights, got)) == pytest.approx(
            sorted(w / (2 * g + 1) for w, g in zip(weights, expected)))
    else:
        assert apportioned(np.array(weights), seats).sum() == 0


def test_targets_share_what_is_cut_off():
    found = targets([100, 100, 400])  # weights 3, 1, 2 of 900
    assert found == pytest.approx([200, 200, 500])
    assert targets([]) == [] and targets([0, 0]) == [0, 0]
    assert targets([10, 0, 10]) == pytest.approx([18, 0, 12])


def test_sources_come_near_their_targets(table):
    docs = table([(k, "w " * (k % 13), "en", None if k % 10 == 0 else f"s{k % 4}", 0) for k in range(800)])
    found = mixed(docs, mix=Mix(shard_words=300)).collect()
    assert len(found) == 800
    by_target = {}
    for r in found:
        assert 0 <= r["taken"] <= 2 * r["size"]
        assert r["target"] <= 2 * r["source_size"]
        by_target.setdefault((r["target"], r["source_size"]), []).append(r["taken"])
    assert sum(t for t, _ in by_target) == pytest.approx(1.5 * sum(r["size"] for r in found))
    for (target, _), taken in by_target.items():
        assert abs(sum(taken) - target) <= 0.01 * target + 5
    again = mixed(docs.repartition(5), mix=Mix(shard_words=300)).collect()
    assert sorted(map(tuple, found)) == sorted(map(tuple, again))


def test_documents_of_the_mix(awkward):
    taken = {}
    for r in mixed(awkward).collect():
        taken[r["doc_id"]] = taken.get(r["doc_id"], 0) + r["taken"]
    out = mixed_documents(awkward)
    assert out.columns == awkward.columns
    words = {}
    texts = {r["doc_id"]: r["text"] for r in awkward.collect()}
    for r in out.collect():
        words[r["doc_id"]] = words.get(r["doc_id"], 0) + len(r["text"].encode().split())
        assert r["text"] and (r["doc_id"] is None or texts[r["doc_id"]].startswith(r["text"]))
    assert words == {k: v for k, v in taken.items() if v}


def test_empty_and_wordless(table):
    assert mixed(table([])).count() == 0
    assert [tuple(r)[1:] for r in mixed(table([(1, None), (2, " ")])).collect()] == [(0, 0, 0.0, 0)] * 2


@pytest.mark.parametrize("blocks, n, shard_words", [(1 << 16, 1, 1 << 20), (64, 100, 1 << 20), (64, 100, 100)])
def test_a_small_source_beside_a_large_one(table, blocks, n, shard_words):
    # "a" has 5 or 1,000 words, "b" a million; with weights 3 and 1 all of "a" is wanted twice.
    docs = [(k, "w " * (5 if n == 1 else 10), "en", "a", 0) for k in range(n)]
    docs += [(1000 + k, "w " * 10_000, "en", "b", 0) for k in range(100)]
    found = mixed(table(docs), mix=Mix(blocks=blocks, shard_words=shard_words)).collect()
    for small in (True, False):
        rows = [r for r in found if (r["doc_id"] < 1000) == small]
        target, taken = rows[0]["target"], sum(r["taken"] for r in rows)
        assert abs(taken - target) <= target / 64
