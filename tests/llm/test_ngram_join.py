import random

import pytest

from tagloom.llm import ngram_join as nj
from tagloom.llm.ngram_join import one_of_each, similar_documents


def shingles(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def by_brute_force(rows):
    """Sizes, and the least id reachable, of each row."""
    sets = [shingles(r[1]) for r in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                root[find(i)] = find(j)
    out = []
    for i, r in enumerate(rows):
        ids = [x[0] for j, x in enumerate(rows) if find(j) == find(i) and x[0] is not None]
        out.append((r[0], len(sets[i]), min(ids) if ids else None))
    return sorted(out, key=repr)


def corpus(seed):
    """Families of near copies around the threshold, and a passage that many share."""
    rng = random.Random(seed)
    passage = [f"p{k}" for k in range(40)]
    rows = []
    for family in range(8):
        base = [f"f{family}w{k}" for k in range(rng.randint(6, 90))]
        for _ in range(rng.randint(1, 9)):
            text = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 25))):
                text[rng.randrange(len(text))] = f"x{rng.random()}"
            if rng.random() < 0.3:
                text += [f"t{rng.random()}" for _ in range(rng.randint(1, 12))]
            if rng.random() < 0.4:
                text = passage + text
            rows.append((len(rows) * 7 % 211, " ".join(text)))
    rows += [(300 + k, " ".join(passage + [f"y{k}{j}" for j in range(k % 12)])) for k in range(25)]
    return rows + [rows[3], rows[5]]


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_brute_force(table, rows, seed):
    data = corpus(seed)
    assert rows(similar_documents(table(data))) == by_brute_force(data)


def test_awkward_rows(awkward, rows, table):
    data = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    assert rows(similar_documents(awkward)) == by_brute_force(data)
    assert similar_documents(table([])).count() == 0


def test_one_of_each_stays(awkward):
    kept = one_of_each(awkward)
    assert kept.columns == awkward.columns
    found = [r["doc_id"] for r in kept.collect()]
    assert sorted(x for x in found if x is not None) == [1, 3, 4, 5, 6, 7, 9]
    assert found.count(None) == 2  # without an id there is no telling which stays


def test_bounds_never_fall_short():
    import numpy as np

    rng = np.random.default_rng(0)
    for n, m in ((5, 6), (100, 90), (300, 2000)):
        a = rng.integers(0, 2**63, n).astype(np.uint64) * np.uint64(2)
        b = np.concatenate([a[: min(n, m) // 2], rng.integers(0, 2**63, m).astype(np.uint64)])
        common = len(set(a.tolist()) & set(b.tolist()))
        assert common <= nj.shared_at_most(len(a), nj.bitmap(a), nj.bitmap(b)) <= len(a)
        union = nj.union_bitmap([nj.bitmap(a), nj.bitmap(b)])
        assert nj.shared_at_most(len(a), nj.bitmap(a), union) == len(a)


def test_counts_of_pairs():
    import numpy as np

    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 12, k).astype(np.uint64)) for k in (0, 3, 9, 30, 30, 5)]
    others = [np.unique(rng.integers(0, 12, k).astype(np.uint64)) for k in (9, 30, 0, 30, 5)]
    found = {tuple(p) for p in nj.similar_pairs(sets, others).tolist()}
    expected = {
        (i, j)
        for i, a in enumerate(sets)
        for j, b in enumerate(others)
        if 100 * len(np.intersect1d(a, b)) >= 80 * len(np.union1d(a, b))
    }
    assert found == expected
    assert nj.similar_pairs([], sets).tolist() == []


def near_misses(seed, n, own):
    """Texts that share 60 words and have ``own`` of their own: just below the threshold."""
    rng = random.Random(seed)
    base = [f"b{k}" for k in range(60)]
    return [(i, " ".join(base + [f"o{rng.random()}" for _ in range(own)])) for i in range(n)]


def test_a_family_below_the_threshold_makes_few_rows(table, rows, monkeypatch):
    """None of 3,000 is linked with another; rows of the joins grow with the texts, not with their pairs."""
    data = near_misses(1, 3000, 9) + [(5000, "w " * 9 + "x y z"), (5001, "w " * 9 + "x y z")]
    made = {}
    keep = nj.Scratch.keep

    def counted(self, df, *by):
        kept = keep(self, df, *by)
        made[self.n] = kept.count()
        return kept

    monkeypatch.setattr(nj.Scratch, "keep", counted)
    found = rows(similar_documents(table(data)))
    assert found == sorted([*((i, 65, i) for i in range(3000)), (5000, 4, 5000), (5001, 4, 5000)], key=repr)
    assert max(made.values()) <= 25 * len(data)


@pytest.mark.parametrize("seed", [3, 4])
def test_families_around_the_threshold(table, rows, monkeypatch, seed):
    """Many parts of a few, so that links go within parts and between them."""
    monkeypatch.setattr(nj, "PART", 4)
    rng = random.Random(seed)
    data = [(i, t) for i, (_, t) in enumerate(near_misses(seed, 40, 9) + near_misses(seed, 40, 6) + near_misses(seed, 20, 7))]
    rng.shuffle(data)
    assert rows(similar_documents(table(data))) == by_brute_force(data)
