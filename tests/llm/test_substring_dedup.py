import hashlib
import random
from collections import Counter

from tagloom.llm.queries import passage_digest
from tagloom.llm.substring_dedup import removed_passages


def by_brute_force(rows, window):
    lists = [(r[1] or "").encode().split() for r in rows]
    seen = Counter(tuple(w[i : i + window]) for w in lists for i in range(len(w) - window + 1))
    out = []
    for row, words in zip(rows, lists, strict=True):
        gone = set()
        for i in range(len(words) - window + 1):
            if seen[tuple(words[i : i + window])] > 1:
                gone.update(range(i, i + window))
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((row[0], len(words), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def corpus(seed, window):
    rng = random.Random(seed)
    passages = [[f"p{k}w{j}" for j in range(window + k)] for k in (-1, 0, 1, 13)]
    rows = []
    for k in range(40):
        words = []
        for _ in range(rng.randint(0, 4)):
            words += [f"d{k}x{rng.random()}" for _ in range(rng.randint(0, 20))]
            words += rng.choice(passages)
        rows.append((k, " \n".join(words)))
    rows.append((40, "again " * (window + 1)))  # its windows overlap
    rows.append((41, "once " * window))
    rows.append((42, " ".join([f"b{j}" for j in range(window)] * 2)))
    return rows + rows[5:7]


def test_spans_equal_brute_force(table, rows):
    for window in (35, 9):
        data = corpus(window, window)
        found = removed_passages(table(data), window=window)
        assert rows(passage_digest(found)) == by_brute_force(data, window)


def test_awkward_rows(awkward, rows, table):
    data = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    found = removed_passages(awkward, with_text=True).cache()
    assert rows(passage_digest(found)) == by_brute_force(data, 35)
    for row in found.collect():
        assert hashlib.sha256(row["kept_text"].encode()).hexdigest() == row["kept_sha256"]
        assert all(a["end"] < b["begin"] for a, b in zip(row["spans"], row["spans"][1:], strict=False))
    assert removed_passages(table([])).count() == 0
