import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from tagloom.llm import words as w

TEXT = st.text(alphabet="ab AB\t\n\x0b\x0c\r\x85\u00a0é漢🙂", max_size=40)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), TEXT), max_size=8))
def test_words_are_those_between_spaces(texts):
    found = w.words_of(pa.array(texts, pa.string()))
    expected = [(t or "").encode().split() for t in texts]
    assert found.counts().tolist() == [len(x) for x in expected]
    flat = [x for words in expected for x in words]
    assert [found.data[a:b].tobytes() for a, b in zip(found.starts, found.ends)] == flat
    assert len(set(found.hashes.tolist())) == len(set(flat))


@settings(max_examples=50, deadline=None)
@given(st.lists(TEXT, max_size=5))
def test_hashes_do_not_depend_on_place_or_pieces(texts):
    together = w.words_of(pa.array(texts, pa.string()), fold_case=True)
    usual = w.PIECE_BYTES
    w.PIECE_BYTES = 3
    try:
        apart = [w.words_of(pa.array([t.lower() if t.isascii() else t]), fold_case=True) for t in texts]
    finally:
        w.PIECE_BYTES = usual
    assert together.hashes.tolist() == [h for x in apart for h in x.hashes.tolist()]


def test_runs_stay_within_texts():
    found = w.words_of(pa.array(["a b c", "b c", None, "a b"]))
    hashes, owners, first = w.runs(found.hashes, found.at, 2)
    assert owners.tolist() == [0, 0, 1, 3]
    assert hashes[0] == hashes[3] and hashes[1] == hashes[2] and hashes[0] != hashes[1]
    assert len(w.runs(found.hashes, found.at, 9)[0]) == 0


def test_slices_keep_all_rows_in_order():
    batch = pa.RecordBatch.from_pydict({"t": ["x" * 10, None, "y" * 100, "", "z"]})
    parts = list(w.slices(batch, "t", 20))
    assert np.concatenate([p.column("t").to_pylist() for p in parts]).tolist() == batch.column("t").to_pylist()
    assert len(parts) > 1
