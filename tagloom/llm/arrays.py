"""Arrays of one fixed size that all tasks fill and that are put together block by block."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

BLOCKS = 16


def gathered(
    df: DataFrame, fill: Callable[[Iterator[pa.RecordBatch]], np.ndarray], pick: np.ufunc = np.add
) -> np.ndarray | None:
    """The arrays that ``fill`` makes of each task's rows, combined by ``pick``.

    All must have the same shape, which bounds what comes to the driver; None without rows.
    """

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values = fill(batches)
        parts = np.array_split(values.ravel(), BLOCKS)
        yield pa.RecordBatch.from_pydict(
            {
                "block": pa.array(range(BLOCKS), pa.int32()),
                "data": pa.array([p.tobytes() for p in parts], pa.binary()),
                "kind": pa.array([values.dtype.str] * BLOCKS),
                "shape": pa.array([list(values.shape)] * BLOCKS, pa.list_(pa.int64())),
            }
        )

    def join(rows: pa.Table) -> pa.Table:
        kind, total = rows.column("kind")[0].as_py(), None
        for data in rows.column("data").to_pylist():
            part = np.frombuffer(data, dtype=kind)
            total = part if total is None else pick(total, part)
        first = rows.slice(0, 1)
        return first.set_column(1, "data", pa.array([total.tobytes()], pa.binary()))

    schema = "block int, data binary, kind string, shape array<long>"
    rows = df.mapInArrow(send, schema).groupBy("block").applyInArrow(join, schema).collect()
    if not rows:
        return None
    rows = sorted(rows, key=lambda r: r["block"])
    flat = np.concatenate([np.frombuffer(r["data"], dtype=r["kind"]) for r in rows])
    return flat.reshape(rows[0]["shape"])
