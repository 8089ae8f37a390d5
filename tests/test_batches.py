"""Slices of Arrow batches: every row once, in order, none larger than it may be."""

import pyarrow as pa

from codexflow.operators import batches


def test_slices_are_bounded():
    sizes = [10, 900_000, 0, 3_000_000, 5, *([20_000] * 300)]
    given = pa.RecordBatch.from_arrays([pa.array(range(len(sizes))), pa.array(["x" * n for n in sizes])], names=["id", "text"])
    parts = list(batches.slices([given, given.slice(0, 0)]))
    assert [i for p in parts for i in p.column(0).to_pylist()] == list(range(len(sizes)))
    assert all(p.num_rows <= 1 or p.nbytes <= batches.SLICE_BYTES for p in parts) and 8 < len(parts) < 30
    assert parts[-1].num_rows == 0
