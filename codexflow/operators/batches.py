"""Arrow batches in slices of bounded size, so that what Python makes of them doesn't grow with the batch."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa

#: Bytes of a slice, unless a single row has more.
SLICE_BYTES = 1 << 20


def slices(batches: Iterable[pa.RecordBatch], limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in order, in slices of about ``limit`` bytes each; an empty batch is one slice."""
    for batch in batches:
        waiting = [batch]
        while waiting:
            part = waiting.pop()
            if part.num_rows <= 1 or part.nbytes <= limit:
                yield part
            else:
                half = part.num_rows // 2
                waiting += [part.slice(half), part.slice(0, half)]
