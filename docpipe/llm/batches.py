"""Cutting Arrow batches so that the texts in one piece have a bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc

CHARACTERS_AT_ONCE = 1 << 20


def text_parts(
    batch: pa.RecordBatch, column: str | int = "text", most: int = CHARACTERS_AT_ONCE
) -> Iterator[pa.RecordBatch]:
    """Runs of rows whose texts have at most ``most`` bytes together, one row at least."""
    sizes = pc.fill_null(pc.binary_length(batch[column]), 0).to_pylist()
    start = held = 0
    for i, size in enumerate(sizes):
        if i > start and held + size > most:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    if len(sizes) > start:
        yield batch.slice(start)
