"""Arrow batches of texts in pieces of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that a task works on at once; a longer text is a piece of its own.
PIECE_BYTES = 8 << 20


def pieces(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in order, cut so that the texts of a piece have ``limit`` bytes, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, ends = text_bytes(batch.column(text))
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All UTF-8 bytes of a string column, one text after another, and where each text ends; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if not pa.types.is_binary(column.type) and not pa.types.is_large_binary(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(column), np.int64)
    ends = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    flat = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data is not None else np.zeros(0, np.uint8)
    return flat, ends[1:] - ends[0]


def starts_of(ends: np.ndarray) -> np.ndarray:
    return np.concatenate([np.zeros(1, np.int64), ends[:-1]]) if len(ends) else ends


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """``starts[0], starts[0] + 1, ...`` for ``lengths[0]`` numbers, then the same for the next range."""
    total = int(lengths.sum())
    before = np.cumsum(lengths) - lengths
    return np.arange(total, dtype=np.int64) + np.repeat(starts - before, lengths)
