"""Numpy helpers that tasks apply to Arrow batches."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

# BLAS may add the products of equal pairs in different orders; scores this close are compared
# again with sums in a fixed order, so results do not depend on batches or partitions.
SCORE_MARGIN = 1e-9
BLOCK_CELLS = 2_000_000
#: Half a unit in the last place of single precision, and values that it leaves room for.
SINGLE_ROUNDING = 2.0**-24
SINGLE_MOST = 1e15


def with_vectors(rows: pa.Table) -> pa.Table:
    """Rows that have a vector. Checked in the task and not as a filter of the plan, which would be pushed
    below the function that makes the vectors and run it twice."""
    return rows.filter(rows["embedding"].is_valid()) if rows["embedding"].null_count else rows


def to_matrix(lists: pa.Array) -> np.ndarray:
    """Rows of a list column as a float64 matrix."""
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    if len(lists) == 0:
        return np.zeros((0, 0))
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if flat.size % len(lists) or lists.null_count:
        raise ValueError("vectors must be present and of one length")
    return flat.reshape(len(lists), -1)


def to_lists(matrix: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    n, d = matrix.shape
    offsets = pa.array(np.arange(0, n * d + 1, d, dtype=np.int32) if d else np.zeros(n + 1, dtype=np.int32))
    return pa.ListArray.from_arrays(offsets, pa.array(matrix.ravel(), type=kind))


def to_keys(column: pa.Array) -> np.ndarray:
    """Identifiers as a sortable array: integers, or strings."""
    keys = column.to_numpy(zero_copy_only=False)
    return keys.astype(str) if keys.dtype == object else keys


def ordered_dots(left: np.ndarray, right: np.ndarray, rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
    """Inner products of the pairs ``left[rows] . right[cols]``, summed from the first element on."""
    total = np.zeros(len(rows))
    if not left.shape[1]:
        return total
    # Few enough pairs at a time that their products stay in the cache; accumulate adds in order, one by one.
    step = max(1, 131_072 // left.shape[1])
    for start in range(0, len(rows), step):
        part = slice(start, start + step)
        total[part] += np.add.accumulate(left[rows[part]] * right[cols[part]], axis=1)[:, -1]
    return total


def single(matrix: np.ndarray) -> np.ndarray | None:
    """The matrix in single precision; none if that has no room for its values."""
    fits = not matrix.size or max(matrix.max(), -matrix.min()) < SINGLE_MOST
    return matrix.astype(np.float32) if fits else None


def for_products(left: np.ndarray, right: np.ndarray, right_single: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Both matrices for ``left @ right.T`` in single precision, and how far off a row's products may be.

    A sum of ``n`` products of rounded numbers is off by at most ``n + 2`` roundings of the sum of their magnitudes, in any
    order, and that is at most the product of the norms. Who decides by such products must look again at what lies within
    the margin of a decision. Values that single precision has no room for stay in double precision.
    """
    a, b = single(left), single(right) if right_single is None else right_single
    if a is None or b is None or left.shape[1] != right.shape[1]:
        return left, right, np.full(len(left), SCORE_MARGIN)
    norms, others = (np.sqrt(np.einsum("ij,ij->i", x, x)) for x in (left, right))
    return a, b, SCORE_MARGIN + SINGLE_ROUNDING * (left.shape[1] + 8) * norms * others.max(initial=0.0)


def just_below(limits: np.ndarray, like: np.ndarray) -> np.ndarray:
    """Limits in the precision of ``like``, rounded down."""
    return np.nextafter(limits.astype(like.dtype), like.dtype.type(-np.inf))


def first_equal_rows(matrix: np.ndarray) -> np.ndarray:
    """Positions of the first of every set of equal rows, in no order."""
    rows = np.ascontiguousarray(matrix) + 0.0
    return np.unique(rows.view(np.dtype((np.void, rows.dtype.itemsize * rows.shape[1]))).ravel(), return_index=True)[1] if rows.size else np.arange(min(1, len(rows)))


def row_blocks(n: int, width: int):
    """Slices of ``n`` rows so that a block of ``width`` columns stays small."""
    step = max(1, BLOCK_CELLS // max(1, width))
    for start in range(0, n, step):
        yield slice(start, min(n, start + step))


def first_in_order(group: np.ndarray, *keys: np.ndarray, n: int = 1) -> np.ndarray:
    """Positions of the first ``n`` rows of each group, ordered by ``keys``."""
    order = np.lexsort((*reversed(keys), group))
    grouped = group[order]
    starts = np.flatnonzero(np.r_[True, grouped[1:] != grouped[:-1]]) if len(grouped) else np.zeros(0, dtype=int)
    place = np.arange(len(grouped)) - np.repeat(starts, np.diff(np.r_[starts, len(grouped)]))
    return order[place < n]
