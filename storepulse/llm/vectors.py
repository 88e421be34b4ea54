"""Columns of vectors as matrices, for tasks that take Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def whole_rows(column: pa.Array, sizes: list[int] | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions and values (as doubles) of the vectors of each length.

    Vectors that are null or hold a null or non-finite entry are left out, empty ones too;
    with `sizes`, vectors of other lengths as well."""
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    for size in np.unique(lengths):
        if size == 0 or (sizes is not None and size not in sizes):
            continue
        at = np.flatnonzero(lengths == size)
        flat = pc.list_flatten(column.take(pa.array(at))).cast(pa.float64())
        rows = flat.to_numpy(zero_copy_only=False).reshape(len(at), size)  # null becomes NaN
        whole = np.isfinite(rows).all(axis=1)
        if whole.any():
            yield at[whole], rows[whole]
