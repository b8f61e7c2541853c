"""Groups of rows out of the Arrow batches of a partition that is sorted by the group's key."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[dict[str, np.ndarray]]:
    """The columns of each run of rows whose first `keys` columns agree, as NumPy arrays.

    Holds one batch and one group at a time. Key columns are integers without nulls.
    """
    open_: list[dict[str, np.ndarray]] = []
    last: tuple | None = None

    def done() -> dict[str, np.ndarray]:
        return {n: np.concatenate([p[n] for p in open_]) for n in open_[0]}

    for b in batches:
        if not b.num_rows:
            continue
        cols = {n: b.column(i).to_numpy(zero_copy_only=False) for i, n in enumerate(b.schema.names)}
        names = b.schema.names[:keys]
        change = np.zeros(b.num_rows - 1, bool)
        for n in names:
            change |= cols[n][1:] != cols[n][:-1]
        cuts = [0, *(np.flatnonzero(change) + 1).tolist(), b.num_rows]
        for begin, end in zip(cuts, cuts[1:]):
            key = tuple(cols[n][begin] for n in names)
            if open_ and key != last:
                yield done()
                open_ = []
            last = key
            open_.append({n: v[begin:end] for n, v in cols.items()})
    if open_:
        yield done()
