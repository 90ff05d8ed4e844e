"""Whole groups out of a sorted stream of Arrow batches, without one Python call per group."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

from . import workers


def _bounds(table: pa.Table, keys: list[str]) -> np.ndarray:
    """Where a new group begins (the first row included)."""
    new = np.zeros(len(table), bool)
    new[:1] = True
    for k in keys:
        column = np.array(table[k])
        new[1:] |= column[1:] != column[:-1]
    return np.flatnonzero(new)


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str], handle: Callable[[pa.Table, np.ndarray], pa.Table | None]) -> Iterator[pa.RecordBatch]:
    """``handle(table, bounds)`` for tables of whole groups; the stream is sorted by the integer ``keys``.

    What is held is one batch and the group that runs over its end.
    """
    carry: list[pa.Table] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        part = pa.Table.from_batches([batch])
        starts = _bounds(part, keys)
        if carry and all(carry[-1][k][-1].as_py() == part[k][0].as_py() for k in keys):
            first_end = starts[1] if len(starts) > 1 else len(part)
        else:
            first_end = 0
        if first_end == len(part):
            carry.append(part)
            continue
        last = max(int(starts[-1]), first_end)
        ready = pa.concat_tables([*carry, part.slice(0, last)]).combine_chunks()
        carry = [part.slice(last)]
        if len(ready) and (out := handle(ready, _bounds(ready, keys))) is not None:
            yield from out.to_batches()
    if carry:
        ready = pa.concat_tables(carry).combine_chunks()
        if (out := handle(ready, _bounds(ready, keys))) is not None:
            yield from out.to_batches()
    workers.give_back()
