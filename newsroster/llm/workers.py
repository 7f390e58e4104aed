"""What a Python worker keeps between batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc

from .pieces import slices

_slot: dict[object, object] = {}


def worker_state(key: object, build: Callable[[], object]):
    """The worker's state for ``key``, built on first use.

    A worker outlives a stage and then serves other operators; only the state that was used last
    is kept, so the memory of workers does not add up over the stages of a pipeline.
    """
    if key not in _slot:
        _slot.clear()
        _slot[key] = build()
    return _slot[key]


def in_slices(batches: Iterator, lengths: Callable[..., pa.Array],
              most: int = 500_000) -> Iterator[tuple[pa.Array, ...]]:
    """The columns of Arrow batches, a slice of rows at a time: at most ``most`` by ``lengths``
    (null: 0), or one row.

    A UDF that yields a result per slice never holds that of a whole batch, nor does the JVM, which
    takes results as they come.
    """
    for batch in batches:
        columns = batch if isinstance(batch, tuple) else (batch,)
        for begin, end in slices(pc.fill_null(lengths(*columns), 0).to_pylist(), most):
            yield tuple(column.slice(begin, end - begin) for column in columns)
