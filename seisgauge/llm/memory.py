"""Memory of the Python workers, which Spark uses again for one task after the other.

What a task remembers to save time, such as the hashes of the words it met, is forgotten when it
ends, and memory that Arrow and the C library hold back goes to the system. So a worker is as large
as its largest task, not as all of its tasks, and small between them.
Tasks that encode words pass them on to the next of their step (``remembering``).
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator
from functools import wraps

import pyarrow as pa

_held: list[dict] = []
# Of the GNU C library, which else keeps what is freed below something that is still in use.
_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)

Run = Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def until_the_task_ends(held: dict) -> dict:
    """``held``, emptied when a task ends that runs a function made by ``forgetting``."""
    _held.append(held)
    return held


def _forget() -> None:
    # By itself, so that it is found by its name: what is inside ``forgetting`` travels to a worker
    # with copies of the globals it uses, and would empty those.
    for held in _held:
        held.clear()
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


def forgetting(run: Run) -> Run:
    """A function for ``mapInArrow`` after which the worker forgets."""

    @wraps(run)
    def whole(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            _forget()

    return whole


def remembering(run: Run) -> Run:
    """A function for ``mapInArrow`` whose tasks pass on what they remember, for words that are dear
    to encode. The next task of another step that runs a function made by ``forgetting`` forgets it."""
    return run
