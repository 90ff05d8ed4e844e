"""Memory of Python workers. Imports nothing that executors may lack."""

from __future__ import annotations

import ctypes
import inspect
from collections.abc import Callable

import pyarrow as pa


def give_back() -> None:
    """Return freed memory to the system. A Python worker is used for the stages that follow too, and
    would keep what this one needed at its height."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def giving_back(run: Callable) -> Callable:
    """``run`` (a function of Arrow tables or of an iterator of batches) that gives memory back when it is done."""
    # Spark counts the arguments, so each number has a function of its own
    if inspect.isgeneratorfunction(run):

        def batches(iterator):
            yield from run(iterator)
            give_back()

        return batches

    if len(inspect.signature(run).parameters) == 1:

        def table(group):
            out = run(group)
            give_back()
            return out

        return table

    def tables(left, right):
        out = run(left, right)
        give_back()
        return out

    return tables
