"""Memory of Python workers: what a task has freed goes back to the system.

Workers outlive their tasks, and several wait in an executor beside the ones at work. The allocators keep
freed pages for themselves, so without this an executor pays for the largest task that each worker ever ran.
"""

from __future__ import annotations

import ctypes

import pyarrow as pa


def give_back() -> None:
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
    if trim is not None:
        trim(0)


def tidy_batches(run):
    """A function for ``mapInArrow`` that gives memory back when its task ends, however it ends."""

    def tidy(batches):
        try:
            yield from run(batches)
        finally:
            give_back()

    return tidy


def tidy_group(run):
    """A function for ``applyInArrow`` that gives memory back after each group."""

    def tidy(*tables):
        try:
            return run(*tables)
        finally:
            give_back()

    def tidy_one(table):
        return tidy(table)

    def tidy_two(left, right):
        return tidy(left, right)

    import inspect

    return tidy_two if len(inspect.signature(run).parameters) == 2 else tidy_one
