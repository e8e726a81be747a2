"""Memory that Python workers have freed goes back to the system, so that idle ones hold little."""

import ctypes
import functools

import pyarrow as pa


@functools.lru_cache(maxsize=1)
def _trim():
    try:
        return ctypes.CDLL(None).malloc_trim
    except (OSError, AttributeError):  # no glibc
        return lambda _: 0


def release() -> None:
    pa.default_memory_pool().release_unused()
    _trim()(0)


def releasing(function):
    """A function of a group, or of two, that gives memory back after each."""

    def run(*groups):
        out = function(*groups)
        release()
        return out

    if function.__code__.co_argcount == 3:
        return lambda key, left, right: run(key, left, right)
    return lambda key, table: run(key, table)
