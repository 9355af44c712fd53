"""The words of many texts as one Arrow array, cut out of their buffer in a few numpy steps."""

import numpy as np
import pyarrow as pa

from sluiceway.llm.words import lower_ascii


def letters() -> np.ndarray:
    """Which bytes belong to a term: ASCII letters and all that is not ASCII."""
    member = np.zeros(256, bool)
    member[0x41:0x5B] = member[0x61:0x7B] = member[0x80:] = True
    return member


def terms_of(data: np.ndarray, offsets: np.ndarray, member: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """All longest runs of member bytes, A-Z lower-cased, as binary values in order, and where
    the terms of each text begin (one entry more than texts). No term spans two texts."""
    data = lower_ascii()[data]
    inside = member[data]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    bounds = offsets[1:-1]
    bounds = bounds[(bounds > 0) & (bounds < len(data))]
    begins[bounds] = inside[bounds]
    ends[bounds - 1] = inside[bounds - 1]
    start, stop = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    del inside, begins, ends
    # Starts and stops in turn are the offsets of an array whose even values are the terms.
    turns = np.empty(2 * len(start), np.int64)
    turns[0::2], turns[1::2] = start, stop
    pieces = pa.Array.from_buffers(
        pa.large_binary(), max(len(turns) - 1, 0), [None, pa.py_buffer(turns), pa.py_buffer(data)]
    )
    return pieces.take(pa.array(np.arange(0, len(turns), 2))), np.searchsorted(start, offsets)
