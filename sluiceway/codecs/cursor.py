"""Reading many byte strings side by side, with an error state for each of them."""

import re
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

VARINT_MAX_BYTES = 10
TRUNCATED = "truncated payload"

# Fixed value: a UTF-8 encoded surrogate, perhaps cut short, which the JVM takes for one
# malformed sequence.
_SURROGATE = re.compile(rb"\xed[\xa0-\xbf][\x80-\xbf]?")


class Cursor:
    """A position in each of many byte strings of one buffer.

    A string that can't be read further fails: it has a reason from then on, keeps its
    position, and takes no part in later steps, whose results for it mean nothing. So a bad
    message costs no more than a good one and never stops the others.
    """

    def __init__(self, data: np.ndarray, start: np.ndarray, stop: np.ndarray):
        self.data, self.at, self.stop = data, start.copy(), stop
        self.reason: np.ndarray | None = None
        #: The strings still read: all of them, or their places.
        self.live: slice | np.ndarray = slice(None)

    @classmethod
    def over(cls, payloads: pa.Array) -> "Cursor":
        wide = payloads.cast(pa.large_binary())
        _, offsets, data = wide.buffers()
        bounds = np.frombuffer(offsets, np.int64, len(wide) + 1, 8 * wide.offset)
        content = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
        return cls(content, bounds[:-1], bounds[1:])

    def __len__(self) -> int:
        return len(self.at)

    @property
    def alive(self) -> np.ndarray:
        return np.ones(len(self), bool) if self.reason is None else self.reason == None  # noqa: E711

    def places(self) -> np.ndarray:
        """The places of the strings still read."""
        return np.arange(len(self)) if isinstance(self.live, slice) else self.live

    def fail(self, places: np.ndarray, reason) -> None:
        """Give up on some strings, for one reason or one each."""
        if len(places):
            if self.reason is None:
                self.reason = np.full(len(self), None, object)
            self.reason[places] = reason
            self.live = np.flatnonzero(self.alive)

    def subset(self, places: np.ndarray) -> "Cursor":
        return Cursor(self.data, self.at[places], self.stop[places])

    def absorb(self, places: np.ndarray, part: "Cursor") -> None:
        """Go on where a subset has come to."""
        self.at[places] = part.at
        if part.reason is not None:
            failed = np.flatnonzero(~part.alive)
            self.fail(places[failed], part.reason[failed])

    def _drop(self, reading, bad: np.ndarray, reason: str) -> np.ndarray:
        places = np.arange(len(self))[reading]
        self.fail(places[bad], reason)
        return places[~bad]

    def varint(self) -> np.ndarray:
        """The next varint of every string."""
        value = np.zeros(len(self), np.int64)
        reading = self.live
        for group in range(VARINT_MAX_BYTES):
            at = self.at[reading]
            short = at >= self.stop[reading]
            if short.any():
                reading = self._drop(reading, short, TRUNCATED)
                at = self.at[reading]
            byte = self.data[at]
            value[reading] |= (byte & 0x7F).astype(np.int64) << (7 * group)
            self.at[reading] = at + 1
            more = np.flatnonzero(byte >= 0x80)
            reading = more if isinstance(reading, slice) else reading[more]
            if not len(reading):
                return value
        self.fail(reading, "a varint is longer than ten bytes")
        return value

    def long(self) -> np.ndarray:
        """The next zig-zag varint of every string."""
        return unzigzag(self.varint())

    def take(self, size: np.ndarray | int) -> tuple[np.ndarray, np.ndarray]:
        """Pass over so many bytes; where they begin and end."""
        size = np.broadcast_to(np.asarray(size, np.int64), len(self))
        over = (size[self.live] < 0) | (size[self.live] > self.stop[self.live] - self.at[self.live])
        if over.any():
            self._drop(self.live, over, TRUNCATED)
        begin = self.at.copy()
        self.at[self.live] += size[self.live]
        return begin, self.at.copy()

    def fixed(self, kind: str) -> np.ndarray:
        """The next value of a numpy type of fixed width, little-endian."""
        kind = np.dtype(kind).newbyteorder("<")
        begin, end = self.take(kind.itemsize)
        return fixed_at(self.data, begin, end, kind)


def unzigzag(value: np.ndarray) -> np.ndarray:
    plain = value.view(np.uint64)
    return (plain >> np.uint64(1)).view(np.int64) ^ -(value & 1)


def fixed_at(data: np.ndarray, begin: np.ndarray, end: np.ndarray, kind: np.dtype) -> np.ndarray:
    """Values at some places; 0 where nothing was taken."""
    out = np.zeros((len(begin), kind.itemsize), np.uint8)
    taken = np.flatnonzero(end > begin)
    out[taken] = data[begin[taken, None] + np.arange(kind.itemsize)]
    return out.reshape(-1).view(kind)


def cut(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> pa.Array:
    """The bytes ``data[begin:end]``, one value per string.

    Begins and ends of successive strings never decrease, so they form the offsets of an
    array whose even entries are the slices and whose odd entries are the gaps.
    """
    offsets = np.empty(2 * len(begin), np.int64)
    offsets[0::2], offsets[1::2] = begin, end
    pieces = pa.Array.from_buffers(
        pa.large_binary(), max(len(offsets) - 1, 0), [None, pa.py_buffer(offsets), pa.py_buffer(data)]
    )
    return pieces.take(pa.array(np.arange(0, len(offsets), 2))).cast(pa.binary())


def text_of(content: pa.Array) -> pa.Array:
    """Bytes as text. Malformed UTF-8 becomes U+FFFD, one per malformed sequence as in the JVM."""
    try:
        return content.cast(pa.string())
    except pa.ArrowInvalid:
        texts = (None if b is None else _SURROGATE.sub(b"\xff", b) for b in content.to_pylist())
        return pa.array([None if b is None else b.decode("utf-8", "replace") for b in texts], pa.string())


def placed(values: pa.Array, places: np.ndarray, count: int) -> pa.Array:
    """An array of ``count`` with the values at some places, in their order, and NULL elsewhere."""
    if len(places) == count:
        return values
    index = np.zeros(count, np.int64)
    absent = np.ones(count, bool)
    index[places], absent[places] = np.arange(len(places)), False
    return values.take(pa.array(index, mask=absent))


def listed(owners: list[np.ndarray], values: list[pa.Array], empty: pa.Array, count: int):
    """Offsets and values of lists, from values with the list that each belongs to, in order."""
    owner = np.concatenate(owners) if owners else np.zeros(0, np.int64)
    flat = pa.concat_arrays([empty, *values])
    if len(owners) > 1 or (np.diff(owner) < 0).any():
        flat = flat.take(pa.array(np.argsort(owner, kind="stable")))
    sizes = np.bincount(owner, minlength=count)
    return np.concatenate(([0], np.cumsum(sizes))).astype(np.int32), flat
