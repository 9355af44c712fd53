"""Byte strings of many records, put together field by field."""

import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass
class Pieces:
    """One byte string per record: ``data[offsets[i]:offsets[i + 1]]``."""

    data: np.ndarray
    offsets: np.ndarray

    @property
    def sizes(self) -> np.ndarray:
        return np.diff(self.offsets)

    def at(self, places: np.ndarray, count: int) -> "Pieces":
        """The same strings as those of some of ``count`` records; the others are empty."""
        sizes = np.zeros(count, np.int64)
        sizes[places] = self.sizes
        return Pieces(self.data, _offsets(sizes))

    def joined(self, offsets: np.ndarray) -> "Pieces":
        """Strings that follow one another as one, by the offsets of lists."""
        return Pieces(self.data, self.offsets[offsets])

    def binary(self) -> pa.Array:
        buffers = [None, pa.py_buffer(self.offsets), pa.py_buffer(self.data)]
        array = pa.Array.from_buffers(pa.large_binary(), len(self.offsets) - 1, buffers)
        return array.cast(pa.binary())


def _offsets(sizes: np.ndarray) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))


def varints(values: np.ndarray) -> Pieces:
    """Each number as a varint; negative ones as 64 bits."""
    values = values.astype(np.int64).view(np.uint64)
    sizes = np.ones(len(values), np.int64)
    for group in range(1, 10):
        sizes += values >> np.uint64(7 * group) != 0
    offsets = _offsets(sizes)
    data = np.zeros(offsets[-1], np.uint8)
    for group in range(int(sizes.max(initial=0))):
        some = np.flatnonzero(sizes > group)
        byte = (values[some] >> np.uint64(7 * group)) & np.uint64(0x7F)
        data[offsets[some] + group] = byte.astype(np.uint8) | ((sizes[some] > group + 1) << 7).astype(np.uint8)
    return Pieces(data, offsets)


def zigzag(values: np.ndarray) -> np.ndarray:
    values = values.astype(np.int64)
    return (values << 1) ^ (values >> 63)


def fixed(values: np.ndarray) -> Pieces:
    """Each value in its own width, little-endian."""
    values = np.ascontiguousarray(values, values.dtype.newbyteorder("<"))
    offsets = np.arange(len(values) + 1, dtype=np.int64) * values.dtype.itemsize
    return Pieces(values.view(np.uint8).reshape(-1), offsets)


def content(values: pa.Array) -> Pieces:
    """The bytes of texts or byte strings; NULL is empty."""
    wide = values.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = wide.buffers()
    bounds = np.frombuffer(offsets, np.int64, len(wide) + 1, 8 * wide.offset)
    return Pieces(np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), bounds)


def constant(value: bytes, count: int) -> Pieces:
    data = np.tile(np.frombuffer(value, np.uint8), count)
    return Pieces(data, np.arange(count + 1, dtype=np.int64) * len(value))


def one_after_another(parts: list[Pieces]) -> Pieces:
    """The strings of each record, one after the other."""
    sizes = [part.sizes for part in parts]
    offsets = _offsets(np.sum(sizes, axis=0))
    data = np.empty(offsets[-1], np.uint8)
    begin = offsets[:-1].copy()
    for part, size in zip(parts, sizes):
        if part.offsets[-1] > part.offsets[0]:
            # Where each byte goes: its place in its own part, moved with its record.
            own = np.arange(part.offsets[0], part.offsets[-1])
            data[np.repeat(begin - part.offsets[:-1], size) + own] = part.data[own[0] : own[-1] + 1]
        begin += size
    return Pieces(data, offsets)


def prefixed(part: Pieces) -> Pieces:
    """Each string after its length as a varint."""
    return one_after_another([varints(part.sizes), part])


def list_parts(values: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Offsets and items of lists, without gaps; items of a map are structs of key and value."""
    begin = values.offsets.to_numpy().astype(np.int64)
    counts = np.where(values.is_valid().to_numpy(False), np.diff(begin), 0)
    offsets = _offsets(counts)
    at = pa.array(np.repeat(begin[:-1] - offsets[:-1], counts) + np.arange(offsets[-1]))
    if pa.types.is_map(values.type):
        return offsets, pa.StructArray.from_arrays([values.keys.take(at), values.items.take(at)], names=["key", "value"])
    return offsets, values.values.take(at)
