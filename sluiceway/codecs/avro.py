"""Avro: a schema becomes a program of column steps, for raw data without any header."""

import json
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import types as T

from sluiceway.codecs.cursor import Cursor, cut, fixed_at, listed, placed, text_of
from sluiceway.codecs.pieces import (
    Pieces,
    constant,
    content,
    fixed,
    list_parts,
    one_after_another,
    varints,
    zigzag,
)

cloudpickle.register_pickle_by_value(sys.modules[__name__])


class Number:
    """A zig-zag varint: int, long, date or timestamp."""

    def __init__(self, bits: int, arrow: pa.DataType, spark: T.DataType, scale: int = 1):
        self.bits, self.arrow, self.spark, self.scale = bits, arrow, spark, scale

    def decode(self, cursor: Cursor) -> pa.Array:
        value = cursor.long()
        if self.bits == 32:
            narrow = value.astype(np.int32)
            live = cursor.places()
            cursor.fail(live[narrow[live] != value[live]], "an int of more than 32 bits")
            return pa.array(narrow).view(self.arrow)
        return pa.array(value * self.scale).view(self.arrow)

    def encode(self, values: pa.Array) -> Pieces:
        plain = values.view(pa.int32() if self.bits == 32 else pa.int64()).fill_null(0)
        return varints(zigzag(plain.to_numpy(False) // self.scale))


class Plain:
    """A value of fixed width: boolean, float or double."""

    def __init__(self, kind: str, arrow: pa.DataType, spark: T.DataType):
        self.kind, self.arrow, self.spark = kind, arrow, spark
        self.width = np.dtype(kind).itemsize

    def decode(self, cursor: Cursor) -> pa.Array:
        return self.values(cursor.fixed(self.kind))

    def values(self, found: np.ndarray) -> pa.Array:
        return pa.array(found == 1 if self.kind == "u1" else found.astype(np.dtype(self.kind)))

    def encode(self, values: pa.Array) -> Pieces:
        return fixed(values.fill_null(False if self.kind == "u1" else 0).to_numpy(False).astype(self.kind))


class Content:
    """Bytes after their length; text if so told."""

    def __init__(self, text: bool):
        self.text = text
        self.arrow, self.spark = (pa.string(), T.StringType()) if text else (pa.binary(), T.BinaryType())

    def decode(self, cursor: Cursor) -> pa.Array:
        length = cursor.varint()
        live = cursor.places()
        cursor.fail(live[length[live] & 1 == 1], "negative string length in an Avro payload")
        found = cut(cursor.data, *cursor.take(length >> 1))
        return text_of(found) if self.text else found

    def encode(self, values: pa.Array) -> Pieces:
        part = content(values)
        return one_after_another([varints(zigzag(part.sizes)), part])


class Fixed:
    def __init__(self, width: int):
        self.width, self.arrow, self.spark = width, pa.binary(), T.BinaryType()

    def decode(self, cursor: Cursor) -> pa.Array:
        return cut(cursor.data, *cursor.take(self.width))

    def encode(self, values: pa.Array) -> Pieces:
        part = content(values)
        if (part.sizes[values.is_valid().to_numpy(False)] != self.width).any():
            raise ValueError(f"a fixed value must have {self.width} bytes")
        return part


class Enum:
    arrow, spark = pa.string(), T.StringType()

    def __init__(self, symbols: list[str]):
        self.symbols = symbols

    def decode(self, cursor: Cursor) -> pa.Array:
        place = cursor.long()
        live = cursor.places()
        cursor.fail(live[(place[live] < 0) | (place[live] >= len(self.symbols))], "unknown symbol of an enum")
        place = np.where(cursor.alive, place, 0)
        return pa.array(self.symbols, pa.string()).take(pa.array(place))

    def encode(self, values: pa.Array) -> Pieces:
        place = pa.compute.index_in(values, pa.array(self.symbols, pa.string()))
        if place.null_count > values.null_count:
            raise ValueError("unknown symbol of an enum")
        return varints(zigzag(place.fill_null(0).to_numpy(False)))


class Nothing:
    arrow, spark = pa.null(), T.NullType()

    def decode(self, cursor: Cursor) -> pa.Array:
        return pa.nulls(len(cursor))

    def encode(self, values: pa.Array) -> Pieces:
        return constant(b"", len(values))


class Union:
    """One of several types. With one type beside null it is that type, nullable; else a struct
    with a member for each type, of which all but one are NULL."""

    def __init__(self, branches: list):
        self.branches = branches
        self.members = [i for i, b in enumerate(branches) if not isinstance(b, Nothing)]
        if not self.members:
            raise ValueError("a union needs a type beside null")
        only = branches[self.members[0]]
        self.single = len(self.members) == 1
        if self.single:
            self.arrow, self.spark = only.arrow, only.spark
        else:
            named = [(f"member{k}", branches[i]) for k, i in enumerate(self.members)]
            self.arrow = pa.struct([(name, b.arrow) for name, b in named])
            self.spark = T.StructType([T.StructField(name, b.spark) for name, b in named])

    def decode(self, cursor: Cursor) -> pa.Array:
        branch = cursor.long()
        live = cursor.places()
        cursor.fail(live[(branch[live] < 0) | (branch[live] >= len(self.branches))], "unknown branch of a union")
        found, taken = [], np.zeros(len(cursor), bool)
        for i in self.members:
            places = np.flatnonzero((branch == i) & cursor.alive)
            taken[places] = True
            if len(places) == len(cursor):
                found.append(self.branches[i].decode(cursor))
                continue
            part = cursor.subset(places)
            values = self.branches[i].decode(part)
            cursor.absorb(places, part)
            found.append(placed(values, places, len(cursor)))
        if self.single:
            return found[0]
        names = [field.name for field in self.arrow]
        return pa.StructArray.from_arrays(found, names=names, mask=pa.array(~taken))

    def encode(self, values: pa.Array) -> Pieces:
        parts, branch = [], np.full(len(values), -1)
        for k, i in enumerate(self.members):
            own = values if self.single else pa.compute.struct_field(values, [k])
            places = np.flatnonzero(own.is_valid().to_numpy(False))
            branch[places] = i
            parts.append(self.branches[i].encode(own.take(pa.array(places))).at(places, len(values)))
        empty = branch < 0
        if empty.any():
            nulls = [i for i, b in enumerate(self.branches) if isinstance(b, Nothing)]
            if not nulls:
                raise ValueError("a value is NULL, but its union has no null")
            branch[empty] = nulls[0]
        return one_after_another([varints(zigzag(branch)), *parts])


class Items:
    """An array, in blocks, each after its count; or a map, whose items are keys and values."""

    def __init__(self, item, is_map: bool = False):
        self.is_map = is_map
        self.item = Record("entry", [("key", Content(True)), ("value", item)]) if is_map else item
        if is_map:
            self.arrow = pa.map_(pa.string(), item.arrow)
            self.spark = T.MapType(T.StringType(), item.spark)
        else:
            self.arrow, self.spark = pa.list_(item.arrow), T.ArrayType(item.spark)

    def decode(self, cursor: Cursor) -> pa.Array:
        owners, values = [], []
        reading = cursor.places()
        while len(reading):
            part = cursor.subset(reading)
            count = part.long()
            sized = np.flatnonzero((count < 0) & part.alive)
            inner = part.subset(sized)
            inner.varint()  # the block's size in bytes, to skip it by
            part.absorb(sized, inner)
            cursor.absorb(reading, part)
            going = part.alive & (count != 0)
            reading, left = reading[going], np.abs(count[going])
            if isinstance(self.item, Plain):
                self._contiguous(cursor, reading, left, owners, values)
            else:
                self._one_by_one(cursor, reading, left, owners, values)
            reading = reading[cursor.alive[reading]]
        offsets, flat = listed(owners, values, pa.nulls(0, self.item.arrow), len(cursor))
        if self.is_map:
            return pa.MapArray.from_arrays(offsets, flat.field(0), flat.field(1))
        return pa.ListArray.from_arrays(offsets, flat)

    def _contiguous(self, cursor, places, left, owners, values):
        part = cursor.subset(places)
        width = self.item.width
        begin, end = part.take(np.minimum(left, 1 << 40) * width)
        cursor.absorb(places, part)
        count = (end - begin) // width
        nth = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        at = np.repeat(begin, count) + nth * width
        owners.append(np.repeat(places, count))
        kind = np.dtype(self.item.kind).newbyteorder("<")
        values.append(self.item.values(fixed_at(cursor.data, at, at + width, kind)))

    def _one_by_one(self, cursor, places, left, owners, values):
        while len(places):
            part = cursor.subset(places)
            found = self.item.decode(part)
            cursor.absorb(places, part)
            # Values of no bytes could make a short payload endless work.
            stuck = np.flatnonzero(part.alive & (left > part.stop - part.at + 1))
            if len(stuck) and isinstance(self.item, Nothing):
                cursor.fail(places[stuck], "an array of more items than bytes")
            owners.append(places)
            values.append(found)
            going = cursor.alive[places] & (left > 1)
            places, left = places[going], left[going] - 1

    def encode(self, values: pa.Array) -> Pieces:
        offsets, items = list_parts(values)
        items = self.item.encode(items).joined(offsets)
        counts = np.diff(offsets)
        some = np.flatnonzero(counts)
        count = varints(zigzag(counts[some])).at(some, len(values))
        return one_after_another([count, items, constant(b"\0", len(values))])


class Record:
    def __init__(self, name: str, fields: list):
        if not fields:
            raise ValueError(f"record {name} has no fields")
        self.name, self.fields = name, fields
        self.arrow = pa.struct([(n, node.arrow) for n, node in fields])
        self.spark = T.StructType([T.StructField(n, node.spark) for n, node in fields])

    def decode(self, cursor: Cursor) -> pa.Array:
        found = [node.decode(cursor) for _, node in self.fields]
        return pa.StructArray.from_arrays(found, names=[n for n, _ in self.fields])

    def encode(self, values: pa.Array) -> Pieces:
        parts = []
        for i, (name, node) in enumerate(self.fields):
            own = pa.compute.struct_field(values, [i])
            if own.null_count and not isinstance(node, (Union, Nothing)):
                raise ValueError(f"field {name} is NULL, but it is required")
            parts.append(node.encode(own))
        return one_after_another(parts)


class Datum:
    """A whole payload: one record and nothing after it."""

    def __init__(self, record):
        self.record = record
        self.arrow, self.spark = record.arrow, record.spark

    def decode(self, payloads: pa.Array) -> tuple[pa.Array, np.ndarray | None]:
        """The records, and why each payload is none (NULL if it is one)."""
        cursor = Cursor.over(payloads)
        found = self.record.decode(cursor)
        live = cursor.places()
        cursor.fail(live[cursor.at[live] != cursor.stop[live]], "bytes follow the Avro datum")
        return found, cursor.reason

    def encode(self, records: pa.Array) -> pa.Array:
        return self.record.encode(records).binary()


_PRIMITIVE = {
    "null": Nothing,
    "boolean": lambda: Plain("u1", pa.bool_(), T.BooleanType()),
    "int": lambda: Number(32, pa.int32(), T.IntegerType()),
    "long": lambda: Number(64, pa.int64(), T.LongType()),
    "float": lambda: Plain("f4", pa.float32(), T.FloatType()),
    "double": lambda: Plain("f8", pa.float64(), T.DoubleType()),
    "bytes": lambda: Content(False),
    "string": lambda: Content(True),
}
_TIME = pa.timestamp("us", "UTC")
_LOGICAL = {
    ("int", "date"): lambda: Number(32, pa.date32(), T.DateType()),
    ("long", "timestamp-micros"): lambda: Number(64, _TIME, T.TimestampType()),
    ("long", "timestamp-millis"): lambda: Number(64, _TIME, T.TimestampType(), 1000),
}


def compile_avro(avsc: str) -> Datum:
    """A program for data of a schema whose outermost type is a record.

    Dates and timestamps become Spark's; other logical types are read as the type beneath.
    Types that contain themselves are refused, as Spark has none.
    """
    known: dict = {}

    def full(name: str, space: str | None) -> str:
        return name if "." in name or not space else f"{space}.{name}"

    def node(schema, space: str | None):
        if isinstance(schema, list):
            return Union([node(branch, space) for branch in schema])
        if isinstance(schema, str):
            if schema in _PRIMITIVE:
                return _PRIMITIVE[schema]()
            found = known.get(full(schema, space), known.get(schema))
            if found is None:
                raise ValueError(f"type {schema} is not known here, or contains itself")
            return found
        kind = schema["type"]
        if not isinstance(kind, str) or kind not in ("record", "error", "enum", "fixed", "array", "map"):
            logical = _LOGICAL.get((kind, schema.get("logicalType"))) if isinstance(kind, str) else None
            return logical() if logical else node(kind, space)
        if kind == "array":
            return Items(node(schema["items"], space))
        if kind == "map":
            return Items(node(schema["values"], space), is_map=True)
        name = full(schema["name"], schema.get("namespace", space))
        if kind == "enum":
            made = Enum(schema["symbols"])
        elif kind == "fixed":
            made = Fixed(schema["size"])
        else:
            inner = name.rpartition(".")[0] or None
            made = Record(name, [(f["name"], node(f["type"], inner)) for f in schema["fields"]])
        known[name] = made
        return made

    record = node(json.loads(avsc), None)
    if not isinstance(record, Record):
        raise ValueError("the outermost type must be a record")
    return Datum(record)
