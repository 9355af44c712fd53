"""Avro and Protobuf encoding of records of required strings, as SQL expressions.

They are SQL text because one parsed expression is far cheaper to build than the more than
a hundred Column objects it stands for.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F


def varint(number: str) -> str:
    """SQL of a non-negative BIGINT, below 2^35, as a base-128 varint.

    A string column holds less than 2^31 bytes, so that is enough for its length, doubled
    in Avro. The common short form is separate; one expression serves all longer ones, as
    Java does not compile a generated method that grows beyond 8,000 bytes.
    """
    # The low four groups with their continuation bits, first group first: eight
    # hexadecimal digits, since the first byte is at least 0x80.
    groups = [f"shiftleft(shiftright({number}, {7 * i}) & 127 | 128, {24 - 8 * i})" for i in range(4)]
    continued = (
        f"CASE WHEN {number} < {1 << 14} THEN 1 WHEN {number} < {1 << 21} THEN 2 "
        f"WHEN {number} < {1 << 28} THEN 3 ELSE 4 END"
    )
    return (
        f"CASE WHEN {number} < 128 THEN cast(chr({number}) AS binary) ELSE "
        f"concat(substring(unhex(hex({' | '.join(groups)})), 1, {continued}), "
        f"cast(chr(shiftright({number}, 7 * {continued})) AS binary)) END"
    )


def avro_record(*columns: str) -> Column:
    """One Avro datum, without any header: each string as zig-zag length and UTF-8 bytes."""
    parts = []
    for column in columns:
        parts += [varint(f"(2L * octet_length({column}))"), f"cast({column} AS binary)"]
    return _of_required(parts, columns)


def protobuf_message(*columns: str) -> Column:
    """One Protobuf message: string fields numbered from 1, in order."""
    parts = []
    for number, column in enumerate(columns, start=1):
        tag = f"X'{number << 3 | 2:02X}'"
        length = varint(f"cast(octet_length({column}) AS bigint)")
        parts += [tag, length, f"cast({column} AS binary)"]
    return _of_required(parts, columns)


def _of_required(parts: list[str], columns: tuple[str, ...]) -> Column:
    # The concatenation is NULL exactly if one of the columns is.
    error = f"raise_error('one of {', '.join(columns)} is NULL, but all are required')"
    return F.expr(f"coalesce(concat({', '.join(parts)}), {error})")
