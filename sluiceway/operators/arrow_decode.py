"""Arrow batch codecs as UDFs, for programs compiled from a schema.

Used where Spark's own Avro or Protobuf module is not loaded, and for schemas that only the
caller knows. A batch is decoded column by column: each step reads one field of every message
at once, so the Python cost is per batch and field, not per row. A message that is none has an
error state of its own and costs no more than others.
"""

import sys

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluiceway.codecs.avro import Content, Datum, Record
from sluiceway.codecs.protobuf import BYTES, Field, Message, Payload, Scalar

# The functions travel to the executors whole, so this package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: With quarantine: the record, and the field that tells why a message could not be decoded.
RECORD, MALFORMED = "record", "malformed"


def record_decoder(program: Datum | Payload, on_malformed: str = "fail"):
    """A UDF: a BINARY payload to the struct of a program's record.

    With ``on_malformed="quarantine"`` it is a struct of ``record`` and ``malformed``: why the
    payload is no message, and then the record is NULL.
    """
    if on_malformed not in ("fail", "quarantine"):
        raise ValueError(f"on_malformed must be 'fail' or 'quarantine', not {on_malformed!r}")
    quarantine = on_malformed == "quarantine"
    kind = program.spark
    if quarantine:
        kind = T.StructType([T.StructField(RECORD, kind), T.StructField(MALFORMED, T.StringType())])

    # Declared non-deterministic so that Spark evaluates it once per row instead of
    # repeating it in every filter on a decoded field.
    @F.arrow_udf(kind)
    def decode(payloads: pa.Array) -> pa.Array:
        records, reasons = program.decode(payloads)
        if not quarantine:
            if reasons is not None:
                raise ValueError(next(reason for reason in reasons if reason is not None))
            return records
        told = pa.nulls(len(records), pa.string()) if reasons is None else pa.array(reasons, pa.string())
        if reasons is not None:
            records = pa.StructArray.from_arrays(
                [records.field(i) for i in range(records.type.num_fields)],
                fields=list(records.type),
                mask=told.is_valid(),
            )
        return pa.StructArray.from_arrays([records, told], names=[RECORD, MALFORMED])

    return decode.asNondeterministic()


def record_encoder(program: Datum | Payload):
    """A UDF: a struct of a program's record to its BINARY payload."""

    @F.arrow_udf(T.BinaryType())
    def encode(records: pa.Array) -> pa.Array:
        return program.encode(records)

    return encode


def avro_decoder(names: tuple[str, ...], on_malformed: str = "fail"):
    """A UDF: a BINARY payload to the struct of the fields ``names``, as BINARY."""
    return record_decoder(Datum(Record("record", [(name, Content(False)) for name in names])), on_malformed)


def protobuf_decoder(names: tuple[str, ...], on_malformed: str = "fail"):
    """A UDF as :func:`avro_decoder`.

    The names are those of Protobuf fields 1, 2 and so on. All are required; other fields,
    and these numbers with another wire type, are skipped. The last of repeated values wins.
    """
    fields = [Field(i, name, Scalar(BYTES), required=True) for i, name in enumerate(names, 1)]
    return record_decoder(Payload(Message("record", fields)), on_malformed)
