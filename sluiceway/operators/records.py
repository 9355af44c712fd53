"""Records of any Avro or Protobuf schema: rows into payloads, payloads into rows."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluiceway.codecs.avro import Datum, compile_avro
from sluiceway.codecs.protobuf import Payload, compile_protobuf
from sluiceway.functions.stamps import processing_time as stamp
from sluiceway.operators.arrow_decode import MALFORMED, RECORD, record_decoder, record_encoder


def encode_records(rows: DataFrame, program: Datum | Payload) -> DataFrame:
    """Add ``payload`` from the columns that have the names of the record's fields.

    Columns are cast to the field's type. NULL in a field that can't be is an error.
    """
    fields = [F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in program.spark]
    return rows.withColumn("payload", record_encoder(program)(F.struct(*fields)))


def decode_records(
    messages: DataFrame, program: Datum | Payload, on_malformed: str = "fail", column: str = RECORD
) -> DataFrame:
    """Add a column with the struct in each payload; a NULL payload counts as an empty one.

    A payload that is no record fails the query. With ``on_malformed="quarantine"`` it stays,
    with NULL in the column, and ``malformed`` tells why (NULL for good messages).
    """
    decode = record_decoder(program, on_malformed)(F.coalesce("payload", F.lit(b"")))
    if on_malformed == "fail":
        return messages.withColumn(column, decode)
    raw = messages.withColumn("_raw", decode)
    found = {column: F.col(f"_raw.{RECORD}"), MALFORMED: F.col(f"_raw.{MALFORMED}")}
    return raw.withColumns(found).drop("_raw")


def encode_avro_records(rows: DataFrame, avsc: str) -> DataFrame:
    """Add ``payload``, one raw Avro datum of the schema ``avsc``."""
    return encode_records(rows, compile_avro(avsc))


def decode_avro_records(messages: DataFrame, avsc: str, on_malformed: str = "fail") -> DataFrame:
    """Add ``record``, the struct in an Avro payload written with the schema ``avsc``."""
    return decode_records(messages, compile_avro(avsc), on_malformed)


def encode_protobuf_records(rows: DataFrame, descriptors: bytes, message: str) -> DataFrame:
    """Add ``payload``, one Protobuf message; ``descriptors`` is a serialized FileDescriptorSet."""
    return encode_records(rows, compile_protobuf(descriptors, message))


def decode_protobuf_records(
    messages: DataFrame, descriptors: bytes, message: str, on_malformed: str = "fail"
) -> DataFrame:
    """Add ``record``, the struct in a Protobuf payload."""
    return decode_records(messages, compile_protobuf(descriptors, message), on_malformed)


def record_rows(decoded: DataFrame, processing_time: Column | None = None) -> DataFrame:
    """The fields of each record and ``timestamp``, as rows for a table."""
    return decoded.select(f"{RECORD}.*", stamp(processing_time).alias("timestamp"))
