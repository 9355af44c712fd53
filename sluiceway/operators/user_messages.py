"""User messages: encode rows into payloads, decode payloads, shape rows."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluiceway.codecs.avro import compile_avro
from sluiceway.codecs.protobuf import compile_protobuf
from sluiceway.functions.stamps import processing_time as stamp
from sluiceway.functions.stamps import random_id
from sluiceway.functions.text import greeting, payload_text
from sluiceway.functions.wire import avro_record, protobuf_message
from sluiceway.operators.records import decode_records
from sluiceway.schemas import (
    AVRO_FIELDS,
    PROTOBUF_FIELDS,
    PROTOBUF_MESSAGE,
    USER_MESSAGE_AVSC,
    USER_MESSAGE_DESCRIPTOR_HEX,
)

USER_COLUMNS = ("id", "first_name", "last_name")


def encode_greetings(names: DataFrame) -> DataFrame:
    """Add ``payload``, the greeting of ``name``, and ``attributes`` with ``first_name``."""
    name = F.col("name")
    return names.withColumns(
        {
            "payload": greeting(name),
            "attributes": F.create_map(F.lit("first_name"), name),
        }
    )


def with_user_ids(users: DataFrame) -> DataFrame:
    """``users`` with a random ``id`` where they have none."""
    return users if "id" in users.columns else users.withColumn("id", random_id())


def encode_avro(users: DataFrame) -> DataFrame:
    """Add ``payload``, one raw Avro datum of ``id, first_name, last_name``."""
    return users.withColumn("payload", avro_record(*USER_COLUMNS))


def encode_protobuf(users: DataFrame) -> DataFrame:
    """Add ``payload``, one Protobuf message of ``id, first_name, last_name``."""
    return users.withColumn("payload", protobuf_message(*USER_COLUMNS))


def decode_avro(
    messages: DataFrame, decoder: str = "auto", on_malformed: str = "fail"
) -> DataFrame:
    """Add ``user_message``, the struct in an Avro payload, with the Avro field names.

    Truncated payloads, trailing bytes and NULL payloads fail the query. With
    ``on_malformed="quarantine"`` such messages stay, with a NULL ``user_message``, and a
    column ``malformed`` tells why (NULL for good messages).

    ``decoder`` is ``"arrow"`` or ``"builtin"`` (Spark's Avro module, which knows no
    quarantine and refuses lengths written in more bytes than they need); ``"auto"`` is
    ``"arrow"``, whatever modules there are.
    """
    if _is_builtin(decoder, on_malformed):
        return _decode_avro_builtin(messages)
    return decode_records(messages, compile_avro(USER_MESSAGE_AVSC), on_malformed, "user_message")


def decode_protobuf(
    messages: DataFrame, decoder: str = "auto", on_malformed: str = "fail"
) -> DataFrame:
    """Add ``user_message``, the struct in a Protobuf payload, with the Protobuf field names.

    Malformed payloads, missing required fields and NULL payloads fail the query or are set
    apart; unknown fields are skipped and the last of repeated values wins. ``decoder`` and
    ``on_malformed`` as in :func:`decode_avro`, with Spark's Protobuf module.
    """
    if _is_builtin(decoder, on_malformed):
        return _decode_protobuf_builtin(messages)
    program = compile_protobuf(bytes.fromhex(USER_MESSAGE_DESCRIPTOR_HEX), PROTOBUF_MESSAGE)
    return decode_records(messages, program, on_malformed, "user_message")


def avro_rows(decoded: DataFrame, processing_time: Column | None = None) -> DataFrame:
    """Rows ``id, first_name, last_name, timestamp`` of decoded Avro messages."""
    return _user_rows(decoded, AVRO_FIELDS, processing_time)


def protobuf_rows(decoded: DataFrame, processing_time: Column | None = None) -> DataFrame:
    """Rows ``id, first_name, last_name, timestamp`` of decoded Protobuf messages."""
    return _user_rows(decoded, PROTOBUF_FIELDS, processing_time)


def _user_rows(decoded: DataFrame, fields: tuple[str, ...], processing_time: Column | None) -> DataFrame:
    named = [
        F.col(f"user_message.{field}").alias(column) for field, column in zip(fields, USER_COLUMNS)
    ]
    return decoded.select(*named, stamp(processing_time).alias("timestamp"))


def _decode_avro_builtin(messages: DataFrame) -> DataFrame:
    datum = F.call_function(
        "from_avro", F.coalesce("payload", F.lit(b"")), F.lit(USER_MESSAGE_AVSC), _fail_fast()
    )
    decoded = messages.withColumn("user_message", datum)
    # The built-in reader ignores what follows the datum.
    fields = [f"user_message.{field}" for field in AVRO_FIELDS]
    whole = F.octet_length(avro_record(*fields)) == F.octet_length("payload")
    text = F.struct(*(payload_text(F.col(f)).alias(n) for f, n in zip(fields, AVRO_FIELDS)))
    return decoded.withColumn(
        "user_message",
        F.when(whole, text).otherwise(F.raise_error(F.lit("bytes follow the Avro datum"))),
    )


def _decode_protobuf_builtin(messages: DataFrame) -> DataFrame:
    message = F.call_function(
        "from_protobuf",
        F.coalesce("payload", F.lit(b"")),
        F.lit(PROTOBUF_MESSAGE),
        F.lit(bytes.fromhex(USER_MESSAGE_DESCRIPTOR_HEX)),
        _fail_fast(),
    )
    return messages.withColumn("user_message", message)


def _fail_fast() -> Column:
    return F.create_map(F.lit("mode"), F.lit("FAILFAST"))


def _is_builtin(decoder: str, on_malformed: str) -> bool:
    if decoder not in ("auto", "builtin", "arrow"):
        raise ValueError(f"decoder must be 'auto', 'builtin' or 'arrow', not {decoder!r}")
    if decoder == "builtin" and on_malformed != "fail":
        raise ValueError("the built-in decoder has no quarantine")
    return decoder == "builtin"
