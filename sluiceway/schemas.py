"""Row types of messages, user messages and sink tables, and the two wire schemas."""

from pyspark.sql import types as T

MESSAGE = T.StructType(
    [
        T.StructField("message_id", T.StringType()),
        T.StructField("payload", T.BinaryType()),
        T.StructField("attributes", T.MapType(T.StringType(), T.StringType())),
        T.StructField("publish_time", T.TimestampType()),
    ]
)

USER_MESSAGE = T.StructType(
    [
        T.StructField("id", T.StringType(), nullable=False),
        T.StructField("first_name", T.StringType(), nullable=False),
        T.StructField("last_name", T.StringType(), nullable=False),
    ]
)

NAME_ROW = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

USER_MESSAGE_ROW = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("first_name", T.StringType()),
        T.StructField("last_name", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

MALFORMED_ROW = T.StructType(
    [
        T.StructField("payload", T.BinaryType()),
        T.StructField("reason", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

# Field names of the two wire schemas, in wire order. The Protobuf fields
# are numbered from 1 in this order and all are required.
AVRO_FIELDS = ("id", "first_name", "last_name")
PROTOBUF_FIELDS = ("id", "firstName", "lastName")

PROTOBUF_MESSAGE = "UserMessage"

# Fixed value: the writer and reader schema of an Avro user message.
USER_MESSAGE_AVSC = """
{"type": "record", "name": "UserMessage", "fields": [
  {"name": "id", "type": "string"},
  {"name": "first_name", "type": "string"},
  {"name": "last_name", "type": "string"}]}
"""

# Fixed value: the serialized FileDescriptorSet of
#   syntax = "proto2";
#   message UserMessage {
#     required string id = 1;
#     required string firstName = 2;
#     required string lastName = 3;
#   }
USER_MESSAGE_DESCRIPTOR_HEX = (
    "0a5c0a12757365725f6d6573736167652e70726f746f223e0a0b557365724d657373616765120a0a02696418"
    "012002280912110a0966697273744e616d6518022002280912100a086c6173744e616d651803200228096206"
    "70726f746f32"
)
