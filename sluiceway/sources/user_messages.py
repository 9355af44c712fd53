"""Streams of decoded user messages: one column ``user_message``, the decoded struct."""

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from sluiceway.operators.user_messages import decode_avro, decode_protobuf
from sluiceway.sources.topics import read_subscription, read_topic


def read_avro(
    spark: SparkSession,
    topic: str,
    start: datetime | None = None,
    decoder: str = "auto",
    **read_options,
) -> DataFrame:
    """The Avro user messages of a topic, those published at or after ``start`` if given."""
    messages = read_topic(spark, topic, start, **read_options)
    return messages.transform(decode_avro, decoder).select("user_message")


def read_protobuf(
    spark: SparkSession, topic: str, decoder: str = "auto", **read_options
) -> DataFrame:
    """The Protobuf user messages of a subscription."""
    messages = read_subscription(spark, topic, **read_options)
    return messages.transform(decode_protobuf, decoder).select("user_message")
