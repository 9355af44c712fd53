"""Jobs for records of any Avro or Protobuf schema: publish rows, ingest payloads."""

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sluiceway.codecs.avro import Datum
from sluiceway.codecs.protobuf import Payload
from sluiceway.operators.records import decode_records, encode_records, record_rows
from sluiceway.sinks.topics import publish
from sluiceway.sources.topics import read_subscription
from sluiceway.streaming.writers import append_batch, start_writing


def publish_records(rows: DataFrame, program: Datum | Payload, topic: str) -> DataFrame:
    """Publish a record of every row; returns the message ids."""
    return rows.transform(encode_records, program).transform(publish, topic)


def ingest_records(
    spark: SparkSession,
    topic: str,
    program: Datum | Payload,
    table: str,
    checkpoint: str,
    *,
    processing_time: Column | None = None,
    trigger: Mapping | None = None,
    malformed_table: str | None = None,
    ledger: str | None = None,
    **read_options,
) -> StreamingQuery:
    """Append the records in the messages of a subscription, and ``timestamp``, to a table."""
    return ingest_record_messages(
        read_subscription(spark, topic, columns=("payload",), **read_options),
        program,
        table,
        checkpoint,
        processing_time=processing_time,
        trigger=trigger,
        malformed_table=malformed_table,
        ledger=ledger,
    )


def ingest_record_messages(
    messages: DataFrame,
    program: Datum | Payload,
    table: str,
    checkpoint: str,
    *,
    processing_time: Column | None = None,
    trigger: Mapping | None = None,
    malformed_table: str | None = None,
    ledger: str | None = None,
) -> StreamingQuery:
    """As :func:`ingest_records`, from any stream of messages.

    A malformed message fails the query, or goes to ``malformed_table`` (``payload, reason,
    timestamp``) if there is one.
    """
    decoded = messages.transform(decode_records, program, "quarantine" if malformed_table else "fail")
    columns = [F.col("record")]
    if malformed_table:
        columns += ["malformed", F.when(F.col("malformed").isNotNull(), F.col("payload")).alias("payload")]
    write = append_batch(table, lambda batch: record_rows(batch, processing_time), malformed_table, ledger)
    return start_writing(decoded.select(*columns), write, checkpoint, trigger)
