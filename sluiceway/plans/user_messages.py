"""User message jobs: publish and ingest, as Avro or as Protobuf."""

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sluiceway.operators.user_messages import (
    avro_rows,
    decode_avro,
    decode_protobuf,
    encode_avro,
    encode_protobuf,
    protobuf_rows,
    with_user_ids,
)
from sluiceway.sinks.topics import publish
from sluiceway.sources.topics import (
    keep_start,
    kept_offset,
    kept_start,
    read_subscription,
    read_topic,
    topic_log,
    unlimited,
)
from sluiceway.streaming.writers import append_batch, pass_over_published, start_writing


def publish_avro(users: DataFrame, topic: str) -> DataFrame:
    """Publish ``first_name, last_name`` (and ``id``, else random) as Avro; returns message ids."""
    return users.transform(with_user_ids).transform(encode_avro).transform(publish, topic)


def publish_protobuf(users: DataFrame, topic: str) -> DataFrame:
    """Publish ``first_name, last_name`` (and ``id``, else random) as Protobuf; returns message ids."""
    return users.transform(with_user_ids).transform(encode_protobuf).transform(publish, topic)


def ingest_avro(
    spark: SparkSession,
    topic: str,
    table: str,
    checkpoint: str,
    *,
    start: datetime | None = None,
    processing_time: Column | None = None,
    trigger: Mapping | None = None,
    decoder: str = "auto",
    malformed_table: str | None = None,
    ledger: str | None = None,
    **read_options,
) -> StreamingQuery:
    """Append the Avro user messages that become visible after the first start of the job.

    At the first start all publications there are are passed over: in a topic with a log by
    its latest offset, in others by listing them on the job's checkpoint. No clocks are compared, so a publication under way is delivered whole
    when it is committed. With ``start`` the messages published at or after that time count
    instead. A restart goes on as the first start began.
    """
    known, since = kept_start(spark, checkpoint)
    log = topic_log(topic)
    if log is not None and (since or start) is None:
        # From the offset after the latest, as it was at the first start.
        read_options["start_offset"] = kept_offset(spark, checkpoint, log.next)
    elif not known:
        since = start
        if start is None:
            everything = read_subscription(spark, topic, ("payload",), **unlimited(read_options))
            decoded, write = _avro_append(
                everything, table, processing_time, decoder, malformed_table, ledger
            )
            pass_over_published(decoded, write, checkpoint)
        keep_start(spark, checkpoint, start)
    return ingest_avro_messages(
        read_topic(spark, topic, since, columns=("payload",), **read_options),
        table,
        checkpoint,
        processing_time=processing_time,
        trigger=trigger,
        decoder=decoder,
        malformed_table=malformed_table,
        ledger=ledger,
    )


def ingest_avro_messages(
    messages: DataFrame,
    table: str,
    checkpoint: str,
    *,
    processing_time: Column | None = None,
    trigger: Mapping | None = None,
    decoder: str = "auto",
    malformed_table: str | None = None,
    ledger: str | None = None,
) -> StreamingQuery:
    """Append the Avro user messages of any stream of messages.

    A malformed message fails the query, or goes to ``malformed_table`` (``payload, reason,
    timestamp``) if there is one.
    """
    decoded, write = _avro_append(messages, table, processing_time, decoder, malformed_table, ledger)
    return start_writing(decoded, write, checkpoint, trigger)


def ingest_protobuf(
    spark: SparkSession,
    topic: str,
    table: str,
    checkpoint: str,
    *,
    processing_time: Column | None = None,
    trigger: Mapping | None = None,
    decoder: str = "auto",
    malformed_table: str | None = None,
    ledger: str | None = None,
    **read_options,
) -> StreamingQuery:
    """Append the Protobuf user messages of a subscription."""
    return ingest_protobuf_messages(
        read_subscription(spark, topic, columns=("payload",), **read_options),
        table,
        checkpoint,
        processing_time=processing_time,
        trigger=trigger,
        decoder=decoder,
        malformed_table=malformed_table,
        ledger=ledger,
    )


def ingest_protobuf_messages(
    messages: DataFrame,
    table: str,
    checkpoint: str,
    *,
    processing_time: Column | None = None,
    trigger: Mapping | None = None,
    decoder: str = "auto",
    malformed_table: str | None = None,
    ledger: str | None = None,
) -> StreamingQuery:
    """Append the Protobuf user messages of any stream, as :func:`ingest_avro_messages`."""
    decoded = _decoded(messages, decode_protobuf, decoder, malformed_table)
    write = append_batch(
        table, lambda batch: protobuf_rows(batch, processing_time), malformed_table, ledger
    )
    return start_writing(decoded, write, checkpoint, trigger)


def _avro_append(messages, table, processing_time, decoder, malformed_table, ledger):
    decoded = _decoded(messages, decode_avro, decoder, malformed_table)
    write = append_batch(table, lambda batch: avro_rows(batch, processing_time), malformed_table, ledger)
    return decoded, write


def _decoded(messages: DataFrame, decode, decoder: str, malformed_table: str | None) -> DataFrame:
    if malformed_table is None:
        return messages.transform(decode, decoder).select("user_message")
    decoded = messages.transform(decode, decoder, "quarantine")
    payload = F.when(F.col("malformed").isNotNull(), F.col("payload")).alias("payload")
    return decoded.select("user_message", "malformed", payload)
