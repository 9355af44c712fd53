"""Publish: append messages to a topic."""

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sluiceway.schemas import MESSAGE
from sluiceway.sources.topics import check_topic, topic_log
from sluiceway.streaming.writers import query_id, start_writing


def publish(messages: DataFrame, topic: str) -> DataFrame:
    """Append ``messages`` to an existing topic; returns their ids as ``message_id``.

    ``messages`` needs a ``payload``. Missing ``attributes`` are empty, a missing
    ``publish_time`` is now, and a missing ``message_id`` is made here, unique within the
    topic, without a shuffle.

    Each publication has a folder of its own in the topic. The ids are read back from
    there, as evaluating ``messages`` again could give other ids than were written, and
    without listing the rest of the topic. In a topic with a log the publication exists once
    it is entered there, after its messages are written whole.
    """
    return _publish(messages, topic, str(uuid.uuid4()))


def publish_stream(
    messages: DataFrame, topic: str, checkpoint: str, trigger: Mapping | None = None
) -> StreamingQuery:
    """Append a stream of messages to an existing topic. Returns the running query.

    Each micro-batch is a publication named by query and batch, so a repeated one takes the place
    of its first attempt. Ids that are made here are the publication's name, the input split and
    the place within it, which a repeated micro-batch of the same input makes again. In a topic
    with a log a publication is entered once.
    """
    log = topic_log(topic)
    if log is None:
        check_topic(messages.sparkSession, topic)

    def write(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            _publish(batch, topic, f"{query_id(batch)}-{batch_id}", repeated=True)

    return start_writing(messages, write, checkpoint, trigger)


def _publish(messages: DataFrame, topic: str, publication: str, repeated: bool = False) -> DataFrame:
    spark = messages.sparkSession
    log = topic_log(topic)
    if log is None:
        check_topic(spark, topic)
    elif repeated and log.entered(publication):
        return spark.read.schema(MESSAGE).parquet(f"{topic.rstrip('/')}/{publication}").select("message_id")
    made = {
        "attributes": F.create_map().cast(MESSAGE["attributes"].dataType),
        "publish_time": F.current_timestamp(),
        "message_id": F.concat_ws("-", F.lit(publication), F.monotonically_increasing_id()),
    }
    missing = {column: value for column, value in made.items() if column not in messages.columns}
    complete = messages.withColumns(missing).select(
        *(F.col(field.name).cast(field.dataType) for field in MESSAGE)
    )
    folder = f"{topic.rstrip('/')}/{publication}"
    complete.write.mode("overwrite" if repeated else "error").parquet(folder)
    if log is not None:
        log.append(publication)
    return spark.read.schema(MESSAGE).parquet(folder).select("message_id")
