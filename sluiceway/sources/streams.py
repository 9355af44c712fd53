"""Messages from any stream, by naming its columns."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluiceway.schemas import MESSAGE


def as_messages(
    stream: DataFrame,
    payload: str | Column = "value",
    message_id: str | Column | None = "key",
    attributes: str | Column | None = "headers",
    publish_time: str | Column | None = "timestamp",
) -> DataFrame:
    """A frame of messages from a stream (or batch) with columns of its own.

    The defaults fit sources with key, value, headers and timestamp. A part given by name
    that the stream lacks is NULL, except the payload; a Column is taken as it is. Headers
    may be a map or an array of entries with a ``key`` and a ``value``, of which the last of
    equal keys counts.
    """
    parts = {"message_id": message_id, "payload": payload, "attributes": attributes}
    parts["publish_time"] = publish_time
    columns = []
    for field in MESSAGE:
        part = parts[field.name]
        if isinstance(part, str) and (part in stream.columns or field.name == "payload"):
            part = F.col(part)
            if field.name == "attributes" and stream.schema[parts["attributes"]].dataType.typeName() == "array":
                part = _last_of_each_key(part)
        elif part is None or isinstance(part, str):
            part = F.lit(None)
        columns.append(part.cast(field.dataType).alias(field.name))
    return stream.select(*columns)


def once_within(messages: DataFrame, bound: str) -> DataFrame:
    """A stream without repeated deliveries: of messages with the same id whose publish times are
    less than ``bound`` apart (such as ``"10 minutes"``), the first to come stays.

    Ids are kept as state, dealt by id, until the watermark, the latest publish time less the
    bound, has passed theirs; so the state is bounded by the ids of that time. A message without
    an id or a time is dropped by no rule and passes: such rows are set apart before.
    """
    keyed = F.col("message_id").isNotNull() & F.col("publish_time").isNotNull()
    first = messages.where(keyed).withWatermark("publish_time", bound)
    return first.dropDuplicatesWithinWatermark(["message_id"]).unionByName(messages.where(~keyed))


def _last_of_each_key(entries: Column) -> Column:
    texts = F.transform(
        entries,
        lambda e: F.struct(e["key"].cast("string").alias("key"), e["value"].cast("string").alias("value")),
    )
    keys = F.transform(entries, lambda e: e["key"].cast("string"))
    last = F.filter(
        texts,
        lambda e, at: ~F.array_contains(F.slice(keys, at + 2, F.size(keys)), e["key"]),
    )
    return F.map_from_entries(last)
