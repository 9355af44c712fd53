"""Queries of topics with an offset log, and of deliveries that are repeated."""

from datetime import datetime, timedelta, timezone

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluiceway.functions.stamps import element_time, instant_text
from sluiceway.operators.user_messages import encode_avro, encode_greetings
from sluiceway.plans.greetings import ACCOUNTING, publish_greetings, route_greetings
from sluiceway.plans.user_messages import ingest_avro
from sluiceway.queries import inputs
from sluiceway.queries.inputs import fixed_time, new_table, scratch_dir
from sluiceway.schemas import MALFORMED_ROW, MESSAGE, NAME_ROW, USER_MESSAGE_ROW
from sluiceway.sinks.topics import publish, publish_stream
from sluiceway.sources.streams import once_within
from sluiceway.sources.tables import scan_table
from sluiceway.sources.topics import (
    create_topic,
    dealt_by_id,
    kept_offset,
    read_subscription,
    topic_log,
    topic_table,
)
from sluiceway.streaming.accounting import Accounts
from sluiceway.streaming.writers import append_stream

ALL_AVAILABLE = {"availableNow": True}


def read_log_from_now(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in four publications; a reader from now starts after the first, and again after
    each. Publications that it has read are then given up."""
    folder = scratch_dir(spark)
    topic = create_topic(spark, f"{folder}/topic", log=True)
    events = inputs.event_messages(spark, sf_dir)
    table = new_table(spark, folder, "received", MESSAGE)
    log = topic_log(topic)
    for part in range(4):
        publish(events.where(F.col("message_id").cast("bigint") % 4 == part), topic)
        start = kept_offset(spark, f"{folder}/checkpoint", log.next)
        messages = read_subscription(spark, topic, start_offset=start)
        append_stream(messages, table, f"{folder}/checkpoint", ALL_AVAILABLE).awaitTermination()
        log.drop_before(log.next())
    return scan_table(spark, table).select(
        "message_id",
        F.decode("payload", "UTF-8").alias("event_type"),
        instant_text(F.col("publish_time")).alias("publish_time"),
    )


def ingest_log_from_now(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``ingest_avro_from_now``, on a topic with a log."""
    folder = scratch_dir(spark)
    topic = create_topic(spark, f"{folder}/topic", log=True)
    table = new_table(spark, folder, "user_messages", USER_MESSAGE_ROW)
    encoded = inputs.users(spark, sf_dir).transform(encode_avro)
    even = F.col("id").cast("bigint") % 2 == 0
    for part in (even, ~even):
        publish(encoded.where(part), topic)
        ingest_avro(
            spark,
            topic,
            table,
            f"{folder}/checkpoint",
            processing_time=fixed_time(),
            trigger=ALL_AVAILABLE,
        ).awaitTermination()
    rows = scan_table(spark, table)
    return rows.withColumn("timestamp", instant_text(F.col("timestamp")))


def route_accounting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What becomes of all words of the conversations, and of whole documents, as greetings."""
    folder = scratch_dir(spark)
    topic = create_topic(spark, f"{folder}/topic", log=True)
    publish(inputs.greeted_names(spark, sf_dir).transform(encode_greetings).drop("name"), topic)
    publish(inputs.document_messages(spark, sf_dir), topic)
    tables = [new_table(spark, folder, name, NAME_ROW) for name in ("a_names", "b_names")]
    malformed = new_table(spark, folder, "malformed", MALFORMED_ROW)
    accounts = Accounts(ACCOUNTING)
    spark.streams.addListener(accounts)
    try:
        query = route_greetings(
            spark,
            topic,
            *tables,
            f"{folder}/checkpoint",
            trigger=ALL_AVAILABLE,
            malformed_table=malformed,
            accounting=True,
        )
        query.awaitTermination()
        batches = accounts.of(query)
    finally:
        spark.streams.removeListener(accounts)
    counts = [(name, n) for batch in batches for name, n in batch.items() if name != "batch"]
    stored = [("stored " + n, t) for n, t in zip(("a", "b", "malformed"), (*tables, malformed))]
    rows = spark.createDataFrame(counts, "what string, n bigint").groupBy("what").agg(F.sum("n").alias("n"))
    for name, table in stored:
        rows = rows.unionByName(scan_table(spark, table).agg(F.lit(name).alias("what"), F.count(F.lit(1)).alias("n")))
    return rows


def redelivered_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events delivered twice each, half of them again after a restart, arrive once."""
    folder = scratch_dir(spark)
    topic = create_topic(spark, f"{folder}/topic", log=True)
    table = new_table(spark, folder, "received", MESSAGE)
    events = inputs.event_messages(spark, sf_dir)
    for again in (events.unionByName(events), events.where(F.col("message_id").cast("bigint") % 2 == 0)):
        publish(again, topic)
        messages = once_within(read_subscription(spark, topic), "3650 days")
        append_stream(messages, table, f"{folder}/checkpoint", ALL_AVAILABLE).awaitTermination()
    return scan_table(spark, table).select("message_id", F.decode("payload", "UTF-8").alias("event_type"))


def element_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether rows of one evaluation have times of their own, from when they were made."""
    started = F.lit(datetime.now(timezone.utc) - timedelta(minutes=1))
    lines = inputs.table(spark, sf_dir, "lineitem").select("l_returnflag", element_time().alias("time"))
    return lines.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("rows"),
        (F.approx_count_distinct("time") > F.least(F.lit(50), F.count(F.lit(1)) / 10)).alias("many_times"),
        F.min(F.col("time") > started).alias("are_now"),
    )


def _crash_before_commit(spark: SparkSession, checkpoint: str) -> None:
    """Leave a checkpoint as a crash between the last write and its commit would."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/commits")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def route_replayed_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``stream_route_two_sinks``, with a ledger, where the second table is missing at first
    and the micro-batch then comes twice more."""
    folder = scratch_dir(spark)
    topic = create_topic(spark, f"{folder}/topic", log=True)
    publish_greetings(inputs.greeted_names(spark, sf_dir), topic)
    a_table, b_table = (new_table(spark, folder, name, NAME_ROW) for name in ("a_names", "b_names"))
    checkpoint = f"{folder}/checkpoint"
    for b_now in (f"{b_table}_missing", b_table, b_table, b_table):
        query = route_greetings(
            spark,
            topic,
            a_table,
            b_now,
            checkpoint,
            processing_time=fixed_time(),
            trigger=ALL_AVAILABLE,
            ledger=f"{folder}/ledger",
        )
        try:
            query.awaitTermination()
            _crash_before_commit(spark, checkpoint)
        except StreamingQueryException:
            if b_now == b_table:
                raise
    a_rows = scan_table(spark, a_table).withColumn("sink", F.lit("a_names"))
    b_rows = scan_table(spark, b_table).withColumn("sink", F.lit("b_names"))
    return a_rows.unionByName(b_rows).withColumn("timestamp", instant_text(F.col("timestamp")))


def published_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events forwarded from one topic to another by a stream whose micro-batch is repeated, and
    whether their ids are distinct."""
    folder = scratch_dir(spark)
    source, topic = (create_topic(spark, f"{folder}/{name}", log=True) for name in ("source", "topic"))
    publish(inputs.event_messages(spark, sf_dir), source)
    for _ in range(2):
        stream = read_subscription(spark, source).select("payload", "publish_time")
        publish_stream(stream, topic, f"{folder}/checkpoint", ALL_AVAILABLE).awaitTermination()
        _crash_before_commit(spark, f"{folder}/checkpoint")
    messages = topic_table(spark, topic).transform(dealt_by_id)
    return messages.groupBy(F.decode("payload", "UTF-8").alias("event_type")).agg(
        F.count(F.lit(1)).alias("messages"), F.countDistinct("message_id").alias("ids")
    )


QUERIES = {
    "read_log_from_now": read_log_from_now,
    "ingest_log_from_now": ingest_log_from_now,
    "route_accounting": route_accounting,
    "redelivered_once": redelivered_once,
    "route_replayed_once": route_replayed_once,
    "published_stream": published_stream,
    "element_times": element_times,
}
