"""The registered queries. Each takes a session and the folder of the given tables."""

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluiceway.functions.stamps import instant_text
from sluiceway.operators.names import (
    extract_names,
    name_rows,
    route_names,
    short_names,
    take_route,
    with_text,
)
from sluiceway.operators.user_messages import (
    decode_avro,
    decode_protobuf,
    encode_avro,
    encode_greetings,
    encode_protobuf,
    with_user_ids,
)
from sluiceway.plans.greetings import (
    publish_greetings,
    route_greetings,
    route_greetings_to_folder,
)
from sluiceway.plans.insert_and_read import insert_and_read
from sluiceway.plans.user_messages import (
    ingest_avro,
    ingest_protobuf,
    publish_avro,
    publish_protobuf,
)
from sluiceway.queries import inputs, records, topics
from sluiceway.queries.inputs import fixed_time, new_table, scratch_dir
from sluiceway.schemas import MALFORMED_ROW, MESSAGE, NAME_ROW, USER_MESSAGE_ROW
from sluiceway.sinks.tables import insert_rows
from sluiceway.sinks.topics import publish
from sluiceway.sources.streams import as_messages
from sluiceway.sources.tables import read_routes, scan_table
from sluiceway.sources.topics import (
    create_topic,
    dealt_by_id,
    read_subscription,
    read_topic,
    topic_table,
)
from sluiceway.streaming.writers import append_stream

Query = Callable[[SparkSession, str], DataFrame]

ALL_AVAILABLE = {"availableNow": True}


def _names(spark: SparkSession, sf_dir: str) -> DataFrame:
    greetings = inputs.greeted_names(spark, sf_dir).transform(encode_greetings)
    return greetings.drop("name").transform(extract_names)


def _routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _names(spark, sf_dir).transform(short_names).transform(route_names)


def _with_time_text(rows: DataFrame, column: str = "timestamp") -> DataFrame:
    return rows.withColumn(column, instant_text(F.col(column)))


def publish_greetings_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    topic = create_topic(spark, scratch_dir(spark))
    names = inputs.greeted_names(spark, sf_dir).withColumn("publish_time", fixed_time())
    publish_greetings(names, topic)
    return topic_table(spark, topic).select(
        "message_id",
        F.hex("payload").alias("payload_hex"),
        F.col("attributes")["first_name"].alias("first_name"),
        instant_text(F.col("publish_time")).alias("publish_time"),
    )


def published_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many ids a publication gives back, and how many of them are distinct."""
    topic = create_topic(spark, scratch_dir(spark))
    ids = publish_greetings(inputs.greeted_names(spark, sf_dir).drop("message_id"), topic)
    return dealt_by_id(ids).agg(
        F.count("message_id").alias("ids"), F.countDistinct("message_id").alias("distinct_ids")
    )


def read_subscription_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_dir(spark)
    topic = create_topic(spark, f"{folder}/topic")
    publish(inputs.document_messages(spark, sf_dir), topic)
    table = new_table(spark, folder, "received", MESSAGE)
    messages = read_subscription(spark, topic)
    append_stream(messages, table, f"{folder}/checkpoint", ALL_AVAILABLE).awaitTermination()
    return scan_table(spark, table).select(
        "message_id",
        F.md5("payload").alias("payload_md5"),
        F.col("attributes")["lang"].alias("lang"),
        instant_text(F.col("publish_time")).alias("publish_time"),
    )


def read_topic_from_now(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_dir(spark)
    topic = create_topic(spark, f"{folder}/topic")
    publish(inputs.event_messages(spark, sf_dir), topic)
    table = new_table(spark, folder, "received", MESSAGE)
    start = inputs.FIXED_TIME.replace(year=2024, month=1, day=15, microsecond=0)
    messages = read_topic(spark, topic, start)
    append_stream(messages, table, f"{folder}/checkpoint", ALL_AVAILABLE).awaitTermination()
    return scan_table(spark, table).select(
        "message_id",
        F.decode("payload", "UTF-8").alias("event_type"),
        instant_text(F.col("publish_time")).alias("publish_time"),
    )


def bytes_to_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = inputs.table(spark, sf_dir, "conversations")
    messages = turns.select("conv_id", "turn", F.col("text").cast("binary").alias("payload"))
    return messages.transform(with_text).select("conv_id", "turn", "text")


def extract_names_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _names(spark, sf_dir).select("message_id", "name")


def extract_names_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = inputs.document_messages(spark, sf_dir).transform(extract_names, "quarantine")
    return names.select("message_id", "name", F.isnull("name").alias("malformed"))


def short_names_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _names(spark, sf_dir).transform(short_names).select("message_id", "name")


def short_names_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = inputs.document_messages(spark, sf_dir).transform(extract_names, "quarantine")
    return names.transform(short_names).select("message_id", "name")


def route_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _routed(spark, sf_dir).transform(take_route, "A").select("message_id", "name")


def route_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _routed(spark, sf_dir).transform(take_route, "B").select("message_id", "name")


def route_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names per route, to see both routes and what is dropped at a glance."""
    return _routed(spark, sf_dir).groupBy("route", "name").agg(F.count(F.lit(1)).alias("names"))


def name_rows_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _routed(spark, sf_dir).transform(name_rows, fixed_time(), keep=("message_id", "route"))
    return _with_time_text(rows)


def stream_route_two_sinks(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_dir(spark)
    topic = create_topic(spark, f"{folder}/topic")
    publish_greetings(inputs.greeted_names(spark, sf_dir), topic)
    a_table = new_table(spark, folder, "a_names", NAME_ROW)
    b_table = new_table(spark, folder, "b_names", NAME_ROW)
    route_greetings(
        spark,
        topic,
        a_table,
        b_table,
        f"{folder}/checkpoint",
        processing_time=fixed_time(),
        trigger=ALL_AVAILABLE,
    ).awaitTermination()
    a_rows = scan_table(spark, a_table).withColumn("sink", F.lit("a_names"))
    b_rows = scan_table(spark, b_table).withColumn("sink", F.lit("b_names"))
    return a_rows.unionByName(b_rows).transform(_with_time_text)


def stream_route_to_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_dir(spark)
    topic = create_topic(spark, f"{folder}/topic")
    publish_greetings(inputs.greeted_names(spark, sf_dir), topic)
    route_greetings_to_folder(
        spark,
        topic,
        f"{folder}/names",
        f"{folder}/checkpoint",
        processing_time=fixed_time(),
        trigger=ALL_AVAILABLE,
    ).awaitTermination()
    rows = read_routes(spark, f"{folder}/names", NAME_ROW).select("name", "timestamp", "route")
    return rows.transform(_with_time_text)


def stream_route_text_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As the job that routes to two tables, which keep their time as text."""
    folder = scratch_dir(spark)
    topic = create_topic(spark, f"{folder}/topic")
    publish_greetings(inputs.greeted_names(spark, sf_dir), topic)
    schema = T.StructType.fromDDL("name string, timestamp string")
    tables = {name: new_table(spark, folder, name, schema) for name in ("a_names", "b_names")}
    route_greetings(
        spark,
        topic,
        *tables.values(),
        f"{folder}/checkpoint",
        processing_time=fixed_time(),
        trigger=ALL_AVAILABLE,
    ).awaitTermination()
    return _union_of(
        scan_table(spark, table).withColumn("sink", F.lit(name)) for name, table in tables.items()
    )


def route_documents_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents as greetings: short A and B names, and the texts that are none."""
    folder = scratch_dir(spark)
    topic = create_topic(spark, f"{folder}/topic")
    publish(inputs.document_messages(spark, sf_dir), topic)
    tables = {name: new_table(spark, folder, name, NAME_ROW) for name in ("a_names", "b_names")}
    malformed = new_table(spark, folder, "malformed", MALFORMED_ROW)
    route_greetings(
        spark,
        topic,
        *tables.values(),
        f"{folder}/checkpoint",
        trigger=ALL_AVAILABLE,
        malformed_table=malformed,
    ).awaitTermination()
    names = [
        scan_table(spark, table).select(F.lit(name).alias("sink"), F.col("name").alias("value"))
        for name, table in tables.items()
    ]
    bad = scan_table(spark, malformed)
    return _union_of([*names, bad.select(F.lit("malformed").alias("sink"), F.md5("payload").alias("value"))])


def read_subscription_late_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A subscription that goes on with files 40 days older than those it has read."""
    folder = scratch_dir(spark)
    topics = create_topic(spark, f"{folder}/topics")
    documents = inputs.document_messages(spark, sf_dir)
    even = F.col("message_id").cast("bigint") % 2 == 0
    table = new_table(spark, folder, "received", MESSAGE)
    for name, part in (("new", even), ("old", ~even)):
        publish(documents.where(part), create_topic(spark, f"{topics}/{name}"))
        if name == "old":
            inputs.set_back(spark, f"{topics}/{name}", days=40)
        append_stream(
            read_subscription(spark, topics), table, f"{folder}/checkpoint", ALL_AVAILABLE
        ).awaitTermination()
    return scan_table(spark, table).select("message_id", F.md5("payload").alias("payload_md5"))


def messages_from_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with the columns of a keyed log, taken as messages."""
    log = inputs.document_messages(spark, sf_dir).select(
        F.col("message_id").cast("binary").alias("key"),
        F.col("payload").alias("value"),
        F.transform(
            F.map_entries("attributes"),
            lambda e: F.struct(e["key"].alias("key"), e["value"].cast("binary").alias("value")),
        ).alias("headers"),
        F.col("publish_time").alias("timestamp"),
    )
    return as_messages(log).select(
        "message_id",
        F.md5("payload").alias("payload_md5"),
        F.col("attributes")["lang"].alias("lang"),
        instant_text(F.col("publish_time")).alias("publish_time"),
    )


def _union_of(frames) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def avro_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _payload_hex(inputs.users(spark, sf_dir).transform(encode_avro))


def avro_encode_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _payload_hex(inputs.document_users(spark, sf_dir).transform(encode_avro))


def proto_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _payload_hex(inputs.users(spark, sf_dir).transform(encode_protobuf))


def proto_encode_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _payload_hex(inputs.document_users(spark, sf_dir).transform(encode_protobuf))


def _payload_hex(encoded: DataFrame) -> DataFrame:
    return encoded.select("id", F.hex("payload").alias("payload_hex"))


def avro_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _avro_round_trip(inputs.users(spark, sf_dir))


def avro_decode_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _avro_round_trip(inputs.document_users(spark, sf_dir))


def proto_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _protobuf_round_trip(inputs.users(spark, sf_dir))


def proto_decode_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _protobuf_round_trip(inputs.document_users(spark, sf_dir))


def _avro_round_trip(users: DataFrame) -> DataFrame:
    payloads = users.transform(encode_avro).select("payload")
    return payloads.transform(decode_avro).select("user_message.*")


def _protobuf_round_trip(users: DataFrame) -> DataFrame:
    payloads = users.transform(encode_protobuf).select("payload")
    return payloads.transform(decode_protobuf).select("user_message.*")


def ingest_avro_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_dir(spark)
    topic = create_topic(spark, f"{folder}/topic")
    # Customers with an even key were published before the job started.
    early = inputs.FIXED_TIME.replace(year=2025)
    users = inputs.users(spark, sf_dir).withColumn(
        "publish_time",
        F.when(F.col("id").cast("bigint") % 2 == 0, F.lit(early)).otherwise(fixed_time()),
    )
    publish_avro(users, topic)
    table = new_table(spark, folder, "user_messages", USER_MESSAGE_ROW)
    ingest_avro(
        spark,
        topic,
        table,
        f"{folder}/checkpoint",
        start=inputs.FIXED_TIME,
        processing_time=fixed_time(),
        trigger=ALL_AVAILABLE,
    ).awaitTermination()
    return scan_table(spark, table).transform(_with_time_text)


def ingest_avro_from_now(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the users are published before the first start, the others before the second,
    with publish times long before either."""
    folder = scratch_dir(spark)
    topic = create_topic(spark, f"{folder}/topic")
    table = new_table(spark, folder, "user_messages", USER_MESSAGE_ROW)
    early = F.lit(inputs.FIXED_TIME.replace(year=2020))
    users = inputs.users(spark, sf_dir).withColumn("publish_time", early)
    even = F.col("id").cast("bigint") % 2 == 0
    for part in (even, ~even):
        publish_avro(users.where(part), topic)
        ingest_avro(
            spark,
            topic,
            table,
            f"{folder}/checkpoint",
            processing_time=fixed_time(),
            trigger=ALL_AVAILABLE,
        ).awaitTermination()
    return scan_table(spark, table).transform(_with_time_text)


def ingest_avro_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every tenth payload lacks its last byte."""
    folder = scratch_dir(spark)
    topic = create_topic(spark, f"{folder}/topic")
    whole = F.col("id").cast("bigint") % 10 != 0
    cut = F.expr("substring(payload, 1, octet_length(payload) - 1)")
    encoded = inputs.users(spark, sf_dir).transform(encode_avro)
    publish(encoded.withColumn("payload", F.when(whole, F.col("payload")).otherwise(cut)), topic)
    table = new_table(spark, folder, "user_messages", USER_MESSAGE_ROW)
    malformed = new_table(spark, folder, "malformed", MALFORMED_ROW)
    ingest_avro(
        spark,
        topic,
        table,
        f"{folder}/checkpoint",
        start=inputs.FIXED_TIME.replace(year=2000),
        trigger=ALL_AVAILABLE,
        malformed_table=malformed,
    ).awaitTermination()
    good = scan_table(spark, table).select(
        F.col("id").alias("value"), "first_name", "last_name", F.lit("user_messages").alias("sink")
    )
    nothing = F.lit(None).cast("string")
    bad = scan_table(spark, malformed).select(
        F.hex("payload").alias("value"),
        nothing.alias("first_name"),
        nothing.alias("last_name"),
        F.col("reason").alias("sink"),
    )
    return good.unionByName(bad)


def ingest_proto_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_dir(spark)
    topic = create_topic(spark, f"{folder}/topic")
    publish_protobuf(inputs.users(spark, sf_dir), topic)
    table = new_table(spark, folder, "user_messages", USER_MESSAGE_ROW)
    ingest_protobuf(
        spark,
        topic,
        table,
        f"{folder}/checkpoint",
        processing_time=fixed_time(),
        trigger=ALL_AVAILABLE,
    ).awaitTermination()
    return scan_table(spark, table).transform(_with_time_text)


def insert_and_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = new_table(spark, scratch_dir(spark), "names", NAME_ROW)
    rows = inputs.greeted_names(spark, sf_dir).transform(name_rows, fixed_time())
    _, inserted = insert_and_read(spark, table, rows)
    return inserted.transform(_with_time_text)


def insert_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports of inserts that fit, and of such whose rows do not."""
    folder = scratch_dir(spark)
    names = new_table(spark, folder, "names", NAME_ROW)
    small = T.StructType.fromDDL("name varchar(3), number int")
    small = new_table(spark, folder, "small", small)
    rows = inputs.greeted_names(spark, sf_dir).transform(name_rows, fixed_time())
    long = F.concat(F.col("name"), F.lit("...")).alias("name")
    wide = F.lit(2**40).alias("number")
    reports = {
        "fits": insert_rows(rows, names),
        "missing column": insert_rows(rows.drop("timestamp"), names),
        "extra column": insert_rows(rows.withColumn("extra", F.lit(1)), names),
        "other type": insert_rows(rows.withColumn("timestamp", F.lit("now")), names),
        "too long": insert_rows(rows.select(long, F.lit(1).alias("number")), small),
        "out of range": insert_rows(rows.select(F.lit("x").alias("name"), wide), small),
        "some too long": insert_rows(rows.select("name", F.lit(1).alias("number")), small, skip_refused=True),
    }
    return spark.createDataFrame(
        [(name, report.rows, report.has_errors) for name, report in reports.items()],
        "insert string, rows bigint, has_errors boolean",
    )


def insert_refusals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each row that a table refuses with its reasons, and the rows that went in."""
    schema = T.StructType.fromDDL("name varchar(3), number int")
    table = new_table(spark, scratch_dir(spark), "small", schema)
    names = inputs.greeted_names(spark, sf_dir)
    rows = names.select("name", (F.octet_length("name").cast("bigint") * 10**9).alias("number"))
    report, inserted = insert_and_read(spark, table, rows, skip_refused=True)
    refused = report.refused.select("name", F.explode("_refusals").alias("refusal"))
    return _union_of(
        [
            inserted.select(F.lit("inserted").alias("what"), "name"),
            refused.select(F.concat_ws(": ", "refusal.column", "refusal.reason").alias("what"), "name"),
        ]
    )


def processing_time_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times as text, with as many digits as each one needs."""
    events = inputs.event_messages(spark, sf_dir)
    time = F.col("publish_time")
    return events.select(
        "message_id",
        instant_text(F.date_trunc("second", time)).alias("to_second"),
        instant_text(F.date_trunc("millisecond", time)).alias("to_millisecond"),
        instant_text(time).alias("to_microsecond"),
    )


def user_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the random id of each user has the form of a random UUID."""
    named = inputs.users(spark, sf_dir).withColumnRenamed("id", "customer").transform(with_user_ids)
    version_4 = "^[0-9a-f]{8}-[0-9a-f]{4}-4[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$"
    return named.select(
        "customer", "first_name", "last_name", F.rlike("id", F.lit(version_4)).alias("is_uuid")
    )


QUERIES: dict[str, Query] = {
    "publish_greetings": publish_greetings_query,
    "published_ids": published_ids,
    "read_subscription": read_subscription_query,
    "read_topic_from_now": read_topic_from_now,
    "bytes_to_text": bytes_to_text,
    "extract_names": extract_names_query,
    "extract_names_documents": extract_names_documents,
    "short_names": short_names_query,
    "short_names_documents": short_names_documents,
    "route_a": route_a,
    "route_b": route_b,
    "route_counts": route_counts,
    "name_rows": name_rows_query,
    "stream_route_two_sinks": stream_route_two_sinks,
    "stream_route_to_folder": stream_route_to_folder,
    "stream_route_text_time": stream_route_text_time,
    "route_documents_quarantine": route_documents_quarantine,
    "read_subscription_late_files": read_subscription_late_files,
    "messages_from_columns": messages_from_columns,
    "avro_encode": avro_encode,
    "avro_encode_documents": avro_encode_documents,
    "proto_encode": proto_encode,
    "proto_encode_documents": proto_encode_documents,
    "avro_decode": avro_decode,
    "avro_decode_documents": avro_decode_documents,
    "proto_decode": proto_decode,
    "proto_decode_documents": proto_decode_documents,
    "ingest_avro": ingest_avro_query,
    "ingest_avro_from_now": ingest_avro_from_now,
    "ingest_avro_quarantine": ingest_avro_quarantine,
    "ingest_proto": ingest_proto_query,
    "insert_and_select": insert_and_select,
    "insert_reports": insert_reports,
    "insert_refusals": insert_refusals,
    "processing_time_text": processing_time_text,
    "user_ids": user_ids,
    **records.QUERIES,
    **topics.QUERIES,
}
