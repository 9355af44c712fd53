"""The streaming jobs: results, restart, replay, missing tables."""

import os
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sluiceway.operators.names import name_rows, take_route
from sluiceway.operators.user_messages import encode_greetings
from sluiceway.plans.greetings import (
    publish_greetings,
    route_greeting_messages,
    route_greetings,
    route_greetings_to_folder,
    routed_names,
)
from sluiceway.plans.user_messages import (
    ingest_avro,
    ingest_avro_messages,
    ingest_protobuf,
    publish_avro,
    publish_protobuf,
)
from sluiceway.queries.inputs import new_table
from sluiceway.schemas import MALFORMED_ROW, NAME_ROW, USER_MESSAGE_ROW
from sluiceway.sinks.topics import publish
from sluiceway.sources.streams import as_messages
from sluiceway.sources.tables import read_routes, scan_table
from sluiceway.sources.topics import create_topic, topic_table

NAMES = ["A", "B", "AA", "BB", "AAAAA", "BBBBB"]
NOW = {"availableNow": True}
TIME = datetime(2026, 1, 2, 3, 4, 5, tzinfo=timezone.utc)


def names_frame(spark, names):
    return spark.createDataFrame([(n,) for n in names], "name string")


def users_frame(spark, *names):
    return spark.createDataFrame([(n, n, n) for n in names], "id string, first_name string, last_name string")


def column(spark, table, name="name"):
    return sorted(row[name] for row in scan_table(spark, table).collect())


@pytest.fixture
def topic(spark, folder):
    return create_topic(spark, f"{folder}/topic")


@pytest.fixture
def tables(spark, folder):
    return [new_table(spark, folder, name, NAME_ROW) for name in ("a_names", "b_names")]


@pytest.fixture
def user_table(spark, folder):
    return new_table(spark, folder, "user_messages", USER_MESSAGE_ROW)


def test_greetings_split_over_two_tables(spark, folder, topic, tables):
    ids = publish_greetings(names_frame(spark, NAMES), topic)
    assert ids.distinct().count() == len(NAMES)
    query = route_greetings(spark, topic, *tables, f"{folder}/checkpoint", trigger=NOW)
    query.awaitTermination()
    assert [column(spark, table) for table in tables] == [["A", "AA"], ["B", "BB"]]
    stamps = scan_table(spark, tables[0]).select("timestamp").collect()
    age = datetime.now(timezone.utc) - stamps[0]["timestamp"].astimezone(timezone.utc)
    assert timedelta(0) <= age < timedelta(minutes=5)
    assert query.lastProgress.numInputRows == len(NAMES)  # one read for both tables


def test_stream_equals_batch(spark, folder, topic, tables):
    names = [prefix + "x" * n for prefix in "ABCab" for n in range(7)]
    publish_greetings(names_frame(spark, names), topic)
    route_greetings(
        spark, topic, *tables, f"{folder}/checkpoint", processing_time=F.lit(TIME), trigger=NOW
    ).awaitTermination()
    batch = topic_table(spark, topic).transform(routed_names)
    for route, table in zip("AB", tables):
        expected = batch.transform(take_route, route).transform(name_rows, F.lit(TIME))
        assert sorted(scan_table(spark, table).collect()) == sorted(expected.collect())


def test_time_as_text_for_a_string_column(spark, folder, topic):
    schema = "name string, timestamp string"
    tables = [new_table(spark, folder, name, StructType.fromDDL(schema)) for name in ("a", "b")]
    publish_greetings(names_frame(spark, NAMES), topic)
    route_greetings(
        spark,
        topic,
        *tables,
        f"{folder}/checkpoint",
        processing_time=F.lit(TIME),
        trigger=NOW,
    ).awaitTermination()
    assert column(spark, tables[0], "timestamp") == ["2026-01-02T03:04:05Z"] * 2


def test_compact_files(spark, folder, topic, tables):
    publish_greetings(names_frame(spark, ["A", "B"] * 50).repartition(8), topic)
    route_greetings(
        spark, topic, *tables, f"{folder}/checkpoint", trigger=NOW, compact=True
    ).awaitTermination()
    for table, name in zip(tables, "AB"):
        assert column(spark, table) == [name] * 50
        assert len(scan_table(spark, table).inputFiles()) == 1


def test_restart_goes_on_where_it_stopped(spark, folder, topic, tables):
    for names, expected in ((["A", "B"], ["A"]), ([], ["A"]), (["AB"], ["A", "AB"])):
        if names:
            publish_greetings(names_frame(spark, names), topic)
        route_greetings(
            spark, topic, *tables, f"{folder}/checkpoint", trigger=NOW, maxFilesPerTrigger=1
        ).awaitTermination()
        assert column(spark, tables[0]) == expected
    assert column(spark, tables[1]) == ["B"]


def test_failed_batch_is_written_again(spark, folder, topic, tables):
    """A failure between the two tables repeats the batch: nothing is lost."""
    publish_greetings(names_frame(spark, NAMES), topic)
    job = (spark, topic, tables[0])
    with pytest.raises(StreamingQueryException, match="TABLE_OR_VIEW_NOT_FOUND"):
        route_greetings(*job, "no_such_table", f"{folder}/checkpoint", trigger=NOW).awaitTermination()
    route_greetings(*job, tables[1], f"{folder}/checkpoint", trigger=NOW).awaitTermination()
    assert column(spark, tables[1]) == ["B", "BB"]
    assert set(column(spark, tables[0])) == {"A", "AA"}
    assert not spark.catalog.tableExists("no_such_table")


def forget_commit(checkpoint):
    """Leave a checkpoint as a crash between the write and the commit of batch 0 would."""
    for name in os.listdir(f"{checkpoint}/commits"):
        os.remove(f"{checkpoint}/commits/{name}")


def test_repeated_batch_is_appended_at_least_once(spark, folder, topic, tables):
    publish_greetings(names_frame(spark, NAMES), topic)
    for _ in range(2):
        route_greetings(spark, topic, *tables, f"{folder}/checkpoint", trigger=NOW).awaitTermination()
        forget_commit(f"{folder}/checkpoint")
    assert set(column(spark, tables[0])) == {"A", "AA"}
    assert set(column(spark, tables[1])) == {"B", "BB"}


def test_repeated_batch_replaces_its_files(spark, folder, topic):
    publish_greetings(names_frame(spark, NAMES), topic)

    def run(checkpoint):
        query = route_greetings_to_folder(
            spark, topic, f"{folder}/names", f"{folder}/{checkpoint}", trigger=NOW
        )
        query.awaitTermination()
        rows = read_routes(spark, f"{folder}/names", NAME_ROW).select("route", "name").collect()
        return sorted(tuple(row) for row in rows)

    once = [("A", "A"), ("A", "AA"), ("B", "B"), ("B", "BB")]
    assert run("first") == once
    forget_commit(f"{folder}/first")
    assert run("first") == once
    assert run("second") == sorted(once * 2)  # a new subscription reads everything again


def test_malformed_greeting_stops_the_job(spark, folder, topic, tables):
    good = names_frame(spark, NAMES).transform(encode_greetings).select("payload")
    bad = spark.createDataFrame([(bytearray(b"Hello"),)], "payload binary")
    publish(good.union(bad), topic)
    with pytest.raises(StreamingQueryException, match="malformed greeting"):
        route_greetings(spark, topic, *tables, f"{folder}/checkpoint", trigger=NOW).awaitTermination()
    assert [column(spark, table) for table in tables] == [[], []]


def test_job_does_not_wait(spark, folder, topic, tables):
    query = route_greetings(spark, topic, *tables, f"{folder}/checkpoint")
    try:
        assert query.isActive
        publish_greetings(names_frame(spark, NAMES), topic)
        query.processAllAvailable()
        assert column(spark, tables[1]) == ["B", "BB"]
    finally:
        query.stop()


def test_avro_job_starts_from_now(spark, folder, topic, user_table):
    publish_avro(users_frame(spark, "before"), topic)
    checkpoint = f"{folder}/checkpoint"
    ingest_avro(spark, topic, user_table, checkpoint, trigger=NOW).awaitTermination()
    assert column(spark, user_table, "id") == []
    publish_avro(users_frame(spark, "after"), topic)  # while the job is down
    ingest_avro(spark, topic, user_table, checkpoint, trigger=NOW).awaitTermination()
    assert column(spark, user_table, "id") == ["after"]


def test_protobuf_job_takes_the_whole_subscription(spark, folder, topic, user_table):
    publish_protobuf(users_frame(spark, "before"), topic)
    checkpoint = f"{folder}/checkpoint"
    ingest_protobuf(
        spark, topic, user_table, checkpoint, trigger=NOW, processing_time=F.lit(TIME)
    ).awaitTermination()
    row = scan_table(spark, user_table).withColumn("timestamp", F.col("timestamp").cast("string"))
    assert tuple(row.head()) == ("before", "before", "before", "2026-01-02 03:04:05")


@pytest.mark.parametrize(
    "publish_users, ingest", [(publish_avro, ingest_avro), (publish_protobuf, ingest_protobuf)]
)
def test_undecodable_message_stops_the_job(spark, folder, topic, user_table, publish_users, ingest):
    start = {"start": datetime(2020, 1, 1, tzinfo=timezone.utc)} if ingest is ingest_avro else {}
    publish_users(users_frame(spark, "x").drop("id"), topic)
    publish(spark.createDataFrame([(bytearray(b"\x0a\x02"),)], "payload binary"), topic)
    with pytest.raises(StreamingQueryException, match="truncated"):
        ingest(spark, topic, user_table, f"{folder}/checkpoint", trigger=NOW, **start).awaitTermination()
    assert column(spark, user_table, "id") == []


def test_folder_without_a_routed_row_is_empty(spark, folder, topic):
    publish_greetings(names_frame(spark, ["C", "D"]), topic)
    query = route_greetings_to_folder(spark, topic, f"{folder}/names", f"{folder}/c", trigger=NOW)
    query.awaitTermination()
    assert read_routes(spark, f"{folder}/names", NAME_ROW).collect() == []
    publish_greetings(names_frame(spark, ["A"]), topic)
    route_greetings_to_folder(spark, topic, f"{folder}/names", f"{folder}/c", trigger=NOW).awaitTermination()
    assert sorted(os.listdir(f"{folder}/names"))[-1] == "route=A"
    assert column_of(read_routes(spark, f"{folder}/names", NAME_ROW)) == ["A"]


def column_of(frame, name="name"):
    return sorted(row[name] for row in frame.collect())


def early(users):
    """A publication that began long before it became visible."""
    return users.withColumn("publish_time", F.lit(datetime(2020, 1, 1, tzinfo=timezone.utc)))


def test_publication_under_way_at_the_first_start_is_delivered(spark, folder, topic, user_table):
    publish_avro(users_frame(spark, "before"), topic)
    checkpoint = f"{folder}/checkpoint"
    ingest_avro(spark, topic, user_table, checkpoint, trigger=NOW, maxFilesPerTrigger=1).awaitTermination()
    publish_avro(early(users_frame(spark, "under way")), topic)
    for _ in range(2):
        ingest_avro(spark, topic, user_table, checkpoint, trigger=NOW).awaitTermination()
        assert column(spark, user_table, "id") == ["under way"]


def test_old_messages_are_passed_over_unread(spark, folder, topic, user_table):
    publish(spark.createDataFrame([(bytearray(b"no message"),)], "payload binary"), topic)
    ingest_avro(spark, topic, user_table, f"{folder}/checkpoint", trigger=NOW).awaitTermination()
    assert column(spark, user_table, "id") == []


def test_crash_before_the_start_is_noted(spark, folder, topic, user_table):
    checkpoint = f"{folder}/checkpoint"
    publish_avro(users_frame(spark, "before"), topic)
    ingest_avro(spark, topic, user_table, checkpoint, trigger=NOW).awaitTermination()
    # As if the job had died after passing over what there was.
    os.rename(f"{checkpoint}/start_position", f"{folder}/elsewhere")
    publish_avro(early(users_frame(spark, "after")), topic)
    ingest_avro(spark, topic, user_table, checkpoint, trigger=NOW).awaitTermination()
    assert column(spark, user_table, "id") == ["after"]
    # And as if before that was committed.
    os.rename(f"{checkpoint}/start_position", f"{folder}/elsewhere2")
    forget_commit(checkpoint)
    ingest_avro(spark, topic, user_table, checkpoint, trigger=NOW).awaitTermination()
    assert set(column(spark, user_table, "id")) == {"after"}


def test_malformed_greetings_in_a_table_of_their_own(spark, folder, topic, tables):
    malformed = new_table(spark, folder, "malformed", MALFORMED_ROW)
    good = names_frame(spark, [*NAMES, "C"]).transform(encode_greetings).select("payload")
    bad = spark.createDataFrame([(bytearray(b"Hello"),), (None,)], "payload binary")
    publish(good.union(bad), topic)
    route_greetings(
        spark, topic, *tables, f"{folder}/checkpoint", trigger=NOW, malformed_table=malformed
    ).awaitTermination()
    assert [column(spark, table) for table in tables] == [["A", "AA"], ["B", "BB"]]
    rows = scan_table(spark, malformed).collect()
    assert sorted(bytes(r["payload"] or b"") for r in rows) == [b"", b"Hello"]
    assert all("second word" in r["reason"] and r["timestamp"] for r in rows)


@pytest.mark.parametrize(
    "publish_users, ingest", [(publish_avro, ingest_avro), (publish_protobuf, ingest_protobuf)]
)
def test_undecodable_messages_in_a_table_of_their_own(
    spark, folder, topic, user_table, publish_users, ingest
):
    malformed = new_table(spark, folder, "malformed", MALFORMED_ROW)
    start = {"start": datetime(2020, 1, 1, tzinfo=timezone.utc)} if ingest is ingest_avro else {}
    users = [f"u{i}" for i in range(300)]
    publish_users(users_frame(spark, *users), topic)
    bad = [(bytearray(b"\x0a\x02"),), (bytearray(b""),), (None,)]
    publish(spark.createDataFrame(bad, "payload binary").coalesce(1), topic)
    ingest(
        spark, topic, user_table, f"{folder}/c", trigger=NOW, malformed_table=malformed, **start
    ).awaitTermination()
    assert column(spark, user_table, "id") == sorted(users)
    rows = scan_table(spark, malformed).collect()
    assert len(rows) == 3 and all(r["reason"] for r in rows)


def test_missing_malformed_table_fails(spark, folder, topic, user_table):
    publish_protobuf(users_frame(spark, "x"), topic)
    with pytest.raises(StreamingQueryException, match="TABLE_OR_VIEW_NOT_FOUND"):
        ingest_protobuf(
            spark, topic, user_table, f"{folder}/c", trigger=NOW, malformed_table="no_such_table"
        ).awaitTermination()


def test_jobs_run_from_any_stream(spark, folder, tables, user_table):
    rate = spark.readStream.format("rate-micro-batch").options(rowsPerBatch=10, numPartitions=2).load()
    greetings = rate.select(F.concat(F.lit("Hello A"), F.col("value"), F.lit("!")).alias("value"), "timestamp")
    route_greeting_messages(as_messages(greetings), *tables, f"{folder}/a", trigger=NOW).awaitTermination(60)
    users = rate.select(F.expr("X'023102410242'").alias("body"), "timestamp")
    ingest_avro_messages(
        as_messages(users, payload="body"), user_table, f"{folder}/b", trigger=NOW
    ).awaitTermination(60)
    assert "A3" in column(spark, tables[0])
    assert set(column(spark, user_table, "id")) == {"1"}


def test_messages_from_a_keyed_log(spark):
    rows = [(bytearray(b"k"), bytearray(b"v"), [("h", bytearray(b"1")), ("h", bytearray(b"2"))], TIME)]
    schema = "key binary, value binary, headers array<struct<key:string,value:binary>>, timestamp timestamp"
    frame = spark.createDataFrame(rows, schema)
    message = as_messages(frame).head()
    assert (message["message_id"], bytes(message["payload"])) == ("k", b"v")
    assert message["attributes"] == {"h": "2"}
    bare = as_messages(frame.select(F.col("value").alias("x")), payload="x").head()
    assert bare["message_id"] is bare["attributes"] is bare["publish_time"] is None
