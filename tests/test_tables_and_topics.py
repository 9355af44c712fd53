"""Appending to tables, publishing to topics, and where a stream starts and resumes."""

import glob
import os
import time
from datetime import datetime, timedelta, timezone
from decimal import Decimal

import pytest
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sluiceway.plans.insert_and_read import insert_and_read
from sluiceway.queries.inputs import new_table
from sluiceway.queries.registry import QUERIES
from sluiceway.schemas import MESSAGE, NAME_ROW
from sluiceway.sinks.admission import judged, takes_all
from sluiceway.sinks.tables import append_rows, insert_rows
from sluiceway.sinks.topics import publish
from sluiceway.sources import topics
from sluiceway.sources.tables import scan_table
from sluiceway.sources.topics import (
    create_topic,
    dealt_by_id,
    keep_start,
    kept_start,
    read_subscription,
    read_topic,
    topic_table,
)
from sluiceway.streaming.writers import append_stream

TIME = datetime(2026, 1, 2, 3, 4, 5, 123456, tzinfo=timezone.utc)


@pytest.fixture
def names_table(spark, folder):
    return new_table(spark, folder, "names", NAME_ROW)


def name_frame(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "name string").withColumn("timestamp", F.lit(TIME))


def stored_names(spark, table):
    return sorted(row["name"] for row in scan_table(spark, table).collect())


def test_append_is_by_name(spark, names_table):
    append_rows(name_frame(spark, "A").select("timestamp", "name"), names_table)
    append_rows(name_frame(spark, "B"), names_table)
    assert stored_names(spark, names_table) == ["A", "B"]


def test_column_the_rows_lack_is_null(spark, names_table):
    append_rows(name_frame(spark, "A").drop("timestamp"), names_table)
    assert scan_table(spark, names_table).head().asDict() == {"name": "A", "timestamp": None}


def test_missing_table_is_not_created(spark):
    for append in (append_rows, insert_rows):
        with pytest.raises(AnalysisException) as raised:
            append(name_frame(spark, "A"), "no_such_table")
        assert raised.value.getCondition() == "TABLE_OR_VIEW_NOT_FOUND"
    assert not spark.catalog.tableExists("no_such_table")


def test_table_name_is_an_identifier(spark):
    with pytest.raises(PySparkException):
        scan_table(spark, "names WHERE 1 = 1")


def test_scan_sees_rows_another_session_wrote(spark, names_table):
    assert stored_names(spark, names_table) == []
    other = spark.newSession()
    append_rows(name_frame(other, "A"), names_table)
    assert stored_names(spark, names_table) == ["A"]


def test_insert_and_read(spark, names_table):
    report, rows = insert_and_read(spark, names_table, name_frame(spark, "Name1", "Name2"))
    assert (report.rows, report.has_errors, report.error) == (2, False, None)
    assert sorted(row["name"] for row in rows.collect()) == ["Name1", "Name2"]
    assert {row["timestamp"].microsecond for row in rows.collect()} == {123456}


def rejected_frames(spark):
    fits = name_frame(spark, "A", "B")
    return {
        "extra column": fits.withColumn("extra", F.lit(1)),
        "other column": fits.withColumnRenamed("name", "nam"),
        "text for a time": fits.withColumn("timestamp", F.lit("2026-01-02T03:04:05Z")),
    }


@pytest.mark.parametrize("case", ["extra column", "other column", "text for a time"])
def test_rejected_rows_are_reported_and_none_goes_in(spark, names_table, case):
    report, rows = insert_and_read(spark, names_table, rejected_frames(spark)[case])
    assert report.has_errors and report.rows == 0 and report.error
    assert rows.count() == 0


@pytest.mark.parametrize(
    "kind, value", [("varchar(3)", "'abcd'"), ("tinyint", "1000"), ("decimal(2,0)", "cast(1000 AS decimal(9,0))")]
)
def test_rows_refused_by_a_type_are_reported(spark, folder, kind, value):
    table = new_table(spark, folder, "small", StructType.fromDDL(f"x {kind}"))
    report = insert_rows(spark.range(3).selectExpr(f"{value} AS x"), table)
    assert report.has_errors and report.rows == 0 and report.error
    assert scan_table(spark, table).count() == 0


def test_each_refused_row_has_its_reasons(spark, folder):
    schema = "name varchar(3), code char(2), number tinyint, price decimal(4,1), parts array<int>"
    table = new_table(spark, folder, "small", StructType.fromDDL(schema))
    given = "id int, name string, code string, number int, price decimal(9,2), parts array<bigint>"
    rows = spark.createDataFrame(
        [
            (0, "abc", "xy", 127, Decimal("999.94"), [1]),
            (1, "abcd", "xy", 128, Decimal("1.0"), []),
            (2, "abc   ", "x", -129, None, None),
            (3, None, "xyz", None, Decimal("9999.9"), [2**40]),
            (4, "äöü", None, 0, Decimal("0"), [None, 2]),
        ],
        given,
    )
    report = insert_rows(rows.drop("id"), table)
    assert report.has_errors and report.rows == 0 and scan_table(spark, table).count() == 0
    found = {(r.name, r.code): [tuple(x) for x in r["_refusals"]] for r in report.refused.collect()}
    assert found == {
        ("abcd", "xy"): [("name", "longer than varchar(3)"), ("number", "out of the range of tinyint")],
        ("abc   ", "x"): [("number", "out of the range of tinyint")],
        (None, "xyz"): [
            ("code", "longer than char(2)"),
            ("price", "out of the range of decimal(4,1)"),
            ("parts", "out of the range of array<int>"),
        ],
    }
    assert report.reasons[("number", "out of the range of tinyint")] == 2
    report.release()
    skipping, stored = insert_and_read(spark, table, rows.drop("id"), skip_refused=True)
    assert (skipping.rows, skipping.has_errors) == (2, True)
    assert sorted(r.name for r in stored.collect()) == ["abc", "äöü"]
    assert sum(skipping.reasons.values()) == 6
    skipping.release()


def test_rows_are_evaluated_once(spark, folder):
    """Also where some are refused, so that random ids are reported as they were judged."""
    table = new_table(spark, folder, "small", StructType.fromDDL("name varchar(3), number int"))
    seen = spark.sparkContext.accumulator(0)

    def count(n):
        seen.add(1)
        return n

    counted = F.udf(count, "bigint").asNondeterministic()
    rows = spark.range(50, numPartitions=2).select(F.lit("x").alias("name"), counted("id").alias("number"))
    assert insert_rows(rows, table).rows == 50
    assert seen.value == 50
    big = spark.range(50, numPartitions=2).select(F.lit("x").alias("name"), (counted("id") * 10**8).alias("number"))
    report = insert_rows(big, table, skip_refused=True)
    assert report.rows == 22 and report.refused.count() == 28
    assert seen.value == 100


def test_required_columns(spark):
    schema = StructType.fromDDL("a int not null, b string not null, c string")
    rows = spark.createDataFrame([(1, None), (None, "x")], "a int, c string")
    told = [[tuple(x) for x in r["_refusals"]] for r in judged(rows, schema).orderBy(F.desc_nulls_last("a")).collect()]
    required = "NULL in a required column"
    assert told == [[("b", required)], [("a", required), ("b", required)]]
    assert not takes_all(rows, schema)
    assert takes_all(rows, StructType.fromDDL("A int, C string, d int"))


@pytest.mark.parametrize(
    "expression", ["string(1 / (id - id))", "string(cast('x' AS int))", "string(cast('x' AS timestamp))"]
)
def test_errors_of_the_rows_themselves_raise(spark, names_table, expression):
    rows = spark.range(2).selectExpr(f"{expression} AS name")
    with pytest.raises(PySparkException):
        insert_rows(rows, names_table)


def test_publish_returns_the_written_ids(spark, folder):
    topic = create_topic(spark, f"{folder}/topic")
    payloads = spark.range(1000, numPartitions=7).select(F.encode(F.uuid(), "UTF-8").alias("payload"))
    first, second = publish(payloads, topic), publish(payloads, topic)
    messages = topic_table(spark, topic)
    assert messages.schema == MESSAGE
    assert messages.count() == 2000
    assert messages.select("message_id").distinct().count() == 2000
    assert first.count() == second.count() == 1000
    assert first.union(second).exceptAll(messages.select("message_id")).count() == 0
    assert messages.where("attributes IS NULL OR cardinality(attributes) > 0").count() == 0
    assert messages.where("publish_time IS NULL").count() == 0


def test_publish_keeps_given_ids(spark, folder):
    topic = create_topic(spark, f"{folder}/topic")
    message = spark.createDataFrame([("7", bytearray(b"x"))], "message_id string, payload binary")
    assert [r["message_id"] for r in publish(message, topic).collect()] == ["7"]
    assert [r["message_id"] for r in topic_table(spark, topic).collect()] == ["7"]


def test_publish_to_a_missing_topic_fails(spark, folder):
    message = spark.createDataFrame([(bytearray(b"x"),)], "payload binary")
    with pytest.raises(FileNotFoundError):
        publish(message, f"{folder}/nowhere")
    with pytest.raises(AnalysisException) as raised:
        topic_table(spark, f"{folder}/nowhere")
    assert raised.value.getCondition() == "PATH_NOT_FOUND"


def test_creating_a_topic_again_keeps_its_messages(spark, folder):
    topic = create_topic(spark, f"{folder}/topic")
    publish(spark.createDataFrame([(bytearray(b"x"),)], "payload binary"), topic)
    create_topic(spark, topic)
    assert topic_table(spark, topic).count() == 1


def test_start_is_kept_with_the_checkpoint(spark, folder):
    assert kept_start(spark, f"{folder}/checkpoint") == (False, None)
    keep_start(spark, f"{folder}/checkpoint", None)
    assert kept_start(spark, f"{folder}/checkpoint/") == (True, None)
    given = datetime(2026, 1, 2, 3, 4, 5, 123456, tzinfo=timezone(timedelta(hours=5)))
    keep_start(spark, f"{folder}/other", given)
    assert kept_start(spark, f"{folder}/other") == (True, given)


def test_files_much_older_than_the_newest_are_read(spark, folder):
    topic = create_topic(spark, f"{folder}/topic")
    table = new_table(spark, folder, "received", MESSAGE)

    def run():
        append_stream(
            read_subscription(spark, topic), table, f"{folder}/checkpoint", {"availableNow": True}
        ).awaitTermination()
        return sorted(bytes(r["payload"]) for r in scan_table(spark, table).collect())

    publish(spark.createDataFrame([(bytearray(b"new"),)], "payload binary"), topic)
    assert run() == [b"new"]
    before = set(glob.glob(f"{topic}/**/*.parquet", recursive=True))
    publish(spark.createDataFrame([(bytearray(b"old"),)], "payload binary"), topic)
    for path in set(glob.glob(f"{topic}/**/*.parquet", recursive=True)) - before:
        os.utime(path, (time.time() - 40 * 86400,) * 2)
    assert run() == [b"new", b"old"]


def test_time_becomes_text_in_a_string_column(spark, folder):
    table = new_table(spark, folder, "names", StructType.fromDDL("name string, timestamp string"))
    append_rows(name_frame(spark, "A"), table)
    assert insert_rows(name_frame(spark, "B"), table).rows == 1
    assert {r["timestamp"] for r in scan_table(spark, table).collect()} == {"2026-01-02T03:04:05.123456Z"}


def test_start_is_pushed_to_the_scan(spark, folder):
    topic = create_topic(spark, f"{folder}/topic")
    messages = spark.createDataFrame(
        [("old", bytearray(b"x"), datetime(2026, 1, 1)), ("new", bytearray(b"y"), datetime(2026, 1, 3))],
        "message_id string, payload binary, publish_time timestamp",
    )
    publish(messages, topic)
    start = datetime(2026, 1, 2, tzinfo=timezone.utc)
    query = (
        read_topic(spark, topic, start)
        .select("payload")
        .writeStream.format("memory")
        .queryName("started")
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    plan = query._jsq.explainInternal(False)
    assert [bytes(r["payload"]) for r in spark.table("started").collect()] == [b"y"]
    assert "GreaterThanOrEqual(publish_time" in plan
    assert "ReadSchema: struct<payload:binary,publish_time:timestamp>" in plan


def test_messages_are_dealt_by_id_to_bounded_tasks(spark, folder, monkeypatch):
    """One file of one row group, with ids that come twice and messages without an id."""
    monkeypatch.setattr(topics, "IDS_PER_TASK", 100)
    topic = create_topic(spark, f"{folder}/topic", log=True)
    rows = [(str(i % 1000) if i < 2000 else None, bytearray(b"x")) for i in range(2010)]
    publish(spark.createDataFrame(rows, "message_id string, payload binary").coalesce(1), topic)
    table = topic_table(spark, topic)
    dealt = dealt_by_id(table).select("message_id", F.spark_partition_id().alias("task")).collect()
    assert sorted(str(r.message_id) for r in dealt) == sorted(str(i) for i, _ in rows)
    tasks = {}
    for r in dealt:
        tasks.setdefault(r.message_id, set()).add(r.task)
    assert all(len(t) == 1 for t in tasks.values())
    ids = [next(iter(t)) for t in tasks.values()]
    assert max(ids.count(t) for t in ids) <= 100
    assert dealt_by_id(table.where("false")).count() == 0


@pytest.mark.parametrize("name", ["published_stream", "published_ids"])
def test_ids_are_counted_in_bounded_tasks(spark, folder, monkeypatch, name):
    """No task of the count meets the ids of a whole input split, however many there are."""
    monkeypatch.setattr(topics, "IDS_PER_TASK", 100)
    events = spark.range(1000).select(
        F.col("id").alias("event_id"),
        F.lit("2024-01-01 00:00:11").cast("timestamp_ntz").alias("ts"),
        F.when(F.col("id") % 3 == 0, "view").when(F.col("id") % 3 == 1, "click").alias("event_type"),
    )
    events.coalesce(1).write.parquet(f"{folder}/events.parquet")
    turns = spark.range(100).selectExpr("id AS conv_id", "0L AS turn", "repeat('a b ', 5) AS text")
    turns.coalesce(1).write.parquet(f"{folder}/conversations.parquet")
    counts = QUERIES[name](spark, folder)
    if name == "published_stream":
        expected = {(None, 333, 333), ("click", 333, 333), ("view", 334, 334)}
    else:
        expected = {(1000, 1000)}
    assert {tuple(r) for r in counts.collect()} == expected
    plan = counts._jdf.queryExecution().executedPlan().toString()
    scanned = plan.split("Initial Plan")[-1].rpartition("Scan parquet")[0]
    below = scanned.rpartition("Exchange hashpartitioning(message_id")[2]
    assert "11), REPARTITION_BY_NUM" in below and "Aggregate" not in below
