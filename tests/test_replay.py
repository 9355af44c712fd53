"""What becomes of messages when micro-batches fail and are repeated, and how it is counted."""

import os
import uuid

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluiceway.functions.stamps import element_time
from sluiceway.operators.names import name_rows
from sluiceway.operators.user_messages import encode_greetings
from sluiceway.plans.greetings import (
    ACCOUNTING,
    publish_greetings,
    route_greetings,
    route_greetings_to_folder,
)
from sluiceway.plans.user_messages import ingest_avro, publish_avro
from sluiceway.queries.inputs import new_table
from sluiceway.schemas import MALFORMED_ROW, MESSAGE, NAME_ROW, USER_MESSAGE_ROW
from sluiceway.sinks import topics
from sluiceway.sinks.topics import publish, publish_stream
from sluiceway.sources.offset_log import PublicationLog
from sluiceway.sources.streams import once_within
from sluiceway.sources.tables import read_routes, scan_table
from sluiceway.sources.topics import create_topic, read_subscription, topic_table
from sluiceway.streaming.accounting import Accounts
from sluiceway.streaming.ledger import Ledger
from sluiceway.streaming.writers import append_stream

NAMES = ["A", "B", "AA", "BB", "AAAAA", "BBBBB", "C", "é"]
NOW = {"availableNow": True}


def names_frame(spark, names):
    return spark.createDataFrame([(n,) for n in names], "name string")


def column(spark, table, name="name"):
    return sorted(row[name] for row in scan_table(spark, table).collect())


def forget_commit(checkpoint):
    """Leave a checkpoint as a crash between the write and the commit of batch 0 would."""
    for name in os.listdir(f"{checkpoint}/commits"):
        os.remove(f"{checkpoint}/commits/{name}")


@pytest.fixture(params=[False, True], ids=["listed", "logged"])
def topic(spark, folder, request):
    return create_topic(spark, f"{folder}/topic", log=request.param)


@pytest.fixture
def tables(spark, folder):
    return [new_table(spark, folder, name, NAME_ROW) for name in ("a_names", "b_names")]


def run(spark, topic, tables, folder, **options):
    options = {"trigger": NOW, "ledger": f"{folder}/ledger"} | options
    route_greetings(spark, topic, *tables, f"{folder}/checkpoint", **options).awaitTermination()


def test_crash_between_two_tables_leaves_each_row_once(spark, folder, topic, tables):
    publish_greetings(names_frame(spark, NAMES), topic)
    with pytest.raises(StreamingQueryException, match="no_such_table"):
        run(spark, topic, (tables[0], "no_such_table"), folder)
    assert column(spark, tables[0]) == ["A", "AA"]
    run(spark, topic, tables, folder)
    assert column(spark, tables[0]) == ["A", "AA"] and column(spark, tables[1]) == ["B", "BB"]


def test_repeated_batch_with_malformed_rows(spark, folder, topic, tables):
    malformed = new_table(spark, folder, "malformed", MALFORMED_ROW)
    publish_greetings(names_frame(spark, NAMES), topic)
    publish(spark.createDataFrame([(bytearray(b"bad"),)], "payload binary"), topic)
    for _ in range(3):
        run(spark, topic, tables, folder, malformed_table=malformed)
        forget_commit(f"{folder}/checkpoint")
    assert column(spark, tables[0]) == ["A", "AA"] and column(spark, tables[1]) == ["B", "BB"]
    assert scan_table(spark, malformed).count() == 1


@pytest.mark.parametrize("crash", ["_stage", "_note", "_move"])
def test_crash_within_an_append(spark, folder, tables, monkeypatch, crash):
    """Before it is staged it is written again; after that it is moved, also if half is moved."""
    ledger = Ledger(spark, f"{folder}/ledger")
    rows = names_frame(spark, ["x", "y", "z"]).repartition(3).transform(name_rows)
    table = tables[0]
    moved = []
    step = getattr(Ledger, crash)

    def fail(self, *args):
        if crash == "_move":  # one file is moved, then the driver dies
            rename = self.files.rename
            folder_, name = args
            listed = [p for p in os.listdir(folder_) if p.endswith(".parquet")]
            place = self._detail(self.spark, name, "Location")
            assert rename(self._path(f"{folder_}/{listed[0]}"), self._path(f"{place}/{listed[0]}"))
            moved.append(listed[0])
        elif crash == "_stage":
            step(self, *args)
        raise KeyboardInterrupt

    monkeypatch.setattr(Ledger, crash, fail)
    with pytest.raises(KeyboardInterrupt):
        ledger.append(rows, table, "q", 0)
    monkeypatch.setattr(Ledger, crash, step)
    assert ledger.append(rows, table, "q", 0)
    assert not ledger.append(rows, table, "q", 0)
    assert column(spark, table) == ["x", "y", "z"]
    assert ledger.append(rows, table, "q", 1) and ledger.append(rows, table, "other", 0)
    assert ledger.append(rows, table, "q", 2)
    assert column(spark, table) == sorted("xyz" * 4)
    assert sorted(os.listdir(f"{folder}/ledger/{table}/q")) == ["1", "2"]
    assert len(moved) == (crash == "_move")


def test_ledger_keeps_the_rules_of_the_table(spark, folder):
    table = new_table(spark, folder, "small", T.StructType.fromDDL("name string, timestamp string, more int"))
    ledger = Ledger(spark, f"{folder}/ledger")
    rows = names_frame(spark, ["x"]).withColumn("timestamp", F.lit("2026-01-02T03:04:05Z").cast("timestamp"))
    ledger.append(rows, table, "q", 0)
    assert [tuple(r) for r in scan_table(spark, table).collect()] == [("x", "2026-01-02T03:04:05Z", None)]
    with pytest.raises(Exception, match="extra|EXTRA"):
        ledger.append(rows.withColumn("extra", F.lit(1)), table, "q", 1)


def test_ingest_with_a_ledger(spark, folder, topic):
    table = new_table(spark, folder, "users", USER_MESSAGE_ROW)
    job = (spark, topic, table, f"{folder}/checkpoint")
    ingest_avro(*job, trigger=NOW, ledger=f"{folder}/ledger").awaitTermination()
    publish_avro(spark.createDataFrame([("1", "A", "B")], "id string, first_name string, last_name string"), topic)
    for _ in range(2):
        ingest_avro(*job, trigger=NOW, ledger=f"{folder}/ledger").awaitTermination()
        forget_commit(f"{folder}/checkpoint")
    assert column(spark, table, "id") == ["1"]


def test_published_stream_after_a_crash(spark, folder, topic, monkeypatch):
    """A repeated micro-batch makes the same ids and leaves each message once."""
    source = create_topic(spark, f"{folder}/source")
    publish_greetings(names_frame(spark, NAMES), source)

    def forward():
        stream = read_subscription(spark, source).select("payload", "attributes", "publish_time")
        publish_stream(stream, topic, f"{folder}/checkpoint", NOW).awaitTermination()
        return sorted((r.message_id, bytes(r.payload)) for r in topic_table(spark, topic).collect())

    first = forward()
    assert len(first) == len(NAMES) == len({i for i, _ in first})
    forget_commit(f"{folder}/checkpoint")
    assert forward() == first
    publish_greetings(names_frame(spark, ["later"]), source)
    both = forward()
    assert set(first) < set(both) and len(both) == len(first) + 1
    table = new_table(spark, folder, "received", MESSAGE)
    append_stream(read_subscription(spark, topic), table, f"{folder}/reader", NOW).awaitTermination()
    assert column(spark, table, "message_id") == sorted(i for i, _ in both)


def test_publication_written_but_not_entered(spark, folder, monkeypatch):
    topic = create_topic(spark, f"{folder}/topic", log=True)
    source = create_topic(spark, f"{folder}/source")
    publish_greetings(names_frame(spark, NAMES), source)
    append = PublicationLog.append

    def forward():
        stream = read_subscription(spark, source).select("payload")
        publish_stream(stream, topic, f"{folder}/checkpoint", NOW).awaitTermination()

    monkeypatch.setattr(PublicationLog, "append", lambda *_: 1 / 0)
    with pytest.raises(StreamingQueryException):
        forward()
    monkeypatch.setattr(PublicationLog, "append", append)
    assert topic_table(spark, topic).count() == 0
    forward()
    assert topic_table(spark, topic).count() == len(NAMES)
    forget_commit(f"{folder}/checkpoint")
    forward()
    assert PublicationLog(topic).next() == 1
    assert topics.topic_log(topic).entered(PublicationLog(topic).entry(0)["folder"])


@pytest.fixture
def accounts(spark):
    listener = Accounts(ACCOUNTING)
    spark.streams.addListener(listener)
    yield listener
    spark.streams.removeListener(listener)


@pytest.mark.parametrize("to_folder", [False, True])
def test_accounts(spark, folder, topic, tables, accounts, to_folder):
    malformed = new_table(spark, folder, "malformed", MALFORMED_ROW)
    publish_greetings(names_frame(spark, NAMES), topic)
    publish(spark.createDataFrame([(bytearray(b"bad"),), (None,)], "payload binary"), topic)
    options = {"trigger": NOW, "malformed_table": malformed, "accounting": True}
    if to_folder:
        query = route_greetings_to_folder(spark, topic, f"{folder}/names", f"{folder}/checkpoint", **options)
    else:
        query = route_greetings(spark, topic, *tables, f"{folder}/checkpoint", **options)
    query.awaitTermination()
    (batch,) = accounts.of(query)
    assert batch == {
        "batch": 0, "messages": 10, "a": 2, "b": 2, "rejected": 2, "unrouted": 2, "malformed": 2,
    }
    assert scan_table(spark, malformed).count() == 2
    if to_folder:
        assert read_routes(spark, f"{folder}/names", NAME_ROW).count() == 4


def test_accounts_of_a_job_that_fails_on_malformed_messages(spark, folder, topic, tables, accounts):
    publish_greetings(names_frame(spark, NAMES), topic)
    query = route_greetings(spark, topic, *tables, f"{folder}/checkpoint", trigger=NOW, accounting=True)
    query.awaitTermination()
    (batch,) = accounts.of(query)
    assert batch["messages"] == 8 == sum(batch[k] for k in ("a", "b", "rejected", "unrouted", "malformed"))
    publish(spark.createDataFrame([(bytearray(b"bad"),)], "payload binary"), topic)
    with pytest.raises(StreamingQueryException, match="no second word"):
        run(spark, topic, tables, folder, accounting=True)


def test_redelivery_within_a_bound(spark, folder, topic):
    table = new_table(spark, folder, "received", MESSAGE)
    schema = "message_id string, payload binary, publish_time timestamp"
    time = lambda minute: F.lit(f"2026-01-02T03:{minute:02d}:00Z").cast("timestamp")

    def deliver(*ids, minute):
        rows = spark.createDataFrame([(i, bytearray(b"x"), None) for i in ids], schema)
        publish(rows.withColumn("publish_time", time(minute)), topic)
        messages = once_within(read_subscription(spark, topic), "10 minutes")
        append_stream(messages, table, f"{folder}/checkpoint", NOW).awaitTermination()
        return column(spark, table, "message_id")

    assert deliver("a", "a", "b", minute=0) == ["a", "b"]
    assert deliver("a", "c", minute=5) == ["a", "b", "c"]  # also after a restart
    assert deliver("c", "d", minute=9) == ["a", "b", "c", "d"]


def test_each_row_has_a_time_of_its_own(spark):
    rows = spark.range(20_000, numPartitions=2).transform(
        lambda frame: name_rows(frame.withColumn("name", F.col("id").cast("string")), element_time())
    )
    assert isinstance(rows.schema["timestamp"].dataType, T.TimestampType)
    assert rows.select("timestamp").distinct().count() > 1000
    named = rows.where("timestamp IS NOT NULL").agg(F.min("timestamp"), F.max("timestamp")).head()
    assert named[0] < named[1]


def test_encoded_names_need_no_ids(spark, topic):
    ids = publish(names_frame(spark, NAMES).transform(encode_greetings), topic).collect()
    assert len({i.message_id for i in ids}) == len(NAMES)
    assert all(uuid.UUID(i.message_id[:36]) for i in ids)
