"""Topics with an offset log: order, restart, from now, publications under way, retention."""

import threading
import time

import pyarrow.fs as pfs
import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from sluiceway.operators.user_messages import encode_avro, encode_greetings
from sluiceway.plans.greetings import route_greetings
from sluiceway.plans.user_messages import ingest_avro
from sluiceway.queries.inputs import new_table
from sluiceway.schemas import MESSAGE, NAME_ROW, USER_MESSAGE_ROW
from sluiceway.sinks.topics import publish
from sluiceway.sources import offset_log
from sluiceway.sources.offset_log import PublicationLog, PublicationReader, read_publications
from sluiceway.sources.tables import scan_table
from sluiceway.sources.topics import create_topic, read_subscription, topic_table
from sluiceway.streaming.writers import append_stream

ALL_AVAILABLE = {"availableNow": True}


@pytest.fixture
def topic(spark, folder):
    return create_topic(spark, f"{folder}/topic", log=True)


def publish_names(spark, topic, *names):
    rows = spark.createDataFrame([(n, n) for n in names], "name string, message_id string")
    return publish(rows.transform(encode_greetings), topic)


def received(spark, table):
    return sorted(r.message_id for r in scan_table(spark, table).collect())


def take_all(spark, topic, table, folder, **options):
    stream = read_subscription(spark, topic, **options)
    append_stream(stream, table, f"{folder}/checkpoint", ALL_AVAILABLE).awaitTermination()
    return received(spark, table)


def test_offsets_have_no_gaps(folder):
    log = PublicationLog(f"{folder}/topic")
    log.create()
    assert log.first() == log.next() == 0
    threads = [threading.Thread(target=log.append, args=(f"p{i}",)) for i in range(40)]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    assert log.next() == 40 == log.next(0) == log.next(39)
    assert sorted(log.entry(i)["folder"] for i in range(40)) == sorted(f"p{i}" for i in range(40))


def test_restart_reads_what_is_new(spark, folder, topic):
    table = new_table(spark, folder, "received", MESSAGE)
    publish_names(spark, topic, "A", "B")
    publish_names(spark, topic, "C")
    assert take_all(spark, topic, table, folder) == ["A", "B", "C"]
    assert take_all(spark, topic, table, folder) == ["A", "B", "C"]
    publish_names(spark, topic, "D")
    assert take_all(spark, topic, table, folder) == ["A", "B", "C", "D"]
    stored = {r.message_id: r for r in scan_table(spark, table).collect()}
    published = {r.message_id: r for r in topic_table(spark, topic).collect()}
    assert stored == published


def test_publication_exists_once_it_is_entered(spark, folder, topic, monkeypatch):
    """Messages of a publication that never came to its entry are not there, for anyone."""
    table = new_table(spark, folder, "received", MESSAGE)
    publish_names(spark, topic, "A")
    append = PublicationLog.append
    monkeypatch.setattr(PublicationLog, "append", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        publish_names(spark, topic, "lost")
    monkeypatch.setattr(PublicationLog, "append", append)
    publish_names(spark, topic, "B")
    assert take_all(spark, topic, table, folder) == ["A", "B"]
    assert sorted(r.message_id for r in topic_table(spark, topic).collect()) == ["A", "B"]


def test_jobs_read_only_the_payload(spark, folder, topic):
    tables = [new_table(spark, folder, name, NAME_ROW) for name in ("a", "b")]
    publish_names(spark, topic, "Al", "Bo", "Cy")
    route_greetings(spark, topic, *tables, f"{folder}/checkpoint", trigger=ALL_AVAILABLE).awaitTermination()
    assert [[r.name for r in scan_table(spark, t).collect()] for t in tables] == [["Al"], ["Bo"]]
    assert read_publications(spark, topic, columns=("payload",)).columns == ["payload"]


def test_avro_job_from_now_and_in_flight(spark, folder, topic, monkeypatch):
    """Publications before the first start are passed over; one under way then is delivered."""
    table = new_table(spark, folder, "users", USER_MESSAGE_ROW)

    def publish_user(name):
        row = spark.createDataFrame([(name, name, name)], "id string, first_name string, last_name string")
        publish(row.transform(encode_avro), topic)

    def run():
        ingest_avro(spark, topic, table, f"{folder}/checkpoint", trigger=ALL_AVAILABLE).awaitTermination()
        return sorted(r.id for r in scan_table(spark, table).collect())

    publish_user("old")
    entered = []
    append = PublicationLog.append
    monkeypatch.setattr(PublicationLog, "append", lambda log, name: entered.append((log, name)))
    publish_user("under way")
    monkeypatch.setattr(PublicationLog, "append", append)
    assert run() == []
    append(*entered[0])
    assert run() == ["under way"]
    publish_user("new")
    assert run() == ["new", "under way"]


def test_first_start_is_kept(spark, folder, topic):
    """Also if the query never got as far as its first micro-batch."""
    table = new_table(spark, folder, "users", USER_MESSAGE_ROW)
    with pytest.raises(TypeError):
        ingest_avro(spark, topic, table, f"{folder}/checkpoint", trigger={"nonsense": True})
    row = spark.createDataFrame([("1", "A", "B")], "id string, first_name string, last_name string")
    publish(row.transform(encode_avro), topic)
    ingest_avro(spark, topic, table, f"{folder}/checkpoint", trigger=ALL_AVAILABLE).awaitTermination()
    assert [r.id for r in scan_table(spark, table).collect()] == ["1"]


def test_options_of_files_are_refused(spark, topic):
    with pytest.raises(ValueError, match="takes no maxFilesPerTrigger"):
        read_subscription(spark, topic, maxFilesPerTrigger=1)


def test_retention(spark, folder, topic):
    table = new_table(spark, folder, "received", MESSAGE)
    for name in "ABC":
        publish_names(spark, topic, name)
    log = PublicationLog(topic)
    assert log.drop_before(2) == 2 and log.drop_before(2) == 0
    assert log.first() == 2 and log.next() == 3
    assert [r.message_id for r in topic_table(spark, topic).collect()] == ["C"]
    assert take_all(spark, topic, table, folder) == ["C"]
    publish_names(spark, topic, "D")
    publish_names(spark, topic, "E")
    log.drop_before(4)
    with pytest.raises(StreamingQueryException, match="are gone"):
        take_all(spark, topic, table, folder)
    assert log.drop_before(100) == 1
    assert log.first() == log.next() == 5
    publish_names(spark, topic, "F")
    assert log.next() == 6


class CountingFiles:
    def __init__(self, files):
        self.files, self.calls = files, 0

    def __getattr__(self, name):
        self.calls += 1
        return getattr(self.files, name)


def test_work_follows_new_publications_and_not_old_ones(folder):
    log = PublicationLog(f"{folder}/topic")
    log.create()
    for i in range(10_000):
        path = log._path(i)
        if i % 1000 == 0:
            log.files.create_dir(path.rpartition("/")[0])
        with open(path, "w") as out:
            out.write('{"folder": "p", "files": [["p/x.parquet", 10]]}')
    log._note("_hint", 9_990)
    log.files = CountingFiles(pfs.LocalFileSystem())
    started = log.files.calls
    assert log.next(10_000) == 10_000
    assert log.files.calls - started <= 4
    started = log.files.calls
    assert log.next() == 10_000  # a first start
    assert log.files.calls - started <= 20
    started = log.files.calls
    assert log.next(0) == 10_000  # even without a hint
    assert log.files.calls - started <= 40
    reader = PublicationReader(f"{folder}/topic", None, ["payload"])
    began = time.perf_counter()
    for _ in range(20):
        assert reader.latestOffset() == {"next": 10_000}
    assert time.perf_counter() - began < 1
    assert len(reader.partitions({"next": 9_998}, {"next": 10_000})) == 1


def test_splits(folder, monkeypatch):
    monkeypatch.setattr(offset_log, "SPLIT_BYTES", 100)
    log = PublicationLog(f"{folder}/topic")
    log.create()
    sizes = [60, 30, 20, 250, 5]
    monkeypatch.setattr(PublicationLog, "entry", lambda _, i: {"files": [[f"f{i}", sizes[i]]]})
    parts = PublicationReader(f"{folder}/topic", 0, []).partitions({"next": 0}, {"next": 5})
    assert [p.files for p in parts] == [
        [("f0", 0, 1), ("f1", 0, 1)],
        [("f3", 0, 3)],
        [("f3", 1, 3)],
        [("f3", 2, 3)],
        [("f2", 0, 1), ("f4", 0, 1)],
    ]


def test_large_files_are_read_in_shares(spark, folder, topic, monkeypatch):
    rows = spark.range(5000).select(F.col("id").cast("string").alias("message_id"), F.lit(b"x").alias("payload"))
    spark.conf.set("parquet.block.size", "4096")
    publish(rows.coalesce(1), topic)
    spark.conf.unset("parquet.block.size")
    reader = PublicationReader(topic, None, ["message_id"])
    (path, _), = PublicationLog(topic).entry(0)["files"]
    found = [b for nth in range(7) for b in reader.read(offset_log.Part([(path, nth, 7)]))]
    ids = [x for b in found for x in b.column(0).to_pylist()]
    assert sorted(ids, key=int) == [str(i) for i in range(5000)]
