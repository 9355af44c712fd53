"""Write a stream micro-batch by micro-batch: to existing tables, or to a folder.

Tables get every row at least once: a micro-batch that failed half way is appended again. With a
``ledger``, a folder to keep account in, they get it once, see :mod:`sluiceway.streaming.ledger`.
In a folder a repeated micro-batch replaces its first attempt. Malformed messages may go to a
table of their own, in the same micro-batch.

``to_rows`` turns a micro-batch into table rows just before it is appended. Stamping the
processing time there, and not in the stream itself, keeps the time, which is a new literal
in every micro-batch, out of the code that Spark generates and compiles for reading and
decoding; that code is then compiled once for the whole stream.
"""

from collections.abc import Callable, Mapping
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sluiceway.operators.names import take_route
from sluiceway.sinks.tables import append_rows
from sluiceway.streaming.ledger import Ledger

ToRows = Callable[[DataFrame], DataFrame]


def append_stream(
    stream: DataFrame,
    table: str,
    checkpoint: str,
    trigger: Mapping | None = None,
    to_rows: ToRows = lambda batch: batch,
    malformed_table: str | None = None,
    ledger: str | None = None,
) -> StreamingQuery:
    """Append every micro-batch to one table. Returns the running query.

    With a ``malformed_table``, rows whose column ``malformed`` is not NULL go there.
    """
    write = append_batch(table, to_rows, malformed_table, ledger)
    return start_writing(stream, write, checkpoint, trigger)


def append_batch(
    table: str, to_rows: ToRows, malformed_table: str | None, ledger: str | None = None
) -> Callable[[DataFrame, int], None]:
    def write(batch: DataFrame, batch_id: int) -> None:
        append = appender(batch, batch_id, ledger)
        if malformed_table is None:
            append(to_rows(batch), table)
            return
        with _kept(batch):
            append(to_rows(batch.where("malformed IS NULL")), table)
            append(malformed_rows(batch), malformed_table)

    return write


def appender(batch: DataFrame, batch_id: int, ledger: str | None) -> Callable[[DataFrame, str], None]:
    """How the rows of a micro-batch are appended to a table."""
    if ledger is None:
        return append_rows
    account = Ledger(batch.sparkSession, ledger)
    query = query_id(batch)
    return lambda rows, table: account.append(rows, table, query, batch_id)


def query_id(batch: DataFrame) -> str:
    """The id of the query that a micro-batch belongs to, the same after a restart."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")


def pass_over_published(
    stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str
) -> None:
    """Advance a new checkpoint past all that the source has, without reading a row of it.

    The first micro-batch lists what there is and is not written. Anything later, which a
    repeated attempt may find, is. The stream must have no limit of its micro-batches.
    """

    def later(batch: DataFrame, batch_id: int) -> None:
        if batch_id:
            write(batch, batch_id)

    start_writing(stream, later, checkpoint, {"availableNow": True}).awaitTermination()


def malformed_rows(batch: DataFrame) -> DataFrame:
    """Rows ``payload, reason, timestamp`` of the malformed messages of a micro-batch."""
    return batch.where("malformed IS NOT NULL").select(
        "payload", F.col("malformed").alias("reason"), F.current_timestamp().alias("timestamp")
    )


@contextmanager
def _kept(batch: DataFrame):
    """A micro-batch that is computed once and spills to disk; blocks of a lost executor are
    computed again."""
    batch.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield
    finally:
        batch.unpersist()


def append_routes(
    routed: DataFrame,
    tables: Mapping[str, str],
    checkpoint: str,
    trigger: Mapping | None = None,
    to_rows: ToRows = lambda batch: batch,
    malformed_table: str | None = None,
    ledger: str | None = None,
) -> StreamingQuery:
    """Append the rows of each ``route`` to its own table, reading the source once.

    The micro-batch is kept, spilling to disk, until every table has its rows. It holds only
    the routed columns, and whole payloads of malformed messages alone.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        append = appender(batch, batch_id, ledger)
        with _kept(batch):
            for route, table in tables.items():
                append(to_rows(take_route(batch, route)), table)
            if malformed_table is not None:
                append(malformed_rows(batch), malformed_table)

    return start_writing(routed, write, checkpoint, trigger)


def write_routes(
    routed: DataFrame,
    folder: str,
    checkpoint: str,
    trigger: Mapping | None = None,
    to_rows: ToRows = lambda batch: batch,
    malformed_table: str | None = None,
) -> StreamingQuery:
    """Write every micro-batch to files of its own, in a folder for each ``route``.

    Rows are in ``route=…/query_id=…/batch_id=…``. A repeated micro-batch overwrites its own
    files only; another checkpoint, whose batches count from 0 again, has another query id.
    All routes are written in one pass, so nothing is persisted unless malformed messages go to
    a table of their own.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        if malformed_table is None:
            write_routed(batch, batch_id)
            return
        with _kept(batch):
            write_routed(batch.where("malformed IS NULL"), batch_id)
            append_rows(malformed_rows(batch), malformed_table)

    def write_routed(batch: DataFrame, batch_id: int) -> None:
        rows = to_rows(batch).withColumns(
            {"query_id": F.lit(query_id(batch)), "batch_id": F.lit(batch_id).cast("bigint")}
        )
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("route", "query_id", "batch_id").parquet(folder)

    return start_writing(routed, write, checkpoint, trigger)


def start_writing(
    stream: DataFrame,
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    trigger: Mapping | None,
) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()
