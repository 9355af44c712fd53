"""Greeting jobs: publish greetings; split greeted names over two tables."""

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sluiceway.functions.text import NO_SECOND_WORD
from sluiceway.operators.names import (
    extract_names,
    is_short,
    name_rows,
    route_names,
    route_of,
    short_names,
)
from sluiceway.operators.user_messages import encode_greetings
from sluiceway.sinks.topics import publish
from sluiceway.sources.topics import read_subscription
from sluiceway.streaming.writers import append_routes, write_routes


#: What becomes of messages that are not routed.
FATES = ("rejected", "unrouted", "malformed")
#: The name of the counts of :func:`routed_names`.
ACCOUNTING = "route_accounting"


def routed_names(
    messages: DataFrame, on_malformed: str = "fail", accounting: bool = False
) -> DataFrame:
    """Rows ``route, name`` of the short A and B names in greeting messages.

    With ``on_malformed="quarantine"`` malformed messages are there too, without a route,
    with their ``payload`` and a reason in ``malformed``; both are NULL for names.

    With ``accounting`` the rows are counted by what becomes of them, as observed metrics of the
    name ``route_accounting``: ``messages = a + b + rejected + unrouted + malformed``.
    """
    if on_malformed == "fail" and not accounting:
        names = messages.transform(extract_names).transform(short_names)
        return names.transform(route_names).select("route", "name")
    names = messages.transform(extract_names, on_malformed)
    bad = F.isnull("name")
    short, route = is_short(F.col("name")), route_of(F.col("name"))
    if accounting:
        fate = F.when(bad, "malformed").when(~short, "rejected").otherwise(F.coalesce(route, F.lit("unrouted")))
        # Through a one-element explode, so that the fate is found once and not for each count.
        names = names.select("*", F.explode(F.array(fate)).alias("_fate"))
        counts = [
            F.count(F.when(F.col("_fate") == value, 1)).alias(name)
            for value, name in (("A", "a"), ("B", "b"), *((x, x) for x in FATES))
        ]
        names = names.observe(ACCOUNTING, F.count(F.lit(1)).alias("messages"), *counts)
        kept = F.col("_fate").isin("A", "B", *(["malformed"] if on_malformed == "quarantine" else []))
        route = F.when(F.col("_fate").isin("A", "B"), F.col("_fate"))
    else:
        kept = bad | (short & route.isNotNull())
    columns = [route.alias("route"), "name"]
    if on_malformed == "quarantine":
        columns.append(F.when(bad, F.col("payload")).alias("payload"))
        columns.append(F.when(bad, NO_SECOND_WORD).alias("malformed"))
    return names.where(kept).select(*columns)


def route_greetings(
    spark: SparkSession,
    topic: str,
    a_table: str,
    b_table: str,
    checkpoint: str,
    *,
    processing_time: Column | None = None,
    trigger: Mapping | None = None,
    compact: bool = False,
    malformed_table: str | None = None,
    accounting: bool = False,
    ledger: str | None = None,
    **read_options,
) -> StreamingQuery:
    """Read greetings from a subscription and append short names to the A or B table.

    As :func:`route_greeting_messages` on the messages of a topic.
    """
    return route_greeting_messages(
        read_subscription(spark, topic, columns=("payload",), **read_options),
        a_table,
        b_table,
        checkpoint,
        processing_time=processing_time,
        trigger=trigger,
        compact=compact,
        malformed_table=malformed_table,
        accounting=accounting,
        ledger=ledger,
    )


def route_greeting_messages(
    messages: DataFrame,
    a_table: str,
    b_table: str,
    checkpoint: str,
    *,
    processing_time: Column | None = None,
    trigger: Mapping | None = None,
    compact: bool = False,
    malformed_table: str | None = None,
    accounting: bool = False,
    ledger: str | None = None,
) -> StreamingQuery:
    """Append the short names in a stream of greeting messages to the A or B table.

    A malformed message fails the query, or goes to ``malformed_table`` (``payload, reason,
    timestamp``) if there is one. With ``accounting`` all messages are counted by what becomes of
    them, see :func:`routed_names` and :class:`sluiceway.streaming.accounting.Accounts`. With a
    ``ledger``, a folder for accounts, each row is appended once, also if a micro-batch that
    failed between two tables is repeated.

    Short names are a small part of what is read, and every input split leaves a file in
    each table. ``compact=True`` shuffles the rows, evenly and without a key, into files
    of ``spark.sql.adaptive.advisoryPartitionSizeInBytes``; worth it for large backlogs.
    """

    def to_rows(names: DataFrame) -> DataFrame:
        rows = name_rows(names, processing_time)
        return rows.hint("rebalance") if compact else rows

    return append_routes(
        messages.transform(routed_names, "quarantine" if malformed_table else "fail", accounting),
        {"A": a_table, "B": b_table},
        checkpoint,
        trigger,
        to_rows,
        malformed_table,
        ledger,
    )


def route_greetings_to_folder(
    spark: SparkSession,
    topic: str,
    folder: str,
    checkpoint: str,
    *,
    processing_time: Column | None = None,
    trigger: Mapping | None = None,
    malformed_table: str | None = None,
    accounting: bool = False,
    **read_options,
) -> StreamingQuery:
    """As :func:`route_greetings`, to one folder partitioned by route, each row exactly once.

    Rows of a ``malformed_table`` are appended at least once.
    """
    messages = read_subscription(spark, topic, columns=("payload",), **read_options)
    return write_routes(
        messages.transform(routed_names, "quarantine" if malformed_table else "fail", accounting),
        folder,
        checkpoint,
        trigger,
        to_rows=lambda names: name_rows(names, processing_time, keep=("route",)),
        malformed_table=malformed_table,
    )


def publish_greetings(names: DataFrame, topic: str) -> DataFrame:
    """Publish a greeting of every ``name``; returns the message ids."""
    return names.transform(encode_greetings).transform(publish, topic)
