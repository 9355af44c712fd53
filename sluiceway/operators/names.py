"""Names in greeting messages: extract, filter, route, shape."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluiceway.functions.stamps import processing_time as stamp
from sluiceway.functions.text import (
    first_match,
    name_of_word,
    payload_text,
    repaired,
    second_word,
    utf16_shorter_than,
)

# Names must be shorter than this many UTF-16 units; the routes, which are
# the first letters they take, in the order they are tried.
NAME_LENGTH_LIMIT = 5
ROUTES = ("A", "B")


def with_text(messages: DataFrame) -> DataFrame:
    """Add ``text``, the payload as text."""
    return messages.withColumn("text", payload_text(F.col("payload")))


def extract_names(messages: DataFrame, on_malformed: str = "fail") -> DataFrame:
    """Add ``name``, taken out of each greeting.

    With ``on_malformed="quarantine"`` the name of a malformed message is NULL and the row
    stays; the caller sends ``name IS NULL`` wherever malformed messages belong.
    """
    # A space is never part of a malformed UTF-8 sequence, so repairing the word gives the
    # same text as repairing the whole payload first.
    words = messages.withColumn("_word", second_word(F.col("payload").cast("string")))
    words = words.withColumn("_word", repaired(F.col("_word")))
    # The one-element explode makes Spark evaluate the name once. As a plain projection it
    # would be copied into every later filter that tests the name (length, each route).
    name = name_of_word(F.col("_word"), on_malformed)
    return words.select("*", F.explode(F.array(name)).alias("name")).drop("_word")


def is_short(name: Column) -> Column:
    return utf16_shorter_than(name, NAME_LENGTH_LIMIT)


def route_of(name: Column) -> Column:
    """``A`` or ``B`` by first letter, else NULL."""
    return first_match(name, ROUTES)


def short_names(names: DataFrame) -> DataFrame:
    """Keep names of fewer than five UTF-16 units; exactly five is rejected."""
    return names.where(is_short(F.col("name")))


def route_names(names: DataFrame) -> DataFrame:
    """Add ``route``, ``A`` or ``B`` by first letter; names with neither are dropped."""
    return names.withColumn("route", route_of(F.col("name"))).where("route IS NOT NULL")


def take_route(routed: DataFrame, route: str) -> DataFrame:
    """The rows of one route, without the ``route`` column."""
    return routed.where(F.col("route") == route).drop("route")


def name_rows(
    names: DataFrame, processing_time: Column | None = None, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Rows ``name, timestamp`` for a sink table, after any columns to ``keep``."""
    return names.select(*keep, "name", stamp(processing_time).alias("timestamp"))
