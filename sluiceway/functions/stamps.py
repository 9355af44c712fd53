"""Processing time and random ids."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def processing_time(given: Column | None = None) -> Column:
    """``given``, or the current time: one value per query or micro-batch."""
    return F.current_timestamp() if given is None else given


def element_time() -> Column:
    """The time at which each row is made, by the clock of the JVM that makes it.

    For ``processing_time`` of jobs that need more than one value per micro-batch. It costs a
    method call by reflection for each row, and unlike a literal it is no part of generated code.
    """
    now = F.reflect(F.lit("java.time.Instant"), F.lit("now"))
    return now.cast("timestamp")


def instant_text(time: Column) -> Column:
    """A timestamp as ISO-8601 text in UTC, with 0, 3 or 6 digits of second fraction.

    For tables that keep the time in a STRING column; a TIMESTAMP column takes the
    timestamp itself.
    """
    # A local time without a zone, so that no clock change of the session's zone gets in.
    epoch = F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'")
    seconds = F.unix_seconds(time).cast("decimal(18,6)")
    whole = (epoch + F.make_dt_interval(secs=seconds)).cast("string")
    micros = F.pmod(F.unix_micros(time), F.lit(1_000_000))
    fraction = (
        F.when(micros == 0, "")
        .when(micros % 1000 == 0, F.concat(F.lit("."), F.lpad((micros / 1000).cast("int"), 3, "0")))
        .otherwise(F.concat(F.lit("."), F.lpad(micros, 6, "0")))
    )
    return F.concat(F.translate(whole, " ", "T"), fraction, F.lit("Z"))


def random_id() -> Column:
    """A random UUID as text, new for every row and every evaluation."""
    return F.uuid()
