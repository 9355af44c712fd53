"""Topics: Parquet tables of messages, read as streams.

A topic made with ``log=True`` has an offset log, see :mod:`sluiceway.sources.offset_log`; all
functions here use it where there is one. Other topics are listed.

A topic is a folder of files, nested or not, with rows of :data:`sluiceway.schemas.MESSAGE`.
A *subscription* is such a stream with a checkpoint, which is its durable cursor; a read of
the *topic* sees only messages that become visible after the job first started.
"""

from collections.abc import Callable
from datetime import datetime, timezone

from pyarrow.lib import ArrowInvalid, ArrowNotImplementedError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluiceway.schemas import MESSAGE
from sluiceway.sources.offset_log import PublicationLog, read_publications

# Each publication is a folder of its own within the topic.
_NESTED = {"recursiveFileLookup": True}

_ANY_AGE = {"maxFileAge": "36500d"}

_START = T.StructType([T.StructField("start", T.TimestampType())])

#: Messages whose ids one task compares; some 340 bytes each for ids that are made by publishing.
IDS_PER_TASK = 250_000


def create_topic(spark: SparkSession, topic: str, log: bool = False) -> str:
    """Make an empty topic, with an offset log if told; an existing one is left as it is."""
    if log:
        PublicationLog(topic).create()
    else:
        spark.createDataFrame([], MESSAGE).write.mode("ignore").parquet(topic)
    return topic


def topic_log(topic: str) -> PublicationLog | None:
    """The offset log of a topic, if it has one."""
    try:
        log = PublicationLog(topic)
        return log if log.exists() else None
    except (ArrowInvalid, ArrowNotImplementedError, OSError):
        return None  # a store that only Spark reaches


def check_topic(spark: SparkSession, topic: str) -> None:
    """Raise ``FileNotFoundError`` if there is no such topic; lists none of its files."""
    path = spark._jvm.org.apache.hadoop.fs.Path(topic)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        raise FileNotFoundError(f"no topic {topic}")


def topic_table(spark: SparkSession, topic: str) -> DataFrame:
    """All messages of a topic, as a batch. A missing topic raises."""
    log = topic_log(topic)
    if log is not None:
        entries = [log.entry(offset) for offset in range(log.first(), log.next())]
        folders = [f"{log.topic}/{entry['folder']}" for entry in entries]
        if not folders:
            return spark.createDataFrame([], MESSAGE)
        return spark.read.schema(MESSAGE).parquet(*folders)
    return spark.read.schema(MESSAGE).options(**_NESTED).parquet(topic)


def dealt_by_id(messages: DataFrame) -> DataFrame:
    """Messages of a topic, read as a batch, with those of one id in one task, and so many tasks
    that each has a bounded number of ids however many messages there are.

    For a count of distinct ids, which holds all ids of a task: splits of files bound their bytes
    only, and ids that are made one after the other take few. The messages are counted first, for
    which Parquet needs no column. Messages of the same id, or without one, are never split.
    """
    return messages.repartition(1 + messages.count() // IDS_PER_TASK, "message_id")


def read_subscription(
    spark: SparkSession,
    topic: str,
    columns: tuple[str, ...] = (),
    start_offset: int | None = None,
    **options,
) -> DataFrame:
    """Stream of all messages of a topic; the checkpoint of the query is the cursor.

    ``columns`` are those of the messages to read, all by default. For a topic with a log,
    ``start_offset`` is where a new query begins, by default with the first publication that is
    kept; each trigger takes all that is new, and other options are refused.

    For others ``options`` go to the file source. For a large backlog set ``maxFilesPerTrigger`` or
    ``maxBytesPerTrigger``, so that one micro-batch stays a bounded job. Files count
    whatever their age (the source would drop those much older than the newest one), so the
    driver remembers all files of the topic; ``maxFileAge`` bounds that where publications
    are known to arrive in time.
    """
    if topic_log(topic) is not None:
        if options:
            raise ValueError(f"a topic with a log takes no {', '.join(sorted(options))}")
        return read_publications(spark, topic, start_offset, columns)
    options = _NESTED | _ANY_AGE | options
    messages = spark.readStream.schema(MESSAGE).options(**options).parquet(topic)
    return messages.select(*columns) if columns else messages


def read_topic(
    spark: SparkSession, topic: str, start: datetime | None, columns: tuple[str, ...] = (), **options
) -> DataFrame:
    """Stream of the messages published at or after ``start``, by their publish time.

    The bound is pushed to the Parquet scan, so row groups of older messages are skipped.
    Without a start it is the whole subscription.
    """
    if start is None:
        return read_subscription(spark, topic, columns, **options)
    read = (*columns, "publish_time") if columns and "publish_time" not in columns else columns
    messages = read_subscription(spark, topic, read, **options).where(F.col("publish_time") >= F.lit(start))
    return messages.select(*columns) if columns else messages


def unlimited(options: dict) -> dict:
    """Source options without those that cut a backlog into several micro-batches."""
    limits = {"maxfilespertrigger", "maxbytespertrigger"}
    return {name: value for name, value in options.items() if name.lower() not in limits}


def kept_start(spark: SparkSession, checkpoint: str) -> tuple[bool, datetime | None]:
    """Whether the job of this checkpoint has started before, and the start it was given."""
    path = checkpoint.rstrip("/") + "/start_position"
    try:
        kept = spark.read.schema(_START).parquet(path).head()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        kept = None
    if kept is None:  # never started, or stopped before the start was written
        return False, None
    # Rows carry local time without a zone; attach it so the instant is unambiguous.
    return True, None if kept.start is None else kept.start.astimezone(timezone.utc)


def keep_start(spark: SparkSession, checkpoint: str, start: datetime | None) -> None:
    """Note beside the checkpoint that the job has started, and from when if it was told."""
    path = checkpoint.rstrip("/") + "/start_position"
    start = start and start.astimezone(timezone.utc)
    spark.createDataFrame([(start,)], _START).coalesce(1).write.mode("overwrite").parquet(path)


def kept_offset(spark: SparkSession, checkpoint: str, first: Callable[[], int]) -> int:
    """The offset at which the job of this checkpoint first started, noted beside it."""
    path = checkpoint.rstrip("/") + "/start_offset"
    try:
        return spark.read.schema("next bigint").parquet(path).head().next
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
    offset = first()
    spark.createDataFrame([(offset,)], "next bigint").coalesce(1).write.mode("overwrite").parquet(path)
    return offset
