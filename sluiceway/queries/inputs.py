"""Messages and users derived from the given tables, and places to put results."""

import tempfile
import uuid
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# One publish and processing time for all queries, so that results can be compared.
FIXED_TIME = datetime(2026, 1, 2, 3, 4, 5, 678000, tzinfo=timezone.utc)
FIXED_TIME_TEXT = "2026-01-02T03:04:05.678Z"


def fixed_time() -> Column:
    return F.lit(FIXED_TIME)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def greeted_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``message_id, name``: every word of the conversations, whole; every seventh of a text
    with a character outside the BMP at its end."""
    words = table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", F.posexplode(F.split("text", " ", -1)).alias("place", "word")
    )
    return words.where("word <> ''").select(
        F.concat_ws("-", "conv_id", "turn", "place").alias("message_id"),
        F.concat("word", F.when(F.col("place") % 7 == 0, "\U0001f600").otherwise("")).alias("name"),
    )


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``id, first_name, last_name`` from customer numbers and names."""
    name = F.col("c_name")
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("id"),
        F.split_part(name, F.lit("#"), F.lit(1)).alias("first_name"),
        F.split_part(name, F.lit("#"), F.lit(2)).alias("last_name"),
    )


def document_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``id, first_name, last_name`` where the last name is a whole document."""
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("id"),
        F.col("lang").alias("first_name"),
        F.col("text").alias("last_name"),
    )


def document_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents as payloads."""
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("message_id"),
        F.col("text").cast("binary").alias("payload"),
        F.create_map(F.lit("lang"), F.col("lang")).alias("attributes"),
        fixed_time().alias("publish_time"),
    )


def event_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as messages, published when they happened (their times are UTC)."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("message_id"),
        F.col("event_type").cast("binary").alias("payload"),
        F.concat(F.col("ts").cast("string"), F.lit("Z")).cast("timestamp").alias("publish_time"),
    )


def scratch_dir(spark: SparkSession) -> str:
    """A new folder for one run, under ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of this machine. The folder and all
    in it are removed when the driver ends, as results may be read from it until then.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="sluiceway-")
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared.rstrip('/')}/{uuid.uuid4().hex}")
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path)
    files.deleteOnExit(path)
    return path.toString()


def set_back(spark: SparkSession, folder: str, days: int) -> None:
    """Give the files of a folder a modification time so many days ago, as a mirror may."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    files = system.listFiles(path, True)
    while files.hasNext():
        file = files.next()
        system.setTimes(file.getPath(), file.getModificationTime() - days * 86_400_000, -1)


def new_table(spark: SparkSession, folder: str, name: str, schema: StructType) -> str:
    """An empty table with files under ``folder``; returns its unique name."""
    unique = f"{name}_{uuid.uuid4().hex}"
    spark.catalog.createTable(unique, path=f"{folder}/{name}", source="parquet", schema=schema)
    return unique
