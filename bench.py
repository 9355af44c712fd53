"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the number of local cores. Every query runs
once to warm up, then ``BENCH_RUNS`` times; the best run counts. Results go to Spark's noop
sink, so every row and column is produced and nothing is collected.
"""

import json
import os
import time
import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluiceway.codecs.avro import compile_avro
from sluiceway.operators.records import decode_records, encode_records
from sluiceway.operators.user_messages import (
    decode_avro,
    decode_protobuf,
    encode_avro,
    encode_greetings,
    encode_protobuf,
)
from sluiceway.plans.greetings import route_greetings, routed_names
from sluiceway.plans.user_messages import ingest_avro
from sluiceway.queries.inputs import new_table, scratch_dir, table
from sluiceway.queries.records import ORDER_LINE_AVSC, order_lines
from sluiceway.queries.registry import ALL_AVAILABLE, QUERIES
from sluiceway.schemas import NAME_ROW, USER_MESSAGE_ROW
from sluiceway.sinks.topics import publish
from sluiceway.sources.tables import scan_table
from sluiceway.sources.topics import create_topic

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "2"))

def volume_queries(spark: SparkSession) -> dict:
    """Message tables as long as ``lineitem``, written once, and the work of each job on them."""
    folder = scratch_dir(spark)
    lines = table(spark, SF_DIR, "lineitem")
    names = lines.select(
        F.expr("substring('ABCABCABC', 1 + l_linenumber % 3, 1 + l_orderkey % 6)").alias("name")
    )
    users = lines.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("id"),
        F.concat(F.lit("Part"), F.col("l_partkey")).alias("first_name"),
        F.concat(F.lit("Supplier"), F.col("l_suppkey")).alias("last_name"),
    )

    def stored(rows: DataFrame, name: str) -> DataFrame:
        path = f"{folder}/{name}"
        # Several files, as a topic has, so that every core reads.
        rows.repartition(int(CPUS)).write.parquet(path)
        return spark.read.parquet(path)

    users = stored(users, "users")
    greetings = stored(names.transform(encode_greetings).select("payload"), "greetings")
    avro = stored(users.transform(encode_avro).select("payload"), "avro")
    protobuf = stored(users.transform(encode_protobuf).select("payload"), "protobuf")
    topic = f"{folder}/topic"
    create_topic(spark, topic)
    publish(greetings, topic)
    create_topic(spark, f"{folder}/users")
    publish(avro, f"{folder}/users")

    def routed_by_job() -> DataFrame:
        run = f"{folder}/{uuid.uuid4().hex}"
        tables = [new_table(spark, run, name, NAME_ROW) for name in ("a_names", "b_names")]
        job = route_greetings(spark, topic, *tables, f"{run}/checkpoint", trigger=ALL_AVAILABLE)
        job.awaitTermination()
        return scan_table(spark, tables[0])

    def ingested_by_job() -> DataFrame:
        run = f"{folder}/{uuid.uuid4().hex}"
        table = new_table(spark, run, "user_messages", USER_MESSAGE_ROW)
        ingest_avro(
            spark,
            f"{folder}/users",
            table,
            f"{run}/checkpoint",
            start=datetime(2000, 1, 1, tzinfo=timezone.utc),
            trigger=ALL_AVAILABLE,
        ).awaitTermination()
        return scan_table(spark, table)

    # The last byte of every hundredth payload is no UTF-8.
    bad = F.concat(F.expr("substring(payload, 1, octet_length(payload) - 1)"), F.lit(b"\xff"))
    spoilt = F.when(F.xxhash64("payload") % 100 == 0, bad).otherwise(F.col("payload"))
    avro_bad_text = stored(avro.withColumn("payload", spoilt), "avro_bad_text")
    # Every payload lacks its last byte.
    cut = F.expr("substring(payload, 1, octet_length(payload) - 1)").alias("payload")
    cuts = {name: stored(frame.select(cut), f"{name}_cut") for name, frame in (("avro", avro), ("proto", protobuf))}
    program = compile_avro(ORDER_LINE_AVSC)
    records = stored(order_lines(spark, SF_DIR), "records")
    encoded = stored(records.transform(encode_records, program).select("payload"), "records_avro")
    decoders = {"avro": (decode_avro, avro), "proto": (decode_protobuf, protobuf)}
    quarantine = {
        f"lineitem_{name}_quarantine_{label}": lambda frame=frame, decode=decode: frame.transform(
            decode, "auto", "quarantine"
        ).select("user_message", "malformed")
        for name, (decode, clean) in decoders.items()
        for label, frame in (("clean", clean), ("all_bad", cuts[name]))
    }
    return quarantine | {
        "lineitem_records_encode": lambda: records.transform(encode_records, program).select("payload"),
        "lineitem_records_decode": lambda: encoded.transform(decode_records, program).select("record"),
        "lineitem_route_job": routed_by_job,
        "lineitem_ingest_avro_job": ingested_by_job,
        "lineitem_avro_decode_bad_text": lambda: avro_bad_text.transform(decode_avro).select(
            "user_message"
        ),
        "lineitem_route": lambda: routed_names(greetings),
        "lineitem_avro_encode": lambda: users.transform(encode_avro).select("payload"),
        "lineitem_proto_encode": lambda: users.transform(encode_protobuf).select("payload"),
        "lineitem_avro_decode": lambda: avro.transform(decode_avro).select("user_message"),
        "lineitem_proto_decode": lambda: protobuf.transform(decode_protobuf).select("user_message"),
    }


def best_time(query) -> float:
    times = []
    for _ in range(1 + RUNS):
        started = time.perf_counter()
        query().write.format("noop").mode("overwrite").save()
        times.append(time.perf_counter() - started)
    return round(min(times[1:]), 4)


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("sluiceway-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    plans = {name: lambda name=name: QUERIES[name](spark, SF_DIR) for name in QUERIES}
    plans |= volume_queries(spark)
    times = {name: best_time(query) for name, query in plans.items()}
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_best_query_time",
                "value": round(sum(times.values()), 4),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
