"""Queries of records of any schema: lines of orders as Avro and Protobuf, there and back."""

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluiceway.codecs.avro import compile_avro
from sluiceway.codecs.protobuf import compile_protobuf
from sluiceway.functions.stamps import instant_text
from sluiceway.operators.records import decode_records, encode_records
from sluiceway.operators.user_messages import encode_protobuf
from sluiceway.plans.records import ingest_records, publish_records
from sluiceway.plans.user_messages import ingest_protobuf
from sluiceway.queries import inputs
from sluiceway.queries.inputs import fixed_time, new_table, scratch_dir
from sluiceway.schemas import MALFORMED_ROW, USER_MESSAGE_ROW
from sluiceway.sinks.topics import publish
from sluiceway.sources.tables import scan_table
from sluiceway.sources.topics import create_topic

ALL_AVAILABLE = {"availableNow": True}

ORDER_LINE_AVSC = json.dumps(
    {
        "type": "record",
        "name": "OrderLine",
        "fields": [
            {"name": "order_key", "type": "long"},
            {"name": "line_number", "type": "int"},
            {"name": "closed", "type": "boolean"},
            {"name": "discount", "type": ["null", "double"]},
            {"name": "flag", "type": {"type": "enum", "name": "Flag", "symbols": ["A", "N", "R"]}},
            {
                "name": "part",
                "type": {
                    "type": "record",
                    "name": "Part",
                    "fields": [{"name": "part_key", "type": "long"}, {"name": "supp_key", "type": ["long", "null"]}],
                },
            },
            {"name": "amounts", "type": {"type": "array", "items": "double"}},
            {"name": "numbers", "type": {"type": "array", "items": "int"}},
            {"name": "shipped", "type": {"type": "long", "logicalType": "timestamp-micros"}},
        ],
    }
)

# The serialized FileDescriptorSet of
#   syntax = "proto2";  package orders;
#   enum Flag { A = 0; N = 1; R = 2; }
#   message Part { required int64 part_key = 1; optional sint64 supp_key = 2; }
#   message OrderLine {
#     required int64 order_key = 1;  required int32 line_number = 2;  optional bool closed = 3;
#     optional double discount = 4;  optional Flag flag = 5;  optional Part part = 6;
#     repeated double amounts = 7 [packed = true];  repeated int32 numbers = 8;
#   }
ORDER_LINE_DESCRIPTOR_HEX = (
    "0a99020a106f726465725f6c696e652e70726f746f12066f7264657273222a0a045061727412100a08706172"
    "745f6b657918012002280312100a08737570705f6b657918022001281222b3010a094f726465724c696e6512"
    "110a096f726465725f6b657918012002280312130a0b6c696e655f6e756d626572180220022805120e0a0663"
    "6c6f73656418032001280812100a08646973636f756e74180420012801121a0a04666c616718052001280e32"
    "0c2e6f72646572732e466c6167121a0a047061727418062001280b320c2e6f72646572732e5061727412130a"
    "07616d6f756e747318072003280142021001120f0a076e756d626572731808200328052a1b0a04466c616712"
    "050a0141100012050a014e100112050a01521002"
)


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of orders with nested, repeated and missing values."""
    zero = F.col("l_discount") == 0
    return inputs.table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_key"),
        F.col("l_linenumber").alias("line_number"),
        (F.col("l_linestatus") == "F").alias("closed"),
        F.when(~zero, F.col("l_discount")).alias("discount"),
        F.col("l_returnflag").alias("flag"),
        F.struct(
            F.col("l_partkey").alias("part_key"),
            F.when(F.col("l_suppkey") % 3 != 0, -F.col("l_suppkey")).alias("supp_key"),
        ).alias("part"),
        F.when(zero, F.array("l_quantity", "l_extendedprice"))
        .otherwise(F.array("l_tax"))
        .alias("amounts"),
        F.filter(
            F.array(*map(F.lit, range(-3, 4))), lambda n: n < F.col("l_linenumber") - 4
        ).alias("numbers"),
        F.concat(F.col("l_shipdate").cast("string"), F.lit("Z")).cast("timestamp").alias("shipped"),
    )


def _flat(records: DataFrame) -> DataFrame:
    """Records as columns that compare in any engine."""
    return records.select(
        "order_key", "line_number", "closed", "discount", "flag", "part.part_key", "part.supp_key",
        F.get("amounts", F.lit(0)).alias("first_amount"),
        F.get("amounts", F.lit(1)).alias("second_amount"),
        F.array_join("numbers", ",").alias("numbers"),
        *([instant_text(F.col("shipped")).alias("shipped")] if "shipped" in records.columns else []),
    )


def avro_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    program = compile_avro(ORDER_LINE_AVSC)
    payloads = order_lines(spark, sf_dir).transform(encode_records, program).select("payload")
    return payloads.transform(decode_records, program).select("record.*").transform(_flat)


def proto_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    program = compile_protobuf(bytes.fromhex(ORDER_LINE_DESCRIPTOR_HEX), "orders.OrderLine")
    payloads = order_lines(spark, sf_dir).transform(encode_records, program).select("payload")
    return payloads.transform(decode_records, program).select("record.*").transform(_flat)


def ingest_order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of orders published and ingested; every seventh payload has a byte too many."""
    program = compile_avro(ORDER_LINE_AVSC)
    folder = scratch_dir(spark)
    topic = create_topic(spark, f"{folder}/topic")
    lines = order_lines(spark, sf_dir)
    bad = F.col("order_key") % 7 == 0
    publish_records(lines.where(~bad), program, topic)
    spoilt = lines.where(bad).transform(encode_records, program)
    publish(spoilt.withColumn("payload", F.concat("payload", F.lit(b"\x00"))), topic)
    schema = T.StructType([*program.spark, T.StructField("timestamp", T.TimestampType())])
    table = new_table(spark, folder, "order_lines", schema)
    malformed = new_table(spark, folder, "malformed", MALFORMED_ROW)
    ingest_records(
        spark,
        topic,
        program,
        table,
        f"{folder}/checkpoint",
        processing_time=fixed_time(),
        trigger=ALL_AVAILABLE,
        malformed_table=malformed,
    ).awaitTermination()
    good = scan_table(spark, table).select(
        F.lit("order_lines").alias("sink"), "order_key", "line_number", instant_text(F.col("timestamp")).alias("time")
    )
    refused = scan_table(spark, malformed).groupBy(F.col("reason").alias("sink")).agg(F.count(F.lit(1)).alias("order_key"))
    nothing = F.lit(None)
    return good.unionByName(
        refused.select("sink", "order_key", nothing.cast("int").alias("line_number"), nothing.cast("string").alias("time"))
    )


def ingest_proto_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every tenth payload lacks its last byte, every eleventh its last field."""
    folder = scratch_dir(spark)
    topic = create_topic(spark, f"{folder}/topic")
    key = F.col("id").cast("bigint")
    cut = F.expr("substring(payload, 1, octet_length(payload) - 1)")
    lacking = F.expr("substring(payload, 1, octet_length(payload) - octet_length(last_name) - 2)")
    payload = F.when(key % 10 == 0, cut).when(key % 11 == 0, lacking).otherwise(F.col("payload"))
    encoded = inputs.users(spark, sf_dir).transform(encode_protobuf)
    publish(encoded.withColumn("payload", payload), topic)
    table = new_table(spark, folder, "user_messages", USER_MESSAGE_ROW)
    malformed = new_table(spark, folder, "malformed", MALFORMED_ROW)
    ingest_protobuf(
        spark, topic, table, f"{folder}/checkpoint", trigger=ALL_AVAILABLE, malformed_table=malformed
    ).awaitTermination()
    good = scan_table(spark, table).select(F.lit("user_messages").alias("sink"), F.col("id").alias("value"))
    bad = scan_table(spark, malformed).select(F.col("reason").alias("sink"), F.hex("payload").alias("value"))
    return good.unionByName(bad)


QUERIES = {
    "avro_records": avro_records,
    "proto_records": proto_records,
    "ingest_order_lines": ingest_order_lines,
    "ingest_proto_quarantine": ingest_proto_quarantine,
}
