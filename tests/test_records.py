"""Codecs compiled from schemas, against the JVM's Avro and Python's Protobuf libraries."""

import json
import random
import time
from datetime import date, datetime, timezone

import numpy as np
import pyarrow as pa
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from sluiceway.codecs.avro import compile_avro
from sluiceway.codecs.protobuf import compile_protobuf
from sluiceway.operators.arrow_decode import record_decoder
from sluiceway.operators.records import (
    decode_avro_records,
    decode_protobuf_records,
    encode_avro_records,
    encode_protobuf_records,
)
from sluiceway.operators.user_messages import decode_avro
from sluiceway.schemas import USER_MESSAGE_AVSC, USER_MESSAGE_DESCRIPTOR_HEX

AVSC = json.dumps(
    {
        "type": "record",
        "name": "Order",
        "namespace": "shop.v1",
        "fields": [
            {"name": "key", "type": "long"},
            {"name": "count", "type": "int"},
            {"name": "open", "type": "boolean"},
            {"name": "price", "type": "double"},
            {"name": "rate", "type": "float"},
            {"name": "note", "type": ["null", "string"]},
            {"name": "raw", "type": ["bytes", "null"]},
            {"name": "state", "type": {"type": "enum", "name": "State", "symbols": ["NEW", "PAID", "SENT"]}},
            {"name": "digest", "type": {"type": "fixed", "name": "Four", "size": 4}},
            {
                "name": "place",
                "type": {
                    "type": "record",
                    "name": "Place",
                    "fields": [{"name": "city", "type": "string"}, {"name": "zip", "type": ["null", "int"]}],
                },
            },
            {"name": "other", "type": ["null", "Place"]},
            {"name": "prices", "type": {"type": "array", "items": "double"}},
            {"name": "marks", "type": {"type": "array", "items": ["null", "long"]}},
            {"name": "stops", "type": {"type": "array", "items": "shop.v1.Place"}},
            {"name": "tags", "type": {"type": "map", "values": {"type": "array", "items": "string"}}},
            {"name": "either", "type": ["null", "long", "string"]},
            {"name": "was", "type": ["null", "State"]},
        ],
    }
)


def place(rng):
    return {"city": rng.choice(["", "Köln", "x" * 200]), "zip": rng.choice([None, 0, -5, 2**31 - 1])}


def order(rng):
    either = rng.choice([None, {"member0": rng.randrange(-9, 9), "member1": None}, {"member0": None, "member1": "y"}])
    return {
        "key": rng.choice([0, -1, 2**63 - 1, -(2**63), rng.randrange(10**6)]),
        "count": rng.choice([0, 63, 64, -64, -65, 2**31 - 1, -(2**31)]),
        "open": rng.random() < 0.5,
        "price": rng.choice([0.0, -1.5, 1e300, rng.random()]),
        "rate": float(np.float32(rng.random())),
        "note": rng.choice([None, "", "é€😀"]),
        "raw": rng.choice([None, b"", b"\x00\xff"]),
        "state": rng.choice(["NEW", "PAID", "SENT"]),
        "digest": bytes(rng.randrange(256) for _ in range(4)),
        "place": place(rng),
        "other": rng.choice([None, place(rng)]),
        "prices": [rng.random() for _ in range(rng.choice([0, 1, 5]))],
        "marks": [rng.choice([None, rng.randrange(-300, 300)]) for _ in range(rng.choice([0, 1, 7]))],
        "stops": [place(rng) for _ in range(rng.choice([0, 2, 3]))],
        "tags": [(f"k{i}", ["v"] * i) for i in range(rng.choice([0, 1, 3]))],
        "either": either,
        "was": rng.choice([None, "SENT"]),
    }


ORDERS = [order(random.Random(seed)) for seed in range(200)]


def as_json(o):
    """As the JVM's JSON encoding of Avro has it."""
    latin = lambda b: b.decode("latin-1")
    place = lambda p: {"city": p["city"], "zip": p["zip"] if p["zip"] is None else {"int": p["zip"]}}
    other = o["either"]
    if other is not None:
        other = {"long": other["member0"]} if other["member1"] is None else {"string": other["member1"]}
    return json.dumps(
        o
        | {
            "note": o["note"] if o["note"] is None else {"string": o["note"]},
            "raw": o["raw"] if o["raw"] is None else {"bytes": latin(o["raw"])},
            "digest": latin(o["digest"]),
            "place": place(o["place"]),
            "other": o["other"] if o["other"] is None else {"shop.v1.Place": place(o["other"])},
            "marks": [m if m is None else {"long": m} for m in o["marks"]],
            "stops": [place(p) for p in o["stops"]],
            "tags": dict(o["tags"]),
            "either": other,
            "was": o["was"] if o["was"] is None else {"shop.v1.State": o["was"]},
        }
    )


@pytest.fixture(scope="module")
def jvm_avro(spark):
    """Encode JSON, and decode to JSON, with the JVM's library."""
    avro, io = spark._jvm.org.apache.avro, spark._jvm.java.io

    def encode(avsc, text, blocking=False):
        schema = avro.Schema.Parser().parse(avsc)
        datum = avro.generic.GenericDatumReader(schema).read(None, avro.io.DecoderFactory.get().jsonDecoder(schema, text))
        out = io.ByteArrayOutputStream()
        factory = avro.io.EncoderFactory.get()
        encoder = factory.blockingBinaryEncoder(out, None) if blocking else factory.binaryEncoder(out, None)
        avro.generic.GenericDatumWriter(schema).write(datum, encoder)
        encoder.flush()
        return bytes(out.toByteArray())

    def decode(avsc, payload):
        schema = avro.Schema.Parser().parse(avsc)
        decoder = avro.io.DecoderFactory.get().binaryDecoder(payload, None)
        datum = avro.generic.GenericDatumReader(schema).read(None, decoder)
        assert decoder.isEnd()
        out = io.ByteArrayOutputStream()
        encoder = avro.io.EncoderFactory.get().jsonEncoder(schema, out)
        avro.generic.GenericDatumWriter(schema).write(datum, encoder)
        encoder.flush()
        return json.loads(out.toString("UTF-8"))

    return encode, decode


@pytest.mark.parametrize("blocking", [False, True])
def test_avro_of_the_jvm_library_is_read(jvm_avro, blocking):
    payloads = [jvm_avro[0](AVSC, as_json(o), blocking) for o in ORDERS]
    records, reasons = compile_avro(AVSC).decode(pa.array(payloads, pa.binary()))
    assert reasons is None and records.to_pylist() == ORDERS


def test_avro_is_read_by_the_jvm_library(jvm_avro):
    program = compile_avro(AVSC)
    payloads = program.encode(pa.array(ORDERS, program.arrow)).to_pylist()
    for o, payload in zip(ORDERS, payloads):
        assert jvm_avro[1](AVSC, payload) == json.loads(as_json(o))


def test_avro_in_spark(spark):
    program = compile_avro(AVSC)
    rows = spark.createDataFrame([{**o, "tags": dict(o["tags"])} for o in ORDERS], program.spark)
    back = rows.transform(encode_avro_records, AVSC).select("payload").transform(decode_avro_records, AVSC)
    assert [r.asDict(True) for r in back.select("record.*").collect()] == [r.asDict(True) for r in rows.collect()]


def test_dates_and_times(spark):
    times = {"type": "long", "logicalType": "timestamp-micros"}
    avsc = json.dumps(
        {
            "type": "record",
            "name": "T",
            "fields": [
                {"name": "day", "type": {"type": "int", "logicalType": "date"}},
                {"name": "at", "type": ["null", times]},
                {"name": "milli", "type": {"type": "long", "logicalType": "timestamp-millis"}},
            ],
        }
    )
    at = datetime(1969, 12, 31, 23, 59, 59, 999000, tzinfo=timezone.utc)
    rows = [(date(1900, 1, 1), None, at), (date(2026, 2, 28), at.replace(year=2030, microsecond=123456), at)]
    frame = spark.createDataFrame(rows, compile_avro(avsc).spark)
    back = frame.transform(encode_avro_records, avsc).select("payload").transform(decode_avro_records, avsc)
    assert back.select("record.*").collect() == frame.collect()


@pytest.mark.parametrize(
    "avsc, reason",
    [
        ('"string"', "outermost"),
        ('{"type": "record", "name": "A", "fields": [{"name": "x", "type": ["null", "A"]}]}', "contains itself"),
        ('{"type": "record", "name": "A", "fields": [{"name": "x", "type": "B"}]}', "not known"),
        ('{"type": "record", "name": "A", "fields": []}', "no fields"),
    ],
)
def test_schemas_that_are_refused(avsc, reason):
    with pytest.raises(ValueError, match=reason):
        compile_avro(avsc)


def cut_and_changed(payloads, rng):
    for payload in payloads:
        at = rng.randrange(len(payload) + 1)
        yield payload[:at]
        yield payload[:at] + bytes([rng.randrange(256)]) + payload[at + 1 :]


def test_bad_avro_fails_alone_and_as_in_the_jvm_library(jvm_avro):
    program = compile_avro(AVSC)
    good = program.encode(pa.array(ORDERS, program.arrow)).to_pylist()
    bad = list(cut_and_changed(good, random.Random(3)))
    mixed = [payload for pair in zip(bad[::2], bad[1::2], good) for payload in pair]
    records, reasons = program.decode(pa.array(mixed, pa.binary()))
    records = records.to_pylist()
    for i, payload in enumerate(mixed):
        alone, reason = program.decode(pa.array([payload], pa.binary()))
        assert (reason is None) == (reasons[i] is None)
        if reason is None:
            assert repr(alone.to_pylist()[0]) == repr(records[i])
        else:
            assert reason[0] == reasons[i]
    assert all(reasons[i] is None and records[i] == ORDERS[i // 3] for i in range(2, len(mixed), 3))
    for payload in mixed[:150]:
        own = program.decode(pa.array([payload], pa.binary()))[1] is None
        try:
            jvm_avro[1](AVSC, payload)
            read = True
        except Exception:
            read = False
        assert own == read, payload


def descriptors():
    pb = pytest.importorskip("google.protobuf.descriptor_pb2")
    kinds = pb.FieldDescriptorProto
    out = {}
    for syntax in ("proto2", "proto3"):
        file = pb.FileDescriptorProto(name=f"{syntax}.proto", package=f"shop.{syntax}", syntax=syntax)
        enum = file.enum_type.add(name="State")
        for number, name in enumerate(("NEW", "PAID", "SENT")):
            enum.value.add(name=name, number=number)
        inner = file.message_type.add(name="Place")
        inner.field.add(name="city", number=1, type=kinds.TYPE_STRING, label=1)
        inner.field.add(name="zip", number=2, type=kinds.TYPE_SINT32, label=1)
        inner.field.add(name="more", number=3, type=kinds.TYPE_INT32, label=3)
        message = file.message_type.add(name="Order")
        types = [t for t in range(1, 19) if t not in (10, 11, 14)]
        for t in types:
            message.field.add(name=f"one_{t}", number=t, type=t, label=2 if syntax == "proto2" and t == 3 else 1)
            message.field.add(name=f"many_{t}", number=100 + t, type=t, label=3)
        name = f".shop.{syntax}"
        message.field.add(name="state", number=200, type=14, type_name=f"{name}.State", label=1)
        message.field.add(name="states", number=201, type=14, type_name=f"{name}.State", label=3)
        message.field.add(name="place", number=202, type=11, type_name=f"{name}.Place", label=1)
        message.field.add(name="places", number=5000, type=11, type_name=f"{name}.Place", label=3)
        entry = message.nested_type.add(name="TagsEntry")
        entry.options.map_entry = True
        entry.field.add(name="key", number=1, type=kinds.TYPE_STRING, label=1)
        entry.field.add(name="value", number=2, type=kinds.TYPE_INT64, label=1)
        message.field.add(name="tags", number=203, type=11, type_name=f"{name}.Order.TagsEntry", label=3)
        out[syntax] = pb.FileDescriptorSet(file=[file]).SerializeToString()
    return out


def protobuf_class(data, name):
    pool = pytest.importorskip("google.protobuf.descriptor_pool").DescriptorPool()
    pb = pytest.importorskip("google.protobuf.descriptor_pb2")
    factory = pytest.importorskip("google.protobuf.message_factory")
    pool.Add(pb.FileDescriptorSet.FromString(data).file[0])
    return factory.GetMessageClass(pool.FindMessageTypeByName(name))


VALUES = {
    1: [0.0, -1.5, 1e300], 2: [0.0, 0.5, -2.25], 3: [0, -1, 2**63 - 1], 4: [0, 5, 2**63 - 1],
    5: [0, -1, 2**31 - 1], 6: [0, 7, 2**62], 7: [0, 9, 2**31 - 1], 8: [True, False],
    9: ["", "é€😀", "z" * 300], 12: [b"", b"\xff\x00"], 13: [0, 3, 2**31 - 1],
    15: [0, -9, 2**31 - 1], 16: [0, -9, 2**62], 17: [0, -1, -(2**31)], 18: [0, -1, -(2**63)],
}


def message_of(cls, rng):
    message = cls()
    for t, values in VALUES.items():
        if rng.random() < 0.6 or t == 3:
            setattr(message, f"one_{t}", rng.choice(values))
        getattr(message, f"many_{t}").extend(rng.choice(values) for _ in range(rng.choice([0, 0, 1, 4])))
    if rng.random() < 0.5:
        message.state = rng.randrange(3)
    message.states.extend(rng.randrange(3) for _ in range(rng.choice([0, 3])))
    if rng.random() < 0.6:
        message.place.city = "Köln"
        message.place.more.extend([1, -2])
    for i in range(rng.choice([0, 1, 3])):
        message.places.add(zip=-i, more=[i] * i)
        message.tags[f"t{i}"] = i
    return message


def plain(message):
    """A message as Python values; absent fields are None."""
    found = {}
    for field in message.DESCRIPTOR.fields:
        value = getattr(message, field.name)
        convert = lambda v, field=field: (
            plain(v) if field.type == 11 else field.enum_type.values_by_number[v].name if field.type == 14 else v
        )
        if field.type == 11 and field.message_type.GetOptions().map_entry:
            found[field.name] = sorted(value.items())
        elif field.is_repeated:
            found[field.name] = [convert(v) for v in value]
        elif field.has_presence and not message.HasField(field.name):
            found[field.name] = None
        elif not field.has_presence and not value:
            found[field.name] = None  # not on the wire
        else:
            found[field.name] = convert(value)
    return found


def loose(value):
    """Without the difference between a zero (or an enum's NEW) on the wire and none."""
    if isinstance(value, dict):
        return {k: loose(v) for k, v in value.items()}
    return [loose(v) for v in value] if isinstance(value, list) else None if value == "NEW" else value or None


def sorted_tags(record):
    return {k: sorted(v) if k == "tags" else v for k, v in record.items()}


@pytest.mark.parametrize("syntax", ["proto2", "proto3"])
def test_protobuf_both_ways(syntax):
    data = descriptors()[syntax]
    cls = protobuf_class(data, f"shop.{syntax}.Order")
    program = compile_protobuf(data, f"shop.{syntax}.Order")
    messages = [message_of(cls, random.Random(seed)) for seed in range(150)]
    payloads = [m.SerializeToString() for m in messages]
    records, reasons = program.decode(pa.array(payloads, pa.binary()))
    assert reasons is None
    assert [sorted_tags(r) for r in records.to_pylist()] == [plain(m) for m in messages]
    encoded = program.encode(records).to_pylist()
    assert [plain(cls.FromString(p)) for p in encoded] == [plain(m) for m in messages]


@pytest.mark.parametrize("syntax", ["proto2", "proto3"])
def test_protobuf_merged_out_of_order_packed_or_not(syntax):
    """Joined payloads are merged: the last value counts, lists and messages go on."""
    all_ = descriptors()
    data, other = all_[syntax], all_["proto2" if syntax == "proto3" else "proto3"]
    cls = protobuf_class(data, f"shop.{syntax}.Order")
    other_cls = protobuf_class(other, f"shop.{'proto2' if syntax == 'proto3' else 'proto3'}.Order")
    program = compile_protobuf(data, "Order")
    rng = random.Random(7)
    payloads = []
    for _ in range(150):
        parts = [message_of(rng.choice([cls, other_cls]), rng).SerializeToString() for _ in range(rng.choice([1, 2, 3]))]
        last = cls(one_3=5)
        payloads.append(b"".join([*parts, last.SerializePartialToString()]))
    records, reasons = program.decode(pa.array(payloads, pa.binary()))
    assert reasons is None
    for payload, record in zip(payloads, records.to_pylist()):
        record["tags"] = dict(record["tags"]).items()
        assert loose(sorted_tags(record)) == loose(plain(cls.FromString(payload)))


def test_bad_protobuf_fails_alone_and_as_in_the_library():
    data = descriptors()["proto2"]
    cls = protobuf_class(data, "shop.proto2.Order")
    program = compile_protobuf(data, "Order")
    good = [message_of(cls, random.Random(seed)).SerializeToString() for seed in range(300)]
    bad = list(cut_and_changed(good, random.Random(5)))
    records, reasons = program.decode(pa.array(bad + good, pa.binary()))
    refused = 0
    for i, payload in enumerate(bad + good):
        try:
            own = cls.FromString(payload).IsInitialized()
        except Exception:
            own = False
        refused += not own
        told = None if reasons is None else reasons[i]
        assert (told is None) == own, (payload, told)
        assert program.decode(pa.array([payload], pa.binary()))[1] is None or told is not None
    assert refused > 50


def test_protobuf_in_spark(spark):
    data = bytes.fromhex(USER_MESSAGE_DESCRIPTOR_HEX)
    rows = spark.createDataFrame([("1", "A", "B"), ("2", "", "é")], "id string, firstName string, lastName string")
    back = rows.transform(encode_protobuf_records, data, "UserMessage").select("payload")
    assert back.transform(decode_protobuf_records, data, "UserMessage").select("record.*").collect() == rows.collect()
    null = rows.withColumn("lastName", F.lit(None).cast("string"))
    with pytest.raises(PySparkException, match="lastName is NULL"):
        null.transform(encode_protobuf_records, data, "UserMessage").collect()


def test_quarantine_of_records(spark):
    rows = spark.createDataFrame([("1", "A", "B"), ("2", "C", "D")], "id string, first_name string, last_name string")
    encoded = rows.transform(encode_avro_records, USER_MESSAGE_AVSC)
    cut = F.when(F.col("id") == "2", F.expr("substring(payload, 1, 3)")).otherwise(F.col("payload"))
    found = encoded.withColumn("payload", cut).transform(decode_avro_records, USER_MESSAGE_AVSC, "quarantine")
    assert {r["id"]: (r["record"], r["malformed"]) for r in found.collect()} == {
        "1": (("1", "A", "B"), None),
        "2": (None, "truncated payload"),
    }
    null = spark.createDataFrame([(None,)], "payload binary").transform(decode_avro, "auto", "quarantine")
    assert null.head()["malformed"] == "truncated payload"


@pytest.mark.parametrize("share", [0.01, 0.1, 1.0])
def test_bad_messages_cost_no_more_than_good_ones(share):
    """A topic of another format, cut payloads, and clean ones, each in about the same time."""
    program = compile_avro(USER_MESSAGE_AVSC)
    decode = record_decoder(program, "quarantine").func
    rng = np.random.default_rng(1)
    good = [b"\x0612\x33\x04ab\x06xyz"] * 50_000
    bad = [b"Hello A!", b"", b"\x0612", b"\xff" * 12, b"\x01\x02"]
    mixed = [bad[i % 5] if rng.random() < share else p for i, p in enumerate(good)]
    times = []
    for payloads in (good, mixed):
        array = pa.array(payloads, pa.binary())
        best = []
        for _ in range(3):
            started = time.perf_counter()
            decode(array)
            best.append(time.perf_counter() - started)
        times.append(min(best))
    assert times[1] < 2 * times[0] + 0.05
