"""Names in greetings: every edge of the text rules, checked against the JVM's own strings."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from sluiceway.functions.text import payload_text, utf16_length, utf16_shorter_than
from sluiceway.operators.names import (
    extract_names,
    name_rows,
    route_names,
    short_names,
    take_route,
    with_text,
)

MALFORMED = [b"Hello ", b"Hello", b"", b" ", b"Hello\tA!", b"Hello  Bob!", b"Hello  "]
NAMED = {
    b"Hello A!": "A",
    b"Hello A B!": "",
    b"Hello !": "",
    b" Bob!": "Bob",
    b" Bob! x": "Bob",
    b"Hello Bob": "Bo",
    b"Hello Bob! and more words": "Bob",
    "Hello A😀😀!".encode(): "A😀😀",
    b"Hello A\xff!": "A�",
    b"\xff\xfe A!": "A",
    b"Hello A\xe2\x82 x": "A",
    "Hello Zoë!".encode(): "Zoë",
}


def messages(spark, payloads):
    rows = [(i, bytearray(p) if p is not None else None) for i, p in enumerate(payloads)]
    return spark.createDataFrame(rows, "n int, payload binary")


def test_names(spark):
    names = messages(spark, NAMED).transform(extract_names).orderBy("n").collect()
    assert [row["name"] for row in names] == list(NAMED.values())


@pytest.mark.parametrize("payload", [*MALFORMED, None])
def test_malformed_payload_fails(spark, payload):
    with pytest.raises(PySparkException, match="malformed greeting"):
        messages(spark, [payload]).transform(extract_names).collect()


def test_malformed_payloads_are_set_apart(spark):
    payloads = [*NAMED, *MALFORMED, None]
    names = messages(spark, payloads).transform(extract_names, "quarantine").orderBy("n").collect()
    assert [row["name"] for row in names] == [*NAMED.values()] + [None] * (len(MALFORMED) + 1)


def test_unknown_choice_for_malformed_payloads(spark):
    with pytest.raises(ValueError):
        messages(spark, [b"x"]).transform(extract_names, "ignore")


def jvm_name(spark, payload: bytes):
    """What a split on one space and a cut of the last UTF-16 unit gives; None if it fails."""
    text = spark._jvm.java.lang.String(payload, "UTF-8")
    words = list(spark._jvm.java.util.regex.Pattern.compile(" ").split(text))
    return words[1] if len(words) > 1 and words[1] else None


@settings(
    max_examples=15,
    deadline=None,
    derandomize=True,
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)
@given(
    st.lists(
        st.one_of(
            st.binary(max_size=12),
            st.lists(
                st.sampled_from([b" ", b"A", b"!", b"\xc3", b"\xa9", b"\xf0\x9f\x98\x80", b"\xe2\x82", b"\xed", b"\xa0"]),
                max_size=8,
            ).map(b"".join),
        ),
        min_size=1,
        max_size=40,
    )
)
def test_words_equal_those_of_the_jvm(spark, payloads):
    rows = messages(spark, payloads).transform(extract_names, "quarantine").orderBy("n").collect()
    words = [jvm_name(spark, payload) for payload in payloads]
    assert [row["name"] for row in rows] == [word and word[:-1] for word in words]


def test_payload_text(spark):
    payloads = [b"", b"abc", "é😀".encode(), b"a\xffb", b"\xe2\x82", b"\xc0\x80", b"\xed\xa0\x80", None]
    rows = messages(spark, payloads).transform(with_text).orderBy("n").collect()
    expected = [p if p is None else spark._jvm.java.lang.String(p, "UTF-8") for p in payloads]
    assert [row["text"] for row in rows] == expected


@settings(
    max_examples=10,
    deadline=None,
    derandomize=True,
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)
@given(
    st.lists(
        st.lists(
            st.sampled_from([0x41, 0x80, 0x90, 0xA0, 0xBF, 0xC0, 0xC3, 0xE0, 0xE2, 0xED, 0xEF, 0xF0, 0xF4, 0xF5]),
            max_size=6,
        ).map(bytes),
        min_size=50,
        max_size=200,
    )
)
def test_repaired_text_equals_that_of_the_jvm(spark, payloads):
    rows = messages(spark, payloads).select("n", payload_text(F.col("payload")).alias("t"))
    texts = [row["t"] for row in rows.orderBy("n").collect()]
    assert texts == [spark._jvm.java.lang.String(payload, "UTF-8") for payload in payloads]


@pytest.mark.parametrize("limit", [1, 2, 5])
def test_length_in_utf16_units(spark, limit):
    texts = ["", "A", "AAAA", "AAAAA", "éééé", "ééééé", "€€€€", "€€€€€", "😀😀", "A😀😀", "A😀"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(
        "t",
        utf16_length(F.col("t")).alias("length"),
        utf16_shorter_than(F.col("t"), limit).alias("short"),
    )
    for row in rows.collect():
        length = len(row["t"].encode("utf-16-be")) // 2
        assert row["length"] == length
        assert row["short"] == (length < limit), row


def test_filter_route_and_rows(spark):
    names = ["A", "B", "AA", "BB", "AAAAA", "BBBBB", "a", "C", "", "Ab", "BA", "A😀😀", "AAAA"]
    frame = spark.createDataFrame([(n,) for n in names], "name string")
    routed = frame.transform(short_names).transform(route_names)
    time = F.lit("2026-01-02T03:04:05Z").cast("timestamp")
    a = routed.transform(take_route, "A").transform(name_rows, time)
    b = routed.transform(take_route, "B").transform(name_rows, time)
    assert a.columns == b.columns == ["name", "timestamp"]
    assert sorted(r["name"] for r in a.collect()) == ["A", "AA", "AAAA", "Ab"]
    assert sorted(r["name"] for r in b.collect()) == ["B", "BA", "BB"]


def test_one_pass_without_shuffle(spark, folder):
    """The word is computed once, and only payloads are read."""
    greetings = messages(spark, [b"Hello A!"]).withColumn("other", F.lit(1))
    greetings.write.parquet(f"{folder}/greetings")
    routed = (
        spark.read.parquet(f"{folder}/greetings")
        .transform(extract_names)
        .transform(short_names)
        .transform(route_names)
        .select("route", "name")
    )
    plan = routed._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert "ReadSchema: struct<payload:binary>" in plan
    assert plan.count("makeValid") == 1, plan
