import time

import pytest
from pyspark.sql import functions as F

from sluiceway.llm.line_dedup import drop_repeated_lines, line_report
from tests.llm.brute import line_report as expected_report
from tests.llm.conftest import collected

ROWS = [
    (1, "The same line here\nshort\nonly mine here, one"),
    (2, "  the SAME line here\t\nshort\n\n"),
    (2, "  the SAME line here\t\nshort\n\n"),
    (2, "another text of the same id\nThe same line here"),
    (3, None),
    (4, ""),
    (5, "twice in one\ntwice in one\nThe same line here"),
    (6, "ÀÉ upper stays\nàé upper stays"),
    (7, "àé upper stays\n\x0b\x0cnine char\nten chars!\x0b"),
    (8, "nine char\nten chars!"),
    (None, "The same line here\nwith null id only"),
    (None, "with null id only"),
    (9, "x" * 300_000 + "\n" + "y\n" * 20_000 + "The same line here"),
]


def test_report(texts, clash):
    assert collected(line_report(clash(texts(ROWS)))) == expected_report(ROWS)


def test_empty_table(texts):
    assert collected(line_report(texts([]))) == []


def test_smallest_id_keeps_among_null_ids(texts):
    rows = [(None, "a line of some length"), (None, "a line of some length")]
    assert collected(line_report(texts(rows))) == expected_report(rows)
    rows.append((7, "a line of some length"))
    assert collected(line_report(texts(rows))) == expected_report(rows)


@pytest.mark.parametrize("documents, dropped", [(2, 3), (4, 3), (5, 0)])
def test_threshold(texts, documents, dropped):
    rows = [(i, "a line of some length") for i in range(4)]
    found = line_report(texts(rows), min_documents=documents).collect()
    assert sum(r["n_dropped"] for r in found) == dropped


def test_drop_returns_the_given_columns(texts, clash):
    frame = clash(texts([(1, "a line of some length\nb"), (2, "c\na line of some length"), (3, None)]))
    kept = drop_repeated_lines(frame)
    assert kept.columns == frame.columns
    assert {r["doc_id"]: r["text"] for r in kept.collect()} == {
        1: "a line of some length\nb",
        2: "c",
        3: None,
    }


def test_many_lines_in_one_text(spark, texts):
    """Work follows the lines of a text; most of them are dropped here."""
    lines = "\n".join(f"line number {i} of many" for i in range(200_000))
    frame = texts([(1, lines), (2, lines + "\nits own last line"), (3, "another")])
    started = time.perf_counter()
    found = {r.doc_id: r for r in line_report(frame).collect()}
    assert time.perf_counter() - started < 20
    assert (found[1].n_lines, found[1].n_dropped) == (200_000, 0)
    assert (found[2].n_lines, found[2].n_dropped) == (200_001, 200_000)


def test_a_line_of_very_many_documents_is_split(spark):
    """The join of the commonest line is dealt to several tasks."""
    documents = spark.range(60_000).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("the same line in all\n"), F.md5(F.col("id").cast("string"))).alias("text")
    )
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        kept = drop_repeated_lines(documents)
        assert kept.where("text LIKE 'the same%'").count() == 1
        kept.write.format("noop").mode("overwrite").save()
        rows = kept.collect()
        plan = kept._jdf.queryExecution().executedPlan().toString()
    finally:
        for name in settings:
            spark.conf.unset(name)
    assert len(rows) == 60_000
    assert "skew=true" in plan
