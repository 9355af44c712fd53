import glob
import os

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
from sluiceway.llm.queries import ORACLE_SQL, QUERIES
from sluiceway.llm.toxicity import drop_toxic
from tests.llm.brute import contamination, line_report, near_duplicates
from tests.llm.conftest import SF_DIR


@pytest.mark.parametrize("name", ORACLE_SQL)
def test_query_equals_its_sql(spark, name):
    connection = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        view = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {view} AS SELECT * FROM read_parquet('{path}')")
    expected = connection.execute(ORACLE_SQL[name]).fetch_df()
    found = QUERIES[name](spark, SF_DIR).toPandas()
    columns = sorted(expected.columns)
    assert columns == sorted(found.columns)
    frames = [x[columns].sort_values(columns).reset_index(drop=True) for x in (found, expected)]
    pd.testing.assert_frame_equal(*frames, check_dtype=False, check_exact=True)


def test_every_operator_is_registered():
    names = contract.queries().keys()
    assert "pipeline" in names
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1


@pytest.fixture(scope="module")
def stages(spark, given, tmp_path_factory):
    """What goes into each stage and what comes out."""
    folder, docs, seen = tmp_path_factory.mktemp("stages"), given("documents"), {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF_DIR).write.parquet(f"{folder}/{name}")
        out = spark.read.parquet(f"{folder}/{name}")
        seen[name] = docs, out
        docs = out
    return seen


def rows(frame):
    return [(r["doc_id"], r["text"]) for r in frame.select("doc_id", "text").collect()]


def test_stages_in_order(stages, given):
    assert list(stages) == ["toxicity", "line_dedup", "near_dedup", "decontamination", "mixing"]
    for name in list(stages)[:-1]:
        assert stages[name][1].columns == given("documents").columns


def test_toxicity_drops_labelled_documents(stages, given):
    docs, kept = stages["toxicity"]
    labels = {r["doc_id"]: r["toxic"] for r in given("labels").collect()}
    ids = {i for i, _ in rows(kept)}
    gone = [i for i, _ in rows(docs) if i not in ids]
    known = [labels[i] for i in gone if i in labels]
    assert known and sum(known) >= 0.9 * len(known)


def test_line_dedup(stages):
    docs, kept = stages["line_dedup"]
    expected = {r[0]: r[3] for r in line_report(rows(docs))}
    found = kept.select("doc_id", "n_chars", F.length("text"), F.sha2("text", 256)).collect()
    assert {r[0]: r[3] for r in found} == expected
    assert all(r[1] == r[2] for r in found)


def test_near_dedup(stages):
    docs, kept = stages["near_dedup"]
    expected = sorted(r[0] for r in near_duplicates(rows(docs), 5) if r[3])
    assert sorted(i for i, _ in rows(kept)) == expected


def test_decontamination(stages, given):
    docs, kept = stages["decontamination"]
    items = [(r["item_id"], r["text"]) for r in given("benchmark").collect()]
    expected = sorted(r[0] for r in contamination(rows(docs), items) if not r[5])
    assert sorted(i for i, _ in rows(kept)) == expected


def test_mixing_and_run(spark, stages):
    docs, mixed = stages["mixing"]
    found = mixed.collect()
    sizes = docs.selectExpr("source", "size(regexp_extract_all(text, '[^\\\\x20\\\\x09-\\\\x0D]+', 0)) AS n")
    total = sizes.agg(F.sum("n")).head()[0]
    assert abs(sum(r["taken"] for r in found) - total) <= len({r["source"] for r in found})
    assert all(0 < r["taken"] <= 3 * r["size"] for r in found)
    whole = corpus_pipeline.run(spark, SF_DIR)
    assert whole.columns == mixed.columns
    assert sorted(whole.collect(), key=repr) == sorted(found, key=repr)


@pytest.fixture
def small(spark, clash, texts, tmp_path):
    """Writes a folder of tables; documents have clashing columns."""
    rows = [(i, f"Document {i} says something of its own.\nA common line of text here.\n{i * 7919} end", f"s{i % 3}") for i in range(30)]
    rows += [(100 + i, f"you utter grobnik {i} and a grobnik again", "s1") for i in range(10)]
    rows += [(200, None, None), (201, "", "s0"), (None, "no id but words", "s2"), (203, "x " * 50_000, "s0")]
    rows += [(204, "The quick brown fox jumps over the lazy dog and then it sleeps", "s1")] * 2

    def make(labels, documents=rows, benchmark=((1, "quick brown fox jumps over the lazy dog and then it sleeps"),)):
        clash(texts(documents)).write.parquet(f"{tmp_path}/documents.parquet")
        labels = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
        labels.write.parquet(f"{tmp_path}/labels.parquet")
        benchmark = spark.createDataFrame(list(benchmark), "item_id bigint, text string")
        benchmark.write.parquet(f"{tmp_path}/benchmark.parquet")
        return str(tmp_path)

    return make


def ids_of(frame):
    return {r["doc_id"] for r in frame.select("doc_id").collect()}


def test_run_with_clashing_columns_nulls_and_repeated_rows(spark, small):
    found = corpus_pipeline.run(spark, small([(i, 1, 0) for i in range(30)] + [(100 + i, 0, 1) for i in range(10)]))
    assert len(set(found.columns)) == len(found.columns) and "_taken" in found.columns
    ids = ids_of(found)  # the mix may pass over some
    assert ids <= {*range(30), None, 203} and len(ids) > 20
    assert found.where("_taken > 3 * _size").count() == 0


def test_labels_that_tell_nothing_drop_nothing(spark, small):
    folder = small([])
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    schema = "doc_id bigint, quality int, toxic int"
    for labels in ([], [(9999, 1, 1), (9998, 1, 0)], [(0, 1, 1)], [(0, 1, 0), (9999, 0, 1)]):
        labels = spark.createDataFrame(labels, schema)
        assert drop_toxic(docs, labels).count() == docs.count() == 46
    ids = ids_of(corpus_pipeline.run(spark, folder))
    assert len(ids) > 20 and ids & {100 + i for i in range(10)}


def test_run_over_empty_tables(spark, small):
    found = corpus_pipeline.run(spark, small([], documents=[], benchmark=[]))
    assert found.collect() == []
