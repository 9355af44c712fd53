import zlib

import numpy as np
import pytest

import sluiceway.llm.toxicity as toxicity
from sluiceway.llm.queries import QUERIES


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.1"
    found = {r["doc_id"]: r for r in QUERIES["op8_toxicity"](spark, sf_dir).collect()}
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").collect()
    caught, clean = [], []
    for row in labels:
        r = found[row["doc_id"]]
        assert r["held_out"] == (zlib.crc32(str(row["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
        if r["held_out"]:
            (caught if row["toxic"] else clean).append(r["predicted"])
    assert np.mean(caught) >= 0.8 and np.mean(clean) < 0.005


@pytest.fixture
def frames(spark, texts):
    docs = [(i, f"a fine day number {i}") for i in range(60)]
    docs += [(100 + i, f"you utter grobnik {i}") for i in range(20)]
    docs += [
        (200, None), (201, ""), (202, "other words " * 20_000 + "UTTER GROBNIK"), (203, "a lovely fine day"),
        (203, "a lovely fine day"), (None, "grobnik and utter grobnik"), (204, "grob\tzik"), (205, "g"),
    ]
    labels = [(i, 0) for i in range(60)] + [(100 + i, 1) for i in range(20)]
    labels += [(5, 0), (None, 1), (7, None), (8, 3), (999, 1)]
    return texts(docs), spark.createDataFrame(labels, "doc_id bigint, toxic int")


def test_edge_rows(frames, clash):
    docs, labels = frames
    found = {}
    for r in toxicity.toxicity_report(clash(docs), clash(labels)).collect():
        found.setdefault(r["doc_id"], []).append(r)
    assert all(found[i][0]["predicted"] == 0 for i in range(60))
    assert all(found[100 + i][0]["predicted"] == 1 for i in range(20))
    assert found[202][0]["predicted"] == 1 and found[None][0]["predicted"] == 1
    assert [r["predicted"] for r in found[203]] == [0, 0]
    assert found[200][0]["score"] == found[201][0]["score"] == found[205][0]["score"] < 0.5


def test_drop_keeps_columns_and_clean_rows(frames, clash):
    docs, labels = frames
    frame = clash(docs)
    kept = toxicity.drop_toxic(frame, labels)
    assert kept.columns == frame.columns
    ids = sorted((r["doc_id"] for r in kept.collect()), key=repr)
    assert ids == sorted([*range(60), 200, 201, 203, 203, 204, 205], key=repr)


def test_nothing_to_learn_from(frames):
    docs, labels = frames
    one_class = toxicity.toxicity_report(docs, labels.where("toxic = 0")).collect()
    assert {r["predicted"] for r in one_class} == {0}
    none = toxicity.toxicity_report(docs, labels.where("false")).collect()
    assert {r["score"] for r in none} == {0.5}
    assert toxicity.toxicity_report(docs.where("false"), labels).collect() == []


def test_same_input_gives_the_same_model(frames):
    docs, labels = frames
    one = toxicity.fit_toxicity(docs, labels)
    two = toxicity.fit_toxicity(docs.repartition(3), labels.repartition(2))
    assert np.array_equal(np.sort(one.buckets), np.sort(two.buckets))
    assert one.bias == pytest.approx(two.bias, abs=1e-6)


def test_characters_fold_case_and_space():
    import pyarrow as pa

    codes, offsets = toxicity._characters(pa.array(["Ab\t", "", "É😀"], pa.large_string()))
    assert codes.tolist() == [97, 98, 32, 0xC9, 0x1F600] and offsets.tolist() == [0, 3, 3, 5]
