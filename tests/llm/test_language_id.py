import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import sluiceway.llm.language_id as language
from sluiceway.llm.queries import QUERIES


def test_gradients_are_those_of_the_loss(monkeypatch):
    monkeypatch.setattr(language, "HIDDEN", 3)
    net = {k: v.astype(float) for k, v in language.new_network(3).items()}
    draw = np.random.default_rng(0)
    x = draw.integers(0, 5, (7, 4)).astype(np.uint8)
    length, label = np.array([7, 3, 1, 5]), np.array([0, 1, 2, 1])
    _, slope = language.gradients(net, x, length, label)
    for name, values in net.items():
        for _ in range(5):
            at = tuple(int(draw.integers(0, n)) for n in values.shape)
            if name[0] == "x":
                at = at[0], int(draw.integers(0, 5))
            losses = []
            for step in (1e-3, -2e-3):
                values[at] += step
                losses.append(language.gradients(net, x, length, label)[0])
            values[at] += 1e-3
            assert (losses[0] - losses[1]) / 2e-3 == pytest.approx(slope[name][at], abs=3e-4)


def test_pooling_reads_every_byte(monkeypatch):
    net = language.new_network(3)
    texts = [b"", b"a", b"hello there, this is it " * 40, b"xyz"]
    offsets = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    data = np.frombuffer(b"".join(texts), np.uint8)
    found = language.text_probabilities(net, data, offsets)
    fold = language._fold()
    for text, p in zip(texts, found):
        total = np.zeros(3)
        for at in range(0, len(text), language.SEGMENT):
            piece = fold[np.frombuffer(text[at : at + language.SEGMENT], np.uint8)]
            total += language.segment_probabilities(net, piece[:, None], np.array([len(piece)]))[:, 0]
        assert p == pytest.approx(total / max(len(text), 1), abs=1e-5)
        assert p.sum() == pytest.approx(1.0 if text else 0.0, abs=1e-4)


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"
    found = QUERIES["op6_language_id"](spark, sf_dir).collect()
    given = {r["doc_id"]: r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert len(found) == len(given)
    known = {r["lang"] for r in given.values()} - {None}
    right = []
    for r in found:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1 and r["lang_pred"] in known | {"und"}
        if r["held_out"] and given[r["doc_id"]]["lang"]:
            right.append(r["lang_pred"] == given[r["doc_id"]]["lang"])
    assert np.mean(right) > 0.97


def labelled(spark):
    rows = [(i, f"aba bab abba {i}", "a") for i in range(30)] + [(40 + i, "oxo xox oxxo", "o") for i in range(30)]
    rows += [
        (100, None, "a"), (101, "", "o"), (102, "12 34 !", "a"), (103, "oxo " * 50_000, None),
        (None, "aba bab abba", "a"), (104, "abba bab", None), (104, "abba bab", None),
    ]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string")


def test_edge_rows(spark, clash, monkeypatch):
    monkeypatch.setattr(language, "EPOCHS", 60)
    rows = clash(labelled(spark))
    found = {}
    for r in language.language_report(rows).collect():
        found.setdefault(r["doc_id"], []).append((r["lang_pred"], r["score"]))
    assert found[100] == found[101] == found[102] == [("und", 0.0)]
    assert found[103][0][0] == "o" and found[104][0][0] == "a" and len(found[104]) == 2
    assert found[None][0][0] == "a"


def test_nothing_to_learn_from(spark):
    rows = labelled(spark)
    found = language.language_report(rows, learn=F.lit(False)).collect()
    assert {(r["lang_pred"], r["score"]) for r in found} == {("und", 0.0)}
    assert language.language_report(rows.where("false")).collect() == []
