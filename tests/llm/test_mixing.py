import re

import pytest
from pyspark.sql import functions as F

import sluiceway.llm.mixing as mixing
from sluiceway.llm.mixing import mix_sources, mixing_schedule
from sluiceway.llm.prefix_sums import running_sum
from tests.llm.conftest import collected


def targets(sizes, repeats=3):
    """Share by weight, stop at the limit, share the excess again."""
    sources = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: 1 + i % 3 for i, s in enumerate(sources)}
    left, free, target = float(sum(sizes.values())), set(sources), {}
    while free:
        level = left / sum(weight[s] for s in free)
        full = {s for s in free if level * weight[s] >= repeats * sizes[s]}
        if not full:
            return target | {s: level * weight[s] for s in free}
        for s in full:
            target[s] = float(repeats * sizes[s])
            left -= target[s]
        free -= full
    return target


def check(rows, frame):
    sizes, count = {}, {}
    for _, text, source in rows:
        n = len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
        sizes[source] = sizes.get(source, 0) + n
    expected = targets(sizes)
    found = mix_sources(frame, keep=("source",)).collect()
    assert len(found) == len(rows)
    for r in found:
        source = r["kept"]["source"]
        assert r["source_size"] == sizes[source]
        assert r["target"] == pytest.approx(expected[source])
        assert 0 <= r["taken"] <= 3 * r["size"]
        count[source] = count.get(source, 0) + r["taken"]
    for source, taken in count.items():
        assert abs(taken - expected[source]) < 1
    return found


def rows_of(**sources):
    at, rows = 0, []
    for source, sizes in sources.items():
        for n in sizes:
            rows.append((at, "w " * n, None if source == "none" else source))
            at += 1
    return rows


@pytest.mark.parametrize(
    "sources",
    [
        {"a": [5] * 40, "b": [1] * 3, "c": [100, 1, 7]},
        {"a": [1000], "b": [1], "c": [1], "d": [1], "none": [50, 50]},
        {"a": [0, 0], "b": [3]},
        {"only": [3, 2, 1]},
        {"é": [4], "Z": [9], "a": [3], "none": [0]},
    ],
)
def test_sources_meet_their_targets(texts, clash, sources):
    rows = rows_of(**sources)
    check(rows, clash(texts(rows)))


def test_edge_rows(texts):
    rows = [(1, None, "a"), (2, "", None), (None, "x y", "a"), (None, "x y", "a"), (3, "w " * 100_000, "b")]
    check(rows, texts(rows))
    assert collected(mix_sources(texts([]))) == []
    nothing = texts([(1, None, "a"), (2, " ", "b")])
    assert [(r["target"], r["taken"]) for r in mix_sources(nothing).collect()] == [(0.0, 0)] * 2


def test_reruns_agree_however_rows_are_dealt(texts):
    rows = rows_of(a=[5, 6, 7] * 30, b=[2] * 20, c=[90])
    one = collected(mix_sources(texts(rows)).drop("kept"))
    two = collected(mix_sources(texts(rows[::-1]).repartition(5)).drop("kept"))
    assert one == two


def test_schedule_serves_in_order_of_finish(texts):
    rows = rows_of(a=[5] * 10, b=[1] * 3, c=[10, 1, 7])
    served = mixing_schedule(texts(rows)).collect()
    finish = [r["finish"] for r in served]
    assert finish == sorted(finish)
    total = {}
    for r in served:
        total[r["id"]] = total.get(r["id"], 0) + r["taken"]
    mixed = {r["doc_id"]: r["taken"] for r in mix_sources(texts(rows)).collect() if r["taken"]}
    assert total == mixed
    assert {r["round"] for r in served} == {0, 1, 2}
    # Sorted over all sources, and truncated where the budget is used up, at virtual time 1.
    budget = sum(int(t) for t in targets({"a": 50, "b": 3, "c": 18}).values())
    assert sum(r["taken"] for r in served) == budget and finish[-1] <= 1


def test_repeated_rows_keep_their_columns(spark, texts, monkeypatch):
    monkeypatch.setattr(mixing, "ROWS_AT_ONCE", 3)
    rows = [(1, "a b c", "s")] * 4 + [(2, "d e", "s"), (None, "f", None), (None, "f", None)]
    frame = texts(rows).withColumn("size", F.monotonically_increasing_id())
    found = mix_sources(frame, keep=("doc_id", "size", "text")).collect()
    assert len(found) == 7 and len({r["kept"]["size"] for r in found}) == 7
    assert sorted(r["taken"] for r in found) == sorted(r["taken"] for r in mix_sources(texts(rows)).collect())
    assert all(r["size"] == len(r["kept"]["text"].split()) for r in found)


def test_running_sum_over_buckets(spark):
    rows = spark.range(200).selectExpr("id", "id % 3 AS g", "id % 7 AS v")
    rows = rows.selectExpr("id", "nullif(g, 2) AS g", "v")
    found = running_sum(rows, "g", F.floor(F.col("id") / 10), [F.col("id")], "v", "before").collect()
    before = {}
    for r in sorted(found, key=lambda r: r["id"]):
        assert r["before"] == before.get(r["g"], 0)
        before[r["g"]] = r["before"] + r["v"]
