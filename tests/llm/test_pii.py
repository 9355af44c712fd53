import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from sluiceway.llm import boosting
from sluiceway.llm.pii import _earlier, personal_data_report
from sluiceway.llm.queries import QUERIES
from tests.llm.brute import KINDS, base_spans, sha
from tests.llm.conftest import SF_DIR

PIECES = [
    "a", "1", "23", "4111", "1111", " ", "  ", "-", ".", "+", "(", ")", "@", "a@b", "b.c", "é", "_", "%", "😀",
    "1.2.3.4", "+1 (607) 555-1595", "4111111111111111", "4111 1111 1111 1111", "x@y.zz", "256.1.1.1", "\n",
]


def check(rows, found):
    assert len(found) == len(rows)
    by_id = {r["doc_id"]: r for r in found}
    for i, text in rows:
        r, spans = by_id[i], base_spans(text)
        listed = [f"{kind}:{start}:{end}" for start, _, end, kind in spans]
        assert [r[f"n_{kind}"] for kind in KINDS] == [sum(s[3] == kind for s in spans) for kind in KINDS]
        assert r["base_sha256"] == sha(",".join(listed))
        all_ = [x for x in r["spans"].split(",") if x]
        assert set(listed) <= set(all_) and len(all_) == len(listed) + r["n_added"]
        places = [(int(x.split(":")[1]), list(KINDS).index(x.split(":")[0])) for x in all_]
        assert places == sorted(places)
        assert all(0 <= int(s) < int(e) <= len(text) for _, s, e in (x.split(":") for x in all_))


def test_query(spark, given):
    rows = [(r["doc_id"], r["text"]) for r in given("documents").collect()]
    check(rows, QUERIES["op9_personal_data"](spark, SF_DIR).collect())


def test_base_spans_of_random_texts(texts):
    draw = random.Random(3)
    rows = [(i, "".join(draw.choice(PIECES) for _ in range(draw.randrange(30)))) for i in range(800)]
    check(rows, personal_data_report(texts(rows)).collect())


def test_edge_rows(texts, clash):
    rows = [
        (0, None), (1, ""), (2, "a@b.c_d@e.f x@y.z.@q.r %%a@b.co"), (3, "1.2.3.4.5.6.7.8 01.002.0255.3 1.2.3"),
        (4, "é4111 1111 1111 1111 +1 (607) 555-1595😀"), (5, "1 " * 40_000), (6, "a" * 100_000 + "@" + "b." * 30_000),
        (7, "+" * 20_000 + "9." * 200), (8, "a@b.c" * 300), (None, "write to a@b.cd"),
    ]
    check(rows, personal_data_report(clash(texts(rows))).collect())
    assert personal_data_report(texts([])).collect() == []


def test_repeated_rows(texts):
    found = personal_data_report(texts([(1, "a@b.cd"), (1, "a@b.cd")])).collect()
    assert len(found) == 2 and found[0] == found[1]


def test_trees_add_numbers_inside_longer_runs(texts):
    draw = random.Random(5)
    cards = ["4111111111111111", "5500000000000004", "4012888888881881"]
    rows = [(i, f"some words {draw.choice(cards)} and +1 (2{i % 90 + 10}) 555-{1000 + i} more") for i in range(200)]
    rows += [(300 + i, f"some words {4111111111111112 + 10 * i} and others") for i in range(100)]
    joined = f"first 9999999999999995 {cards[0]} last"
    rows.append((500, joined))
    found = {r["doc_id"]: r for r in personal_data_report(texts(rows)).collect()}
    check(rows, list(found.values()))
    at = joined.index(cards[0])
    assert f"card:{at}:{at + 16}" in found[500]["spans"].split(",")
    failing = [i for i, text in rows if 300 <= i < 400 and not base_spans(text)]
    assert all(found[i]["spans"] == "" for i in failing) and len(failing) > 50


@pytest.mark.parametrize("percent", [1, 50])
def test_contact_words_settle_what_the_rules_leave(texts, percent):
    national = ["call 212-555-{n}", "phone: (212) 555-{n}", "Email bob{n} (at) site.org", "contact ann{n}[at]mail.co.uk"]
    rows, kinds = [], {}
    for i in range(400):
        if i % 100 < percent:
            rows.append((i, national[len(kinds) % 4].format(n=1000 + i) + " today"))
            kinds[i] = "phone" if "555" in rows[-1][1] else "email"
        else:
            rows.append((i, f"reach +1 (607) 555-{1000 + i} or q{i}@site.org"))
    rows += [(1000 + i, f"order 212-555-{1000 + i} was sent") for i in range(percent)]
    rows += [(2000, "the border 1 hotel order 212 555 1234"), (2001, "call about order 212 555 1234")]
    found = {r["doc_id"]: r for r in personal_data_report(texts(rows)).collect()}
    check(rows, list(found.values()))
    assert set(kinds.values()) == {"phone", "email"}
    for i, kind in kinds.items():
        assert found[i]["n_added"] == 1 and found[i]["spans"].startswith(f"{kind}:")
    assert all(r["n_added"] == 0 for i, r in found.items() if i >= 1000)


def test_a_form_without_evidence_is_judged_by_those_with(texts):
    def report(orders):
        rows = [(i, f"call 212-555-{1000 + i} now") for i in range(200)]
        rows += [(1000 + i, f"order 212-555-{1000 + i} now") for i in range(orders)]
        rows += [(5000, "so it was 212-555-9999 then")]
        return {r["doc_id"]: r["n_added"] for r in personal_data_report(texts(rows)).collect()}

    assert report(0)[5000] == 1 and report(200)[5000] == 0


def test_main_path_is_native(spark, given):
    plan = QUERIES["op9_personal_data"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "Exchange"))


@pytest.fixture
def examples():
    draw = np.random.default_rng(1)
    x = draw.integers(0, 4, (200, 3))
    count = draw.integers(1, 9, 200).astype(float)
    chance = np.where((x[:, 0] > 1) & (x[:, 2] == 3), 0.9, 0.05)
    return x, count, draw.binomial(count.astype(int), chance).astype(float)


def test_boosting_finds_an_interaction(examples):
    x, count, positive = examples
    start, trees = boosting.grow_trees(x, count, positive, 20, 2, 0.5)
    margin = start + sum(boosting.evaluate(t, x) for t in trees)
    hot = (x[:, 0] > 1) & (x[:, 2] == 3)
    assert margin[hot].min() > 0 > margin[~hot].max()
    a, b = boosting.calibrate(margin, count, positive)
    assert a > 0
    p = 1 / (1 + np.exp(-(a * margin + b)))
    assert (p * count).sum() == pytest.approx(positive.sum(), rel=0.1)


def test_trees_as_sql_agree(spark, examples):
    x, count, positive = examples
    _, trees = boosting.grow_trees(x, count, positive, 5, 3, 0.5)
    frame = spark.createDataFrame([[int(v) for v in row] for row in x], "a int, b int, c int")
    sql = " + ".join(boosting.tree_sql(t, ["a", "b", "c"]) for t in trees)
    got = [r[0] for r in frame.selectExpr(sql).collect()]
    assert got == pytest.approx(sum(boosting.evaluate(t, x) for t in trees).tolist())


def test_threshold_keeps_precision():
    p = np.array([0.9, 0.8, 0.8, 0.3])
    count, positive = np.array([10.0, 5, 5, 50]), np.array([10.0, 5, 4, 1])
    assert boosting.lowest_threshold(p, count, positive, 0.95) == 0.8
    assert boosting.lowest_threshold(p, count, positive, 0.97) == 0.9
    assert boosting.lowest_threshold(p, count, np.zeros(4), 0.5) == 2.0
    assert boosting.lowest_threshold(p[:0], count[:0], positive[:0], 0.5) == 2.0


def test_many_spans_in_one_text(spark, texts):
    """Work follows the spans of a text: a server log of addresses, and candidates of all kinds."""
    lines = [f"10.{i // 65536}.{i // 256 % 256}.{i % 256} GET /x{i}" for i in range(100_000)]
    log = "\n".join(lines)
    started = time.perf_counter()
    found = personal_data_report(texts([(1, log), (2, "a@b.cd")]).coalesce(1)).collect()
    assert time.perf_counter() - started < 20
    by_id = {r["doc_id"]: r for r in found}
    assert by_id[1]["n_ip"] == 100_000
    starts = np.cumsum([0] + [len(x) + 1 for x in lines[:-1]])
    listed = ",".join(f"ip:{s}:{s + x.index(' ')}" for s, x in zip(starts.tolist(), lines))
    assert by_id[1]["base_sha256"] == sha(listed)


def test_values_before_each_place(spark):
    rows = [(i, [random.Random(i).randrange(-5, 50) for _ in range(n)]) for i, n in enumerate([0, 1, 2, 63, 64, 65, 200, 9000])]
    frame = spark.createDataFrame(rows, "i int, v array<int>")
    sums = _earlier(F.col("v"), lambda x, y: x + y, F.lit(0)).alias("sums")
    most = _earlier(F.col("v"), lambda x, y: F.greatest(x, y), F.lit(-9)).alias("most")
    for row in frame.select("i", "v", sums, most).collect():
        assert row["sums"] == [sum(row["v"][:k]) for k in range(len(row["v"]))][: len(row["v"])]
        assert row["most"] == np.maximum.accumulate([-9, *row["v"]])[:-1].tolist()
