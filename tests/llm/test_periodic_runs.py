"""Runs against a direct search for every period."""

import hashlib
import random
import re
import time
import zlib

import numpy as np
import pytest

from sluiceway.llm.periodic_runs import find_runs, run_report, runs_of
from sluiceway.llm.queries import op13_periodic_runs
from tests.llm.conftest import SF_DIR, collected


def brute(words, least):
    found = set()
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            if j > i and length >= max(least, 2 * q):
                if not any(words[i : j + q - r] == words[i + r : j + q] for r in range(1, q)):
                    found.add((i, length, q))
            i = max(j, i + 1)
    return sorted(found, key=lambda run: (run[0], run[2]))


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def repetitive(rng, most):
    kinds = rng.choice([1, 2, 3, 6, 40])
    words = [f"w{rng.randrange(kinds)}" for _ in range(rng.randrange(most))]
    if len(words) > 3 and rng.random() < 0.6:
        a = rng.randrange(len(words))
        p = rng.randint(1, max(1, (len(words) - a) // 2))
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return words


@pytest.mark.parametrize("least", [2, 5, 12])
def test_runs_of_numbers(least):
    rng = random.Random(least)
    for _ in range(400):
        words = repetitive(rng, 60)
        numbers: dict[str, int] = {}
        codes = np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64)
        assert sorted(runs_of(codes, least), key=lambda r: (r[0], r[2])) == brute(words, least)


def test_texts(spark, clash, texts):
    rng = random.Random(5)
    rows = []
    for i in range(150):
        # Repetitive parts between words that occur once.
        words = []
        for part in range(rng.randrange(4)):
            words += repetitive(rng, 50) + [f"u{i}.{part}.{k}" for k in range(rng.randrange(5))]
        rows.append((i, rng.choice([" ", "\t\n", "  "]).join(words)))
    rows += [(200, None), (201, ""), (202, " \n"), (203, "A a " * 20), (None, "x " * 12), (203, "A a " * 20)]
    found = find_runs(clash(texts(rows)), min_length=12).collect()
    assert len(found) == len(rows)
    by_id = {}
    for i, text in rows:
        words = (text or "").split()
        by_id[i] = (words, brute(words, 12))
    for row in found:
        words, runs = by_id[row.doc_id]
        assert [tuple(r) for r in row.runs] == runs
        assert row.n_words == len(words) and row.collapsed == collapsed(words, runs)
    assert collected(find_runs(texts([]))) == []


def test_ties_of_the_report(spark, texts):
    text = "a b c d e f " * 3 + "x " + "g " * 18 + "y " + "h i " * 9
    row = run_report(texts([(1, text), (2, "one")])).orderBy("doc_id").collect()
    assert row[0][1:6] == (3, 0, 18, 6, 3000)
    assert row[1][1:6] == (0, None, None, None, None)
    assert row[1].runs_sha256 == hashlib.sha256(b"").hexdigest()


def test_long_texts_take_linear_time():
    rng = random.Random(1)
    base = [rng.randrange(1000) for _ in range(20_000)]
    for codes in ([0] * 200_000, base * 10, [rng.randrange(2) for _ in range(30_000)]):
        started = time.perf_counter()
        runs_of(np.array(codes, np.int64), 12)
        assert time.perf_counter() - started < 1e-4 * len(codes)


def planted(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return words


def test_query_over_the_whole_table(spark, given):
    rows = {r.doc_id: r.text for r in given("documents").collect()}
    found = op13_periodic_runs(spark, SF_DIR).collect()
    assert len(found) == len(rows)
    some = 0
    for row in found:
        words = planted(row.doc_id, rows[row.doc_id])
        runs = brute(words, 12) if len(words) < 700 else None
        if runs is None:
            continue
        some += bool(runs)
        assert row.n_runs == len(runs)
        listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        assert row.runs_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert row.collapsed_sha256 == hashlib.sha256(collapsed(words, runs).encode()).hexdigest()
        if runs:
            s, n, q = min(runs, key=lambda r: (-r[1], r[0], r[2]))
            assert (row.start, row.length, row.period, row.exponent_milli) == (s, n, q, 1000 * n // q)
    assert some >= 10
