"""Divergence of sources against a direct form and DuckDB."""

import re
from collections import Counter, defaultdict

import duckdb
import pytest

from sluiceway.llm import divergence
from sluiceway.llm.divergence import DIVERGENCE_SQL, divergence_report
from sluiceway.llm.queries import op11_source_divergence
from tests.llm.conftest import SF_DIR, collected

SCHEMA = "doc_id bigint, text string, lang string, source string"


def brute(rows, least=10, top=10):
    """``lang, source, part, item, value, rank`` from rows of text, language and source."""
    rows = [tuple(x or "" for x in row) for row in rows]
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    counts, documents = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text.translate(fold))
        documents[lang].update(set(terms))
        counts[lang, source].update(terms)
        counts[lang, None].update(terms)
    kept = {lang: [t for t, n in c.items() if n >= least] for lang, c in documents.items()}

    def p(lang, source, term):
        total = sum(counts[lang, source][t] for t in kept[lang])
        return 1 + 10**9 * (counts[lang, source][term] + 2) // (total + 2 * len(kept[lang]))

    result = []
    groups = {(lang, source) for _, lang, source in rows}
    for lang, source in groups:
        pairs = []
        for other in {s for g, s in groups if g == lang and s != source}:
            cells = [(p(lang, source, t), p(lang, other, t)) for t in kept[lang]]
            pairs.append((-sum((a - b) ** 2 // (a + b) for a, b in cells), other))
        terms = []
        for t in kept[lang]:
            a, b = p(lang, source, t), p(lang, None, t)
            if counts[lang, source][t] and a > b:
                terms.append((-((a - b) ** 2 // (a + b)), t))
        for part, items, most in (("pair", pairs, len(pairs)), ("term", terms, top)):
            ordered = sorted(items, key=lambda x: (x[0], x[1].encode()))[:most]
            result += [(lang, source, part, x, -v, i) for i, (v, x) in enumerate(ordered, 1)]
    return sorted(result, key=repr)


def rows_of(spark, rows):
    return spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], SCHEMA)


WORDS = ["Ähm", "ähm", "The", "the", "a1b", "x-y", "ÉTÉ", "日本", "z"]
MIXED = [
    (" ".join(WORDS[(i * k + k) % 9] for k in range(i % 7)) or None, [None, "en", "", "fr"][i % 4], [None, "s", "t", "ué"][i // 3 % 4])
    for i in range(120)
]


@pytest.mark.parametrize("least", [1, 3, 10])
def test_equals_a_direct_form(spark, clash, least):
    documents = rows_of(spark, MIXED)
    expected = brute(MIXED, least, 2)
    found = divergence_report(clash(documents), least, 2)
    assert collected(found) == expected and expected


def test_many_sources_are_compared_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(divergence, "GROUPS_AT_ONCE", 3)
    monkeypatch.setattr(divergence, "BLOCK_WORDS", 1)
    rows = [
        (" ".join(f"w{chr(97 + (i * j) % 26)}{chr(97 + j % 11)}" for j in range(40)), "en", f"s{i % 10}")
        for i in range(60)
    ]
    assert collected(divergence_report(rows_of(spark, rows), 2)) == brute(rows, 2)


def test_languages_without_kept_terms_and_empty_tables(spark):
    rows = [("one", "en", "a"), ("two", "en", "b"), (None, "fr", "c")]
    assert collected(divergence_report(rows_of(spark, rows))) == [
        ("en", "a", "pair", "b", 0, 1),
        ("en", "b", "pair", "a", 0, 1),
    ]
    assert collected(divergence_report(rows_of(spark, []))) == []


def test_counts_are_added_up_in_bounded_memory(spark, monkeypatch):
    monkeypatch.setattr(divergence, "BUFFERED_ROWS", 4)
    assert collected(divergence_report(rows_of(spark, MIXED), 2)) == brute(MIXED, 2)


def test_large_counts_stay_exact(spark):
    row = spark.range(1).select(
        *(
            divergence.probability(*(divergence.F.lit(x).cast("bigint") for x in (n, total, v))).alias(f"p{v}")
            for n, total, v in ((10**17, 3 * 10**17, 7), (5, 3, 0))
        )
    ).head()
    assert row.p7 == 1 + 10**9 * (10**17 + 2) // (3 * 10**17 + 14)
    assert row.p0 == 1 + 10**9 * 7 // 3


def test_query_equals_sql(spark):
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF_DIR}/documents.parquet')")
    expected = sorted(connection.execute(DIVERGENCE_SQL).fetchall(), key=repr)
    assert collected(op11_source_divergence(spark, SF_DIR)) == expected
