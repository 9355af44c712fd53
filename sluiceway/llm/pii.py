"""Find personal data: rules, and boosted trees over further candidates. Native Spark only.

Base spans come from one rule for each kind, leftmost and non-overlapping. Generators of
high recall propose more spans, which may overlap: numbers inside longer runs that the
rules reject as a whole, numbers without a country code, obscured addresses. Evidence
settles most of them, whether or not they are base spans: check digit, octets, number of
digits, ending of the domain, and the nearest word before that speaks for contact data or
for something else. Boosted trees judge the candidates without evidence, by the features of
their format and surroundings that are no evidence for their kind. They learn from the
candidates with evidence, over all documents: these are folded into a table of distinct
feature rows, bounded by the feature space, and the trees go back into the query as SQL
expressions. A part of the documents, by the hash of their text, is left out of learning and
used to turn scores into probabilities and to choose each kind's threshold for a precision of
``PRECISION`` among candidates that are no base spans, as only such are judged.

All patterns are possessive where they repeat, so that long runs neither backtrack nor
recurse. They find the same spans as the plain forms in the contract.

Defined results: a NULL text is empty and has no spans. Rows are independent, so ties,
repeated rows and NULL ids need no rule. An empty table gives an empty result. Only the two
named columns are read. Positions are code points from 0, ends exclusive.
"""

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluiceway.llm.boosting import calibrate, evaluate, grow_trees, lowest_threshold, tree_sql
from sluiceway.llm.frames import col

# Kinds in the order in which spans of one start are listed.
KINDS = ("email", "ip", "card", "phone")

ROUNDS, DEPTH, RATE = 12, 3, 0.5
PRECISION = 0.95

_LOCAL = "[A-Za-z0-9._%+-]"
_DOMAIN = r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
# A match may begin where a run of its characters begins, or where the last match ended.
_FRESH_LOCAL = rf"(?:(?<!{_LOCAL})|\G)"

#: Kind, what a text must contain (a cheap test), and the pattern; base rules first.
RULES = (
    ("email", "@", rf"{_FRESH_LOCAL}{_LOCAL}++@{_DOMAIN}"),
    ("ip", r"[0-9]\.[0-9]", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"),
    # Runs of digits with single separators, of 12 to 19 digits as a whole.
    (
        "card",
        "[0-9][ -]?[0-9][ -]?[0-9][ -]?[0-9]",
        "(?<![0-9])(?<![0-9][ -])(?:[0-9][ -]?){11,18}[0-9](?![ -]?[0-9])",
    ),
    ("phone", r"\+[0-9]", r"\+[0-9][ ().0-9-]+[0-9]"),
)
GENERATORS = (
    ("email", r"(?i)[(\[]at[)\]]", rf"(?<!{_LOCAL}){_LOCAL}{{1,64}} ?[(\[](?i:at)[)\]] ?{_DOMAIN}"),
    ("ip", r"[0-9]\.[0-9]", r"(?<![0-9])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9])"),
    (
        "card",
        "[0-9]{4}[ -]?[0-9]{4}",
        "(?<![0-9])(?:[0-9]{4}[ -][0-9]{4}[ -][0-9]{4}[ -][0-9]{4}|[0-9]{12,19})(?![0-9])",
    ),
    (
        "phone",
        r"\+[0-9]",
        r"\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)|[0-9]{1,4})(?:[ .-][0-9]{2,4}){2,3}(?![0-9])",
    ),
    (
        "phone",
        "[0-9]{3}[ .-][0-9]{4}",
        r"(?<![0-9+(])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])",
    ),
)

# Words near a number that speak for contact data, or for something else.
_CONTACT = "(?:tele|cell|smart)?phone|tel|call|fax|mobile|e?mail|contact|card|visa|address"
_OTHER = "token|passw|(?:api)?key|secret|version|(?:re)?order|invoice|serial|hash"
#: Up to the last of these words; the group is there if it is one for contact data.
_WORDS = rf"(?is)^.*(?<![a-z])(?:({_CONTACT})|(?:{_OTHER}))"

FEATURES = ("kind", "digits", "groups", "luhn", "octets", "plus", "before", "after", "length")
#: Features that are evidence for a kind, so its trees don't see them.
EVIDENCE = {"digits": ("card", "phone"), "luhn": ("card",), "octets": ("ip",), "plus": ("phone",)}

_SPAN = "array<struct<k:int,s:int,e:int,t:string,b:string,a:string>>"


def _bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _larger(x: Column, y: Column) -> Column:
    return F.greatest(x, y)


def _earlier(values: Column, combine: Callable[[Column, Column], Column], zero: Column) -> Column:
    """For each place of an array of integers, all values before it combined.

    Each pass combines a place with the one 1, 2, 4, ... places before, so there are as many
    passes as the array's length has binary digits. A fold with a growing array would copy that
    array at each place.
    """

    def passed(done: Column, step: Column) -> Column:
        return F.transform(
            done, lambda x, i: F.when(i >= step, combine(x, F.get(done, i - step))).otherwise(x)
        )

    def all_passes(items: Column) -> Column:
        steps = F.filter(F.array(*(F.lit(1 << k) for k in range(31))), lambda s: s < F.size(items))
        return F.aggregate(steps, items, passed)

    def moved(done: Column) -> Column:
        return F.transform(done, lambda _, i: F.when(i > 0, F.get(done, i - 1)).otherwise(zero))

    values = values.cast("array<int>")
    return _bound(values, lambda items: _bound(all_passes(items), moved))


def _spans(kind: str, name: str) -> Column:
    """Spans from ``<name>_hits`` and ``<name>_parts``: the matches and what is between."""
    hits, parts = F.col(f"{name}_hits"), F.col(f"{name}_parts")
    sizes = F.zip_with(hits, parts, lambda h, p: F.coalesce(F.length(h) + F.length(p), F.lit(0)))
    before = _earlier(sizes, lambda x, y: x + y, F.lit(0))
    after = F.slice(parts, F.lit(2), F.greatest(F.size(parts), F.lit(1)))
    zipped = F.arrays_zip(hits, parts, after, before)
    zipped = zipped.cast("array<struct<h:string,p:string,n:string,at:int>>")

    def span(x: Column) -> Column:
        first = x["at"] + F.length(x["p"])
        return F.struct(
            F.lit(KINDS.index(kind)).alias("k"),
            first.alias("s"),
            (first + F.length(x["h"])).alias("e"),
            x["h"].alias("t"),
            F.substring(x["p"], -20, 20).alias("b"),
            F.substring(F.coalesce(x["n"], F.lit("")), 1, 1).alias("a"),
        )

    return F.transform(F.filter(zipped, lambda x: x["h"].isNotNull()), span)


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn(text: Column) -> Column:
    """Whether the digits of a text pass the check: every second one from the right doubles."""
    total = F.aggregate(
        F.split(F.reverse(_digits(text)), ""),
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("sum")),
        lambda state, digit: F.struct(
            (state["n"] + 1).alias("n"),
            (
                state["sum"]
                + F.when(state["n"] % 2 == 0, digit.try_cast("int")).otherwise(
                    F.element_at(
                        F.array(*(F.lit(2 * d - 9 * (d > 4)) for d in range(10))),
                        digit.try_cast("int") + 1,
                    )
                )
            ).alias("sum"),
        ),
        lambda state: state["sum"],
    )
    return F.coalesce(total % 10 == 0, F.lit(False))


_OCTETS = r"^0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?:\.0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])){3}$"


def _valid(span: Column) -> Column:
    """The tests that base spans of each kind must pass."""
    digits = F.length(_digits(span["t"]))
    return (
        F.when(span["k"] == KINDS.index("ip"), F.rlike(span["t"], F.lit(_OCTETS)))
        .when(span["k"] == KINDS.index("card"), digits.between(12, 19) & _luhn(span["t"]))
        .when(span["k"] == KINDS.index("phone"), digits.between(9, 15))
        .otherwise(True)
    )


def _char_class(char: Column) -> Column:
    """0 none, 1 space, 2 digit, 3 letter, 4 other."""
    return (
        F.when(char == "", 0)
        .when(F.rlike(char, F.lit(r"\s")), 1)
        .when(F.rlike(char, F.lit("[0-9]")), 2)
        .when(F.rlike(char, F.lit(r"\p{L}")), 3)
        .otherwise(4)
    )


def _evidence(span: Column) -> Column:
    """1 for a candidate that is personal data by evidence, 0 for one that is not, -1 for none."""
    text, before = span["t"], span["b"]
    digits = F.length(_digits(text))
    told = F.rlike(before, F.lit(_WORDS))
    contact = F.regexp_extract(before, _WORDS, 1) != ""
    address = F.rlike(text, F.lit(r"^[^A-Za-z@(\[]*+[A-Za-z]")) & F.rlike(text, F.lit(r"\.[A-Za-z]{2,}+$"))
    card = digits.between(12, 19) & _luhn(text)
    ip = F.rlike(text, F.lit(_OCTETS))
    inside = F.rlike(before, F.lit(r"[0-9]\.$"))  # a longer run of numbers and dots
    # Whether the form can be right, and whether it is evidence without a word.
    right = (
        F.when(span["k"] == KINDS.index("email"), address)
        .when(span["k"] == KINDS.index("ip"), ip)
        .when(span["k"] == KINDS.index("card"), card)
        .otherwise(digits.between(9, 15))
    )
    enough = (
        F.when(span["k"] == KINDS.index("email"), F.contains(text, F.lit("@")))
        .when(span["k"] == KINDS.index("ip"), ~inside)
        .when(span["k"] == KINDS.index("card"), True)
        .otherwise(F.startswith(text, F.lit("+")))
    )
    return F.when(~right, 0).when(contact, 1).when(told, 0).when(enough, 1).otherwise(-1)


def _features(span: Column) -> list[Column]:
    text = span["t"]
    values = (
        span["k"],
        F.least(F.length(_digits(text)), F.lit(24)),
        F.least(F.size(F.split(text, "[^0-9]+")), F.lit(8)),
        F.when(F.length(_digits(text)).between(12, 19), _luhn(text).cast("int")).otherwise(0),
        F.rlike(text, F.lit(_OCTETS)).cast("int"),
        F.startswith(text, F.lit("+")).cast("int"),
        _char_class(F.substring(span["b"], -1, 1)),
        _char_class(span["a"]),
        F.least(F.length(text), F.lit(32)),
    )
    seen = []
    for name, value in zip(FEATURES, values):
        hidden = span["k"].isin([KINDS.index(kind) for kind in EVIDENCE.get(name, ())])
        seen.append((F.when(hidden, 0).otherwise(value) if name in EVIDENCE else value).cast("int").alias(name))
    return seen


def _with_spans(documents: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, held``, and the arrays ``base`` and ``more``: base spans, and candidates that
    are not inside one."""
    text = F.coalesce(col(text_col).cast("string"), F.lit(""))
    rows = documents.select(col(id_col).alias("doc_id"), text.alias("text"))
    patterns = {f"r{i}": rule for i, rule in enumerate(RULES + GENERATORS)}
    found = []
    for name, (_, needs, pattern) in patterns.items():
        there = F.rlike("text", F.lit(needs))
        hits = F.regexp_extract_all("text", F.lit(pattern), F.lit(0))
        found.append(F.when(there, hits).otherwise(F.array().cast("array<string>")).alias(f"{name}_hits"))
        parts = F.when(there, F.split("text", pattern, -1)).otherwise(F.array().cast("array<string>"))
        found.append(parts.alias(f"{name}_parts"))
    held = F.pmod(F.xxhash64("text"), F.lit(4)) == 0
    rows = rows.select("doc_id", held.alias("held"), *found)
    spans = {name: _spans(rule[0], name).alias(name) for name, rule in patterns.items()}
    rows = rows.select("doc_id", "held", *spans.values())
    names = list(patterns)
    base = F.filter(F.concat(*names[: len(RULES)]), _valid)
    rows = rows.select("doc_id", "held", base.alias("base"), F.concat(*names).alias("all"))
    return rows.select("doc_id", "held", "base", _outside("all", "base").alias("more"))


def _outside(spans: str, base: str) -> Column:
    """Spans that are not inside (or equal to) a base span, by the furthest end of those that
    begin no later."""

    def keyed(rank: int):
        return lambda s: F.struct(s["s"], F.lit(rank).alias("rank"), *(s[f] for f in "ektba"))

    ordered = F.array_sort(F.concat(F.transform(base, keyed(0)), F.transform(spans, keyed(1))))

    def beyond(ordered: Column) -> Column:
        ends = F.transform(ordered, lambda s: F.when(s["rank"] == 0, s["e"]).otherwise(-1))
        kept = F.filter(
            F.arrays_zip(ordered.alias("span"), _earlier(ends, _larger, F.lit(-1)).alias("reach")),
            lambda x: (x["span"]["rank"] == 1) & (x["span"]["e"] > x["reach"]),
        )
        return F.transform(kept, lambda x: F.struct(*(x["span"][f] for f in "ksetba")))

    return _bound(ordered, beyond).cast(_SPAN)


def _widest(spans: str) -> Column:
    """Of nested redactions the widest, of equal ones the likeliest, then the first kind."""
    keyed = F.transform(
        spans,
        lambda c: F.struct(
            c["s"].alias("s"), (-c["e"]).alias("back"), (-c["p"]).alias("unlikely"), *(c[f] for f in "ketp")
        ),
    )

    def outermost(ordered: Column) -> Column:
        reach = _earlier(F.transform(ordered, lambda c: c["e"]), _larger, F.lit(-1))
        zipped = F.arrays_zip(ordered.alias("span"), reach.alias("reach"))
        kept = F.filter(zipped, lambda x: x["span"]["e"] > x["reach"])
        return F.transform(kept, lambda x: F.struct(*(x["span"][f] for f in "ksetp")))

    return _bound(F.array_sort(keyed), outermost)


class SpanModel:
    """Trees, calibration and thresholds, and the SQL that applies them."""

    def __init__(self, table: list, rounds: int, depth: int, rate: float, precision: float):
        x = np.array([[r[f] for f in FEATURES] for r in table], np.int64).reshape(-1, len(FEATURES))
        held = np.array([r["held"] for r in table], bool)
        more = np.array([r["more"] for r in table], bool)
        count = np.array([r["n"] for r in table], float)
        positive = np.array([r["positive"] for r in table], float)
        own = ~held
        self.start, self.trees = grow_trees(x[own], count[own], positive[own], rounds, depth, rate)
        margin = self.start + sum((evaluate(t, x[held]) for t in self.trees), np.zeros(held.sum()))
        self.scale, self.shift = calibrate(margin, count[held], positive[held])
        p = 1 / (1 + np.exp(-(self.scale * margin + self.shift)))
        self.thresholds = []
        for kind in range(len(KINDS)):
            some = (x[held][:, 0] == kind) & more[held]
            self.thresholds.append(
                lowest_threshold(p[some], count[held][some], positive[held][some], precision)
            )

    def probability_sql(self, names: list[str]) -> str:
        total = " + ".join([f"{self.start!r}D", *(tree_sql(t, names) for t in self.trees)])
        return f"1 / (1 + exp(-({self.scale!r}D * ({total}) + {self.shift!r}D)))"


def fit_spans(rows: DataFrame) -> SpanModel:
    """Learn from the candidates with evidence which of them are personal data."""

    def told(name: str) -> Column:
        more = F.lit(name == "more")
        return F.transform(name, lambda c: F.struct(c.alias("c"), more.alias("more")))

    rows = rows.select("held", F.inline(F.concat(told("base"), told("more"))))
    rows = rows.select("held", "more", _evidence(F.col("c")).alias("label"), *_features(F.col("c")))
    table = rows.where("label >= 0").groupBy("held", "more", *FEATURES).agg(
        F.count(F.lit(1)).alias("n"), F.sum("label").alias("positive")
    )
    return SpanModel(table.collect(), ROUNDS, DEPTH, RATE, PRECISION)


def find_personal_data(
    documents: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, base, added`` of every row: arrays of spans with ``kind, start, end, text``,
    and for the added ones their ``probability``, which is 1 where evidence settles it."""
    rows = _with_spans(documents, id_col, text_col)
    model = fit_spans(rows)

    def judged(span: Column) -> Column:
        told = _evidence(span).alias("label")
        return F.struct(*(span[f] for f in ("k", "s", "e", "t")), told, *_features(span))

    rows = rows.select("doc_id", "base", F.transform("more", judged).alias("more"))
    probability = model.probability_sql([f"c.{name}" for name in FEATURES])
    threshold = "CASE c.k " + " ".join(
        f"WHEN {k} THEN {t!r}D" for k, t in enumerate(model.thresholds)
    ) + " END"
    scored = (
        "filter(transform(filter(more, c -> c.label <> 0), c -> named_struct("
        "'k', c.k, 's', c.s, 'e', c.e, 't', c.t, "
        f"'p', IF(c.label = 1, 1D, {probability}), 'least', IF(c.label = 1, 1D, {threshold}))), "
        "x -> x.p >= x.least)"
    )
    rows = rows.select("doc_id", "base", F.expr(scored).alias("more"))
    names = F.array(*map(F.lit, KINDS))

    def named(span: Column, *others: Column) -> Column:
        return F.struct(
            F.element_at(names, span["k"] + 1).alias("kind"),
            span["s"].alias("start"),
            span["e"].alias("end"),
            span["t"].alias("text"),
            *others,
        )

    return rows.select(
        "doc_id",
        F.transform("base", lambda s: named(s)).alias("base"),
        F.transform(_widest("more"), lambda s: named(s, s["p"].alias("probability"))).alias("added"),
    )


def _listed(spans: Column) -> Column:
    """``kind:start:end`` by start, then kind as listed, comma-joined."""
    place = F.array(*map(F.lit, KINDS))
    ordered = F.array_sort(
        F.transform(
            spans,
            lambda s: F.struct(
                s["start"].alias("start"), F.array_position(place, s["kind"]).alias("k"), s["end"].alias("end"), s["kind"].alias("kind")
            ),
        )
    )
    return F.array_join(F.transform(ordered, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def personal_data_report(documents: DataFrame, **options) -> DataFrame:
    """``doc_id``, the number of base spans of each kind, ``base_sha256``, ``spans`` (base and
    added) and ``n_added``."""
    found = find_personal_data(documents, **options)
    kinds = F.col("base.kind")
    counts = [
        (F.size(kinds) - F.size(F.array_remove(kinds, kind))).cast("bigint").alias(f"n_{kind}")
        for kind in KINDS
    ]
    plain = F.transform("added", lambda s: F.struct(s["kind"], s["start"], s["end"], s["text"]))
    return found.select(
        "doc_id",
        *counts,
        F.sha2(_listed(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        _listed(F.concat("base", plain)).alias("spans"),
        F.size("added").cast("bigint").alias("n_added"),
    )
