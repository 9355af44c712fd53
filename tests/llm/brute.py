"""Plain Python forms of the contracts, for small tables."""

import hashlib
import re
from collections import defaultdict

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACE = " \t\n\x0b\x0c\r"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def shingle_set(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not words:
        return set()
    size = min(size, len(words))
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


class Union:
    def __init__(self):
        self.parent = {}

    def find(self, x):
        while self.parent.setdefault(x, x) != x:
            x = self.parent[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.parent[max(a, b)] = min(a, b)


def near_duplicates(rows, size, percent=80):
    sets = [(i, shingle_set(t, size)) for i, t in rows]
    union = Union()
    for x, (i, a) in enumerate(sets):
        for j, b in sets[:x]:
            if i is not None and j is not None and a and b and 100 * len(a & b) >= percent * len(a | b):
                union.join(i, j)
    return sorted(
        (
            (i, len(s), None if i is None else union.find(i), i is None or union.find(i) == i)
            for i, s in sets
        ),
        key=repr,
    )


def line_report(rows):
    def key(line):
        return line.strip(SPACE).translate(LOWER)

    found = defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 10:
                found[key(line)].add((i is None, i or 0))
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [
            x
            for x in lines
            if len(found.get(key(x), ())) < 2 or min(found[key(x)]) == (i is None, i or 0)
        ]
        out.append((i, len(lines), len(lines) - len(kept), sha("\n".join(kept))))
    return sorted(out, key=repr)


def contamination(rows, items, window=13):
    def words(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))

    windows = defaultdict(set)
    for i, text in items:
        w = words(text)
        n = min(window, len(w))
        if n and i is not None:
            for k in range(len(w) - n + 1):
                windows[tuple(w[k : k + n])].add(str(i))
    lengths = {len(w) for w in windows}
    out = []
    for i, text in rows:
        w, hit, ids = words(text), set(), set()
        for n in lengths:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in windows:
                    hit |= set(range(k, k + n))
                    ids |= windows[tuple(w[k : k + n])]
        dirty = len(hit) > 0 and 20 * len(hit) >= len(w)
        out.append((i, len(w), len(hit), len(ids), sha(",".join(sorted(ids))), dirty))
    return sorted(out, key=repr)


KINDS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for at, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + at % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def base_spans(text):
    spans = []
    for order, (kind, pattern) in enumerate(KINDS.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            good = {
                "email": True,
                "ip": all(int(p) <= 255 for p in m.group().split(".")) if kind == "ip" else True,
                "card": 12 <= len(digits) <= 19 and luhn(digits),
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if good:
                spans.append((m.start(), order, m.end(), kind))
    return sorted(spans)
