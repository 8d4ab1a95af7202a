"""Plain versions of the operators, straight from their definitions."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
KINDS = ("email", "ip", "card", "phone")
PII = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def words(text):
    return WORD.findall(text or "")


def measures(text):
    text, w = text or "", words(text)
    grams = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    covered = {i + j for i in range(len(w) - 4) if grams[tuple(w[i : i + 5])] > 1 for j in range(5)}
    lines = Counter(x for x in text.split("\n") if WORD.search(x))
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), sum(n - 1 for n in lines.values()), len(covered)


def shingles(text):
    w = words("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)])


def components(links, nodes):
    up = {n: n for n in nodes}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def near(docs, percent=85):
    """{doc_id: (n_shingles, component)} of (doc_id, text) with distinct ids."""
    sets = {d: shingles(t) for d, t in docs}
    ids = sorted(d for d in sets if sets[d])
    links = [
        (a, b) for k, a in enumerate(ids) for b in ids[k + 1 :]
        if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    comp = components(links, sets)
    return {d: (len(sets[d]), comp[d]) for d in sets}


def without_repeats(docs, width=35):
    """[(doc_id, n_words, n_removed, kept)] of (doc_id, text) rows."""
    seen = Counter(tuple(w[i : i + width]) for _, t in docs for w in [words(t)] for i in range(len(w) - width + 1))
    out = []
    for d, t in docs:
        w = words(t)
        gone = {i + j for i in range(len(w) - width + 1) if seen[tuple(w[i : i + width])] > 1 for j in range(width)}
        out.append((d, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (2 if i % 2 else 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def personal(text):
    """[(start, kind, end)] of the base spans."""
    out = []
    for k, kind in enumerate(KINDS):
        for m in re.finditer(PII[kind], text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            if {
                "email": True, "ip": kind != "ip" or all(int(p) <= 255 for p in m.group().split(".")),
                "card": 14 <= len(digits) <= 19 and luhn(digits), "phone": 10 <= len(digits) <= 15,
            }[kind]:
                out.append((m.start(), k, m.end()))
    return sorted(out)


def named(spans):
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def groups(rows, key):
    out = defaultdict(list)
    for r in rows:
        out[key(r)].append(r)
    return out
