"""Plain Python versions of the operators, and small tables with every awkward case."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

BLANK = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
# Names that operators use inside; as extra input columns they must not matter.
CLASHING = ["kept", "keep_id", "digest", "n", "node", "component", "key", "size", "copies", "sketch", "value",
            "line_no", "left", "hash", "pattern", "cls", "start", "end", "score", "features", "part", "file"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHING)


def lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def documents(spark, rows):
    """rows: (doc_id, text) or (doc_id, text, source)."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "web", len(r[1] or "")) + ("x",) * len(CLASHING) for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def sentence(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 6))) for _ in range(n))


def awkward(rng: random.Random):
    """Nulls, empty and blank texts, ties, repeated rows, null ids, a long text, near and exact copies."""
    base = sentence(rng, 120)
    words = base.split(" ")
    rows = [(1, base), (2, base), (3, base.upper()), (4, " ".join(words[:-3] + ["zz", "yy", "xx"])), (5, None), (6, ""),
            (7, " \t\n "), (8, "one two"), (9, "ONE\ttwo"), (10, "one"), (10, "one"), (10, "other words here now and then"),
            (None, "no id at all but some words"), (None, None), (11, sentence(rng, 20_000)), (12, "é ü — ß x  y")]
    for i in range(20, 60):
        cut = rng.randint(0, 12)
        mixed = list(words)
        for _ in range(cut):
            mixed[rng.randrange(len(mixed))] = "w%d" % rng.randrange(1000)
        rows.append((i, " ".join(mixed)))
    for i in range(60, 80):
        rows.append((i, sentence(rng, rng.randint(1, 200))))
    return rows


def shingles(text, n=5):
    w = BLANK.findall(lower(text))
    return {tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def components(sets, linked):
    """Indices joined when ``linked(a, b)``; returns the root of each index."""
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            if sets[i] and sets[j] and linked(sets[i], sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(sets))]


def near(rows):
    """Sorted (doc_id, n_shingles, component_id, kept) of op1."""
    sets = [shingles(r[1]) for r in rows]
    roots = components(sets, lambda a, b: 100 * len(a & b) >= 85 * len(a | b))
    heads = {}
    for r, c in zip(rows, roots):
        heads.setdefault(c, []).append(r[0])
    out = []
    for r, s, c in zip(rows, sets, roots):
        known = [i for i in heads[c] if i is not None]
        head = min(known) if known else None
        out.append((r[0], len(s), head, r[0] == head))
    return sorted(out, key=repr)


def contaminated(rows, items):
    """Sorted rows of op2."""
    out = []
    parsed = [(i, ALNUM.findall(lower(t))) for i, t in items]
    for doc_id, text in [(r[0], r[1]) for r in rows]:
        w = ALNUM.findall(lower(text))
        hit, found = set(), set()
        for item, iw in parsed:
            m = min(13, len(iw))
            grams = {tuple(iw[k:k + m]) for k in range(len(iw) - m + 1)} if m else set()
            for p in range(len(w) - m + 1 if m else 0):
                if tuple(w[p:p + m]) in grams:
                    hit |= set(range(p, p + m))
                    found.add(item)
        names = sorted(str(i) for i in found if i is not None)
        out.append((doc_id, len(w), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(),
                    bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


def held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0
