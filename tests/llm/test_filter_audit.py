import random
from itertools import permutations
from math import factorial

from hypothesis import given, settings
from hypothesis import strategies as st

from garimpo.llm import filter_audit as A

from . import brute


def test_paths_through_each_edge_are_the_orders_that_hold_it():
    for n in (1, 2, 3, 5):
        seen = {}
        for order in permutations(range(n)):
            for step in range(n):
                key = (sum(1 << f for f in order[:step]), order[step])
                seen[key] = seen.get(key, 0) + 1
        assert {(s, f): p for s, f, p in A.path_weights(n)} == seen
    assert sum(p for s, f, p in A.path_weights(6) if s == 0) == factorial(6)


def failures(text):
    words = brute.BLANK.findall(text)
    bad = set()
    if len(words) < 100:
        bad.add("A")
    if 100 * len(set(words)) < 80 * len(words):
        bad.add("B")
    if 100 * sum("A" <= c <= "Z" for c in text) > 10 * len(text):
        bad.add("C")
    if set(text) & set("#$%&*|"):
        bad.add("D")
    return bad


def audited(rows, marks):
    """rows: (doc_id, text, lang); marks: (doc_id, quality, toxic)."""
    ids = {}
    for i, t, _ in rows:
        if i is not None:
            ids.setdefault(t or "", set()).add(i)
    docs = []
    for i, t, part in rows:
        bad = failures(t or "")
        if i is not None and min(ids[t or ""]) < i:
            bad.add("E")
        good = any(m[0] == i and m[1] == 1 for m in marks if i is not None)
        toxic = any(m[0] == i and m[2] == 1 for m in marks if i is not None)
        docs.append((part or "", bad, good, toxic))
    out = {}
    for part in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == part]
        removals = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = mine
            for step, f in enumerate(order):
                gone = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                removals[f] += len(gone)
                out[part, "".join(order), step + 1] = (
                    len(left), len(gone), sum(f in d[1] for d in mine) - len(gone), sum(d[1] == {f} for d in mine),
                    sum(d[2] for d in gone), sum(d[3] for d in gone))
        for (p, order, step), value in list(out.items()):
            if p == part:
                out[p, order, step] = value + (removals[order[step - 1]],)
    return out


def collected(df):
    return {(r.part, r.filter_order, r.step): tuple(r[c] for c in A.COUNTS) for r in df.collect()}


def documents(spark, rows):
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    for name in ("mask", "digest", "good", "toxic", "n", "first", "part", "state", "step", "quality", "edge"):
        frame = frame.withColumn(name, frame.text)
    return frame


def labels(spark, marks):
    frame = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    return frame.withColumn("good", frame.quality).withColumn("mask", frame.toxic).withColumn("part", frame.toxic)


def test_audit_equals_the_replayed_orders(spark):
    rng = random.Random(13)
    rows = [(i, t, rng.choice(["en", "de", "", None])) for i, t in brute.awkward(rng)]
    rows += [(200 + i, rows[0][1], "en") for i in range(30)] + [(7, "x y", "de"), (7, "x y", "de"), (3, "x y", None)]
    rows += [(300, "A" * 10 + "b" * 90, "fr"), (301, "A" * 11 + "b" * 90, "fr"), (302, "ÀÉ" * 40, "fr"),
             (303, " ".join(["a"] * 21 + ["w%d" % i for i in range(79)]), "fr"),
             (304, " ".join(["a"] * 20 + ["w%d" % i for i in range(80)]), "fr"), (305, "50 % | off", "fr")]
    rng.shuffle(rows)
    marks = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 320, 2)] + [(4, 1, 1), (4, 0, 0), (None, 1, 1)]
    assert collected(A.filter_audit(documents(spark, rows), labels(spark, marks))) == audited(rows, marks)


def test_empty_tables(spark):
    none, unlabelled = documents(spark, []), labels(spark, [])
    assert A.filter_audit(none, unlabelled).count() == 0
    rows = [(1, None, None), (2, "", "x")]
    assert collected(A.filter_audit(documents(spark, rows), unlabelled)) == audited(rows, [])


masks = st.lists(st.tuples(st.sampled_from(["p", "q"]), st.integers(0, 7), st.integers(1, 5)), min_size=1, max_size=12)


@settings(max_examples=8, deadline=None)
@given(masks)
def test_shapley_values_share_out_what_is_removed(spark, found):
    counts = {}
    for part, mask, n in found:
        counts[part, mask] = counts.get((part, mask), 0) + n
    table = spark.createDataFrame([(p, m, n, 0, 0) for (p, m), n in counts.items()], "part string, mask int, n long, good long, toxic long")
    rows = A.order_steps(table, "ABC").collect()
    for part in {p for p, _ in counts}:
        share = {r.filter_order[r.step - 1]: r.shapley for r in rows if r.part == part}
        assert sum(share.values()) == 6 * sum(n for (p, m), n in counts.items() if p == part and m)
