import hashlib
import random

import pytest
from pyspark.sql import functions as F

from garimpo.llm import decontaminate, exact_dedup, fuzzy_lines, near_dups, passages
from garimpo.llm.components import connected

from . import brute


def rows_of(df, *names):
    return sorted((tuple(r) for r in df.select(*names).collect()), key=repr)


def test_exact_groups_with_awkward_rows(spark):
    rows = brute.awkward(random.Random(1))
    got = rows_of(exact_dedup.exact_groups(brute.documents(spark, rows), salts=3),
                  "doc_id", "keep_id", "group_size", "kept", "text_sha256")
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    want = []
    for i, t in rows:
        ids = [x for x in groups[t or ""] if x is not None]
        keep = max(ids) if ids else None
        want.append((i, keep, len(groups[t or ""]), i == keep, hashlib.sha256((t or "").encode()).hexdigest()))
    assert got == sorted(want, key=repr)


def test_drop_copies_keeps_whole_rows_once(spark):
    docs = brute.documents(spark, [(1, "a"), (2, "a"), (2, "a"), (3, None), (4, ""), (None, "b")])
    kept = exact_dedup.drop_copies(docs)
    assert kept.columns == docs.columns
    assert rows_of(kept, "doc_id", "text") == sorted([(2, "a"), (4, ""), (None, "b")], key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_near_duplicates_match_brute_force(spark, seed):
    rows = brute.awkward(random.Random(seed))
    got = near_dups.near_duplicates(brute.documents(spark, rows))
    assert rows_of(got, "doc_id", "n_shingles", "component_id", "kept") == brute.near(rows)


def test_near_duplicates_of_a_large_group_and_a_common_passage(spark):
    rng = random.Random(5)
    base, passage = brute.sentence(rng, 300).split(" "), brute.sentence(rng, 40)
    rows = []
    for i in range(150):
        words = list(base)
        for _ in range(rng.randint(0, 5)):
            words[rng.randrange(300)] = "v%d" % i
        rows.append((i, " ".join(words)))
    rows += [(200 + i, brute.sentence(rng, 60) + " " + passage) for i in range(60)]
    got = near_dups.near_duplicates(brute.documents(spark, rows))
    assert rows_of(got, "doc_id", "n_shingles", "component_id", "kept") == brute.near(rows)


def test_families_of_edited_copies_give_few_candidates(spark, monkeypatch):
    rng, rows = random.Random(17), []
    for size, edits, n in ((260, 6, 150), (120, 9, 64)):
        base, vocabulary = brute.sentence(rng, n).split(" "), ["q%d" % i for i in range(40)]
        for _ in range(size):
            words = list(base)
            for _ in range(rng.randint(0, edits)):
                words[rng.randrange(n)] = rng.choice(vocabulary)
            rows.append((len(rows), " ".join(words)))
    rng.shuffle(rows)
    made, apart = [], near_dups._apart

    def counted(members, sets, link):
        made.append(apart(members, sets, link).distinct().count())
        return apart(members, sets, link)

    monkeypatch.setattr(near_dups, "_apart", counted)
    monkeypatch.setattr(near_dups, "PAIRED", 8)
    got = near_dups.near_duplicates(brute.documents(spark, rows))
    assert rows_of(got, "doc_id", "n_shingles", "component_id", "kept") == brute.near(rows)
    assert 0 < made[0] < 0.1 * len(rows) ** 2 / 2


def test_the_head_of_a_family_is_a_member_with_few_edits(spark, monkeypatch):
    rng, rows = random.Random(23), []
    for _ in range(6):
        base = brute.sentence(rng, 400).split(" ")
        for i in range(80):
            words = list(base)
            # Two members are linked if they have six edits together at most.
            for at in rng.sample(range(400), (2, 3, 3, 3, 3, 3, 4, 4, 5, 5)[i % 10]):
                words[at] = "e%dx%d" % (len(rows), at)
            rows.append((len(rows), " ".join(words)))
    made, apart = [], near_dups._apart

    def counted(members, sets, link):
        made.append(apart(members, sets, link).count())
        return apart(members, sets, link)

    monkeypatch.setattr(near_dups, "_apart", counted)
    monkeypatch.setattr(near_dups, "PAIRED", 8)
    got = near_dups.near_duplicates(brute.documents(spark, rows))
    assert rows_of(got, "doc_id", "n_shingles", "component_id", "kept") == brute.near(rows)
    assert 0 < made[0] < 10 * len(rows)


def test_rows_without_ids_do_not_multiply(spark):
    rng, rows = random.Random(18), []
    for i in range(1000):
        words = brute.sentence(rng, 60).split(" ")
        rows.append((None if i % 2 else 7, " ".join(words)))
        words[rng.randrange(60)] = "edited"
        rows.append((None, " ".join(words)))
    docs = brute.documents(spark, rows).withColumn("__md5", F.lit("mine")).withColumn("md5", F.lit(1))
    kept = near_dups.keep_every_component(docs, link=80)
    assert kept.columns == docs.columns
    assert kept.count() == 1000 and kept.filter("__md5 = 'mine'").count() == 1000


def test_bounds_follow_the_link(spark):
    assert (near_dups.least_agreeing(85), near_dups.most_unlike(85)) == (34, 20)
    rng = random.Random(16)
    rows = []
    for i in range(150):
        words = brute.sentence(rng, 154).split(" ")
        # 100 of 200 shingles in common.
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(words[:104] + brute.sentence(rng, 50).split(" ")))]
    near = near_dups.near_duplicates(brute.documents(spark, rows), link=50)
    assert {r.doc_id for r in near.filter("not kept").collect()} == {2 * i + 1 for i in range(150)}


def test_keep_one_of_each_keeps_columns(spark):
    rows = brute.awkward(random.Random(3))
    docs = brute.documents(spark, rows)
    kept = near_dups.keep_one_of_each(docs)
    assert kept.columns == docs.columns
    assert {r[0] for r in rows_of(kept, "doc_id")} == {r[0] for r in brute.near(rows) if r[3]}
    assert kept.count() == len({r[0] for r in brute.near(rows) if r[3]})


@pytest.mark.parametrize("function", [
    exact_dedup.exact_groups, near_dups.near_duplicates, passages.repeated_passages, fuzzy_lines.dropped_lines])
def test_empty_tables(spark, function):
    assert function(brute.documents(spark, [])).count() == 0


def test_components_of_chains_and_loops(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7), (203, 200), (203, 201)]
    got = {r.node: r.component for r in connected(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(41)) and got[101] == got[100] == 100
    assert got[203] == got[201] == got[200] == 200


ITEMS = [(1, " ".join(f"w{i}" for i in range(30))), (2, "Short ITEM here"), (3, None), (4, "..."), (5, "single"),
         (1, " ".join(f"z{i}" for i in range(14))), (None, " ".join(f"q{i}" for i in range(13))), (6, "a b a b a b a b a b a b a b a b")]


def _texts():
    w = ITEMS[0][1].split(" ")
    return [(1, " ".join(w[3:18])), (2, "x " * 400 + " ".join(w[:13])), (3, " ".join(w[:12])), (4, "a short, item... HERE!"),
            (5, None), (6, ""), (7, "!!"), (8, "single"), (9, " ".join(["pad"] * 30 + ITEMS[6][1].split(" "))),
            (10, ITEMS[5][1].upper() + " tail"), (11, "b a " * 9), (11, "b a " * 9), (None, "short item"),
            (12, " ".join(w[:13]) + " pad " + " ".join(w[5:25]) + " pad " * 700), (13, "w0 w1 " * 20)]


@pytest.mark.parametrize("block", [decontaminate.BLOCK_WORDS, 10])
def test_contamination_matches_brute_force(spark, block):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = decontaminate.contamination(brute.documents(spark, _texts()), items, block_words=block)
    names = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert rows_of(got, *names) == brute.contaminated(_texts(), ITEMS)


def test_contamination_random_small_alphabet(spark):
    rng = random.Random(9)
    def make(n): return " ".join(rng.choice("ab") for _ in range(n))
    items = [(i, make(rng.randint(1, 30))) for i in range(12)] + [(90, make(13)), (91, make(14))]
    rows = [(i, make(rng.randint(0, 80))) for i in range(60)]
    frame = spark.createDataFrame(items[3:], "item_id long, text string")
    got = decontaminate.contamination(brute.documents(spark, rows), frame)
    names = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert rows_of(got, *names) == brute.contaminated(rows, items[3:])


def test_contamination_of_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    docs = brute.documents(spark, [(1, "a b"), (2, None)])
    assert rows_of(decontaminate.contamination(docs, none), "doc_id", "n_hit", "contaminated") == [(1, 0, False), (2, 0, False)]
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert decontaminate.contamination(brute.documents(spark, []), items).count() == 0


def test_drop_and_cut(spark):
    items = spark.createDataFrame(ITEMS[:1], "item_id long, text string")
    w = ITEMS[0][1]
    docs = brute.documents(spark, [(1, "keep " + w + " this"), (2, "clean"), (3, None)])
    dropped = decontaminate.drop_contaminated(docs, items)
    assert dropped.columns == docs.columns and rows_of(dropped, "doc_id") == [(2,), (3,)]
    cut = decontaminate.cut_spans(docs, items)
    assert rows_of(cut, "doc_id", "text") == [(1, "keep  this"), (2, "clean"), (3, None)]


def _lines(text):
    return [(n, line.strip(" \t\r\x0b\x0c")) for n, line in enumerate((text or "").split("\n"))]


def test_fuzzy_lines_match_brute_force(spark):
    rng = random.Random(4)
    base = [brute.sentence(rng, 40) for _ in range(4)]
    rows = [(1, None), (2, ""), (3, "\n\n"), (4, "ab\nab\n ab "), (5, "\n".join(base))]
    for i in range(10, 40):
        lines = []
        for b in base:
            words = b.split(" ")
            for _ in range(rng.choice([0, 1, 1, 8])):
                words[rng.randrange(40)] = "new%d" % rng.randrange(99)
            lines.append(" ".join(words))
        rows.append((i, "\n".join(lines + [brute.sentence(rng, 12), "short"])))
    rows.append((50, brute.sentence(rng, 8000)))
    rows.append((None, base[0]))
    places = [(i, n, line) for i, t in rows for n, line in _lines(t) if line]
    places.sort(key=lambda p: (p[0] is not None, p[0] or 0, p[1]))
    q = fuzzy_lines.SHINGLE
    sets = [{p[2][k:k + q] for k in range(max(1, len(p[2]) - q + 1))} for p in places]
    roots = brute.components(sets, lambda a, b: 100 * len(a & b) >= 80 * len(a | b))
    want = {}
    for i, _ in rows:
        want[i] = (0, [])
    for k, (i, n, _) in enumerate(places):
        total, dropped = want[i]
        want[i] = (total + 1, dropped + ([n] if roots[k] != k else []))
    docs = brute.documents(spark, rows)
    got = {r.doc_id: (r.n_lines, r.dropped) for r in fuzzy_lines.dropped_lines(docs).collect()}
    assert got == want
    cut = {r.doc_id: r.text for r in fuzzy_lines.drop_lines(docs).collect()}
    assert cut[4] == "ab" and cut[1] is None and cut[3] == "\n\n"


def test_cutting_keeps_what_only_one_row_of_an_id_has(spark):
    rng = random.Random(19)
    lines = [brute.sentence(rng, 12) for _ in range(6)]
    rows = [(1, lines[0] + "\n" + lines[1]), (5, lines[0] + "\n" + lines[2]), (5, lines[3] + "\n" + lines[4]),
            (None, lines[5]), (None, lines[5] + "\n" + "a line of its own"), (None, None)]
    docs = brute.documents(spark, rows).withColumn("dropped", F.lit("x")).withColumn("row", F.lit("y"))
    cut = fuzzy_lines.drop_lines(docs)
    assert cut.columns == docs.columns and cut.filter("dropped = 'x' and row = 'y'").count() == len(rows)
    texts = rows_of(cut, "doc_id", "text")
    assert (5, lines[3] + "\n" + lines[4]) in texts and (5, lines[2]) in texts
    assert sum(t is not None and lines[5] in t for _, t in texts) == 1
    assert sum(t is not None and "a line of its own" in t for _, t in texts) == 1

    passage = brute.sentence(rng, 70)
    own = [brute.sentence(rng, 60) for _ in range(6)]
    rows = [(1, own[0] + " " + passage), (2, passage + " " + own[1]), (3, passage + " " + own[2]), (3, own[3]),
            (None, own[4] + " " + passage), (None, own[5])]
    docs = brute.documents(spark, rows).withColumn("spans", F.lit("x"))
    cut = passages.cut_repeats(docs, passages.repeated_passages(docs))
    assert cut.columns == docs.columns and cut.count() == len(rows)
    texts = [t for _, t in rows_of(cut, "doc_id", "text")]
    assert all(any(o in t for t in texts) for o in own) and sum(passage in t for t in texts) < 5


def test_short_similar_lines_meet_in_a_band(spark):
    rng = random.Random(15)
    # 13 and 12 characters: 4 of 5 shingles, just at the link.
    pairs = [("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(13)), i) for i in range(2000)]
    rows = [(2 * i, line) for line, i in pairs] + [(2 * i + 1, line[:-1]) for line, i in pairs]
    got = fuzzy_lines.dropped_lines(brute.documents(spark, rows)).filter("n_dropped = 1")
    assert {r.doc_id for r in got.collect()} == {2 * i + 1 for _, i in pairs}


def test_fuzzy_lines_have_no_python_in_the_plan(spark):
    plan = fuzzy_lines.dropped_lines(brute.documents(spark, [(1, "a b\nc d"), (2, "a b")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "MapInPandas" not in plan


def _passages(spark, rows):
    return passages.repeated_passages(brute.documents(spark, rows))


def test_repeated_passages_are_found_and_clean_texts_left_alone(spark):
    rng = random.Random(6)
    shared = [brute.sentence(rng, 70), brute.sentence(rng, 55)]
    line = brute.sentence(rng, 20)
    rows = [(i, brute.sentence(rng, 60) + " " + line + " " + brute.sentence(rng, 90)) for i in range(30)]
    for i in range(30, 60):
        edited = shared[0].split(" ")
        if i % 3 == 0:
            edited[35] = "edit"
        rows.append((i, brute.sentence(rng, rng.randint(5, 80)) + " " + " ".join(edited) + " " + line + " " + shared[1]))
    rows += [(90, None), (91, ""), (92, "short text"), (None, shared[1] + " end"), (93, shared[1]), (93, shared[1])]
    found = _passages(spark, rows).collect()
    words = {}
    for i, t in rows:
        words.setdefault(i, []).append(brute.BLANK.findall(brute.lower(t)))
    flagged = {r.doc_id for r in found}
    assert flagged == (set(range(31, 60)) | {30, 93}) and not flagged & set(range(30))
    for r in found:
        best = max(
            len(a & b) / len(a | b)
            for one in words[r.first_doc_id] for two in words[r.doc_id]
            for a in [{tuple(one[k:k + 5]) for k in range(r.first_start, r.first_end - 4)}]
            for b in [{tuple(two[k:k + 5]) for k in range(r.start, r.end - 4)}])
        assert best >= 0.8 and r.end - r.start >= 50
    for i in range(31, 60):
        n = len(words[i][0])
        covered = {k for r in found if r.doc_id == i for k in range(r.start, r.end)}
        assert len(covered & set(range(n - 55, n))) == 55


def _template_groups(rng, groups, edited):
    """Pairs of texts with a passage of 48 common words and 5 own ones on both sides, unlike surroundings."""
    core, rows = brute.sentence(rng, 48), []
    for g in range(groups):
        ahead, behind = brute.sentence(rng, 5), brute.sentence(rng, 5)
        for copy in range(2):
            words = f"{ahead} {core} {behind}".split(" ")
            if copy and edited:
                words[29] = "edit%d" % g
            rows.append((2 * g + copy, f"{brute.sentence(rng, 30)} {' '.join(words)} {brute.sentence(rng, 30)}"))
    return rows


@pytest.mark.parametrize("edited", [False, True])
def test_passages_of_many_groups_with_a_common_core(spark, edited):
    rng = random.Random(12)
    rows = []
    for k in range(12):
        rows += [(100 * k + i, t) for i, t in _template_groups(rng, 12, edited)]
    found = {(r.first_doc_id, r.doc_id) for r in _passages(spark, rows).collect()}
    assert [i for i, _ in rows if i % 2 and (i - 1, i) not in found] == []


def test_further_anchors_join_whole_stretches_one_word_apart(spark):
    rng = random.Random(13)
    core = brute.sentence(rng, 48).split(" ")
    a, b = (brute.sentence(rng, 4).split(" ") for _ in range(2))
    plain, swapped, longer = a[:2] + core + b[:2], a[:2] + core + b[:2], a[:2] + core + b[:2]
    swapped[20] = "other"
    longer.insert(31, "more")
    rows = [(i, " ".join(w)) for i, w in enumerate([plain, swapped, longer, a[2:] + core + b[2:]])]
    texts = brute.documents(spark, rows).select("doc_id", "text")
    members = spark.createDataFrame([(1, i, 12) for i in range(4)], "key long, doc_id long, centre int")
    got = rows_of(passages._further(members, members, texts, 5, 50), "first_doc_id", "doc_id", "diagonal")
    assert got == [(0, 1, 0), (0, 2, 0)]


@pytest.mark.parametrize("length", [51, 60, 80])
@pytest.mark.parametrize("kept", ["ahead", "behind"])
def test_an_inserted_or_deleted_word_does_not_split_a_passage(length, kept):
    import numpy as np

    rng = np.random.Generator(np.random.PCG64(length))
    for inserted in (True, False):
        one = rng.integers(1, 1 << 63, length + 40).astype(np.uint64)
        shared, middle = one[20:20 + length], length // 2
        edited = np.insert(shared, middle, np.uint64(7)) if inserted else np.delete(shared, middle)
        two = np.concatenate((rng.integers(1, 1 << 63, 33).astype(np.uint64), edited, rng.integers(1, 1 << 63, 9).astype(np.uint64)))
        # Only one of the halves has an anchor.
        diagonal = 20 - 33 if kept == "ahead" else 20 - 33 - (1 if inserted else -1)
        (s, e, t, f, share), = passages.alike(one, two, [diagonal], 5, 50, 0.8)
        assert (s, e, t, f) == (33, 33 + len(edited), 20, 20 + length) and share >= 0.8


def test_a_passage_repeated_within_its_text_is_not_the_text_itself(spark):
    rng = random.Random(14)
    shared = brute.sentence(rng, 60)
    (row,) = _passages(spark, [(1, " ".join([shared, brute.sentence(rng, 3), shared, brute.sentence(rng, 300)]))]).collect()
    assert (row.doc_id, row.first_doc_id, row.start, row.end, row.first_start, row.first_end) == (1, 1, 63, 123, 0, 60)


def test_compact_windows_match_their_definition():
    import numpy as np

    rng = np.random.Generator(np.random.PCG64(3))
    for n in (10, 11, 40, 200):
        v = rng.integers(1, 50 if n == 40 else 1 << 62, n).astype(np.uint64)
        width = 10
        got = sorted(zip(*(x.tolist() for x in passages.compact_windows(v, np.array([0, n]), width))))
        covered = {}
        for c, a, b in got:
            assert b - a + 1 >= width and v[c] == v[a:b + 1].min()
            for s in range(a, c + 1):
                for e in range(max(c, s + width - 1), b + 1):
                    assert (s, e) not in covered
                    covered[s, e] = c
        # Every subsequence of at least ``width`` values is in exactly one window.
        assert len(covered) == (n - width + 1) * (n - width + 2) // 2


def test_cut_repeats(spark):
    rng = random.Random(8)
    shared = brute.sentence(rng, 60)
    docs = brute.documents(spark, [(1, "first " + shared), (2, "second " + shared + " tail"), (3, None)])
    cut = passages.cut_repeats(docs, passages.repeated_passages(docs))
    assert cut.columns == docs.columns
    assert rows_of(cut, "doc_id", "text") == [(1, "first " + shared), (2, "second  tail"), (3, None)]


def test_every_pair_of_passages_at_the_bound_keeps_a_run_in_common(spark):
    """One word of 50 replaced, at every place, in 160 pairs: chance must not decide which pairs meet."""
    rng = random.Random(83)
    assert passages.shared_words() == 25
    rows = []
    for i in range(160):
        text = [f"w{rng.randrange(10 ** 9)}" for _ in range(50)]
        other = list(text)
        other[5 + i % 40] = "changed"
        rows += [(2 * i, " ".join(text)), (2 * i + 1, " ".join(other))]
    found = {(r.first_doc_id, r.doc_id) for r in _passages(spark, rows).collect()}
    assert found == {(2 * i, 2 * i + 1) for i in range(160)}


def test_a_text_of_one_word_repeats_itself_one_word_on(spark):
    (row,) = _passages(spark, [(1, "word " * 200)]).collect()
    assert (row.doc_id, row.first_doc_id, row.start, row.end, row.first_start, row.first_end) == (1, 1, 1, 200, 0, 199)


def test_words_are_left_out_only_of_stretches_that_meet_unlike_ones(spark, monkeypatch):
    rng = random.Random(31)
    text = brute.sentence(rng, 60)
    texts = brute.documents(spark, [(i, text) for i in range(3)]).select("doc_id", "text")
    members = spark.createDataFrame([(1, i, 12) for i in range(3)], "key long, doc_id long, centre int")
    asked, by_place = [], passages._by_place

    def counted(marks, *rest):
        asked.append(marks.count())
        return by_place(marks, *rest)

    monkeypatch.setattr(passages, "_by_place", counted)
    found = passages._further(members, members, texts, 5, 50)
    assert rows_of(found, "first_doc_id", "doc_id", "diagonal") == [(0, 1, 0), (0, 2, 0)]
    assert asked == [3, 0]


def test_lines_are_shuffled_as_texts(spark):
    texts = spark.createDataFrame([(0, "a line of some words"), (1, "a line of some words!"), (2, "others")], "line_id long, line string")
    pairs = spark.createDataFrame([(0, 1), (0, 2)], "a long, b long")
    linked = fuzzy_lines._linked(pairs, texts, 80)
    assert rows_of(linked, "a", "b") == [(0, 1)]
    plan = linked._jdf.queryExecution().optimizedPlan().toString()
    assert not [x for x in plan.split("\n") if "Project" in x and "regexp_extract_all" in x]


def _shuffle_files(spark):
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return manager.getAllFiles().mkString("\n").count("/shuffle_")


def test_written_tables_leave_no_shuffle_files_and_can_be_discarded(spark):
    from garimpo.llm.common import CLEANUP, discard, passing, written
    from garimpo.session import path_exists

    def folder(table):
        return table.inputFiles()[0].rpartition("/")[0]

    before, setting = _shuffle_files(spark), spark.conf.get(CLEANUP, None)
    table = written(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "test")
    assert _shuffle_files(spark) <= before and table.count() == 7
    assert spark.conf.get(CLEANUP, None) == setting
    place = folder(table)
    discard(table)
    assert not path_exists(spark, place)
    with passing(spark) as keep:
        gone, stays = written(spark.range(3), "test"), keep(written(spark.range(4), "test"))
        places = folder(gone), folder(stays)
    assert [path_exists(spark, x) for x in places] == [False, True] and stays.count() == 4


def test_batches_are_cut_to_pieces_of_bounded_size():
    import pyarrow as pa

    from garimpo.llm.common import pieces

    texts = ["x" * n for n in (3, 0, 9, 2, 2, 2)] + [None]
    batch = pa.RecordBatch.from_pydict({"id": list(range(7)), "text": texts})
    cut = list(pieces([batch, batch.slice(0, 0)], 1, 5))
    assert [x for b in cut for x in b.column(0).to_pylist()] == list(range(7))
    assert [x for b in cut for x in b.column(1).to_pylist()] == texts
    assert max(sum(len(x or "") for x in b.column(1).to_pylist()) for b in cut if b.num_rows > 1) <= 5


def test_band_lists_are_shuffled_once(spark):
    lists = spark.createDataFrame([(1, 30), (1, 10), (1, 20), (2, 10), (3, 20), (3, 30)], "key long, line_id long").repartition(3)
    several = fuzzy_lines._several(lists)
    plan = several._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
    assert {tuple(r) for r in several.select("key", "line_id", "a").collect()} == {
        (1, 30, 10), (1, 10, 10), (1, 20, 10), (3, 20, 20), (3, 30, 20)}


def test_passage_lists_are_shuffled_once(spark):
    rows = [(5, 1, 0), (5, None, 3), (5, None, 2), (6, 1, 4), (7, 2, 0), (7, 2, 9)]
    members = spark.createDataFrame(rows, "key long, doc_id long, centre int").repartition(3)
    listed = passages._listed(members)
    plan = listed._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
    got = {(r.key, r.doc_id, r.centre, r.head.doc_id, r.head.centre) for r in listed.collect()}
    assert got == {(5, 1, 0, None, 2), (5, None, 3, None, 2), (5, None, 2, None, 2), (7, 2, 0, 2, 0), (7, 2, 9, 2, 0)}


def _held(rows, doc_id, start, end):
    return {k for r in rows if r.doc_id == doc_id for k in range(r.start, r.end)} >= set(range(start, end))


def test_the_only_uncovered_run_of_a_list_meets_those_that_are_covered(spark):
    """The first text shares what is before the core with the second, the third what is behind it."""
    rng = random.Random(41)
    rows = []
    for i in range(0, 48, 3):
        ahead, core, behind = (brute.sentence(rng, n) for n in (7, 48, 7))
        rows += [(i, f"{ahead} {core} {brute.sentence(rng, 40)}"), (i + 1, f"{ahead} {core} {behind}"),
                 (i + 2, f"{brute.sentence(rng, 40)} {core} {behind}")]
    found = _passages(spark, rows).collect()
    assert [i for i in range(0, 48, 3) if not (_held(found, i + 1, 0, 55) and _held(found, i + 2, 40, 95))] == []


def _fillings(rng, groups):
    """Pairs of texts that share 22 words behind a core that all texts share; two words between differ."""
    core, rows = brute.sentence(rng, 36), []
    for g in range(groups):
        own = brute.sentence(rng, 22)
        for copy in range(2):
            rows.append((2 * g + copy, f"{brute.sentence(rng, 30)} {core} {brute.sentence(rng, 2)} {own} {brute.sentence(rng, 30)}"))
    return rows


def test_fillings_of_a_template_that_differ_in_two_words_meet(spark):
    rng = random.Random(42)
    rows = [(100 * k + i, t) for k in range(8) for i, t in _fillings(rng, 12)]
    found = _passages(spark, rows).collect()
    assert [i for i, _ in rows if i % 2 and not _held(found, i, 30, 90)] == []
    assert {r.doc_id % 2 for r in found} == {1}


def test_lists_of_any_length_give_the_same_passages(spark, monkeypatch):
    rng = random.Random(43)
    rows = _fillings(rng, 20) + [(100 + i, t) for i, t in _template_groups(rng, 12, True)]
    rows += [(None, rows[-1][1]), (None, rows[5][1])]
    want = {(r.doc_id, r.start, r.end) for r in _passages(spark, rows).collect()}
    # Rows without an id come first.
    assert {i for i, *_ in want} == {4, rows[-4][0]} | {i for i, _ in rows if i is not None and i % 2}
    monkeypatch.setattr(passages, "TILE", (2, 3))
    assert {(r.doc_id, r.start, r.end) for r in _passages(spark, rows).collect()} == want
    monkeypatch.setattr(passages, "LONG", 1)
    assert {(r.doc_id, r.start, r.end) for r in _passages(spark, rows).collect()} == want


def test_passages_overlap_where_a_stretch_is_alike_with_both_its_neighbours():
    import numpy as np

    rng = np.random.Generator(np.random.PCG64(44))
    one = rng.integers(1, 1 << 63, 100).astype(np.uint64)
    two = one.copy()
    two[[32, 53]] = 7, 8
    assert [o[:2] for o in passages.alike(one[:86], two[:86], [0], 5, 50, 0.8)] == [(0, 53), (33, 86)]


def test_every_passage_has_a_run_whose_surroundings_meet():
    """No passage is left out, whatever was changed in it and however often it repeats itself."""
    import numpy as np

    rng = np.random.Generator(np.random.PCG64(45))
    reach, run_words, table = 150, passages._run_words(5, 50, 0.8), np.zeros(1 << 15, bool)
    around = passages._surroundings(5, run_words, reach)

    def near(text, at):
        (row,) = around(text, np.array([2 * at]), np.array([1]))
        return np.frombuffer(row[3][0].as_py(), np.uint16)

    seen = 0
    for _ in range(300):
        one = rng.integers(1, 1 << 63, 300).astype(np.uint64)
        if rng.random() < 0.3:
            one = np.tile(one[:rng.integers(20, 60)], 15)[:300]
        two = one.tolist()
        for _ in range(rng.integers(4, 14)):
            at = int(rng.integers(0, len(two)))
            two[at:at + int(rng.integers(0, 4))] = rng.integers(1, 1 << 63, rng.integers(0, 4)).tolist()
        two = np.array(two, np.uint64)
        runs = {}
        for a, v in enumerate(passages.W.grams(one, run_words).tolist()):
            runs.setdefault(v, []).append(a)
        pairs = [(a, b) for b, v in enumerate(passages.W.grams(two, run_words).tolist()) for a in runs.get(v, [])]
        met = {}
        for d in sorted({a - b for a, b in pairs})[:6]:
            for s, e, t, f, _ in passages.alike(one, two, [d], 5, 50, 0.8):
                within = [(a, b) for a, b in pairs if s <= b and b + run_words <= e and t <= a and a + run_words <= f]
                for a, b in within:
                    if (a, b) not in met:
                        met[a, b] = len(passages._met(near(one, a)[None, :], near(two, b), reach, 46, 0.8, table)[0]) == 1
                    if met[a, b]:
                        break
                assert any(met.get(p) for p in within)
                seen += 1
    assert seen > 1000
    # A run of 45 words in common is not enough.
    ahead, run, behind = rng.integers(1, 1 << 63, (2, 100)), rng.integers(1, 1 << 63, 45), rng.integers(1, 1 << 63, (2, 100))
    one, two = (np.concatenate((ahead[i], run, behind[i])).astype(np.uint64) for i in range(2))
    assert not len(passages._met(near(one, 110)[None, :], near(two, 110), reach, 46, 0.8, table)[0])


def test_bands_are_runs_of_the_sorted_signature(spark):
    """Band keys agree where the smallest hashes of all three bins do; the size of the set goes along."""
    rng = random.Random(51)
    lines = ["ab", "some words of a line", "x" * 40] + [brute.sentence(rng, n) for n in (3, 9, 30, 90)]
    lines += [lines[-1][:-30] + "other end", lines[-2] + "!"]
    table = spark.createDataFrame(list(enumerate(lines)), "id int, line string")
    rows = fuzzy_lines._with_bands(table).select("id", "n", "bands", fuzzy_lines.shingle_hashes(F.col("line")).alias("h")).collect()
    wanted, got = {}, {}
    for r in rows:
        mins = {}
        for h in r.h:
            bin_ = (h >> 58) + 32
            mins[bin_] = min(h, mins.get(bin_, h))
        parts = {b // 3: tuple(mins.get(3 * (b // 3) + k) for k in range(3)) for b in mins if b < 63}
        assert r.n == len(set(r.h)) and len(r.bands) == len(set(r.bands)) == len(parts)
        wanted[r.id], got[r.id] = set(parts.items()), set(r.bands)
    assert all(len(got[a] & got[b]) == len(wanted[a] & wanted[b]) for a in got for b in got)


def test_lines_whose_sizes_rule_out_a_link_are_not_compared(spark):
    texts = spark.createDataFrame([(0, "a line of words", 100), (1, "a line of words", 80), (2, "a line of words", 79)],
                                  "line_id long, line string, n int")
    pairs = spark.createDataFrame([(0, 1), (0, 2)], "a long, b long")
    assert rows_of(fuzzy_lines._linked(pairs, texts, 80), "a", "b") == [(0, 1)]
