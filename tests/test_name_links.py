"""Names and their representatives against all pairs; few pairs are counted in full."""

import random

from garimpo.operators import name_links


def _grams(name):
    word, words = "", []
    for c in name.lower() + " ":
        if c.isalnum():
            word += c
        elif word:
            words.append(word)
            word = ""
    return {f"  {w} "[i:i + 3] for w in words for i in range(len(w) + 1)}


def _wanted(rows, percent):
    names = sorted({n for _, n in rows if n is not None})
    sets = {n: _grams(n) for n in names}

    def linked(a, b):
        union = len(sets[a] | sets[b])
        return a != b and union > 0 and 100 * len(sets[a] & sets[b]) >= percent * union

    near = {n: [m for m in names if linked(n, m)] for n in names}
    out = []
    for i, n in rows:
        out.append((i, n, None, 0) if n is None else (i, n, min([n, *near[n]]), len(near[n])))
    return sorted(out, key=repr)


def _got(spark, rows, percent):
    df = spark.createDataFrame(rows, "id long, nome string")
    return sorted((tuple(r) for r in name_links.represented(df, "id", "nome", percent).collect()), key=repr)


def _made(n, seed):
    rng = random.Random(seed)
    first = ["Construtora", "Comércio", "Serviços", "Papelaria", "Hospital"]
    second = ["São João", "Boa Vista", "Central", "do Norte", "Santa Rita"]
    rows = []
    for i in range(n):
        name = f"{rng.choice(first)} {rng.choice(second)} {rng.choice(['LTDA', 'Ltda.', 'ME', 'S/A', ''])}"
        if rng.random() < 0.4:
            at = rng.randrange(len(name))
            name = name[:at] + rng.choice("xyz ") + name[at + rng.randrange(2):]
        rows.append((i, name))
    return rows


def test_equal_to_all_pairs(spark):
    rows = _made(160, 2) + [(None, "Papelaria Central ME"), (500, None), (501, ""), (502, "--"), (503, "?!"), (504, "a"), (505, "A")]
    for percent in (40, 70, 100):
        assert _got(spark, rows, percent) == _wanted(rows, percent)


def test_words_in_another_order_are_one_set(spark):
    rows = [(1, "norte obras"), (2, "obras norte"), (3, "Obras, Norte"), (4, "sul")]
    assert _got(spark, rows, 100) == _wanted(rows, 100)
    assert [r[2:] for r in _got(spark, rows, 100)] == [("Obras, Norte", 2)] * 3 + [("sul", 0)]


def test_a_name_of_many_rows_and_an_empty_table(spark):
    rows = [(i, "Prefeitura Municipal") for i in range(3000)] + [(9999, "Prefeitura Municipa")]
    got = _got(spark, rows, 70)
    assert len(got) == 3001 and {r[2:] for r in got} == {("Prefeitura Municipa", 1)}
    assert _got(spark, [], 70) == []
