"""Fields that change type: values, errors and counts of kinds."""

import pytest

from garimpo.sources.drifting import Field, kinds_found, page_records, read_records, typed

FIELDS = [Field("n", "$.n", "long"), Field("v", "$.v", "decimal(5,2)"), Field("s", "$.a.s", "string"), Field("b", "$.b", "boolean", texts=True)]
LINES = [
    ('{"n":1,"v":1.25,"a":{"s":"x"},"b":true}', (1, "1.25", "x", True), []),
    ('{"n":1.5,"v":1.255,"a":{"s":7},"b":"true"}', (None, None, None, True), ["n DECIMAL", "v DECIMAL", "s BIGINT"]),
    ('{"n":"1","v":123456,"a":[1],"b":"maybe"}', (None, None, None, None), ["n STRING", "v BIGINT", "b STRING"]),
    ('{"n":null,"v":7}', (None, "7.00", None, None), []),
    ('{"n":{"x":1},"v":[1.0],"a":null,"b":0}', (None, None, None, None), ["n OBJECT", "v ARRAY", "b BIGINT"]),
    ('{}', (None, None, None, None), []),
    ('[1,2]', (None, None, None, None), ["Record is no object but ARRAY"]),
    ('{"n":1', (None, None, None, None), ["Record is no JSON"]),
]


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("drift") / "lines.json"
    path.write_text("\n".join(x[0] for x in LINES) + "\n\n   \n")
    return read_records(spark, f"file:{path}")


def test_values_and_errors(landed):
    kinds = {f.name: f.type for f in FIELDS}
    rows = typed(landed, FIELDS, ["corrupt"]).collect()
    assert len(rows) == len(LINES)
    for (text, values, errors), r in zip(LINES, rows):
        assert (r.n, None if r.v is None else str(r.v), r.s, r.b) == values, text
        want = [e if e.startswith("Record") else f"Wrong type in '{e.split()[0]}': expected {kinds[e.split()[0]]}, found {e.split()[1]}"
                for e in errors]
        assert r.type_errors == want, text
        assert r.corrupt == (text if errors == ["Record is no JSON"] else None)


def test_kinds(landed):
    found = {(r.field, r.kind): r.records for r in kinds_found(landed, FIELDS[:2]).collect()}
    assert found == {
        ("n", "BIGINT"): 1, ("n", "DECIMAL"): 1, ("n", "STRING"): 1, ("n", "NULL"): 1, ("n", "OBJECT"): 1, ("n", "ABSENT"): 2,
        ("v", "DECIMAL"): 2, ("v", "BIGINT"): 2, ("v", "ARRAY"): 1, ("v", "ABSENT"): 2}


def test_pages_and_no_rows(spark, tmp_path, landed):
    path = tmp_path / "pages.json"
    path.write_text('{"data":[{"n":1},{"n":"x"}]}\n{"data":{"n":1}}\n{"data":null}\n{}\n{"data":[]}\nbroken\n')
    rows = typed(page_records(read_records(spark, f"file:{path}")), FIELDS[:1], ["pos"]).collect()
    assert [(r.pos, r.n, len(r.type_errors)) for r in rows] == [(0, 1, 0), (1, None, 1)]
    assert typed(landed.limit(0), FIELDS).count() == kinds_found(landed.limit(0), FIELDS).count() == 0
    with pytest.raises(ValueError):
        Field("d", "$.d", "date").family
