import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from garimpo.llm import words as W
from garimpo.llm.common import slices, utf8

from . import brute

texts = st.lists(st.one_of(st.none(), st.text(alphabet="aAbZ09 \t\n\x00.é  ß", max_size=30)), max_size=8)


@settings(max_examples=150, deadline=None)
@given(texts)
def test_spans_are_the_words_of_each_text(values):
    raw, offsets = utf8(pa.array(values, pa.string()))
    for table, pattern in ((W.BLANK_SEPARATED, brute.BLANK), (W.lowered(W.ALPHANUMERIC), brute.ALNUM)):
        starts, ends, first = W.spans(raw, offsets, table)
        for i, value in enumerate(values):
            got = [raw[a:b].tobytes().decode() for a, b in zip(starts[first[i]:first[i + 1]], ends[first[i]:first[i + 1]])]
            assert [brute.lower(g) for g in got] == pattern.findall(brute.lower(value))


@settings(max_examples=100, deadline=None)
@given(texts)
def test_equal_words_share_a_hash_and_others_do_not(values):
    raw, offsets = utf8(pa.array(values, pa.string()))
    starts, ends, _ = W.spans(raw, offsets, W.BLANK_SEPARATED)
    seen = {}
    for a, b, h in zip(starts, ends, W.hashes(raw, starts, ends).tolist()):
        assert seen.setdefault(h, brute.lower(raw[a:b].tobytes().decode())) == brute.lower(raw[a:b].tobytes().decode())
    assert len(set(seen.values())) == len(seen)


def test_hash_does_not_depend_on_the_place_or_the_chunk():
    raw, offsets = utf8(pa.array(["ab cd", "xx AB"]))
    starts, ends, _ = W.spans(raw, offsets, W.BLANK_SEPARATED)
    h = W.hashes(raw, starts, ends)
    assert h[0] == h[3] and len(set(h.tolist())) == 3
    long = "q " * 3_000_000 + "ab"
    raw, offsets = utf8(pa.array([long]))
    starts, ends, _ = W.spans(raw, offsets, W.BLANK_SEPARATED)
    assert W.hashes(raw, starts, ends)[-1] == h[0]


def test_short_sequence_is_one_gram_and_not_a_longer_one():
    h = np.arange(1, 4, dtype=np.uint64)
    assert len(W.grams(h, 5)) == 1 and len(W.grams(h, 2)) == 2 and len(W.grams(h[:0], 5)) == 0
    assert W.grams(h[:2], 5)[0] != W.grams(h[:2], 1)[0]


def test_slices_cover_all_texts_and_never_cut_one():
    offsets = np.array([0, 5, 5, 100, 101, 101])
    got = list(slices(offsets, 10))
    assert [i for a, b in got for i in range(a, b)] == list(range(5))


def test_sliced_arrow_columns_keep_their_bytes():
    column = pa.array(["aa", None, "ccc", "d"]).slice(1, 2)
    raw, offsets = utf8(column)
    assert raw.tobytes() == b"ccc" and offsets.tolist() == [0, 0, 3]
