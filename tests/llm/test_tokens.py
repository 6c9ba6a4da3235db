import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from garimpo.llm import token_counts, token_files
from garimpo.llm.common import utf8

from . import brute

BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
ENCODER = token_files.PieceEncoder(BPE)
COUNTER = token_counts.UnigramCounter(token_counts.load_pieces(PIECES))


def _unigram():
    import tokenizers

    t = tokenizers.Tokenizer(tokenizers.models.Unigram(token_counts.load_pieces(PIECES), unk_id=0, byte_fallback=True))
    t.pre_tokenizer = tokenizers.pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    return t


UNIGRAM = _unigram()
mixed = st.text(alphabet=" \n\t\r  　\u0085\x1c'aAsétß1,.!<|>▁語🙂", max_size=40)
texts = st.lists(st.one_of(st.none(), mixed, st.sampled_from([
    "a <|endoftext|> b", "<|endoftext|>", " <|endoftext|>\nx", "it's we'll  don't", "a\n  b", "x   y", "\n  z"])), max_size=6)


@settings(max_examples=300, deadline=None)
@given(texts)
def test_pieces_encode_like_whole_texts(values):
    ids, begin = ENCODER.encode(*utf8(pa.array(values, pa.string())))
    for i, value in enumerate(values):
        want = ENCODER.tokenizer.encode(value or "", add_special_tokens=False).ids
        assert ids[begin[i]:begin[i + 1]].tolist() == want, value


def test_words_before_marks_are_learnt_once():
    encoder = token_files.PieceEncoder(BPE)
    marks = [m + n for m in "!#$%&*,.:;?" for n in ("", "?", "***")]
    values = [" ".join(w + m for w in ("plain", "it's", "x<|endoftext|>y", "été") for m in marks), "a.b:c d!<|endoftext|>"]
    ids, begin = encoder.encode(*utf8(pa.array(values)))
    for i, value in enumerate(values):
        assert ids[begin[i]:begin[i + 1]].tolist() == encoder.tokenizer.encode(value, add_special_tokens=False).ids
    assert sum(p.startswith(" plain") for p in encoder.known.to_pylist()) == 1


@settings(max_examples=300, deadline=None)
@given(texts)
def test_unigram_counts_match_the_library(values):
    tokens, _ = COUNTER.counts(*utf8(pa.array(values, pa.string())))
    for value, n in zip(values, tokens.tolist()):
        assert n == len(UNIGRAM.encode(value or "", add_special_tokens=False).ids), value


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.text("abc", min_size=1, max_size=4), st.sampled_from([-1.0, -2.0, -0.5, -4.0])), min_size=1, max_size=8,
                unique_by=lambda p: p[0]), st.text("abcd", max_size=12))
def test_tie_rules_of_small_vocabularies(pieces, word):
    import tokenizers

    everything = [("<unk>", -9.0)] + pieces + [(f"<0x{i:02X}>", -50.0) for i in range(256)]
    library = tokenizers.Tokenizer(tokenizers.models.Unigram(everything, unk_id=0, byte_fallback=True))
    assert token_counts.UnigramCounter(everything).count(word) == len(library.encode(word, add_special_tokens=False).ids)


@pytest.mark.parametrize("n, top", [(0, 1), (1, 1), (5, 3), (70_000, 50_000), (65_536, 2), (200_000, 300), (3, 1 << 20)])
def test_wavelet_matrix_round_trip_and_lookups(n, top):
    rng = np.random.Generator(np.random.PCG64(n))
    ids = rng.integers(0, top, n).astype(np.uint32)
    lengths = np.array([n - n // 3, n // 3])
    shard = token_files.ShardFile(token_files.encode_shard(ids, [7, None], lengths))
    assert shard.decode().tolist() == ids.tolist()
    assert shard.doc_ids == [7, None] and shard.lengths.tolist() == lengths.tolist()
    for i in rng.integers(0, n, min(n, 20)).tolist():
        token = int(ids[i])
        assert shard.access(i) == token
        assert shard.count(token) == int((ids == token).sum())
        assert shard.count(token, i // 2, i) == int((ids[i // 2:i] == token).sum())
        nth = int((ids[:i] == token).sum())
        assert shard.select(token, nth) == i
    if n:
        rare = int(ids[n // 2])
        if shard.count(rare) < 50:
            assert shard.occurrences(rare) == np.flatnonzero(ids == rare).tolist()
    assert shard.count(top + 5 + (1 << 21)) == 0


def _rows():
    rng = random.Random(2)
    return brute.awkward(rng) + [(100, "a <|endoftext|> b"), (101, "x" * 5000), (102, brute.sentence(rng, 3000))]


@pytest.mark.parametrize("shard_tokens", [token_files.SHARD_TOKENS, 200])
def test_token_table_matches_whole_encoding(spark, shard_tokens):
    from garimpo.session import fresh_path

    rows = _rows()
    path = fresh_path(spark, "shards")
    shards = token_files.write_shards(brute.documents(spark, rows), path, BPE, shard_tokens=shard_tokens)
    got = sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in token_files.read_shards(shards).collect())
    ordered = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode()))
    want, start = [], 0
    for i, t in ordered:
        ids = ENCODER.tokenizer.encode(t, add_special_tokens=False).ids + [2]
        want.append((start, i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert got == want


def test_empty_tables(spark):
    none = brute.documents(spark, [])
    assert token_files.token_table(none, BPE).count() == 0
    assert token_counts.token_counts(none, PIECES).count() == 0


def test_token_counts_and_totals(spark):
    rows = _rows()
    docs = brute.documents(spark, rows)
    got = sorted(((r.doc_id, r.n_tokens) for r in token_counts.token_counts(docs, PIECES).collect()), key=repr)
    want = sorted(((i, len(UNIGRAM.encode(t or "", add_special_tokens=False).ids)) for i, t in rows), key=repr)
    assert got == want
    two = brute.documents(spark, [(1, "a b", "x"), (2, None, None), (None, "c", "x"), (1, "d", "y"), (1, "d", "y"), (None, "e f", "x")])
    totals = token_counts.source_totals(two, PIECES)
    assert sorted(((r.source, r.n_docs, r.n_words) for r in totals.collect()), key=repr) == [("x", 3, 5), ("y", 2, 2), (None, 1, 0)]
