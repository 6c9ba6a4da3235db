"""Token ids as wavelet matrices in compressed shard files (operator 3)."""

from __future__ import annotations

import os
import struct
import zlib
from array import array
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from garimpo.llm.common import lean, ship, slices, texts_of, utf8
from garimpo.session import fresh_path

#: Id that ends every document.
END_ID = 2
#: Tokens of a shard; a longer document is a shard of its own.
SHARD_TOKENS = 1 << 20
#: Bits of a plane that are compressed together, and that one entry of the rank directory covers.
BLOCK_BITS = 1 << 16
#: Text bytes whose pieces are numbered together, and pieces a worker remembers.
TEXT_BYTES = 4 << 20
REMEMBERED = 2_000_000
REMEMBERED_BYTES = 64 << 20
#: New pieces that are encoded as one text, and pieces that are given to the tokenizer at once.
ROW_PIECES = 200
CALL_PIECES = 2_000
#: A blank, then anything that is white space nowhere.
PLAIN = r"^ [^\s\pZ\x{0B}\x{1C}-\x{1F}\x{85}]+$"

_MAGIC = b"GWM1"
_HEAD = struct.Struct("<4sBQQ")


class PieceEncoder:
    """Encodes texts with the ``tokenizers`` library, each distinct piece once.

    The vocabulary's splitting pattern never joins what lies on both sides of a lone blank or line break,
    so a text may be cut there, its pieces encoded apart and the ids put in a row: the ids are those of
    the whole text. Pieces are remembered across batches, up to ``REMEMBERED``.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        # Byte-level vocabularies spell every byte as one character.
        self.bytes_of = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for piece, i in vocabulary.items():
            self.bytes_of[i] = len(piece)
        self._forget()

    def _forget(self) -> None:
        self.known = pa.array([], pa.large_string())
        self.ids, self.ends = array("I"), array("q", [0])

    def _coded(self, texts: list[str]) -> list[list[int]]:
        """Ids of each text; places in the text, which take a third of the time, are not asked for."""
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, pieces: pa.LargeStringArray) -> np.ndarray:
        """Encodes new pieces, plain ones in long rows, the others one by one; returns their numbers.

        A plain piece is a blank and then no white space, so a row of them is a text that would be cut at
        just these blanks. Bytes per id tell which ids belong to which piece.
        """
        plain = pc.and_not(pc.match_substring_regex(pieces, PLAIN), pc.match_substring(pieces, "<|"))
        row, others = pieces.filter(plain), pieces.filter(pc.invert(plain))
        data, offsets = utf8(row)
        edges = [*range(0, len(row), ROW_PIECES), len(row)]
        for at in range(0, len(edges) - 1, CALL_PIECES // ROW_PIECES):
            cuts = [offsets[a:b + 1] for a, b in pairwise(edges[at:at + CALL_PIECES // ROW_PIECES + 1])]
            texts = [data[cut[0]:cut[-1]].tobytes().decode("utf-8") for cut in cuts]
            for cut, coded in zip(cuts, self._coded(texts)):
                ids = np.array(coded, np.uint32)
                reached = np.concatenate(([0], np.cumsum(self.bytes_of[ids])))
                bounds = cut[1:] - cut[0]
                ends = np.searchsorted(reached, bounds)
                if reached[-1] != bounds[-1] or not np.array_equal(reached[ends], bounds):
                    raise ValueError("the vocabulary does not cut texts at blanks")
                begin = len(self.ids)
                self.ids.frombytes(ids.tobytes())
                self.ends.frombytes((begin + ends).astype(np.int64).tobytes())
        left = others.to_pylist()
        for at in range(0, len(left), CALL_PIECES):
            for coded in self._coded(left[at:at + CALL_PIECES]):
                self.ids.extend(coded)
                self.ends.append(len(self.ids))
        first, mask = len(self.known), plain.to_numpy(zero_copy_only=False)
        self.known = pa.concat_arrays([self.known, row, others])
        return first + np.where(mask, np.cumsum(mask) - 1, len(row) + np.cumsum(~mask) - 1)

    def encode(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and where each text's ids begin."""
        if not len(raw):
            return np.empty(0, np.uint32), np.zeros(len(offsets), np.int64)
        starts = piece_starts(raw, offsets)
        bounds = np.append(starts, len(raw))
        pieces = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(raw)))
        coded = pieces.dictionary_encode()
        distinct = coded.dictionary
        if len(self.known) + len(distinct) > REMEMBERED or self.known.nbytes > REMEMBERED_BYTES:
            self._forget()
        found = pc.index_in(distinct, value_set=self.known)
        rows = pc.fill_null(found, -1).to_numpy().astype(np.int32)
        if found.null_count:
            rows[rows < 0] = self._learn(distinct.filter(pc.is_null(found)))
        row = rows[coded.indices.to_numpy()]
        ids = np.frombuffer(self.ids, np.uint32) if len(self.ids) else np.empty(0, np.uint32)
        ends = np.frombuffer(self.ends, np.int64)
        begin, size = ends[row], ends[row + 1] - ends[row]
        at = np.zeros(len(row) + 1, np.int64)
        np.cumsum(size, out=at[1:])
        flat = ids[np.arange(at[-1]) + np.repeat(begin - at[:-1], size)]
        del ids, ends
        return flat, at[np.searchsorted(starts, offsets)]


_BLANK = np.zeros(256, bool)
_BLANK[[*range(0x09, 0x0E), *range(0x1C, 0x21)]] = True

_LETTER = np.zeros(256, bool)
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = True
#: Marks that neither contractions nor special tokens hold.
_MARKS = b"!#$%&*,.:;?"
_MARK = np.zeros(256, bool)
_MARK[list(_MARKS)] = True


def piece_starts(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where texts may be cut: at text starts, before a lone blank or line break, after a lone line break, and between
    an ASCII letter and a mark of ``_MARKS``, where the splitting pattern always ends a run of letters.

    Two neighbours outside ASCII might both be white space of Unicode; there the text is not cut.
    """
    cut = np.zeros(len(raw) + 1, bool)
    cut[1:-1] = _LETTER[raw[:-1]] & _MARK[raw[1:]]
    if len(raw) > 2:
        blank, high = _BLANK[raw], raw >= 0x80
        inner = np.zeros(len(raw), bool)
        inner[1:-1] = ~blank[:-2] & ~blank[2:] & ~(high[:-2] & high[2:])
        full = offsets[:-1] < offsets[1:]
        inner[offsets[:-1][full]] = False
        inner[offsets[1:][full] - 1] = False
        line = inner & (raw == 0x0A)
        cut[:-1] |= line | (inner & (raw == 0x20))
        after = np.flatnonzero(line)
        cut[after[~high[after + 1]] + 1] = True
    cut[offsets[:-1]] = True
    cut[len(raw)] = False
    return np.flatnonzero(cut)


def _pack(data: bytes, compressor) -> bytes:
    small = compressor.compress(data)
    return small if len(small) < len(data) else data


def encode_shard(ids: np.ndarray, doc_ids: list, lengths: np.ndarray) -> bytes:
    """One shard file: header, documents, rank directory and bit planes.

    Plane b holds, highest bit first, one bit per token in the order left by stably moving the tokens with
    a 0 bit before those with a 1 bit, plane after plane. Every plane is cut into blocks of ``BLOCK_BITS``
    bits, each compressed apart; the directory holds each block's place and the ones before it.
    """
    bits = max(1, int(ids.max()).bit_length()) if len(ids) else 1
    now = ids.astype(np.uint16 if bits <= 16 else np.uint32)
    compressor = zstandard.ZstdCompressor(level=1)
    directory, body, at = [], [], 0
    for b in range(bits - 1, -1, -1):
        one = (now >> b) & 1 > 0
        packed = np.packbits(one, bitorder="little").tobytes()
        before = 0
        for a in range(0, len(packed), BLOCK_BITS // 8):
            block = packed[a:a + BLOCK_BITS // 8]
            small = _pack(block, compressor)
            directory.append((at, before))
            before += int(np.count_nonzero(one[a * 8:a * 8 + BLOCK_BITS]))
            body.append(small)
            at += len(small)
        directory.append((at, before))
        now = np.concatenate((np.compress(~one, now), np.compress(one, now)))
    known = np.array([d is not None for d in doc_ids], bool)
    documents = _pack_documents(known, np.array([d or 0 for d in doc_ids], np.int64), lengths, compressor)
    index = zlib.compress(np.array(directory, np.int64).reshape(-1, 2).tobytes(), 1)
    head = _HEAD.pack(_MAGIC, bits, len(ids), len(doc_ids))
    return b"".join([head, struct.pack("<QQ", len(documents), len(index)), documents, index, *body])


def _pack_documents(known, doc_ids, lengths, compressor) -> bytes:
    return compressor.compress(known.tobytes() + doc_ids.tobytes() + lengths.astype(np.int64).tobytes())


class ShardFile:
    """Token access, counting and occurrence lookup on one shard file; planes are read block by block."""

    def __init__(self, data: bytes):
        magic, self.bits, self.size, docs = _HEAD.unpack_from(data)
        if magic != _MAGIC:
            raise ValueError("not a token shard")
        n_docs, n_index = struct.unpack_from("<QQ", data, _HEAD.size)
        at = _HEAD.size + 16
        plain = zstandard.ZstdDecompressor().decompress(data[at:at + n_docs], max_output_size=17 * docs + 1)
        known = np.frombuffer(plain, bool, docs)
        ids = np.frombuffer(plain, np.int64, docs, docs)
        self.lengths = np.frombuffer(plain, np.int64, docs, docs + 8 * docs)
        self.doc_ids = [int(i) if k else None for i, k in zip(ids, known)]
        at += n_docs
        index = np.frombuffer(zlib.decompress(data[at:at + n_index]), np.int64).reshape(-1, 2)
        self.blocks = -(-self.size // BLOCK_BITS)
        self.index = index.reshape(self.bits, self.blocks + 1, 2)
        self.zeros = [self.size - int(plane[-1, 1]) for plane in self.index]
        self.body = memoryview(data)[at + n_index:]
        self.cache: dict = {}

    def _block(self, level: int, k: int, keep: bool = True) -> np.ndarray:
        """The bits of block k of a plane as 0 and 1."""
        if (level, k) in self.cache:
            return self.cache[level, k]
        n = min(BLOCK_BITS, self.size - k * BLOCK_BITS)
        data = self.body[self.index[level, k, 0]:self.index[level, k + 1, 0]]
        raw = -(-n // 8)
        if len(data) != raw:
            data = zstandard.ZstdDecompressor().decompress(bytes(data), max_output_size=raw)
        bits = np.unpackbits(np.frombuffer(data, np.uint8), count=n, bitorder="little")
        if keep:
            self.cache[level, k] = bits
        return bits

    def _rank1(self, level: int, i: int) -> int:
        """Ones among the first i bits of a plane."""
        k, r = divmod(i, BLOCK_BITS)
        ones = int(self.index[level, k, 1])
        return ones + (int(self._block(level, k)[:r].sum()) if r else 0)

    def _select(self, level: int, bit: int, nth: int) -> int:
        """Position of the nth (from 0) 0 or 1 of a plane."""
        ones = self.index[level, :, 1]
        before = ones if bit else np.minimum(np.arange(len(ones)) * BLOCK_BITS, self.size) - ones
        k = int(np.searchsorted(before, nth, side="right")) - 1
        return k * BLOCK_BITS + int(np.flatnonzero(self._block(level, k) == bit)[nth - int(before[k])])

    def access(self, i: int) -> int:
        """Token at position i."""
        if not 0 <= i < self.size:
            raise IndexError(i)
        token = 0
        for level in range(self.bits):
            k, r = divmod(i, BLOCK_BITS)
            bit = int(self._block(level, k)[r])
            token = token << 1 | bit
            ones = self._rank1(level, i)
            i = self.zeros[level] + ones if bit else i - ones
        return token

    def _range(self, token: int, a: int, b: int) -> tuple[int, int]:
        if token < 0 or token >> self.bits:
            return 0, 0
        for level in range(self.bits):
            ones_a, ones_b = self._rank1(level, a), self._rank1(level, b)
            if token >> (self.bits - 1 - level) & 1:
                a, b = self.zeros[level] + ones_a, self.zeros[level] + ones_b
            else:
                a, b = a - ones_a, b - ones_b
        return a, b

    def count(self, token: int, a: int = 0, b: int | None = None) -> int:
        """Occurrences of a token at positions a to b (without b)."""
        low, high = self._range(token, a, self.size if b is None else b)
        return high - low

    def select(self, token: int, nth: int) -> int:
        """Position of the nth (from 0) occurrence of a token."""
        low, high = self._range(token, 0, self.size)
        if not 0 <= nth < high - low:
            raise IndexError(nth)
        i = low + nth
        for level in range(self.bits - 1, -1, -1):
            bit = token >> (self.bits - 1 - level) & 1
            i = self._select(level, bit, i - self.zeros[level] if bit else i)
        return i

    def occurrences(self, token: int) -> list[int]:
        return [self.select(token, k) for k in range(self.count(token))]

    def decode(self) -> np.ndarray:
        """All tokens, from the last plane back to the first."""
        kind = np.uint16 if self.bits <= 16 else np.uint32
        now = np.zeros(self.size, kind)
        for level in range(self.bits - 1, -1, -1):
            one = np.concatenate([self._block(level, k, keep=False) for k in range(self.blocks)] or [np.empty(0, np.uint8)]) > 0
            back = np.empty(self.size, kind)
            back[np.flatnonzero(~one)] = now[:self.zeros[level]]
            back[np.flatnonzero(one)] = now[self.zeros[level]:] | kind(1 << (self.bits - 1 - level))
            now = back
        return now.astype(np.uint32)


_ENCODERS: dict[str, PieceEncoder] = {}

_SHARD = "part int, seq int, n_docs long, n_tokens long, file binary"


def write_shards(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID, id_col: str = "doc_id",
                 text_col: str = "text", shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Writes the shards of all documents, in ascending doc_id, below ``path``; returns them as read back.

    Documents are range partitioned by id, so shard (part, seq) holds smaller ids than the next one. Spark
    writes the files (one record per shard, in uncompressed Parquet, since a shard is compressed itself),
    which works on any store and makes a retried task replace its own output. A null text is empty and
    has the end id only; null ids come first; rows that repeat an id follow each other in text order.
    """
    ship(docs.sparkSession)

    def run(batches):
        encoder = _ENCODERS.get(tokenizer)
        if encoder is None:
            encoder = _ENCODERS[tokenizer] = PieceEncoder(tokenizer)
        part, seq = TaskContext.get().partitionId(), 0
        ids, names, lengths, held = [], [], [], 0

        def shard():
            sizes = np.array(lengths, np.int64)
            data = encode_shard(np.concatenate(ids), names, sizes)
            return pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "seq": pa.array([seq], pa.int32()),
                "n_docs": pa.array([len(names)], pa.int64()), "n_tokens": pa.array([held], pa.int64()),
                "file": pa.array([data], pa.binary())})

        for batch in batches:
            keys = batch.column(0).to_pylist()
            raw, offsets = utf8(batch.column(1))
            for a, b in slices(offsets, TEXT_BYTES):
                flat, begin = encoder.encode(raw[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
                size = np.diff(begin) + 1
                # Each document's ids, then the end id.
                out = np.insert(flat, begin[1:], end_id)
                ends = np.cumsum(size)
                i = 0
                while i < b - a:
                    base = int(ends[i - 1]) if i else 0
                    j = max(i + 1, int(np.searchsorted(ends, base + max(0, shard_tokens - held), side="right")))
                    if held and int(ends[i]) - base + held > shard_tokens:
                        yield shard()
                        ids, names, lengths, held, seq = [], [], [], 0, seq + 1
                        continue
                    ids.append(out[base:int(ends[j - 1])])
                    names += keys[a + i:a + j]
                    lengths += size[i:j].tolist()
                    held += int(ends[j - 1]) - base
                    i = j
        if names:
            yield shard()

    ordered = texts_of(docs, id_col, text_col).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(lean(run), _SHARD).write.option("compression", "none").parquet(path)
    return docs.sparkSession.read.schema(_SHARD).parquet(path)


def read_shards(shards: DataFrame) -> DataFrame:
    """One row per document from shard files: doc_id, start, n_tokens, ids_crc32."""
    ship(shards.sparkSession)

    def run(batches):
        for batch in batches:
            parts, seqs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for i, data in enumerate(batch.column(2)):
                shard = ShardFile(data.as_py())
                ids = shard.decode().astype("<u4")
                ends = np.cumsum(shard.lengths)
                begins = ends - shard.lengths
                view = memoryview(ids).cast("B")
                sums = [zlib.crc32(view[4 * a:4 * b]) for a, b in zip(begins.tolist(), ends.tolist())]
                n = len(sums)
                yield pa.RecordBatch.from_pydict({
                    "part": pa.array([parts[i]] * n, pa.int32()), "seq": pa.array([seqs[i]] * n, pa.int32()),
                    "doc_id": pa.array(shard.doc_ids, pa.int64()), "inside": pa.array(begins, pa.int64()),
                    "n_tokens": pa.array(shard.lengths, pa.int64()), "ids_crc32": pa.array(sums, pa.int64())})

    rows = shards.select("part", "seq", "file").mapInArrow(
        lean(run), "part int, seq int, doc_id long, inside long, n_tokens long, ids_crc32 long")
    # Tokens before each part (one row per range partition), then before each shard of the part.
    earlier = Window.rowsBetween(Window.unboundedPreceding, -1)
    parts = shards.groupBy("part").agg(F.sum("n_tokens").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(earlier.orderBy("part")), F.lit(0)).alias("before_part"))
    starts = shards.select("part", "seq", F.coalesce(
        F.sum("n_tokens").over(earlier.partitionBy("part").orderBy("seq")), F.lit(0)).alias("before"))
    starts = starts.join(parts, "part").select("part", "seq", (F.col("before_part") + F.col("before")).alias("before"))
    return rows.join(starts, ["part", "seq"]).select(
        "doc_id", (F.col("before") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")


def token_table(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """Encodes and writes all documents, then describes them from the files that were written.

    An empty table writes no shard and gives no rows. Other columns are ignored, whatever their names.
    """
    path = fresh_path(docs.sparkSession, "token-shards")
    return read_shards(write_shards(docs, path, tokenizer, end_id))
