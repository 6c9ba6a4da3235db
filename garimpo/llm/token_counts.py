"""Token counts by a count-only Viterbi over a unigram vocabulary (operator 5)."""

from __future__ import annotations

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from garimpo.llm.common import ship, slices, texts_of, utf8

#: Score below the vocabulary's least one for a character that is no piece.
UNKNOWN_PENALTY = 10.0
SPACE = "▁"
#: Text bytes whose pieces are numbered together, and pieces a worker remembers.
TEXT_BYTES = 16 << 20
REMEMBERED = 1_000_000


def load_pieces(path: str) -> list[tuple[str, float]]:
    """(piece, score) of a public vocabulary file in the order of its ids; nothing is trained."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.piece_size())]


class UnigramCounter:
    """Number of pieces of the best segmentation, without the segmentation.

    For every end position in a word the automaton gives the pieces that end there; the best score and
    the number of pieces on its path are all that is carried. Tie rules of the tokenizer: a later
    candidate replaces the best one only if its score is strictly greater, candidates come by start, so
    of equal scores the longest last piece stays. A character that is no piece of its own scores
    ``UNKNOWN_PENALTY`` below the least score and falls back to one token per UTF-8 byte.
    """

    def __init__(self, pieces: list[tuple[str, float]]):
        self.automaton = ahocorasick.Automaton()
        scores: dict[str, float] = {}
        for piece, score in pieces:
            if piece:
                scores[piece] = score
        for piece, score in scores.items():
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.single = {piece for piece in scores if len(piece) == 1}
        self.unknown = min(score for _, score in pieces) - UNKNOWN_PENALTY
        self.known: dict[str, int] = {}

    def count(self, word: str) -> int:
        """Pieces of one word; the word carries its space mark."""
        n = len(word)
        if not n:
            return 0
        best, counts, reached = [0.0] * (n + 1), [0] * (n + 1), 0
        single = self.single
        for end, (size, score) in self.automaton.iter(word):
            end += 1
            while reached < end - 1:
                # Positions without a match are reached by an unknown character only.
                reached = self._step(word, best, counts, reached)
            start = end - size
            total = best[start] + score
            if reached < end:
                best[end], counts[end], reached, first = total, counts[start] + 1, end, start
                if word[end - 1] not in single:
                    other = best[end - 1] + self.unknown
                    # The unknown character starts last, so it needs a strictly greater score.
                    if other > total:
                        best[end], counts[end] = other, counts[end - 1] + len(word[end - 1].encode("utf-8", "surrogatepass"))
                        first = end - 1
            elif total > best[end] or (total == best[end] and start < first):
                best[end], counts[end], first = total, counts[start] + 1, start
        while reached < n:
            reached = self._step(word, best, counts, reached)
        return counts[n]

    def _step(self, word, best, counts, reached):
        best[reached + 1] = best[reached] + self.unknown
        counts[reached + 1] = counts[reached] + len(word[reached].encode("utf-8", "surrogatepass"))
        return reached + 1

    def counts(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Tokens and words of each text; every distinct word is segmented once."""
        n = len(offsets) - 1
        if not len(raw):
            return np.zeros(n, np.int64), np.zeros(n, np.int64)
        starts = word_starts(raw, offsets)
        bounds = np.append(starts, len(raw))
        data = pa.py_buffer(np.ascontiguousarray(raw))
        words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(bounds), data)
        coded = words.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        if len(self.known) + len(distinct) > REMEMBERED:
            self.known.clear()
        sizes = np.empty(len(distinct), np.int64)
        for i, word in enumerate(distinct):
            size = self.known.get(word)
            if size is None:
                marked = SPACE + word[1:] if word[0] == " " else word if word[0] == SPACE else SPACE + word
                size = self.known[word] = self.count(marked)
            sizes[i] = size
        total = np.zeros(len(starts) + 1, np.int64)
        np.cumsum(sizes[coded.indices.to_numpy()], out=total[1:])
        at = np.searchsorted(starts, offsets)
        return np.diff(total[at]), np.diff(at)


def word_starts(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Text starts and every blank or literal space mark: each begins a word."""
    cut = np.zeros(len(raw) + 1, bool)
    cut[:-1] = raw == 0x20
    if len(raw) > 2:
        cut[:-3] |= (raw[:-2] == 0xE2) & (raw[1:-1] == 0x96) & (raw[2:] == 0x81)
    cut[offsets[:-1]] = True
    cut[len(raw)] = False
    return np.flatnonzero(cut)


_COUNTERS: dict[str, UnigramCounter] = {}


def token_counts(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, n_tokens.

    Words begin at blanks, as the tokenizer's space marks do. Null and empty texts have 0 of both. Rows
    that repeat an id are counted each; an empty table gives no rows. Texts are read whole. Other columns
    are ignored, whatever their names. One narrow pass, no shuffle.
    """
    return _counted(texts_of(docs, id_col, text_col), vocabulary, "doc_id long")


def _counted(texts: DataFrame, vocabulary: str, first: str) -> DataFrame:
    """The first column of ``texts``, named and typed as ``first`` says, and the words and tokens of the second."""
    ship(texts.sparkSession)
    name = first.split()[0]

    def run(batches):
        counter = _COUNTERS.get(vocabulary)
        if counter is None:
            counter = _COUNTERS[vocabulary] = UnigramCounter(load_pieces(vocabulary))
        for batch in batches:
            raw, offsets = utf8(batch.column(1))
            tokens, words = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
            for a, b in slices(offsets, TEXT_BYTES):
                t, w = counter.counts(raw[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
                tokens.append(t)
                words.append(w)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.concatenate(words)), pa.array(np.concatenate(tokens))],
                names=[name, "n_words", "n_tokens"])

    return texts.mapInArrow(run, f"{first}, n_words long, n_tokens long")


def source_totals(docs: DataFrame, vocabulary: str, text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Documents, words and tokens per source; null is a source of its own. Every row counts, whatever its id."""
    texts = docs.select(F.col(source_col).cast("string").alias("source"), F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    return _counted(texts, vocabulary, "source string").groupBy("source").agg(
        F.count("*").alias("n_docs"), F.sum("n_words").alias("n_words"), F.sum("n_tokens").alias("n_tokens"))
