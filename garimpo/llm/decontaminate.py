"""Benchmark decontamination with a generalised suffix automaton of the test items (operator 2)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from garimpo.llm import words as W
from garimpo.llm.common import lean, ship, slices, utf8, written

#: Consecutive item words that make a window.
WINDOW = 13
#: A document is contaminated when n_hit * COVERAGE >= n_words, that is from 5 % on.
COVERAGE = 20
#: Words per automaton; more items become further automata, each run over all documents.
BLOCK_WORDS = 100_000
#: Automata per pass over the documents; between passes the hits are written to the shared folder.
BLOCKS_PER_PASS = 8

_BUILT: dict = {}


class Automaton:
    """All factors of a block of items, as a generalised suffix automaton over word numbers."""

    def __init__(self, items: list[tuple[int | None, str]], window: int = WINDOW):
        self.window = window
        raw, offsets = utf8(pa.array([text for _, text in items], pa.string()))
        starts, ends, first = W.spans(raw, offsets, W.lowered(W.ALPHANUMERIC))
        hashes = W.hashes(raw, starts, ends)
        self.vocabulary = W.distinct(hashes)
        self.filter = np.zeros(1 << 16, bool)
        self.filter[(self.vocabulary & np.uint64(0xFFFF)).astype(np.int64)] = True
        numbers = np.searchsorted(self.vocabulary, hashes).tolist()
        self.next: list[dict] = [{}]
        self.link, self.length = [-1], [0]
        sequences = [(item, numbers[first[i]:first[i + 1]]) for i, (item, _) in enumerate(items)]
        sequences = [(item, seq) for item, seq in sequences if seq]
        for _, seq in sequences:
            state = 0
            for word in seq:
                state = self._extend(state, word)
        self.shortest = min([window, *(len(seq) for _, seq in sequences)]) if sequences else None
        self._mark(sequences)

    def _state(self, length: int, link: int, edges: dict) -> int:
        self.length.append(length)
        self.link.append(link)
        self.next.append(edges)
        return len(self.length) - 1

    def _split(self, state: int, word: int, target: int) -> int:
        copy = self._state(self.length[state] + 1, self.link[target], dict(self.next[target]))
        self.link[target] = copy
        while state >= 0 and self.next[state].get(word) == target:
            self.next[state][word] = copy
            state = self.link[state]
        return copy

    def _extend(self, last: int, word: int) -> int:
        known = self.next[last].get(word)
        if known is not None:
            return known if self.length[known] == self.length[last] + 1 else self._split(last, word, known)
        new = self._state(self.length[last] + 1, 0, {})
        state = last
        while state >= 0 and word not in self.next[state]:
            self.next[state][word] = new
            state = self.link[state]
        if state >= 0:
            known = self.next[state][word]
            self.link[new] = known if self.length[known] == self.length[state] + 1 else self._split(state, word, known)
        return new

    def _mark(self, sequences) -> None:
        """Which items hold the window of a state, and which short items end in a state."""
        window, link, length = self.window, self.link, self.length
        self.of_window = [-1] * len(length)
        for state in sorted(range(len(length)), key=length.__getitem__):
            if length[state] >= window:
                up = link[state]
                self.of_window[state] = state if length[up] < window else self.of_window[up]
        self.items: dict[int, set] = {}
        self.short: dict[int, list] = {}
        for item, seq in sequences:
            state = 0
            for word in seq:
                # The prefix of an item is a factor, so every step exists.
                state = self.next[state][word]
                if self.of_window[state] >= 0:
                    self.items.setdefault(self.of_window[state], set()).add(item)
            size = len(seq)
            if size < window:
                while length[link[state]] >= size:
                    state = link[state]
                self.short.setdefault(state, []).append((size, item))
        self.short_up = [-1] * len(length)
        for state in sorted(range(len(length)), key=length.__getitem__):
            if state in self.short:
                self.short_up[state] = state
            elif state:
                self.short_up[state] = self.short_up[link[state]]

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """Word number of each hash, -1 for words that no item has."""
        out = np.full(len(hashes), -1, np.int64)
        maybe = np.flatnonzero(self.filter[(hashes & np.uint64(0xFFFF)).astype(np.int64)])
        if len(maybe) and len(self.vocabulary):
            at = np.minimum(np.searchsorted(self.vocabulary, hashes[maybe]), len(self.vocabulary) - 1)
            out[maybe] = np.where(self.vocabulary[at] == hashes[maybe], at, -1)
        return out

    def walk(self, run: list[int]) -> Iterator[tuple[int, int, set]]:
        """(end, words, items) of every window occurrence in a run of known words."""
        following, link, length = self.next, self.link, self.length
        window, of_window, short_up = self.window, self.of_window, self.short_up
        state = matched = 0
        for i, word in enumerate(run):
            while state and word not in following[state]:
                state = link[state]
                matched = length[state]
            if word in following[state]:
                state = following[state][word]
                matched += 1
            if matched >= window:
                yield i + 1, window, self.items[of_window[state]]
            at = short_up[state]
            while at >= 0:
                for size, item in self.short[at]:
                    if size <= matched:
                        yield i + 1, size, {item}
                at = short_up[link[at]] if at else -1


def _automata(blocks: tuple, window: int) -> list[Automaton]:
    key = (hash(blocks), window)
    if key not in _BUILT:
        _BUILT.clear()
        _BUILT[key] = [Automaton(list(block), window) for block in blocks]
    return _BUILT[key]


def _hits(automata: list[Automaton], hashes: np.ndarray, first: np.ndarray):
    """Hit mask over all words of a slice of texts, and the found items of each text."""
    hit = np.zeros(len(hashes) + 1, np.int32)
    found: list[set] = [set() for _ in range(len(first) - 1)]
    for automaton in automata:
        if automaton.shortest is None or not len(hashes):
            continue
        numbers = automaton.numbers(hashes)
        known = numbers >= 0
        begin = known.copy()
        begin[1:] &= ~known[:-1]
        edges = first[:-1][first[:-1] < len(known)]
        begin[edges] = known[edges]
        begins = np.flatnonzero(begin)
        # A run ends at the next unknown word or at the end of its text.
        stop = np.append(np.flatnonzero(~known), len(known))
        ends = stop[np.searchsorted(stop, begins)] if len(begins) else begins
        texts = np.searchsorted(first, begins, side="right") - 1
        ends = np.minimum(ends, first[texts + 1])
        for k in np.flatnonzero(ends - begins >= automaton.shortest).tolist():
            a = int(begins[k])
            for end, size, items in automaton.walk(numbers[a:int(ends[k])].tolist()):
                hit[a + end - size] += 1
                hit[a + end] -= 1
                found[int(texts[k])] |= items
    return np.cumsum(hit[:-1]) > 0, found


def _blocks(items: DataFrame, item_col: str, text_col: str, block_words: int) -> Iterator[tuple]:
    """The items in blocks of about ``block_words`` words; the driver holds one pass's blocks at a time."""
    block, size = [], 0
    rows = items.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).cast("string").alias("text"))
    for row in rows.filter("text is not null").toLocalIterator():
        n = len(row.text) // 2 + 1
        if block and size + n > block_words:
            yield tuple(block)
            block, size = [], 0
        block.append((row.item, row.text))
        size += n
    if block:
        yield tuple(block)


def _passed(docs: DataFrame, blocks: tuple, window: int) -> DataFrame:
    """Adds the hits of some blocks to the columns ``__hits`` (one bit per word) and ``__items``."""
    schema = docs.schema
    names = docs.columns
    holder = docs.sparkSession.sparkContext.broadcast(blocks)

    def run(batches):
        automata = _automata(holder.value, window)
        table = W.lowered(W.ALPHANUMERIC)
        for batch in batches:
            at = {n: i for i, n in enumerate(names)}
            raw, offsets = utf8(batch.column(at["__text"]))
            old_bits, old_items = batch.column(at["__hits"]), batch.column(at["__items"])
            bits, items, counts, hits = [], [], [], []
            for a, b in slices(offsets, W.CHUNK):
                part, local = raw[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]
                starts, ends, first = W.spans(part, local, table)
                hit, found = _hits(automata, W.hashes(part, starts, ends), first)
                for i in range(b - a):
                    mask, n = hit[first[i]:first[i + 1]], int(first[i + 1] - first[i])
                    before = old_bits[a + i].as_py()
                    if before:
                        mask = mask | (np.unpackbits(np.frombuffer(before, np.uint8), count=n) > 0)
                        found[i] |= set(old_items[a + i].as_py())
                    counts.append(n)
                    hits.append(int(mask.sum()))
                    bits.append(np.packbits(mask).tobytes() if hits[-1] else b"")
                    items.append(sorted(x for x in found[i] if x is not None))
            made = {"__hits": bits, "__items": items, "__n": counts, "__hit": hits}
            kinds = {"__hits": pa.binary(), "__items": pa.list_(pa.string()), "__n": pa.int64(), "__hit": pa.int64()}
            yield pa.RecordBatch.from_arrays(
                [pa.array(made[n], kinds[n]) if n in made else batch.column(at[n]) for n in names], names=names)

    return docs.mapInArrow(lean(run), schema)


def _scanned(docs: DataFrame, items: DataFrame, text_col: str, item_col: str, item_text_col: str,
             window: int, block_words: int) -> DataFrame:
    ship(docs.sparkSession)
    state = docs.withColumns({
        "__text": F.coalesce(F.col(text_col).cast("string"), F.lit("")), "__hits": F.lit(b""),
        "__items": F.array().cast("array<string>"), "__n": F.lit(0).cast("long"), "__hit": F.lit(0).cast("long")})
    group, passes = [], 0
    for block in _blocks(items, item_col, item_text_col, block_words):
        if len(group) == BLOCKS_PER_PASS:
            state, group, passes = written(_passed(state, tuple(group), window), "decontaminate"), [], passes + 1
        group.append(block)
    return _passed(state, tuple(group), window)


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
                  block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, items.

    A window is ``window`` consecutive words of an item, or a whole shorter item with any word. The words
    of each document are streamed through the automaton; wherever the longest match reaches a window, its
    words are hit. Words that no item has end a match, so only runs of known words are walked.

    Null and empty texts have no words and are clean. Items without words have no window. Rows that
    repeat an item id count as one item; an item without id causes hits but is not listed. Repeated
    documents give repeated rows. Empty tables give no rows or only clean rows. Texts of any length are
    read whole. Other columns are ignored, whatever their names.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    found = _scanned(rows, items, "text", item_col, item_text_col, window, block_words)
    return found.select(
        "doc_id", F.col("__n").alias("n_words"), F.col("__hit").alias("n_hit"),
        F.size("__items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort("__items")), 256).alias("items_sha256"),
        _over("__hit", "__n").alias("contaminated"), F.col("__items").alias("items"))


def _over(hit: str, words: str):
    return (F.col(hit) > 0) & (F.col(hit) * COVERAGE >= F.col(words))


def drop_contaminated(docs: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id",
                      item_text_col: str = "text", window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` without its contaminated rows; one narrow pass, all columns unchanged.

    Columns that begin with two underscores are reserved for the pass.
    """
    found = _scanned(docs, items, text_col, item_col, item_text_col, window, block_words)
    return found.filter(~_over("__hit", "__n")).select(docs.columns)


def cut_spans(docs: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id",
              item_text_col: str = "text", min_words: int = WINDOW, window: int = WINDOW,
              block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` with every hit span of at least ``min_words`` words cut out of the text.

    Text around a span stays as it is; documents over the coverage limit are the caller's to drop.
    """
    found = _scanned(docs, items, text_col, item_col, item_text_col, window, block_words)
    names, table = found.columns, W.lowered(W.ALPHANUMERIC)

    def run(batches):
        for batch in batches:
            columns = {n: batch.column(i) for i, n in enumerate(names)}
            out = []
            for text, bits in zip(columns[text_col].to_pylist(), columns["__hits"].to_pylist()):
                if text and bits:
                    raw, offsets = utf8(pa.array([text]))
                    starts, ends, _ = W.spans(raw, offsets, table)
                    mask = np.unpackbits(np.frombuffer(bits, np.uint8), count=len(starts)) > 0
                    edge = np.flatnonzero(np.diff(np.concatenate(([0], mask.astype(np.int8), [0]))))
                    keep = np.ones(len(raw), bool)
                    for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()):
                        if b - a >= min_words:
                            keep[starts[a]:ends[b - 1]] = False
                    text = raw[keep].tobytes().decode("utf-8")
                out.append(text)
            columns[text_col] = pa.array(out, pa.string())
            yield pa.RecordBatch.from_arrays([columns[n] for n in names], names=names)

    return found.mapInArrow(lean(run), found.schema).select(docs.columns)


def _lowered(column: str) -> str:
    return f"translate({column}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _words(column: str) -> str:
    return rf"regexp_extract_all({_lowered(column)}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_words("coalesce(text, '')")} AS w FROM documents),
i AS (SELECT item_id, {_words("coalesce(text, '')")} AS w FROM benchmark),
iw AS (SELECT DISTINCT item_id, least(len(w), {WINDOW}) AS m,
       array_to_string(list_slice(w, p, p + least(len(w), {WINDOW}) - 1), ' ') AS g
       FROM (SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - {WINDOW} + 1, 1))) AS p FROM i WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT m FROM iw),
dw AS (SELECT r, m, p, array_to_string(list_slice(w, p, p + m - 1), ' ') AS g
       FROM (SELECT r, w, m, unnest(generate_series(1, len(w) - m + 1)) AS p FROM d, sizes WHERE len(w) >= m)),
occ AS (SELECT dw.r, dw.m, dw.p, iw.item_id FROM dw JOIN iw ON dw.g = iw.g AND dw.m = iw.m),
hit AS (SELECT r, count(DISTINCT x) AS n FROM (SELECT r, unnest(generate_series(p, p + m - 1)) AS x FROM occ) GROUP BY r),
it AS (SELECT r, count(*) AS n, string_agg(s, ',' ORDER BY s) AS s
       FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS s FROM occ WHERE item_id IS NOT NULL) GROUP BY r)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(hit.n, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(it.n, 0) AS BIGINT) AS n_items, sha256(coalesce(it.s, '')) AS items_sha256,
       coalesce(hit.n, 0) > 0 AND 20 * coalesce(hit.n, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN it USING (r)
"""
