"""Repeated word passages by a compressed FM-index per shard.

A shard's segments are laid end to end as word numbers with separators. The index is the
Burrows-Wheeler transform of that text (suffixes ordered by their first words, as deep
as the windows need) in a wavelet matrix: one bit-packed vector with rank counts per bit
of the word number. Segments are streamed through it backwards, all at once: each step
is one backward search step (two rank queries); at full width the interval is first
widened to its parent, one word shorter. So every place gets its matching statistic up
to ``width`` words, and places that reach it report their interval; the interval's
smallest (document, start) is the first occurrence.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from segmint.llm.common import byte_slices, resized, tidy
from segmint.llm.passages import SLICE_BYTES, START_BITS, Units, repeated_spans, with_spans, without_spans
from segmint.llm.suffix_buckets import merge

WIDTH = 20
GRAM = 5


class WaveletMatrix:
    """Rank queries over numbers: packed bits and a running count per 64 of them on each level."""

    def __init__(self, values: np.ndarray, top: int):
        self.n = len(values)
        self.levels = max(1, int(top).bit_length())
        self.bits, self.ones, self.zeros = [], [], []
        at_symbol = np.arange(top + 1)
        low = np.zeros(top + 1, dtype=np.int64)  # where a symbol's run starts below the last level
        now = values
        for level in range(self.levels - 1, -1, -1):
            bit = ((now >> level) & 1).astype(np.uint8)
            padded = np.zeros((self.n // 64 + 1) * 64, dtype=np.uint8)
            padded[: self.n] = bit
            words = np.packbits(padded, bitorder="little").view("<u8")
            self.bits.append(words)
            self.ones.append(np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int32)]).astype(np.int32))
            self.zeros.append(self.n - int(bit.sum()))
            low = self._down(len(self.bits) - 1, low, (at_symbol >> level) & 1)
            now = np.concatenate([now[bit == 0], now[bit == 1]])
        self.low = low

    def _down(self, k: int, i: np.ndarray, bit: np.ndarray) -> np.ndarray:
        word = i >> 6
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        ones = self.ones[k][word] + np.bitwise_count(self.bits[k][word] & mask)
        return np.where(bit == 1, self.zeros[k] + ones, i - ones)

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each place."""
        for k in range(self.levels):
            i = self._down(k, i, (symbol >> (self.levels - 1 - k)) & 1)
        return i - self.low[symbol]


class FMIndex:
    """Backward search for patterns up to ``depth`` symbols over ``text`` (numbers from 1, 0 parts segments)."""

    def __init__(self, text: np.ndarray, depth: int):
        n = len(text)
        rank, names, have = text.astype(np.int64), {}, 1
        while have <= depth:  # suffix order by doubling, one symbol deeper than the patterns
            names[have] = rank
            ahead = np.zeros(n, dtype=np.int64)
            ahead[: max(0, n - have)] = rank[have:] + 1
            rank = np.unique(rank * np.int64(n + 2 + int(text.max(initial=0))) + ahead, return_inverse=True)[1].astype(np.int64)
            have *= 2
        names[have] = rank
        self.order = np.argsort(rank, kind="stable")
        self.names, self.depth = names, depth
        top = int(text.max(initial=0))
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=top + 1))])  # rows of each first symbol
        self.bwt = WaveletMatrix(text[self.order - 1], top)
        self.heads = {d: self._heads(d) for d in (depth - 1, depth)}

    def _heads(self, d: int):
        """Where each row's group of suffixes equal in d symbols starts, and ends."""
        n, new = len(self.order), None
        if d <= 0:
            new = np.zeros(n, dtype=bool)
        else:
            have = max(p for p in self.names if p <= d)
            far = np.minimum(self.order + (d - have), n - 1)
            a, b = self.names[have][self.order], self.names[have][far]
            new = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
        new[:1] = True
        heads = np.flatnonzero(new)
        group = np.cumsum(new) - 1
        return heads[group], np.append(heads[1:], n)[group]

    def widen(self, lo: np.ndarray):
        """The parent interval, one symbol shorter than ``depth``."""
        a, b = self.heads[self.depth - 1]
        return a[lo], b[lo]

    def back(self, symbol: np.ndarray, lo: np.ndarray, hi: np.ndarray):
        """The intervals with ``symbol`` put in front; empty ones have lo == hi."""
        return self.first[symbol] + self.bwt.rank(symbol, lo), self.first[symbol] + self.bwt.rank(symbol, hi)


def find_repeats(texts: list[bytes], doc: np.ndarray, start: np.ndarray, width: int = WIDTH):
    """(segment, from, to) of each window of ``width`` words that starts earlier in another segment or place."""
    lists = pc.split_pattern(pa.array(texts, pa.binary()).cast(pa.string()), " ")
    codes = lists.flatten().dictionary_encode().indices.to_numpy().astype(np.int64) + 1
    bounds = lists.offsets.to_numpy().astype(np.int64)
    size = np.diff(bounds)
    # a separator after every segment
    text = np.zeros(len(codes) + len(size), dtype=np.int64)
    place = np.arange(len(codes)) + np.repeat(np.arange(len(size)), size)
    text[place] = codes
    begin = bounds[:-1] + np.arange(len(size))
    index = FMIndex(text, width)
    # first occurrence of each interval at full width
    _, rank = np.unique(doc, return_inverse=True)
    key = np.full(len(text), np.iinfo(np.int64).max)
    key[place] = np.repeat((rank.astype(np.int64) << START_BITS) | start, size) + (np.arange(len(codes)) - np.repeat(bounds[:-1], size))
    head = index.heads[width][0]
    heads = np.flatnonzero(np.arange(len(head)) == head)
    lowest = np.minimum.reduceat(key[index.order], heads)
    number = np.cumsum(np.arange(len(head)) == head) - 1

    found_seg, found_at = [], []
    seg = np.argsort(-size, kind="stable")
    lo, hi = np.zeros(len(seg), np.int64), np.full(len(seg), len(text), np.int64)
    for step in range(1, int(size.max(initial=0)) + 1):
        live = int(np.searchsorted(-size[seg], -step, side="right"))  # segments with that many words
        at = size[seg[:live]] - step
        lo, hi = lo[:live], hi[:live]
        if step > width:
            lo, hi = index.widen(lo)
        lo, hi = index.back(text[begin[seg[:live]] + at], lo, hi)
        if step >= width:
            again = np.flatnonzero((hi - lo > 1) & (key[begin[seg[:live]] + at] > lowest[number[np.minimum(lo, len(number) - 1)]]))
            found_seg.append(seg[again])
            found_at.append(at[again])
    if not found_seg:
        return (np.zeros(0, np.int64),) * 3
    return merge(np.concatenate(found_seg), np.concatenate(found_at), width)


def dedup_words(docs: DataFrame, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text", digest: bool = False, hot: int | None = None) -> DataFrame:
    """Every row's words without those covered by a window of ``width`` words that starts earlier.

    Rows: doc_id, n_words, n_removed and kept (the words that stay, joined by one space),
    or kept_sha256 with ``digest``. Null texts have no words; a null doc_id is never
    removed from and counts for nothing; rows repeated under one id are one document;
    texts of fewer than ``width`` words stay. Other columns are not read.
    """
    units = Units(True, width, min(GRAM, width))
    extra = {} if hot is None else {"hot": hot}
    marked, spans = repeated_spans(docs, units, lambda t, d, s: find_repeats(t, d, s, width), id_col, text_col, **extra)
    if digest:
        finish = lambda n, gone, kept, cuts: (n, gone, hashlib.sha256(kept).hexdigest())
        return without_spans(docs, marked, spans, units, id_col, text_col, finish, "n_words long, n_removed long, kept_sha256 string")
    finish = lambda n, gone, kept, cuts: (n, gone, kept.decode())
    return without_spans(docs, marked, spans, units, id_col, text_col, finish, "n_words long, n_removed long, kept string")


def cut_repeats(docs: DataFrame, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text", size_col: str = "n_chars") -> DataFrame:
    """``docs`` with each text cut as by ``dedup_words``; all columns stay, ``size_col`` is counted anew where it is there.

    A text that loses nothing is not touched; of a cut one the words that stay are joined
    by one space. A row whose words are all repeats has nothing of its own and goes.
    """
    units = Units(True, width, min(GRAM, width))
    marked, spans = repeated_spans(docs, units, lambda t, d, s: find_repeats(t, d, s, width), id_col, text_col)
    names = list(docs.columns)
    at = names.index(text_col)

    def run(batches):
        for batch in batches:
            for part in byte_slices(batch, at, SLICE_BYTES):
                old = part.column(at).cast(pa.string())
                cut = units.kept(old.fill_null(""), part.column(part.num_columns - 2).to_pylist(), part.column(part.num_columns - 1).to_pylist())
                new = [kept.decode() if gone else text for (_, gone, kept, _), text in zip(cut, old.to_pylist(), strict=True)]
                columns = [pa.array(new, pa.string()) if k == at else part.column(k) for k in range(part.num_columns - 2)]
                keep = pa.array([not gone or gone < n for n, gone, _, _ in cut])
                yield pa.RecordBatch.from_arrays(columns, names=names).filter(keep)

    out = with_spans(docs, marked, spans, id_col, text_col).mapInArrow(tidy(run), docs.schema)
    return resized(out, text_col, size_col)
