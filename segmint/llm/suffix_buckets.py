"""Repeated byte passages by bucket-pointer refinement of suffixes.

In a shard the suffixes of all segments start in buckets by their first ``Q`` bytes, laid
out in the order of these bytes; a suffix's bucket pointer is the last place of its bucket.
Buckets are refined in ``ROUNDS`` rounds of about equal work: a bucket is sorted on the
pointers of the places as far ahead as its suffixes are known to agree, its parts get
pointers of their own at once, and parts that still hold several suffixes are refined
again in the same way, further ahead. Later rounds read the pointers as earlier ones left
them, mostly whole orders already, so one look often settles what would take many. A
segment's end is a symbol below all bytes, so a suffix that reached it is settled.

Neighbours in the order of suffixes so made that agree in ``width`` bytes form the groups
of equal windows; the smallest (document, start) of a group is the first occurrence, every
other one is a repeat.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segmint.llm.passages import START_BITS, Units, repeated_spans, without_spans

WIDTH = 100
GRAM = 24
Q = 7  # symbols of 9 bits in one 64-bit number
ROUNDS = 8
COMPARED = 1 << 16  # neighbours compared at a time


class SuffixBuckets:
    """The order of all suffixes of ``text`` (symbols from 1; 0 ends a segment and is the last symbol)."""

    def __init__(self, text: np.ndarray, q: int = Q, rounds: int = ROUNDS):
        n = len(text)
        self.left = _to_end(text)
        grams = np.zeros(n, dtype=np.uint64)
        for j in range(q):  # nothing is read past a segment's end
            ahead = np.zeros(n, dtype=np.uint64)
            ahead[: max(0, n - j)] = text[j:]
            grams = (grams << np.uint64(9)) | np.where(self.left >= j, ahead, np.uint64(0))
        self.order = np.argsort(grams)
        self.pointer = np.empty(n, dtype=np.int64)
        self.known = np.full(n, q, dtype=np.int64)  # how many symbols the suffixes of a place's bucket share
        ordered = grams[self.order]
        ends = np.flatnonzero(np.append(ordered[1:] != ordered[:-1], True)) if n else np.zeros(0, np.int64)
        sizes = np.diff(np.append(-1, ends))
        self.pointer[self.order] = np.repeat(ends, sizes)
        # small buckets first: large ones then read what is already settled
        rank = np.empty(len(ends), dtype=np.int64)
        by_size = np.argsort(sizes, kind="stable")
        rank[by_size] = np.cumsum(sizes[by_size]) * rounds // max(n, 1)
        turn = np.repeat(np.minimum(rank, rounds - 1), sizes)
        for r in range(rounds):
            self._refine(np.flatnonzero(turn == r))

    def _refine(self, rows: np.ndarray) -> None:
        """Order the suffixes in these places of the order (whole buckets, ascending), as deep as they differ."""
        while len(rows):
            at = self.order[rows]
            own = self.pointer[at]
            several = np.zeros(len(rows), dtype=bool)
            same = own[1:] == own[:-1]
            several[1:] = same
            several[:-1] |= same
            open_ = several & (self.left[at] >= self.known[at])  # the end lies beyond what is known
            rows, at, own = rows[open_], at[open_], own[open_]
            if not len(rows):
                return
            ahead = at + self.known[at]
            key, deeper = self.pointer[ahead], self.known[ahead]
            by = np.argsort(own * np.int64(len(self.order)) + key)
            at, own, key, deeper = at[by], own[by], key[by], deeper[by]
            self.order[rows] = at
            last = np.append((own[1:] != own[:-1]) | (key[1:] != key[:-1]), True)
            ends = np.flatnonzero(last)
            self.pointer[at] = np.repeat(rows[ends], np.diff(np.append(-1, ends)))
            self.known[at] += deeper


def _to_end(text: np.ndarray) -> np.ndarray:
    """How far each place is from its segment's end."""
    ends = np.flatnonzero(text == 0)
    return np.repeat(ends, np.diff(np.append(-1, ends))) - np.arange(len(text))


def find_repeats(texts: list[bytes], doc: np.ndarray, start: np.ndarray, width: int = WIDTH):
    """(segment, from, to) of each window that starts earlier in another segment or place."""
    size = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    text = np.zeros(int((size + 1).sum()), dtype=np.uint16)
    begin = np.cumsum(size + 1) - size - 1
    seg = np.repeat(np.arange(len(texts)), size)
    inside = np.arange(len(seg)) - np.repeat(np.cumsum(size) - size, size)
    text[begin[seg] + inside] = np.frombuffer(b"".join(texts), dtype=np.uint8).astype(np.uint16) + 1
    index = SuffixBuckets(text)
    whole = index.order[index.left[index.order] >= width]  # windows, those of equal bytes side by side
    if not len(whole):
        return (np.zeros(0, np.int64),) * 3
    new = np.ones(len(whole), dtype=bool)
    windows = np.lib.stride_tricks.sliding_window_view(text, width)
    for k in range(1, len(whole), COMPARED):
        here = whole[k - 1 : k + COMPARED]
        new[k : k + COMPARED] = (windows[here[1:]] != windows[here[:-1]]).any(axis=1)
    seg = np.searchsorted(begin, whole, side="right") - 1
    inside = whole - begin[seg]
    _, rank = np.unique(doc, return_inverse=True)
    key = (rank[seg].astype(np.int64) << START_BITS) | (start[seg] + inside)
    heads = np.flatnonzero(new)
    lowest = np.repeat(np.minimum.reduceat(key, heads), np.diff(np.append(heads, len(whole))))
    again = key > lowest
    return merge(seg[again], inside[again], width)


def merge(seg: np.ndarray, at: np.ndarray, width: int):
    """Windows at ``at`` of segments as runs (segment, from, to), neighbours joined."""
    if not len(seg):
        return (np.zeros(0, np.int64),) * 3
    order = np.lexsort((at, seg))
    seg, at = seg[order], at[order]
    new = np.concatenate([[True], (seg[1:] != seg[:-1]) | (at[1:] > at[:-1] + 1)])
    head = np.flatnonzero(new)
    tail = np.append(head[1:], len(seg)) - 1
    return seg[head], at[head], at[tail] + width


def dedup_bytes(docs: DataFrame, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text", digest: bool = False, hot: int | None = None) -> DataFrame:
    """Every row's text without the bytes covered by a ``width``-byte string that starts earlier.

    Rows: doc_id, n_bytes, n_removed, n_spans and kept (binary: a cut may part a
    character), or kept_sha256 with ``digest``. Null texts are empty; a null doc_id is
    never removed from and counts for nothing; rows repeated under one id are one
    document; texts shorter than ``width`` stay. Other columns are not read.
    """
    units = Units(False, width, min(GRAM, width))
    extra = {} if hot is None else {"hot": hot}
    marked, spans = repeated_spans(docs, units, lambda t, d, s: find_repeats(t, d, s, width), id_col, text_col, **extra)
    if digest:
        finish = lambda n, gone, kept, cuts: (n, gone, cuts, hashlib.sha256(kept).hexdigest())
        return without_spans(docs, marked, spans, units, id_col, text_col, finish, "n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    finish = lambda n, gone, kept, cuts: (n, gone, cuts, kept)
    return without_spans(docs, marked, spans, units, id_col, text_col, finish, "n_bytes long, n_removed long, n_spans long, kept binary")


def spans_of(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """The repeated places themselves: doc, span (from, to), not merged."""
    _, spans = repeated_spans(docs, Units(False, width, min(GRAM, width)), lambda t, d, s: find_repeats(t, d, s, width))
    return spans.select("doc", F.explode("spans").alias("span"))
