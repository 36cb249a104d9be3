"""Windows of fixed length over sequences of units (words or bytes), and their anchors.

Every window of ``width`` units is given to the smallest ``gram``-unit hash inside it
(leftmost of equals), its anchor. Equal windows have equal anchors, so whatever is
grouped by anchor keeps equal windows together, and consecutive windows mostly share
one anchor: a run of them is one segment of text, cut out once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from segmint.llm.common import U64, mix

#: positions handled at a time; a longer text is taken in overlapping parts
PART = 1 << 21
LOW = U64((1 << 22) - 1)
BYTE_CODES = mix(np.arange(1, 257, dtype=np.uint64) * U64(0x9E3779B97F4A7C15))


def powers(k: int) -> np.uint64:
    return U64(pow(0x9E3779B97F4A7C15, k, 1 << 64))


def gram_hashes(units: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k consecutive units (uint64), by doubling; k at most len(units)."""
    done, have, h = 0, 1, units
    total = None
    while True:
        if k & have:
            part = h[done : len(units) - k + done + 1]
            total = part.copy() if total is None else total * powers(have) + part
            done += have
        if done == k:
            return mix(total)
        h = h[:-have] * powers(have) + h[have:]
        have *= 2


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every w consecutive values."""
    have = 1
    while have * 2 <= w:
        x = np.minimum(x[:-have], x[have:])
        have *= 2
    return np.minimum(x[: len(x) - (w - have)], x[w - have :]) if have < w else x


def runs(units: np.ndarray, bounds: np.ndarray, width: int, gram: int):
    """Runs of windows with one anchor, over texts laid end to end.

    ``units``: uint64; ``bounds``: text k is units[bounds[k]:bounds[k+1]]. Returns arrays
    (text, first window start in the text, number of windows, anchor hash), in order.
    """
    out = []
    k = 0
    while k < len(bounds) - 1:
        if bounds[k + 1] - bounds[k] < width:
            k += 1
            continue
        last = k + 1
        while last < len(bounds) - 1 and bounds[last + 1] - bounds[k] <= PART:
            last += 1
        if last == k + 1:  # one text, maybe a very long one
            n = int(bounds[k + 1] - bounds[k]) - width + 1
            for at in range(0, n, PART):
                here = units[bounds[k] + at : bounds[k] + min(at + PART, n) + width - 1]
                t, s, m, h = _runs(here, np.array([0, len(here)]), width, gram)
                out.append((t + k, s + at, m, h))
        else:
            t, s, m, h = _runs(units[bounds[k] : bounds[last]], bounds[k : last + 1] - bounds[k], width, gram)
            out.append((t + k, s, m, h))
        k = last
    if not out:
        z = np.zeros(0, np.int64)
        return z, z, z, np.zeros(0, np.uint64)
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _runs(units, bounds, width, gram):
    h = gram_hashes(units, gram)
    key = (h & ~LOW) | np.arange(len(h), dtype=np.uint64)
    anchor = (sliding_min(key, width - gram + 1) & LOW).astype(np.int64)  # per window start
    size = np.diff(bounds)
    good = np.flatnonzero(size >= width)
    text = np.repeat(good, size[good] - width + 1)
    start = np.arange(len(text)) - np.repeat(np.cumsum(size[good] - width + 1) - (size[good] - width + 1), size[good] - width + 1)
    at = anchor[bounds[text] + start]
    new = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (text[1:] != text[:-1])]))
    count = np.diff(np.concatenate([new, [len(text)]]))
    return text[new], start[new], count, h[at[new]]


def word_lists(texts: pa.Array) -> tuple[pa.Array, np.ndarray, pa.Array]:
    """Words (split at ASCII white space) of each text: their numbers, bounds, and the distinct words.

    ``texts`` is a string array without nulls; returns (word numbers, bounds, dictionary)."""
    lists = pc.ascii_split_whitespace(texts)
    flat = lists.flatten()
    bounds = lists.offsets.to_numpy().astype(np.int64)
    bounds = bounds - bounds[0]
    full = pc.not_equal(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    if not full.all():  # white space at either end leaves empty words
        kept = np.concatenate([[0], np.cumsum(full)])
        flat, bounds = flat.filter(pa.array(full)), kept[bounds]
    numbered = flat.dictionary_encode()
    return numbered.indices.to_numpy().astype(np.int64), bounds, numbered.dictionary


def word_codes(distinct: pa.Array) -> np.ndarray:
    import xxhash

    words = distinct.cast(pa.binary()).to_pylist()
    return np.fromiter(map(xxhash.xxh64_intdigest, words), dtype=np.uint64, count=len(words))


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of string or binary texts laid end to end, and their bounds."""
    texts = texts.cast(pa.large_string() if pa.types.is_string(texts.type) else pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]
