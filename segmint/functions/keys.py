"""Key functions: consistent bucket of a string (O51) and run-prefixed ids."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


_MASK = 0xFFFFFFFF
# MurmurHash3 x86 32-bit (public domain): block multipliers, block sum, final multipliers
_C1, _C2, _N, _F1, _F2 = 0xCC9E2D51, 0x1B873593, 0xE6546B64, 0x85EBCA6B, 0xC2B2AE35


def _low(x: Column) -> Column:
    return x.bitwiseAND(F.lit(_MASK))


def _times(x: Column, c: int) -> Column:
    """x * c modulo 2^32, both below 2^32: in halves, so that no product leaves 64 bits."""
    high = F.shiftright(x, 16) * F.lit(c)
    return _low(x.bitwiseAND(F.lit(0xFFFF)) * F.lit(c) + F.shiftleft(high.bitwiseAND(F.lit(0xFFFF)), 16))


def _rotated(x: Column, bits: int) -> Column:
    return _low(F.shiftleft(x, bits)).bitwiseOR(F.shiftright(x, 32 - bits))


def _shifted(x: Column, bits: int) -> Column:
    return x.bitwiseXOR(F.shiftright(x, bits))


def _bound(x: Column, f: Callable[[Column], Column]) -> Column:
    """``f`` of a value that is worked out once, however often ``f`` names it."""
    return F.element_at(F.transform(F.array(x), f), 1)


def _murmur3_of(units: Column, seed: int) -> Column:
    """Murmur3 of UTF-16 code units, given as bytes, high ones first."""
    n = (F.length(units) / 2).cast("int")
    # bytes are cut in place: a piece of a string would be sought from its start each time
    number = lambda start, size: F.conv(F.hex(F.substr(units, start, F.lit(size))), 16, 10).cast("bigint")
    mixed = (lambda k: _times(k, _C1), lambda k: _rotated(k, 15), lambda k: _times(k, _C2))
    starts = F.when(n > 1, F.sequence(F.lit(1), n * 2 - 3, F.lit(4))).otherwise(F.array().cast("array<int>"))
    # a block's second unit is its high half; an odd last unit is a block of its own
    blocks = F.transform(F.transform(starts, lambda i: number(i, 4)), lambda k: _rotated(k, 16))
    last = F.array(F.when(n % 2 == 1, number(n * 2 - 1, 2)).otherwise(F.lit(0).cast("bigint")))
    for step in mixed:
        blocks, last = F.transform(blocks, step), F.transform(last, step)
    h = F.aggregate(blocks, F.lit(seed).cast("bigint"), lambda h, k: _low(_rotated(h.bitwiseXOR(k), 13) * 5 + F.lit(_N)))
    done = F.array(h.bitwiseXOR(F.element_at(last, 1)).bitwiseXOR((n * 2).cast("bigint")))
    for step in (lambda v: _shifted(v, 16), lambda v: _times(v, _F1), lambda v: _shifted(v, 13), lambda v: _times(v, _F2), lambda v: _shifted(v, 16)):
        done = F.transform(done, step)
    return F.element_at(F.transform(done, lambda v: F.when(v > 0x7FFFFFFF, v - (1 << 32)).otherwise(v)), 1)


def murmur3_utf16(x, seed: int = 0) -> Column:
    """Murmur3 (x86, 32 bits) of a string's UTF-16 code units, two of them a block, as a signed int in a bigint.

    Characters beyond the basic plane count as their two surrogates; null gives null.
    Every step is a lambda over bigints, so nothing is evaluated twice and nothing overflows.
    The string is encoded once, outside the lambda of its blocks, so the work is in proportion to its length.
    """
    x = F.col(x) if isinstance(x, str) else x
    return _bound(F.encode(x.cast("string"), "UTF-16BE"), lambda units: F.when(units.isNotNull(), _murmur3_of(units, seed)))


def consistent_hash(x, num_slots: int, method: str = "md5") -> Column:
    """Bucket 0..num_slots-1 of a string key.

    ``md5`` (default) takes the first 32 bits of the MD5 digest, so the bucket
    is reproducible outside Spark. ``murmur`` uses Spark's built-in ``hash``
    (Murmur3, seed 42): faster, same purpose, different values. ``utf16`` is the
    reference's hash (Murmur3, seed 0, over UTF-16 code units), for data that was
    placed by it. A null key has no bucket.
    """
    if num_slots <= 0:
        raise ValueError("num_slots must be positive")
    x = F.col(x) if isinstance(x, str) else x
    if method == "md5":
        h = F.conv(F.substring(F.md5(x.cast("string")), 1, 8), 16, 10).cast("bigint")
    elif method == "murmur":
        h = F.hash(x)
    elif method == "utf16":
        h = murmur3_utf16(x)
    else:
        raise ValueError(f"unknown hash method {method!r}")
    return F.pmod(h, F.lit(num_slots)).cast("bigint")


def cluster_id(run_id: str | Column, cluster) -> Column:
    """``<run id>-<cluster number>``."""
    run = F.lit(run_id) if isinstance(run_id, str) else run_id
    cluster = F.col(cluster) if isinstance(cluster, str) else cluster
    return F.concat_ws("-", run, cluster.cast("string"))
