"""Best-fit packing of tokenised documents into sequences of bounded length.

Bounded-space online best-fit: every task streams its documents and keeps a fixed
number of bins open. A Python integer is the bitset keyed by free space (bit f is
set while an open bin has f free places), so the best fit of a piece is the lowest
set bit at or above its length. When no bin fits and all are open, the fullest
one closes first. Bins still open when a task ends are emptied again and their
pieces packed a second time, longest first, over groups of ``FAN_IN`` tasks: a
group holds at most ``FAN_IN * open_bins`` bins of pieces, whatever the input size.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections import defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segmint.llm.common import ByteCache, byte_slices, per_worker, tidy, prepare, store

MAX_TOKENS = 2048
OPEN_BINS = 512
FAN_IN = 16
#: bytes a Python worker's cache of runs and that of words hold, each
CACHE_BYTES = 64 << 20
#: bytes of text tokenised at a time (a longer text alone): bounds the task's memory
CHUNK_BYTES = 4 << 20


class WordEncoder:
    """Token ids of texts by a ``tokenizers`` file with the pattern below.

    No token crosses white space or the border of two runs (letters, a digit, signs), so
    a text's ids are its runs' ids one after another. A batch of texts is split and its
    words numbered by Arrow; each distinct word and run is encoded once while it stays
    in a bounded cache. Texts with letters beyond Latin (where lower-casing rules differ
    between libraries) go through the tokenizer as they are.
    """

    #: the tokenizer file's contractions, letters, numbers and signs below U+0250 (fixed values)
    LETTERS = "a-zA-Zªµº\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
    NUMBERS = "0-9²³¹¼½¾"
    PATTERN = f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[{NUMBERS}]|[^\\s{LETTERS}{NUMBERS}]+"
    #: other letters, a letter whose lower case is two characters, control characters (white space to some libraries), special tokens
    EXOTIC = "[\u0250-\U0010ffff\u0130\x00-\x08\x0e-\x1f\x7f-\x9f]|<\\|"

    def __init__(self, path: str, cache_bytes: int = CACHE_BYTES):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.runs_of = re.compile(self.PATTERN).findall
        self.exotic = re.compile(self.EXOTIC).search
        self.runs, self.words = ByteCache(cache_bytes), ByteCache(cache_bytes)
        plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]  # byte-level alphabet: printable bytes stand for themselves
        rest = [b for b in range(256) if b not in plain]
        self.alphabet = {b: chr(256 + k) for k, b in enumerate(rest)}

    def whole(self, text: str) -> bytes:
        return np.asarray(self.tok.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _run(self, run: str) -> bytes:
        got = self.runs.find(run)
        if got is None:
            marked = run if run.isascii() else run.encode().decode("latin-1").translate(self.alphabet)
            got = np.array([t.id for t in self.tok.model.tokenize(marked)], dtype="<u4").tobytes()
            self.runs.put(run, got)
        return got

    def _word(self, word: str) -> bytes:
        if word.isalpha():
            return self._run(word)
        got = self.words.find(word)
        if got is None:
            got = b"".join(map(self._run, self.runs_of(word)))
            self.words.put(word, got)
        return got

    def encode(self, texts: pa.Array) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text; null is empty."""
        plain = [not self.exotic(t) and (t.isascii() or unicodedata.is_normalized("NFC", t))
                 for t in texts.fill_null("").to_pylist()]
        some = texts.filter(pa.array(plain, pa.bool_()))
        words = pc.utf8_split_whitespace(pc.utf8_lower(some.fill_null("")))
        numbered = words.flatten().dictionary_encode()
        known = [self._word(w) for w in numbered.dictionary.to_pylist()]
        size = np.fromiter(map(len, known), dtype=np.int64, count=len(known)) // 4
        pool = np.frombuffer(b"".join(known), dtype="<u4")
        which = numbered.indices.to_numpy()
        n = size[which]
        ends = np.cumsum(n)
        at = np.repeat((np.cumsum(size) - size)[which] - (ends - n), n) + np.arange(int(n.sum()))
        ids = pool[at].astype("<u4")
        cuts = np.concatenate([[0], ends])[words.offsets.to_numpy() - words.offsets[0].as_py()]
        found = iter([ids[a:b].tobytes() for a, b in zip(cuts, cuts[1:], strict=False)])
        return [next(found) if ok else self.whole(t.as_py()) for ok, t in zip(plain, texts, strict=True)]


class Bins:
    """Open bins of one packer; ``add`` gives (bin, offset) for a piece."""

    def __init__(self, capacity: int, open_bins: int):
        self.capacity, self.most = capacity, open_bins
        self.bits, self.by_free, self.n_open, self.next = 0, defaultdict(list), 0, 0
        self.closed: list[int] = []

    def _take(self, free: int) -> int:
        bins = self.by_free[free]
        b = bins.pop()
        if not bins:
            del self.by_free[free]
            self.bits &= ~(1 << free)
        return b

    def add(self, length: int) -> tuple[int, int]:
        fits = self.bits >> length
        if fits:
            free = length + (fits & -fits).bit_length() - 1
            b = self._take(free)
        else:
            if self.n_open >= self.most:
                fullest = (self.bits & -self.bits).bit_length() - 1
                self.closed.append(self._take(fullest))
                self.n_open -= 1
            b, free = self.next, self.capacity
            self.next += 1
            self.n_open += 1
        left = free - length
        if left:
            self.by_free[left].append(b)
            self.bits |= 1 << left
        else:
            self.closed.append(b)
            self.n_open -= 1
        return b, self.capacity - free


def _pieces(doc_id, ids: bytes, cap: int, with_ids: bool):
    for k, at in enumerate(range(0, len(ids), 4 * cap)):
        part = ids[at : at + 4 * cap]
        yield doc_id, k, at // 4, len(part) // 4, zlib.crc32(part), part if with_ids else None


COLS = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]


def _first_pass(path: str, cap: int, open_bins: int, end_id: int, with_ids: bool):
    def run(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        enc, bins = per_worker(WordEncoder, path), Bins(cap, open_bins)
        end = np.asarray([end_id], dtype="<u4").tobytes()
        waiting: dict[int, list] = {}
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.bool_(), pa.int64()]
        schema = pa.schema(list(zip([*COLS, "bin", "offset", "closed", "part"], kinds, strict=True)))

        def frame(rows, closed):
            out = pd.DataFrame(rows, columns=[*COLS, "bin", "offset"])
            out["closed"], out["part"] = closed, part
            return pa.RecordBatch.from_pandas(out, schema=schema, preserve_index=False)

        for batch in batches:
            for chunk in byte_slices(batch, 1, CHUNK_BYTES):
                for doc_id, ids in zip(chunk.column(0).to_pylist(), enc.encode(chunk.column(1)), strict=True):
                    for row in _pieces(doc_id, ids + end, cap, with_ids):
                        b, at = bins.add(row[3])
                        waiting.setdefault(b, []).append((*row, b, at))
                done = [r for b in bins.closed for r in waiting.pop(b)]
                bins.closed.clear()
                if done:
                    yield frame(done, True)
        rest = [r for rows in waiting.values() for r in rows]
        if rest:
            yield frame(rest, False)

    return tidy(run)


def _second_pass(cap: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "doc_id", "piece", "part", "bin", "offset"], ascending=[False, True, True, True, True, True], kind="stable")
        bins = Bins(cap, len(pdf))
        put = [bins.add(n) for n in pdf["length"].tolist()]
        pdf["bin"], pdf["offset"] = [b for b, _ in put], [o for _, o in put]
        pdf["part"] = pdf["part"] // FAN_IN
        return pdf

    return run


def pack_documents(docs: DataFrame, tokenizer_path: str, max_tokens: int = MAX_TOKENS, open_bins: int = OPEN_BINS,
                   end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids).

    A document is its text's ids followed by ``end_id``; null and empty texts are
    that one id. Only documents over ``max_tokens`` are cut. Repeated rows and null
    ids are packed like any other row; an empty frame gives no rows; other columns
    are not read. ``with_ids`` adds the little-endian 32-bit ids as binary.
    """
    prepare(docs.sparkSession)
    kinds = "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary, bin long, offset long"
    first = store(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
                  .mapInArrow(_first_pass(tokenizer_path, max_tokens, open_bins, end_id, with_ids),
                               f"{kinds}, closed boolean, part long"))
    again = first.where("not closed").withColumn("grp", (F.col("part") / FAN_IN).cast("long"))
    names = [*COLS, "bin", "offset", "closed", "part"]
    second = again.groupBy("grp").applyInPandas(
        lambda pdf: _second_pass(max_tokens)(pdf)[names], f"{kinds}, closed boolean, part long")
    # high bits: task; low bit: pass
    seq = (F.col("part") * F.lit(1 << 33) + F.col("bin") * 2 + F.when(F.col("closed"), 0).otherwise(1)).cast("long")
    out = first.where("closed").union(second)
    cols = COLS if with_ids else COLS[:-1]
    return out.select(*cols, seq.alias("sequence_id"), "offset")
