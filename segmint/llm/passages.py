"""Passages that start earlier in the corpus: the Spark side shared by the word and the byte operator.

What is looked for: every window of ``width`` units whose units also start at an
earlier place (smaller document id, or the same document and a smaller start).

1. Each text gives its runs' anchors (``windows.runs``); anchors seen once in the corpus
   can't hold a repeated window and go no further.
2. Exact copies: only the copy with the smallest id goes on; the others are removed whole.
3. The segments of repeated anchors are cut out of the texts. A segment whose content
   occurred earlier as a whole is removed whole; that needs only narrow rows.
4. First occurrences of contents that share an anchor with other contents meet in shards
   by anchor, where the operator's own index finds their earlier windows.
5. An anchor with more than ``HOT`` contents is not sent to one shard: its windows are
   spread by their own content and the earliest of each is taken by aggregation.

Counting is partial before each shuffle; joins on anchors are ordinary joins that the
planner may split where skewed. Every step is written to the shared folder, so a lost
executor costs its tasks of one step.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segmint.llm.common import U64, byte_slices, mix, prepare, release, store, tidy
from segmint.llm.windows import BYTE_CODES, powers, runs, text_bytes, word_codes, word_lists

HOT = 5_000
SHARD_UNITS = 1 << 20
SLICE_BYTES = 2 << 20  # of texts taken at a time (a longer one alone); arrays of their units take some 20 times as much
START_BITS = 40


@dataclass(frozen=True)
class Units:
    """Words or bytes: how texts become units and units become text again."""

    words: bool
    width: int
    gram: int

    def read(self, texts: pa.Array):
        """(hashed units, bounds, pieces): pieces(a, b) gives the text of units a..b as bytes."""
        if self.words:
            which, bounds, distinct = word_lists(texts)
            names = np.array(distinct.cast(pa.binary()).to_pylist() or [b""], dtype=object)
            return word_codes(distinct)[which], bounds, lambda a, b: b" ".join(names[which[a:b]])
        raw, bounds = text_bytes(texts)
        return BYTE_CODES[raw], bounds, lambda a, b: raw[a:b].tobytes()

    def kept(self, texts: pa.Array, spans: list, copies: list) -> list[tuple[int, int, bytes, int]]:
        """(units, removed units, bytes that stay, removed runs) of each text without its spans
        [(from, to)]; of a copy nothing stays."""
        out = []
        for text, cut, copy in zip(texts.cast(pa.binary()).to_pylist(), spans, copies, strict=True):
            if self.words:
                text = text.split()  # bytes split at ASCII white space
            n = len(text)
            if copy:
                out.append((n, n, b"", 1))
            elif not cut:
                out.append((n, 0, b" ".join(text) if self.words else text, 0))
            else:
                stay = covered(n, cut) == 0
                if self.words:
                    got = b" ".join(compress(text, stay.tolist()))
                else:
                    got = np.frombuffer(text, dtype=np.uint8)[stay].tobytes()
                out.append((n, int(n - stay.sum()), got, int((np.diff(np.concatenate([[1], stay])) == -1).sum())))
        return out


def covered(n: int, spans) -> np.ndarray:
    """How many of the spans cover each of n units."""
    edge = np.zeros(n + 1, dtype=np.int64)
    if spans is not None and len(spans):
        a = np.asarray(spans, dtype=np.int64)
        np.add.at(edge, a[:, 0], 1)
        np.add.at(edge, a[:, 1], -1)
    return np.cumsum(edge)[:n]


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc, text and two 64-bit digests of the text: rows of one id but other text stay apart."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).cast("long").alias("doc"), text.alias("text"),
                       F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(7), text).alias("k2"))


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _anchors(units: Units):
    """doc, k1, k2 and the anchors of each text, in order."""

    def run(batches):
        for batch in batches:
            for part in byte_slices(batch, 1, SLICE_BYTES):
                codes, bounds, _ = units.read(part.column(1))
                text, _, _, anchor = runs(codes, bounds, units.width, units.gram)
                ends = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=part.num_rows))]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), _signed(anchor))
                n = pa.array(np.diff(bounds))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), part.column(3), n, lists],
                                                 names=["doc", "k1", "k2", "n", "anchors"])

    return run


def _segments(units: Units):
    """The segments of each text's listed runs; the content only at its first occurrence in the batch."""

    def run(batches):
        for batch in batches:
            for part in byte_slices(batch, 1, SLICE_BYTES):
                codes, bounds, pieces = units.read(part.column(1))
                text, start, count, anchor = runs(codes, bounds, units.width, units.gram)
                first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=part.num_rows))])
                pick = [f + np.unique([x for x in want if x < g - f]).astype(np.int64)
                        for f, g, want in zip(first, first[1:], part.column(3).to_pylist(), strict=False)]
                pick = np.concatenate(pick)
                text, start, count, anchor = text[pick], start[pick], count[pick], anchor[pick]
                a = bounds[text] + start
                b = a + count + units.width - 1
                content = segment_hashes(codes, a, b)
                doc, k1 = np.asarray(part.column(0))[text], np.asarray(part.column(2))[text]
                order = np.lexsort((start, doc, content, anchor))
                new = np.ones(len(order), dtype=bool)
                new[1:] = (anchor[order][1:] != anchor[order][:-1]) | (content[order][1:] != content[order][:-1])
                leads = np.zeros(len(order), dtype=bool)
                leads[order[new]] = True
                texts = [pieces(x, y) if lead else None for x, y, lead in zip(a.tolist(), b.tolist(), leads.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [_signed(anchor), _signed(content), pa.array(doc), pa.array(k1), pa.array(start), pa.array(b - a), pa.array(texts, pa.binary())],
                    names=["anchor", "content", "doc", "k1", "start", "n", "text"])

    return run


def segment_hashes(codes: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """64-bit hashes of codes[a:b] by prefix sums of codes times powers, taken back to power 0."""
    if not len(a):
        return np.zeros(0, np.uint64)
    base = powers(1)
    up = np.concatenate([[U64(1)], np.cumprod(np.full(len(codes), base, dtype=np.uint64))])
    sums = np.concatenate([[U64(0)], np.cumsum(mix(codes + U64(1)) * up[:-1])])
    down = pow(int(base), -1, 1 << 64)
    inverse = np.concatenate([[U64(1)], np.cumprod(np.full(int(a.max()) or 1, U64(down), dtype=np.uint64))])
    return mix((sums[b] - sums[a]) * inverse[a] + (b - a).astype(np.uint64))


def _shards(units: Units, find: Callable):
    """Rows sorted by anchor, taken up to ``SHARD_UNITS`` units at a time without parting an anchor."""

    def table(rows):
        texts = [r[3] for r in rows]
        doc, start = np.array([r[1] for r in rows], np.int64), np.array([r[2] for r in rows], np.int64)
        seg, a, b = find(texts, doc, start)
        k1 = np.array([r[4] for r in rows], np.int64)
        return pa.RecordBatch.from_arrays([pa.array(doc[seg]), pa.array(k1[seg]), pa.array(start[seg] + a), pa.array(start[seg] + b)],
                                          names=["doc", "k1", "a", "b"])

    def run(batches):
        rows, held, last = [], 0, None
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("anchor", "doc", "start", "text", "k1", "n")), strict=True):
                if held >= SHARD_UNITS and row[0] != last:
                    yield table(rows)
                    rows, held = [], 0
                rows.append(row)
                held += row[5]
                last = row[0]
        if rows:
            yield table(rows)

    return run


def _windows(units: Units):
    """Single windows of segments, by two 64-bit hashes of their own."""

    def run(batches):
        for batch in batches:
            for part in byte_slices(batch, batch.schema.get_field_index("text"), SLICE_BYTES):
                codes, bounds, _ = units.read(part.column(part.schema.get_field_index("text")).cast(pa.string(), safe=False) if units.words
                                              else part.column(part.schema.get_field_index("text")))
                n = np.diff(bounds) - units.width + 1
                seg = np.repeat(np.arange(part.num_rows), n)
                at = np.arange(len(seg)) - np.repeat(np.cumsum(n) - n, n)
                a = bounds[seg] + at
                w1 = segment_hashes(codes, a, a + units.width)
                w2 = segment_hashes(mix(codes ^ U64(0x5851F42D4C957F2D)), a, a + units.width)
                column = {c: np.asarray(part.column(part.schema.get_field_index(c))) for c in ("doc", "k1", "start")}
                yield pa.RecordBatch.from_arrays([_signed(w1), _signed(w2), pa.array(column["doc"][seg]), pa.array(column["k1"][seg]),
                                                  pa.array(column["start"][seg] + at)], names=["w1", "w2", "doc", "k1", "start"])

    return run


def place(doc: str = "doc", start: str = "start") -> Column:
    """(doc, start) as one ordered number."""
    return (F.col(doc).cast("decimal(38,0)") * F.lit(1 << START_BITS).cast("decimal(38,0)") + F.col(start)).cast("decimal(38,0)")


def repeated_spans(docs: DataFrame, units: Units, find: Callable, id_col: str = "doc_id", text_col: str = "text",
                   hot: int = HOT) -> tuple[DataFrame, DataFrame]:
    """(texts, spans): texts has doc, k1, n and copy (an exact copy of an earlier id, long
    enough to be removed whole); spans has doc, k1 and spans (array of from, to)."""
    prepare(docs.sparkSession)
    keyed = _keyed(docs, id_col, text_col)
    texts = store(keyed.select("doc", "text", "k1", "k2").mapInArrow(tidy(_anchors(units)), "doc long, k1 long, k2 long, n long, anchors array<long>"))
    first = texts.groupBy("k1", "k2").agg(F.min("doc").alias("first"))
    marked = store(texts.select("doc", "k1", "k2", "n").join(first, ["k1", "k2"], "left")
                   .select("doc", "k1", "n", (F.coalesce(F.col("doc") > F.col("first"), F.lit(False)) & (F.col("n") >= units.width)).alias("copy")))

    each = texts.where("doc is not null").select("doc", "k1", F.posexplode("anchors").alias("idx", "anchor"))
    repeated = store(each.groupBy("anchor").agg(F.count("*").alias("c")).where("c > 1").select("anchor"))
    wanted = each.join(repeated, "anchor").groupBy("doc", "k1").agg(F.collect_list("idx").alias("idx"))
    wanted = store(wanted.join(marked.where("not copy").select("doc", "k1").distinct(), ["doc", "k1"], "left_semi"))
    release(texts, repeated)
    segments = store(keyed.select("doc", "text", "k1").join(wanted, ["doc", "k1"]).select("doc", "text", "k1", "idx")
                     .mapInArrow(tidy(_segments(units)), "anchor long, content long, doc long, k1 long, start long, n long, text binary"))

    contents = store(segments.groupBy("anchor", "content").agg(F.min(place()).alias("first"), F.count("*").alias("c")))
    later = (segments.drop("text").join(contents.where("c > 1"), ["anchor", "content"]).where(place() > F.col("first"))
             .select("doc", "k1", F.col("start").alias("a"), (F.col("start") + F.col("n")).alias("b")))
    shared = contents.groupBy("anchor").agg(F.count("*").alias("kinds")).where("kinds > 1")
    leads = (segments.where("text is not null").join(contents.join(shared, "anchor").select("anchor", "content", "first", "kinds"), ["anchor", "content"])
             .where(place() == F.col("first")))
    near = (leads.where(F.col("kinds") <= hot).select("anchor", "content", "doc", "start", "text", "k1", "n").repartition("anchor")
            .sortWithinPartitions("anchor", "doc", "start").mapInArrow(tidy(_shards(units, find)), "doc long, k1 long, a long, b long"))
    hot_leads = store(leads.where(F.col("kinds") > hot).select("doc", "k1", "start", "text"))
    spans = later.union(near)
    if not hot_leads.isEmpty():
        single = store(hot_leads.mapInArrow(tidy(_windows(units)), "w1 long, w2 long, doc long, k1 long, start long"))
        earliest = single.groupBy("w1", "w2").agg(F.min(place()).alias("first"), F.count("*").alias("c")).where("c > 1")
        spans = spans.union(single.join(earliest, ["w1", "w2"]).where(place() > F.col("first"))
                            .select("doc", "k1", F.col("start").alias("a"), (F.col("start") + units.width).alias("b")))
    found = store(spans.groupBy("doc", "k1").agg(F.collect_set(F.struct("a", "b")).alias("spans")))
    release(wanted, segments, contents, hot_leads)
    return marked, found


def with_spans(docs: DataFrame, marked: DataFrame, spans: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``docs`` with two more columns: the row's spans (null: none) and whether it is a copy removed whole."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    flags = marked.where("copy").select("doc", "k1", "copy").distinct()
    found = spans.join(flags, ["doc", "k1"], "full").select(
        "doc", "k1", F.transform("spans", lambda s: F.array(s["a"], s["b"])).alias("_segmint_spans"), F.coalesce("copy", F.lit(False)).alias("_segmint_copy"))
    keyed = docs.withColumn("_segmint_id", F.col(id_col).cast("long")).withColumn("_segmint_key", F.xxhash64(text))
    joined = keyed.join(found, (F.col("_segmint_id") == found["doc"]) & (F.col("_segmint_key") == found["k1"]), "left")
    return joined.select(*[keyed[c] for c in docs.columns], "_segmint_spans", "_segmint_copy")


def without_spans(docs: DataFrame, marked: DataFrame, spans: DataFrame, units: Units, id_col: str, text_col: str, finish: Callable, schema: str) -> DataFrame:
    """``finish(n, removed, kept bytes, runs)`` of every row of ``docs``, as columns of ``schema`` after doc_id."""
    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    names = [c.split()[0] for c in schema.split(",")]

    def run(batches):
        for batch in batches:
            for part in byte_slices(batch, 1, SLICE_BYTES):
                rows = [finish(*r) for r in units.kept(part.column(1), part.column(2).to_pylist(), part.column(3).to_pylist())]
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(c) for c in zip(*rows, strict=True))], names=["doc_id", *names])

    return with_spans(plain, marked, spans, "doc_id", "text").mapInArrow(tidy(run), f"doc_id long, {schema}")
