"""Packing and sub-word coding: ids as the public libraries give them, sequences without gaps."""

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

import brute
from awkward import docs, no_docs  # noqa: F401
from segmint.llm.packing import Bins, WordEncoder, pack_documents
from segmint.llm.pieces import PieceCoder, encode_pieces

WORDS, PIECES = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("piece_bpe_32k.model")
TOK, SP = Tokenizer.from_file(WORDS), sentencepiece.SentencePieceProcessor(model_file=PIECES)
ENC, CODER = WordEncoder(WORDS), PieceCoder(PIECES)
TEXTS = st.text(st.one_of(st.characters(codec="utf-8"), st.sampled_from("  \n\t.,'sİßéñ▁<|0１½\u0301\x1c\x85\u2028日")), max_size=60)


@settings(max_examples=400, deadline=None)
@given(st.lists(TEXTS, max_size=5))
def test_word_ids_equal_the_library(texts):
    assert [np.frombuffer(b, "<u4").tolist() for b in ENC.encode(pa.array(texts, pa.string()))] == [TOK.encode(t, add_special_tokens=False).ids for t in texts]


@settings(max_examples=400, deadline=None)
@given(st.lists(TEXTS, max_size=5))
def test_piece_ids_equal_the_library(texts):
    ids, plain = CODER.code_all(pa.array(texts, pa.string()))
    for t, i, p in zip(texts, ids, plain, strict=True):
        want = SP.encode(t)
        assert i == ",".join(map(str, want)) and p == SP.decode(want) == CODER.decode(want)


def test_special_tokens_in_a_text():
    for t in ("a <|endoftext|> b", "x<|startoftext|>y", "<s> a</s><0x0A>", "▁▁ a▁b  c ", " lead", "trail ", "   "):
        assert np.frombuffer(ENC.encode(pa.array([t]))[0], "<u4").tolist() == TOK.encode(t, add_special_tokens=False).ids
        assert CODER.code(t)[0] == ",".join(map(str, SP.encode(t)))


def test_coding_of_the_table(docs, no_docs):
    got = Counter(tuple(r) for r in encode_pieces(docs, PIECES, digest=True).collect())
    want = Counter((i, len(SP.encode(t or "")), hashlib.sha256(",".join(map(str, SP.encode(t or ""))).encode()).hexdigest(),
                    hashlib.sha256(SP.decode(SP.encode(t or "")).encode()).hexdigest()) for i, t in brute.documents())
    assert got == want
    whole = encode_pieces(docs, PIECES).where("doc_id = 63").first()
    assert whole.ids == SP.encode("日本 語 " * 40) and whole.decoded == SP.decode(whole.ids)
    assert encode_pieces(no_docs, PIECES).count() == 0


def test_packing_of_the_table(docs, no_docs):
    rows = pack_documents(docs, WORDS, max_tokens=64, open_bins=8, with_ids=True).collect()
    want = Counter()
    for i, t in brute.documents():
        ids = TOK.encode(t or "", add_special_tokens=False).ids + [0]
        for k in range(0, len(ids), 64):
            part = np.array(ids[k : k + 64], "<u4").tobytes()
            want[i, k // 64, k, len(part) // 4, zlib.crc32(part), part] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32, bytes(r.ids)) for r in rows) == want
    places = defaultdict(list)
    for r in rows:
        places[r.sequence_id].append((r.offset, r.length))
    for p in places.values():
        at = 0
        for o, n in sorted(p):
            assert o == at
            at += n
        assert at <= 64
    total = sum(r.length for r in rows)
    assert len(places) <= 1.1 * (total / 64) + 8
    assert pack_documents(no_docs, WORDS).count() == 0


def test_bins_take_the_best_fit_and_close_the_fullest():
    b = Bins(10, 2)
    assert b.add(6) == (0, 0)      # 4 free
    assert b.add(7) == (1, 0)      # 3 free
    assert b.add(3) == (1, 7)      # the fuller of the two that fit; full now
    assert b.closed == [1]
    assert b.add(9) == (2, 0)
    assert b.add(5) == (3, 0) and b.closed == [1, 2]  # no fit, two open: the fullest goes
    assert b.add(4) == (0, 6) and b.closed == [1, 2, 0]


def test_caches_are_bounded_in_bytes():
    """A million different words: the cache holds what it may, and what comes back is found."""
    from segmint.llm.common import ByteCache

    cache = ByteCache(1 << 20)
    for k in range(200_000):
        for _ in range(2):
            if cache.find(f"word{k}") is None:
                cache.put(f"word{k}", b"1234")
        assert cache.find("often") or cache.put("often", b"x") is None
    held = sum(ByteCache.ENTRY + 4 * len(w) + len(v) for part in (cache.new, cache.old) for w, v in part.items())
    assert held <= (1 << 20) + 1000 and cache.find("often") == b"x"
    once = ByteCache(1 << 20)
    for k in range(1000):
        once.put(f"w{k}", b"1")
    assert len(once.new) < 20  # marks of different words rarely meet


def test_slices_hold_their_bytes():
    from segmint.llm.common import byte_slices

    sizes = [5, 5, 0, 30, 1, 1, 9, 20, 0]
    batch = pa.RecordBatch.from_pylist([{"i": k, "t": "x" * n if n else None} for k, n in enumerate(sizes)])
    cut = [s.column(0).to_pylist() for s in byte_slices(batch, 1, 10)]
    assert [k for part in cut for k in part] == list(range(9))
    assert all(len(part) == 1 or sum(sizes[k] for k in part) <= 10 for part in cut)


def test_many_long_texts_in_bounded_memory(spark):
    """1,000 texts of 20,000 words, 110 MB, in one task: the worker grows by less than 500 MB."""
    import pandas as pd
    from pyspark.sql import functions as F

    words = F.transform(F.sequence(F.lit(1), F.lit(20_000)), lambda k: F.conv(F.xxhash64("id", k % 7000).bitwiseAND(0xFFFFF).cast("string"), 10, 36))
    texts = spark.range(0, 1000, 1, 1).select(F.col("id").alias("doc_id"), F.concat_ws(" ", words).alias("text"))

    def peak(frames):
        import resource

        for f in frames:
            yield pd.DataFrame({"mb": [resource.getrusage(resource.RUSAGE_SELF).ru_maxrss // 1024], "n": [len(f)]})

    before = spark.range(1).mapInPandas(peak, "mb long, n long").first().mb
    out = pack_documents(texts, WORDS)
    assert out.agg(F.countDistinct("doc_id")).first()[0] == 1000
    after = spark.range(8).repartition(8).mapInPandas(peak, "mb long, n long").agg(F.max("mb")).first()[0]
    assert after - before < 500, (before, after)
