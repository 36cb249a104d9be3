"""Repeated words and bytes, n-gram groups: equal to brute force on every row."""

import random
from collections import Counter

import numpy as np
import pytest

import brute
from awkward import docs, no_docs  # noqa: F401
from segmint.llm import fm_index, suffix_buckets
from segmint.llm.ngram_join import block_links, first_of_each, fragment_keys, jaccard_components, most_different, partial_overlaps, similar_pairs, slices_of

import pandas as pd


@pytest.mark.parametrize("hot", [None, 1])  # 1: every shared anchor takes the way of the hot ones
def test_repeated_words(docs, hot):
    want = brute.repeats(brute.documents(), 20, words=True)
    got = Counter((r.doc_id, r.n_words, r.n_removed, r.kept) for r in fm_index.dedup_words(docs, hot=hot).collect())
    assert got == Counter((i, want[i, t][0], want[i, t][1], want[i, t][3]) for i, t in brute.documents())


@pytest.mark.parametrize("hot", [None, 1])
def test_repeated_bytes(docs, hot):
    want = brute.repeats(brute.documents(), 100, words=False)
    got = Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffix_buckets.dedup_bytes(docs, hot=hot).collect())
    assert got == Counter((i, *want[i, t]) for i, t in brute.documents())


def test_empty_tables(no_docs):
    assert fm_index.dedup_words(no_docs).count() == suffix_buckets.dedup_bytes(no_docs).count() == jaccard_components(no_docs).count() == 0
    assert fm_index.cut_repeats(no_docs).columns == no_docs.columns


def test_cut_repeats_keeps_columns(docs):
    got = fm_index.cut_repeats(docs)
    assert got.columns == docs.columns and got.schema == docs.schema
    want = brute.repeats(brute.documents(), 20, words=True)
    rows = [(i, t) for i, t in brute.documents() if not want[i, t][0] or want[i, t][1] < want[i, t][0]]
    expect = Counter((i, want[i, t][3] if want[i, t][1] else t) for i, t in rows)
    assert Counter((r.doc_id, r.text) for r in got.collect()) == expect
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in got.collect())


@pytest.mark.parametrize("module,words", [(fm_index, True), (suffix_buckets, False)])
def test_shard_search_against_brute_force(module, words):
    rng = random.Random(3)
    for width in (3, 8, 20):
        texts = [[rng.choice("abc") for _ in range(rng.randint(width, 60))] for _ in range(40)]
        raw = [(" ".join(t) if words else "".join(t)).encode() for t in texts]
        doc, start = np.array([rng.randrange(9) for _ in texts]), np.array([rng.randrange(1000) * 100 for _ in texts])
        first = {}
        for t, d, s in zip(texts, doc, start):
            for k in range(len(t) - width + 1):
                w = tuple(t[k : k + width])
                first[w] = min(first.get(w, (d, s + k)), (d, s + k))
        want = [{k + j for k in range(len(t) - width + 1) if first[tuple(t[k : k + width])] < (d, s + k) for j in range(width)} for t, d, s in zip(texts, doc, start)]
        got = [set() for _ in texts]
        for seg, a, b in zip(*module.find_repeats(raw, doc, start, width)):
            got[seg] |= set(range(a, b))
        assert got == want


def test_buckets_are_refined_to_the_order_of_suffixes():
    """Few symbols, empty and equal segments, buckets of every depth, one round and several."""
    rng = random.Random(1)
    for _ in range(200):
        segments = [[rng.randint(1, rng.choice([1, 2, 3])) for _ in range(rng.randint(0, 30))] for _ in range(rng.randint(1, 8))]
        text = [x for s in segments for x in [*s, 0]]
        index = suffix_buckets.SuffixBuckets(np.array(text, dtype=np.uint16), rng.choice([1, 2, 3, 7]), rng.choice([1, 2, 5]))
        suffix = lambda i: text[i : text.index(0, i) + 1]
        order = index.order.tolist()
        assert sorted(order) == list(range(len(text)))
        assert [suffix(i) for i in order] == sorted(map(suffix, order))
        assert len(set(index.pointer.tolist())) == len({tuple(suffix(i)) for i in order})


@pytest.mark.parametrize("num,den,n", [(90, 100, 3), (80, 100, 5), (50, 100, 2)])
def test_jaccard_groups(docs, num, den, n):
    want = brute.jaccard_groups(brute.documents(), num, den, n)
    sizes = {(i, t): len(brute.shingles(t, n)) for i, t in brute.documents()}
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_components(docs, (num, den), n).collect())
    assert got == Counter((i, sizes[i, t], want.get(i)) for i, t in brute.documents())


def test_equal_fragments_are_enough_of_them():
    """Random similar pairs share as many keys as the filter asks of each."""
    rng = np.random.default_rng(1)
    for similar in ((90, 100), (80, 100), (50, 100)):
        for n in (1, 2, 5, 9, 10, 19, 30, 80, 333, 1200):
            for _ in range(20):
                x = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
                drop = rng.integers(0, most_different(len(x), similar) + 1)
                y = np.unique(np.concatenate([x[drop // 2 :], rng.integers(0, 2**63, drop - drop // 2, dtype=np.uint64)]))
                same = len(np.intersect1d(x, y))
                if not len(y) or same * similar[1] < (len(x) + len(y) - same) * similar[0]:
                    continue
                met = max(len(np.intersect1d(a, b)) - max(p, q) for a, p in fragment_keys(x, similar) for b, q in fragment_keys(y, similar))
                assert met >= 0


def test_block_links_join_what_is_similar():
    rng = np.random.default_rng(2)
    base = rng.integers(0, 2**62, 100)
    sets = [np.unique(np.concatenate([base[k:], rng.integers(0, 2**62, k)])) for k in (0, 2, 4, 40, 41)]
    pdf = pd.DataFrame({"k": range(5), "n": [len(s) for s in sets], "component": range(5), "side": [0, 0, 1, 1, 1], "grams": [s.tolist() for s in sets]})
    assert brute.groups(block_links(pdf), range(5)) == {0: 0, 1: 0, 2: 0, 3: 3, 4: 4}
    cut = pdf.assign(grams=[[x.view(np.int64) for x in slices_of(s.astype(np.uint64) << np.uint64(1))] for s in sets]).explode("grams")
    assert len(cut) > len(pdf) and brute.groups(block_links(cut), range(5)) == {0: 0, 1: 0, 2: 0, 3: 3, 4: 4}


def test_partial_overlaps_sum_to_the_whole(spark):
    """Each fragment counts what two sets share in its range of the n-gram order; only the sum decides, at the threshold too."""
    rng = np.random.default_rng(7)
    new = lambda n: np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
    base = new(300)
    sets = [base, *(np.unique(np.concatenate([base[k:], new(k)])) for k in (1, 15, 16, 17, 60)), base[:270], base[:269], base[:40], new(300), new(1), base[:1], base[:1].copy()]
    rows = [(k, len(s), [len(x) for x in slices_of(s)], f, x.view(np.int64).tolist()) for k, s in enumerate(sets) for f, x in enumerate(slices_of(s))]
    table = spark.createDataFrame(rows, "k long, n long, sizes array<int>, fragment int, grams array<long>").repartition(5)
    every = [(a, b) for a in range(len(sets)) for b in range(a + 1, len(sets))]
    pairs = spark.createDataFrame(every, "a long, b long")
    got = {(r.a, r.b, r.fragment): r.partial for r in partial_overlaps(pairs, table).collect()}
    assert got == {(a, b, f): len(np.intersect1d(x, y)) for a, b in every for f, (x, y) in enumerate(zip(slices_of(sets[a]), slices_of(sets[b])))}
    for num, den in ((90, 100), (80, 100), (1, 10)):
        same = {(a, b): len(np.intersect1d(sets[a], sets[b])) for a, b in every}
        want = {(a, b) for (a, b), s in same.items() if s * den >= (len(sets[a]) + len(sets[b]) - s) * num}
        assert {(r.a, r.b) for r in similar_pairs(pairs, table, (num, den)).collect()} == want and (want or num > den)


def test_first_of_each_keeps_one_row(docs):
    got = first_of_each(docs, jaccard_components(docs))
    want = brute.jaccard_groups(brute.documents())
    assert sorted(r.doc_id for r in got.collect() if r.doc_id is not None) == sorted(i for i, c in want.items() if i == c)
    assert got.where("doc_id is null").count() == 2 and got.columns == docs.columns
