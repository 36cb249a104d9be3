"""The n-gram join where many sets hang together by chance fragments, and where fragments are common."""

import random

import pytest

import brute
from segmint.llm import ngram_join


def chained(n, rng):
    """Texts of five passages each, of which the next text has four: two thirds alike, all in one chain."""
    passages = [" ".join(f"w{rng.randrange(400)}" for _ in range(20)) for _ in range(n + 4)]
    return [" ".join(passages[i : i + 5]) for i in range(n)]


def groups(spark, texts, *args, **kw):
    rows = list(enumerate(texts))
    got = ngram_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), *args, **kw)
    return {r.doc_id: r.component_id for r in got.collect()}, brute.jaccard_groups(rows, *args[0], args[1])


def test_sets_in_a_chain_are_not_compared_with_all_of_it(spark, monkeypatch):
    rng = random.Random(11)
    texts = chained(150, rng)
    texts += [f"{t} more" for t in texts[::30]]  # near copies
    sent, rest = [], ngram_join.rest_links

    def counted(members, *args, **kw):
        sent.append(members.select("k").distinct().count())
        return rest(members, *args, **kw)

    monkeypatch.setattr(ngram_join, "rest_links", counted)
    got, want = groups(spark, texts, (80, 100), 5, finer=0.25)
    assert got == want and len(set(got.values())) == 150
    assert sum(sent) <= 10  # sets that blocks are made of; with the groups of all fragments: 155


# 0: every open fragment takes the way of the common ones
@pytest.mark.parametrize("few,similar,ngram,finer", [(0, (80, 100), 5, 0.25), (32, (80, 100), 5, 0.25), (2, (60, 100), 3, 0.5), (32, (90, 100), 3, 0.5)])
def test_links_of_rare_and_common_fragments(spark, monkeypatch, few, similar, ngram, finer):
    monkeypatch.setattr(ngram_join, "FEW", few, raising=False)
    rng = random.Random(f"{few} {similar}")
    common = [" ".join(f"c{rng.randrange(90)}" for _ in range(30)) for _ in range(4)]
    texts = chained(12, rng)
    for c in common:  # texts that share most of a common passage, of all sizes, and their near copies
        for _ in range(12):
            words = c.split() + [f"u{rng.randrange(300)}" for _ in range(rng.randrange(12))]
            texts.append(" ".join(words))
            for _ in range(rng.randrange(3)):
                words = [*words[: (at := rng.randrange(len(words)))], f"x{rng.randrange(9)}", *words[at + 1 :]]
                texts.append(" ".join(words))
    got, want = groups(spark, texts + texts[:5] + ["", "one", "one"], similar, ngram, finer=finer)
    assert got == want
    assert 5 < len(set(got.values())) < len(texts) - 10
