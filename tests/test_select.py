"""k selection: candidate rule, bisection and linear search with a stub scorer."""

import pytest

from segmint.operators import select as S
from segmint.operators.train import ScoredModel


class Stub:
    """BIC and diameter from fixed functions of k; records every fit."""

    def __init__(self, bic, diam=lambda k: 100.0 / k):
        self.bic, self.diam, self.calls = bic, diam, []

    def __call__(self, k):
        self.calls.append(k)
        return ScoredModel(k=k, wssse=1000.0 / k, avg_diameter=self.diam(k), model=None, n=100, q=2, bic=self.bic(k))


def test_candidate_ks():
    assert S.candidate_ks(6) == [2, 4]
    assert S.candidate_ks(3) == [2]
    assert S.candidate_ks(1) == []
    assert S.candidate_ks(100_000) == [2 ** i for i in range(1, 17)]
    assert S.candidate_ks(99_999)[-1] == 65_536  # the cap only applies above the limit
    assert S.candidate_ks(100_001) == [16, 32, 64, 128, 256, 512]


def test_midpoint_rounds_half_up():
    assert S.next_binsearch_value(2, 5) == 4  # 2 + round(1.5) = 4
    assert S.next_binsearch_value(2, 4) == 3
    assert S.next_binsearch_value(16, 32) == 24
    assert S.next_binsearch_value(3, 4) == 4


def _ref_binsearch(bic, k1, b1, k2, b2):
    """Plain transcription of the bisection rule, for comparison."""
    while True:
        if k2 <= k1:
            return k1, b1
        if k2 - k1 == 1:
            return (k1, b1) if b1 < b2 else (k2, b2)
        mid = k1 + int((k2 - k1) / 2.0 + 0.5)
        b = bic(mid)
        if abs(b1 - b) > abs(b - b2):
            k2, b2 = mid, b
        else:
            k1, b1 = mid, b


@pytest.mark.parametrize("shape", ["peak", "falling", "rising", "flat"])
def test_binsearch_bic_matches_rule(shape):
    f = {
        "peak": lambda k: -((k - 11) ** 2) * 1.0,
        "falling": lambda k: -3.0 * k,
        "rising": lambda k: 2.0 * k + 0.5 * (k % 3),
        "flat": lambda k: 5.0,
    }[shape]
    stub = Stub(f)
    got = S.binsearch_bic(stub, (4, f(4)), (32, f(32)))
    assert got == _ref_binsearch(f, 4, f(4), 32, f(32))
    assert len(stub.calls) <= 6  # logarithmic in the range


def test_binsearch_final_rules():
    stub = Stub(lambda k: {3: 1.0, 4: 2.0}[k])
    assert S.binsearch_bic(stub, (3, 1.0), (4, 2.0), final="lower") == (3, 1.0)
    assert S.binsearch_bic(stub, (3, 1.0), (4, 2.0), final="higher") == (4, 2.0)
    assert S.binsearch_bic(stub, (4, 2.0), (4, 2.0)) == (4, 2.0)
    assert stub.calls == []


def test_binsearch_diameter_takes_upper_when_adjacent():
    d = lambda k: 100.0 / k
    stub = Stub(lambda k: 0.0, d)
    k, _ = S.binsearch_diameter(stub, (2, d(2)), (16, d(16)))
    # halves: d1 - d > d - d2 → left; steep at small k, so the search walks left
    assert 2 < k <= 16


def test_linear_bic_highest_earliest():
    f = lambda k: -abs(k - 7) * 1.0
    stub = Stub(f)
    assert S.linear_bic(stub, 2, 12) == (6, -1.0)  # candidates 2,4,6,8,10,12: 6 and 8 tie, earliest wins
    assert stub.calls == [2, 4, 6, 8, 10, 12]


def test_memo_scorer_fits_once():
    inner = Stub(lambda k: float(k))
    memo = S.MemoScorer(inner)
    memo(4), memo(4), memo(8)
    assert inner.calls == [4, 8]


def test_select_k_with_stub(spark):
    f = lambda k: -((k - 11) ** 2) * 1.0
    stub = S.MemoScorer(Stub(f))
    best = S.select_k(spark.range(1).toDF("features"), ks=[2, 4, 8, 16, 32], scorer=stub)
    # largest |ΔBIC| among consecutive sweep points is (16, 32); bisection from there
    lo, hi = (16, f(16)), (32, f(32))
    assert best.k == _ref_binsearch(f, *lo, *hi)[0]
    linear = S.select_k(spark.range(1).toDF("features"), ks=[2, 4, 8, 16, 32], scorer=stub, strategy="linear")
    assert linear.k == 16


def test_candidate_frame_matches_rule(spark):
    for n in (1, 3, 6, 150, 1000):
        got = sorted(r["k"] for r in S.candidate_ks_frame(spark.range(n)).collect())
        assert got == S.candidate_ks(n)


def test_random_tables_match_rules():
    import random

    rnd = random.Random(7)
    for _ in range(300):
        table = {k: float(rnd.randint(-20, 20)) for k in range(2, 70)}
        k1 = rnd.randint(2, 40)
        k2 = rnd.randint(k1, 69)
        f = table.__getitem__
        assert S.binsearch_bic(Stub(f), (k1, f(k1)), (k2, f(k2))) == _ref_binsearch(f, k1, f(k1), k2, f(k2))
        # diameter rule, transcribed
        a, da, b, db = k1, f(k1), k2, f(k2)
        while True:
            if b <= a:
                want = (a, da)
                break
            if b - a == 1:
                want = (b, db)
                break
            m = a + int((b - a) / 2.0 + 0.5)
            d = f(m)
            if (da - d) > (d - db):
                b, db = m, d
            else:
                a, da = m, d
        assert S.binsearch_diameter(Stub(lambda k: 0.0, f), (k1, f(k1)), (k2, f(k2))) == want
        cands = list(range(k1, k2, 2)) + [k2]
        best = sorted([(k, f(k)) for k in cands], key=lambda t: -t[1])[0]
        assert S.linear_bic(Stub(f), k1, k2) == best


def test_lookahead_bisection_same_answer():
    import random

    rnd = random.Random(11)
    for _ in range(60):
        table = {k: float(rnd.randint(-20, 20)) for k in range(2, 70)}
        f = table.__getitem__
        k1 = rnd.randint(2, 30)
        k2 = rnd.randint(k1, 69)
        seq = S.binsearch_bic(S.MemoScorer(Stub(f)), (k1, f(k1)), (k2, f(k2)))
        par = S.binsearch_bic(S.MemoScorer(Stub(f)), (k1, f(k1)), (k2, f(k2)), parallelism=3)
        assert seq == par
        seq_d = S.binsearch_diameter(S.MemoScorer(Stub(lambda k: 0.0, f)), (k1, f(k1)), (k2, f(k2)))
        par_d = S.binsearch_diameter(S.MemoScorer(Stub(lambda k: 0.0, f)), (k1, f(k1)), (k2, f(k2)), parallelism=3)
        assert seq_d == par_d


def test_select_k_diameter_strategy_with_stub(spark):
    d = lambda k: 100.0 / k
    stub = S.MemoScorer(Stub(lambda k: -((k - 11) ** 2) * 1.0, d))
    best = S.select_k(spark.range(1).toDF("features"), ks=[2, 4, 8, 16, 32], scorer=stub, strategy="diameter")
    # range from the largest BIC gap (16, 32), then the diameter bisection inside it
    want, _ = S.binsearch_diameter(Stub(lambda k: 0.0, d), (16, d(16)), (32, d(32)))
    assert best.k == want
    with pytest.raises(ValueError):
        S.select_k(spark.range(1).toDF("features"), ks=[2, 4], scorer=stub, strategy="nope")
