"""Curve operators on small inline curves against plain-Python versions of the rules."""

import math

import pytest

from segmint.operators import curve as C

# Edge runs: one point, two points, equal gaps (ties), all slopes > -1, rising values, an elbow.
RUNS = {
    "one": [(2, 10.0)],
    "two": [(2, 10.0), (4, 6.0)],
    "ties": [(2, 9.0), (4, 7.0), (6, 5.0), (8, 3.0)],
    "gentle": [(2, 3.0), (4, 2.9), (8, 2.8), (16, 2.7)],
    "rising": [(2, 1.0), (4, 2.0), (8, 4.0), (16, 9.0)],
    "elbow": [(2, 40.0), (4, 20.0), (8, 8.0), (16, 6.0), (32, 5.0)],
}


@pytest.fixture(scope="module")
def curve(spark):
    rows = [(r, k, v, v * 10.0, -v) for r, pts in RUNS.items() for k, v in pts]
    return spark.createDataFrame(rows, "run_id string, k int, avg_diameter double, wssse double, bic double")


def pairs(pts):
    return list(zip(pts, pts[1:]))


def ref_slopes(pts):
    return [(k1, 0.0 if k2 == k1 else (v2 - v1) / (k2 - k1), v1) for (k1, v1), (k2, v2) in pairs(pts)]


def ref_range_slope(pts):
    sl = ref_slopes(pts)
    if len(sl) <= 1:
        return (sl[0] + sl[0]) if sl else None
    ps = pairs(sl)
    match = [(a, b) for a, b in ps if a[1] <= -1 and b[1] >= -1]
    a, b = (match or ps)[0]
    return a + b


def ref_drop(pts):
    best = (0, 0.0)
    for (k1, v1), (k2, v2) in pairs(pts):
        if v1 - v2 > best[1]:
            best = (k2, v1 - v2)
    return best


def ref_ratio(pts):
    diffs = [(k2, v1 / v2) for (k1, v1), (k2, v2) in pairs(pts)]
    best = diffs[0]
    for d in diffs[1:]:
        if d[1] < best[1]:
            best = d
    return best


def ref_elbow(pts):
    if len(pts) < 2:
        return None
    (x1, y1), (x2, y2) = pts[0], pts[-1]
    mid = (x1 + abs(x2 - x1) / 2.0, y1 + abs(y2 - y1) / 2.0)
    dist = lambda p: math.sqrt((p[0] - mid[0]) ** 2 + (p[1] - mid[1]) ** 2)
    elbow = pts[1]
    for p in list(reversed(pts[1:]))[1:]:
        if dist(p) < dist(elbow):
            elbow = p
    return elbow


def ref_gap(pts):
    cands = [((k1, v1), (k2, v2), abs(v2 - v1)) for (k1, v1), (k2, v2) in pairs(pts)]
    return sorted(cands, key=lambda c: -c[2])[0] if cands else None  # stable: earliest on ties


def _by_run(df, cols):
    return {r["run_id"]: tuple(r[c] for c in cols) for r in df.collect()}


def test_successive_pairs_count(curve):
    got = C.successive_pairs(curve, "avg_diameter").groupBy("run_id").count().collect()
    counts = {r["run_id"]: r["count"] for r in got}
    for run, pts in RUNS.items():
        assert counts.get(run, 0) == len(pts) - 1


def test_slopes_and_filter(curve):
    got = {(r["run_id"], r["k"]): (r["slope"], r["value"]) for r in C.k_slopes(curve).collect()}
    for run, pts in RUNS.items():
        for k, s, v in ref_slopes(pts):
            assert got[(run, k)] == pytest.approx((s, v))
    kept = {(r["run_id"], r["k"]) for r in C.filter_slopes(C.k_slopes(curve)).collect()}
    assert kept == {(run, k) for run, pts in RUNS.items() for k, s, _ in ref_slopes(pts) if s <= -1}


def test_best_k_range_slope(curve):
    got = _by_run(C.best_k_range_slope(curve), ["k1", "s1", "d1", "k2", "s2", "d2"])
    for run, pts in RUNS.items():
        ref = ref_range_slope(pts)
        if ref is None:
            assert got[run] == (None,) * 6
        else:
            assert got[run] == pytest.approx(ref)


def test_drop_ratio_elbow_gap(curve):
    drops = _by_run(C.best_k_diameter_drop(curve), ["k", "drop"])
    ratios = _by_run(C.best_k_error_ratio(curve), ["k", "ratio"])
    elbows = _by_run(C.elbow_point(curve), ["k", "avg_diameter"])
    gaps = _by_run(C.max_bic_gap(curve), ["k1", "k2", "gap"])
    for run, pts in RUNS.items():
        assert drops[run] == pytest.approx(ref_drop(pts))
        if len(pts) > 1:
            assert ratios[run] == pytest.approx(ref_ratio([(k, v * 10.0) for k, v in pts]))
            g = ref_gap([(k, -v) for k, v in pts])
            assert gaps[run] == pytest.approx((g[0][0], g[1][0], g[2]))
        else:
            assert run not in ratios and run not in gaps
        e = ref_elbow(pts)
        assert elbows.get(run) == (None if e is None else pytest.approx(e))


def test_scale_points_and_first_k(curve):
    got = {(r["run_id"], r["k"]): (r["x"], r["y"]) for r in C.scale_points(curve, "wssse").collect()}
    for run, pts in RUNS.items():
        xs = [k for k, _ in pts]
        ys = [v * 10.0 for _, v in pts]
        for k, y in zip(xs, ys):
            if max(ys) - min(ys) > max(xs) - min(xs):
                want = (k * max(ys) / max(xs), y)
            else:
                want = (float(k), y * max(xs) / max(ys))
            assert got[(run, k)] == pytest.approx(want)
    firsts = _by_run(C.first_k(curve), ["k"])
    assert firsts == {run: (pts[0][0],) for run, pts in RUNS.items()}


def test_between_model_statistics(spark):
    rows = [("r", 2, 0, 4.0), ("r", 2, 1, 2.0), ("r", 4, 0, 1.0), ("r", 4, 1, 3.0), ("r", 4, 3, 2.0), ("s", 2, 0, 5.0)]
    d = spark.createDataFrame(rows, "run_id string, k int, cluster int, diameter double")
    obs = {(r["run_id"], r["k"]): (r["mean_diameter"], r["n_clusters"]) for r in C.diameter_observations(d).collect()}
    assert obs == {("r", 2): (3.0, 2), ("r", 4): (1.5, 3), ("s", 2): (2.5, 1)}  # divides by k, not by clusters present
    om = _by_run(C.overall_mean(C.diameter_observations(d)), ["overall_mean"])
    assert om == {"r": (2.25,), "s": (2.5,)}
    ssd = _by_run(C.between_group_ssd(C.diameter_observations(d)), ["between_group_ssd"])
    assert ssd["r"][0] == pytest.approx(2 * 0.75 ** 2 + 3 * 0.75 ** 2)
    msb = _by_run(C.msb(C.diameter_observations(d)), ["msb"])
    assert msb == {"r": (2.25,), "s": (None,)}
    centered = {(r["k"], r["cluster"]): r["centered"] for r in C.center_data(d).where("run_id = 'r'").collect()}
    assert centered == {(2, 0): 1.0, (2, 1): -1.0, (4, 0): -1.0, (4, 1): 1.0, (4, 3): 0.0}


def test_random_curves_match_brute_force(spark):
    """300 random curves (small integer values, so ties happen) in one job, every rule checked."""
    import random

    rnd = random.Random(20261202)
    curves = {}
    for i in range(300):
        n = rnd.randint(1, 7)
        ks = sorted(rnd.sample(range(2, 40), n))
        curves[f"r{i}"] = [(k, float(rnd.randint(0, 6))) for k in ks]
    rows = [(r, k, v, v * 10.0 + 1.0, -v) for r, pts in curves.items() for k, v in pts]
    df = spark.createDataFrame(rows, "run_id string, k int, avg_diameter double, wssse double, bic double")
    slope_rows = {(r["run_id"], r["k"]): (r["slope"], r["value"]) for r in C.k_slopes(df).collect()}
    ranges = _by_run(C.best_k_range_slope(df), ["k1", "s1", "d1", "k2", "s2", "d2"])
    drops = _by_run(C.best_k_diameter_drop(df), ["k", "drop"])
    ratios = _by_run(C.best_k_error_ratio(df), ["k", "ratio"])
    elbows = _by_run(C.elbow_point(df), ["k", "avg_diameter"])
    gaps = _by_run(C.max_bic_gap(df), ["k1", "k2", "gap"])
    for run, pts in curves.items():
        for k, s, v in ref_slopes(pts):
            assert slope_rows[(run, k)] == pytest.approx((s, v))
        ref = ref_range_slope(pts)
        assert ranges[run] == ((None,) * 6 if ref is None else pytest.approx(ref))
        assert drops[run] == pytest.approx(ref_drop(pts))
        e = ref_elbow(pts)
        assert elbows.get(run) == (None if e is None else pytest.approx(e))
        if len(pts) > 1:
            assert ratios[run] == pytest.approx(ref_ratio([(k, v * 10.0 + 1.0) for k, v in pts]))
            g = ref_gap([(k, -v) for k, v in pts])
            assert gaps[run] == pytest.approx((g[0][0], g[1][0], g[2]))
