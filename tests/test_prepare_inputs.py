"""Activity lines → input folder → membership and profiles (Entry C)."""

import json
import os

from pyspark.sql import functions as F

from segmint.plans.kmeans_job import load_inputs
from segmint.plans.prepare_inputs import folder_k, prepare_folder, run_from_activity, write_folder

from test_golden import POINTS, _check_profiles


def lines(spark):
    """The golden points as activity: counts spread over the kinds, a page and a kind outside the category."""
    rows = []
    for u, x, y in POINTS:
        likes = {p: int(v) for p, v in (("page1", x), ("page2", y)) if v}
        rows.append((json.dumps([u, "1", {"other": 5}, likes, {}, {}]),))
    # a zero and a count split over two kinds
    rows[3] = (json.dumps(["d", "1", {"page1": 4}, {"page1": 5, "page2": 2}, {"page2": 7}, {"page1": 0}]),)
    rows[0] = (json.dumps(["a", "1", {"page1": 0}, {}, {}, {}]),)
    category = json.dumps({"id": 1, "facebook": [{"id": "page1", "name": "One"}, {"id": "page2", "name": "Two"}, {"id": "unused", "name": "x"}]})
    return spark.createDataFrame(rows, "value string"), spark.createDataFrame([(category,)], "value string")


def test_activity_to_outputs(spark, workdir):
    activity, category = lines(spark)
    folder, out = os.path.join(workdir, "in"), os.path.join(workdir, "out")
    got = prepare_folder(spark, activity, category, folder, factor=1)
    assert got == {"points": 5, "pages": 2}  # the user whose only count is zero has no point
    points, dims, q = load_inputs(spark, folder)
    assert {r["user_id"]: r["features"] for r in points.collect()} == {u: [x, y] for u, x, y in POINTS if u != "a"}
    assert sorted((r["dim"], r["dimension_id"], r["dimension_name"]) for r in dims.collect()) == [(0, "page1", "One"), (1, "page2", "Two")] and q == 2
    with open(os.path.join(folder, "k.txt"), "w") as f:
        f.write("2\n")
    assert folder_k(spark, folder) == 2
    assert run_from_activity(spark, activity, category, folder, out, params="kmeans||,100,0.001", run_id="r", seed=1)["k"] == 2
    data = [json.loads(r["value"]) for r in spark.read.text(out + "/data.json").collect()]
    assert {tuple(d["user_ids"]) for d in data} == {("b", "c"), ("d", "e", "f")}


def test_golden_points_through_a_written_folder(spark, workdir):
    """All six points (a zero point has a line of its own) through the writer to both outputs."""
    folder, out = os.path.join(workdir, "in"), os.path.join(workdir, "out")
    rows = [(u, p, v) for u, x, y in POINTS for p, v in (("page1", x), ("page2", y))]
    assert write_folder(spark.createDataFrame(rows, "user_id string, page_id string, n double"), None, folder) == {"points": 6, "pages": 2}
    assert folder_k(spark, folder) is None
    run_from_activity(spark, None, None, folder, out, k=2, params="kmeans||,100,0.001", run_id="golden", seed=1)
    _check_profiles([r.asDict(recursive=True) for r in spark.read.json(out + "/meta-data.json").collect()])
    chosen = run_from_activity(spark, None, None, folder, out + "2", ks=[2, 3], run_id="c")
    assert chosen["k"] in (2, 3)


def test_many_users_keep_their_lines(spark, workdir):
    folder = os.path.join(workdir, "in")
    counts = spark.range(20_000).select(F.concat(F.lit("u"), F.col("id").cast("string")).alias("user_id"), F.concat(F.lit("p"), (F.col("id") % 7).cast("string")).alias("page_id"), (F.col("id") + 1).alias("n"))
    write_folder(counts, None, folder)
    points, _, _ = load_inputs(spark, folder, sparse=True)
    wrong = points.where((F.col("val")[0] != F.substring("user_id", 2, 10).cast("double") + 1) | (F.size("idx") != 1))
    assert points.count() == 20_000 and wrong.count() == 0
