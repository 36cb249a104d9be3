"""Counted reads: broken lines are set aside whole with a reason, all lines counted in the pass that parses them."""

import json
import os

import pytest

from segmint.plans.kmeans_job import load_inputs
from segmint.sources import jsonl, text
from segmint.sources.counted import read_category_counted, read_points_counted, read_user_activity_counted

LINES = ["0:1.5 3:2.0", "x:1", "", "1;4.0", "2:0.25  0:7", "2:1 2:3", "-1:2", "1:2:3", "4:1e3", "5:", "99999999999:1", " 6:-0.5 "]


def _write(folder, name, lines):
    path = os.path.join(folder, name)
    with open(path, "w") as f:
        f.writelines(line + "\n" for line in lines)
    return path


@pytest.mark.parametrize("as_frame", [False, True])
def test_points(spark, workdir, as_frame):
    source = spark.createDataFrame([(x,) for x in LINES], "value string").coalesce(1) if as_frame else _write(workdir, "inputs.txt", LINES)
    read = read_points_counted(spark, source, f"{workdir}/counted")
    got = {r.row_id: dict(r.features) for r in read.rows.collect()}
    assert got == {0: {0: 1.5, 3: 2.0}, 2: {}, 4: {2: 0.25, 0: 7.0}, 8: {4: 1000.0}, 11: {6: -0.5}}
    broken = {r.row_id: (r.value, r.reason) for r in read.broken.collect()}
    assert broken == {i: (LINES[i], "index twice" if i == 5 else "token") for i in (1, 3, 5, 6, 7, 9, 10)}
    assert read.counts == {"lines": 12, "broken": 7, "entries": 6, "top_index": 6}


def test_good_points_as_the_strict_reader(spark, workdir):
    lines = [" ".join(f"{j}:{i * j}.5" for j in range(i % 4)) for i in range(3000)]
    path = _write(workdir, "inputs.txt", lines)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")  # several splits of one file
    try:
        read = read_points_counted(spark, path, f"{workdir}/counted")
        want = {r.row_id: dict(r.features) for r in text.read_points(spark, path).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert {r.row_id: dict(r.features) for r in read.rows.collect()} == want and read.broken.isEmpty()
    assert read.counts == {"lines": 3000, "broken": 0, "entries": sum(i % 4 for i in range(3000)), "top_index": 2}


def test_empty_input_and_used_folder(spark, workdir):
    none = spark.createDataFrame([], "value string")
    read = read_points_counted(spark, none, f"{workdir}/counted")
    assert read.rows.isEmpty() and read.broken.isEmpty() and read.counts == {"lines": 0, "broken": 0, "entries": None, "top_index": None}
    with pytest.raises(Exception, match="exist"):
        read_points_counted(spark, none, f"{workdir}/counted")


def test_user_activity(spark, workdir):
    good = ["u1", "f", {"p": 2, "q": 1}, {}, {"r": 5}, {}]
    lines = [json.dumps(good), "not json", json.dumps(["u2", "m", {"p": 1}]), json.dumps(["u3", "m", {"p": "many"}, {}, {}, {}]),
             json.dumps(["u4", None, {}, {}, [1], {}]), json.dumps(["u5", "m", None, {}, {}, {}]), "{}", ""]
    read = read_user_activity_counted(spark, _write(workdir, "users.json", lines), f"{workdir}/counted")
    assert {r.value: r.reason for r in read.broken.collect()} == {
        lines[1]: "json", lines[2]: "fields", lines[3]: "page_like", lines[4]: "post_like", "{}": "json", "": "json"}
    rows = {r.user_id: r for r in read.rows.collect()}
    assert rows.keys() == {"u1", "u5"} and rows["u1"].page_like == {"p": 2, "q": 1} and rows["u5"].page_like == {}
    assert read.counts == {"lines": 8, "broken": 6, "entries": 3}
    strict = jsonl.read_user_activity(spark, spark.createDataFrame([(lines[0],), (lines[5],)], "value string"))
    assert sorted(strict.collect()) == sorted(read.rows.collect()) and strict.dtypes == read.rows.dtypes


def test_category(spark, workdir):
    docs = [{"id": 3, "facebook": [{"id": "a", "name": "A"}, {"id": "b"}]}, {"facebook": []}, {"id": 4, "facebook": [{"name": "B"}]}, {"id": 5, "facebook": []}]
    lines = [json.dumps(d) for d in docs] + ["[", None]
    read = read_category_counted(spark, spark.createDataFrame([(x,) for x in lines], "value string"), f"{workdir}/counted")
    assert sorted((r.category_id, r.page_id, r.name or "") for r in read.rows.collect()) == [(3, "a", "A"), (3, "b", "")]
    assert {r.value: r.reason for r in read.broken.collect()} == {lines[1]: "json", lines[2]: "page", "[": "json", None: "json"}
    assert read.counts == {"lines": 6, "broken": 4, "pages": 2}
    one = read_category_counted(spark, _write(workdir, "category.txt", [json.dumps(docs[0], indent=1)]), f"{workdir}/one")
    assert one.rows.count() == 2 and one.counts["lines"] == 1


def test_job_inputs_with_quarantine(spark, workdir):
    _write(workdir, "inputs.txt", ["0:1 1:2", "0:1 broken", "1:5"])
    _write(workdir, "users.txt", ["ann", "bob", "cem"])
    for name in ("pages.txt", "names.txt"):
        _write(workdir, name, ["p0", "p1"])
    points, dims, q = load_inputs(spark, workdir, quarantine=f"{workdir}/quarantine")
    assert {r.user_id: list(r.features) for r in points.collect()} == {"ann": [1.0, 2.0], "cem": [0.0, 5.0]} and q == 2
    assert [r.reason for r in spark.read.parquet(f"{workdir}/quarantine").where("not cast(ok as boolean)").collect()] == ["token"]
    with pytest.raises(Exception):
        load_inputs(spark, workdir)[0].collect()
    _write(workdir, "users.txt", ["ann", "bob"])
    with pytest.raises(ValueError, match="3 points but 2 users"):
        load_inputs(spark, workdir, quarantine=f"{workdir}/second")
