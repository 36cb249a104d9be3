"""Steps appear whole and once: racing drivers, failing ones, and ones that die at any point."""

import os
from concurrent.futures import ThreadPoolExecutor

import pytest

from segmint.session import ensure_checkpoint_dir
from segmint.sources.publish import Folder, publish_once


def rows(spark, n):
    def build(folder):
        spark.range(n).write.parquet(f"{folder}/members")
        spark.range(1).write.json(f"{folder}/step")

    return build


def left(workdir):
    return sorted(os.listdir(f"{workdir}/_attempts")) if os.path.isdir(f"{workdir}/_attempts") else []


def test_second_call_is_skipped(spark, workdir):
    assert publish_once(spark, f"{workdir}/a", rows(spark, 5)) is True
    assert publish_once(spark, f"{workdir}/a", rows(spark, 7)) is False
    assert spark.read.parquet(f"{workdir}/a/members").count() == 5 and left(workdir) == []


def test_racing_drivers_publish_once(spark, workdir):
    """Six drivers build one step at once, each with its own content: one content is there, whole."""
    with ThreadPoolExecutor(6) as pool:
        ran = list(pool.map(lambda n: publish_once(spark, f"{workdir}/a", rows(spark, n)), range(10, 16)))
    assert sum(ran) == 1
    assert spark.read.parquet(f"{workdir}/a/members").count() == 10 + ran.index(True) and left(workdir) == []


def test_failed_attempt_leaves_nothing(spark, workdir):
    def broken(folder):
        spark.range(3).write.parquet(f"{folder}/members")
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        publish_once(spark, f"{workdir}/a", broken)
    assert not os.path.exists(f"{workdir}/a") and left(workdir) == []
    assert publish_once(spark, f"{workdir}/a", rows(spark, 4)) is True


def test_a_driver_that_died_after_its_manifest_is_finished(spark, workdir, monkeypatch):
    """The manifest is there, the move isn't: the next driver moves that attempt and builds nothing."""
    with monkeypatch.context() as m:
        m.setattr(Folder, "move", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            publish_once(spark, f"{workdir}/a", rows(spark, 6))
    assert not os.path.exists(f"{workdir}/a")
    assert publish_once(spark, f"{workdir}/a", lambda folder: pytest.fail("built again")) is False
    assert spark.read.parquet(f"{workdir}/a/members").count() == 6


def test_a_driver_that_died_before_its_manifest_is_forgotten(spark, workdir):
    rows(spark, 9)(f"{workdir}/_attempts/a-dead")
    assert publish_once(spark, f"{workdir}/a", rows(spark, 2)) is True
    assert spark.read.parquet(f"{workdir}/a/members").count() == 2


def test_folders_of_others_are_not_touched(spark, workdir):
    spark.range(2).write.parquet(f"{workdir}/a/members")
    with pytest.raises(FileExistsError):
        publish_once(spark, f"{workdir}/a", rows(spark, 1))
    spark.range(1).write.json(f"{workdir}/b/step")  # complete in the older form
    assert publish_once(spark, f"{workdir}/b", rows(spark, 1)) is False


def test_hadoop_form_of_create_if_absent(spark, workdir):
    folder = Folder(spark, workdir)
    folder.local = False
    assert folder.create_if_absent(f"{workdir}/m/x.json", "one") and not folder.create_if_absent(f"{workdir}/m/x.json", "two")
    assert folder.read(f"{workdir}/m/x.json") == "one"
    spark.range(1).write.parquet(f"{workdir}/old")
    folder.move(f"{workdir}/old", f"{workdir}/new/er")
    assert spark.read.parquet(f"{workdir}/new/er").count() == 1


def test_no_machine_local_folder_on_a_cluster(spark, monkeypatch):
    class Cluster:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        sparkContext = Cluster()
        conf = {}

    with pytest.raises(ValueError):
        ensure_checkpoint_dir(Session(), fallback_local=True)
