"""Outputs that appear whole and once (O54), whoever writes them.

A step is built in an attempt folder of its own, ``<parent>/_attempts/<step>-<id>`` (readers skip
names that begin with an underscore). When it is complete, one manifest, ``<parent>/_manifests/<step>.json``,
is created *if absent* and names the attempt; then that attempt's folder is moved to the step's path.
Of several drivers on one step the first to create the manifest publishes and the others
drop their attempts. A driver that dies before the manifest has published nothing; one that
dies after it leaves the move to whoever comes next. So a step's path exists only whole.
"""

from __future__ import annotations

import json
import logging
import os
import uuid
from collections.abc import Callable
from urllib.parse import urlparse

from pyspark.sql import SparkSession

from segmint.sources.sinks import path_done

log = logging.getLogger(__name__)


class Folder:
    """The few file operations that Spark's readers and writers don't offer, through Hadoop's file system of a path."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm = spark._jvm
        self.fs = self._path(path).getFileSystem(spark._jsc.hadoopConfiguration())
        self.local = self.fs.getScheme() == "file"

    def _path(self, path: str):
        return self.jvm.org.apache.hadoop.fs.Path(path)

    @staticmethod
    def _plain(path: str) -> str:
        return urlparse(path).path if path.startswith("file:") else path

    def exists(self, path: str) -> bool:
        return self.fs.exists(self._path(path))

    def read(self, path: str) -> str:
        stream = self.fs.open(self._path(path))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create_if_absent(self, path: str, text: str) -> bool:
        """Write ``text`` as a new file; False if there is one already. Of several callers one gets True."""
        self.fs.mkdirs(self._path(path).getParent())
        if self.local:
            # a hard link appears with its content or not at all
            draft = f"{self._plain(path)}.{uuid.uuid4().hex}"
            with open(draft, "x") as f:
                f.write(text)
            try:
                os.link(draft, self._plain(path))
                return True
            except FileExistsError:
                return False
            finally:
                os.unlink(draft)
        try:
            stream = self.fs.create(self._path(path), False)
        except Exception as e:  # noqa: BLE001 (the JVM's exceptions come as one type)
            if self.exists(path):
                return False
            raise e
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        return True

    def move(self, old: str, new: str) -> None:
        """Move a folder to a path that doesn't exist; nothing happens when another driver has moved it already."""
        self.fs.mkdirs(self._path(new).getParent())
        if self.exists(new) or not self.exists(old):
            return
        if self.local:
            try:
                os.rename(self._plain(old), self._plain(new))
            except OSError:
                if not self.exists(new):
                    raise
        elif not self.fs.rename(self._path(old), self._path(new)) and not self.exists(new):
            raise OSError(f"could not move {old} to {new}")

    def drop(self, path: str) -> None:
        self.fs.delete(self._path(path), True)


def publish_once(spark: SparkSession, path: str, build: Callable[[str], None], marker: str = "step") -> bool:
    """Run ``build(folder)`` and make what it wrote appear as ``path``, unless the step is published already.

    True when this call published the step. ``marker`` is a Spark output inside the step, written
    last by steps from before there were manifests; a folder that holds it is complete.
    A failing ``build`` raises, and leaves no file that a reader would take for the step's.
    """
    path = path.rstrip("/")
    parent, name = path.rsplit("/", 1)
    folder = Folder(spark, path)
    manifest = f"{parent}/_manifests/{name}.json"

    def settle() -> bool:
        """Whether the step is published; finishes the move that another driver may have left."""
        if not folder.exists(manifest):
            return path_done(spark, f"{path}/{marker}")
        named = folder.read(manifest)
        if named:  # still empty: being written this moment by its driver, which moves it next
            folder.move(json.loads(named)["attempt"], path)
        return True

    if settle():
        log.info("output exists, skipping: %s", path)
        return False
    if folder.exists(path):
        raise FileExistsError(f"{path} holds files but isn't a published step; move it away first")
    attempt = f"{parent}/_attempts/{name}-{uuid.uuid4().hex}"
    try:
        build(attempt)
        won = folder.create_if_absent(manifest, json.dumps({"attempt": attempt, "path": path}))
    except BaseException:
        folder.drop(attempt)
        raise
    if won:
        folder.move(attempt, path)
        return True
    folder.drop(attempt)
    settle()
    log.info("another driver published %s, this attempt is dropped", path)
    return False
