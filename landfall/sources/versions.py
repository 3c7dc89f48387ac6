"""Tables that change by one atomic step.

The files of a table lie in folders that nothing names until a manifest does. A change writes its folders,
then a manifest with the next number; a number can be taken once, so a writer that comes second
starts again from the manifest that was faster and nobody's change is lost. Readers take the manifest
with the highest number. Whatever is interrupted leaves the state before or the state after.
"""

from __future__ import annotations

import json
import os
import re
import uuid
from collections.abc import Callable
from typing import NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

from landfall.session import hadoop_path

MANIFESTS = "_manifests"
KEPT = 3  # manifests whose folders stay, for readers that began before a change
_NUMBERED = re.compile(r"(\d{12})\.json")


class Snapshot(NamedTuple):
    """The entries of a manifest: by name, what the entry says, with its ``folders`` under the table's path."""

    version: int
    entries: dict[str, dict]

    def folders(self) -> list[str]:
        return [folder for entry in self.entries.values() for folder in entry["folders"]]


def fresh_name() -> str:
    """A name for a folder of data that no other writer uses."""
    return f"_data={uuid.uuid4().hex}"


def latest(spark: SparkSession, path: str) -> Snapshot | None:
    """The present state of the table, or None before its first manifest."""
    numbers = _numbers(spark, path)
    return _read(spark, path, numbers[-1]) if numbers else None


def commit(spark: SparkSession, path: str, change: Callable[[Snapshot], dict[str, dict]]) -> Snapshot:
    """Put ``change(present state)`` in place of the present entries.

    The state that ``change`` is given carries the number that the new one would get. It may be called more
    than once, each time with a later state.
    """
    while True:
        now = latest(spark, path) or Snapshot(0, {})
        new = Snapshot(now.version + 1, change(Snapshot(now.version + 1, now.entries)))
        if _claim(spark, path, new):
            return new


def expire(spark: SparkSession, path: str, kept=KEPT) -> None:
    """Remove what only manifests before the last ``kept`` name. The manifests go last, so it can be repeated."""
    numbers = _numbers(spark, path)
    old, new = numbers[:-kept], numbers[-kept:]
    if not old:
        return
    named = {folder for number in new for folder in _read(spark, path, number).folders()}
    gone = {folder for number in old for folder in _read(spark, path, number).folders()} - named
    for folder in sorted(gone):
        drop(spark, f"{path}/{folder}")
        _drop_if_empty(spark, f"{path}/{folder}".rpartition("/")[0])
    for number in old:
        drop(spark, _manifest(path, number))


def drop(spark: SparkSession, path: str) -> None:
    system, found = hadoop_path(spark, path)
    system.delete(found, True)


def children(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder; none if it does not exist."""
    system, folder = hadoop_path(spark, path)
    if not system.exists(folder):
        return []
    return sorted(status.getPath().getName() for status in system.listStatus(folder))


def _drop_if_empty(spark, path):
    if path.rpartition("/")[2].startswith("_data=") and not children(spark, path):
        drop(spark, path)


def _manifest(path, number):
    return f"{path}/{MANIFESTS}/{number:012d}.json"


def _numbers(spark, path):
    found = (_NUMBERED.fullmatch(name) for name in children(spark, f"{path}/{MANIFESTS}"))
    return sorted(int(match[1]) for match in found if match)


def _read(spark, path, number):
    system, file = hadoop_path(spark, _manifest(path, number))
    stream = system.open(file)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return Snapshot(number, json.loads(text))


def _claim(spark, path, snapshot) -> bool:
    """Write a manifest whole under a name of its own, then give it its number unless that is taken."""
    system, made = hadoop_path(spark, f"{path}/{MANIFESTS}/new-{uuid.uuid4().hex}")
    out = system.create(made, False)
    out.write(json.dumps(snapshot.entries).encode())
    out.close()
    _, target = hadoop_path(spark, _manifest(path, snapshot.version))
    try:
        made, target = system.makeQualified(made), system.makeQualified(target)
        if target.toUri().getScheme() == "file":  # a rename there would replace the target
            return _link_if_free(made, target)
        return _rename_if_free(spark, made, target)
    finally:
        system.delete(made, False)


def _link_if_free(made, target) -> bool:
    try:
        os.link(made.toUri().getPath(), target.toUri().getPath())
    except FileExistsError:
        return False
    return True


def _rename_if_free(spark, made, target) -> bool:
    jvm = spark._jvm
    kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(kind, 1)
    options[0] = kind.NONE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(made, target, options)
    except Py4JJavaError as error:
        if error.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
            return False
        raise
    return True
