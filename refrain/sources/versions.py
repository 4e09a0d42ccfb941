"""Datasets that are replaced without ever being gone.

A version is written whole into a folder of its own below the target, and only then
entered in the target's log: a small file whose name is the next number, written only
if there is none of that name. Readers take the entry with the greatest number. So no
clock decides which version is the newest, of two writers that began from the same
version one wins and the other is told, and a run that fails leaves the one before
untouched. ``vacuum`` clears away old versions and failed tries.

Several targets may share a journal: then their new versions are entered in it
together, by one file, and readers of any of them see all or none.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from refrain import files

_LOG = "_log"
_FOLDER = "v-"

#: In a target's log: where the journal is that it shares.
_JOURNAL = "journal"

#: Versions that are neither current nor younger than this many hours may go.
KEEP_HOURS = 7 * 24


class VersionConflict(RuntimeError):
    """Another writer has made a version meanwhile."""


def _log(target: str) -> str:
    return f"{target.rstrip('/')}/{_LOG}"


def _numbers(names) -> list[int]:
    return sorted(int(n.removesuffix(".json")) for n in names if n.removesuffix(".json").isdigit())


def _entry(spark: SparkSession, target: str, number: int) -> dict:
    return json.loads(files.read_text(spark, f"{_log(target)}/{number:020}.json"))


def _logged_in(spark: SparkSession, target: str) -> str:
    """The journal of a target, or the target itself."""
    marker = f"{_log(target)}/{_JOURNAL}"
    return files.read_text(spark, marker) if files.exists(spark, marker) else target


def version(spark: SparkSession, target: str) -> int:
    """The number of the newest version in the target's log or journal, 0 for none."""
    log = _log(_logged_in(spark, target))
    return max(_numbers(files.listed(spark, log)), default=0)


def _newest(spark: SparkSession, log: str, target: str) -> str | None:
    """The newest folder that a log has for a target."""
    for number in reversed(_numbers(files.listed(spark, _log(log)))):
        folder = _entry(spark, log, number).get(target)
        if folder:
            return folder
    return None


def current(spark: SparkSession, target: str) -> str:
    """The folder of the newest whole version; ``target`` itself if it has no log."""
    target = target.rstrip("/")
    folder = _newest(spark, _logged_in(spark, target), target)
    return f"{target}/{folder}" if folder else target


def _commit(spark: SparkSession, log: str, after: int, folders: Mapping[str, str]) -> None:
    path = f"{_log(log)}/{after + 1:020}.json"
    if not files.put_if_absent(spark, path, json.dumps(dict(folders))):
        raise VersionConflict(f"version {after + 1} of {log} was made by another writer")


def write_version(
    df: DataFrame, target: str, write: Callable[[DataFrame, str], None]
) -> str:
    """Write ``df`` as the new version of ``target`` and return its folder.

    ``df`` may be read from ``target``: its version stays while the new one is made.
    A version that another writer has made since this began raises
    ``VersionConflict``, and the folder written here is removed.
    """
    return write_versions({target: df}, write)[target]


def write_versions(
    datasets: Mapping[str, DataFrame],
    write: Callable[[DataFrame, str], None],
    journal: str | None = None,
    each: Callable[[list[Callable[[], None]]], None] | None = None,
) -> dict[str, str]:
    """New versions of several targets; returns their folders.

    With ``journal`` they are entered together, without it each by itself as soon as
    all are written. ``each`` runs the writes, by default one after the other.
    """
    spark = next(iter(datasets.values())).sparkSession
    bare = {target: target.rstrip("/") for target in datasets}
    if journal:
        journal = journal.rstrip("/")
        for target in bare.values():
            files.put_if_absent(spark, f"{_log(target)}/{_JOURNAL}", journal)
    logs = {target: _logged_in(spark, target) for target in bare.values()}
    if journal and set(logs.values()) != {journal}:
        raise ValueError(f"a target has another journal than {journal}")
    before = {log: max(_numbers(files.listed(spark, _log(log))), default=0) for log in logs.values()}
    folders = {target: f"{_FOLDER}{uuid.uuid4().hex}" for target in bare.values()}
    writes = [lambda df=df, t=bare[t]: write(df, f"{t}/{folders[t]}") for t, df in datasets.items()]
    try:
        if each:
            each(writes)
        else:
            for run in writes:
                run()
        for log, number in before.items():
            _commit(spark, log, number, {t: folders[t] for t in folders if logs[t] == log})
    except Exception:
        for target, folder in folders.items():
            if current(spark, target) != f"{target}/{folder}":
                files.remove(spark, f"{target}/{folder}")
        raise
    return {target: f"{bare[target]}/{folders[bare[target]]}" for target in datasets}


def vacuum(spark: SparkSession, target: str, keep_hours: float = KEEP_HOURS) -> list[str]:
    """Remove old versions and failed tries of a target; returns their folders.

    The current version stays, and so does every folder that was changed within
    ``keep_hours``, as a reader or writer may still be at it. Log entries stay, so
    numbers go on rising.
    """
    target = target.rstrip("/")
    kept, since = current(spark, target), time.time() * 1000 - keep_hours * 3_600_000
    gone = [
        f"{target}/{name}"
        for name, changed in files.listed(spark, target).items()
        if name.startswith(_FOLDER) and changed < since and f"{target}/{name}" != kept
    ]
    for folder in gone:
        files.remove(spark, folder)
    return gone
