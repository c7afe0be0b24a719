"""Tables that are replaced as a whole: every refresh writes a folder of its own and then publishes it.

A table is a folder holding ``version-<number>-<id>`` folders and a ``_published`` folder with one empty file per
finished version. Publishing creates one such file, so a reader sees the old version or the new one, never a mixture,
and a refresh that dies half way leaves nothing that anyone reads. A frame that was opened before a refresh keeps
reading its own version, which stays until ``keep`` newer ones have been published.
"""

from __future__ import annotations

import uuid
from typing import Any

from pyspark.sql import DataFrame, SparkSession

_LOG, _PREFIX = "_published", "version-"
#: Published versions that stay on disk: the current one and those that readers may still hold.
KEEP = 2


def file_system(spark: SparkSession, path: str) -> tuple[Any, Any]:
    """A path and its file system, whichever Spark can read."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def folder_names(spark: SparkSession, path: str) -> list[str]:
    place, system = file_system(spark, path)
    return sorted(s.getPath().getName() for s in system.listStatus(place)) if system.exists(place) else []


def published(spark: SparkSession, target: str) -> list[str]:
    """Names of published versions, oldest first. Of two refreshes that ran at once the larger id counts as the later."""
    return folder_names(spark, f"{target}/{_LOG}")


def current(spark: SparkSession, target: str) -> str | None:
    """Folder of the version that readers get; none if nothing has been published."""
    done = published(spark, target)
    return f"{target}/{_PREFIX}{done[-1]}" if done else None


def exists(spark: SparkSession, target: str) -> bool:
    """Whether there is something to read: a published version, or files written without versions."""
    if current(spark, target):
        return True
    place, system = file_system(spark, target)
    return system.exists(place) and not any(n.startswith(_PREFIX) for n in folder_names(spark, target))


def publish(df: DataFrame, target: str, keep: int = KEEP) -> str:
    """Write ``df`` as the next version of a table and make it the current one. Returns its folder.

    ``df`` may read the table itself. Versions before the last ``keep`` go, and so do folders of refreshes that died so long ago.
    """
    spark = df.sparkSession
    done = published(spark, target)
    number = int(done[-1].split("-")[0]) + 1 if done else 0
    name = f"{number:012}-{uuid.uuid4().hex}"
    df.write.parquet(f"{target}/{_PREFIX}{name}")
    entry, system = file_system(spark, f"{target}/{_LOG}/{name}")
    system.createNewFile(entry)
    _remove_old(spark, target, keep)
    return f"{target}/{_PREFIX}{name}"


def _remove_old(spark: SparkSession, target: str, keep: int) -> None:
    done = published(spark, target)
    if len(done) <= keep:
        return
    oldest = done[-keep]
    for name in done[:-keep]:  # first out of the log, so that no reader is sent to a folder that is going
        entry, system = file_system(spark, f"{target}/{_LOG}/{name}")
        system.delete(entry, False)
    for name in folder_names(spark, target):
        if name.startswith(_PREFIX) and name.removeprefix(_PREFIX) < oldest and name.removeprefix(_PREFIX) not in done[-keep:]:
            folder, system = file_system(spark, f"{target}/{name}")
            system.delete(folder, True)
