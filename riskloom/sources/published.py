"""Published tables: numbered versions of a frame, of which readers see the newest complete one.

A version is a folder of files that nobody sees until its manifest is there. The manifest is written aside
and renamed into place, and that rename is the commit: it fails if the number is taken, so of two writers
one wins and the other one learns of it. What a version must fulfil is measured by the job that writes it. The file system
must rename atomically, as HDFS does; on an object store a committer table would have to take this place.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from typing import Any

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from riskloom.sources.store import hadoop_path, path_exists, read_text, remove_path

_MANIFESTS, _DATA = "_versions", "_data"
ROWS = "rows"


class Conflict(RuntimeError):
    """Another writer has published a version in the meantime."""


@dataclass(frozen=True)
class Version:
    """``number`` counts from 1; ``facts`` are what the write measured, ``note`` what the writer had to say."""

    number: int
    folder: str
    schema: str
    facts: dict[str, Any] = field(default_factory=dict)
    note: dict[str, Any] = field(default_factory=dict)

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(StructType.fromJson(json.loads(self.schema))).parquet(self.folder)


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the complete versions that are kept, in order."""
    target, fs = hadoop_path(spark, f"{path}/{_MANIFESTS}")
    if not fs.exists(target):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(target)]
    return sorted(int(n.split(".")[0]) for n in names if n.endswith(".json") and n.split(".")[0].isdigit())


def version(spark: SparkSession, path: str, number: int | None = None) -> Version | None:
    """The newest version or the one of a number; None where there is none."""
    known = versions(spark, path)
    if not known or (number is not None and number not in known):
        return None
    return Version(**json.loads(read_text(spark, _manifest(path, number or known[-1]))))


def read_published(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """The rows of the newest version, or of an earlier one that is still kept."""
    found = version(spark, path, number)
    if found is None:
        raise ValueError(f"nothing is published at {path}" if number is None else f"version {number} is not kept at {path}")
    return found.read(spark)


def publish(
    df: DataFrame, path: str, facts: Mapping[str, Column] | None = None, accept: Callable[[dict[str, Any]], None] | None = None,
    note: Mapping[str, Any] | None = None, after: int | None = None, keep: int = 2,
) -> Version:
    """Write a frame as the next version; readers go on reading the last one until it is complete.

    ``facts`` are aggregates that the write itself measures, besides the number of rows: one job writes and counts.
    ``accept`` gets them and raises if the version must not be seen; then, as after any other error,
    the files are removed and the last version stands. ``after`` names the version that the frame was made from: if a newer one is there
    by then, the write is a ``Conflict``. The newest ``keep`` versions stay readable.
    """
    spark = df.sparkSession
    before = versions(spark, path)
    last = before[-1] if before else 0
    if after is not None and after != last:
        raise Conflict(f"version {last} is there, the frame was made from {after}")
    folder = f"{path}/{_DATA}/{uuid.uuid4().hex}"
    measured = Observation()
    try:
        df.observe(measured, F.count(F.lit(1)).alias(ROWS), *[c.alias(n) for n, c in (facts or {}).items()]).write.parquet(folder)
        found = dict(measured.get)
        if not path_exists(spark, f"{folder}/_SUCCESS"):
            raise RuntimeError(f"the write to {folder} did not finish")
        if accept is not None:
            accept(found)
        made = Version(last + 1, folder, df.schema.json(), _plain(found), _plain(note or {}))
        _commit(spark, path, made)
    except BaseException:
        remove_path(spark, folder)
        raise
    for number in before[: max(0, len(before) + 1 - keep)]:
        _drop(spark, path, number)
    return made


def publish_view(df: DataFrame, path: str, view: str, **how: Any) -> Version:
    """Publish a frame and point a session's view at the new version in one step."""
    made = publish(df, path, **how)
    made.read(df.sparkSession).createOrReplaceTempView(view)
    return made


def remove_unfinished(spark: SparkSession, path: str, minutes: float = 24 * 60) -> int:
    """Remove folders that no manifest names and nobody has touched for some time, as a lost driver leaves them; their number."""
    named = {v.folder.rsplit("/", 1)[-1] for n in versions(spark, path) if (v := version(spark, path, n)) is not None}
    target, fs = hadoop_path(spark, f"{path}/{_DATA}")
    if not fs.exists(target):
        return 0
    limit = (time.time() - 60 * minutes) * 1000
    old = [s.getPath() for s in fs.listStatus(target) if s.getPath().getName() not in named and s.getModificationTime() <= limit]
    for folder in old:
        fs.delete(folder, True)
    return len(old)


def _manifest(path: str, number: int) -> str:
    return f"{path}/{_MANIFESTS}/{number:08d}.json"


def _plain(values: Mapping[str, Any]) -> dict[str, Any]:
    """Values as JSON has them, others as text."""
    return {k: v if v is None or isinstance(v, bool | int | float | str) else str(v) for k, v in values.items()}


def _commit(spark: SparkSession, path: str, made: Version) -> None:
    """The rename that makes a version visible; it never replaces a manifest."""
    aside, fs = hadoop_path(spark, f"{path}/{_MANIFESTS}/.{uuid.uuid4().hex}")
    stream = fs.create(aside, False)
    stream.write(bytearray(json.dumps(made.__dict__).encode()))
    stream.close()
    place, _ = hadoop_path(spark, _manifest(path, made.number))
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(place.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    try:
        files.rename(aside, place, gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0))
    except Exception as error:
        fs.delete(aside, False)
        if fs.exists(place):
            raise Conflict(f"version {made.number} was published by another writer") from error
        raise


def _drop(spark: SparkSession, path: str, number: int) -> None:
    """Remove a version: the manifest first, so that no reader finds it while its files go."""
    try:
        old = version(spark, path, number)
    except PySparkException:
        old = None
    remove_path(spark, _manifest(path, number))
    if old is not None:
        remove_path(spark, old.folder)
