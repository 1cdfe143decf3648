"""Versioned tables: folders of Parquet and one manifest per version.

``<base>/data/<name>/`` holds rows and is never changed once a manifest names
it; ``<base>/versions/<number>.json`` names the folders of one version, oldest
first.  A version begins to exist when its manifest is moved to its number,
which fails if that number is taken: so a writer that dies leaves nothing to
be seen, and of two writers one has to try again.  The current version is the
highest number; a reader that has opened a version keeps it.

``append`` adds a folder of changed rows, so one late row is one small file and
no stored row is written again.  Reading keeps one row per key, of the latest
``order`` value.  ``compact`` writes that result as one folder;
``vacuum`` deletes folders that no kept version names.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


#: Names of the last writes that a manifest holds: a stream retries only its last batch.
MARKS = 100


class Conflict(RuntimeError):
    """Another writer has committed this version."""


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def versions(spark: SparkSession, base: str) -> list[int]:
    """The committed versions, ascending."""
    p, fs = _fs(spark, os.path.join(base, "versions"))
    names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def manifest(spark: SparkSession, base: str, version: int | None = None) -> dict | None:
    """What a version (default: the current) is made of; None without any."""
    there = versions(spark, base)
    if version is None and not there:
        return None
    number = there[-1] if version is None else version
    if number not in there:
        raise ValueError(f"{base}: no version {number}")
    text = spark.read.option("wholetext", True).text(os.path.join(base, "versions", f"{number:010d}.json")).first()[0]
    return json.loads(text)


def commit(spark: SparkSession, base: str, about: dict) -> int:
    """Publish ``about`` as version about["version"]."""
    jvm = spark.sparkContext._jvm
    folder = os.path.join(base, "versions")
    hidden, fs = _fs(spark, os.path.join(folder, f".{uuid.uuid4().hex}"))
    out = fs.create(hidden)
    out.write(bytearray(json.dumps(about).encode()))
    out.close()
    target = jvm.org.apache.hadoop.fs.Path(os.path.join(folder, f"{about['version']:010d}.json"))
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    nothing = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)  # don't overwrite
    try:
        context.rename(fs.makeQualified(hidden), fs.makeQualified(target), nothing)
    except Exception as e:  # noqa: BLE001 - Java's exceptions come as one type
        fs.delete(hidden, False)
        if "FileAlreadyExists" in str(e) or "already exists" in str(e):
            raise Conflict(f"{base}: version {about['version']} is taken") from e
        raise
    return about["version"]


def _write(df: DataFrame, base: str, partition_by: str | None) -> str:
    """Store rows in a new folder, which no version names yet."""
    name = uuid.uuid4().hex
    (df.write.partitionBy(partition_by) if partition_by else df.write).parquet(os.path.join(base, "data", name))
    return name


def append(df: DataFrame, base: str, keys: Sequence[str], order: Sequence[str], partition_by: str | None = None,
           mark: str | None = None, tries: int = 5, over: bool = True) -> int:
    """Add ``df`` as changed rows and return the new version.  ``mark`` names
    the write (a stream's batch): one that is already committed is left out,
    so a retried batch changes nothing.  Without ``over`` the rows of earlier
    versions are left behind."""
    spark = df.sparkSession
    before = manifest(spark, base)
    if before and mark and mark in before["marks"]:
        return before["version"]
    name = _write(df, base, partition_by)
    for _ in range(tries):
        now = before or {"version": 0, "folders": [], "marks": []}
        if mark and mark in now["marks"]:
            return now["version"]
        about = {"version": now["version"] + 1, "folders": [*(now["folders"] if over else []), name], "keys": list(keys),
                 "order": list(order), "partition_by": partition_by, "schema": json.loads(df.schema.json()),
                 "marks": [*now["marks"], mark][-MARKS:] if mark else now["marks"]}
        try:
            return commit(spark, base, about)
        except Conflict:  # another writer was first: go on from its version
            before = manifest(spark, base)
    raise Conflict(f"{base}: {tries} tries")


def replace(df: DataFrame, base: str, keys: Sequence[str], order: Sequence[str], partition_by: str | None = None) -> int:
    """The rows of ``df`` alone as the next version."""
    return append(df, base, keys, order, partition_by, over=False)


def _folders(spark: SparkSession, base: str, about: dict) -> DataFrame:
    schema = T.StructType.fromJson(about["schema"])
    rows = None
    for name in about["folders"]:
        part = spark.read.schema(schema).parquet(os.path.join(base, "data", name)).select(*schema.fieldNames())
        rows = part if rows is None else rows.unionByName(part)
    return rows


def read(spark: SparkSession, base: str, version: int | None = None, where=None) -> DataFrame:
    """The rows of a version (default: the current): one per key, the one of
    the latest ``order``.  ``where`` is a condition on key columns; it reaches
    the scans before rows are compared."""
    about = manifest(spark, base, version)
    if about is None:
        raise ValueError(f"{base}: no version")
    rows = _folders(spark, base, about)
    if where is not None:
        rows = rows.where(where)
    keys, order = about["keys"], about["order"]
    rest = [c for c in rows.columns if c not in keys]
    latest = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("r"))
    return latest.select(*(F.col(c) if c in keys else F.col(f"r.{c}").alias(c) for c in rows.columns))


def compact(spark: SparkSession, base: str) -> int:
    """Write the current version as one folder, as a new version."""
    about = manifest(spark, base)
    if about is None or len(about["folders"]) < 2:
        return about["version"] if about else 0
    name = _write(read(spark, base, about["version"]), base, about["partition_by"])
    # a version committed meanwhile makes this one fail: its rows are not in the folder
    return commit(spark, base, {**about, "version": about["version"] + 1, "folders": [name]})


def vacuum(spark: SparkSession, base: str, keep: int = 2) -> list[str]:
    """Delete all versions but the last ``keep`` and the folders only they
    name; returns these.  Not while a writer is at work: its folder has no
    version yet."""
    there = versions(spark, base)
    kept = {f for v in there[-keep:] for f in manifest(spark, base, v)["folders"]}
    for v in there[:-keep]:
        p, fs = _fs(spark, os.path.join(base, "versions", f"{v:010d}.json"))
        fs.delete(p, False)
    p, fs = _fs(spark, os.path.join(base, "data"))
    gone = sorted(s.getPath().getName() for s in fs.listStatus(p) if s.getPath().getName() not in kept) if fs.exists(p) else []
    for name in gone:
        fs.delete(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(os.path.join(base, "data", name)), True)
    return gone
