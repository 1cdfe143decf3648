"""Helpers shared by the operators of this subpackage: table reads, written
stages in the shared folder, and file access from tasks."""

from __future__ import annotations

import sys
import uuid
from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipmart.session import scratch_path

#: A word: a run of characters other than space, tab, LF, VT, FF and CR.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder path under the shared ``spark.checkpoint.dir``."""
    return scratch_path(spark, f"llm-{name}-{uuid.uuid4().hex}")


#: Rows that a task in Python gets at once where rows hold texts.
BATCH_ROWS = 1000


def small_batches(spark: SparkSession) -> None:
    """Lower the session's rows per Arrow batch for rows that hold texts: ten
    thousand long ones would fill a task's memory, in Spark and in Python."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name, "10000")) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def staged(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: later
    readers neither recompute it nor depend on one executor's disk."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.parquet(path, compression=codec)
    return spark.read.schema(df.schema).parquet(path)


def per_worker(name: str, make: Callable[[], Any]) -> Any:
    """One object per Python worker process, kept between tasks (the package
    travels to workers by value, so module globals start anew in each task)."""
    kept = sys.__dict__.setdefault("_clipmart_llm", {})
    if name not in kept:
        kept[name] = make()
    return kept[name]


def filesystem(root: str):
    """(file system, path) of a folder uri, for tasks that write or read files."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(root) if "://" in root or root.startswith("file:") \
        else (fs.LocalFileSystem(), root)


def write_file(root: str, name: str, data: bytes) -> str:
    """Write one file under a private name and move it into place: a retried
    or speculative task replaces it with the same bytes."""
    fs, base = filesystem(root)
    fs.create_dir(base, recursive=True)
    part = f"{base}/.{name}.{uuid.uuid4().hex}"
    with fs.open_output_stream(part, compression=None) as out:
        out.write(data)
    fs.move(part, f"{base}/{name}")
    return name


def read_file(root: str, name: str) -> bytes:
    fs, base = filesystem(root)
    with fs.open_input_stream(f"{base}/{name}", compression=None) as src:
        return src.read()


def free_name(taken: list[str], wanted: str) -> str:
    """``wanted``, with underscores added until no input column has that name
    (names compare without case, as Spark's do)."""
    low = {c.lower() for c in taken}
    while wanted.lower() in low:
        wanted += "_"
    return wanted


def only(df: DataFrame, **cols: str) -> DataFrame:
    """The named columns under fixed names; everything else is left behind, so
    extra columns can't clash with what an operator adds."""
    return df.select(*(F.col(f"`{c}`").alias(n) for n, c in cols.items()))
