"""Sources and sinks.

Layout of a lake table: ``<root>/<name>/client_id=<c>/part-*.parquet``.
Tenancy is a directory partition, so a one-client read prunes partitions
and a one-client write overwrites only that partition (dynamic partition
overwrite).  Every reader takes an explicit schema: nothing is inferred.
"""

from __future__ import annotations

import csv
import os
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clipmart import schemas


def _require_client(client_id: str | None) -> str:
    if client_id is None or not str(client_id).strip():
        raise ValueError("client_id is required (tenant-scoped read/write; no default)")
    return str(client_id)


def _with_client(schema: T.StructType) -> T.StructType:
    if "client_id" in schema.fieldNames():
        return schema
    return T.StructType(schema.fields + [T.StructField("client_id", T.StringType(), True)])


def read_table(spark: SparkSession, root: str, name: str, schema: T.StructType,
               client_id: str | None = None, all_clients: bool = False) -> DataFrame:
    """Read a client-partitioned lake table.  One client -> partition
    pruning on ``client_id``; ``all_clients`` -> one read over every
    partition (S8).  A missing client id fails loudly (S1)."""
    df = spark.read.schema(_with_client(schema)).parquet(os.path.join(root, name))
    if all_clients:
        return df
    return df.where(F.col("client_id") == _require_client(client_id))


def read_bronze(spark, root, client_id):
    """S1."""
    return read_table(spark, root, "bronze_asset_raw", schemas.BRONZE_ASSET_RAW, client_id)


def read_perf(spark, root, client_id):
    """Append-only performance captures of one client."""
    return read_table(spark, root, "bronze_ad_performance_raw", schemas.BRONZE_AD_PERF, client_id)


def read_all_clients(spark, root, name, schema):
    """Cross-client read (partition discovery on client_id)."""
    return read_table(spark, root, name, schema, all_clients=True)


def csv_headers(spark: SparkSession, path: str) -> list[tuple[list[str], list[str]]]:
    """(header names, files) of the CSV files under ``path``: files whose
    headers agree go together.  Each file's first line is read in a task."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "length") \
        .where("length > 0").select("path")
    schema = T.StructType([T.StructField("path", T.StringType()), T.StructField("header", T.StringType())])

    def first_lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs as pafs

        for b in batches:
            lines = []
            for p in b["path"]:
                filesystem, name = pafs.FileSystem.from_uri(p)
                with filesystem.open_input_stream(name, compression=None) as src:
                    data = b""
                    while b"\n" not in data and (more := src.read(1 << 16)):
                        data += more
                lines.append(data.split(b"\n", 1)[0].decode("utf-8-sig").rstrip("\r"))
            yield b.assign(header=lines)

    groups: dict[str, list[str]] = {}
    for r in files.mapInPandas(first_lines, schema).collect():  # a row per file, as the reader lists them
        groups.setdefault(r["header"], []).append(r["path"])
    return [(next(csv.reader([h])), sorted(paths)) for h, paths in sorted(groups.items())]


def read_csv_by_name(spark: SparkSession, path: str, required: list[str], optional: list[str] = ()) -> DataFrame:
    """The named columns of all CSV files under ``path`` as text, found by
    their names in each file's header: files may order them differently and
    hold others, which are left behind.  A file without a required column, or
    with a column twice, fails the read; a missing optional one is null."""
    wanted, out = [*required, *optional], None
    for names, files in csv_headers(spark, path):
        names = [n.strip() for n in names]
        missing = [c for c in required if c not in names]
        again = [c for c in wanted if names.count(c) > 1]
        if missing or again:
            raise ValueError(f"{files[0]}: " + (f"no column {', '.join(missing)}" if missing else f"column {', '.join(again)} is there twice"))
        # positions in place of names: others may repeat, and Spark compares names without case
        schema = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(names))])
        rows = spark.read.schema(schema).option("header", True).option("enforceSchema", True).csv(files)
        rows = rows.select(*((F.col(f"c{names.index(c)}") if c in names else F.lit(None).cast("string")).alias(c) for c in wanted))
        out = rows if out is None else out.unionByName(rows)
    if out is None:
        out = spark.createDataFrame([], T.StructType([T.StructField(c, T.StringType()) for c in wanted]))
    return out


def read_seed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """S3: CSV with pinned column types (no sniffing), columns by name.  Text
    that isn't of its column's type fails the read."""
    raw = read_csv_by_name(spark, path, schema.fieldNames())

    def typed(f: T.StructField):
        value = F.col(f.name).try_cast(f.dataType)
        broken = F.concat(F.lit(f"{f.name} of {f.dataType.simpleString()} holds "), F.col(f.name))
        return F.when(F.col(f.name).isNotNull() & value.isNull(), F.raise_error(broken).cast(f.dataType)).otherwise(value).alias(f.name)

    return raw.select(*map(typed, schema.fields))


def read_embeddings(spark: SparkSession, path: str) -> DataFrame:
    """The embedding side table.  A missing or repeated ``chunk_id`` fails
    the read, as it would multiply or lose chunks in every join on it."""
    df = spark.read.schema(schemas.CHUNK_EMBEDDING).parquet(path)
    bad = df.groupBy("chunk_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 OR chunk_id IS NULL").limit(1).collect()
    if bad:
        raise ValueError(f"{path}: chunk_id {bad[0]['chunk_id']!r} is on {bad[0]['n']} rows")
    return df


def read_run_log(spark: SparkSession, path: str) -> DataFrame:
    """One JSON object per extraction run."""
    return spark.read.schema(schemas.EXTRACTION_RUN_LOG).json(path)


def _raw_export(spark: SparkSession, path: str, platform: str) -> DataFrame:
    from clipmart.operators import perf

    native = perf.EXPORT_COLUMNS[platform]
    keys = [c for c, to in native.items() if to in perf.EXPORT_KEYS]
    return read_csv_by_name(spark, path, keys, [c for c in native if c not in keys])


def read_export(spark: SparkSession, path: str, platform: str) -> DataFrame:
    """The platform CSV exports under ``path`` by their native column names
    (in any order, with others between), conformed to the canonical schema
    (perf.conform).  Rows that ``quarantined_export`` returns are left out."""
    from clipmart.operators import perf

    raw = _raw_export(spark, path, platform)
    return perf.conform(raw.where(F.size(perf.malformed(raw, platform)) == 0), platform)


def quarantined_export(spark: SparkSession, path: str, platform: str) -> DataFrame:
    """The rows of the same files whose text isn't of its column's type, as
    they stand, with ``bad_fields``: the native names of these columns."""
    from clipmart.operators import perf

    raw = _raw_export(spark, path, platform)
    return raw.withColumn("bad_fields", perf.malformed(raw, platform)).where(F.size("bad_fields") > 0)


def scan_landing(spark: SparkSession, path: str, with_content: bool = True) -> DataFrame:
    """Recursive listing of landing objects with path, mtime and size;
    the bytes are read only when asked (listing stays metadata-only)."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    cols = ["path", F.col("modificationTime").alias("last_modified"), "length"]
    if with_content:
        cols.append("content")
    return df.select(*cols)


def write_objects(df: DataFrame, root: str, key_col: str, payload_col: str) -> DataFrame:
    """Write one object per row (``root/<key>``) from the executors and
    return (key, bytes written).  Used to lay out landing objects.  The
    file system comes from the root uri (local, hdfs://, s3://) through
    pyarrow; each object is written to a temporary name and moved into
    place, so a retried task rewrites the same object."""
    schema = T.StructType([T.StructField("key", T.StringType()), T.StructField("written", T.LongType())])

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs as pafs

        filesystem, base = pafs.FileSystem.from_uri(root)
        for pdf in it:
            out = []
            for key, payload in zip(pdf[key_col], pdf[payload_col]):
                data = payload.encode("utf-8") if isinstance(payload, str) else bytes(payload or b"")
                full = f"{base.rstrip('/')}/{key}"
                filesystem.create_dir(full.rsplit("/", 1)[0], recursive=True)
                tmp = full + ".tmp"
                with filesystem.open_output_stream(tmp) as fh:
                    fh.write(data)
                filesystem.move(tmp, full)
                out.append((key, len(data)))
            yield pd.DataFrame(out, columns=["key", "written"])
    return df.select(key_col, payload_col).mapInPandas(run, schema)


def escape_partition(value: str) -> str:
    """A partition value as Spark writes it into a folder name."""
    special = '"#%\'*/:=?\\\x7f{[]^'
    return "".join(f"%{ord(c):02X}" if c < " " or c in special else c for c in value)


def write_table(df: DataFrame, root: str, name: str, client_id: str | None = None) -> None:
    """K1: full overwrite of one client's copy of a table, others untouched
    (dynamic partition overwrite).  Without ``client_id`` every client
    partition present in ``df`` is replaced."""
    if client_id is not None:
        # the folder of the one client is replaced, also by an empty table
        df = df.where(F.col("client_id") == _require_client(client_id)).drop("client_id")
        df.write.mode("overwrite").parquet(os.path.join(root, name, f"client_id={escape_partition(client_id)}"))
        return
    # per-write option: no session-wide setting is changed
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
        .partitionBy("client_id").parquet(os.path.join(root, name))


def append_events(df: DataFrame, path: str) -> None:
    """K3: append JSON events (one object per line)."""
    df.write.mode("append").json(path)


def append_manifest(new_rows: DataFrame, path: str) -> int:
    """K4: append manifest rows whose asset id is not stored yet, one (the
    first ingested) per asset."""
    spark = new_rows.sparkSession
    from clipmart.operators.incremental import one_per_key
    from clipmart.session import materialize, path_exists

    columns = new_rows.columns
    new_rows = one_per_key(new_rows, "asset_id", "ingested_at" if "ingested_at" in columns else None)
    if path_exists(spark, path):
        old = spark.read.schema(new_rows.schema).parquet(path).select("asset_id")
        new_rows = new_rows.join(old, "asset_id", "left_anti").select(*columns)
    new_rows = materialize(new_rows)
    n = new_rows.count()
    if n:
        new_rows.write.mode("append").parquet(path)
    return n


def write_versioned(df: DataFrame, base: str, keys: list[str], order: list[str]) -> int:
    """K5/K6: the rows of ``df`` as the next version of the table under
    ``base``: it replaces all rows, earlier versions stay readable, and readers
    see it from the moment it is whole (``snapshots``)."""
    from clipmart.sources import snapshots

    return snapshots.replace(df, base, keys, order)


def write_failures(fails: DataFrame, path: str) -> None:
    """K7: append the failing rows of a DQ run to the audit table."""
    fails.write.mode("append").partitionBy("check_id").parquet(path)


def serving_view(spark: SparkSession, fact_path: str, name: str = "fact_chunk_vector",
                 schema: T.StructType | None = None) -> DataFrame:
    """K8: refresh the one table's files and (re)register the read-only serving view."""
    from clipmart.operators.search import serving_view as shape

    spark.catalog.refreshByPath(fact_path)
    df = spark.read.schema(schema).parquet(fact_path) if schema else spark.read.parquet(fact_path)
    return shape(df, name)
