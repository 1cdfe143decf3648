"""Streaming forms of the only-process-what-is-new loops.

X1 bronze_to_silver: new bronze files -> Silver chunks, each asset once.
   The ids seen are state of the stream (in RocksDB, so they needn't fit in
   memory), with an expiry if one is given; the sink is never read.  State,
   source offsets and the file sink's log commit batch by batch, so a restart
   from the checkpoint loses and repeats nothing.
X2 perf_upsert: late restated days replace earlier pulls.  Each
   micro-batch appends its latest pulls to a versioned table
   (``sources.snapshots``): no stored day is written again, readers never see
   half a batch, and a retried batch is left out by its mark.
X3 daily_counts: event stream -> daily counters per ad x platform with a
   watermark; append mode emits a day only once the watermark closes it.
"""

from __future__ import annotations

import os
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clipmart import schemas
from clipmart.operators import perf, silver
from clipmart.session import ensure_checkpoint_dir
from clipmart.sources import snapshots


def _run(writer) -> None:
    """Process all that is there.  ``availableNow`` ends by itself; until then
    there is no result to read, so the wait has no limit."""
    q = writer.trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def _rocksdb_state(spark: SparkSession):
    """The state store of streams that start meanwhile, unless the session names one."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    own = before is None or before.endswith("HDFSBackedStateStoreProvider")  # Spark's default
    if own:
        spark.conf.set(name, ROCKSDB)
    try:
        yield
    finally:
        if own:
            spark.conf.unset(name)


def bronze_to_silver(spark: SparkSession, src: str, out: str, ckpt: str, id_width: int = 3,
                     max_files: int | None = None, expire: str | None = None) -> None:
    """X1.  With ``expire`` (such as "30 days") an id is forgotten once
    ``load_ts`` has moved on that far, which bounds the state; an asset that
    comes again later than that would be taken again."""
    ensure_checkpoint_dir(spark)
    reader = spark.readStream.schema(schemas.BRONZE_ASSET_RAW)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    stream = reader.parquet(src)
    if expire:
        new = stream.withWatermark("load_ts", expire).dropDuplicatesWithinWatermark(["asset_id"])
    else:
        new = stream.dropDuplicates(["asset_id"])
    chunks = silver.clean(silver.explode_chunks(new, id_width))
    with _rocksdb_state(spark):
        _run(chunks.writeStream.format("parquet").outputMode("append").option("path", out).option("checkpointLocation", ckpt))


PERF_KEYS = ["ad_id", "platform_native", "perf_date"]


def perf_upsert(spark: SparkSession, src: str, out: str, ckpt: str, max_files: int | None = None) -> None:
    """``out`` is a versioned table, its folders partitioned by perf_date;
    ``snapshots.read`` gives the current rows."""
    ensure_checkpoint_dir(spark)
    reader = spark.readStream.schema(schemas.BRONZE_AD_PERF)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    stream = reader.parquet(src)

    def batch(df: DataFrame, epoch: int) -> None:
        # the order of perf.latest_pull: the last pull, of equal times the highest hash
        snapshots.append(perf.latest_pull(df, PERF_KEYS), out, PERF_KEYS, ["load_ts", "content_hash"], "perf_date",
                         mark=f"{ckpt}:{epoch}")

    _run(stream.writeStream.foreachBatch(batch).option("checkpointLocation", ckpt))


EVENTS = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType()),
])


def daily_counts_stream(events: DataFrame, delay: str = "1 hour") -> DataFrame:
    """X3 (the streaming DataFrame): watermark + 1-day tumbling window."""
    et, eid = F.col("event_type"), F.col("event_id")
    purchase = et == "purchase"
    ts = F.col("ts").cast("timestamp")
    return (events.withColumn("event_time", ts).withWatermark("event_time", delay)
            .groupBy(F.window("event_time", "1 day").alias("w"),
                     F.concat(F.lit("ad"), F.col("user_id").cast("string")).alias("ad_id"),
                     F.when(eid % 2 == 0, "meta").otherwise("tiktok").alias("platform_native"))
            .agg(F.count(F.lit(1)).alias("impressions"),
                 F.count_if(et.isin("view", "click", "purchase")).alias("plays_3s"),
                 F.count_if(et.isin("click", "purchase")).alias("plays_25"),
                 F.count_if(purchase).alias("plays_50"),
                 F.count_if(purchase & (eid % 4 < 2)).alias("plays_75"),
                 F.count_if(purchase & (eid % 8 < 2)).alias("plays_100"),
                 F.count_if(et == "view").alias("play_count"),
                 F.count_if(et == "click").alias("link_clicks"),
                 F.count_if(purchase).alias("results"),
                 F.sum(eid % 30).cast("decimal(18,3)").alias("sum_watch_time_sec"),
                 F.sum(F.col("value").cast("decimal(12,2)")).cast("decimal(18,2)").alias("spend"))
            .select(F.to_date(F.col("w.start")).alias("perf_date"), "ad_id", "platform_native",
                    *schemas.COUNTERS, "sum_watch_time_sec", "spend"))


def daily_counts(spark: SparkSession, src_dir: str, out: str, ckpt: str, delay: str = "1 hour",
                 glob: str = "events.parquet", max_files: int | None = None) -> None:
    """X3 job: file source -> windowed counts -> parquet sink (append)."""
    ensure_checkpoint_dir(spark)
    reader = spark.readStream.schema(EVENTS).option("pathGlobFilter", glob)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    stream = reader.parquet(src_dir)
    w = daily_counts_stream(stream, delay).writeStream.format("parquet").outputMode("append") \
        .option("path", out).option("checkpointLocation", ckpt)
    _run(w)


def paths(spark: SparkSession, tag: str) -> tuple[str, str, str]:
    """(source, output, checkpoint) folders for one run, under the shared
    checkpoint folder."""
    import uuid
    base = os.path.join(ensure_checkpoint_dir(spark), "streams", f"{tag}-{uuid.uuid4().hex}")
    return os.path.join(base, "src"), os.path.join(base, "out"), os.path.join(base, "ckpt")
