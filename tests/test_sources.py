import os
import tempfile

import pytest

from clipmart import schemas
from clipmart.operators import incremental
from clipmart.sources import io


def test_bronze_append_is_idempotent(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="clipmart-bronze-"), "bronze")
    rows = [("a", "c", "{}", "m", "p", None, 0, None), ("b", "c", "{}", "m", "p", None, 0, None)]
    df = spark.createDataFrame(rows, schemas.BRONZE_ASSET_RAW)
    assert incremental.append_bronze(df, path) == 2
    assert incremental.append_bronze(df, path) == 0
    assert spark.read.parquet(path).count() == 2


def test_client_overwrite_leaves_other_clients(spark):
    root = tempfile.mkdtemp(prefix="clipmart-lake-")
    df = spark.createDataFrame([("x1", "c1"), ("x2", "c2")], "asset_id string, client_id string")
    io.write_table(df, root, "t")
    io.write_table(spark.createDataFrame([("y1", "c1")], "asset_id string, client_id string"), root, "t", "c1")
    got = sorted((r.asset_id, r.client_id) for r in spark.read.parquet(os.path.join(root, "t")).collect())
    assert got == [("x2", "c2"), ("y1", "c1")]
    with pytest.raises(ValueError):
        io.read_table(spark, root, "t", schemas.MAP_AD_ASSET, client_id="")


def written(tmp_path, **files):
    for name, text in files.items():
        (tmp_path / f"{name}.csv").write_text(text)
    return str(tmp_path)


def test_one_row_per_asset_inside_a_batch(spark):
    import datetime as dt
    path = os.path.join(tempfile.mkdtemp(prefix="clipmart-bronze-"), "bronze")
    at = lambda h: dt.datetime(2026, 1, 1, h)
    rows = [("a", "c", "second", "m", "p", None, 0, at(2)), ("a", "c", "first", "m", "p", None, 0, at(1)),
            ("a", "c", "undated", "m", "p", None, 0, None), ("b", "c", "{}", "m", "p", None, 0, None)] * 2
    df = spark.createDataFrame(rows, schemas.BRONZE_ASSET_RAW)
    assert incremental.append_bronze(df, path) == 2
    assert sorted((r.asset_id, r.raw_response) for r in spark.read.parquet(path).collect()) == [("a", "first"), ("b", "{}")]
    manifest = os.path.join(tempfile.mkdtemp(prefix="clipmart-manifest-"), "m")
    twice = spark.createDataFrame([("a", "x", at(2)), ("a", "y", at(1)), (None, "z", at(1))], "asset_id string, n string, ingested_at timestamp")
    assert io.append_manifest(twice, manifest) == 1 and io.append_manifest(twice, manifest) == 0
    assert [r.n for r in spark.read.parquet(manifest).collect()] == ["y"]


SEED = "client_id string, client_name string, landing_ttl_days int"


def test_seed_columns_by_name(spark, tmp_path):
    from pyspark.sql.types import _parse_datatype_string as parse
    schema = parse(SEED)
    path = written(tmp_path, a="client_id,client_name,landing_ttl_days\nc1,one,30\n",
                   b="landing_ttl_days,note,client_name,client_id\n7,x,\"two, 2\",c2\n", empty="")
    assert sorted(tuple(r) for r in io.read_seed(spark, path, schema).collect()) == [("c1", "one", 30), ("c2", "two, 2", 7)]
    bad = written(tmp_path / "..", other="client_id,landing_ttl_days\nc3,1\n")
    with pytest.raises(ValueError, match="client_name"):
        io.read_seed(spark, os.path.join(bad, "other.csv"), schema)
    text = written(tmp_path / "..", text="client_id,client_name,landing_ttl_days\nc3,n,soon\n")
    with pytest.raises(Exception, match="landing_ttl_days"):
        io.read_seed(spark, os.path.join(text, "text.csv"), schema).collect()
    twice = written(tmp_path / "..", twice="client_id,client_id,client_name,landing_ttl_days\na,b,c,1\n")
    with pytest.raises(ValueError, match="twice"):
        io.read_seed(spark, os.path.join(twice, "twice.csv"), schema)


def test_export_columns_by_name_and_quarantine(spark, tmp_path):
    path = written(tmp_path, a="ad_id,stat_time_day,impressions,spend,total_watch_time\nx,2026-01-01,10,1.50,3\ny,2026-01-01,many,2,\n",
                   b="spend,extra,impressions,stat_time_day,ad_id\n7.25,z,20,2026-01-02,v\n1,z,2,someday,w\n1,z,2,2026-01-03,\n")
    good = {r.ad_id: (str(r.perf_date), r.impressions, float(r.spend), r.plays_25) for r in io.read_export(spark, path, "tiktok").collect()}
    assert good == {"x": ("2026-01-01", 10, 1.5, None), "v": ("2026-01-02", 20, 7.25, None)}
    bad = sorted((str(r.ad_id), r.bad_fields) for r in io.quarantined_export(spark, path, "tiktok").collect())
    assert bad == [("None", ["ad_id"]), ("w", ["stat_time_day"]), ("y", ["impressions"])]
    lone = written(tmp_path / "..", lone="ad_id,spend\nx,1\n")
    with pytest.raises(ValueError, match="stat_time_day"):
        io.read_export(spark, os.path.join(lone, "lone.csv"), "tiktok")
