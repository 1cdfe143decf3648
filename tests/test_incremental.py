import datetime as dt

from clipmart.operators import incremental


def test_ttl_edges(spark):
    now = "2026-01-31 00:00:00"
    base = dt.datetime(2026, 1, 31)
    rows = [("c", "landing/c/video/a1.mp4", base - dt.timedelta(days=29, hours=23, minutes=45)),
            ("c", "landing/c/video/a2.mp4", base - dt.timedelta(days=30)),
            ("c", "landing/c/video/a3.mp4", base - dt.timedelta(days=31)),
            ("c", "landing/_golden/a4.mp4", base - dt.timedelta(days=90))]
    land = spark.createDataFrame(rows, "client_id string, key string, last_modified timestamp")
    clients = spark.createDataFrame([("c", 30)], "client_id string, landing_ttl_days int")
    bronze = spark.createDataFrame([("a2",)], "asset_id string")
    plan = {r.asset_id: r.action for r in incremental.ttl_plan(land, clients, bronze, now).collect()}
    assert plan == {"a1": "within_ttl", "a2": "delete", "a3": "skip_no_bronze"}


def test_embed_gate_keeps_unchanged_and_embeds_changed(spark):
    from clipmart.functions.identity import content_sha256
    s = spark.createDataFrame([("c1", "same text"), ("c2", "new text")], "chunk_id string, transcript_segment string")
    h = s.where("chunk_id = 'c1'").select("chunk_id", content_sha256("transcript_segment").alias("content_hash"))
    old = h.selectExpr("chunk_id", "content_hash", "array(cast(1.0 as float)) as embedding").unionByName(
        spark.createDataFrame([("c2", "stale", [1.0])], "chunk_id string, content_hash string, embedding array<float>"))
    out = {r.chunk_id: (r.status, len(r.embedding)) for r in incremental.embed(s, old, dim=8).collect()}
    assert out == {"c1": ("kept", 1), "c2": ("new", 8)}


def test_unextracted_requires_client(spark):
    m = spark.createDataFrame([("a", "c")], "asset_id string, client_id string")
    try:
        incremental.unextracted(m, m.select("asset_id"), "")
        raise AssertionError
    except ValueError:
        pass
