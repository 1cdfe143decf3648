from clipmart.operators import dq, lineage, reconcile


def test_checks_red_then_green(spark):
    bad = spark.createDataFrame([("a", 1, "calm"), ("a", 9, "angry"), (None, None, None)],
                                "chunk_id string, standalone_score int, sentiment string")
    good = spark.createDataFrame([("a", 1, "calm"), ("b", 5, None)],
                                 "chunk_id string, standalone_score int, sentiment string")
    for df, want in ((bad, (1, 1, 1, 1)), (good, (0, 0, 0, 0))):
        got = (dq.not_null(df, "chunk_id").count(), dq.unique(df, "chunk_id").count(),
               dq.between(df, "standalone_score", 1, 5).count(),
               dq.accepted_values(df, "sentiment", dq.SENTIMENTS).count())
        assert got == want
    assert dq.row_count_floor(good.limit(0), 1).count() == 1
    assert dq.row_count_floor(good, 1).count() == 0


def test_orphans_treat_null_key_as_orphan_and_relationships_skip_null(spark):
    child = spark.createDataFrame([("x",), (None,), ("y",)], "chunk_id string")
    parent = spark.createDataFrame([("x",)], "chunk_id string")
    assert dq.orphans(child, parent, "chunk_id").count() == 2
    assert dq.relationships(child, "chunk_id", parent, "chunk_id").count() == 1


def test_run_metrics_and_enforce(spark):
    df = spark.createDataFrame([("a",), ("a",)], "chunk_id string")
    m, f = dq.run([dq.Check("u", "error", dq.unique(df, "chunk_id")),
                   dq.Check("n", "warn", dq.not_null(df, "chunk_id"))])
    st = {r.check_id: (r.failed, r.status) for r in m.collect()}
    assert st == {"u": (1, "fail"), "n": (0, "pass")}
    try:
        dq.enforce(m)
        raise AssertionError("should raise")
    except RuntimeError:
        pass


def test_quarantine_reasons(spark):
    df = spark.createDataFrame(
        [("a", 0.0, 1.0, "t", " ", "calm", 7, ["x"], ["k"]), ("b", 0.0, 1.0, "t", "Hook", "calm", 3, ["x"], ["k"])],
        "chunk_id string, start_sec double, end_sec double, transcript_segment string, chunk_theme string, "
        "sentiment string, standalone_score int, next_compatible_themes array<string>, keywords array<string>")
    ok, bad = dq.quarantine(df)
    assert [r.chunk_id for r in ok.collect()] == ["b"]
    assert bad.collect()[0].reasons == ["score_out_of_range", "theme_empty"]


def test_lineage_rules_one_each(spark):
    import hashlib
    sha = hashlib.sha256(b"x").hexdigest()
    aid = hashlib.sha256(f"c1:{sha}".encode()).hexdigest()
    good = (1, aid, "c1", sha, "RAW", f"s3://b/landing/c1/video/{aid}.mp4")
    rows = [good,
            (2, aid, "c1", sha, "RAW", f"s3://b/landing/c1/video/{aid}.mp4"),            # R6
            (3, "nothex", "c1", sha, "RAW", f"s3://b/landing/c1/video/{aid}.mp4"),       # R2, R3, R4
            (4, aid, "", sha, "RAW", f"s3://b/landing/c1/video/{aid}.mp4"),              # R1, R4, R7
            (5, aid, "zz", sha, "RAW", f"s3://b/landing/c1/video/{aid}.mp4")]            # R3, R4, R5
    m = spark.createDataFrame(rows, "row_pos long, asset_id string, client_id string, content_sha256 string, "
                                    "asset_type string, source_uri string")
    clients = spark.createDataFrame([("c1",)], "client_id string")
    v = lineage.violations(m, clients).collect()
    got = {(r.row_pos, r.rule) for r in v}
    assert (1, "R1") not in got and not any(p == 1 for p, _ in got)
    assert {(2, "R6"), (3, "R2"), (4, "R1"), (4, "R7"), (5, "R5"), (5, "R3")} <= got


def test_reconcile_equal_counts_different_multiset(spark):
    a = spark.createDataFrame([("x",), ("x",), ("y",)], "k string")
    b = spark.createDataFrame([("x",), ("y",), ("y",)], "k string")
    t = reconcile.tables({"t": (a, b, ["k"])}).collect()[0]
    assert (t.left_rows, t.right_rows, t.only_left, t.only_right, t.status) == (3, 3, 1, 1, "key_mismatch")
