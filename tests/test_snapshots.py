import os
import uuid

import pytest

from clipmart.session import scratch_path
from clipmart.sources import snapshots
from clipmart.streaming import jobs


@pytest.fixture
def base(spark):
    return scratch_path(spark, f"table-{uuid.uuid4().hex}")


def rows(spark, *data):
    return spark.createDataFrame(data, "k int, day string, t int, v string")


def seen(spark, base, version=None, where=None):
    return sorted(tuple(r) for r in snapshots.read(spark, base, version, where).collect())


def test_one_late_row_is_one_small_folder(spark, base):
    first = rows(spark, *((i, "d1", 1, "a") for i in range(50)))
    assert snapshots.append(first, base, ["k", "day"], ["t"], "day") == 1
    files = {f for f in snapshots.read(spark, base).inputFiles()}
    assert snapshots.append(rows(spark, (3, "d1", 2, "b"), (4, "d1", 0, "older")), base, ["k", "day"], ["t"], "day") == 2
    assert files < set(snapshots.read(spark, base).inputFiles())  # no stored file was written again
    now = seen(spark, base)
    assert len(now) == 50 and (3, "d1", 2, "b") in now and (4, "d1", 1, "a") in now
    assert (3, "d1", 1, "a") in seen(spark, base, 1)  # a reader of version 1 keeps it
    assert seen(spark, base, where="day = 'd2'") == []


def test_a_failed_write_is_never_visible(spark, base, monkeypatch):
    snapshots.append(rows(spark, (1, "d", 1, "a")), base, ["k"], ["t"])
    monkeypatch.setattr(snapshots, "commit", lambda *a: (_ for _ in ()).throw(OSError("storage")))
    with pytest.raises(OSError):
        snapshots.append(rows(spark, (2, "d", 1, "b")), base, ["k"], ["t"])
    monkeypatch.undo()
    assert snapshots.versions(spark, base) == [1] and seen(spark, base) == [(1, "d", 1, "a")]
    assert len(snapshots.vacuum(spark, base)) == 1  # the folder without a version


def test_of_two_writers_one_goes_on_from_the_other(spark, base, monkeypatch):
    snapshots.append(rows(spark, (1, "d", 1, "a")), base, ["k"], ["t"])
    commit, raced = snapshots.commit, []

    def second_first(spark_, base_, about):
        if not raced:
            raced.append(1)
            snapshots.append(rows(spark, (2, "d", 1, "other")), base, ["k"], ["t"])
        return commit(spark_, base_, about)

    monkeypatch.setattr(snapshots, "commit", second_first)
    assert snapshots.append(rows(spark, (3, "d", 1, "own")), base, ["k"], ["t"]) == 3
    assert [r[0] for r in seen(spark, base)] == [1, 2, 3]
    with pytest.raises(snapshots.Conflict):
        commit(spark, base, {**snapshots.manifest(spark, base), "version": 2})
    assert snapshots.versions(spark, base) == [1, 2, 3]


def test_marks_compaction_and_vacuum(spark, base):
    assert snapshots.append(rows(spark, (1, "d", 1, "a")), base, ["k"], ["t"], mark="s:0") == 1
    assert snapshots.append(rows(spark, (1, "d", 9, "again")), base, ["k"], ["t"], mark="s:0") == 1  # a retried batch
    assert snapshots.append(rows(spark, (1, "d", 2, "b")), base, ["k"], ["t"], mark="s:1") == 2
    assert snapshots.compact(spark, base) == 3 and snapshots.compact(spark, base) == 3
    assert len(snapshots.manifest(spark, base)["folders"]) == 1 and seen(spark, base) == [(1, "d", 2, "b")]
    assert snapshots.replace(rows(spark, (7, "d", 1, "new")), base, ["k"], ["t"]) == 4
    assert seen(spark, base) == [(7, "d", 1, "new")] and seen(spark, base, 3) == [(1, "d", 2, "b")]
    assert len(snapshots.vacuum(spark, base, keep=1)) == 3 and snapshots.versions(spark, base) == [4]
    with pytest.raises(ValueError):
        snapshots.read(spark, base, 3)
    with pytest.raises(ValueError):
        snapshots.read(spark, base + "-none")


def test_stream_batches_become_versions(spark):
    import datetime as dt

    from clipmart import schemas
    src, out, ckpt = jobs.paths(spark, "x2-test")
    row = lambda ad, day, n, hour: (ad, dt.date(2026, 1, day), "meta", *([n] * 9), None, None,
                                    dt.datetime(2026, 2, 1, hour), "f", str(n))
    for i, some in enumerate(([row("a", 1, 1, 1), row("b", 1, 2, 1), row("a", 2, 3, 1)], [row("a", 1, 5, 2), row("b", 1, 9, 0)])):
        spark.createDataFrame(some, schemas.BRONZE_AD_PERF).coalesce(1).write.parquet(os.path.join(src, str(i)))
        jobs.perf_upsert(spark, src + "/*", out, ckpt, max_files=1)
    jobs.perf_upsert(spark, src + "/*", out, ckpt, max_files=1)  # nothing new: no version
    assert snapshots.versions(spark, out) == [1, 2]
    now = {(r.ad_id, r.perf_date.day): r.impressions for r in snapshots.read(spark, out).collect()}
    assert now == {("a", 1): 5, ("b", 1): 2, ("a", 2): 3}
