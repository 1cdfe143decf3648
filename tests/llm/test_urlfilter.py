import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from clipmart.llm import urlfilter

from ..conftest import SMALL

URLS = [
    (1, None), (2, "no scheme"), (3, ""), (4, "http://EXAMPLE.org"), (5, "http://example.org/es/x"), (6, "http://a.example.org/es/"),
    (7, "http://notexample.org/es/1"), (8, "http://example.org/en/1"), (9, "http://example.org/en/2"), (10, "http://com/fr/"),
    (11, "http://x.com/DE/"), (12, "http://x.com/de/?q#f"), (13, "http://x.net/fr/1"), (13, "http://x.net/fr/1"), (14, "x://h?y/z"),
    (15, "http://a.net/x://b.org/y"), (None, "http://x.net/de/9"), (16, "http://x.net/" + "abc/" * 5000), (17, "http://ÄB.org/é\nx"),
]


def by_definition(url):
    m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (re.sub("[A-Z]", lambda c: c[0].lower(), m[1]), m[2]) if m else ("", "")
    fits = [(h + p, v) for v, h, p in urlfilter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, *max(fits, key=lambda f: len(f[0]), default=(None, None))


@pytest.fixture(scope="module")
def urls(spark):
    return spark.createDataFrame([(k, u, "x", "y") for k, u in URLS], "page_id long, url string, text string, score string")


def test_rules(urls):
    got = urlfilter.by_rule(urlfilter.parsed(urls)).collect()
    want = sorted(((k or 0), *by_definition(u)) for k, u in URLS)
    assert sorted((r["page_id"] or 0, r["host"], r["path"], r["rule"], r["ruled"]) for r in got) == want


def test_substrings(spark):
    text = "ab" * 700
    got = Counter(r["s"] for r in urlfilter.substrings(spark.createDataFrame([(text,)], "text string")).collect())
    t, n = text + urlfilter.END, urlfilter.ORDER + 1
    assert got == Counter(t[i:i + k] for i in range(len(t)) for k in range(1, n + 1) if i + k <= len(t))


def test_ratio_by_definition(spark):
    train = {1: ["a.net/fr/1", "b.net/fr/22", "c.net/fr/3"], 0: ["a.net/de/1", "bb.net/de/4"]}
    model = urlfilter.learned(spark.createDataFrame([(t, ok) for ok, ts in train.items() for t in ts], "text string, ok long"))
    counts = {}
    for ok, ts in train.items():
        counts[ok] = Counter((t + urlfilter.END)[i:i + k] for t in ts for i in range(len(t) + 1)
                             for k in range(1, urlfilter.ORDER + 2) if i + k <= len(t) + 1)
    both = counts[0] + counts[1]
    kept = {ok: {s: n for s, n in c.items() if len(s) < 3 or both[s] >= urlfilter.LEAST} for ok, c in counts.items()}
    constant = model.where("s = ''").head()["w"]
    tests = ["a.net/fr/9", "", "zzz", "bb.net/de/1", "q" * 600]
    got = urlfilter.scored(spark.createDataFrame([(t, t) for t in tests], "text string, name string"),
                           model.where("s <> ''"), model.count(), constant).collect()
    assert len(got) == len(tests)
    for r in got:
        want = urlfilter.log_likelihood(r["name"], kept[1]) - urlfilter.log_likelihood(r["name"], kept[0])
        assert math.isclose(r["score"], want / (len(r["name"]) + 1), rel_tol=1e-9, abs_tol=1e-9)


def test_pages(spark, urls):
    pages = spark.read.parquet(f"{SMALL.replace('0.001', '0.1')}/pages.parquet").select("page_id", "url")
    out = urlfilter.filtered(pages.union(urls.select("page_id", "url"))).collect()
    assert len(out) == pages.count() + len(URLS)
    for r in out:
        assert r["verdict"] in ("allow", "block") and (r["score"] is None) == (r["rule"] is not None)
    free = [r for r in out if r["rule"] is None and "/es/" in r["path"]]
    assert sum(r["verdict"] == "block" for r in free) >= 0.8 * len(free)  # as the rules block /es/
    same = [r["verdict"] for r in out if r["page_id"] == 13 and r["path"] == "/fr/1"]
    assert len(same) == 2 and len(set(same)) == 1


def test_no_examples(spark, urls):
    out = urlfilter.filtered(urls.where("url LIKE '%.net/%' OR url IS NULL").where(~F.col("url").contains("org")))
    assert {r["verdict"] for r in out.collect()} == {"allow"}
    assert urlfilter.filtered(urls.limit(0)).collect() == []


def test_main_path_is_native(spark, urls):
    plan = urlfilter.filtered(urls)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_threshold():
    assert urlfilter.calibrated([(-5, 0, 10), (5, 10, 0)]) == 0
    assert urlfilter.calibrated([(3, 5, 0)]) == 0.0


def labelled(spark, rare, common=300):
    """Many allowed urls, a few blocked ones, and some without a rule."""
    rows = [f"http://s{i % 7}.com/fr/page{i}" for i in range(common)] + [f"http://bad.com/de/track{i}" for i in range(rare)]
    rows += [f"http://x.net/{w}{i}" for i in range(20) for w in ("fr/page", "de/track")]
    return spark.createDataFrame(list(enumerate(rows)), "page_id long, url string")


def test_learns_from_all_labelled_urls(spark, monkeypatch):
    pages = labelled(spark, 12)
    model, _, _, _ = urlfilter.fit(urlfilter.by_rule(urlfilter.parsed(pages)))
    assert model.where("s IN ('/track', '/page2', 'track1')").count() == 3
    out = urlfilter.filtered(pages).where("rule IS NULL").collect()
    assert all(r["verdict"] == ("block" if "/de/" in r["path"] else "allow") for r in out)


def test_same_scores_without_broadcasting_the_model(spark, monkeypatch):
    pages = urlfilter.by_rule(urlfilter.parsed(labelled(spark, 40)))
    model, rows, constant, _ = urlfilter.fit(pages)
    texts = pages.select("page_id", F.concat("path", "host").alias("text")).union(
        spark.createDataFrame([(-1, ""), (-2, "q" * 1300), (-3, "q" * 1300)], "page_id long, text string"))
    want = {r["page_id"]: r["score"] for r in urlfilter.scored(texts, model, rows, constant).collect()}
    for bound in (1, 50):
        monkeypatch.setattr(urlfilter, "MODEL_ROWS", bound)
        got = urlfilter.scored(texts, model, rows, constant).collect()
        assert len(got) == len(want) == texts.count()
        assert all(math.isclose(r["score"], want[r["page_id"]], rel_tol=1e-9, abs_tol=1e-9) for r in got)


def test_learns_from_long_urls(spark):
    long = "track/" * 500
    rows = [f"http://a.com/fr/page{i}" for i in range(40)] + [f"http://b.com/de/{long}{i}" for i in range(40)]
    free = ["http://x.net/fr/page7", "http://x.net/de/track/track/7"]
    out = urlfilter.filtered(spark.createDataFrame(list(enumerate(rows + free)), "page_id long, url string"))
    assert {r["path"]: r["verdict"] for r in out.where("rule IS NULL").collect()} == {
        "/fr/page7": "allow", "/de/track/track/7": "block"}
