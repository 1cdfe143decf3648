from clipmart.llm import langid


def test_held_out_accuracy(spark, small):
    model = langid.fit(small)
    assert sorted(model.dictionaries) == ["de", "en", "es", "fr"]
    out = langid.predict(small, model).withColumn("held", langid.held_out(small["doc_id"])).collect()
    held = [r for r in out if r["held"] and r["text"]]
    assert len(held) > 20
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.9 * len(held)
    assert all(0 <= r["score"] <= 1 for r in out)
    assert sum(r["rejected"] for r in out) <= 0.1 * len(out)


def test_learns_from_its_part_only(spark, small):
    from pyspark.sql import functions as F

    other = small.withColumn("lang", F.when(langid.held_out(F.col("doc_id")), F.lit("xx")).otherwise(F.col("lang")))
    assert langid.fit(other).dictionaries == langid.fit(small).dictionaries


def test_edges(spark, small, edges):
    model = langid.fit(small)
    out = langid.predict(edges, model)
    assert set(edges.columns) - {"score", "rejected", "lang_pred"} < set(out.columns)
    rows = out.collect()
    assert len(rows) == edges.count()
    for r in rows:
        if r["doc_id"] in (1, 2, 3, 4):
            assert (r["lang_pred"], r["score"], r["rejected"]) == ("und", 0.0, True)
        else:
            assert r["lang_pred"] in model.dictionaries
    assert len({(r["lang_pred"], r["score"]) for r in rows if r["text"] == "one"}) == 1


def test_nothing_to_learn(spark, small):
    none = langid.fit(small.limit(0))
    assert none.dictionaries == {}
    assert {r["lang_pred"] for r in langid.predict(small.limit(5), none).collect()} == {"und"}
    assert langid.predict(small.limit(0), none).collect() == []
    one = langid.LanguageModel({"en": b"the and of"})
    assert [(r["lang_pred"], r["score"]) for r in langid.predict(small.where("text <> ''").limit(1), one).collect()] == [("en", 1.0)]


def test_tie_goes_to_the_first():
    import pandas as pd

    same = {"b": b"the and of " * 20, "a": b"the and of " * 20}
    out = next(langid.classifier(same)(iter([pd.Series(["the and of the", None, "..."])])))
    assert out.values.tolist() == [["a", 0.0], ["und", 0.0], ["und", 0.0]]


def test_margin():
    assert langid.narrowest([(0.5, True)] * 50) == langid.FLOOR
    assert 0.01 < langid.narrowest([(0.01, False)] * 3 + [(0.005, True)] + [(0.5, True)] * 50) < 0.5


def test_margin_from_all_other_labelled_rows(spark, small, monkeypatch):
    from pyspark.sql import functions as F

    seen, predict = [], langid.predict
    monkeypatch.setattr(langid, "predict", lambda docs, *a, **k: seen.append(docs.count()) or predict(docs, *a, **k))
    monkeypatch.setattr(langid, "EXCERPTS", 20)
    monkeypatch.setattr(langid, "CALIBRATION", 5, raising=False)
    learned = small.where(~langid.held_out(F.col("doc_id")) & F.col("text").isNotNull() & F.col("lang").isNotNull())
    langid.fit(small)
    used = [r["h"] for r in learned.select("lang", F.xxhash64("text").alias("h")).distinct().orderBy("lang", "h").collect()]
    langs = [r["lang"] for r in learned.select("lang", F.xxhash64("text").alias("h")).distinct().orderBy("lang", "h").collect()]
    first = {h for i, (n, h) in enumerate(zip(langs, used)) if i - langs.index(n) < min(20, -(-3 * langs.count(n) // 4))}
    want = learned.where(~F.xxhash64("text").isin(first)).count()
    assert seen == [want] and want > 4 * 5
    monkeypatch.setattr(langid, "EXCERPTS", 10**6)  # fewer texts than that: some still set the margin
    langid.fit(small)
    assert seen[1] > 0


def test_margin_counts_repeated_scores():
    many = [(0.01, False)] * 3 + [(0.01, True)] * 2 + [(0.5, True)] * 50
    assert langid.narrowest([(0.01, False, 3), (0.01, True, 2), (0.5, True, 50)]) == langid.narrowest(many) > 0.01
    assert langid.narrowest([(0.01, False, 1), (0.01, True, 9)]) == langid.FLOOR
