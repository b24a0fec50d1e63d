"""Language model on held-out rows; pipeline stages against plain Python."""

import sys
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from crawlcat.llm import language, queries

import corpus_pipeline


def test_counts_are_those_of_each_text():
    texts = ["The cat", "", "É, é!", "ab", "The cat sat. The cat ran " * 9, "123"]
    together = language.counts(pa.array(texts))
    for t, row in zip(texts, together):
        assert np.array_equal(language.counts(pa.array([t]))[0], row)
    assert np.array_equal(together[0], language.counts(pa.array(["THE  cat"]))[0]) or together[0].sum() > 0
    assert together[1].sum() == 0 and together[5].sum() == 0


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = queries.QUERIES["op10_centroid_language"](spark, sf).collect()
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert len(got) == len(docs)
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and 0 <= r["score"] <= 1
    held = [r for r in got if r["held_out"]]
    right = np.mean([r["lang_pred"] == docs[r["doc_id"]]["lang"] for r in held])
    assert right >= 0.97, right
    assert np.mean([r["rejected"] for r in got]) <= 0.02


def test_odd_texts_and_models(spark, sf_dir):
    train = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    model = language.fit(train.unionByName(spark.createDataFrame([(1, None, "en"), (2, "abc", None), (3, "", "zz")], "doc_id long, text string, lang string")))
    assert model.languages == ("de", "en", "es", "fr")
    rows = [(1, None), (2, ""), (3, "12 34 !?"), (4, "漢字かな交じり文です。" * 30), (5, "the"), (None, "der und die " * 3000), (7, "qzxj kvqz xxzq wqvk " * 50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' as lang_pred", "1 as score", "'y' as rejected", "2 as __text", "map('a', 1) as lang")
    got = {r["doc_id"]: r for r in language.identify(docs, model, *docs.columns).collect()}
    assert set(got[1].asDict()) == {"doc_id", "text", "__text", "lang", "lang_pred", "score", "rejected"}
    kept = language.recognised(docs, model)
    assert kept.schema == docs.schema and {r["doc_id"] for r in kept.collect()} == {i for i, r in got.items() if not r["rejected"]}
    assert [got[i]["lang_pred"] for i in (1, 2, 3)] == ["und"] * 3 and all(got[i]["rejected"] and got[i]["score"] == 0 for i in (1, 2, 3))
    assert got[4]["rejected"] and got[4]["lang_pred"] in model.languages and got[None]["lang_pred"] == "de" and not got[None]["rejected"]
    none = language.fit(train.where("false"))
    out = language.identify(docs.select("doc_id", "text"), none).collect()
    assert all(r["rejected"] and r["lang_pred"] == "und" for r in out)
    assert language.identify(docs.where("false").select("doc_id", "text"), model).count() == 0


def plain_model(rows):
    """Frequencies, centroids and thresholds of (text, lang) rows by loops."""
    model = {}
    texts = [(t, k) for t, k in rows if t and any(c.isalpha() for c in t)]
    c = np.stack([language.counts(pa.array([t]))[0] for t, _ in texts]).astype(np.float64)
    idf = np.log((1 + len(c)) / (1 + (c > 0).sum(axis=0))) + 1
    v = np.sqrt(c) * idf
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    for lang in sorted({k for _, k in texts}):
        own = v[[k == lang for _, k in texts]]
        chosen = [int((own @ own.mean(axis=0)).argmax())]
        while len(chosen) < min(language.CENTROIDS, len(own)):
            chosen.append(int(np.max([own @ own[i] for i in chosen], axis=0).argmin()))
        centres = own[chosen]
        for _ in range(language.ROUNDS):
            near = [int(np.argmax([x @ y for y in centres])) for x in own]
            sums = [sum((x for x, k in zip(own, near) if k == i), np.zeros(language.DIMS)) for i in range(len(centres))]
            centres = np.stack([s / np.linalg.norm(s) if np.linalg.norm(s) else y for s, y in zip(sums, centres)])
        model[lang] = centres
    return idf, model


def test_prediction_equals_a_plain_one(spark, sf_dir):
    rows = [(r["text"], r["lang"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    seen = list(dict.fromkeys(rows))[:120]
    model = language.fit(spark.createDataFrame(seen + seen[:30], "text string, lang string"))
    idf, centres = plain_model(seen)
    asked = spark.createDataFrame(list(enumerate(t for t, _ in rows)), "doc_id long, text string")
    near = 0
    for r in language.identify(asked, model).collect():
        c = np.sqrt(language.counts(pa.array([rows[r["doc_id"]][0]]))[0].astype(np.float64)) * idf
        best = {k: float((own @ c).max() / max(np.linalg.norm(c), 1e-9)) for k, own in centres.items()}
        if r["lang_pred"] != "und":
            assert abs(r["score"] - max(best.values())) < 1e-3 and best[r["lang_pred"]] > max(best.values()) - 1e-3
            near += 1
    assert near > 150


def test_more_languages_than_sample(spark, monkeypatch):
    monkeypatch.setattr(language, "SAMPLE_TEXTS", 20)
    rows = [(f"{chr(97 + k % 26)}{chr(97 + k // 26)} " * 8 + f"n{chr(97 + i)}", f"l{k:02d}") for k in range(60) for i in range(5)]
    model = language.fit(spark.createDataFrame(rows, "text string, lang string"))
    assert len(model.languages) == 60 and len(model.centroids) == 60
    got = language.identify(spark.createDataFrame([(i, t) for i, (t, _) in enumerate(rows)], "doc_id long, text string"), model).collect()
    assert np.mean([r["lang_pred"] == rows[r["doc_id"]][1] for r in got]) == 1


def test_clean_one_word_texts_stay(spark, sf_dir):
    train = spark.read.parquet(f"{sf_dir}/documents.parquet").select("text", "lang")
    few = spark.createDataFrame([("Zwölf.", "de"), ("Why.", "en"), ("Muy.", "es"), ("Où.", "fr")], "text string, lang string")
    model = language.fit(train.unionByName(few))
    asked = ["This.", "Re.", "Edrere.", "Éaux.", "In. The.", "Der.", "Los.", "Le."]
    got = language.identify(spark.createDataFrame(list(enumerate(asked)), "doc_id long, text string"), model).collect()
    assert [asked[r["doc_id"]] for r in got if r["rejected"]] == []


def test_pipeline_stages(spark, sf_dir):
    from tests.llm.test_jaccard import brute
    from tests.llm.test_spans import secret_base

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, rows = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r["doc_id"]: r for r in docs.collect()}
        docs = spark.createDataFrame(stage(spark, docs, sf_dir).collect(), docs.schema)
        after = {r["doc_id"]: r for r in docs.collect()}
        assert docs.columns == columns and docs.count() == len(after) and set(after) <= set(before), name
        if name == "language ID":
            assert len(after) >= 0.98 * rows
        if name == "n-gram Jaccard join":
            assert set(after) == {c for c, _ in brute([(i, r["text"]) for i, r in before.items()]).values()}
        if name == "benchmark decontamination":
            bench = [r["text"] for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
            assert set(before) - set(after) == {i for i, r in before.items() if any(b in r["text"] for b in bench)}
        if name == "secret scans":
            assert set(after) == set(before)
            for i, r in before.items():
                found = any(secret_base(r["text"]))
                assert found or after[i]["text"] == r["text"]
                assert not found or after[i]["text"] != r["text"]
                assert after[i]["n_chars"] == len(after[i]["text"])
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    whole = corpus_pipeline.run(spark, sf_dir)
    key = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    assert sorted(map(tuple, pieces.select(*key).collect())) == sorted(map(tuple, whole.select(*key).collect()))
    assert pieces.groupBy("doc_id").agg((F.sum("length") == F.first("doc_tokens")).alias("ok")).where("not ok").count() == 0


def test_stages_on_hostile_rows(spark, sf_dir):
    words = [" ".join(f"wort{chr(97 + k)}{chr(97 + i)}" for i in range(20)) for k in range(4)]
    secret = "token = 0123456789abcdef0123456789abcdef"
    rows = [(None, words[0], None), (None, words[1], "de"), (5, words[2], "de"), (5, words[3], "de"), (6, None, "de"), (6, None, "de"), (7, "", None), (8, "?! 12", "de"), (9, f"{words[1]} {words[1]} {secret}", "de"), (9, f"{words[1]} {words[1]} {secret}", "de")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "'s' as source", "cast(length(text) as long) as n_chars", "1 as score", "true as rejected", "'x' as key", "2 as spans", "3 as _key", "4 as text_hash", "5 as label", "6 as item_id", "map('a', 7) as first")
    want = {"language ID": 6, "n-gram Jaccard join": 7, "benchmark decontamination": 10, "secret scans": 10, "packing": None}
    for name, stage in corpus_pipeline.STAGES:
        got, none = stage(spark, docs, sf_dir), stage(spark, docs.where("false"), sf_dir)
        assert none.count() == 0, name
        if name != "packing":
            assert got.columns == none.columns == docs.columns and got.count() == want[name], (name, got.count())
        else:
            assert got.select("doc_id", "text" if "text" in got.columns else "start").count() >= len(rows) and got.where("doc_id = 6").count() == 2
        if name == "secret scans":
            texts = [r["text"] for r in got.where("doc_id = 9").collect()]
            assert texts == [f"{words[1]} {words[1]} [assign]"] * 2 and got.where("doc_id = 6 and text is null and n_chars is null").count() == 2
        if name == "n-gram Jaccard join":
            assert sorted(r["text"] or "" for r in got.collect()) == sorted(["", "?! 12", *words, rows[8][1]])
