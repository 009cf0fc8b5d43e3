"""Language identification: held-out accuracy, gradients, pooling over whole texts."""

import zlib

import numpy as np
from pyspark.sql import functions as F

from rollwise.llm import langid
from tests.conftest import SF_MID


def test_gradients_match_differences():
    rng = np.random.default_rng(0)
    unit = langid.Direction(rng, 3)
    unit.w, unit.u = unit.w.astype(float), unit.u.astype(float)
    x, up = rng.integers(97, 105, size=(6, 4)), rng.standard_normal((6, 4, 3))
    dw, du = unit.backward(x, unit.forward(x, keep=True)[1], up)
    for arr, grad in ((unit.w, dw), (unit.u, du)):
        for i in rng.choice(np.flatnonzero(grad), 5):
            at, kept = np.unravel_index(i, arr.shape), arr.flat[i]
            ends = []
            for step in (1e-2, -1e-2):
                arr[at] = kept + step
                ends.append(float((unit.forward(x)[0] * up).sum()))
            arr[at] = kept
            assert abs((ends[0] - ends[1]) / 2e-2 - grad[at]) < 2e-2 * max(1, abs(grad[at]))


def test_held_out_accuracy_and_edges(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    odd = [(None, "The and of", None), (10**7, None, "en"), (10**7 + 1, "12 34 --", "en"), (10**7 + 2, "", None), (10**7 + 2, "", None)]
    extra = spark.createDataFrame(odd, "doc_id long, text string, lang string").withColumns({"source": F.lit("x"), "n_chars": F.lit(1)})
    both = docs.unionByName(extra).withColumn("score", F.lit("clash"))
    out = langid.predict(both).collect()
    assert len(out) == docs.count() + 5
    truth = {r["doc_id"]: r["lang"] for r in docs.collect()}
    held = [r for r in out if r["held_out"] and r["doc_id"] in truth]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in out if r["doc_id"] is not None)
    assert np.mean([truth[r["doc_id"]] == r["lang_pred"] for r in held]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in out)
    edge = {r["doc_id"]: r for r in out if r["doc_id"] is None or r["doc_id"] >= 10**7}
    assert not edge[None]["held_out"] and edge[None]["lang_pred"] != "und"
    assert all(edge[10**7 + i]["lang_pred"] == "und" and edge[10**7 + i]["score"] == 0 for i in range(3))


def test_nothing_to_learn_from(spark):
    df = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    assert [r["lang_pred"] for r in langid.predict(df).collect()] == ["und"]
    assert langid.predict(df.limit(0)).count() == 0


def test_long_texts_are_pooled_whole():
    model = langid.Model(["a", "b"])
    texts = ["abc def " * 40_000, "é", "1 2", None, "x" * 63 + "1"]
    got = list(model.documents(texts))
    assert got[2] == got[3] == (-1, 0.0)
    for text, (lang, score) in zip(texts, got):
        if lang >= 0:
            raw = np.frombuffer(text.encode(), np.uint8)
            rows = np.full(-(-len(raw) // langid.WINDOW) * langid.WINDOW, langid.PAD)
            rows[: len(raw)] = raw
            x = rows.reshape(-1, langid.WINDOW)
            p = model.probabilities(x.T).transpose(1, 0, 2)[langid.IS_LETTER[x]].astype(float).mean(axis=0)
            assert lang == p.argmax() and abs(p.max() - score) < 1e-4


def test_every_language_has_its_quota_and_windows_lie_anywhere(spark):
    # An id whose draw among 2^20 values is small: with equal ids a whole language used to draw the same.
    ids = spark.range(1, 200_000).filter("crc32(cast(cast(id AS string) AS binary)) % 5 <> 0")
    least = ids.orderBy(F.expr("pmod(xxhash64(cast(id AS string)), 1048576)")).first()["id"]
    rows = [(least, f"aa{i} " * 40, "aa") for i in range(200)] + [(i, f"zz{i} " * 40, "zz") for i in range(1, 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    languages, windows, labels = langid.training_sample(df, 8)
    assert languages == ["aa", "zz"] and np.bincount(labels).tolist() == [4, 4]
    far = spark.createDataFrame([(i, "x" * 1000 + "y" * 9000, "aa") for i in range(50)], "doc_id long, text string, lang string")
    _, windows, _ = langid.training_sample(far, 40)
    assert (windows == ord("y")).mean() > 0.5


def test_sample_stays_bounded_with_many_languages(spark):
    rows = spark.range(9000).selectExpr("id AS doc_id", "concat('text number ', id, ' of some length, long enough for a window of bytes and more') AS text", "concat('l', lpad(CAST(id % 3000 AS STRING), 4, '0')) AS lang")
    often = spark.range(400).selectExpr("id + 100000 AS doc_id", "concat('often seen ', id) AS text", "'often' AS lang")
    languages, windows, labels = langid.training_sample(rows.union(often))
    assert len(windows) == len(labels) <= langid.TRAIN_WINDOWS and len(languages) == langid.LANGUAGES and "often" in languages
    assert len(set(labels.tolist())) == len(languages)
    few, windows, _ = langid.training_sample(rows.union(often), train_windows=20)
    assert len(few) <= 20 and len(windows) <= 20
