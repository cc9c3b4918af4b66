import zlib

import numpy as np
import pytest
from helpers import DOCS, clashing
from pyspark.sql import functions as F

from cohortframe.llm import langid as L, queries
from cohortframe.llm.ngrams import hashed, packed

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    return queries.language_model(spark.read.parquet(f"{SF}/documents.parquet"))


def test_ngrams_and_packing():
    data = np.frombuffer(b"abcabc", np.uint8)
    assert (hashed(data, 3, 16)[0] == hashed(data, 3, 16)[3]) and len(hashed(data, 7, 16)) == 0 and hashed(data, 2, 8).max() < 256
    parts = list(packed([b"abcdefgh", b"", b"ij"], 3))
    joined = {}
    for d, starts, index in parts:
        for k, (i, s) in enumerate(zip(index, starts)):
            end = starts[k + 1] if k + 1 < len(starts) else len(d)
            joined[i] = joined.get(i, b"") + d[s:end].tobytes()
    assert joined == {0: b"abcdefgh", 1: b"", 2: b"ij"}


def test_held_out_accuracy(spark, model):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    held = docs.filter(queries.held_out())
    rows = held.select("doc_id").collect()
    assert rows and all(zlib.crc32(str(r[0]).encode()) % 4 == 2 for r in rows)
    got = L.predict(held, model).join(docs.select("doc_id", "lang"), "doc_id").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.min("score"), F.max("score")).first()
    assert got[0] > 0.97 and 0 <= got[1] <= got[2] <= 1


def test_a_prediction_depends_on_its_text_alone(model):
    texts = ["Der Hund und die Katze " * k for k in range(1, 30)] + ["the cat of that was in", "x"]
    together = model.predict(texts)
    for i, t in enumerate(texts):
        alone = model.predict([t])
        assert alone[0][0] == together[0][i] and alone[1][0] == pytest.approx(together[1][i], abs=1e-9)


def test_a_long_text_counts_whole(model, monkeypatch):
    text = "und der die ist nicht " * 3000
    want = model.predict([text])
    monkeypatch.setattr(L, "BYTES", 1000)
    got = model.predict([text])
    assert got[0] == want[0] and got[1][0] == pytest.approx(want[1][0], abs=1e-3)


def test_rows_without_letters_and_rejection(make, spark, model):
    rows = [(1, "the and of that is in with"), (2, None), (3, ""), (4, "123 !?"), (5, "the and of that is in with"), (5, "the and of that is in with"), (None, "the of and")]
    got = L.predict(clashing(make(rows)), model).collect()
    assert len(got) == len(rows)
    by = {r["doc_id"]: r for r in got}
    assert all(by[i]["lang_pred"] == "und" and by[i]["score"] == 0 and by[i]["rejected"] for i in (2, 3, 4))
    assert by[1]["lang_pred"] == "en" and not by[1]["rejected"]
    docs = clashing(make(rows))
    kept = L.keep_known(docs, model)
    assert kept.columns == docs.columns and sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "5", "5", "None"]


def test_empty_tables(spark, model):
    none = spark.createDataFrame([], DOCS)
    empty = L.fit(none)
    assert empty.languages == [] and empty.predict(["word"])[0] == ["und"]
    assert L.predict(none, model).collect() == [] and L.keep_known(none, model).collect() == []
    one = L.train(["alpha beta gamma"], ["aa"])
    assert one.predict(["alpha"])[0] == ["aa"]


def test_uses_no_label_of_the_held_out_fold(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(200)
    wrong = docs.withColumn("lang", F.when(queries.held_out(), F.lit("zz")).otherwise(F.col("lang")))
    assert "zz" not in queries.language_model(wrong).languages


def slow_prediction(model, text):
    """Every n-gram looked up by itself, in plain numbers."""
    data = b" " + "".join(c if c.isalpha() or ord(c) > 127 else " " for c in text.lower()).encode() + b"    "
    total, count = [0.0] * len(model.languages), 0
    for n in (1, 2, 3, 4):
        for at in range(len(data) - 3):
            h = n * 0x85EBCA6B & 0xFFFFFFFF
            for c in data[at:at + n]:
                h = (h ^ c) * 0x9E3779B1 & 0xFFFFFFFF
                h ^= h >> 15
            count += 1
            for k, v in enumerate(model.table[h >> 16]):
                total[k] += float(v)
    z = [(t / count + b) / model.temperature for t, b in zip(total, model.bias.tolist())]
    e = [np.exp(x - max(z)) for x in z]
    return model.languages[int(np.argmax(z))], max(e) / sum(e)


def test_predictions_match_brute_force(model):
    texts = ["the and of that", "Der Hund, und die Katze!", "x", "él niño está aquí 12", "la de les où ça", "ÀÉ\n\tÖ", "a" * 300]
    lang, score, low = model.predict(texts)
    for i, t in enumerate(texts):
        want, p = slow_prediction(model, t)
        assert lang[i] == want and score[i] == pytest.approx(p, abs=1e-4) and low[i] == (score[i] < model.reject)
