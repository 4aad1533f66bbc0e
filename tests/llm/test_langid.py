"""Language identification: features, clusters, rejection, held-out accuracy."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from liftworks.llm import langid

from conftest import frame

SYLLABLES = {
    "aa": ["ka", "to", "mi", "ru", "sen"],
    "bb": ["sch", "ung", "der", "ein", "pf"],
    "cc": ["ção", "nh", "lh", "os", "ês"],
    "dd": ["привет", "да", "мир", "во", "не"],
}


def speak(rng, lang, words):
    return " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randint(1, 4))) for _ in range(words))


@pytest.fixture(scope="module")
def spoken(spark):
    rng = random.Random(8)
    rows = [(i, lang, speak(rng, lang, rng.randint(3, 60))) for i, lang in enumerate(list(SYLLABLES) * 60)]
    # a group of copies, rows that teach nothing, repeated and null ids
    rows += [(1000 + i, "aa", rows[0][2]) for i in range(200)]
    rows += [(7, None, "ka to mi"), (None, "bb", "sch ung"), (8, "aa", None), (8, "aa", ""), (9, "bb", "12 ,. !")]
    return spark.createDataFrame(rows, "doc_id long, lang string, text string").repartition(3)


def plain_counts(text):
    flat = b" " + b" ".join("".join(
        c if ord(c) >= 128 or c.isalpha() else " " for c in text
    ).encode().lower().split()) + b" "
    return sum(max(0, len(flat) - n + 1) for n in langid.ORDERS)


def test_gram_counts(monkeypatch):
    for text in ("", "A b-C", "ñ é 12 x", "word " * 500):
        whole = langid.gram_counts(text.encode())
        assert whole[1].sum() == plain_counts(text)
        monkeypatch.setattr(langid, "STRETCH", 7)  # stretches overlap by what an n-gram needs
        cut = langid.gram_counts(text.encode())
        monkeypatch.undo()
        assert (whole[0] == cut[0]).all() and (whole[1] == cut[1]).all()
    assert (langid.gram_counts(b"AbC")[0] == langid.gram_counts(b"abc")[0]).all()


def test_letters():
    assert all(map(langid.has_letter, ["a".encode(), "1 ñ".encode(), "漢".encode()]))
    assert not any(map(langid.has_letter, [b"", b"123 !?", "№ ٣ 🙂".encode()]))


def test_clusters_find_groups():
    rng = np.random.default_rng(2)
    heads = np.eye(3, 40)
    x = np.abs(heads[rng.integers(0, 3, 300)] + rng.normal(0, 0.05, (300, 40)))
    x = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
    centers, least = langid.clusters(x, 3)
    assert sorted((centers @ heads.T).argmax(axis=1).tolist()) == [0, 1, 2]
    assert ((x @ centers.T).max(axis=1) >= least.min() - 1e-6).mean() > 0.98
    assert len(langid.clusters(np.repeat(x[:1], 5, axis=0), 3)[0]) == 1


def test_identify(spoken):
    rows = langid.identify(spoken).collect()
    assert len(rows) == spoken.count()
    truth = spoken.filter("lang is not null and length(text) > 9").groupBy("doc_id").agg(F.first("lang").alias("l"))
    truth = {r["doc_id"]: r["l"] for r in truth.collect() if r["doc_id"] is not None}
    for r in rows:
        known = r["doc_id"] is not None
        assert r["held_out"] == (known and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1
    held = [r for r in rows if r["held_out"] and r["doc_id"] in truth]
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) / len(held) > 0.97
    unknown = [r for r in rows if r["lang_pred"] == "und"]
    assert len(unknown) == 3 and all(r["score"] == 0 and r["rejected"] for r in unknown)


def test_labels_of_held_out_rows_are_not_used(spark, spoken):
    held = F.coalesce(langid.held_out(), F.lit(False))
    turned = spoken.withColumn("lang", F.when(held, F.lit("zz")).otherwise(F.col("lang")))
    assert sorted(map(str, langid.identify(turned).collect())) == sorted(map(str, langid.identify(spoken).collect()))


def test_unlike_texts_are_rejected(spark, spoken):
    model = langid.fit(spoken)
    texts = ["qqq zzz xxwqx qzx wwz", "кафе日本語のテキスト", speak(random.Random(1), "aa", 30)]
    odd = spark.createDataFrame(list(enumerate(texts, 1)), "id int, text string")
    out = {r["id"]: r for r in langid.predict(model, odd).collect()}
    assert out[1]["rejected"] and out[2]["rejected"] and not out[3]["rejected"]
    assert out[3]["lang_pred"] == "aa" and out[1]["lang_pred"] in SYLLABLES


def test_odd_tables(spark, docs, no_docs):
    assert langid.identify(no_docs).count() == 0
    rows = langid.identify(docs).collect()
    assert len(rows) == docs.count() and {r["lang_pred"] for r in rows} <= {"en", "und"}
    nothing = langid.identify(frame(spark, [(1, "some text"), (2, None)]).withColumn("lang", F.lit(None).cast("string")))
    assert {(r["lang_pred"], r["score"]) for r in nothing.collect()} == {("und", 0.0)}


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    both = langid.identify(docs).filter("held_out").join(docs.select("doc_id", "lang"), "doc_id").collect()
    right = [r["lang"] == r["lang_pred"] for r in both if r["lang_pred"] != "und"]
    assert len(right) > 150 and sum(right) / len(right) > 0.97
