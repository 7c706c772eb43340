"""Language identification against plain dictionaries, and held-out accuracy."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from searchlake.llm import language_id as li

EN = "the cat and the dog run over this hill with their friends while it rains".split()
DE = "der hund und die katze laufen über den berg mit ihren freunden während es regnet".split()
FR = "le chien et le chat courent sur la colline avec leurs amis pendant la pluie élève".split()


def corpus(spark, n=120):
    rows = []
    for i in range(n):
        lang, words = [("en", EN), ("de", DE), ("fr", FR)][i % 3]
        rows.append((i, " ".join(words[(i * k) % len(words)] for k in range(1, 12)), lang))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


class Plain:
    """The same model with dictionaries of strings."""

    def __init__(self, rows):
        n = Counter(lang for lang, _ in rows)
        self.langs = sorted(n, key=lambda x: (-n[x], x))
        self.counts = {}
        for lang, text in rows:
            for words in li.words_of(text):
                for w in filter(li.has_letter, words):
                    self.counts.setdefault((0, w), Counter())[lang] += 1
                    for size in li.GRAMS:
                        for g in li.grams(w, size):
                            self.counts.setdefault((size, g), Counter())[lang] += 1
        self.total = {}
        for (size, _), by in self.counts.items():
            for lang in self.langs:
                self.total[size, lang] = self.total.get((size, lang), 0) + by[lang] + li.SMOOTH

    def log(self, key, lang):
        return math.log((self.counts[key][lang] + li.SMOOTH) / self.total[key[0], lang])

    def word(self, w, lang):
        if not li.has_letter(w):
            return 0
        if (0, w) in self.counts:
            return self.log((0, w), lang)
        for size in li.GRAMS:
            known = [(size, g) for g in li.grams(w, size) if (size, g) in self.counts]
            if known:
                return sum(self.log(k, lang) for k in known) / len(known)
        return 0

    def predict(self, text):
        words = [w for ws in li.words_of(text or "") for w in ws]
        if not any(map(li.has_letter, words)):
            return "und", 0.0
        sums = [sum(self.word(w, lang) for w in words) for lang in self.langs]
        best = max(sums)
        return self.langs[sums.index(best)], 1 / sum(math.exp(s - best) for s in sums)


TEXTS = [
    None, "", " \t", "123 ... ²³", "the dog", "unseenword theory", "Überraschung Hundehütte", "élan vital", "日本語", "x1y2 the_dog",
    "THE CAT AND", "d" * 70 + " hund " + "d" * 70, "le la der the", "ꙮ", "ǅ und ſ",
]


def test_predictions_equal_plain_dictionaries(spark):
    docs = corpus(spark)
    model = li.fit(docs.where(~li.held_out("doc_id")))
    plain = Plain([(r["lang"], r["text"]) for r in docs.where(~li.held_out("doc_id")).distinct().collect()])
    assert model.langs == plain.langs
    odd = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    for r in li.predict(odd, model).join(odd, "doc_id").collect():
        lang, share = plain.predict(r["text"])
        assert (r["lang_pred"], pytest.approx(r["score"], abs=1e-4)) == (lang, share), r["text"]
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)


def test_pieces_and_forgetting_change_nothing(spark, monkeypatch):
    model = li.fit(corpus(spark))
    texts = [" ".join(EN * 40 + ["unbekannt", "d" * 90, "été"]), None, " ".join(DE * 3), "²"] * 3
    want = li.Scorer(model).score(texts)
    monkeypatch.setattr(li, "PIECE", 50)
    monkeypatch.setattr(li, "CACHE_BYTES", 500)
    got = li.Scorer(model).score(texts)
    assert got[0] == want[0]
    np.testing.assert_allclose(got[1], want[1], rtol=1e-9)


def test_pieces_end_between_words(monkeypatch):
    text = "one two " + "three" * 30 + " four5six, seven"
    whole = [w for ws in li.words_of(text) for w in ws]
    monkeypatch.setattr(li, "PIECE", 7)
    assert [w for ws in li.words_of(text) for w in ws] == whole


def test_held_out_labels_are_never_learned(spark):
    docs = corpus(spark)
    other = docs.withColumn("lang", F.when(li.held_out("doc_id"), "xx").otherwise(F.col("lang")))
    order = ["doc_id"]
    assert li.identify(docs).orderBy(*order).collect() == li.identify(other).orderBy(*order).collect()


def test_sample_is_bounded_by_rows_also_for_one_repeated_id(spark, monkeypatch):
    monkeypatch.setattr(li, "SAMPLE_ROWS", 5)
    one = spark.range(300).select(F.lit(1).cast("long").alias("doc_id"), F.concat(F.lit("word "), F.col("id")).alias("text"), F.lit("en").alias("lang"))
    same = spark.range(300).select(F.lit(2).cast("long").alias("doc_id"), F.lit("das wort").alias("text"), F.lit("de").alias("lang"))
    chosen = li.sample(one.unionByName(same), "doc_id", "text", "lang").groupBy("lang").count().collect()
    assert {r["lang"]: r["count"] for r in chosen} == {"en": 5, "de": 1}


def test_odd_rows(odd_docs, no_docs):
    rows = li.identify(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        assert 0 <= r["score"] <= 1 and r["lang_pred"] in ("en", "de", "und")
        if r["doc_id"] in (3, 4, 5, 11):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
    assert li.identify(no_docs).collect() == []
    unlabelled = odd_docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in li.identify(unlabelled).collect()} == {"und"}


def test_held_out_accuracy(spark):
    """Whole table; junk documents (few letters of any language) included."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = li.identify(docs).where("held_out").join(docs, "doc_id").where("lang is not null")
    right = {r["lang"]: r["share"] for r in out.groupBy("lang").agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("int")).alias("share")).collect()}
    assert min(right.values()) > 0.9, right
