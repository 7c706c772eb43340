"""Toxicity: a convolutional text classifier in numpy (operator 3).

A word's embedding is the sum of the hashed embeddings of the word, its first
and its last four bytes, so inflected and compound forms share what they
learn.  Filters of widths 1, 2 and 3 run over the whole text, and the maximum
of each filter over all positions feeds a logistic output.  Only the text
enters a score.

The network is fitted on a bounded sample (``SAMPLE_TOXIC`` and
``SAMPLE_CLEAN`` labelled documents outside the held-out fold, drawn by a
hash of the id); the output's bias is then corrected for the share of toxic
documents among all labels.  For scoring, embeddings and filters are
multiplied out, so that a position costs a few table rows.  Texts are never
shortened.

Thresholds: of all labelled documents outside the held-out fold, per
language, ``CLEAN_SHARE`` of the non-toxic ones score below the language's
threshold, which is 0.5 at least; a language with fewer than ``LEAST_DOCS``
of them, or none, uses that of all languages.  ``flagged`` applies it.

Null and empty texts get the score of a text without words.  Labels that are
null or belong to no document are ignored; a document with several labels
counts as toxic if any says so.  Without labels of both kinds every score is
the share of toxic labels (0 without labels).  Repeated rows get equal results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from searchlake.llm.common import crc32_mod, slices, utf8, without, written
from searchlake.llm.decontaminate import item_words

BUCKETS = 1 << 15
DIM = 12
WIDTHS = (1, 2, 3)
FILTERS = 12
EPOCHS = 12
BATCH = 64
RATE = 0.1
SAMPLE_TOXIC = 2500
SAMPLE_CLEAN = 3500
#: Longer documents are scored, but not fitted on.
SAMPLE_CHARS = 20_000
FOLDS = 5
CLEAN_SHARE = 0.99
LEAST_DOCS = 50

PAD = max(WIDTHS) - 1


class _Index(dict):
    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self) + 1
        return n


def indexed(lists: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All texts in a row as numbers of distinct words, each text followed
    by padding (0) for the widest filter and one place more; the texts'
    first places; and the three buckets of each distinct word (0: none)."""
    counts = np.array([len(x) for x in lists], np.int64)
    starts = np.cumsum(counts + PAD + 1) - (counts + PAD + 1)
    place = np.zeros(int((counts + PAD + 1).sum()), np.int64)
    index = _Index()
    words = [w for x in lists for w in x]
    nth = np.arange(len(words), dtype=np.int64) - np.repeat(np.cumsum(counts) - counts, counts)
    place[np.repeat(starts, counts) + nth] = np.fromiter(map(index.__getitem__, words), np.int64, len(words))
    digest = xxhash.xxh3_64_intdigest
    hashed = [(0, 0, 0), *[(digest(w), digest(w[:4], 1), digest(w[-4:], 2)) for w in index]]
    parts = np.array(hashed, np.uint64) % np.uint64(BUCKETS - 1)
    parts = parts.astype(np.int64) + 1
    parts[0] = 0
    return place, starts, parts


class Scorer:
    """The network with embeddings and filters multiplied out: one table row
    a bucket, a block of columns for each filter position."""

    def __init__(self, table: np.ndarray, shift: np.ndarray, weight: np.ndarray, bias: float):
        self.table, self.shift, self.weight, self.bias = table, shift, weight, bias

    def scores(self, lists: list[list[bytes]]) -> np.ndarray:
        """The score of each text, given as its words."""
        place, starts, parts = indexed(lists)
        known = self.table[parts[:, 0]] + self.table[parts[:, 1]] + self.table[parts[:, 2]]
        n, block, pooled = len(place) - PAD, 0, []
        # A text's places are its words and one more; the filters that start
        # further right would reach into the next text.
        beyond = (starts + np.array([len(x) for x in lists], np.int64) + 1)[:, None] + np.arange(PAD)
        beyond = beyond[beyond < n]
        for width in WIDTHS:
            r = 0
            for j in range(width):
                r = r + np.ascontiguousarray(known[:, block : block + FILTERS])[place[j : j + n]]
                block += FILTERS
            r[beyond] = -np.inf
            pooled.append(np.maximum.reduceat(r, starts, axis=0))
        x = np.maximum(np.concatenate(pooled, axis=1) + self.shift, 0) @ self.weight + self.bias
        return 1 / (1 + np.exp(-np.clip(x.astype(np.float64), -30, 30)))


class Network:
    """Embeddings, filters and output weights."""

    def __init__(self, seed: int = 3):
        rng = np.random.default_rng(seed)
        self.embed = rng.normal(0, 0.3, (BUCKETS, DIM)).astype(np.float32)
        self.embed[0] = 0
        self.filters = [rng.normal(0, 0.3, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS]
        self.shift = [np.zeros(FILTERS, np.float32) for _ in WIDTHS]
        self.weight = rng.normal(0, 0.3, len(WIDTHS) * FILTERS).astype(np.float32)
        self.bias = np.zeros(1, np.float32)

    def fit(self, docs: list[np.ndarray], labels: np.ndarray, seed: int = 3) -> None:
        """``docs``: per text its words' buckets, a row of three a word.
        Logistic loss, per-parameter step sizes (AdaGrad)."""
        rng = np.random.default_rng(seed)
        params = [self.embed, *self.filters, *self.shift, self.weight, self.bias]
        past = [np.full(p.shape, 0.05, np.float32) for p in params]

        def step(p: int, grad: np.ndarray) -> None:
            past[p] += grad * grad
            params[p] -= RATE * grad / np.sqrt(past[p])

        for _ in range(EPOCHS):
            order = rng.permutation(len(docs))
            for at in range(0, len(order), BATCH):
                own = order[at : at + BATCH]
                sizes = np.array([len(docs[i]) + 1 for i in own])  # one place more, as in scoring
                starts = np.cumsum(sizes + PAD) - sizes - PAD
                token = np.zeros((int((sizes + PAD).sum()), 3), np.int64)
                for i, a in zip(own, starts):
                    token[a : a + len(docs[i])] = docs[i]
                rows = self.embed[token].sum(axis=1)
                n = len(rows) - PAD
                best, where = [], []
                for k, width in enumerate(WIDTHS):
                    r = sum(rows[j : j + n] @ self.filters[k][j] for j in range(width)) + self.shift[k]
                    places = np.stack([a + r[a : a + m].argmax(axis=0) for a, m in zip(starts, sizes)])
                    where.append(places)
                    best.append(r[places, np.arange(FILTERS)])
                pooled = np.maximum(np.concatenate(best, axis=1), 0)
                p = 1 / (1 + np.exp(-(pooled @ self.weight + self.bias)))
                d = ((p - labels[own]) / len(own)).astype(np.float32)
                back = d[:, None] * self.weight * (pooled > 0)
                touched, grads = [], []
                for k, width in enumerate(WIDTHS):
                    g = back[:, k * FILTERS : (k + 1) * FILTERS]
                    grad = np.empty_like(self.filters[k])
                    for j in range(width):
                        grad[j] = np.einsum("df,dfe->ef", g, rows[where[k] + j])
                        move = (g[:, :, None] * self.filters[k][j].T[None]).reshape(-1, DIM)
                        for part in token[where[k] + j].reshape(-1, 3).T:
                            touched.append(part)
                            grads.append(move)
                    step(1 + k, grad)
                    step(1 + len(WIDTHS) + k, g.sum(axis=0))
                ids, inverse = np.unique(np.concatenate(touched), return_inverse=True)
                grad = np.zeros((len(ids), DIM), np.float32)
                np.add.at(grad, inverse, np.concatenate(grads))
                grad[ids == 0] = 0
                past[0][ids] += grad * grad
                self.embed[ids] -= RATE * grad / np.sqrt(past[0][ids])
                step(len(params) - 2, d @ pooled)
                step(len(params) - 1, d.sum(keepdims=True))

    def scorer(self, odds_shift: float = 0.0) -> Scorer:
        table = np.concatenate([self.embed @ f[j] for f in self.filters for j in range(len(f))], axis=1)
        return Scorer(table, np.concatenate(self.shift), self.weight, float(self.bias[0]) + odds_shift)


def fitted(toxic: list[list[bytes]], clean: list[list[bytes]], n_toxic: int, n_clean: int) -> Scorer:
    """The scorer fitted on two samples, out of so many labelled documents."""
    if not toxic or not clean:
        share = n_toxic / max(1, n_toxic + n_clean)
        odds = np.log(max(share, 1e-9) / max(1 - share, 1e-9))
        return Scorer(np.zeros((BUCKETS, sum(WIDTHS) * FILTERS), np.float32), np.zeros(len(WIDTHS) * FILTERS, np.float32),
                      np.zeros(len(WIDTHS) * FILTERS, np.float32), float(odds))
    place, starts, parts = indexed(toxic + clean)
    docs = [parts[place[a : a + len(x)]] for a, x in zip(starts, toxic + clean)]
    network = Network()
    network.fit(docs, np.repeat(np.array([1, 0], np.float32), [len(toxic), len(clean)]))
    return network.scorer(float(np.log(n_toxic / n_clean) - np.log(len(toxic) / len(clean))))


def _scored(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = shared.value
        for part in slices(batches):
            score = scorer.scores([item_words(t) for t in utf8(part)])
            yield pa.RecordBatch.from_arrays([part.column("id"), part.column("lang"), pa.array(score)], names=["id", "lang", "score"])

    return run


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``id_col, held_out, score, predicted, lang, threshold, flagged`` for
    each row of ``docs(id_col, text, lang)``; ``predicted`` is score >= 0.5."""
    spark = docs.sparkSession
    base = docs.select(F.col(id_col).alias("id"), F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    known = labels.where("doc_id is not null and toxic is not null").where(crc32_mod("doc_id", FOLDS) != 0)
    known = known.groupBy(F.col("doc_id").alias("id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    known = written(known.join(base.select("id").distinct(), "id", "left_semi"), "labels")
    count = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    drawn = [known.where(F.col("toxic") == t).orderBy(F.xxhash64("id"), "id").limit(n)
             for t, n in ((1, SAMPLE_TOXIC), (0, SAMPLE_CLEAN))]
    sample = base.where(F.length("text") <= SAMPLE_CHARS).join(F.broadcast(drawn[0].union(drawn[1])), "id")  # bounded
    # One row an id: repeated ids don't make the sample larger.
    sample = sample.groupBy("id", "toxic").agg(F.min("text").alias("text"))
    rows = sample.select("toxic", "text").orderBy("toxic", F.xxhash64("text")).toArrow()
    texts = list(zip(rows.column("toxic").to_pylist(), utf8(rows.combine_chunks())))
    scorer = fitted([item_words(x) for t, x in texts if t == 1], [item_words(x) for t, x in texts if t == 0],
                    count.get(1, 0), count.get(0, 0))
    shared = spark.sparkContext.broadcast(scorer)
    kind = base.schema["id"].dataType.simpleString()
    scored = written(base.mapInArrow(_scored(shared), f"id {kind}, lang string, score double"), "toxicity")

    clean = written(scored.join(known.where("toxic = 0"), "id", "left_semi"), "clean")
    at = F.percentile_approx("score", CLEAN_SHARE, 10000)
    everywhere = clean.agg(at.alias("t")).first()["t"] or 0.0
    each = clean.where("lang is not null").groupBy("lang").agg(F.count(F.lit(1)).alias("n"), at.alias("own"))
    each = each.where(F.col("n") >= LEAST_DOCS).select("lang", "own")
    limit = F.greatest(F.lit(0.5), F.coalesce("own", F.lit(float(everywhere))))
    out = scored.join(each, "lang", "left").withColumn("threshold", limit)
    return out.select(
        F.col("id").alias(id_col), (crc32_mod("id", FOLDS) == 0).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), "lang", "threshold",
        ((F.col("score") >= 0.5) & (F.col("score") > F.col("threshold"))).alias("flagged"),
    )


def keep_clean(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``docs`` without the rows whose id was flagged; rows without an id stay."""
    return without(docs, classify(docs, labels, id_col).where("flagged"), id_col)
