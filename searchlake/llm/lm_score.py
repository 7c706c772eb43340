"""Masked pseudo-likelihood scoring (operator 1).

A bidirectional window network predicts every word from two words on either
side, the word itself masked.  A text's score is the sum of the conditional
log-probabilities of all its words.

Vocabulary: every word of the corpus, counted in Spark.  The network knows
the ``WORDS`` most frequent ones and ``OTHERS`` hash buckets for all others;
its output layer is a two-level softmax, class then word within the class.
A word of a bucket also costs -ln p(word | bucket), from the smoothed counts
of the corpus; one share of every bucket is left for words never seen.  So
probabilities are normalised exactly over words, not over buckets.

The counts are a table that grows with the corpus.  At most ``HEAD`` of its
words, the most frequent, are broadcast; the occurrences of all others meet
the table in a Spark join.  A word's probability is the same on either way.

Training reads every text of the corpus once, in ``ROUNDS`` hash folds of
the documents.  In a round each task starts from the current weights and
trains in numpy (AdaGrad) on its own texts; the tasks' weights, in blocks,
are averaged in Spark by numbers of words, and start the next round.  What is
shuffled grows with the number of input partitions; the driver only sees one
network of fixed size.

Null and empty texts have no words, a score of 0 and a null mean.  Repeated
rows get equal results.  An empty corpus leaves the initial network.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from searchlake.llm.common import concat, slices, utf8, written
from searchlake.llm.decontaminate import item_words

WORDS = 960
OTHERS = 64
CLASSES = 32
DIM = 16
#: Places of the window, relative to the masked word.
WINDOW = (-2, -1, 1, 2)
ROUNDS = 2
BATCH = 8192
RATE = 0.1
BLOCK = 4096
#: Most words whose counts are broadcast (16 bytes each).
HEAD = 1 << 20
#: Added to the count of every word of a bucket, and to that of unseen words.
SMOOTH = 0.5
#: A word's number: its place in the output layer, a mark that its cost in the
#: bucket is yet to be joined, and that cost in units of 1 / ``UNITS`` nats.
PLACE = 0xFFFF
JOINED = 1 << 16
COST = 17
UNITS = 1 << 20

VOCABULARY = WORDS + OTHERS
PER_CLASS = VOCABULARY // CLASSES


def word_hash(word: bytes) -> int:
    """Spark's ``xxhash64``, unsigned."""
    return xxhash.xxh64_intdigest(word, 42)


class Vocabulary(list):
    """The network's words, with what gives the others their costs: hashes
    (sorted) and counts of the most frequent words, and per bucket the sum of
    its smoothed counts."""

    def __init__(self, words: list[bytes], keys: np.ndarray, counts: np.ndarray, sums: np.ndarray):
        super().__init__(words)
        self.keys, self.counts, self.sums = keys, counts, sums

    def __reduce__(self):
        return Vocabulary, (list(self), self.keys, self.counts, self.sums)


class Words(dict):
    """Word numbers; unknown words are hashed to a bucket and remembered.  A
    plain list of words has no counts: its buckets are not told apart."""

    def __init__(self, vocabulary: list[bytes]):
        super().__init__(zip(vocabulary, range(WORDS)))
        self.vocabulary = vocabulary
        self.costs = None
        if isinstance(vocabulary, Vocabulary):
            own = vocabulary.sums[(vocabulary.keys % np.uint64(OTHERS)).astype(np.int64)]
            self.costs = np.rint(UNITS * np.log(own / (vocabulary.counts + SMOOTH))).astype(np.int64).clip(0)
            self.keys, self.costs = memoryview(vocabulary.keys), memoryview(self.costs)

    def __missing__(self, word: bytes) -> int:
        if len(self) > 200_000:
            self.clear()
            self.update(zip(self.vocabulary, range(WORDS)))
            if word in self:
                return self[word]
        h = word_hash(word)
        n = WORDS + h % OTHERS
        if self.costs is not None:
            at = bisect_left(self.keys, h)
            n |= self.costs[at] << COST if at < len(self.keys) and self.keys[at] == h else JOINED
        self[word] = n
        return n


def windows(lists: list[list[bytes]], known: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number of every word, the numbers in its window (``VOCABULARY`` beyond
    the text's ends), and the words per text."""
    words, ends = concat(lists)
    sizes = np.diff(ends)
    pad = max(WINDOW)
    token = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
    spread = np.full(len(words) + pad * (len(lists) + 1), VOCABULARY, np.int64)
    at = np.arange(len(words)) + pad * (1 + np.repeat(np.arange(len(lists)), sizes))
    spread[at] = token & PLACE
    return token, np.stack([spread[at + k] for k in WINDOW]), sizes


class Network:
    """Window embeddings, hidden layer and two-level softmax."""

    def __init__(self, seed: int = 1):
        rng = np.random.default_rng(seed)
        shapes = {
            "embed": (len(WINDOW), VOCABULARY + 1, DIM), "hidden": (DIM,), "top": (DIM, CLASSES), "top0": (CLASSES,),
            "low": (CLASSES, DIM, PER_CLASS), "low0": (CLASSES, PER_CLASS),
        }
        sizes = {k: int(np.prod(s)) for k, s in shapes.items()}
        self.flat = np.zeros(sum(sizes.values()), np.float32)
        at = 0
        for name, shape in shapes.items():
            setattr(self, name, self.flat[at : at + sizes[name]].reshape(shape))
            at += sizes[name]
        for name in ("embed", "top", "low"):
            w = getattr(self, name)
            w[...] = rng.normal(0, 0.1, w.shape)

    def _forward(self, window: np.ndarray) -> np.ndarray:
        h = self.hidden + self.embed[0][window[0]]
        for k in range(1, len(WINDOW)):
            h += self.embed[k][window[k]]
        return np.tanh(h)

    def log_probability(self, token: np.ndarray, window: np.ndarray) -> np.ndarray:
        """ln p(word | window) of each word; of a word marked ``JOINED`` that
        of its bucket."""
        out = np.empty(len(token), np.float32)
        for at in range(0, len(token), BATCH):
            t, w = token[at : at + BATCH] & PLACE, window[:, at : at + BATCH]
            order = np.argsort(t // PER_CLASS, kind="stable")
            t, h = t[order], self._forward(w[:, order])
            c, i = t // PER_CLASS, t % PER_CLASS
            rows = np.arange(len(t))
            logp = _log_softmax(h @ self.top + self.top0)[rows, c]
            cuts = np.searchsorted(c, np.arange(CLASSES + 1))
            low = np.empty((len(t), PER_CLASS), np.float32)
            for k in range(CLASSES):
                a, b = cuts[k], cuts[k + 1]
                if a < b:
                    low[a:b] = h[a:b] @ self.low[k] + self.low0[k]
            out[at + order] = logp + _log_softmax(low)[rows, i]
        return out - (token >> COST) / np.float32(UNITS)

    def train(self, token: np.ndarray, window: np.ndarray, past: Network) -> None:
        """One pass over the words; ``past`` holds the sums of squares."""
        for at in range(0, len(token), BATCH):
            t, w = token[at : at + BATCH] & PLACE, window[:, at : at + BATCH]
            order = np.argsort(t // PER_CLASS, kind="stable")
            t, w = t[order], w[:, order]
            n, c, i = len(t), t // PER_CLASS, t % PER_CLASS
            h, rows = self._forward(w), np.arange(n)
            g = np.exp(_log_softmax(h @ self.top + self.top0))
            g[rows, c] -= 1
            g /= n
            back = g @ self.top.T
            _step(self.top, past.top, h.T @ g)
            _step(self.top0, past.top0, g.sum(axis=0))
            cuts = np.searchsorted(c, np.arange(CLASSES + 1))
            for k in range(CLASSES):
                a, b = cuts[k], cuts[k + 1]
                if a < b:
                    g = np.exp(_log_softmax(h[a:b] @ self.low[k] + self.low0[k]))
                    g[np.arange(b - a), i[a:b]] -= 1
                    g /= n
                    back[a:b] += g @ self.low[k].T
                    _step(self.low[k], past.low[k], h[a:b].T @ g)
                    _step(self.low0[k], past.low0[k], g.sum(axis=0))
            back *= 1 - h * h
            _step(self.hidden, past.hidden, back.sum(axis=0))
            for k in range(len(WINDOW)):
                by = np.argsort(w[k], kind="stable")
                ids, first = np.unique(w[k][by], return_index=True)
                grad = np.add.reduceat(back[by], first, axis=0)
                past.embed[k][ids] += grad * grad
                self.embed[k][ids] -= RATE * grad / np.sqrt(past.embed[k][ids])


def _step(weight: np.ndarray, past: np.ndarray, grad: np.ndarray) -> None:
    past += grad * grad
    weight -= RATE * grad / np.sqrt(past)


def _log_softmax(x: np.ndarray) -> np.ndarray:
    x = x - x.max(axis=1, keepdims=True)
    return x - np.log(np.exp(x).sum(axis=1, keepdims=True))


def word_counts(docs: DataFrame) -> DataFrame:
    """``word, n, h, grade`` of every word of ``docs(text)``: counted per task,
    summed in Spark.  Grades rise with the counts, four for a doubling."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for part in slices(batches):
            for t in utf8(part):
                total.update(item_words(t))
            if len(total) > 200_000:
                yield _counts(total)
                total.clear()
        yield _counts(total)

    counts = docs.select("text").mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return written(counts, "word-counts").withColumns({"h": F.xxhash64("word"), "grade": F.floor(4 * F.log2("n"))})


def vocabulary(counts: DataFrame) -> tuple[Vocabulary, int]:
    """The vocabulary and the least grade of the words whose counts it holds.
    Ties of the network's words are broken by the word."""
    top = counts.orderBy(F.col("n").desc(), "word").limit(WORDS).collect()
    sums = np.full(OTHERS, SMOOTH)  # of unseen words
    for r in counts.groupBy(F.pmod("h", F.lit(OTHERS)).alias("b")).agg(F.sum(F.col("n") + SMOOTH).alias("n")).collect():
        sums[r["b"]] += r["n"]
    for r in top:  # the network's words are in no bucket
        sums[r["h"] % OTHERS] -= r["n"] + SMOOTH
    least, held = 0, 0
    for r in sorted(counts.groupBy("grade").agg(F.count(F.lit(1)).alias("m")).collect(), reverse=True):
        held += r["m"]
        if held > HEAD:
            least = r["grade"] + 1
            break
    head = counts.where(F.col("grade") >= least).select("h", "n").toArrow()  # HEAD rows at most
    keys, n = (head.column(c).to_numpy() for c in ("h", "n"))
    order = np.argsort(keys.view(np.uint64))
    return Vocabulary([bytes(r["word"]) for r in top], keys.view(np.uint64)[order], n[order], sums), least


def _counts(total: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"word": pa.array(list(total), pa.binary()), "n": pa.array(list(total.values()), pa.int64())})


def _trained(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, weights = shared.value
        known, network, past, seen = Words(words), Network(), Network(), 0
        network.flat[:] = weights
        past.flat[:] = 1e-6
        for part in slices(batches):
            token, window, _ = windows([item_words(t) for t in utf8(part)], known)
            if len(token):
                network.train(token, window, past)
                seen += len(token)
        if seen:
            cut = range(0, len(network.flat), BLOCK)
            yield pa.RecordBatch.from_pydict({
                "block": pa.array([a // BLOCK for a in cut], pa.int32()), "n": pa.array([seen] * len(cut), pa.int64()),
                "weights": pa.array([network.flat[a : a + BLOCK] for a in cut], pa.list_(pa.float32())),
            })

    return run


def _averaged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, list] = {}
    for batch in batches:
        for block, n, weights in zip(*(batch.column(c) for c in ("block", "n", "weights"))):
            own = total.setdefault(block.as_py(), [0, 0.0])
            own[0] += n.as_py()
            own[1] = own[1] + n.as_py() * weights.values.to_numpy().astype(np.float64)
    for block, (n, weights) in total.items():
        yield pa.RecordBatch.from_pydict({
            "block": pa.array([block], pa.int32()), "n": pa.array([n], pa.int64()),
            "weights": pa.array([(weights / n).astype(np.float32)], pa.list_(pa.float32())),
        })


def fit(docs: DataFrame) -> tuple[Vocabulary, np.ndarray]:
    """Vocabulary and weights after one pass over ``docs(text)``."""
    words, _ = vocabulary(word_counts(docs))
    return words, trained(docs, words)


def trained(docs: DataFrame, words: list[bytes]) -> np.ndarray:
    """The network's weights after one pass over ``docs(text)``."""
    spark, weights = docs.sparkSession, Network().flat
    schema = "block int, n long, weights array<float>"
    for r in range(ROUNDS):
        shared = spark.sparkContext.broadcast((list(words), weights))
        fold = docs.where(F.pmod(F.xxhash64("text"), F.lit(ROUNDS)) == r)
        blocks = fold.mapInArrow(_trained(shared), schema).repartition("block").mapInArrow(_averaged, schema)
        parts = {row["block"]: row["weights"] for row in blocks.collect()}  # one network
        if parts:
            weights = np.concatenate([np.array(parts[b], np.float32) for b in sorted(parts)])
    return weights


def _scored(shared):
    """Rows are numbered by task; ``rest`` has the hashes of the words whose
    costs are yet to be joined, once an occurrence."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, weights = shared.value
        known, network = Words(words), Network()
        network.flat[:] = weights
        row = TaskContext.get().partitionId() << 40
        for part in slices(batches):
            lists = [item_words(t) for t in utf8(part)]
            token, window, sizes = windows(lists, known)
            total = np.zeros(len(sizes))
            starts = np.cumsum(sizes) - sizes
            if len(token):
                some = sizes > 0
                logs = network.log_probability(token, window).astype(np.float64)
                total[some] = np.add.reduceat(logs, starts[some])
            rest = np.flatnonzero(token & JOINED)
            own = np.searchsorted(starts + sizes, rest, "right")
            hashes = [word_hash(lists[k][i]) for k, i in zip(own.tolist(), (rest - starts[own]).tolist())]
            ends = np.searchsorted(own, np.arange(len(sizes) + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(row + np.arange(len(sizes))), part.column("id"), pa.array(sizes), pa.array(total),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(np.array(hashes, np.uint64).view(np.int64))),
                ],
                names=["row", "id", "n_words", "pll", "rest"],
            )
            row += len(sizes)

    return run


def _cost(sums: np.ndarray) -> Column:
    """-ln p(word | bucket) of ``h`` with count ``n`` (null: never seen)."""
    own = F.element_at(F.array(*map(F.lit, sums.tolist())), (F.pmod("h", F.lit(OTHERS)) + 1).cast("int"))
    return F.log(own / (F.coalesce("n", F.lit(0)) + SMOOTH))


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, n_words, pll, mean_pll`` of each row's whole text, under the
    network trained on all of them and the counts of all their words."""
    base = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    counts = word_counts(base)
    words, least = vocabulary(counts)
    shared = docs.sparkSession.sparkContext.broadcast((words, trained(base.select("text"), words)))
    kind = base.schema["id"].dataType.simpleString()
    rows = written(base.mapInArrow(_scored(shared), f"row long, id {kind}, n_words long, pll double, rest array<long>"), "scores")
    # A word outside the head has few occurrences: no hot key in this join.
    rest = rows.select("row", F.explode("rest").alias("h")).join(counts.where(F.col("grade") < least).select("h", "n"), "h", "left")
    rest = rest.groupBy("row").agg(F.sum(_cost(words.sums)).alias("cost"))
    out = rows.drop("rest").join(rest, "row", "left").withColumn("pll", F.col("pll") - F.coalesce("cost", F.lit(0.0)))
    out = out.select("id", "n_words", "pll", F.when(F.col("n_words") > 0, F.col("pll") / F.col("n_words")).alias("mean_pll"))
    return out.withColumnRenamed("id", id_col)
