"""Language identification by word-first backoff (operator 12).

A word that the model knows is scored by its log frequency in each language.
An unknown word falls back to its character n-grams (the word between two
marks), longest first: at the first length of which the model knows any
n-gram, the word gets the mean log frequency of those; a word without any
known character says nothing.  A text's score for a language is the sum over
its words; the prediction is the best language, the score its share among all
languages (a softmax of the sums).

A word is a run of letters (and number signs) of the lower-cased text that
holds at least one letter.

The model is fitted on at most ``SAMPLE_ROWS`` labelled rows of each language,
with the smallest hashes of id and text, none longer than
``SAMPLE_CHARS``: so the counts that reach the driver are bounded, and the
model that each task gets is two arrays.  Counting is a Spark aggregation over
64-bit n-gram hashes.  The model grows with the number of languages, not with
the number of rows.  Every document is scored whole, in pieces, inside the
scan's own tasks.

Defined cases: a text that is null or has no letter is ``und`` with score 0,
and so is every text if there is no labelled row to learn from.  A text whose
words say nothing gets the language with the most sample rows (of equals the
first by name) and score 1 / languages; ties between languages go the same
way.  Repeated labelled rows count once.  A row without an id counts as id ''
for the split.  Empty tables give empty results; columns other than the id,
text and language are not read, whatever their names.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from searchlake.llm.common import crc32_mod, slices, written

#: Bounds of the sample the model is fitted on.
SAMPLE_ROWS, SAMPLE_CHARS = 1000, 20_000

#: Rows of a language that are ranked for the sample, in units of SAMPLE_ROWS.
DRAW = 4

#: Lengths of character n-grams, as they are tried.
GRAMS = (5, 4, 3, 2, 1)

SMOOTH = 0.5
UNKNOWN = "und"

#: A worker forgets its words beyond this many bytes, and never keeps longer
#: ones than ``KEEP``.
CACHE_BYTES, KEEP = 24 << 20, 64

#: Texts are split into words a piece at a time.
PIECE = 1 << 20

_WORD = re.compile(r"[^\W\d_]+")
_BREAK = re.compile(r"[\W\d_]")


def words_of(text: str) -> Iterator[list[str]]:
    """The words of a text, piece by piece; a piece ends between words."""
    start = 0
    while start < len(text):
        end = start + PIECE
        if end < len(text):
            cut = _BREAK.search(text, end)
            end = cut.start() if cut else len(text)
        yield _WORD.findall(text[start:end].lower())
        start = end


def has_letter(word: str) -> bool:
    return any(map(str.isalpha, word))


def grams(word: str, n: int) -> list[str]:
    """The n-grams of the word between marks; single characters without marks."""
    if n == 1:
        return list(word)
    marked = f"<{word}>"
    return [marked[i : i + n] for i in range(len(marked) - n + 1)]


def _hash(piece: str, n: int) -> int:
    """Words hash with seed 0, n-grams with their length."""
    return xxhash.xxh3_64_intdigest(piece.encode("utf-8", "surrogatepass"), n)


# --- fitting -------------------------------------------------------------------


def sample(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    """``lang, text``: the bounded sample of labelled rows, one of each
    repeated row.  Only languages and hashes are ranked; texts are read again
    for the rows below their language's last hash."""
    rows = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & (F.length(text_col) <= SAMPLE_CHARS))
    rows = rows.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"), F.xxhash64(id_col, text_col).alias("h"))
    # Hashes are even: a few times SAMPLE_ROWS lie below this share of them, so
    # what is ranked doesn't grow with the rows of a language.
    sizes = written(rows.groupBy("lang").agg(F.count(F.lit(1)).alias("size")), "lang-sizes")
    low = rows.join(sizes, "lang").where(F.col("h") / float(2**64) + 0.5 <= DRAW * SAMPLE_ROWS / F.col("size"))
    ranked = low.select("lang", "h").distinct().withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy("h")))
    last = written(ranked.where(F.col("rank") <= SAMPLE_ROWS).groupBy("lang").agg(F.max("h").alias("last")), "lang-sample")
    chosen = rows.join(last, "lang").where(F.col("h") <= F.col("last"))
    return chosen.groupBy("lang", "h").agg(F.min("text").alias("text")).select("lang", "text")


def gram_counts(chosen: DataFrame) -> DataFrame:
    """``lang, size, h, n``: occurrences of each word (size 0) and n-gram."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            seen: dict[str, Counter] = {}
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                for words in words_of(text):
                    seen.setdefault(lang, Counter()).update(words)
            for lang, words in seen.items():
                found: Counter = Counter()
                for word, n in words.items():
                    if has_letter(word):
                        found[0, _hash(word, 0)] += n
                        for size in GRAMS:
                            for gram in grams(word, size):
                                found[size, _hash(gram, size)] += n
                keys = np.array(list(found), np.uint64).reshape(-1, 2)
                yield pa.RecordBatch.from_pydict({
                    "lang": pa.array([lang] * len(keys), pa.string()), "size": pa.array(keys[:, 0].astype(np.int32)),
                    "h": pa.array(keys[:, 1].view(np.int64)), "n": pa.array(list(found.values()), pa.int64()),
                })

    counted = chosen.mapInArrow(count, "lang string, size int, h long, n long")
    return counted.groupBy("lang", "size", "h").agg(F.sum("n").alias("n"))


def summed(owner: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """The rows summed by owner, in their order."""
    return np.stack([np.bincount(owner, column, n) for column in rows.T], 1) if rows.shape[1] else np.zeros((n, 0))


class Model:
    """Log frequencies: sorted hashes, one row of languages for each."""

    def __init__(self, langs: list[str], keys: np.ndarray, logs: np.ndarray):
        self.langs, self.keys, self.logs = langs, keys, logs

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The row of each hash, -1 where it is unknown."""
        if not len(self.keys):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
        return np.where(self.keys[at] == hashes, at, -1)

    def word_scores(self, words: list[str]) -> np.ndarray:
        """A row of languages for each word, zeros if it says nothing."""
        out = np.zeros((len(words), len(self.langs)))
        at = self.find(np.fromiter((_hash(w, 0) for w in words), np.uint64, len(words)))
        out[at >= 0] = self.logs[at[at >= 0]]
        rest = np.flatnonzero(at < 0)
        for size in GRAMS:
            if not len(rest):
                break
            lists = [grams(words[i], size) for i in rest.tolist()]
            owner = np.repeat(np.arange(len(rest)), [len(x) for x in lists])
            found = self.find(np.fromiter((_hash(g, size) for x in lists for g in x), np.uint64, len(owner)))
            owner, found = owner[found >= 0], found[found >= 0]
            hits = np.bincount(owner, minlength=len(rest))
            total = summed(owner, self.logs[found], len(rest))
            known = hits > 0
            out[rest[known]] = total[known] / hits[known, None]
            rest = rest[~known]
        return out


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """The model of the labelled rows of ``docs``."""
    chosen = written(sample(docs, id_col, text_col, lang_col), "lang-rows")
    rows = {r["lang"]: r["n"] for r in chosen.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    langs = sorted(rows, key=lambda x: (-rows[x], x))
    table = gram_counts(chosen).toArrow()
    size = table.column("size").to_numpy()
    h = table.column("h").to_numpy().view(np.uint64)
    n = table.column("n").to_numpy()
    place = {lang: i for i, lang in enumerate(langs)}
    lang = np.fromiter((place[x] for x in table.column("lang").to_pylist()), np.int64, len(n))
    keys, first, inverse = np.unique(h, return_index=True, return_inverse=True)
    counts = np.zeros((len(keys), len(langs)))
    np.add.at(counts, (inverse.reshape(-1), lang), n)
    kind, logs = size[first], np.zeros((len(keys), len(langs)), np.float32)
    for s in (0, *GRAMS):
        own = kind == s
        smooth = counts[own] + SMOOTH
        logs[own] = np.log(smooth / smooth.sum(0)) if own.any() else 0
    return Model(langs, keys, logs)


# --- prediction ------------------------------------------------------------------


class Scorer:
    """Sums of word scores, with the words seen so far remembered."""

    def __init__(self, model: Model):
        self.model = model
        self.forget()

    def forget(self) -> None:
        self.place: dict[str, int] = {}
        self.rows = np.zeros((0, len(self.model.langs)))
        self.letters = np.zeros(0, bool)
        self.size = 0

    def _learn(self, words: set[str]) -> None:
        new = sorted(words)
        keep = [w for w in new if len(w) <= KEEP]
        long = [w for w in new if len(w) > KEEP]
        self.size += sum(8 * len(self.model.langs) + 100 + 2 * len(w) for w in keep)
        start = len(self.rows)
        self.place.update(zip(keep + long, range(start, start + len(new))))
        self.long = long
        letters = np.fromiter(map(has_letter, keep + long), bool, len(new))
        scores = self.model.word_scores(keep + long)
        scores[~letters] = 0
        self.rows, self.letters = np.concatenate([self.rows, scores]), np.concatenate([self.letters, letters])

    def _sum(self, lists: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Per word list the summed scores and whether it has a letter."""
        new = {w for words in lists for w in words if w not in self.place}
        self._learn(new)
        flat = np.fromiter((self.place[w] for words in lists for w in words), np.int64)
        owner = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
        total = summed(owner, self.rows[flat], len(lists))
        letter = np.zeros(len(lists), bool)
        letter[owner[self.letters[flat]]] = True
        if self.long or self.size > CACHE_BYTES:
            self._trim()
        return total, letter

    def _trim(self) -> None:
        """Long words go at once; all go when they hold too many bytes."""
        if self.size > CACHE_BYTES:
            self.forget()
            return
        for w in self.long:
            del self.place[w]
        keep = len(self.rows) - len(self.long)
        self.rows, self.letters, self.long = self.rows[:keep], self.letters[:keep], []

    def score(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """The predicted language and its share for each text."""
        langs = self.model.langs
        lists, owner = [], []
        total, letter = np.zeros((len(texts), len(langs))), np.zeros(len(texts), bool)

        def flush() -> None:
            part, has = self._sum(lists)
            own = np.array(owner, np.int64)
            np.add.at(total, own, part)
            letter[own[has]] = True
            lists.clear()
            owner.clear()

        held = 0
        for i, text in enumerate(texts):
            for words in words_of(text or ""):
                lists.append(words)
                owner.append(i)
                held += len(words)
                if held > PIECE:
                    flush()
                    held = 0
        if lists:
            flush()
        if not langs:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        best = total.argmax(1)
        share = 1 / np.exp(total - total.max(1, keepdims=True)).sum(1)
        return [langs[b] if ok else UNKNOWN for b, ok in zip(best, letter)], np.where(letter, share, 0.0)


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, held_out, lang_pred, score`` for every row.  The model has a
    bounded size (see the sample) and is sent to each worker once."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in slices(batches):
            langs, score = scorer.score(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("held_out"), pa.array(langs, pa.string()), pa.array(score)],
                ["id", "held_out", "lang_pred", "score"],
            )

    rows = docs.select(F.col(id_col).alias("id"), held_out(id_col).alias("held_out"), F.col(text_col).alias("text"))
    schema = T.StructType([rows.schema["id"], *T.StructType.fromDDL("held_out boolean, lang_pred string, score double").fields])
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)


#: The split of the task: rows with this remainder are never learned from.
FOLDS, HELD_OUT = 4, 2


def held_out(id_col: str):
    return crc32_mod(id_col, FOLDS) == HELD_OUT


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Languages of all rows, learned from the labelled rows not held out."""
    return predict(docs, fit(docs.where(~held_out(id_col)), id_col, text_col, lang_col), id_col, text_col)
