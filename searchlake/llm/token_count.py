"""Token counts by a count-only Viterbi (operator 4).

The tokenizer is a unigram model: a vocabulary of pieces with scores, spaces
written as U+2581, one in front of the text, each starting a new word.  A
word is segmented into the pieces with the highest sum of scores; a
character that no piece covers costs the lowest score minus 10 and counts as
its UTF-8 bytes when the vocabulary has all byte pieces, else a run of them
counts as one unknown token.

An Aho-Corasick automaton over the vocabulary enumerates the pieces that end
at each character; the dynamic program carries best score and piece count
per end, never the pieces.  Ties follow the tokenizer: a later candidate has
to be strictly better, and candidates come by start, so the longest last
piece stays.  Words are independent, so each worker counts a distinct word
once and remembers it.

Null and empty texts have no tokens.  Repeated rows get equal results.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from searchlake.llm.common import CACHE_WORDS, slices

SPACE = "▁"
#: Below the lowest score, for a character that no piece covers.
UNKNOWN_PENALTY = 10.0


def load_pieces(path: str) -> list[tuple[str, float]]:
    """Pieces and scores of a sentencepiece file; control pieces never match
    a text and are left out."""
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    return [
        (sp.id_to_piece(i), sp.get_score(i))
        for i in range(sp.get_piece_size())
        if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))
    ]


class Counter:
    """Counts the pieces of words, and remembers the words seen lately."""

    def __init__(self, pieces: list[tuple[str, float]], cache: int = CACHE_WORDS):
        self.matches = ahocorasick.Automaton()
        for piece, score in dict(pieces).items():
            self.matches.add_word(piece, (len(piece), score))
        self.matches.make_automaton()
        names = {p for p, _ in pieces}
        self.bytes = all(f"<0x{i:02X}>" in names for i in range(256))
        self.unknown = min((s for _, s in pieces), default=0.0) - UNKNOWN_PENALTY
        self.known: dict[str, int] = {}
        self.cache = cache

    def word(self, word: str) -> int:
        """The number of tokens of one word (with its leading mark)."""
        n = len(word)
        best: list = [None] * (n + 1)
        count, unk = [0] * (n + 1), [False] * (n + 1)
        best[0] = 0.0
        ends: list[list] = [[] for _ in range(n)]
        for end, match in self.matches.iter(word):
            ends[end].append(match)
        for end in range(n):
            single = False
            to = end + 1
            for size, score in sorted(ends[end], reverse=True):  # by start
                single |= size == 1
                total = best[to - size] + score
                if best[to] is None or total > best[to]:
                    best[to], count[to], unk[to] = total, count[to - size] + 1, False
            if not single:
                total = best[end] + self.unknown
                if best[to] is None or total > best[to]:
                    more = len(word[end].encode()) if self.bytes else int(not unk[end])
                    best[to], count[to], unk[to] = total, count[end] + more, True
        return count[n]

    def text(self, text: str) -> int:
        """The number of tokens of a text."""
        if not text:
            return 0
        if len(self.known) > self.cache:
            self.known = {}
        total, known = 0, self.known
        first, *rest = text.replace(SPACE, " ").split(" ")
        for w in ([first, *rest] if not text.startswith((" ", SPACE)) else rest):
            n = known.get(w)
            if n is None:
                n = known[w] = self.word(SPACE + w)
            total += n
        return total


def count_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, n_chars, n_tokens`` of each row's whole text; the vocabulary
    at ``path`` is read by the driver (a few MB at most)."""
    shared = docs.sparkSession.sparkContext.broadcast(load_pieces(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(shared.value)
        for part in slices(batches):
            texts = [t or "" for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_pydict({
                "id": part.column("id"),
                "n_chars": pa.array([len(t) for t in texts], pa.int64()),
                "n_tokens": pa.array([counter.text(t) for t in texts], pa.int64()),
            })

    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = base.schema["id"].dataType.simpleString()
    return base.mapInArrow(run, f"id {kind}, n_chars long, n_tokens long").withColumnRenamed("id", id_col)
