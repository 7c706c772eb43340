"""Byte-level BPE encoding and decoding (operator 7).

Texts are split into matches of the tokenizer's pattern; a match is encoded
on its own, so a worker encodes every distinct match once, in one DuckDB
query for all new matches of a slice of texts:

* rows ``(match, position, token)`` start as single bytes;
* a recursive step joins each row and its right neighbour with the merge
  table, takes the leftmost pair of minimum rank of every match and
  contracts it; a match without a pair left is at its fixpoint;
* ordered aggregation lists the tokens of a match, and decodes lists of ids
  by concatenating the tokens' bytes in order.

A match that is a token itself is not split, as in the library.  A match over
``LONG`` bytes (text without spaces) is cut first wherever no token of the
vocabulary occurs across a place: no contraction can join what such a cut
parts.  An Aho-Corasick automaton finds the occurrences; the segments are short
as a rule, and encoded and remembered like matches.  Segments that are still
over ``LONG`` bytes contract, in one step, all occurrences of the minimum
rank from the left, each second one of an overlapping run.  That equals the
one-by-one order as long as no new pair has a lower rank; a segment where one
has is encoded again one by one.

A worker remembers pieces of text in two generations of at most half of
``CACHE_BYTES`` each: when the younger is full, the older goes, and what is
still met moves to the younger.  Pieces over ``LONG`` characters are not kept.

Null texts are empty; empty texts have no ids.  Repeated rows get equal
results.  Ids outside the vocabulary can't be decoded: the text is null.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import ahocorasick
import duckdb
import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from searchlake.llm.common import KEPT, slices

LONG = 64
CACHE_BYTES = 128 << 20
#: Bytes that a remembered piece takes besides its characters and ids.
ENTRY_BYTES = 190
CACHE_SEGMENTS = 200_000
BATCH_MATCHES = 30_000

#: A space before another character than white space starts a match under
#: the pattern, unless it is a space of a longer run; these never are.
_CUT = re.compile(r"(?<=\S) (?=\S)")

_STEP = """
WITH RECURSIVE state(k, token, live) AS (
    SELECT k, token, true FROM bytes
    UNION ALL
    (WITH pairs AS MATERIALIZED (
        SELECT p.k, p.token, p.before, (m.rank << 32) + (p.k & 4294967295) AS here
        FROM (SELECT k, token, lag(k) OVER o AS before,
                  CASE WHEN lead(k) OVER o >> 32 = k >> 32 THEN (token << 32) + lead(token) OVER o END AS pair
              FROM state WHERE live WINDOW o AS (ORDER BY k)) p
        LEFT JOIN merges m ON m.pair = p.pair
    ), low AS (SELECT k >> 32 AS match, min(here) AS best FROM pairs GROUP BY 1)
    SELECT k, CASE WHEN here = best THEN here >> 32 ELSE token END, best IS NOT NULL
    FROM pairs JOIN low ON match = k >> 32
    WHERE best IS NULL OR before IS NULL OR before <> ((k >> 32) << 32) + (best & 4294967295))
)
SELECT k >> 32 AS match, token, false AS broken FROM state WHERE NOT live ORDER BY k
"""

_STEP_LONG = """
WITH RECURSIVE state(k, token, live, last, broken) AS (
    SELECT k, token, true, -1::BIGINT, false FROM bytes
    UNION ALL
    SELECT k, CASE WHEN taken THEN rank ELSE token END, best IS NOT NULL, best, broken OR coalesce(best < last, false)
    FROM (SELECT *, coalesce(lag(taken) OVER (ORDER BY k), false) AS gone FROM (
        SELECT *, rank = best AND (row_number() OVER (PARTITION BY rank = best, run ORDER BY k)) % 2 = 1 AS taken FROM (
            SELECT *, nth - row_number() OVER (PARTITION BY rank = best ORDER BY k) AS run FROM (
                SELECT *, min(rank) OVER () AS best FROM (
                    SELECT p.*, m.rank FROM (
                        SELECT *, (token << 32) + lead(token) OVER o AS pair, row_number() OVER o AS nth FROM state WHERE live
                        WINDOW o AS (ORDER BY k)) p
                    LEFT JOIN merges m ON m.pair = p.pair)))))
    WHERE NOT gone
)
SELECT 0::BIGINT AS match, token, broken FROM state WHERE NOT live ORDER BY k
"""

#: One thread aggregates in the order of the rows it is given.
_DECODE = """
SELECT text, string_agg(bytes, '') AS bytes, count(*) AS known
FROM (SELECT text, bytes FROM lists JOIN vocabulary USING (id) ORDER BY nth) GROUP BY text
"""


def parse_ranks(content: bytes) -> dict[bytes, int]:
    """Token bytes to ranks, from lines of base64 tokens and ranks."""
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, content.splitlines()) if a}


class Tokenizer:
    """One worker's DuckDB tables and the matches it has encoded lately."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.find = ranks, regex.compile(pattern).findall
        self.single = np.array([ranks[bytes([i])] for i in range(256)], np.int64)
        # Without a temp folder DuckDB writes nothing beside its memory.
        self.db = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": "300MB", "temp_directory": ""})
        pairs = [
            (ranks[t[:i]], ranks[t[i:]], r) for t, r in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks
        ]
        a, b, r = (np.array(x, np.int64) for x in zip(*pairs)) if pairs else (np.empty(0, np.int64),) * 3
        self._table("merges", {"pair": (a << 32) + b, "rank": r})
        # Bytes as characters 0 to 255: DuckDB concatenates texts only.
        self._table("vocabulary", {"id": np.array(list(ranks.values()), np.int32), "bytes": [t.decode("latin-1") for t in ranks]})
        #: Ids as int32 bytes of pieces of text, and of those after a space
        #: (None: that space may belong to another match).
        self.heads: dict[str, bytes] = {}
        self.tails: dict[str, bytes | None] = {}
        self.old_heads: dict[str, bytes] = {}
        self.old_tails: dict[str, bytes | None] = {}
        self.size, self.long = 0, []
        self.segments: dict[bytes, bytes] = {}
        self.automaton = None

    def cut(self, word: bytes) -> list[bytes]:
        """The word in segments that no token crosses."""
        if self.automaton is None:
            self.automaton = ahocorasick.Automaton()
            for t in self.ranks:
                if len(t) > 1:
                    self.automaton.add_word(t.decode("latin-1"), len(t))
            self.automaton.make_automaton()
        crossed = np.zeros(len(word) + 2, np.int64)
        for end, n in self.automaton.iter(word.decode("latin-1")):
            crossed[end - n + 2] += 1
            crossed[end + 1] -= 1
        # crossed[i] now counts the tokens across the place before byte i.
        places = (np.flatnonzero(np.cumsum(crossed)[1 : len(word)] == 0) + 1).tolist()
        return [word[a:z] for a, z in zip([0, *places], [*places, len(word)])]

    def _table(self, name: str, columns: dict) -> None:
        data = pa.table(columns)
        self.db.register("incoming", data)
        self.db.execute(f"CREATE OR REPLACE TEMP TABLE {name} AS SELECT * FROM incoming")
        self.db.unregister("incoming")

    def _contract(self, words: list[bytes], query: str) -> tuple[list[bytes], bool]:
        sizes = np.array([len(w) for w in words], np.int64)
        owner = np.repeat(np.arange(len(words), dtype=np.int64), sizes)
        nth = np.arange(len(owner), dtype=np.int64) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        self._table("bytes", {"k": (owner << 32) + nth, "token": self.single[np.frombuffer(b"".join(words), np.uint8)]})
        found = self.db.execute(query).fetchnumpy()
        ends = 4 * np.cumsum(np.bincount(found["match"], minlength=len(words)))
        ids = found["token"].astype(np.int32).tobytes()
        return [ids[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())], bool(found["broken"].any())

    def encode_matches(self, words: list[bytes]) -> list[bytes]:
        """Ids (as int32 bytes) of each word, by contraction to the fixpoint."""
        out = [b""] * len(words)
        short = [i for i, w in enumerate(words) if 0 < len(w) <= LONG]
        for start in range(0, len(short), BATCH_MATCHES):
            part = short[start : start + BATCH_MATCHES]
            for i, ids in zip(part, self._contract([words[i] for i in part], _STEP)[0]):
                out[i] = ids
        cut = {i: self.cut(w) for i, w in enumerate(words) if len(w) > LONG}
        if cut:
            if len(self.segments) > CACHE_SEGMENTS:
                self.segments = {}
            new = {s for own in cut.values() for s in own} - self.segments.keys()
            few = [s for s in new if len(s) <= LONG]
            known = dict(zip(few, self.encode_matches(few)))
            for s in new - known.keys():
                (known[s],), broken = self._contract([s], _STEP_LONG)
                if broken:
                    (known[s],), _ = self._contract([s], _STEP)
            for i, own in cut.items():
                out[i] = b"".join([known[s] if s in known else self.segments[s] for s in own])
            self.segments.update((s, ids) for s, ids in known.items() if len(s) <= LONG)
        return out

    def _learn(self, heads: set[str], tails: set[str]) -> None:
        """Encode the matches of pieces of text that are not known yet."""
        odd = {t for t in tails if not t or t[0].isspace()}
        self.tails.update(dict.fromkeys(odd))
        split = [(self.heads, h, self.find(h)) for h in heads]
        rest, words = [], []
        # Most pieces after a space are one match: those need no parts.
        find, ranks = self.find, self.ranks
        for t in tails - odd:
            spaced = " " + t
            own = find(spaced)
            if len(own) > 1:
                split.append((self.tails, t, own))
            elif (whole := ranks.get(w := spaced.encode())) is None:
                rest.append((self.tails, t))
                words.append(w)
            else:
                self._keep(self.tails, t, np.int32(whole).tobytes())
        single = {t for _, t in rest}

        def place(match: str) -> tuple[dict, dict, str]:
            after = len(match) > 1 and match[0] == " " and not match[1].isspace()
            return (self.tails, self.old_tails, match[1:]) if after else (self.heads, self.old_heads, match)

        for m in {m for _, _, own in split for m in own}:
            known, old, key = place(m)
            if key not in known and not (known is self.tails and key in single):
                w = m.encode()
                if key in old:
                    self._keep(known, key, old[key])
                elif (whole := self.ranks.get(w)) is None:
                    rest.append((known, key))
                    words.append(w)
                else:
                    self._keep(known, key, np.int32(whole).tobytes())
        for (known, key), ids in zip(rest, self.encode_matches(words)):
            self._keep(known, key, ids)
        for known, piece, own in split:
            if piece not in known:
                parts = [place(m) for m in own]
                self._keep(known, piece, b"".join([d[key] for d, _, key in parts]))

    def _keep(self, known: dict, piece: str, ids: bytes | None) -> None:
        known[piece] = ids
        if len(piece) > LONG:
            self.long.append((known, piece))
        self.size += ENTRY_BYTES + len(piece) + len(ids or b"")

    def _recall(self, wanted: set[str], known: dict, old: dict) -> set[str]:
        """The wanted pieces that are not known; those of the older
        generation move to the younger."""
        for piece in (wanted := wanted - known.keys()) & old.keys():
            self._keep(known, piece, old[piece])
        return wanted - known.keys()

    def _forget(self) -> None:
        """Long pieces go at once, the older generation when the younger is full."""
        for known, piece in self.long:
            known.pop(piece, None)
        self.long = []
        if self.size > CACHE_BYTES // 2:
            self.old_heads, self.old_tails = self.heads, self.tails
            self.heads, self.tails, self.size = {}, {}, 0

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        self._forget()
        cut, heads, tails = [t.split(" ") for t in texts], set(), set()
        for own in cut:
            heads.add(own[0])
            tails.update(own[1:])
        heads = self._recall(heads, self.heads, self.old_heads)
        tails = self._recall(tails, self.tails, self.old_tails)
        if heads or tails:
            self._learn(heads, tails)
        done = [[self.heads[own[0]], *map(self.tails.__getitem__, own[1:])] for own in cut]
        odd = {i: _CUT.split(texts[i]) for i, found in enumerate(done) if None in found}
        if odd:
            odd = {i: [own[0], *[" " + x for x in own[1:]]] for i, own in odd.items()}
            self._learn(self._recall({x for own in odd.values() for x in own}, self.heads, self.old_heads), set())
            for i, own in odd.items():
                done[i] = [self.heads[x] for x in own]
        return [np.frombuffer(b"".join(found), np.int32) for found in done]

    def decode(self, lists: list[np.ndarray]) -> list[bytes | None]:
        """The bytes of each list of ids, by ordered aggregation."""
        sizes = np.array([len(x) for x in lists], np.int64)
        ids = np.concatenate(lists).astype(np.int32) if lists else np.empty(0, np.int32)
        owner = np.repeat(np.arange(len(lists), dtype=np.int64), sizes)
        self._table("lists", {"text": owner, "nth": np.arange(len(ids), dtype=np.int64), "id": ids})
        found = {t: b.encode("latin-1") for t, b, n in self.db.execute(_DECODE).fetchall() if n == sizes[t]}
        return [found.get(i) if n else b"" for i, n in enumerate(sizes.tolist())]


def _worker(name: str, shared) -> Tokenizer:
    """The tokenizer of this worker process, by the digest of its definition."""
    if name not in KEPT:
        KEPT.clear()
        content, pattern = shared.value
        KEPT[name] = Tokenizer(parse_ranks(content), pattern)
    return KEPT[name]


def _runner(name: str, shared, decode: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _worker(name, shared)
        for part in slices(batches, keeps=name):
            ids = tokenizer.encode([t or "" for t in part.column("text").to_pylist()])
            ends = np.zeros(len(ids) + 1, np.int32)
            np.cumsum([len(x) for x in ids], out=ends[1:])
            flat = np.concatenate(ids) if ids else np.empty(0, np.int32)
            columns = {"id": part.column("id"), "ids": pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, pa.int32()))}
            if decode:
                columns["decoded"] = pa.array(tokenizer.decode(ids), pa.binary())
            yield pa.RecordBatch.from_pydict(columns)

    return run


def encode(
    docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", decode: bool = False
) -> DataFrame:
    """``id_col, ids`` of each row's whole text under the rank file at
    ``path`` (read by the driver; a vocabulary is a few MB at most) and, if
    ``decode``, the bytes that the ids stand for as ``decoded``."""
    with open(path, "rb") as f:
        content = f.read()
    shared = docs.sparkSession.sparkContext.broadcast((content, pattern))
    name = xxhash.xxh3_128_hexdigest(content + pattern.encode())
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = f"id {base.schema['id'].dataType.simpleString()}, ids array<int>" + (", decoded binary" if decode else "")
    return base.mapInArrow(_runner(name, shared, decode), schema).withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, path: str, pattern: str, id_col: str = "doc_id") -> DataFrame:
    """``id_col, decoded``: the bytes of each row's ``ids``."""
    with open(path, "rb") as f:
        content = f.read()
    shared = encoded.sparkSession.sparkContext.broadcast((content, pattern))
    name = xxhash.xxh3_128_hexdigest(content + pattern.encode())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _worker(name, shared)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                lists = [np.array(x or [], np.int32) for x in part.column("ids").to_pylist()]
                yield pa.RecordBatch.from_pydict({"id": part.column("id"), "decoded": pa.array(tokenizer.decode(lists), pa.binary())})

    base = encoded.select(F.col(id_col).alias("id"), "ids")
    schema = f"id {base.schema['id'].dataType.simpleString()}, decoded binary"
    return base.mapInArrow(run, schema).withColumnRenamed("id", id_col)
