"""Benchmark decontamination by a prefix-filtered set join (operator 10).

An item is cut into windows of 10 consecutive words (a shorter item is one
window).  A document contains a window only if it contains every word of it,
so by the prefix principle one word a window is enough to find it: its
rarest.  Rarity is counted over all documents.

1. A first pass counts the benchmark's words in the documents.
2. Every distinct window gets its rarest word as prefix, with its offset.
3. A second pass emits, for each occurrence of a prefix word, the words
   around it; a Spark join on the word meets the windows.  Positions and
   lengths must fit (the window lies inside the document), then all words
   of the window are compared.

The passes recognise benchmark words by a bitmap of fixed size (1 MiB)
over their hashes, so nothing that grows with either table is broadcast; a
false match only adds rows that the join drops.  A prefix word that is
frequent in the documents is a skewed join key, split by adaptive execution.

Null texts and texts without words have no words, no hits and no items.
Items without words or without an id occur nowhere.  Repeated rows get
equal results.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from searchlake.llm.common import ALNUM, WordHash, bitmap, concat, place, slices, utf8, without, written

WINDOW = 10


def item_words(text: bytes) -> list[bytes]:
    """Maximal runs of ASCII letters, digits and non-ASCII characters."""
    return text.translate(ALNUM).split()


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches):
        ids, out = part.column("item_id").to_pylist(), ([], [])
        for item, text in zip(ids, utf8(part)):
            words = item_words(text)
            size = min(WINDOW, len(words))
            for window in {b" ".join(words[i : i + size]) for i in range(len(words) - size + 1)} if words else ():
                out[0].append(window.decode())
                out[1].append(item)
        yield pa.RecordBatch.from_arrays(
            [pa.array(out[0], pa.string()), pa.array(out[1], part.column("item_id").type)], names=["window", "item_id"]
        )


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = batch.column("word").cast(pa.binary()).to_pylist()
        h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
        yield pa.RecordBatch.from_pydict({"h": pa.array(h.view(np.int64))})


def word_bitmap(words: DataFrame) -> np.ndarray:
    return bitmap(words.select("word").distinct().mapInArrow(_hashes, "h long"))


def _count_words(bits):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, total = bits.value, Counter()

        def flush():
            out = pa.RecordBatch.from_arrays(
                [pa.array([w.decode() for w in total], pa.string()), pa.array(list(total.values()), pa.int64())],
                names=["word", "n"],
            )
            total.clear()
            return out

        for part in slices(batches):
            here = Counter(concat([item_words(t) for t in utf8(part)])[0])
            known = list(here)
            for i in np.flatnonzero(table[place(WordHash().of(known))]).tolist():
                total[known[i]] += here[known[i]]
            if len(total) > 200_000:
                yield flush()
        if total:
            yield flush()

    return run


def _occurrences(bits):
    """Per document its number of words and, for each prefix word in it, the
    position and the words that a window through it could hold."""
    near = pa.list_(pa.struct([("word", pa.string()), ("pos", pa.int64()), ("around", pa.string()), ("before", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, cache = bits.value, WordHash()
        for part in slices(batches):
            texts = utf8(part)
            lists = [item_words(t) for t in texts]
            words, ends = concat(lists)
            at = np.flatnonzero(table[place(cache.of(words))])
            owner = np.searchsorted(ends, at, "right") - 1
            found: list[list] = [[] for _ in lists]
            for p, d in zip(at.tolist(), owner.tolist()):
                pos, own = p - int(ends[d]), lists[d]
                start = max(0, pos - WINDOW + 1)
                found[d].append(
                    {"word": own[pos].decode(), "pos": pos, "around": b" ".join(own[start : pos + WINDOW]).decode(), "before": pos - start}
                )
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("id"),
                    pa.array([xxhash.xxh3_128_digest(t) for t in texts], pa.binary()),
                    pa.array([len(x) for x in lists], pa.int64()),
                    pa.array(found, near),
                ],
                names=["id", "digest", "n_words", "found"],
            )

    return run


def contaminated_windows(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """``(rows, hits)``: ``rows(id, digest, n_words)`` has each input row,
    ``hits(digest, start, size, item_id)`` each verified occurrence of an
    item's window in a distinct text (``start`` is a word position)."""
    spark = docs.sparkSession
    base = docs.select(F.col(id_col).alias("id"), F.col("text").cast("string").alias("text"))
    items = benchmark.select("item_id", F.col("text").cast("string").alias("text")).where("item_id is not null")
    id_type = base.schema["id"].dataType.simpleString()
    item_type = items.schema["item_id"].dataType.simpleString()
    owners = written(items.mapInArrow(_windows, f"window string, item_id {item_type}").distinct(), "item-windows")
    window_words = owners.select("window").distinct().select(
        "window", F.size(F.split("window", " ")).alias("size"), F.posexplode(F.split("window", " ")).alias("offset", "word")
    )

    known = spark.sparkContext.broadcast(word_bitmap(window_words))
    counts = base.select("text").mapInArrow(_count_words(known), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    ranked = window_words.join(counts, "word", "left")
    prefix = ranked.groupBy("window", "size").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "word", "offset")).alias("p")
    )
    prefix = written(prefix.select("window", "size", "p.word", "p.offset"), "prefixes")

    anchors = spark.sparkContext.broadcast(word_bitmap(prefix))
    schema = f"id {id_type}, digest binary, n_words long, " \
             "found array<struct<word: string, pos: long, around: string, before: long>>"
    rows = written(base.mapInArrow(_occurrences(anchors), schema), "occurrences")
    seen = rows.select("digest", "n_words", F.explode("found").alias("f")).select("digest", "n_words", "f.*")
    # Position and length bounds, then all words of the window.
    met = seen.join(prefix, "word").where("pos >= offset and pos - offset + size <= n_words")
    here = F.expr("array_join(slice(split(around, ' '), before - offset + 1, size), ' ')")
    met = met.where(here == F.col("window")).select("digest", (F.col("pos") - F.col("offset")).alias("start"), "size", "window")
    hits = written(met.distinct().join(owners, "window").select("digest", "start", "size", "item_id"), "hits")
    return rows.select("id", "digest", "n_words"), hits


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row per input row: ``id_col, n_words, n_hit`` (words inside any
    occurrence), ``item_ids`` (sorted as strings) and ``contaminated``."""
    rows, hits = contaminated_windows(docs, benchmark, id_col)
    spans = hits.select("digest", "start", "size").distinct()
    covered = spans.select("digest", F.explode(F.expr("sequence(start, start + size - 1)")).alias("pos")).distinct()
    n_hit = covered.groupBy("digest").agg(F.count(F.lit(1)).alias("n_hit"))
    found = hits.select("digest", "item_id").distinct().groupBy("digest").agg(
        F.sort_array(F.collect_list(F.col("item_id").cast("string"))).alias("item_ids")
    )
    out = rows.join(n_hit.join(found, "digest"), "digest", "left")
    return out.select(
        F.col("id").alias(id_col), "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )


def clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``docs`` without the rows whose id has a contaminated text; rows
    without an id stay."""
    return without(docs, decontaminate(docs, benchmark, id_col).where("contaminated"), id_col)
