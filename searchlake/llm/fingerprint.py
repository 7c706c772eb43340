"""Document fingerprints: MinHash with universal hashing (operator 5).

A text is the set of its 5-word shingles (a text of fewer words has its word
sequence as one, a text without words its characters).  ``PERMUTATIONS``
functions a * x + b mod 2**64 with odd a, each a permutation of the 64-bit
shingle hashes, are evaluated in vectorised numpy and keep their minimum; the
fingerprint is the hexadecimal row of the minima's high 32 bits, and the
share of equal places estimates the Jaccard similarity of two texts.

``links`` joins fingerprints of ``PLACES`` functions, the first of which are
those of the fingerprint: equal bands of 4 places make buckets in a Spark join,
each class of equal texts represented once by its digest.  The members of a
bucket are compared with its first, and only members that no verified link
connects yet with each other (operator 6), so a group of near copies has a few
links a member, not all its pairs.  The Jaccard similarity of the full shingle sets is verified.  With 32
bands two documents of similarity 0.75 share no band with probability 5e-6.
``with_links`` adds each row's class and number of links: inside a component
of the verified links, all pairs of classes are compared on full sets
(``link_counts``), block by block, so none is left out.

``with_edits`` compares each document with an edited text of its own, made
from the next document by ascending id, and with that next document.  The
texts are shuffled once, to ranges of ids cut at quantiles; the first
document of a range also goes to the end of the range before it, so no order
is ever computed in one task and a range is streamed, not gathered.

Null texts are empty; empty texts have the fingerprint of the empty set,
which equals only itself.  Ids are numbers; rows of one id are ordered by a
hash of their texts.  Rows without an id have an empty next document.
Without documents the result is empty.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from searchlake.llm.common import WordHash, bitmap, long_list, passing, seeds, shingle_sets, slices, utf8, written
from searchlake.llm.components import connected_components
from searchlake.llm.near_dedup import SIMILAR, _candidates, _own_text, band_keys, class_links, ws_words

WIDTH = 5
PERMUTATIONS = 64
#: Functions for the bands.
PLACES = 128
#: Ranges of ids per shuffle partition.
RANGES = 8
#: Shingles hashed at once: the working table stays in the processor's cache.
BLOCK = 512

#: Classes and shingles of a block of ``link_counts``, and the shingles of its
#: matrix at once.
BLOCK_CLASSES, BLOCK_SHINGLES, COLUMNS = 256, 500_000, 4096

_A = seeds(PLACES, 5) | np.uint64(1)
_B = seeds(PLACES, 55)


def minima(values: np.ndarray, places: int = PERMUTATIONS) -> np.ndarray:
    """The minimum of every hash function over 64-bit values."""
    best = np.full(places, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(values), BLOCK):
        h = values[None, at : at + BLOCK] * _A[:places, None]
        h += _B[:places, None]
        np.minimum(best, h.min(axis=1), out=best)
    return best


def sets_of(texts: list[bytes], cache: WordHash) -> list[np.ndarray]:
    """The shingle sets; characters alone (no words) make one shingle."""
    out = shingle_sets([ws_words(t) for t in texts], cache, WIDTH)
    return [s if len(s) or not t else np.array([xxhash.xxh3_64_intdigest(t)], np.uint64) for s, t in zip(out, texts)]


def signatures(texts: list[bytes], cache: WordHash) -> np.ndarray:
    """One row of 32-bit places a text; an empty text has all ones."""
    return _rows(sets_of(texts, cache), PERMUTATIONS)


def _rows(sets: list[np.ndarray], places: int) -> np.ndarray:
    out = np.full((len(sets), places), 0xFFFFFFFF, np.uint32)
    for i, s in enumerate(sets):
        if len(s):
            out[i] = _high(minima(s, places))
    return out


def _high(best: np.ndarray) -> np.ndarray:
    return np.minimum(best >> np.uint64(32), np.uint64(0xFFFFFFFE)).astype(np.uint32)


def edited_signatures(texts: list[bytes], changed: list[bytes], cache: WordHash) -> tuple[np.ndarray, np.ndarray]:
    """``signatures`` of texts and of their edited texts.  What both sets of a
    text have in common is evaluated once."""
    out = np.full((2, len(texts), PERMUTATIONS), 0xFFFFFFFF, np.uint32)
    for i, (a, b) in enumerate(zip(sets_of(texts, cache), sets_of(changed, cache))):
        at = np.searchsorted(a, b)
        known = np.append(a, a[:1])[at] == b if len(a) else np.zeros(len(b), bool)
        common = np.zeros(len(a), bool)
        common[at[known]] = True
        both = minima(a[common])
        for row, s, rest in ((out[0, i], a, a[~common]), (out[1, i], b, b[~known])):
            if len(s):
                row[:] = _high(np.minimum(both, minima(rest)))
    return out[0], out[1]


def hexes(rows: np.ndarray) -> list[str]:
    return [r.tobytes().hex() for r in rows.astype(">u4")]


def _bytes(rows: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes() for r in rows.astype(">u4")], pa.binary())


def _in_hex(out: DataFrame) -> DataFrame:
    """Digests and fingerprints as text; until then half the bytes travel."""
    return out.withColumns({c: F.lower(F.hex(c)) for c in ("edited_sha256", "fingerprint", "edited_fingerprint")})


# --- near pairs ---------------------------------------------------------------------


def _banded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cache = WordHash()
    for part in slices(batches):
        texts = utf8(part)
        sets = sets_of(texts, cache)
        yield pa.RecordBatch.from_arrays(
            [
                part.column("id"), pa.array(map(xxhash.xxh3_128_digest, texts), pa.binary()),
                pa.array([len(x) for x in sets], pa.int64()), long_list(band_keys(_rows(sets, PLACES).astype(np.uint64))),
            ],
            names=["id", "node", "n", "bands"],
        )


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches):
        digest = pa.array([f"text:{xxhash.xxh3_128_hexdigest(t).upper()}" for t in utf8(part)], pa.string())
        yield pa.RecordBatch.from_arrays([digest, part.column("text")], names=["id", "text"])


def links(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """``(classes, links)``: ``classes(node, class_id)`` has the digest of each
    distinct text and the smallest id of its rows (null: none has an id);
    ``links(a, b, jaccard)`` the verified links between digests that connect
    all classes which links connect.  Empty texts have no links."""
    classes, found, _ = _links(docs, id_col, text_col)
    return classes.select("node", "class_id"), found.select("a", "b", (F.col("inter") / F.col("union")).alias("jaccard"))


def _links(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``classes(node, class_id, rep, n)``, the links of ``class_links`` and
    the texts ``(id, text)`` of the representatives ``rep``, among others."""
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = base.schema["id"].dataType.simpleString()
    rows = base.mapInArrow(_banded, f"id {kind}, node binary, n long, bands array<long>")
    classes = rows.groupBy("node").agg(F.min("id").alias("class_id"), F.max("n").alias("n"), F.first("bands").alias("bands"))
    classes = written(classes, "classes")
    # The row with a class's smallest id brings its text, so copies stay where
    # they are; only a class without any id is asked for by its digest.
    rep = F.coalesce(F.col("class_id").cast("string"), F.concat(F.lit("text:"), F.hex("node")))
    named = base.where("id is not null").select(F.col("id").cast("string").alias("id"), "text")
    unnamed = base.where("id is null").select("text").mapInArrow(_digests, "id string, text string").dropDuplicates(["id"])
    texts = named.unionByName(unnamed)
    found = class_links(classes.where("n > 0").select("node", rep.alias("rep"), "n", "bands"), texts, xxhash.xxh3_128_digest)
    return classes.select("node", "class_id", rep.alias("rep"), "n"), found, texts


def link_counts(classes: DataFrame, found: DataFrame, texts: DataFrame) -> DataFrame:
    """``(node, n_links)`` for each class with links, out of ``_links``: the
    number of other classes with a similarity of ``SIMILAR`` / 100 or more.

    Every link lies in a component, and two classes that are one have just
    their link.  A larger component is cut into blocks by a hash of the
    digest, of about ``BLOCK_CLASSES`` classes and ``BLOCK_SHINGLES`` shingles
    at most, and each pair of blocks is one group, so a task holds two blocks
    however large a component is."""
    parts = connected_components(found.select("u", "v")).withColumnRenamed("node", "rep").join(classes.select("node", "rep", "n"), "rep")
    parts = written(parts, "link-parts")
    sizes = parts.groupBy("component").agg(
        F.count(F.lit(1)).alias("size"), F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK_CLASSES), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("int").alias("blocks")
    )
    sized = written(parts.join(sizes, "component"), "link-sizes")
    pairs = sized.where("size = 2").select("node", F.lit(1).cast("long").alias("n_links"))
    large = sized.where("size > 2").withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    bits = texts.sparkSession.sparkContext.broadcast(bitmap(large.select(F.xxhash64("rep").alias("h"))))
    few = texts.select("id", "text", F.xxhash64("id").alias("h")).mapInArrow(_candidates(bits), "id string, text string")
    few = few.join(large.select(F.col("rep").alias("id"), "node", "component", "own", "blocks"), "id")
    schema = "node binary, text string, component string, own int, blocks int"
    few = few.select("node", "text", "component", "own", "blocks").mapInArrow(_own_text(xxhash.xxh3_128_digest), schema).dropDuplicates(["node"])
    dealt = few.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    group = ["component", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high")]
    counted = dealt.select("node", "text", "own", *group).groupBy("component", "low", "high").applyInArrow(_counted_links, "node binary, n_links long")
    return pairs.unionByName(counted).groupBy("node").agg(F.sum("n_links").alias("n_links")).where("n_links > 0")


def _counted_links(table: pa.Table) -> pa.Table:
    """Links of each class between two blocks, or inside the one block."""
    texts = [t.encode() for t in table.column("text").to_pylist()]
    sets = sets_of(texts, WordHash())
    sizes = np.array([len(s) for s in sets], np.int64)
    _, column, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(sets)), sizes)
    # A shingle of one set only is in no intersection.
    shared = often[column] > 1
    place = (np.cumsum(often > 1) - 1)[column[shared]]
    order = np.argsort(place, kind="stable")
    row, place = row[shared][order], place[order]
    inter = np.zeros((len(sets), len(sets)))
    ends = np.searchsorted(place, np.arange(0, place[-1] + 1 + COLUMNS, COLUMNS)) if len(place) else [0]
    for i, (a, z) in enumerate(zip(ends[:-1], ends[1:])):
        has = np.zeros((len(sets), COLUMNS), np.float32)
        has[row[a:z], place[a:z] - i * COLUMNS] = 1
        inter += has @ has.T
    linked = 100 * inter >= SIMILAR * (sizes[:, None] + sizes[None, :] - inter)
    np.fill_diagonal(linked, False)
    if table.column("low")[0] != table.column("high")[0]:
        own = table.column("own").to_numpy()
        linked &= own[:, None] != own[None, :]
    return pa.table({"node": table.column("node"), "n_links": pa.array(linked.sum(axis=1).astype(np.int64))})


def near_pairs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """``(members, pairs)``: ``members(id_col, class_id)`` puts rows of equal
    texts in one class, named by its smallest id; ``pairs(a, b, jaccard)``
    has the ``links`` between classes a <= b, of a Jaccard similarity of
    ``SIMILAR`` / 100 or more.  Rows without an id are in no class."""
    classes, found = links(docs.where(F.col(id_col).isNotNull()), id_col, text_col)
    base = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = base.schema["id"].dataType.simpleString()
    members = base.mapInArrow(_named, f"id {kind}, node binary").join(classes, "node").select(F.col("id").alias(id_col), "class_id")
    a, b = (classes.select(F.col("node").alias(x), F.col("class_id").alias(f"_{x}")) for x in "ab")
    pairs = found.join(a, "a").join(b, "b").select(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b"), "jaccard")
    return members, pairs


def _named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches):
        digest = pa.array(map(xxhash.xxh3_128_digest, utf8(part)), pa.binary())
        yield pa.RecordBatch.from_arrays([part.column("id"), digest], names=["id", "node"])


# --- each document, its edited text and the next document -------------------------------


def edited(own: str, following: str) -> str:
    """``own`` with its last floor(n / 2) characters replaced by the first as
    many (or all) of ``following``."""
    half = len(own) // 2
    return own[: len(own) - half] + following[:half]


def _compared(cache: WordHash, rows: list[tuple], chained: bool, id_type: pa.DataType) -> pa.RecordBatch:
    """Result rows of ``(id, text, next text)``; ``chained``: each row's next
    text is the text of the row after it."""
    ids, own, follow = zip(*rows)
    texts = [t.encode() for t in own]
    changed = [edited(a, b).encode() for a, b in zip(own, follow)]
    sig, sig_new = edited_signatures(texts, changed, cache)
    if chained:
        after = np.concatenate([sig[1:], signatures([follow[-1].encode()], cache)])
    else:
        after = signatures([t.encode() for t in follow], cache)
    return pa.RecordBatch.from_pydict({
        "id": pa.array(ids, id_type), "node": pa.array(map(xxhash.xxh3_128_digest, texts), pa.binary()), "n_chars": pa.array([len(t) for t in own], pa.int64()),
        "edited_sha256": pa.array([hashlib.sha256(t).digest() for t in changed], pa.binary()),
        "fingerprint": _bytes(sig), "edited_fingerprint": _bytes(sig_new),
        "near_edited": pa.array((sig == sig_new).mean(axis=1)), "near_next": pa.array((sig == after).mean(axis=1)),
    })


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by (part, tail, id, text hash).  The first tail row
    of a part starts the next part and only serves its predecessor here."""
    cache, held = WordHash(), None
    rows: list[tuple] = []
    size, id_type = 0, None
    for batch in slices(batches):
        id_type = batch.column("id").type
        for part, tail, i, text in zip(*(batch.column(c).to_pylist() for c in ("part", "tail", "id", "text"))):
            text = text or ""
            if held is not None and held[0] == part:
                rows.append((held[1], held[2], text))
                size += len(text)
            if rows and (tail or size >= 1 << 20):
                yield _compared(cache, rows, True, id_type)
                rows, size = [], 0
            held = None if tail else (part, i, text)


def _alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cache = WordHash()
    for batch in slices(batches):
        rows = [(i, t or "", "") for i, t in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist())]
        yield _compared(cache, rows, False, batch.column("id").type)


def with_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next`` for each row."""
    return _in_hex(_with_edits(docs, id_col, text_col).drop("node"))


def with_links(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``with_edits`` and ``class_id, n_links``: the smallest id among the rows
    of the same text, and the number of other texts that it links with."""
    with passing(docs.sparkSession):
        classes, found, texts = _links(docs, id_col, text_col)
        degree = link_counts(classes, found, texts)
        label = classes.join(degree, "node", "left").select("node", "class_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))
        label = written(label, "labels", lasting=True)
        rows = _with_edits(docs, id_col, text_col)
    return _in_hex(rows.join(label, "node", "left").drop("node"))


def _with_edits(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    spark = docs.sparkSession
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = base.schema["id"].dataType.simpleString()
    schema = f"id {kind}, node binary, n_chars long, edited_sha256 binary, fingerprint binary, edited_fingerprint binary, " \
             "near_edited double, near_next double"
    alone = base.where("id is null").mapInArrow(_alone, schema)

    # Quantiles of the ids cut the ranges; the bucketing is a binary search.
    n = RANGES * int(spark.conf.get("spark.sql.shuffle.partitions"))
    known = base.where("id is not null").withColumn("at", F.col("id").cast("double"))
    cuts = known.agg(F.percentile_approx("at", [i / n for i in range(1, n)], 4 * n).alias("q")).first()["q"] or []
    splits = [-float("inf"), *sorted(set(cuts)), float("inf")]
    ranged = Bucketizer(splits=splits, inputCol="at", outputCol="part").transform(known) if len(splits) > 2 else known.withColumn("part", F.lit(0.0))
    ranged = ranged.withColumn("part", F.col("part").cast("int"))
    firsts = ranged.groupBy("part").agg(F.min("id").alias("id")).orderBy("part").collect()  # one row a range
    before = {r["id"]: firsts[i - 1]["part"] for i, r in enumerate(firsts)}
    tails = spark.createDataFrame(list(before.items()), f"id {kind}, before int")
    placed = ranged.join(F.broadcast(tails), "id", "left")
    places = F.expr("filter(array(struct(part, false as tail), struct(before as part, true as tail)), x -> x.part is not null)")
    dealt = placed.select("id", "text", F.inline(places)).select("part", "tail", "id", "text").repartition("part")
    out = dealt.sortWithinPartitions("part", "tail", "id", F.xxhash64("text")).mapInArrow(_neighbours, schema)
    return out.unionByName(alone).withColumnRenamed("id", id_col)
