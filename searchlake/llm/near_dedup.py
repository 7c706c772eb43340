"""MinHash near-dedup by fast similarity sketching (operator 6).

A document is the set of its 5-word shingles.  Its sketch has ``BINS``
coordinates, filled in rounds: in round r < BINS every shingle falls into a
hashed bin with value (r, hash); in round BINS + b every shingle goes to bin
b, so that after at most 2 * BINS rounds each coordinate is filled, and long
documents are done after two or three.  Equal coordinates estimate the
Jaccard similarity with concentration like independent samples.

Plan: one pass over the texts writes digest, set size and band keys.  Equal
word sequences collapse to one class.  Classes that share a band key form a
bucket; the bucket's members are compared with one hub, on full sets.  Then
only members that are not yet in one component with each other need more:
the pairs across components of a bucket that three bounds leave over, the
triangle inequality of the Jaccard distance (through the hub), the set sizes,
and a second sketch of ``CODE_BITS`` one-bit coordinates.  So a group of
copies yields one pair a member, and unlike members of a bucket none.
With 32 bands of 4 rows two documents of similarity 0.75 share no bucket
with probability 5e-6; the one-bit sketch overlooks them with 1e-7.

Null texts and texts without words have the empty set and no links; rows
without an id are returned with a null component and kept.  Rows sharing an
id are one document: their texts' groups are one.  Repeated rows get equal
results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from searchlake.llm.common import WordHash, bitmap, long_list, mix, place, seeds, shingle_sets, slices, utf8, without, written
from searchlake.llm.components import connected_components

WIDTH = 5
#: A link needs intersection / union >= SIMILAR / 100.
SIMILAR = 75
BINS = 128
BAND_ROWS = 4
#: One-bit coordinates agree with probability (1 + similarity) / 2: 0.875 for
#: a link, with a deviation of 0.0052 (0.0103 for the first quarter of them).
#: Five deviations below are still compared.
CODE_BITS = 4096
CODE_DIFFER = 618
QUICK_BITS = 1024
QUICK_DIFFER = 183

_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def ws_words(text: bytes) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case."""
    return text.lower().split()


def sketch(sets: list[np.ndarray], bins: int = BINS, seed: int = 6) -> np.ndarray:
    """The fast similarity sketch of every set: a row of ``bins`` 64-bit
    coordinates (all ones for an empty set)."""
    n = len(sets)
    table = np.full(n * bins, _EMPTY, np.uint64)
    sizes = np.array([len(s) for s in sets], np.int64)
    flat = np.concatenate(sets) if n else np.empty(0, np.uint64)
    owner = np.repeat(np.arange(n, dtype=np.int64) * bins, sizes)
    seed_of = seeds(2 * bins, seed)
    rows, todo, check = table.reshape(n, bins), sizes > 0, 0
    for r in range(2 * bins):
        if not len(flat):
            break
        h = mix(flat ^ seed_of[r])
        value = (h >> np.uint64(14)) | np.uint64(r << 50)
        place = owner + ((h & np.uint64(bins - 1)).astype(np.int64) if r < bins else r - bins)
        np.minimum.at(table, place, value)
        # A round more changes nothing in a full sketch, so looking for full
        # ones can wait longer the more rounds there were.
        if r >= check:
            check = r + 1 + r // 8
            still = np.flatnonzero(todo)
            todo[still] = (rows[still] == _EMPTY).any(axis=1)
            if len(still) != todo.sum():
                keep = todo[owner // bins]
                flat, owner = flat[keep], owner[keep]
    return table.reshape(n, bins)


def band_keys(rows: np.ndarray, band_rows: int = BAND_ROWS) -> np.ndarray:
    """One 64-bit key per band of a sketch; the band's number is part of it."""
    n, bins = rows.shape
    bands = bins // band_rows
    grouped = rows.reshape(n, bands, band_rows)
    key = np.tile(seeds(bands, 66), (n, 1))
    for k in range(band_rows):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + grouped[:, :, k])
    return key


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cache = WordHash()
    for part in slices(batches):
        lists = [ws_words(t) for t in utf8(part)]
        sets = shingle_sets(lists, cache, WIDTH)
        keys = band_keys(sketch(sets))
        yield pa.RecordBatch.from_arrays(
            [
                part.column("id"),
                pa.array([xxhash.xxh3_128_digest(b" ".join(w)) if w else None for w in lists], pa.binary()),
                pa.array([len(s) for s in sets], pa.int64()),
                long_list(keys),
            ],
            names=["id", "node", "n_shingles", "bands"],
        )


def _candidates(bits):
    """Rows whose hashed id may be wanted; the text of the others stays here."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = batch.column("h").to_numpy(zero_copy_only=False).view(np.uint64)
            yield batch.select(["id", "text"]).filter(pa.array(bits.value[place(h)]))

    return run


def codes(sets: list[np.ndarray]) -> np.ndarray:
    """``CODE_BITS`` one-bit coordinates of every set, as 64-bit words."""
    out = np.empty((len(sets), CODE_BITS // 64), np.uint64)
    for at in range(0, len(sets), 512):  # a sketch takes 32 KB here
        rows = mix(sketch(sets[at : at + 512], CODE_BITS, 77) ^ seeds(CODE_BITS, 777)) & np.uint64(1)
        out[at : at + 512] = np.packbits(rows.astype(np.uint8), axis=1).view(np.uint64)
    return out


def sequence_digest(text: bytes) -> bytes:
    return xxhash.xxh3_128_digest(b" ".join(ws_words(text)))


def _own_text(digest):
    """Rows whose text has the digest asked for (rows may share an id)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            same = [digest(t) == n for t, n in zip(utf8(part), part.column("node").to_pylist())]
            yield part.filter(pa.array(same, pa.bool_()))

    return run


def _coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cache = WordHash()
    for part in slices(batches):
        bits = codes(shingle_sets([ws_words(t) for t in utf8(part)], cache, WIDTH))
        yield pa.RecordBatch.from_arrays([part.column("node"), long_list(bits)], names=["node", "code"])


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Exact intersection and union sizes of the pairs' full shingle sets."""
    cache, known = WordHash(), {}

    def full(node: bytes, text: bytes) -> np.ndarray:
        if node not in known:
            if len(known) >= 64:
                known.clear()
            known[node] = shingle_sets([ws_words(text)], cache, WIDTH)[0]
        return known[node]

    for part in slices(batches, "text_a"):
        a, b = part.column("a").to_pylist(), part.column("b").to_pylist()
        inter, union = [], []
        for na, nb, ta, tb in zip(a, b, utf8(part, "text_a"), utf8(part, "text_b")):
            sa = shingle_sets([ws_words(ta)], cache, WIDTH)[0]
            sb = full(nb, tb)
            both = len(np.intersect1d(sa, sb, assume_unique=True))
            inter.append(both)
            union.append(len(sa) + len(sb) - both)
        yield pa.RecordBatch.from_arrays(
            [*(part.column(c) for c in "abuv"), pa.array(inter, pa.int64()), pa.array(union, pa.int64())],
            names=["a", "b", "u", "v", "inter", "union"],
        )


def _compare(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """``pairs(a, b)`` with the ids ``u`` and ``v`` that stand for them and the
    exact sizes; a hub that is ``b`` of very many pairs is a skewed join key,
    which adaptive execution splits."""
    a = texts.select(F.col("node").alias("a"), F.col("rep").alias("u"), F.col("text").alias("text_a"))
    b = texts.select(F.col("node").alias("b"), F.col("rep").alias("v"), F.col("text").alias("text_b"))
    kind = texts.schema["rep"].dataType.simpleString()
    return pairs.join(a, "a").join(b, "b").select("a", "b", "u", "v", "text_a", "text_b").mapInArrow(
        _compared, f"a binary, b binary, u {kind}, v {kind}, inter long, union long"
    )


def class_links(classes: DataFrame, base: DataFrame, digest=sequence_digest) -> DataFrame:
    """``a, b, u, v, inter, union`` of the verified links between classes that
    the plan needed: enough to connect all classes that links connect.
    ``classes(node, rep, n, bands)`` have one row a class; ``base(id, text)``
    has their texts, of id ``rep`` and with ``digest(text)`` = ``node``."""
    id_type = base.schema["id"].dataType.simpleString()
    banded = classes.select("node", F.posexplode("bands").alias("band", "key"))
    buckets = banded.groupBy("key").agg(F.min("node").alias("hub"), F.count(F.lit(1)).alias("size")).where("size > 1")
    members = written(banded.join(buckets.select("key", "hub"), "key"), "members")

    nodes = members.select("node").distinct().join(classes.select("node", "rep", "n"), "node")
    nodes = written(nodes, "nodes")
    wanted = base.sparkSession.sparkContext.broadcast(bitmap(nodes.select(F.xxhash64("rep").alias("h"))))
    few = base.select("id", "text", F.xxhash64("id").alias("h")).mapInArrow(_candidates(wanted), f"id {id_type}, text string")
    texts = few.join(nodes.select(F.col("rep").alias("id"), "node"), "id").select("node", F.col("id").alias("rep"), "text")
    texts = written(texts.mapInArrow(_own_text(digest), f"node binary, rep {id_type}, text string").dropDuplicates(["node"]), "texts")

    # Every member against its bucket's hub.
    star = members.where("node <> hub").select(F.col("node").alias("a"), F.col("hub").alias("b")).distinct()
    near = written(_compare(star, texts), "star")
    linked = F.expr(f"100 * inter >= {SIMILAR} * union")
    links = near.where(linked)
    first = connected_components(links.select("u", "v"))

    # Pairs across components of one bucket that are still possible.
    part = nodes.join(first.withColumnRenamed("node", "rep"), "rep", "left").select(
        "node", "n", F.coalesce("component", "rep").alias("component")
    )
    part = written(part, "parts")
    hub_part = part.select(F.col("node").alias("hub"), F.col("component").alias("hub_component"))
    apart = F.expr("1 - inter / union").alias("d")
    seen = members.where("node <> hub").join(part, "node").join(hub_part, "hub")
    torn = seen.where("component <> hub_component").select("key").distinct()
    dist = near.select(F.col("a").alias("node"), F.col("b").alias("hub"), apart)
    rest = seen.join(torn, "key").join(dist, ["node", "hub"])
    coded = texts.join(seen.join(torn, "key").select("node").distinct(), "node", "left_semi").select("node", "text")
    rest = rest.join(coded.mapInArrow(_coded, "node binary, code array<bigint>"), "node")
    rest = written(rest.join(classes.select("node", "bands"), "node"), "rest")
    x = rest.where("component <> hub_component").select(
        "key", "band", F.col("bands").alias("ba"), F.col("node").alias("a"), F.col("n").alias("na"), F.col("d").alias("da"), F.col("component").alias("ca"),
        F.col("code").alias("wa"),
    )
    y = rest.select("key", F.col("bands").alias("bb"), F.col("node").alias("b"), F.col("n").alias("nb"), F.col("d").alias("db"),
                    F.col("component").alias("cb"), F.col("hub_component").alias("ch"), F.col("code").alias("wb"))
    # Distances, set sizes and codes must allow a similarity of SIMILAR / 100;
    # a pair is taken in the first bucket that it shares.
    quick = " + ".join(f"bit_count(wa[{i}] ^ wb[{i}])" for i in range(QUICK_BITS // 64))
    whole = "aggregate(zip_with(wa, wb, (x, y) -> bit_count(x ^ y)), 0, (s, n) -> s + n)"
    may = f"ca <> cb and (cb = ch or a < b) and abs(da - db) <= {1 - SIMILAR / 100} + 1e-9" \
          f" and 100 * least(na, nb) >= {SIMILAR} * greatest(na, nb)" \
          f" and {quick} <= {QUICK_DIFFER} and {whole} <= {CODE_DIFFER}" \
          " and array_position(zip_with(ba, bb, (x, y) -> x = y), true) = band + 1"
    cross = x.join(y, "key").where(may).select("a", "b").distinct()
    more = _compare(cross, texts).where(linked)
    return written(links.union(more), "links")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``id_col, n_shingles, component_id, n_links``
    and ``kept``.  ``component_id`` is the smallest id reachable through
    links (its own at least); ``n_links`` counts the verified links of the
    row's class to other classes that the plan needed."""
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    id_type = base.schema["id"].dataType.simpleString()
    rows = written(base.mapInArrow(_sketched, f"id {id_type}, node binary, n_shingles long, bands array<long>"), "sketch")

    # One class per word sequence; the smallest id stands for it.
    classes = written(
        rows.where("node is not null and id is not null")
        .groupBy("node").agg(F.min("id").alias("rep"), F.max("n_shingles").alias("n"), F.first("bands").alias("bands")),
        "classes",
    )
    ends = written(class_links(classes, base).select("u", "v").distinct(), "ends")
    # An id with several texts ties their classes together.
    known = rows.where("node is not null and id is not null").select("id", "node")
    several = known.groupBy("id").agg(F.min("node").alias("first"), F.max("node").alias("last")).where("first <> last")
    tied = known.join(several.select("id", "first"), "id").where("node <> first").select("node", "first").distinct()
    reps = classes.select("node", "rep")
    tied = tied.join(reps.withColumnRenamed("rep", "u"), "node").join(
        reps.select(F.col("node").alias("first"), F.col("rep").alias("v")), "first"
    )
    final = connected_components(ends.union(tied.select("u", "v")))

    degree = ends.select(F.explode(F.array("u", "v")).alias("rep")).groupBy("rep").agg(F.count(F.lit(1)).alias("n_links"))
    label = classes.select("node", "rep").join(final.withColumnRenamed("node", "rep"), "rep", "left").join(degree, "rep", "left")
    label = label.select("node", F.coalesce("component", "rep").alias("component"), "n_links")
    out = rows.select("id", "node", "n_shingles").join(label, "node", "left")
    component = F.coalesce("component", "id")
    return out.select(
        F.col("id").alias(id_col), "n_shingles", component.alias("component_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group; rows without an id stay."""
    return without(docs, near_duplicates(docs, id_col, text_col).where(~F.col("kept")), id_col, once=True)
