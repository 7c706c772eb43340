"""Vector code compression (operator 13): one byte per vector part.

A vector becomes integers, is cut into equal parts, and each part is replaced
by the index of its nearest entry in a small codebook.  The codebooks come
from a fixed number of rounds of integer k-means over all rows.

The nearest entry is found through memoised grid cells: a part falls into a
coarse cell of an axis-parallel grid, and for each cell the entries are
remembered that some point of the cell's box may have as its nearest one.  An
entry is left out when its least distance to the box exceeds the largest
distance that another entry can have there.  Only the remembered entries are
measured exactly, so results equal a full search, ties included.

A round is one pass over the rows; a task sends one row of sums for each
codebook component, so the driver sees ``parts * entries * width`` numbers a
round, however many rows there are.

Defined cases: a vector that is null or has a null or non-finite component is
dropped, as the contract says.  Shorter vectors, and lengths that the parts
don't divide, are padded with zeros, which changes no distance.  A component
whose squared distances wouldn't fit in 64 bits counts as the largest that
does (beyond 46,000 at 64 components).  A repeated id starts one entry, with
its smallest vector; null ids come last.  Fewer rows than entries give smaller
codebooks, an empty table an empty result.  A label's sum beyond 64 bits is
null.  Other columns of the input are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from searchlake.llm.common import mix, written

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096

#: Grid cells are 2**CELL_BITS wide in each component; a worker remembers the
#: entries of this many cells per part.
CELL_BITS, CELLS = 10, 1 << 14

#: Components are stored big-endian and shifted, so bytes order as vectors do.
_SHIFT = 1 << 31
_SLICE = 4096

_RESULT = "code string, error long"


class GridCells:
    """Nearest entries of one part's codebook ``entries`` (k x width)."""

    def __init__(self, entries: np.ndarray, bits: int = CELL_BITS, cells: int = CELLS):
        self.entries, self.bits, self.cells = entries, bits, max(cells, _SLICE)
        self.known: dict[int, int] = {}
        self.coords = np.zeros((self.cells, entries.shape[1]), np.int64)
        self.near = np.zeros((self.cells, len(entries)), bool)
        self.measured = 0

    def candidates(self, cell: np.ndarray) -> np.ndarray:
        """Per cell, which entries no other entry dominates across its box."""
        low = (cell << self.bits)[:, None, :] - self.entries
        high = low + (1 << self.bits) - 1
        least = np.maximum(np.maximum(low, -high), 0)
        most = np.maximum(-low, high)
        return (least * least).sum(2) <= (most * most).sum(2).min(1, keepdims=True)

    def _rows(self, cell: np.ndarray) -> np.ndarray:
        """A boolean row of candidates for each given cell."""
        h = mix(np.full(len(cell), cell.shape[1], np.uint64))
        for column in cell.T:
            h = mix(h ^ column.astype(np.uint64))
        keys, first, inverse = np.unique(h, return_index=True, return_inverse=True)
        new = [i for i, key in enumerate(keys.tolist()) if key not in self.known]
        if len(self.known) + len(new) > self.cells:
            self.known.clear()
            new = list(range(len(keys)))
        if new:
            at = len(self.known)
            own = cell[first[new]]
            self.coords[at : at + len(new)] = own
            self.near[at : at + len(new)] = self.candidates(own)
            self.known.update(zip(keys[new].tolist(), range(at, at + len(new))))
        slot = np.fromiter(map(self.known.__getitem__, keys.tolist()), np.int64, len(keys))[inverse.reshape(-1)]
        out = self.near[slot]
        # Another cell with this hash was remembered: measure all entries.
        out[(self.coords[slot] != cell).any(1)] = True
        return out

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest entry (the lowest of equals) and its squared distance."""
        rows = self._rows(x >> self.bits)
        best = np.full(len(x), np.iinfo(np.int64).max)
        code = np.zeros(len(x), np.int64)
        for i, entry in enumerate(self.entries):
            at = np.flatnonzero(rows[:, i])
            off = x[at] - entry
            d = (off * off).sum(1)
            self.measured += len(at)
            closer = d < best[at]
            best[at[closer]] = d[closer]
            code[at[closer]] = i
        return code, best


def to_integers(batch: pa.RecordBatch, column: str, dims: int) -> np.ndarray:
    """The vectors as rows of floor(SCALE * x), padded with zeros."""
    limit = math.isqrt((2**63 - 1) // dims) // 2
    lists = batch.column(column)
    size = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    out = np.zeros((len(size), dims), np.int64)
    out[np.arange(dims) < size[:, None]] = np.clip(np.floor(flat * SCALE), -limit, limit).astype(np.int64)
    return out


def _matrices(batches: Iterable[pa.RecordBatch], dims: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Slices of the stored rows with their vectors as a matrix."""
    for batch in batches:
        for start in range(0, batch.num_rows, _SLICE):
            rows = batch.slice(start, _SLICE)
            x = np.frombuffer(b"".join(rows.column("ints").to_pylist()), ">u4").astype(np.int64) - _SHIFT
            yield rows, x.reshape(rows.num_rows, dims)


def _cut(x: np.ndarray, parts: int) -> list[np.ndarray]:
    width = x.shape[1] // parts
    return [np.ascontiguousarray(x[:, p * width : (p + 1) * width]) for p in range(parts)]


def usable(vector: str) -> F.Column:
    """The vector is there and all its components are finite numbers."""
    x = F.col(vector)
    fine = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")))
    return x.isNotNull() & F.coalesce(fine, F.lit(False))


def integer_vectors(vectors: DataFrame, id_col: str, vector_col: str, label_col: str, parts: int) -> tuple[DataFrame, int]:
    """``id, label, ints`` of the usable rows, written once, and the padded
    number of components."""
    kept = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).alias("vector"))
    kept = kept.where(usable("vector"))
    longest = kept.agg(F.max(F.size("vector"))).first()[0] or 0
    dims = max(1, math.ceil(longest / parts)) * parts

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, _SLICE):
                batch = whole.slice(start, _SLICE)
                x = (to_integers(batch, "vector", dims) + _SHIFT).astype(">u4")
                ints = pa.array([row.tobytes() for row in x], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), ints], ["id", "label", "ints"])

    schema = T.StructType([kept.schema["id"], kept.schema["label"], T.StructField("ints", T.BinaryType())])
    return written(kept.mapInArrow(store, schema), "vector-ints"), dims


def first_entries(rows: DataFrame, entries: int) -> list[bytes]:
    """The vectors of the ``entries`` smallest ids, one each, in id order."""
    fields, id_type = T.StructType([rows.schema["id"], rows.schema["ints"]]), to_arrow_type(rows.schema["id"].dataType)

    def smallest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict = {}
        for batch in batches:
            for i, ints in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if i in best:
                    best[i] = min(best[i], ints)
                elif len(best) < entries or (i is not None and (None in best or i < max(best))):
                    best[i] = ints
                    if len(best) > entries:
                        del best[None if None in best else max(best)]
        ids, ints = list(best), list(best.values())
        yield pa.RecordBatch.from_arrays([pa.array(ids, id_type), pa.array(ints, pa.binary())], ["id", "ints"])

    few = rows.select("id", "ints").mapInArrow(smallest, fields).groupBy("id").agg(F.min("ints").alias("ints"))
    return [bytes(r["ints"]) for r in few.orderBy(F.col("id").asc_nulls_last()).limit(entries).collect()]


def train(rows: DataFrame, dims: int, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks (parts x entries x width) after ``rounds`` of k-means."""
    start = [np.frombuffer(b, ">u4").astype(np.int64) - _SHIFT for b in first_entries(rows, entries)]
    books = np.array([_cut(row[None], parts) for row in start], np.int64).reshape(len(start), parts, dims // parts)
    books = np.ascontiguousarray(books.transpose(1, 0, 2))
    for _ in range(rounds if len(start) else 0):
        sums = rows.select("ints").mapInArrow(_sums(books, dims), "part int, entry int, place int, n long, total long")
        exact = F.sum(F.col("total").cast("decimal(38,0)")).alias("total")
        for r in sums.groupBy("part", "entry", "place").agg(F.sum("n").alias("n"), exact).collect():
            books[r["part"], r["entry"], r["place"]] = int(r["total"]) // r["n"]
    return books


def _sums(books: np.ndarray, dims: int):
    """Task function: counts and component sums of each used entry."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, k, width = books.shape
        cells = [GridCells(b) for b in books]
        n, total = np.zeros((parts, k), np.int64), np.zeros(books.shape, np.int64)
        for _, x in _matrices(batches, dims):
            for p, own in enumerate(_cut(x, parts)):
                code, _ = cells[p].nearest(own)
                n[p] += np.bincount(code, minlength=k)
                np.add.at(total[p], code, own)
        part, entry = np.nonzero(n)
        yield pa.RecordBatch.from_pydict({
            "part": np.repeat(part, width).astype(np.int32), "entry": np.repeat(entry, width).astype(np.int32),
            "place": np.tile(np.arange(width, dtype=np.int32), len(part)),
            "n": np.repeat(n[part, entry], width), "total": total[part, entry].reshape(-1),
        })

    return run


def encode(rows: DataFrame, books: np.ndarray, dims: int) -> DataFrame:
    """``id, label, code, error`` of the stored rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = [GridCells(b) for b in books]
        for batch, x in _matrices(batches, dims):
            codes, error = np.zeros((len(x), len(books)), np.uint8), np.zeros(len(x), np.int64)
            for p, own in enumerate(_cut(x, len(books))):
                code, d = cells[p].nearest(own)
                codes[:, p] = code
                error += d
            hexes = pa.array([c.tobytes().hex() for c in codes], pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("label"), hexes, pa.array(error)], ["id", "label", "code", "error"]
            )

    schema = T.StructType([rows.schema["id"], rows.schema["label"], *T.StructType.fromDDL(_RESULT).fields])
    return rows.mapInArrow(run, schema)


#: A label with more than one row in this many gets its sum by broadcast.
COMMON = 1000


def with_label_error(coded: DataFrame) -> DataFrame:
    """``coded`` plus the errors summed over equal labels, nulls together.

    Labels that hold more than a thousandth of the rows (fewer than a thousand
    labels) are broadcast, so no hot label is shuffled; the others, each a
    small share, meet their sums in a join."""
    coded = written(coded, "vector-codes")
    total = coded.count()
    by_label = coded.groupBy(F.col("label").alias("l")).agg(
        F.sum(F.col("error").cast("decimal(38,0)")).try_cast("long").alias("label_error"), F.count(F.lit(1)).alias("n")
    )
    by_label = written(by_label, "vector-labels")
    common, rare = by_label.where(F.col("n") * COMMON > total), by_label.where(F.col("n") * COMMON <= total)
    first = coded.join(F.broadcast(common), F.col("label").eqNullSafe(F.col("l")), "left")
    done = first.where(F.col("n").isNotNull()).select(*coded.columns, "label_error")
    rest = first.where(F.col("n").isNull()).select(*coded.columns)
    return done.unionByName(rest.join(rare, F.col("label").eqNullSafe(F.col("l"))).select(*coded.columns, "label_error"))


def codebook_digest(books: np.ndarray) -> str:
    """SHA-256 of all components by part, entry and place."""
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def compress(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
) -> DataFrame:
    """``id_col, code, error, label_error, codebooks_sha256`` per usable row."""
    if not 1 <= entries <= 256:
        raise ValueError("a code has one byte: 1 to 256 entries")
    rows, dims = integer_vectors(vectors, id_col, vector_col, label_col, parts)
    books = train(rows, dims, parts, entries, rounds)
    out = with_label_error(encode(rows, books, dims))
    return out.select(F.col("id").alias(id_col), "code", "error", "label_error", F.lit(codebook_digest(books)).alias("codebooks_sha256"))
